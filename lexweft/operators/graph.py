"""Connected components by alternating smallest-neighbour hooks, as joins; each round is kept in a checkpoint."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> None:
    """Sees to it that checkpoints have a folder: spark.checkpoint.dir, or a temporary one where none is set and all run on one machine."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="lexweft-"))


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Has the driver collect its garbage, as only then Spark deletes the shuffles and checkpoints of frames that are gone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (a, b) of any type that has an order; the component is its smallest node.

    Each round gives a node the smallest label among its own and its neighbours', then follows that label's own label
    (pointer jumping), so that the rounds grow with the logarithm of the longest path. It ends when a round changes nothing.
    """
    both = checkpointed(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    seen = None
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("least_"))
        # Kept, so that the join has an exchange of its own on either side, which may be split for a large component.
        hooked = checkpointed(labels.join(near, labels["node"] == near["a"], "left").select("node", F.least("component", F.coalesce("least_", "component")).alias("component")))
        jump = hooked.select(F.col("node").alias("via"), F.col("component").alias("next"))
        labels = checkpointed(hooked.join(jump, F.col("component") == F.col("via"), "left").select("node", F.least("component", F.coalesce("next", "component")).alias("component")))
        total = labels.agg(F.sum(F.xxhash64("node", "component").cast("decimal(38,0)"))).first()[0]
        if total == seen:
            return labels
        seen = total
