"""Connected components by alternating large-star and small-star rounds, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import durable


def _large(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node that it knows, itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("c")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
    out = down.join(least, F.col("a") == F.col("c"))
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("c").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """node, component (the smallest node that it reaches) for every node of an edge other than a component's smallest.

    Each round is kept in the shared folder and makes no more rows than nodes and edges. Ends when a round changes
    nothing: then every edge goes from a node to its component's smallest. The rounds grow with the logarithm of the
    number of nodes; each one that changes something brings a node closer, so there is no bound to set.

    rows: about how many edges there are at most, where that is known (see durable).
    """
    now = durable(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), rows)
    rows, seen = now.count(), None
    while True:
        now = durable(_small(_large(now)), rows)
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(mark) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = tuple(mark)
