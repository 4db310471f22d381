"""Sinks: tables by partition, merges by key, manifests, append-only history, exports."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.profiles import LATIN, Profile
from ..operators import search


def merged(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """new's rows, and old's rows of keys that new lacks; columns that one side lacks are null there."""
    keys = new.select(F.col(key).alias("k_")).distinct()
    return old.join(keys, F.col(key) == F.col("k_"), "left_anti").unionByName(new, allowMissingColumns=True)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Writes df; partitions that df has no rows for stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_lines(df: DataFrame, path: str) -> None:
    """Gzipped JSON lines, for readers outside."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def export_reproducible(df: DataFrame, path: str, order: list[str]) -> None:
    """One gzipped JSON-lines file whose bytes depend on the rows alone: sorted by `order`, without a time or name in it. For
    tables that one file may hold; the rows pass through one task."""
    lines = df.orderBy(*order).select(F.to_json(F.struct(*df.columns)).alias("value"))

    def pack(batches):
        parts = [v for b in batches for v in b["value"]]
        yield pd.DataFrame({"content": [gzip.compress("".join(f"{v}\n" for v in parts).encode(), mtime=0)]})

    content = lines.coalesce(1).mapInPandas(pack, "content binary").first()["content"]
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(content))
    out.close()


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, action) from two manifests (path, sha): add, drop, refresh or keep."""
    o, n = old.select("path", F.col("sha").alias("o")), new.select("path", F.col("sha").alias("n"))
    action = F.when(F.col("o").isNull(), "add").when(F.col("n").isNull(), "drop").when(F.col("o") != F.col("n"), "refresh").otherwise("keep")
    return o.join(n, "path", "full").select("path", action.alias("action"))


def last_wins(layers: list[DataFrame], key: str) -> DataFrame:
    """One row for each key: that of the last layer that has it."""
    marked = [df.withColumn("layer_", F.lit(i)) for i, df in enumerate(layers)]
    every = marked[0]
    for df in marked[1:]:
        every = every.unionByName(df, allowMissingColumns=True)
    return every.withColumn("r_", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("layer_")))).where("r_ = 1").drop("r_", "layer_")


def staged(spark, build, path: str, marker: str) -> dict:
    """Builds a table beside its place and moves it there only when it is whole; a failure leaves what was there.

    build(staging_path) writes the table. The old table is moved aside before and deleted after; what a crash between the
    two left aside is moved back first. Returns the status row that is appended to `marker`.
    """
    jvm = spark._jvm
    target, staging, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.staging", f"{path}.aside"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(aside):
        if fs.exists(target):
            fs.delete(aside, True)
        else:
            fs.rename(aside, target)
    fs.delete(staging, True)
    status = {"path": path, "ok": True, "error": ""}
    try:
        build(f"{path}.staging")
        if fs.exists(target) and not fs.rename(target, aside):
            raise OSError(f"{path} can't be moved aside")
        if not fs.rename(staging, target):
            fs.rename(aside, target)
            raise OSError(f"{path}.staging can't be moved to its place")
        fs.delete(aside, True)
    except Exception as e:  # noqa: BLE001  the failure is the result
        fs.delete(staging, True)
        status |= {"ok": False, "error": str(e)[:200]}
    spark.createDataFrame([status], "path string, ok boolean, error string").coalesce(1).write.mode("append").parquet(marker)
    return status


def stored_index(docs: DataFrame, path: str, uid: str = "doc_id", text_col: str = "text", p: Profile = LATIN, buckets: int = 64) -> dict[str, str]:
    """Stores the search index of a collection: units, postings and vocabulary dealt by a hash of the term, and one row of
    meta data. Returns the paths. A query of some terms reads their buckets only (see `postings_of`)."""
    paths = {name: f"{path}/{name}" for name in ("units", "postings", "vocabulary", "meta")}
    docs.write.mode("overwrite").parquet(paths["units"])
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")
    posts = search.postings(docs, uid, text_col, p).select("*", bucket)
    posts.write.mode("overwrite").partitionBy("bucket").parquet(paths["postings"])
    stored = docs.sparkSession.read.parquet(paths["postings"])
    stored.groupBy("bucket", "term").agg(F.count("*").alias("freq"), F.countDistinct("uid").alias("df")).write.mode("overwrite").partitionBy("bucket").parquet(paths["vocabulary"])
    meta = stored.agg(F.count("*").alias("tokens"), F.countDistinct("uid").alias("units")).withColumns({"profile": F.lit(p.name), "buckets": F.lit(buckets)})
    meta.coalesce(1).write.mode("overwrite").parquet(paths["meta"])
    return paths


def postings_of(spark, path: str, terms: list[str]) -> DataFrame:
    """The postings (uid, pos, term) of some terms in a stored index; other terms' buckets aren't read."""
    buckets = spark.read.parquet(f"{path}/meta").first()["buckets"]
    wanted = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "term string").select(F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")).distinct().collect()]
    return spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(*wanted) & F.col("term").isin(*terms)).drop("bucket")


def markdown(df: DataFrame, limit: int = 200) -> str:
    """A small table as Markdown; more than `limit` rows are an error, not a cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *["| " + " | ".join(cell(v) for v in r) + " |" for r in rows]]) + "\n"
