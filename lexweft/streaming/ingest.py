"""Structured Streaming ingestion (an extension): new files become rows of a table once, keyed; windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _stream(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    folder, _, name = path.rstrip("/").rpartition("/")
    # A table that is one file is read as its folder with a name filter: file streams take folders only.
    return reader.option("pathGlobFilter", name).parquet(folder) if _single_file(spark, path) else reader.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))


def _single_file(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile())


def ingest_files(spark: SparkSession, source: str, target: str, key: str) -> None:
    """Reads all files that are there now; a key is added once, however often it comes.

    Each batch is written to a folder of its own, without the keys that earlier batches' folders have and with one row of
    each key that it brings itself. So a batch that runs twice overwrites itself with the same rows.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        here = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        if batch_id and _exists(here, f"{target}/table"):
            known = here.read.parquet(f"{target}/table").where(F.col("batch") < batch_id).select(F.col(key).alias("k_"))
            fresh = fresh.join(known, F.col(key) == F.col("k_"), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target}/table/batch={batch_id}")

    q = _stream(spark, source).writeStream.foreachBatch(sink).option("checkpointLocation", f"{target}/state").trigger(availableNow=True).start()
    q.awaitTermination()


def windowed_counts(spark: SparkSession, source: str, target: str, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Events by user, type and window: the windows that a watermark has closed, then those still open, from one stream.

    In update mode each batch brings the present count of every window it changed; the last one of a window counts.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{target}/table/batch={batch_id}")

    events = _stream(spark, source).withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    counts = events.groupBy("user_id", "event_type", F.window("at", window).alias("w")).agg(F.count("*").alias("n"))
    q = counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{target}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{target}/table")
    last = rows.groupBy("user_id", "event_type", F.col("w.start").alias("day")).agg(F.max_by("n", "batch_id").alias("n"))
    return last.select("user_id", "event_type", F.col("day").cast("timestamp_ntz").alias("day"), "n")
