"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one Arrow slice handled at a time inside a Python kernel.
SLICE_ROWS = 512
#: Characters of one Arrow slice handled at a time, unless one text is longer.
SLICE_CHARS = 2_000_000
#: Rows of a small frame that are kept in one file.
ROWS_PER_FILE = 250_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and all run on one machine."""
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isEmpty():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            path = tempfile.mkdtemp(prefix="lexweft-")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(path)
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
    return known.get()


def durable(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Computes df once and keeps it in the shared folder, so that later jobs survive lost executors and see one version.

    rows: df comes out of a shuffle and has about so many rows at most, of a few numbers each; it is kept in a file for each
    ROWS_PER_FILE of them (and two for each core) instead of one for each shuffle partition.
    """
    shared_dir(df.sparkSession)
    return (df if rows is None else fewer(df, rows)).checkpoint(eager=True)


def fewer(df: DataFrame, rows: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """df, which has about `rows` rows at most, in as many partitions as that needs and two for each core, if it has more."""
    return df.coalesce(max(8, 2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_file)))


def free_name(df: DataFrame, name: str) -> str:
    """name, or name and so many underscores that no column of df starts with it (in any case)."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name


def column(name: str) -> Column:
    """The column of this very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for a table that is dropped when the session's JVM ends."""
    root = f"{shared_dir(spark)}/lexweft-{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        fs.mkdirs(place)
        fs.deleteOnExit(place)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _parquet_only(df: DataFrame) -> bool:
    """Whether df is a selection of columns and rows of Parquet files, each read once."""
    plan = df._jdf.queryExecution().optimizedPlan()
    lines = [re.sub(r"^[\s:+-]+", "", line) for line in plan.toString().splitlines() if line.strip()]
    if not {line.split(" ")[0] for line in lines} <= {"Project", "Filter", "Relation"} or not lines[-1].endswith(" parquet") or not plan.deterministic():
        return False
    files = list(plan.collectLeaves().head().relation().location().inputFiles())
    return len(set(files)) == len(files)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df and a column `name` that numbers its rows, the same in every job, however the files are split then.

    A row of a Parquet file has its place in the file, after the rows of the files before, so sorted tables are numbered in
    their order. Anything else is written to the shared folder first.
    """
    if not _parquet_only(df):
        path = fresh_path(df.sparkSession, "rows")
        df.write.parquet(path)
        df = df.sparkSession.read.parquet(path)
    at = df.metadataColumn("_metadata")
    placed = df.select("*", at["row_index"].alias(name), at["file_path"].alias(f"{name}file"))
    sizes = placed.groupBy(f"{name}file").agg(F.max(name).alias("n")).collect()
    starts, start = [], 0
    for path, n in sorted(tuple(r) for r in sizes):
        starts.append((path, start))
        start += n + 1
    # One row for each file, which the driver has listed already.
    first = F.broadcast(df.sparkSession.createDataFrame(starts, f"`{name}from` string, `{name}start` long"))
    out = placed.join(first, F.col(f"{name}file") == F.col(f"{name}from"))
    return out.select(*[column(c) for c in df.columns], (F.col(name) + F.col(f"{name}start")).alias(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: Column | str, n: int) -> Column:
    """crc32 of the id as text, mod n; null ids count as 0 text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def hash_order(df: DataFrame, id_col: str, bound: int, seed: int) -> DataFrame:
    """At most `bound` distinct ids, chosen by hash order: the same ones whatever the partitioning."""
    return df.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(F.xxhash64(id_col, F.lit(seed)), id_col).limit(bound)


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors unless their PYTHONPATH or working folder has it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.path.realpath(p) for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()] if p]
    sc = spark.sparkContext
    if os.path.realpath(root) in known or getattr(sc, "_lexweft_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="lexweft-"), "lexweft_pkg")
    atexit.register(shutil.rmtree, os.path.dirname(base), ignore_errors=True)
    sc.addPyFile(shutil.make_archive(base, "zip", root, "lexweft"))
    sc._lexweft_shipped = True


_CACHES: dict[str, dict] = {}


def worker_cache(name: str) -> dict:
    """What a Python worker keeps between batches and tasks of one kind; that of other kinds is dropped then."""
    if name not in _CACHES:
        _CACHES.clear()
        release()
        _CACHES[name] = {}
    return _CACHES[name]


def release() -> None:
    """Gives memory that a worker has freed back to the system: workers are used again by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = SLICE_ROWS, chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Arrow slices of bounded rows and characters, each with its texts as a list (None stays None)."""
    for batch in batches:
        texts, start, size = batch.column(text).to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if i + 1 - start >= rows or size >= chars or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0


def map_text(df: DataFrame, keep: list[str], text_col: str, out: list[tuple[str, str]], kernel: Callable[[list], list[pa.Array]], text_type: str = "string") -> DataFrame:
    """Adds columns `out` (name, DDL type) that kernel computes from a list of texts; keeps the columns `keep` beside them.

    kernel is called on the executors with the texts of one slice and returns one Arrow array for each new column. Columns
    travel under names of their own, so that they may have any names; a kept one whose name (in any case) is a new one's
    is called kept_ and that name.
    """
    ship(df.sparkSession)
    inner = df.select(*[column(c).alias(f"k{i}") for i, c in enumerate(keep)], column(text_col).cast(text_type).alias("text"))
    names = [*[f"k{i}" for i in range(len(keep))], *[f"o{i}" for i in range(len(out))]]
    schema = T.StructType([T.StructField(f"k{i}", inner.schema[f"k{i}"].dataType) for i in range(len(keep))] + [T.StructField(f"o{i}", T._parse_datatype_string(t)) for i, (_, t) in enumerate(out)])

    def run(batches):
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([*[batch.column(f"k{i}") for i in range(len(keep))], *kernel(texts)], names=names)

    new = {n.lower() for n, _ in out}
    return inner.mapInArrow(run, schema).toDF(*[f"kept_{c}" if c.lower() in new else c for c in keep], *[n for n, _ in out])
