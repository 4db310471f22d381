"""Secret scans with an incremental ledger of blobs.

Every historical version of every path is addressed by its content (SHA-256). The ledger, a table in a shared place, has a
row for each blob and rule version that has been scanned, with what was found. A run scans each blob once that the ledger
lacks under the present rules, however many paths and versions have it, appends the result and joins it back to all paths.

Findings are (kind, start, end) in code points, by start and then kind as listed in KINDS; matches of different kinds may
overlap or be equal, and all are kept. A private key reaches to its END line, if one follows before another BEGIN. Null
texts count as empty, repeated rows have the same findings each, an empty table gives an empty one (and an empty ledger),
and columns may have any names. A blob that stands in the ledger twice (two runs at once) counts once.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import column, fresh_path, map_text

#: Kind, pattern, least characters and of which group, strings of which a text needs one (in lower case if the last is true).
RULES = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, ("password", "passwd", "secret", "token", "api_key", "apikey"), True),
    ("access", r"AKIA[A-Z0-9]+", 18, 0, ("AKIA",), False),
    ("hex", r"[0-9a-f]{16,}", 16, 0, (), False),
    ("private_key", r"-----(BEGIN|END) (?:[A-Z]+ )*PRIVATE KEY-----", 1, 0, ("PRIVATE KEY-----",), False),
    ("code_host", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 1, 0, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), False),
    ("web_token", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 1, 0, ("eyJ",), False),
]
BASE = ("assign", "access", "hex")
KINDS = [r[0] for r in RULES]
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]
MASK = "[SECRET]"
_COMPILED = [(k, re.compile(p, re.ASCII | (re.IGNORECASE if low else 0)), least, group, need, low) for k, p, least, group, need, low in RULES]
_HEX = bytes(ord("x") if chr(c) in "0123456789abcdef" else ord(" ") for c in range(256))
SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All findings in a text, by start and kind."""
    if not text:
        return []
    out, low = [], None
    for order, (kind, pattern, least, group, need, lower) in enumerate(_COMPILED):
        if lower and low is None:
            low = text.lower()
        if kind == "hex":
            if b"x" * least not in text.encode().translate(_HEX):
                continue
        elif not any(x in (low if lower else text) for x in need):
            continue
        if kind == "private_key":
            out += [(a, order, b, kind) for a, b in _keys(list(pattern.finditer(text)))]
        else:
            out += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def _keys(lines: list[re.Match]) -> list[tuple[int, int]]:
    """From each BEGIN line to the END line that follows, or the BEGIN line alone where another one follows or nothing."""
    after = [*lines[1:], None]
    return [(m.start(), n.end() if n and n[1] == "END" else m.end()) for m, n in zip(lines, after, strict=True) if m[1] == "BEGIN"]


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for _, start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _scan(blobs: DataFrame) -> DataFrame:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    cover = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def kernel(texts):
        found = [find(t) for t in texts]
        return [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in f] for f in found], span), pa.array([[{"start": a, "end": b} for a, b in merged(f)] for f in found], cover)]

    return map_text(blobs, ["blob"], "text", [("spans", SPANS), ("cover", "array<struct<start:int,end:int>>")], kernel)


def ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def update(versions: DataFrame, path: str, text_col: str = "text", version: str = RULE_VERSION) -> DataFrame:
    """Scans what the ledger at `path` lacks of the versions' blobs; returns the ledger's rows under these rules."""
    spark = versions.sparkSession
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    blobs = versions.select(blob_id(column(text_col)).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    known = ledger(spark, path)
    if known is not None:
        seen = known.where(F.col("rule_version") == version).select(F.col("blob").alias("seen"))
        blobs = blobs.join(seen, F.col("blob") == F.col("seen"), "left_anti")
    _scan(blobs).withColumn("rule_version", F.lit(version)).write.mode("append").parquet(path)
    return spark.read.parquet(path).where(F.col("rule_version") == version)


def _findings(versions: DataFrame, text_col: str, path: str | None, *columns: Column) -> DataFrame:
    """found (blob) and columns of the ledger's rows with findings, one for each blob."""
    rows = update(versions, path or fresh_path(versions.sparkSession, "ledger"), text_col)
    return rows.where(F.size("spans") > 0).dropDuplicates(["blob"]).select(F.col("blob").alias("found"), *columns)


def scan(versions: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None) -> DataFrame:
    """keep, blob and spans (empty if there are none) for each version. path: of the ledger; a new one if not given.

    A kept column whose name is blob or spans is called kept_ and that name.
    """
    found = _findings(versions, text_col, path, F.col("spans"))
    rows = versions.select(*[column(c).alias(f"k{i}") for i, c in enumerate(keep)], blob_id(column(text_col)).alias("b"))
    out = rows.join(found, F.col("b") == F.col("found"), "left").drop("found")
    names = ["kept_" + c if c.lower() in ("blob", "spans") else c for c in keep]
    return out.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS))).toDF(*names, "blob", "spans")


def redact(docs: DataFrame, text_col: str = "text", path: str | None = None, mask: str = MASK) -> DataFrame:
    """docs with every finding in text_col replaced by mask; other texts and columns as they were."""
    found = _findings(docs, text_col, path, F.reverse("cover").alias("cover"))
    at = docs.columns.index(text_col)
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # so that docs may have any names
    text = F.col(f"c{at}")
    joined = rows.join(found, blob_id(text) == F.col("found"), "left")
    masked = F.aggregate("cover", text, lambda t, s: F.concat(F.substring(t, F.lit(1), s["start"]), F.lit(mask), F.substring(t, s["end"] + 1, F.length(t))))
    new = F.when(F.col("cover").isNull(), text).otherwise(masked)
    return joined.select(*[new.alias(c) if c == f"c{at}" else F.col(c) for c in rows.columns]).toDF(*docs.columns)
