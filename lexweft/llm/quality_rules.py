"""Quality rules with thresholds from mergeable quantile sketches for each language and source.

Base rules are fixed: a text of fewer than 20 words, or with more than 30 % of its words in repeated 8-word windows,
fails. The adaptive rules look at four ratios (symbols to characters, characters to words, repeated lines to lines,
capitals to characters). For each language and source a quantile sketch of each ratio gives the quartiles; a text passes
while its ratio lies within the quartiles, widened by FENCE times their distance (or by a least distance, so that a ratio
that is the same everywhere rejects nothing near it). A group with fewer than MIN_GROUP texts takes the sketch of its
language, merged from its sources' sketches, and a small language takes the sketch of everything, merged likewise.

A sketch counts values in buckets whose bounds grow by a factor, so each quantile is off by ACCURACY of its value at most;
sketches are merged by adding counts, so the result doesn't depend on how rows are split or in which order parts meet.

A null text has no words and fails the base rules; null languages and sources are groups of their own. Rows may be repeated
(each counts); an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import column, durable, map_text

MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
FENCE, MIN_GROUP = 4.0, 50
#: The largest error of a quantile, as a share of its value, and the value under which all count as 0.
ACCURACY, LEAST_VALUE = 0.005, 1e-6
#: Ratio and the least distance of quartiles that is taken.
RATIOS = {"symbol_ratio": 0.01, "mean_word_chars": 0.8, "dup_line_ratio": 0.1, "capital_ratio": 0.05}
#: Rows of the threshold table up to which it is broadcast; beyond, it is joined by the group with a salt.
BROADCAST_GROUPS = 20_000
SALTS = 32
FEATURES = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("n_lines", "long"), ("n_capitals", "long")]
_SPACES = bytes(c for c in range(256) if c == 0x20 or 0x09 <= c <= 0x0D)
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of `window` words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    if len(number) + window - 1 >= len(words) and len(number) == len(words):
        return 0
    # A window can be there twice only if each of its words is.
    count = [0] * len(number)
    for i in ids:
        count[i] += 1
    several, run, starts = [count[i] > 1 for i in ids], 0, []
    for k, s in enumerate(several):
        run = run + 1 if s else 0
        if run >= window:
            starts.append(k - window + 1)
    if len(starts) < 2:
        return 0
    seen: dict[tuple, int] = {}
    twice: set[int] = set()
    for k in starts:
        first = seen.setdefault(tuple(ids[k : k + window]), k)
        if first != k:
            twice.add(first)
            twice.add(k)
    covered, end = 0, 0
    for k in sorted(twice):
        covered += k + window - max(k, end)
        end = k + window
    return covered


def features(text: str | None) -> tuple[int, ...]:
    """The numbers named in FEATURES."""
    if not text:
        return (0,) * len(FEATURES)
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    return (
        len(words),
        len(text) - spaces,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, _CAPITALS)),
    )


def measure(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep and the columns of FEATURES for each whole text."""

    def kernel(texts):
        rows = [features(t) for t in texts]
        return [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(FEATURES))]

    return map_text(df, keep, text_col, FEATURES, kernel)


def _ratios(df: DataFrame) -> DataFrame:
    over = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1))
    return df.withColumns({"symbol_ratio": over("n_symbols", "word_chars"), "mean_word_chars": over("word_chars", "n_words"), "dup_line_ratio": over("n_dup_lines", "n_lines"), "capital_ratio": over("n_capitals", "word_chars")})


def _bucket(value: Column, accuracy: float = ACCURACY) -> Column:
    """The number of the sketch's bucket for a value that isn't negative; null stands for 0."""
    return F.when(value >= LEAST_VALUE, F.ceil(F.log(value) / math.log((1 + accuracy) / (1 - accuracy))).cast("int"))


def _value(bucket: Column, accuracy: float = ACCURACY) -> Column:
    """The value that stands for a bucket: at most `accuracy` of it away from all values that fall there."""
    growth = (1 + accuracy) / (1 - accuracy)
    return F.when(bucket.isNull(), 0.0).otherwise(2 * F.pow(F.lit(growth), bucket) / (growth + 1))


def sketches(df: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """The quantile sketches of the columns `values` for each group: group, value_name, bucket and n, the number of rows."""
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("value_name"), _bucket(F.col(v)).alias("bucket")) for v in values])).alias("e")
    return df.select(*group, each).groupBy(*group, "e.value_name", "e.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, group: list[str]) -> DataFrame:
    """The sketches of wider groups: counts of the same bucket are added."""
    return sketch.groupBy(*group, "value_name", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, group: list[str], shares: dict[str, float]) -> DataFrame:
    """group, value_name, n (rows) and for each share, by name, the value that this share of the group's rows doesn't exceed."""
    w = Window.partitionBy(*group, "value_name")
    upto = sketch.withColumn("upto", F.sum("n").over(w.orderBy(F.asc_nulls_first("bucket")))).withColumn("total", F.sum("n").over(w))
    # The first bucket at which the count reaches the share; values grow with buckets, so the least one that does.
    found = [F.min(F.when(F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.col("total") * share)), _value(F.col("bucket")))).alias(name) for name, share in shares.items()]
    return upto.groupBy(*group, "value_name").agg(F.max("total").alias("n"), *found)


def thresholds(measured: DataFrame, group: list[str], min_group: int = MIN_GROUP, fence: float = FENCE) -> DataFrame:
    """For each group of measured texts: lo_ and hi_ of each ratio. group: from the widest column to the narrowest."""
    ratios = _ratios(measured.where(F.col("n_words") > 0)).withColumn("everything_", F.lit(0))
    group = ["everything_", *group]
    base = durable(sketches(ratios, group, list(RATIOS)), measured.count())
    quartiles = lambda sketch, keys: quantiles(sketch, keys, {"q1": 0.25, "q3": 0.75})
    out = quartiles(base, group)
    for k in range(len(group) - 1, 0, -1):  # a small group takes what its wider group has
        keys = [*group[:k], "value_name"]
        wide = quartiles(merged(base, group[:k]), group[:k]).withColumnsRenamed({c: f"w_{c}" for c in [*keys, "n", "q1", "q3"]})
        small = F.col("n") < min_group
        out = out.join(wide, [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in keys], "left")
        out = out.select(*group, "value_name", *[F.when(small, F.col(f"w_{c}")).otherwise(F.col(c)).alias(c) for c in ("n", "q1", "q3")])
    least = F.create_map(*itertools.chain.from_iterable((F.lit(r), F.lit(d)) for r, d in RATIOS.items()))[F.col("value_name")]
    wide = F.lit(fence) * F.greatest(F.col("q3") - F.col("q1"), least)
    out = out.select(*group[1:], "value_name", (F.col("q1") - wide).alias("lo"), (F.col("q3") + wide).alias("hi"))
    return out.groupBy(*group[1:]).agg(*[F.max(F.when(F.col("value_name") == r, F.col(c))).alias(f"{c}_{r}") for r in RATIOS for c in ("lo", "hi")])


def judge(measured: DataFrame, limits: DataFrame, group: list[str], broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """measured with base_failed and kept: the base rules, then each ratio against its group's limits."""
    limits = durable(limits.withColumnsRenamed({c: f"g_{c}" for c in group}), broadcast_groups)
    on = [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in group]
    if limits.limit(broadcast_groups + 1).count() <= broadcast_groups:
        joined = _ratios(measured).join(F.broadcast(limits), on, "left")
    else:
        salted = limits.withColumn("g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("n_words", "word_chars", "n_symbols", "n_lines"), F.lit(SALTS))
        joined = _ratios(measured).withColumn("salt", salt).join(salted, [*on, F.col("salt") == F.col("g_salt")], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    within = F.lit(True)
    for r in RATIOS:
        within = within & F.col(r).between(F.col(f"lo_{r}"), F.col(f"hi_{r}"))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(within, F.lit(True))).select(*measured.columns, *RATIOS, "base_failed", "kept")


def filter_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """For each row its id, group, numbers, base_failed and kept. Texts are read once; the numbers are kept in the shared folder."""
    slim = df.select(column(id_col).alias("doc_id"), column(lang_col).cast("string").alias("g_lang_"), column(source_col).cast("string").alias("g_source_"), column(text_col).alias("text"))
    measured = durable(measure(slim, ["doc_id", "g_lang_", "g_source_"]))
    group = ["g_lang_", "g_source_"]
    return judge(measured, thresholds(measured, group), group).withColumnsRenamed({"g_lang_": "lang", "g_source_": "source"})
