"""Exact dedup by deterministic block naming, with DataFrame functions only.

A text (each run of ASCII white space as one space) is cut into blocks of BLOCK characters. The blocks that stand in more
than one place are dealt by their content and sorted, and a block's integer name is its place in that order: equal blocks
have one name, different ones never share one, and names follow from the blocks, not from how files are split. A block that
stands in one place only needs none, as no other text can equal its text. Then adjacent names are paired and the pairs named
in the same way, again and again, until each text that is left has one name. Two texts are equal if and only if their last
names, and the rounds that these took, are equal: no hash is trusted.

Hot blocks: a block's copies meet only as one partial count for each task; they get their name by a join whose other side
has one row for each repeated block, a join that adaptive execution may split anywhere. Rows are numbered by their place
in the files and rounds are kept in the shared folder, so that all jobs see the same, also if executors come or go.

Null texts count as empty, empty ones are equal to each other, null ids sort last, and of rows with the same id and text
one is kept. An empty table gives an empty one. df's columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import ROWS_PER_FILE, column, durable, fewer, free_name, numbered

BLOCK = 4096
#: Repeated blocks of which one file is made (20 MB).
BLOCKS_PER_FILE = 5_000
#: The column of the rows' numbers beside df's own columns, which get it with more underscores if a name starts so.
UID = "dedup_uid_"
WHITE = r"[\x20\x09-\x0D]+"


def normalised(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), WHITE, " ")


def _named(parts: DataFrame, key: list[str], rows: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """The rows of parts (uid, pos, total, key...) whose key is there more than once, with an integer `name` for each
    distinct key: its place among these keys in sorted order. rows: about how many keys there are at most."""
    several = parts.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*[F.col(c).alias(f"r_{c}") for c in key])
    # Sorted where the counts met (a sort of all would sample blocks to the driver), written, and numbered by the place in the
    # files. So the join also has an exchange of its own on either side, which adaptive execution may split for a hot key.
    names = numbered(fewer(several, rows, rows_per_file).sortWithinPartitions(*several.columns), "name")
    on = [F.col(c) == F.col(f"r_{c}") for c in key]
    return parts.join(names, on).select("uid", "pos", "total", "name")


def identities(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, names, texts): for each row its number `uid`, id and text_sha256; for each row that may have copies uid and its
    text's identity (level, name); and df's rows with that number as a last column.

    The identity is one for all equal texts and for no others; a text without one has no copies.
    """
    uid = free_name(df, UID)
    texts = numbered(df, uid)
    text = normalised(column(text_col))
    cut = texts.select(F.col(uid).alias("uid"), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0)).alias("blocks"))
    first = cut.select("uid", F.greatest(F.size("blocks"), F.lit(1)).alias("total"), F.posexplode_outer("blocks").alias("pos", "block"))
    first = first.select("uid", "total", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("block", F.lit("")).alias("block"))
    n = texts.count()
    now = durable(_named(first, ["block"], n, BLOCKS_PER_FILE), n)
    level, done = 0, []
    while True:
        done.append(now.where("total = 1").select("uid", F.lit(level).alias("level"), "name"))
        rest = now.where("total > 1")
        if rest.isEmpty():
            break
        # A pair that lacks a member belongs to a text with a block of its own, and goes with it; -1 stands after an odd last one.
        half = rest.groupBy("uid", F.floor(F.col("pos") / 2).cast("int").alias("half"), "total")
        pairs = half.agg(F.count("*").alias("n"), F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = pairs.where(F.col("n") == F.least(F.lit(2), F.col("total") - 2 * F.col("half")))
        level += 1
        now = durable(_named(pairs.select("uid", F.col("half").alias("pos"), F.ceil(F.col("total") / 2).cast("int").alias("total"), "a", "b"), ["a", "b"], n), n)
    names = done[0]
    for d in done[1:]:
        names = names.unionByName(d)
    rows = texts.select(F.col(uid).alias("uid"), column(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))
    return rows, names, texts


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(groups, texts): doc_id, keep_id, group_size, kept, text_sha256 and uid for each row; and df's rows with that number as a last column."""
    rows, names, texts = identities(df, id_col, text_col, block)
    n = rows.count()
    named = durable(rows.select("uid", "doc_id").join(names, "uid"), n)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).alias("best")
    groups = durable(named.groupBy("level", "name").agg(best, F.count("*").alias("n")).where("n > 1").select(F.col("level").alias("g_level"), F.col("name").alias("g_name"), "best", "n"), n)
    group = durable(named.join(groups, (F.col("level") == F.col("g_level")) & (F.col("name") == F.col("g_name"))).select(F.col("uid").alias("g_uid"), "best", "n"), n)
    out = rows.join(group, F.col("uid") == F.col("g_uid"), "left")
    single = F.col("n").isNull()
    out = out.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (single | (F.col("uid") == F.col("best.uid"))).alias("kept"), "text_sha256", "uid")
    return out, texts


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the later copies, with df's columns."""
    groups, texts = dedup(df, id_col, text_col)
    uid = texts.columns[-1]
    dropped = groups.where("not kept").select(F.col("uid").alias(f"{uid}dropped"))
    return texts.join(dropped, F.col(uid) == F.col(f"{uid}dropped"), "left_anti").select(*[column(c) for c in df.columns])
