"""MinHash near-dedup: many universal hash minima, banding, signature verification, components by alternating stars.

A text's set is its distinct shingles of `size` words (ASCII white space between them, A-Z lowered). Texts are linked if
their sets' similarity is at least `percent` / 100. Texts with equal sets become one node first, so that a group of copies,
however large, costs one node. Nodes with equal minima in a band meet in a bucket:

1. every node of a bucket is compared with one hub, the node of the bucket that meets most others in all its buckets (in
   a group of near copies, the text they were made from), not with each other; links give components;
2. a hub leaves its bucket, as do buckets whose nodes are in one component by then. For the nodes of the others, pairs of
   different components are found by prefix filtering of their sets (see _prefix_pairs), which loses none and makes no
   pairs of texts that only share what many share. Nodes that are already connected are not compared, so links that are
   left out join nothing new.

A comparison looks at the signatures first (a pair that is far below the threshold ends there: five standard errors),
then at the full sets. With BANDS x ROWS minima a pair at similarity 0.85 shares no bucket with probability 3e-7.

Null, empty and blank texts have no shingles and link with nothing; a text of fewer words than a shingle has one. Rows may
be repeated and ids null (they sort last); an empty table gives an empty one. df's columns may have any names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import column, durable, free_name, map_text, numbered, worker_cache
from .components import connected_components

BANDS, ROWS = 32, 6
SEED = 20240229
#: The column of the rows' numbers beside df's own columns, which get it with more underscores if a name starts so.
UID = "near_uid_"
#: Ids up to which the nodes to compare are broadcast to the scan that fetches their sets; beyond, they are joined.
BROADCAST_IDS = 1_000_000
#: Distinct words of which a worker keeps the hash.
CACHE_WORDS = 400_000

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    known = worker_cache("minhash")
    try:
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


def hash_family(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of `count` functions of the multiply-shift family."""
    r = np.random.default_rng(seed)
    return r.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, count, np.uint64)


def minima(shingles: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """For each function the smallest value over the set, as its upper 32 bits."""
    best = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        best = np.minimum(best, (mul[:, None] * shingles[None, start : start + 1024] + add[:, None]).min(axis=1))
    return (best >> np.uint64(32)).astype(np.uint32)


def _arrays(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.ravel(), kind))


def signatures(df: DataFrame, keep: list[str], text_col: str = "text", size: int = 3, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """keep, n_shingles, the set's 128-bit digest (d1, d2), its buckets (one for each band) and 16 bits of each minimum."""
    mul, add = hash_family(bands * rows)

    def kernel(texts):
        n, digest, bucket, sig = [], np.zeros((len(texts), 2), np.int64), np.zeros((len(texts), bands), np.int64), np.zeros((len(texts), bands * rows), np.int16)
        for i, t in enumerate(texts):
            s = shingle_set(t, size)
            n.append(len(s))
            if len(s):
                digest[i] = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                m = minima(s, mul, add)
                sig[i] = m.astype(np.uint16).view(np.int16)
                wide, h = m.reshape(bands, rows).astype(np.uint64), np.zeros(bands, np.uint64)
                for k in range(rows):
                    h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + wide[:, k] + np.uint64(1))
                bucket[i] = h.view(np.int64)
        return [pa.array(n, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), _arrays(bucket, pa.int64()), _arrays(sig, pa.int16())]

    return map_text(df, keep, text_col, [("n_shingles", "long"), ("d1", "long"), ("d2", "long"), ("buckets", "array<long>"), ("sig", "array<smallint>")], kernel)


def _shingle_sets(df: DataFrame, keep: list[str], text_col: str, size: int) -> DataFrame:
    def kernel(texts):
        sets = [shingle_set(t, size).view(np.int64) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))]

    return map_text(df, keep, text_col, [("shingles", "array<long>")], kernel)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 85, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """For each row: doc_id, n_shingles, component_id (the smallest id it is linked with, over any number of links), kept
    (whether that is its own id), first_of_group (true for one row of each group, also where ids are repeated or null) and uid.

    uid is the row's number, the same in all jobs (see numbered).
    """
    return _near_duplicates(numbered(df, free_name(df, UID)), id_col, text_col, size, percent, bands, rows)


def _near_duplicates(df: DataFrame, id_col: str, text_col: str, size: int = 3, percent: int = 85, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    source = df.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"), F.col(df.columns[-1]).alias("uid"))
    docs = durable(signatures(source, ["uid", "doc_id"], "text", size, bands, rows))
    rows_n = docs.count()
    with_set = docs.where("n_shingles > 0")
    # One node for each set; a set's rows meet as one partial row for each task. min over the struct keeps id and row together.
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).alias("best")
    nodes = durable(with_set.groupBy("d1", "d2").agg(best).select("d1", "d2", F.col("best.doc_id").alias("first_id"), F.col("best.uid").alias("node")), rows_n)
    rep = durable(nodes.select("node").join(with_set.select("uid", "n_shingles", "buckets", "sig"), F.col("node") == F.col("uid")).drop("uid"))
    member = rep.select("node", F.posexplode("buckets").alias("band", "bucket"))
    count = member.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1").select(F.col("band").alias("n_band"), F.col("bucket").alias("n_bucket"), "n")
    shared = durable(member.join(count, (F.col("band") == F.col("n_band")) & (F.col("bucket") == F.col("n_bucket"))).select("node", "band", "bucket", "n"))
    meets = shared.groupBy(F.col("node").alias("m_node")).agg(F.sum("n").alias("meets"))
    left = shared.join(meets, F.col("node") == F.col("m_node")).select("node", "band", "bucket", "meets")
    # Step 1: each node with its bucket's hub, which is then done with the bucket.
    hub = left.groupBy("band", "bucket").agg(F.max_by("node", F.struct("meets", -F.col("node"))).alias("hub")).select(F.col("band").alias("h_band"), F.col("bucket").alias("h_bucket"), "hub")
    left = durable(left.join(hub, (F.col("band") == F.col("h_band")) & (F.col("bucket") == F.col("h_bucket"))).where("node <> hub").select("node", "band", "bucket", "hub"))
    stars = left.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = durable(_confirmed(stars, rep, _sets_of(source, size, rows_n), percent, bands * rows))
    comp = connected_components(links, rows=rows_n * bands)
    # Step 2: what is left in buckets of several components.
    left = durable(_several(left.join(comp.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left")), rows_n)
    if not left.isEmpty():
        sets = durable(_sets_of(source, size, rows_n)(left.select("node")))
        new = durable(_confirmed(_prefix_pairs(left, sets, percent, rows_n), rep, lambda _: sets, percent, bands * rows))
        if not new.isEmpty():
            comp = connected_components(links.unionByName(new), rows=rows_n * bands)
    label = lambda col: F.coalesce(col, F.col("node"))
    where = durable(nodes.join(comp.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left").select("d1", "d2", "first_id", "node", label(F.col("component")).alias("component")), rows_n)
    # Kept, so that the join back has an exchange of its own on either side, which may be split for a large component.
    least = where.groupBy("component").agg(F.min(F.struct(F.col("first_id").isNull().alias("last"), F.col("first_id").alias("id"), "node")).alias("best"), F.count("*").alias("n")).where("n > 1").select(F.col("component").alias("g"), "best")
    least = durable(least, rows_n)
    sets = durable(where.join(least, F.col("component") == F.col("g"), "left").select("d1", "d2", F.coalesce("best.id", "first_id").alias("component_id"), F.coalesce("best.node", "node").alias("keeper")))
    out = docs.select("uid", "doc_id", "n_shingles", "d1", "d2").join(sets.withColumnsRenamed({"d1": "s1", "d2": "s2"}), (F.col("n_shingles") > 0) & (F.col("d1") == F.col("s1")) & (F.col("d2") == F.col("s2")), "left")
    none = F.col("keeper").isNull()
    group = F.when(none, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", group.alias("component_id"), F.col("doc_id").eqNullSafe(group).alias("kept"), (none | (F.col("keeper") == F.col("uid"))).alias("first_of_group"), "uid")


def _several(rows: DataFrame) -> DataFrame:
    """The nodes of buckets that hold more than one component, with their component."""
    rows = rows.select("node", "band", "bucket", F.coalesce("component", F.col("node")).alias("component"))
    open_ = rows.groupBy("band", "bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select(F.col("band").alias("o_band"), F.col("bucket").alias("o_bucket"))
    return rows.join(open_, (F.col("band") == F.col("o_band")) & (F.col("bucket") == F.col("o_bucket"))).select("node", "component").distinct()


def _prefix_pairs(left: DataFrame, sets: DataFrame, percent: int, rows_n: int) -> DataFrame:
    """The pairs (a, b) of nodes (node, component) of different components that can be similar enough.

    With the shingles of all sets in one order, the rarest first, two sets that are so similar share one of their first
    n - ceil(n x percent / 100) + 1. What many sets have in common comes last in that order, so a passage that many texts
    share makes no pairs among texts that differ elsewhere.
    """
    each = sets.select("uid", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    # Kept, so that the join has an exchange of its own on either side, which may be split for a hot shingle.
    df = durable(each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"))
    order = Window.partitionBy("uid").orderBy("df", "shingle")
    head = each.join(df, "shingle", "left").fillna({"df": 1}).withColumn("at", F.row_number().over(order)).where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).where("df > 1")
    head = durable(head.select("uid", "n", "shingle", "at").join(left, F.col("uid") == F.col("node")).select("node", "component", "n", "shingle", "at"))
    several = durable(head.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("shingle"), rows_n)
    head = durable(head.join(several, "shingle", "left_semi"))
    x, y = (head.select("shingle", *[F.col(c).alias(f"{p}_{c}") for c in ("node", "component", "n", "at")]) for p in "xy")
    # Of two sets the smaller one needs an even shorter part: what both must share is a share of both sizes. And what
    # stands after the first shared shingle must suffice.
    x = x.where(F.col("x_at") <= F.col("x_n") - F.ceil(F.col("x_n") * 2 * percent / (100 + percent)) + 1)
    smaller = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_node") < F.col("y_node")))
    enough = (100 + percent) * (1 + F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))) >= percent * (F.col("x_n") + F.col("y_n"))
    fits = smaller & (100 * F.col("x_n") >= percent * F.col("y_n")) & enough
    pairs = x.join(y, (x["shingle"] == y["shingle"]) & (F.col("x_component") != F.col("y_component")) & fits)
    return pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def _sets_of(source: DataFrame, size: int, rows_n: int) -> Callable[[DataFrame], DataFrame]:
    """For nodes (node): uid and shingles, from the texts."""

    def fetch(ids: DataFrame) -> DataFrame:
        ids = durable(ids.distinct(), rows_n)
        # Broadcast if so few; else both sides are dealt by the id.
        wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        return _shingle_sets(source.join(wanted, F.col("uid") == F.col("node"), "left_semi"), ["uid"], "text", size)

    return fetch


def _confirmed(pairs: DataFrame, rep: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int, count: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough; those with signatures far apart are left out first."""
    least = percent / 100 - 5 * math.sqrt(percent / 100 * (1 - percent / 100) / count)
    side = lambda p: rep.select(F.col("node").alias(p), F.col("n_shingles").alias(f"n_{p}"), F.col("sig").alias(f"sig_{p}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    equal = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda e: e))
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    near = durable(near.where(fits & (equal >= math.floor(least * count))).select("a", "b", "n_a", "n_b"))
    sets = fetch(near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))))
    full = near.join(sets.select(F.col("uid").alias("a"), F.col("shingles").alias("set_a")), "a").join(sets.select(F.col("uid").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return full.withColumn("both", both).where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """df with one row of each group of near-duplicates, with df's columns."""
    uid = free_name(df, UID)
    texts = numbered(df, uid)
    out = _near_duplicates(texts, id_col, text_col, **parameters)
    dropped = out.where("not first_of_group").select(F.col("uid").alias(f"{uid}dropped"))
    return texts.join(dropped, F.col(uid) == F.col(f"{uid}dropped"), "left_anti").select(*[column(c) for c in df.columns])
