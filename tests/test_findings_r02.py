"""Cases that queries got wrong or couldn't finish, on small tables."""

from __future__ import annotations

import hashlib
import random
from difflib import SequenceMatcher

import pytest

from lexweft.operators import catalog, collate, match
from lexweft.plans import registry


def run(spark, tmp_path, name, **tables):
    """The rows of a query over tables (rows and schema)."""
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{t}.parquet")
    return registry.QUERIES[name](spark, str(tmp_path))


def test_cutoff_counts_only_what_is_said(spark, tmp_path):
    """The format's mark is no part of the text: neither the 900 characters nor the text itself have it."""
    short, full = "A" + "x" * 898, "I" + "x" * 899
    rows = [(1, 0, "user", short), (1, 1, "user", "tail"), (2, 0, "user", full), (2, 1, "user", "tail"), (3, 0, "user", "A vitamin bC and aA"), (3, 1, "user", None), (4, 0, "system", "A"), (4, 1, "user", "x")]
    out = run(spark, tmp_path, "u4_cutoff", conversations=(rows, "conv_id long, turn long, role string, text string"))
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert {tuple(r) for r in out.collect()} == {(1, 1, "aA", 2, digest(f"{short} tail")), (2, 1, "bI", 1, digest(full)), (3, 1, "aA", 2, digest("A vitamin bC and aA"))}


def test_names_broadcast_no_dictionary(spark, tmp_path):
    """However small the files look, no side that grows with the dictionary or the chains is broadcast."""
    part = [(i, f"red ring{i % 7}", f"Brand#{i % 3}", 1 + i % 50) for i in range(40)]
    lines = [(i // 4, i % 40, i % 5, 1 + i % 4, "ANR"[i % 3]) for i in range(200)]
    tables = {"part": (part, "p_partkey long, p_name string, p_brand string, p_size int"), "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string")}
    for name in ("g4_name_cascade", "g5_neighbour_support"):
        out = run(spark, tmp_path, name, **tables)
        assert out.count() > 0
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString(), name


def test_story_lookup_never_deals_out_its_result(spark, tmp_path):
    """Repeated rows of any table make no row twice, and the result isn't shuffled to find that."""
    orders = [(k, "FO"[k % 5 == 0]) for k in range(0, 3000, 7)] * 2
    part = [(i,) for i in range(40)] * 2
    supplier = [(i, f"S{i}") for i in range(3)] * 2
    lines = [(i, i % 13, 7) for i in range(200)] + [(None, 1, 7), (3, 5, 6)]
    customer = [(i, i * 1.5) for i in range(10)] + [(3, 99.999)]
    out = run(
        spark, tmp_path, "l6_story_lookup", orders=(orders, "o_orderkey long, o_orderstatus string"), part=(part, "p_partkey long"), supplier=(supplier, "s_suppkey long, s_name string"),
        lineitem=(lines, "l_orderkey long, l_partkey long, l_linenumber int"), customer=(customer, "c_custkey long, c_acctbal double"),
    )
    reading = {k: round(max(b for c, b in customer if c == k), 2) for k, _ in customer}
    want = {
        (o, o // 75, s, f"S{s}", r, reading.get(r)) for o, st in orders if st == "F" and o // 75 < 40 for s in range(3) if 20 * s <= o // 75 <= 20 * s + 25
        for k, r, n in lines if n == 7 and k is not None and k % 40 == s % 40
    }
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_hot_join_meets_each_pair_once(spark):
    left, right = spark.range(50).selectExpr("id % 2 as k", "id as a"), spark.range(60).selectExpr("id % 3 as k", "id as b")
    got = sorted((r["k"], r["a"], r["b"]) for r in catalog.hot_join(left, right, "k", per_task=30).collect())
    assert got == sorted((a % 2, a, b) for a in range(50) for b in range(60) if a % 2 == b % 3)


def test_candidate_terms_look_up_each_word_once(spark, tmp_path):
    """Words within words, of one letter too few, with digits, repeated passages and texts, null; no pair of a text and a passage is made to test it."""
    benchmark = [(1, "abc def ghi"), (2, "abc xyz1"), (3, ""), (1, "abc def ghi"), (4, "uno Dós"), (5, None)]
    documents = [(1, "xabcx. DEFdef"), (2, "abc"), (3, None), (4, "dos"), (5, "ab cdef gh"), (6, "a" * 500 + "unodos"), (2, "abc")]
    out = run(spark, tmp_path, "p10_candidate_terms", benchmark=(benchmark, "item_id long, text string"), documents=(documents, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == [(1, 1), (1, 1), (2, 1), (2, 2), (2, 2), (4, 4), (4, 6)]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    q, d = spark.createDataFrame([(i, ["abc", f"x{i}"]) for i in range(9)], "q long, w array<string>"), spark.createDataFrame([(1, "abc")], "d long, t string")
    assert sorted(r["q"] for r in match.half_contained(d, q, most=4).collect()) == list(range(9))


@pytest.mark.parametrize("percent", [60, 80])
def test_text_pairs_lose_no_link(spark, monkeypatch, percent):
    monkeypatch.setattr(match, "FREQUENT", 3)
    r = random.Random(percent)
    base = [[f"w{r.randrange(30)}" for _ in range(r.randrange(1, 60))] for _ in range(8)]
    texts = {i: " ".join(f"x{r.randrange(9)}" if r.random() < 0.04 else w for w in base[i % 8]) for i in range(120)} | {500: "", 501: None}
    sets = {i: frozenset(zip(*((t or "").split()[k:] for k in range(3)), strict=False)) for i, t in texts.items()}
    first = {s: min(i for i in sets if sets[i] == s) for s in sets.values() if s}
    want = {(a, b) for x, a in first.items() for y, b in first.items() if a < b and 100 * len(x & y) >= percent * len(x | y)}
    got = {(p["a"], p["b"]) for p in match.text_pairs(spark.createDataFrame(list(texts.items()), "key long, w string"), 3, percent).collect()}
    assert want and want <= got and {i for p in got for i in p} <= set(first.values())


def test_readings_move_less_than_the_texts_grams(spark, tmp_path):
    r = random.Random(8)
    docs = [(i, " ".join(f"word{r.randrange(5000)}" for _ in range(200))) for i in range(2000)]
    docs += [(2000 + i, f"{t} word{i}") for i, t in docs[:20]]
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext._jsc.sc().statusStore()
    written = lambda: bus.waitUntilEmpty() or store.executorList(False).apply(0).totalShuffleWrite()
    before = written()
    assert run(spark, tmp_path, "w9_readings", documents=(docs, "doc_id long, text string"), benchmark=([(1, "word1 word2")], "item_id long, text string")).collect() == []
    assert written() - before < 2 * sum(len(t) for _, t in docs)


def test_blocks_in_arrays_are_those_of_the_sequence_matcher(monkeypatch):
    monkeypatch.setattr(collate, "ARRAYS", (0, 10**9))
    r = random.Random(4)
    for k in range(300):
        x = [str(r.randrange(2 + k % 30)) for _ in range(r.randrange(90))]
        y = [w for w in x if r.random() < 0.9] if k % 2 else [str(r.randrange(2 + k % 30)) for _ in range(r.randrange(90))]
        assert collate.opcodes(x, y) == SequenceMatcher(None, x, y, autojunk=False).get_opcodes()
