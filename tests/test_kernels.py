"""State-machine kernels, the acceptance runner, and what every registered query must have."""

from __future__ import annotations

import pytest

from lexweft.functions import kernels as K
from lexweft.operators import acceptance as A


def test_name_kernels():
    assert K.strip_gloss("Ali with-a-dot note bin Omar", "with", frozenset({"bin"})) == "Ali bin Omar"
    assert K.last_name("told from Omar, from", frozenset({"from"})) == "Omar, from" and K.last_name("none", frozenset({"from"})) is None and K.last_name(None, frozenset()) is None
    assert K.name_before(["said", "Abu", "Bakr", "weak"], 3, {"Abu", "Bakr"}) == "Abu Bakr"
    assert K.chain_names("x from a b / from c from d e, said", frozenset({"from", "said"}), frozenset({"c"}), "/") == ["d e"]


def test_dictionary_entry():
    e = K.dictionary_entry("12 Omar bin Ali weak but honest died AB", [(3, "honest"), (8, "weak")], " from ", "ABC", {})
    assert e == {"no": 12, "name": "Omar bin Ali", "grade": "weak", "rank": 8, "codes": "AB"}
    assert K.dictionary_entry("no number", [], "x", "A", {})["no"] is None


def hits(*rows):
    return [{"g": v // 100, "n": v, "passage": v, "head": a, "hits": b} for v, a, b in rows]


def test_placement_follows_what_was_taken():
    rows = [(1, hits((10, 3, 3)), None), (2, hits((90, 2, 2)), None), (3, [], None), (4, hits((200, 4, 4), (11, 2, 2)), None), (5, hits((7, 2, 2), (6, 2, 2)), {"g": 3, "n": 300, "passage": 300}), (6, hits((301, 2, 2), (302, 2, 2)), None), (7, hits((310, 1, 5)), None)]
    got = K.place(rows)
    assert (1, 10, "lemma", 3) in got and (2, 10, "continues", 0) in got and (2, 90, "cited", 2) in got and (3, 10, "continues", 0) in got
    assert (4, 200, "lemma", 4) in got and (4, 11, "cited", 2) in got and (5, 300, "heading", 0) in got and (6, 301, "lemma", 2) in got
    assert (7, 301, "continues", 0) in got and (7, 310, "cited", 5) in got  # a passage quoted deep in a record doesn't move the work
    assert K.place([(1, [], None)]) == [] and K.place([(1, hits((110, 2, 2)), None), (2, hits((90, 2, 2)), None)])[1] == (2, 110, "continues", 0)  # near, but of another group


TABLE = """
| id | level | check | input | expect |
|---|---|---|---|---|
| A1 | must | count | x | n >= 2, share > 50% |
| A2 | goal | count | y | n = 9 |
| A3 | must | broken | | n > 0 |
"""


def test_acceptance():
    cases = A.parse_table(TABLE)
    assert [c.id for c in cases] == ["A1", "A2", "A3"]
    out = A.run(cases, {"count": lambda c: {"n": 2, "share": 0.6}, "broken": lambda c: {"n": 1 / 0}})
    assert [r["passed"] for r in out] == [True, False, False] and "ZeroDivisionError" in out[2]["why"] and not A.verdict(out)
    assert A.verdict(out[:2])
    with pytest.raises(ValueError, match="twice"):
        A.parse_table(TABLE + "| A1 | must | count | x | n > 1 |\n")
    with pytest.raises(ValueError, match="level"):
        A.parse_table(TABLE.replace("goal", "maybe"))
    with pytest.raises(ValueError, match="condition"):
        A.parse_conditions("n about 3")
    with pytest.raises(ValueError, match="unknown checks: count"):
        A.run(cases, {"broken": lambda c: {}})
    facts = A.run([A.Case("F", "must", "x", expect="in:buKH, flag, n<3s"), A.Case("G", "must", "x", expect="in:none"), A.Case("H", "must", "x", expect="other")], {"x": lambda c: {"in": ["al-Bukhari"], "flag": 1, "n": 2}})
    assert [r["passed"] for r in facts] == [True, False, False]


def test_all_twelve_kinds_of_check(spark):
    from pyspark.sql import functions as F

    rows = lambda data, schema: spark.createDataFrame(data, schema)
    said = {"lamp": [(1, "B", "x", "classical", "sound"), (1, "B", "y", "modern", "weak")], "LAMP": [(1, "B", "x", "classical", "sound")], "none": []}
    calls = []

    def authenticate(texts):
        calls.append(texts)
        return rows([(i, *r) for i, t in enumerate(texts) for r in said[t]], "q int, uid int, collection string, critic string, layer string, grade string")

    found = rows([("f1", "w", 1), ("f1", "v", 2), ("f2", "u", 3)], "folder string, work string, uid int")
    lib = A.Library(
        authenticate, lambda p, fs: found.where(F.col("folder").isin(*fs)) if fs else found, lambda k: rows([("w", 100, 1), ("v", None, 2), ("u", 200, 3)], "work string, death int, uid int"), lambda k: rows([("w", 300, 1), ("u", 200, 3)], "work string, death int, uid int"),
        lambda i, p: rows([("on", "1:2")] if i == "known" else [], "kind string, loc string"), lambda k: rows([("h", "s", "p", None)], "heading string, story string, passage string, reading string"),
        rows([("Ali",), ("Ali",), ("Umar",)], "caliph string"), rows([("question",), ("reading",)], "type string"), rows([], "check string, key string"), {"share": lambda: 0.25},
    )
    expect = [
        ("authenticate", "lamp", "", "hits=1, in:b, critic:x, grade:x:sound, modern_apart, cites", True), ("authenticate", "lamp", "", "grade:y", False), ("authenticate", "none", "", "not_in_layer", True), ("same", "lamp // LAMP", "", "same", True), ("same", "lamp // none", "", "same", False),
        ("search", "p", "all", "records=3, works=3", True), ("search", "p", "f1,f2", "each_folder", True), ("search", "p", "f1,f9", "each_folder", False), ("verse", "2:3", "", "passages=3, oldest_first", True), ("concept", "c", "", "oldest_first", False), ("caliph", "Ali", "", "hadith=2", True),
        ("cite", "known", "x", "resolved, loc:1:2", True), ("cite", "unknown", "", "", False), ("story", "5", "", "heading, story, passages=1, readings=0", True), ("sijill", "validator", "", "problems=0", True), ("sijill", "type:question", "", "entries=1", True),
        ("metric", "share", "", "value=25%", True), ("metric", "nothing", "", "", False), ("time", "authenticate_all", "", "seconds<60s", True), ("crash", "??", "f1", "ran", True), ("crash", "lamp", "authenticate", "ran", True),
    ]
    cases = [A.Case(str(i), "must", kind, given, where, want) for i, (kind, given, where, want, _) in enumerate(expect)]
    out = A.run(cases, A.checks(lib, cases))
    assert [r["passed"] for r in out] == [e[4] for e in expect], [r for r, e in zip(out, expect, strict=True) if r["passed"] != e[4]]
    assert calls == [["lamp", "none", "LAMP"]]  # one scan for all texts


def test_registry():
    import __spark_entry__ as e

    names = set(e.queries())
    assert set(e.oracle_sql()) <= names and "m1_loose_score" in names and len(names) > 120
