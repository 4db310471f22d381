"""Operators on small hand-made frames, and what must not change a result."""

from __future__ import annotations

import collections
import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from lexweft.functions import kernels as K, text as T
from lexweft.functions.profiles import ARABIC
from lexweft.operators import catalog, cite, collate, graph, ledger, match, names, passages, search, segment, verdicts
from lexweft.sources import readers, sinks
from lexweft.streaming import ingest


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_phrase_near_and_boolean(spark):
    p = search.postings(docs(spark, "a b c a b", "b a x c", "", "a a b b c"))
    assert {(r["uid"], r["hits"]) for r in search.match_phrase(p, ["a", "b"]).collect()} == {(0, 2), (3, 1)}
    assert {r["uid"] for r in search.match_phrase(p, ["a", "a"]).collect()} == {3}
    assert {r["uid"] for r in search.match_near(p, [["b"], ["c"]], 0).collect()} == {0, 3}
    assert {r["uid"] for r in search.match_near(p, [["b"], ["c"]], 2).collect()} == {0, 1, 3}
    assert {r["uid"] for r in search.match_near(p, [["b"], ["c"], ["x"]], 2).collect()} == {1}
    assert {r["uid"] for r in search.match_phrase(p, ["a", "b"], prefix=True).collect()} == {0, 3}
    assert {r["uid"] for r in search.match_all(p, ["x", "a"]).collect()} == {1}
    assert {r["uid"] for r in search.match_groups(p, [["x", "b"], ["c"]]).collect()} == {0, 1, 3}


VOWELLED, BARE = "كَتَبَ الْوَلَدُ رِسَالَةً إِلَى المَدْرَسَةِ", "كتب الولد رسالة الى المدرسة"


def test_vowelled_and_bare_texts_are_found_alike(spark):
    """Searching, phrases, grams and loose matching see the same words whether a text has its marks or not."""
    df = docs(spark, VOWELLED, BARE, "كلام آخر")
    p = search.postings(df, p=ARABIC)
    for asked in (VOWELLED, BARE):
        terms = ARABIC.tokens(asked)
        assert {r["uid"] for r in search.match_all(p, terms[:2]).collect()} == {0, 1}
        assert {(r["uid"], r["hits"]) for r in search.match_phrase(p, terms[:3]).collect()} == {(0, 1), (1, 1)}
        assert {r["uid"] for r in search.match_expression(p, f'"{" ".join(asked.split()[:2])}" OR xyz', ARABIC).collect()} == {0, 1}
        q = spark.createDataFrame([(1, asked)], "item_id int, text string")
        hits = match.loose_matches(match.query_model(q, "item_id", "text", ARABIC), df, p=ARABIC).collect()
        assert {(r["uid"], r["num"] / r["den"]) for r in hits} == {(0, 1.0), (1, 1.0)}
    grams = {(r["key"], r["gram"]) for r in match.gram_table(df, "doc_id", "text", 2, ARABIC).collect()}
    assert {g for k, g in grams if k == 0} == {g for k, g in grams if k == 1}


def holds(tree, toks):
    """A query tree on one text, by definition."""
    kind = tree[0]
    if kind in ("and", "or"):
        return (all if kind == "and" else any)(holds(x, toks) for x in tree[1])
    if kind == "not":
        return holds(tree[1], toks) and not holds(tree[2], toks)
    if kind == "phrase":
        n = len(tree[1])
        same = lambda i, x, y: x.startswith(y) if tree[2] and i == n - 1 else x == y
        return n > 0 and any(all(same(i, toks[s + i], w) for i, w in enumerate(tree[1])) for s in range(len(toks) - n + 1))
    import itertools

    places = [[i for i, t in enumerate(toks) if t in g] for g in tree[1]]
    return any(max(c) - min(c) - 1 <= tree[2] for c in itertools.product(*places))


@pytest.mark.parametrize("text", ["a b", "a OR b c", '"a b" NOT c', "ca*", "(a OR b) AND (c OR d)", "NEAR(a d, 1)", 'NEAR(a b c) OR "b ca"*', "a NOT b NOT c", '"a"', "A"])
def test_search_language(spark, text):
    r = random.Random(text)
    texts = [" ".join(r.choice(["a", "b", "c", "d", "cab"]) for _ in range(r.randrange(0, 7))) for _ in range(60)]
    tree = search.parse(text)
    want = {i for i, t in enumerate(texts) if holds(tree, t.split())}
    assert {x["uid"] for x in search.matching(search.postings(docs(spark, *texts)), tree).collect()} == want


def test_search_language_errors():
    for text in ("(a", "a)", "OR", "NEAR()", "a AND"):
        with pytest.raises(ValueError):
            search.parse(text)


def test_filters_are_three_valued(spark):
    df = spark.createDataFrame([(1, "en", "w", None, "ocr", "unmatched", True), (2, "en", "w", 300, "ocr", "verified", False), (3, "de", "v", 100, "typed", None, True)], "uid long, lang string, work string, death int, source_type string, level string, primary_version boolean")
    ids = lambda f, **k: {r["uid"] for r in df.where(f(search.QuerySpec(**k))).collect()}
    assert ids(search.unit_filter) == {1, 3} and ids(search.unit_filter, all_versions=True, langs=["en"]) == {1, 2}
    assert ids(search.citation_filter) == {1, 2, 3} and ids(search.citation_filter, before=9999) == {2, 3} and ids(search.citation_filter, min_level="partial") == {2, 3} and ids(search.citation_filter, after=200) == {2}
    h = spark.createDataFrame([(1, "Ali", "k", "sahih", True, 3), (2, "Ali", "k", "SAHIH", False, None), (None, None, None, None, None, None)], "hadith_id int, caliph string, narrator_key string, grades string, agreed_upon boolean, weakest_rank int")
    ids = lambda **k: {r["hadith_id"] for r in h.where(search.hadith_filter(search.QuerySpec(**k))).collect()}
    assert ids() == {1, 2, None} and ids(hadith_only=True) == {1, 2} and ids(graded="Sahih") == {1, 2} and ids(agreed=True) == {1} and ids(max_weakest_rank=5) == {1} and ids(caliph="Ali", narrator="k") == {1, 2}


def test_front_end(spark):
    units = spark.createDataFrame([(i, f"w{i % 2}", f"a{i % 2}", "en", "own", "typed" if i % 3 else "ocr", i != 5, t) for i, t in enumerate(["lamp oil", "lamp lamp", "oil", "Lámp and oil", "lamp x", "lamp"])], "uid long, work string, author string, lang string, attribution string, source_type string, primary_version boolean, text string")
    t = {
        "units": units, "postings": search.postings(units, "uid"), "work_meta": spark.createDataFrame([("w0", None, "zero"), ("w1", 300, "one")], "work string, death int, title string"),
        "verse_refs": spark.createDataFrame([(0, 2, 3, "lemma"), (0, 2, 3, "cited"), (1, 2, 3, "cited"), (2, 2, 4, "lemma")], "uid long, sura int, aya int, how string"), "concept_refs": spark.createDataFrame([(1, "c"), (4, "d")], "uid long, concept string"),
        "hadith_units": spark.createDataFrame([(0, 9), (0, 8), (1, 7)], "uid long, hadith_id long"), "hadith": spark.createDataFrame([(9, "Ali"), (8, "Umar"), (7, "Ali")], "hadith_id long, caliph string"),
    }
    found = lambda **k: [r["uid"] for r in search.search(search.QuerySpec(**k), t).orderBy("rank").collect()]
    assert sorted(found(query="LAMP")) == [0, 1, 3, 4] and found(query="lamp")[0] == 1 and sorted(found(query="lamp", all_versions=True)) == [0, 1, 3, 4, 5]
    assert sorted(found(query="oil lamp")) == [0, 3] and found(query="lamp", chrono=True) == [1, 3, 0, 4] and found(query="lamp", limit=1) == [1]
    assert found(verse=(2, 3)) == [0, 1] and found(verse=(2, 3), how=["lemma"]) == [0] and found(concept="d") == [4] and found(query="lamp", concept="c") == [1]
    assert sorted(found(query="lamp", before=300)) == [1, 3] and found(query="?!") == [] and sorted(found(query="lamp", hadith_only=True)) == [0, 1]
    rows = {r["uid"]: r for r in search.assembled(search.QuerySpec(verse=(2, 3)), t).collect()}
    assert rows[0]["verse_how"] == "cited,lemma" and rows[0]["hadith_id"] == 8 and rows[1]["title"] == "one"
    assert {r["hadith_id"] for r in search.assembled(search.QuerySpec(query="lamp", caliph="Ali"), t).collect()} == {9, 7}
    assert search.total(search.QuerySpec(query="lamp"), t).first()["total"] == 4
    assert [(r["author"], r["n"], r["total"]) for r in search.by_author(search.QuerySpec(query="lamp"), t).collect()] == [("a0", 2, 2), ("a1", 2, 2)]
    with pytest.raises(ValueError, match="needs"):
        search.assembled(search.QuerySpec(), t)


def test_places_of_an_order(spark):
    df = spark.createDataFrame([(i, (i * 37) % 11 if i % 4 else None) for i in range(300)], "k int, v int").repartition(7)
    got = {r["k"]: r["place"] for r in search.placed(df, [F.coalesce("v", F.lit(99)), F.col("k")], "place").collect()}
    want = sorted(range(300), key=lambda i: ((i * 37) % 11 if i % 4 else 99, i))
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == want and sorted(got.values()) == list(range(1, 301))


def test_prefiltered_pattern_finds_variants():
    import re

    p = re.compile(search.line_pattern("Rights RÉSERVED", {"e": "é"}, "\u0301").replace("(?iu)", ""), re.I)
    assert p.search("all reservéd") and p.search("RE\u0301SERVED") and not p.search("rights only")


def sweep(words, toks, window, need):
    """The loose score as a plain sweep over the text."""
    content, size = words, len(set(words))
    pairs = [(a, b) for a, b in zip(content, content[1:]) if a != b]
    pos = [(i, t) for i, t in enumerate(toks) if t in set(content)]
    best = None
    if len({t for _, t in pos}) < need:
        return None
    for end, _ in pos:
        inside = [(i, t) for i, t in pos if end - window < i <= end]
        cov = len({t for _, t in inside})
        ok = sum(any(a == x and b == y and 1 <= j - i <= 3 for i, x in inside for j, y in inside) for a, b in pairs)
        score = (7 * cov * len(pairs) + 3 * ok * size) / (10 * size * len(pairs)) if pairs else cov / size
        if best is None or score > best[0] + 1e-12:
            best = (score, inside[0][0], end)
    return best


def stems(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(T.stems("t").alias("s")).first()["s"]


def test_many_queries_take_several_passes(spark, monkeypatch):
    queries = spark.createDataFrame([(i, f"lamp river w{i} stone") for i in range(20)], "item_id int, text string")
    model, d = match.query_model(queries, "item_id", "text"), docs(spark, "lamp river w3 stone", "w19 stone lamp")
    once = sorted(tuple(r) for r in match.loose_matches(model, d).collect())
    monkeypatch.setattr(match, "QUERIES_AT_ONCE", 3)
    assert sorted(tuple(r) for r in match.loose_matches(model, d).collect()) == once and len(once) > 5
    assert sorted(tuple(r) for r in match.loose_matches(model, d.repartition(5)).collect()) == once  # however the scan is split
    assert match.loose_matches(model.limit(0), d).count() == 0


def test_retry_follow_on_and_enrichment(spark):
    q = match.query_model(spark.createDataFrame([(1, "lamp river stone cloud")], "item_id int, text string"), "item_id", "text")
    d = spark.createDataFrame([(1, "lamp river stone cloud", "x lamp river stone cloud"), (2, "stone cloud", "lamp river stone cloud"), (3, "a", "b")], "doc_id int, body string, whole string")
    assert {(r["uid"], r["how"]) for r in match.retried_matches(q, d, "doc_id", "body", "whole").collect()} == {(1, "text"), (2, "whole")}
    rows = spark.createDataFrame([("w", 1, "a b", False), ("w", 2, "Title", True), ("w", 3, "c", False), ("w", 4, "12 - new", False), ("w", 5, "word " * 40, False), ("w", 6, "z", False)], "w string, n int, t string, h boolean")
    got = {r["n"]: (r["follows"], r["joined"]) for r in match.follow_on(rows, "w", "n", "t", F.col("h"), r"^\d+ - ").collect()}
    assert got[1] == (1, "a b c") and got[3] == (0, "c") and got[4][0] == 2 and got[5][0] == 0 and 2 not in got
    hits = spark.createDataFrame([(1, 5)], "q int, uid long")
    e = match.enriched(
        hits, spark.createDataFrame([(5, "g"), (6, "g"), (7, "h")], "uid long, group string"), spark.createDataFrame([(5, 8, 3)], "uid long, weakest int, names int"),
        spark.createDataFrame([(5, "late", 900, "classical", "sound"), (5, "early", 200, "classical", "weak"), (5, "new", 1400, "modern", "fair")], "uid long, critic string, death int, layer string, class string"),
        spark.createDataFrame([(5, "B")], "uid long, source string"), spark.createDataFrame([(5, "sound"), (5, "unique")], "uid long, class string"),
    )
    r = e.withColumn("has", match.has_classical_verdict()).first()
    assert r["members"] == [6] and [v["critic"] for v in r["classical"]] == ["early", "late"] and [v["critic"] for v in r["modern"]] == ["new"] and r["remarks"] == ["unique"] and r["has"]


def test_loose_score_is_the_sweep(spark):
    stop = frozenset(["the", "of"])
    queries = spark.createDataFrame([(1, "the light of lamp in glass"), (2, "of the"), (3, "one")], "item_id long, text string")
    texts = ["a lamp gives light and the lamp in a glass of light lamp glass", "of the the of", "one two one", "glass lamp light in", "in glass in lamp " * 20 + "light lamp in glass", ""]
    model = match.query_model(queries, "item_id", "text", stop=stop)
    got = {(r["q"], r["uid"]): r for r in match.loose_matches(model, docs(spark, *texts), num=0, den=1).collect()}
    for m in model.collect():
        for uid, t in enumerate(texts):
            want = sweep(m["words"], stems(spark, t), m["window"], m["need"])
            assert ((m["q"], uid) in got) == (want is not None)
            if want:
                r = got[m["q"], uid]
                assert abs(r["num"] / r["den"] - want[0]) < 1e-12 and (r["start"], r["stop"]) == want[1:]


def linked(sets, percent, of=None):
    """Groups of keys by brute force: key -> smallest key it reaches; only keys with a link."""
    label = {k: k for k in sets}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    out = set()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and (of is None or of[a] != of[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                out |= {a, b}
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {k: find(k) for k in out}


@pytest.mark.parametrize("percent", [30, 60, 85])
def test_prefix_filtered_jaccard_is_exact(spark, percent):
    r = random.Random(percent)
    sets = {i: {f"g{r.randrange(14)}" for _ in range(r.randrange(1, 9))} for i in range(60)}
    grams = spark.createDataFrame([(i, g) for i, s in sets.items() for g in sorted(s)], "key long, gram string")
    distinct, members = match.equal_sets(grams)
    first = {r["key"]: r["set"] for r in members.collect()}
    assert first == {i: min(k for k in sets if sets[k] == sets[i]) for i in sets}
    want = {(a, b) for a in sets for b in sets if a < b and first[a] == a and first[b] == b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert {(p["a"], p["b"]) for p in match.set_pairs(distinct, percent).collect()} == want
    of = {i: i % 3 for i in sets}
    assert {p["key"]: p["group"] for p in match.jaccard_groups(grams, percent).collect()} == linked(sets, percent)
    across = spark.createDataFrame(list(of.items()), "key long, of int")
    assert {p["key"]: p["group"] for p in match.jaccard_groups(grams, percent, across=across).collect()} == linked(sets, percent, of)


def test_many_copies_make_no_pairs(spark):
    grams = spark.range(10_000).select(F.col("id").alias("key"), F.explode(F.array(*[F.lit(f"g{i}") for i in range(12)])).alias("gram"))
    sets, members = match.equal_sets(grams)
    assert sets.count() == 1 and match.set_pairs(sets, 60).count() == 0 and members.count() == 10_000
    assert match.jaccard_groups(grams, 60).where("group = 0").count() == 10_000


def test_minhash_groups_are_links_to_a_buckets_first(spark):
    r = random.Random(5)
    base = [[r.randrange(1 << 28) for _ in range(40)] for _ in range(5)]
    sets = {i: set(base[i % 5][: 40 - i % 7]) | {r.randrange(1 << 28) for _ in range(i % 7)} for i in range(60)}
    sets |= {100 + i: {r.randrange(1 << 28) for _ in range(20)} for i in range(20)}
    df = spark.createDataFrame([(k, sorted(s)) for k, s in sets.items()], "key long, s array<long>")
    got = {x["key"]: x["group"] for x in match.minhash_groups(df, "key", F.col("s")).collect()}
    assert got == {i: i % 5 for i in range(60)} == linked(sets, 30)
    prime, family = match.hash_parameters()
    assert len(family) == 32 and all(0 < a < prime and 0 <= b < prime for a, b in family)


def test_vote_join_takes_only_asked_documents(spark):
    q = spark.createDataFrame([("q", g) for g in "abcdef"], "key string, gram string")
    d = spark.createDataFrame([(k, g) for k, gs in {1: "abcdef", 2: "abcde", 3: "abcd", 4: "xyz"}.items() for g in gs], "key int, gram string")
    ids = lambda **k: {r["r"] for r in match.vote_join(q, d, **k).collect()}
    assert ids() == {1} and ids(keep_percent=60) == {1, 2, 3} and ids(only=spark.createDataFrame([(2,), (3,)], "key int")) == {2} and ids(most_left=1, keep_percent=60) == set()
    assert ids(most_df=2, percent=10, least=1, keep_percent=1) == {1, 2} and [tuple(r) for r in match.argmax_join(q, d).collect()] == [("q", 1, 6)]


def test_wording_links(spark):
    rows = [(1, 10, 9, 10, 10, True, True, False), (1, 11, 9, 10, 10, False, False, True), (2, 12, 9, 10, 10, False, False, False), (2, 13, 5, 10, 10, False, False, False), (3, 14, 5, 10, 10, None, True, True)]
    df = spark.createDataFrame(rows, "l int, r int, votes int, n_l int, n_r int, same boolean, grp boolean, critic boolean")
    got = {(r["l"], r["r"]): (r["companion"], r["basis"]) for r in match.wording_links(df, F.col("same"), F.col("grp"), F.col("critic")).collect()}
    assert got == {(1, 10): ("same", "parallel_group"), (2, 12): ("other", "wording"), (3, 14): ("unknown", "parallel_group+critic_takhrij")}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(90, 99), (95, 99)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 90: 90, 95: 90, 99: 90}
    named = spark.createDataFrame([("urn:b", "urn:a"), ("urn:c", "urn:b"), ("x", "y")], "a string, b string")
    assert {r["node"]: r["component"] for r in graph.components(named).collect()} == {"urn:a": "urn:a", "urn:b": "urn:a", "urn:c": "urn:a", "x": "x", "y": "x"}


def test_islands_carry_and_cutoff(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 2, "#"), ("k", 3, "y"), ("k", 4, "#"), ("k", 5, "z")], "key string, n int, v string")
    assert [r["unit"] for r in segment.islands(df, "key", "n", F.col("v") == "#").orderBy("n").collect()] == [0, 1, 1, 2, 2]
    carried = segment.carried(df, "key", "n", F.when(F.col("v") == "#", F.col("n")), "c", before=True)
    assert [r["c"] for r in carried.orderBy("n").collect()] == [None, None, 2, 2, 4]
    assert segment.until(df, ["key"], "n", F.lit(1), 3).count() == 3
    same = spark.createDataFrame([("k", 1, 7), ("k", 2, 7), ("k", 3, 8)], "key string, n int, number int")
    assert [r["number_id"] for r in segment.suffixed(same, "key", "number", "n").orderBy("n").collect()] == ["7", "7#2", "8"]


def test_offset_vote_and_levels(spark):
    words = [f"w{i}" for i in range(60)]
    a = collate.gram_positions(docs(spark, " ".join(["x"] * 30 + words)), "doc_id", "text", 5, 4)
    b = collate.gram_positions(docs(spark, " ".join(words)), "doc_id", "text", 5)
    r = collate.offset_votes(a, b).first()
    assert (r["bucket"], r["offset"], r["votes"]) == (1, 30, 56)
    lv = spark.createDataFrame([(85, 20, False, True), (60, 20, False, True), (59, 20, False, True), (None, 20, False, True), (None, 20, True, False), (None, 20, False, False), (99, 14, False, True)], "a int, w int, v boolean, h boolean")
    got = [r[0] for r in lv.select(collate.level(F.col("a"), F.col("w"), F.col("v"), F.col("h"))).collect()]
    assert got == ["corroborated", "partial", "divergent", "unmatched", "verified", "no_witness", None]


def test_offset_votes_are_the_definition(spark):
    r = random.Random(9)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(20, 90))) for _ in range(14)]
    w, p = collate.gram_positions(docs(spark, *texts), "doc_id", "text", 2, 4), collate.gram_positions(docs(spark, *texts[:4]), "doc_id", "text", 2)
    got = {(x["w"], x["r"]): (x["bucket"], x["votes"], x["offset"]) for x in collate.offset_votes(w, p).collect()}
    filtered = collate.gram_positions(docs(spark, *texts), "doc_id", "text", 2, 4, wanted=p)
    assert {(x["w"], x["r"]): (x["bucket"], x["votes"], x["offset"]) for x in collate.offset_votes(filtered, p).collect()} == got
    grams = [[" ".join(t.split()[i : i + 2]) for i in range(len(t.split()) - 1)] for t in texts]
    want = {}
    for a, ga in enumerate(grams):
        for b, gb in enumerate(grams[:4]):
            ds = [i - j for i, x in enumerate(ga) if ga.count(x) <= 4 for j, y in enumerate(gb) if x == y]
            buckets = collections.Counter(d // 25 for d in ds)
            if buckets and max(buckets.values()) >= 2:
                best = min(buckets, key=lambda k: (-buckets[k], k))
                inside = sorted(d for d in ds if d // 25 == best)
                want[a, b] = (best, len(inside), inside[len(inside) // 2])
    assert got == want


def test_comparison_families_and_independence(spark):
    a = "one two three four five six"
    c = collate.compared(a, "x y " + a.replace("four", "vier") + " z", 2, around=2)
    assert (c["first"], c["last"], c["word_agreement"], c["diffs"]) == (2, 7, 5 / 6, [{"at": 3, "old": "four", "new": "vier"}]) and 0.5 < c["agreement"] < 1
    assert collate.compared(a, a)["agreement"] == 1.0 and collate.compared(a, "nothing alike") is None and collate.compared(None, a) is None
    shares = spark.createDataFrame([("a", "b", 95), ("a", "b", 90), ("a", "b", 99), ("b", "c", 93), ("c", "d", 92)], "a string, b string, share int")
    assert {r["witness"]: r["family"] for r in collate.families(shares).collect()} == {"a": "a", "b": "a", "c": "a"}
    texts = spark.createDataFrame([(1, "abcdef"), (2, "abcd ef"), (3, "zzzz")], "key int, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    assert {(r["a"], r["b"]): r["share"] for r in collate.letter_agreements(pairs, texts).collect()} == {(1, 2): 100, (1, 3): 0}
    records, wits = spark.createDataFrame([(1, "odd"), (1, "rare"), (1, "the")], "key int, term string"), spark.createDataFrame([(7, "odd"), (8, "x")], "key int, term string")
    at = spark.createDataFrame([(1, 7, "w", "copy"), (1, 8, "w", "free")], "record int, text int, work string, witness string")
    got = {r["witness"]: (r["unknown"], r["reproduced"], r["used"]) for r in collate.independence(records, wits, at, spark.createDataFrame([("the",)], "term string")).collect()}
    assert got == {"copy": (2, 1, False), "free": (2, 0, True)}


def test_alignment(spark):
    same = lambda x, y: float(x == y)
    assert collate.align(["a", "b", "c"], ["a", "c"], same) == [(0, 0, "matched"), (1, None, "gap"), (2, 1, "matched")]
    pairs = spark.createDataFrame([(1, "a b c", "a x c"), (2, None, "")], "k int, a string, b string")
    got = {r["k"]: [tuple(d) for d in r["diffs"]] for r in collate.differences(pairs, ["k"], "a", "b").collect()}
    assert got == {1: [(1, "b", "x")], 2: []}


def test_reading_of_a_record_from_all_witnesses():
    base = "one small lamp stood by the river"
    read = lambda text, ws, lex={}, fam=None: collate.read_record(text, {i: collate.edits(text, w) for i, w in enumerate(ws)}, lex, fam)
    assert collate.edits(base, "a front " + base + " and back") == [("equal", 0, 7, [])]
    ws = [base.replace("stood", "once stod"), base.replace("stood", "once stod")]
    # An inserted word moves nothing after it; an insertion beside a replacement is no 1:1 replacement.
    assert read(base, [base.replace("lamp", "lamp once")] * 2) == ("one small lamp once stood by the river".split(), [(3, "insert")])
    assert read(base, ws) == (base.split(), [])
    bad = base.replace("stood", "stodd")
    assert read(bad, [base, base]) == (base.split(), [(3, "majority")])
    assert read(bad, [base, base], {}, {0: 7, 1: 7}) == (bad.split(), [(3, "open")])
    assert read(bad, [base], {"stood": 99}) == (base.split(), [(3, "lexicon")])
    assert read(bad, [base, bad, base], {"stood": 99}) == (bad.split(), [(3, "open")])
    assert read(base, [base.replace("lamp", "xyzzy")] * 2, {"lamp": 99})[1] == [(2, "open")]
    assert read(base.replace("small lamp", "smalllamp"), [base], {"small": 99, "lamp": 99}) == (base.split(), [(1, "join")])
    assert read(bad, [base.replace("stood", "Stood"), base], {"=stood": 5})[0] == base.split()


ENTRY = "id string, type string, status string, title string, text string, data string, links array<struct<rel:string,to:string>>"


def test_ledger(spark):
    rows = [
        ("saying:a", "saying", "draft", "t", "x", "{}", [("supersedes", "saying:b")]), ("saying:b", "saying", "draft", "t", "x", "{}", []), ("saying:b", "saying", "superseded", "", "x", "{}", []),
        ("odd:c", "saying", "draft", "t", "x", "{}", [("knows", "saying:zz")]), ("reading:d", "reading", "draft", "t", "x", "{}", []), ("passage:e", "passage", "draft", "t", "x", '{"voice": "v"}', []),
    ]
    e = spark.createDataFrame(rows, ENTRY)
    assert {r["id"] for r in ledger.current(e).collect()} == {"saying:a", "odd:c", "reading:d", "passage:e"}
    types, rels = spark.createDataFrame([("saying",), ("passage",)], "type string"), spark.createDataFrame([("supersedes",)], "rel string")
    assert {(r["check"], r["key"]) for r in ledger.validate(e, types, rels).collect()} == {("missing", "saying:b"), ("duplicate", "saying:b"), ("type", "reading"), ("relation", "knows"), ("link", "saying:zz"), ("prefix", "odd:c"), ("layer", "reading:d")}


def test_ledger_views(spark):
    rows = [("q:1", "question", "draft", "why", []), ("q:2", "question", "draft", "how", []), ("a:1", "reading", "draft", "so", [("answers", "q:1")]), ("i:1", "inference", "draft", "then", [("rests_on", "a:1"), ("rests_on", "q:2")]), ("r", "reading", "draft", "root", []), ("r/1", "reading", "draft", "part", [("part_of", "r")]), ("r/2", "reading", "draft", "deep", [("part_of", "r/1")])]
    e = spark.createDataFrame([(i, t, s, n, "x", "{}", links) for i, t, s, n, links in rows], ENTRY)
    assert [r["id"] for r in ledger.open_questions(e).collect()] == ["q:2"] and [tuple(r) for r in ledger.inferences(e).collect()] == [("i:1", "then", "a:1,q:2")]
    assert {(r["id"], r["depth"]) for r in ledger.tree(e).where("root = 'r'").collect()} == {("r", 0), ("r/1", 1), ("r/2", 2)}


def test_catalogue_rules(spark):
    v = spark.createDataFrame([("w", 1, False, 1, 9), ("w", 2, True, None, 1), ("w", 3, True, 2, 1), ("w", 4, True, 2, 5), ("x", 5, None, None, 1), ("x", 6, False, None, 1)], "work string, version int, typed boolean, pri int, n int")
    pick = lambda forced=None: {r["work"]: r["version"] for r in catalog.best_versions(v, ["work"], F.col("typed"), F.col("pri"), F.col("n"), "version", forced).collect()}
    assert pick() == {"w": 4, "x": 5} and pick(spark.createDataFrame([("w", 1), ("x", 99)], "work string, version int")) == {"w": 1, "x": 5}
    recs, nums = spark.createDataFrame([(1, "a"), (2, "b")], "seq int, line string"), spark.createDataFrame([(1, "a", "7"), (2, "b", "8a")], "seq int, line string, number string")
    out = {r["id"]: (r["interpolation_candidate"], r["concordance"][0]["number"]) for r in catalog.renumbered(recs, nums, ["seq"], ["line"], "number", F.col("n_number"), "ed").collect()}
    assert out == {"7": (False, "7"), "8a": (True, "8a")}
    with pytest.raises(Exception, match="another text"):
        catalog.renumbered(recs, nums.withColumn("line", F.lit("z")), ["seq"], ["line"], "number", F.col("n_number"), "ed").collect()
    new, known = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "2"), ("d", "9"), ("e", "5")], "path string, sha string"), spark.createDataFrame([("z", "1"), ("d", "8")], "path string, sha string")
    assert {r["path"]: r["action"] for r in catalog.placement(new, known).collect()} == {"a": "skip", "b": "place", "c": "skip", "d": "refuse", "e": "place"}
    s = lambda rows: spark.createDataFrame(rows, "name string, size long")
    assert {r["name"]: r["state"] for r in catalog.size_check(s([("a", 1), ("b", 2), ("c", 3)]), s([("a", 1), ("b", 3), ("d", 1)])).collect()} == {"a": "ok", "b": "mismatch", "c": "missing", "d": "extra"}
    units, old = spark.createDataFrame([("k", 1), ("k", 2), ("k", 3)], "k string, s int"), spark.createDataFrame([("id2", 2)], "id string, s int")
    assert [r["id"] for r in catalog.rebuilt_ids(units, old, "s", [F.col("s")], "k", "p:").orderBy("s").collect()] == ["p:k:1", "id2", "p:k:2"]
    with pytest.raises(Exception, match="would be lost"):
        catalog.rebuilt_ids(units.where("s <> 2"), old, "s", [F.col("s")], "k", "p").collect()
    e = lambda rows: spark.createDataFrame(rows, "entry int, record int, share double")
    got = catalog.number_guard(spark.createDataFrame([(1,), (2,), (3,), (4,)], "entry int"), e([(1, 10, 0.3), (1, 11, 0.4), (2, 10, 0.2)]), e([(2, 12, 0.8), (3, 13, 0.9), (3, 14, 0.8), (4, 15, 0.6)]))
    assert {r["entry"]: (r["record"], r["how"]) for r in got.collect()} == {1: (11, "number"), 2: (12, "wording"), 3: (None, None), 4: (None, None)}


def test_interval_and_theta_joins(spark):
    r = random.Random(7)
    points = [(i, r.randrange(-50, 2000), i % 3) for i in range(150)]
    spans = [(i, a, a + r.choice([-1, 0, 1, 7, 300, 5000]), i % 3) for i in range(60) for a in [r.randrange(-60, 1900)]]
    p, s = spark.createDataFrame(points, "k int, v long, g int"), spark.createDataFrame(spans, "i int, lo long, hi long, g int")
    want = {(k, i) for k, v, _ in points for i, lo, hi, _ in spans if lo <= v <= hi}
    assert sorted((x["k"], x["i"]) for x in catalog.interval_join(p, s.drop("g"), "v", "lo", "hi").collect()) == sorted(want)
    want = {(k, i) for k, v, g in points for i, lo, hi, h in spans if lo <= v <= hi and g == h}
    assert sorted((x["k"], x["i"]) for x in catalog.interval_join(p, s, "v", "lo", "hi", ["g"]).collect()) == sorted(want)
    met = catalog.theta_join(p.select("k", "v"), s.select("i", "lo"), F.col("v") > 2 * F.col("lo"), most=10)  # in parts
    assert sorted((x["k"], x["i"]) for x in met.collect()) == sorted((k, i) for k, v, _ in points for i, lo, _, _ in spans if v > 2 * lo)


def test_works_meta(spark):
    works = spark.createDataFrame([("a.0852Name", "t", "typed"), ("b.Ghost", "u", "ocr"), ("c.x", "v", "ocr")], "work string, title string, source_type string")
    refs = spark.createDataFrame([("a.0852Name", "r1"), ("a.*", "r2"), ("b.*", "r3")], "covers string, ref string")
    conf = spark.createDataFrame([("b.Ghost", 3, 5)], "work string, corroborated int, records int")
    out = {r["work"]: (r["death"], r["witnesses"], r["corroborated"], r["refs"]) for r in catalog.works_meta(works, works.limit(0).select("work"), conf, refs, {"ghost": 400}, {"c": 700}).collect()}
    assert out == {"a.0852Name": (852, 0, None, "r1;r2"), "b.Ghost": (400, 0, "3/5", "r3"), "c.x": (700, 0, None, "")}


RULES = names.NameRules(("abu", "umm"), ("bin", "bint"), "al")


def brute_resolve(name, code, entries, codes, aliases):
    """The cascade for one name, by definition."""
    pre, inside = {}, {}
    for k, n in entries.items():
        w = n.split()
        for i in range(1, 9):
            pre.setdefault(" ".join(w[:i]), set()).add(k)
        for j, t in enumerate(w):
            grams = []
            if t in RULES.kunya and (j == 0 or w[j - 1] not in RULES.lineage) or (t == "bin" and j > 0 and not (t in RULES.kunya)):
                grams = [" ".join(w[j : j + i]) for i in (2, 3, 4)]
            elif t.startswith("al") and j > 0:
                grams = [t]
            for g in grams:
                inside.setdefault(g, set()).add(k)
    if name in aliases:
        return aliases[name], "alias"
    special = name.startswith(("abu ", "umm ", "al"))
    for how, cand in (("prefix", pre.get(name, set())), ("contains", inside.get(name, set()))):
        coded = [k for k in cand if (k, code) in codes]
        if how == "contains" and not special:
            return (coded[0], "contains+book_code") if len(coded) == 1 and name.startswith("bin ") else (None, len(cand))
        if len(cand) == 1:
            return next(iter(cand)), how
        bare = len(name.split()) == 2 and name.split()[0] in RULES.kunya
        if len(cand) > 1 and not bare and len(coded) == 1:
            return coded[0], how + "+book_code"
        if cand:
            return None, len(cand)
    return None, 0


def test_name_cascade_is_the_definition(spark):
    r = random.Random(3)
    words = ["ali", "omar", "bin", "abu", "alkufi", "zayd", "umm", "hasan", "albasri"]
    entries = {k: " ".join(r.choice(words) for _ in range(r.randrange(2, 6))) for k in range(40)}
    codes = {(k, c) for k in entries for c in "mn" if r.random() < 0.3}
    asked = {(" ".join(r.choice(words) for _ in range(r.randrange(1, 4))), r.choice("mnx")) for _ in range(200)} | {(" ".join(n.split()[i : i + 3]), "m") for n in entries.values() for i in range(2)}
    index = names.name_index(spark.createDataFrame(list(entries.items()), "entry long, name string"), RULES)
    args = (index, spark.createDataFrame(sorted(codes), "entry long, code string"), spark.createDataFrame([("zayd", 7)], "name string, entry long"), RULES)
    got = {(x["name"], x["code"]): x for x in names.resolve(spark.createDataFrame(sorted(asked), "name string, code string"), *args).collect()}
    for (name, code), x in got.items():
        entry, how = brute_resolve(name, code, entries, codes, {"zayd": 7})
        assert (x["entry"], x["how"] if entry is not None else x["candidates"]) == (entry, how), (name, code)
    assert len(got) == len(asked) and len({x["how"] for x in got.values()}) >= 4


def test_neighbours_settle_names(spark):
    entries = {1: "ali bin zayd one", 2: "ali bin zayd two", 3: "omar x", 4: "hasan y"}
    index = names.name_index(spark.createDataFrame(list(entries.items()), "entry long, name string"), RULES)
    chains = [(c, i, n) for c, ns in enumerate([["omar x", "ali bin zayd one"], ["omar x", "ali bin zayd one"], ["omar x", "ali bin zayd"], ["hasan y", "ali bin zayd"], ["ali bin zayd"]]) for i, n in enumerate(ns)]
    df = spark.createDataFrame([(c, i, n, "-") for c, i, n in chains], "chain int, at int, name string, code string")
    none = (spark.createDataFrame([], "entry long, code string"), spark.createDataFrame([], "name string, entry long"))
    got = {(r["chain"], r["at"]): (r["entry"], r["how"], r["candidates"]) for r in names.chains_resolved(df, index, *none, [], RULES).collect()}
    assert got[2, 1] == (1, "neighbour", 2) and got[3, 1] == (None, None, 2) and got[4, 0] == (None, None, 2) and len(got) == len(chains)
    assert all(r["entry"] is None for r in names.chains_resolved(df, index, *none, ["ali bin zayd"], RULES).where("name = 'ali bin zayd'").collect())
    ranks = spark.createDataFrame([(1, 9), (3, 2)], "entry long, rank int")
    resolved = names.chains_resolved(df, index, *none, [], RULES)
    assert {r["chain"]: (r["names"], r["linked"], r["weakest"]) for r in names.weakest_links(resolved, ranks).collect()}[0] == (2, 2, 9)
    assert {r["chain"] for r in names.weak_narrators(resolved, ranks, spark.createDataFrame([(1,)], "chain int")).collect()} == {0, 2}


def test_cite(spark):
    text = "first words here PageV01P004 second page all PageV01P005 rights reserved"
    rows = [("urn:lib:f.b:1", "f", text, None, 1, 3, None), ("urn:lib:f.b:2", "f", "x", ["a", "b"], None, None, 7), ("odd", "g", "plain", None, 2, None, 9)]
    records = spark.createDataFrame(rows, "id string, folder string, text string, hemistichs array<string>, vol int, page_before int, seq int")
    asked = [("urn:lib:f.b:1", p) for p in ("", "Second PAGE", "all rights", "nothing")] + [("urn:lib:f.b:2", "x"), ("odd", None), ("urn:lib:f.b:9", None), (None, None)]
    got = {(r["id"], r["phrase"]): (r["kind"], r["loc"]) for r in cite.cite(records, spark.createDataFrame(asked, "id string, phrase string")).collect()}
    assert got == {
        ("urn:lib:f.b:1", ""): ("pages", "1:4 to 1:6"), ("urn:lib:f.b:1", "Second PAGE"): ("on", "1:5"), ("urn:lib:f.b:1", "all rights"): ("across", "1:5-1:6"), ("urn:lib:f.b:1", "nothing"): ("missing", ""),
        ("urn:lib:f.b:2", "x"): ("verse", "seq=7"), ("odd", None): ("locator", "vol=2 seq=9"), ("urn:lib:f.b:9", None): ("absent", ""), (None, None): ("absent", ""),
    }
    layer = spark.createDataFrame([("urn:hadith:c:5", 5, ["urn:lib:f.b:1"])], "id string, number int, source_ids array<string>")
    ids = {r["asked"]: (r["id"], r["known"]) for r in cite.resolved_ids(spark.createDataFrame([("urn:hadith:c:5", ""), ("urn:hadith:c:6", ""), ("odd", "")], "id string, phrase string"), layer).collect()}
    assert ids == {"urn:hadith:c:5": ("urn:lib:f.b:1", True), "urn:hadith:c:6": (None, False), "odd": ("odd", True)}


def test_placement_of_a_work_in_stretches_is_that_of_the_whole(spark):
    r = random.Random(11)
    records = [(i, f"w{i % 2}") for i in range(200)]
    hits = [(i, p, h, h + r.randrange(3)) for i in range(200) for p in r.sample(range(300), r.randrange(0, 4)) for h in [r.choice([0, 1, 2, 2, 3, 5])]]
    rec, hit = spark.createDataFrame(records, "doc_id long, work string"), spark.createDataFrame(hits, "record long, passage long, head long, hits long")
    heading = F.when(F.col("doc_id") % 37 == 5, F.struct(F.lit(1).cast("long").alias("g"), F.col("doc_id").alias("n"), F.col("doc_id").alias("passage")))
    got = sorted(tuple(x) for x in passages.placed(rec, hit, "work", "doc_id", "doc_id", F.floor(F.col("passage") / 100).cast("long"), F.col("passage"), heading).collect())
    want = []
    for w in ("w0", "w1"):
        rows = [(i, [{"g": p // 100, "n": p, "passage": p, "head": a, "hits": b} for k, p, a, b in hits if k == i], {"g": 1, "n": i, "passage": i} if i % 37 == 5 else None) for i, x in records if x == w]
        want += [(w, *x) for x in K.place(rows)]
    assert got == sorted(want) and {x[3] for x in got} == {"heading", "lemma", "continues", "cited"}


def test_concepts_in_their_sense(spark):
    c = passages.Concept("light", ("lamp", "lamp oil", "lamp oil jar"), ("wick",), ("street",), ("نور",))
    far = "x " * 90
    texts = ["the lamp with a wick", "lamp", "a street lamp and a wick", "lamp oil", "wick " + far + "lamp", "qlamp near the wick lamp oil jar", "نور lamp wick"]
    df = docs(spark, *texts).withColumn("fa", F.col("doc_id") == 6)
    got = {r["record"]: (r["raw"], r["kept"]) for r in passages.concept_hits(df, [c], "doc_id", "text", "q", bridged=F.col("fa")).collect()}
    assert got == {0: (1, 1), 1: (1, 0), 2: (1, 0), 3: (1, 1), 4: (1, 0), 5: (2, 2), 6: (2, 2)}


SOUND = [("sound", "sound"), ("fair", "fair")]


def test_scanner(spark):
    lines = ["intro", "1 - «lamp stood near river stone cloud» It is sound", "and more", "Chapter", "lost", "2 - «small green field bird sang loud» It is weak, in One", "7 - «nothing that is known here» It is weak", "2 - no verdict"]
    df = spark.createDataFrame([("p", i, v, v == "Chapter") for i, v in enumerate(lines)], "path string, line int, value string, heading boolean")
    layer = spark.createDataFrame([(10, "One", 2, "small green field bird sang loud x"), (11, "Two", 2, "small green field bird sang loud x"), (12, "Two", 1, "x lamp stood near river stone cloud y")], "record int, collection string, number int, text string")
    s = verdicts.Scanner("w", "critic", 500, "classical", r"^(\d+) - ", "It is", [("weak", "weak")], SOUND, scope="It is", names=[("one", "in One", ["One"])])
    got = {(r["entry"], r["record"]): (r["class"], r["candidates"], r["sources"], r["verdict"]) for r in verdicts.scan(df, layer, s).collect()}
    assert got == {("1", 12): ("sound", 1, "", "It is sound and more"), ("2", 10): ("weak", 1, "one", "It is weak, in One"), ("7", None): ("weak", 0, "", "It is weak")}
    by_number = dataclasses.replace(s, by_number=True, names=[])
    got = {(r["entry"], r["record"]) for r in verdicts.scan(df, layer, by_number).collect()}
    assert got in ({("1", 12), ("2", 10), ("7", None)}, {("1", 12), ("2", 11), ("7", None)})


def test_units_by_kind(spark):
    kinds = [("more", "a"), ("heading", "b"), ("more", "c"), ("sub", "d"), ("start", "e"), ("more", "f"), ("sub", "g"), ("more", "h"), ("start", "i")]
    df = spark.createDataFrame([("k", i, k, t) for i, (k, t) in enumerate(kinds)], "key string, n int, kind string, t string")
    assert {r["number"]: r["text"] for r in segment.numbered_units(df, "key", "n", F.col("kind"), "t").collect()} == {"0": "a", "intro.1": "d", "1": "e f", "1.1": "g h", "2": "i"}
    rows = [("k", i, t) for i, t in enumerate(["x", "# one", "two", "* note", "lost", "# one", "two", "# other"])]
    u = segment.closed_units(spark.createDataFrame(rows, "key string, n int, t string"), "key", "n", "t", F.col("t").startswith("#"), F.col("t").startswith("*"))
    assert {r["first"]: r["text"] for r in u.collect()} == {1: "# one two", 7: "# other"}


def test_stored_index_and_exports(spark, tmp_path):
    df = docs(spark, "lamp oil", "oil river", "")
    sinks.stored_index(df, str(tmp_path / "index"), buckets=4)
    got = sinks.postings_of(spark, str(tmp_path / "index"), ["oil"])
    assert {(r["uid"], r["pos"]) for r in got.collect()} == {(0, 1), (1, 0)} and got.columns == ["uid", "pos", "term"]
    meta = spark.read.parquet(str(tmp_path / "index" / "meta")).first()
    assert (meta["tokens"], meta["units"], meta["profile"]) == (4, 2, "latin")
    for name, rows in (("a", df), ("b", df.orderBy(F.desc("doc_id")))):
        sinks.export_reproducible(rows, str(tmp_path / f"{name}.gz"), ["doc_id"])
    assert (tmp_path / "a.gz").read_bytes() == (tmp_path / "b.gz").read_bytes() and spark.read.text(str(tmp_path / "a.gz")).count() == 3


def test_staged_build_survives_a_crash_between_moves(spark, tmp_path):
    path, marker = str(tmp_path / "layer"), str(tmp_path / "status")
    build = lambda n: lambda p: spark.range(n).write.parquet(p)
    assert sinks.staged(spark, build(3), path, marker)["ok"]
    (tmp_path / "layer").rename(tmp_path / "layer.aside")  # as if the run had ended right after the old table was moved
    assert not sinks.staged(spark, lambda p: 1 / 0, path, marker)["ok"] and spark.read.parquet(path).count() == 3
    assert sinks.staged(spark, build(5), path, marker)["ok"] and spark.read.parquet(path).count() == 5
    assert not (tmp_path / "layer.aside").exists() and spark.read.parquet(marker).count() == 3


def test_ingestion_adds_a_key_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    part = lambda rows: spark.createDataFrame(rows, "k int, v string").coalesce(1).write.mode("append").parquet(source)
    part([(1, "a"), (1, "a"), (2, "b")])
    ingest.ingest_files(spark, source, target, "k")
    part([(2, "again"), (3, "c")])
    ingest.ingest_files(spark, source, target, "k")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{target}/table").collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_readers_and_sinks(spark, tmp_path):
    lines = tmp_path / "in" / "deep"
    lines.mkdir(parents=True)
    (lines / "a.jsonl").write_text('{"id": "1", "text": "one", "number": 5}\n{"id": "2", "number": "12.3", "hemistichs": ["x", "y"]}\nnot json\n', encoding="utf-8")
    got = readers.json_lines(spark, str(tmp_path / "in")).cache()
    assert got.count() == 3 and {r["number"] for r in got.collect()} == {"5", "12.3", None} and got.where("corrupt_record IS NOT NULL").count() == 1
    filtered = readers.prefiltered_json_lines(spark, str(tmp_path / "in"), "one")
    assert [r["id"] for r in filtered.collect()] == ["1"]
    schema = "k int, v string"
    assert readers.tab_separated(spark, str(tmp_path / "none.tsv"), schema).count() == 0
    (tmp_path / "t.tsv").write_text('k\tv\n1\t"a\n2\tb\n', encoding="utf-8")
    assert [tuple(r) for r in readers.tab_separated(spark, str(tmp_path / "t.tsv"), schema).collect()] == [(1, '"a'), (2, "b")]
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, 9)], "k int, n int")
    assert {tuple(r) for r in sinks.merged(old, new, "k").collect()} == {(1, "a", None), (2, None, 9)}
    m = lambda rows: spark.createDataFrame(rows, "path string, sha string")
    assert {tuple(r) for r in sinks.manifest_diff(m([("a", "1"), ("b", "2"), ("c", "3")]), m([("b", "2"), ("c", "4"), ("d", "5")])).collect()} == {("a", "drop"), ("b", "keep"), ("c", "refresh"), ("d", "add")}
    path = str(tmp_path / "out")
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["v"])
    sinks.overwrite_partitions(spark.createDataFrame([(3, "b")], "k int, v string"), path, ["v"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (3, "b")}
    sinks.export_lines(old, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 2


def test_marked_up_text(spark):
    lines = ["# one", "~~more PageV01P004", "### || Title", "# two", "", "loose"]
    df = spark.createDataFrame([("p", i, v) for i, v in enumerate(lines)], "path string, line int, value string")
    got = [(r["kind"], r["level"], r["page_before"], r["text"]) for r in readers.marked_up(df).orderBy("unit").collect()]
    assert got == [("para", None, None, "one more"), ("heading", 2, 4, "Title"), ("para", None, 4, "two"), ("para", None, 4, "loose")]


def test_word_files_folders_and_walks(spark, tmp_path):
    import io
    import zipfile

    buffer, name = io.BytesIO(), "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{name}"><w:body><w:p><w:r><w:t>one </w:t></w:r><w:r><w:t>line</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>two</w:t></w:r></w:p></w:body></w:document>')
    files = spark.createDataFrame([("f", bytearray(buffer.getvalue()))], "path string, content binary")
    assert [(r["line"], r["text"]) for r in readers.word_paragraphs(files).collect()] == [(0, "one line"), (2, "two")]
    for folder, file in (("a", "Book.One"), ("a", "other"), ("b/deep", "book.two")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / f"{file}.jsonl").write_text('{"id": "%s"}\n' % file, encoding="utf-8")
    ids = lambda *a: {r["id"] for r in readers.folder_records(spark, str(tmp_path), *a).collect()}
    assert ids() == {"Book.One", "other", "book.two"} and ids(["a"]) == {"Book.One", "other"} and ids([], "BOOK, x") == {"Book.One", "book.two"} and ids(["b"], "one") == set()
    nodes = spark.createDataFrame([("a", None, 2, "A"), ("b", None, 1, "B"), ("c", "a", 1, "C"), ("d", "c", 1, "D")], "id string, parent string, o int, title string")
    walk = readers.tree_walk(nodes, "id", "parent", "o", "title", 3)
    assert [(r["id"], r["path"]) for r in walk.orderBy("place").collect()] == [("b", ["B"]), ("a", ["A"]), ("c", ["A", "C"]), ("d", ["A", "C", "D"])]
    with pytest.raises(Exception, match="too deep"):
        readers.tree_walk(nodes, "id", "parent", "o", "title", 1).collect()
    assert readers.counted(nodes, 4).count() == 4
    with pytest.raises(Exception, match="not 5 rows"):
        readers.counted(nodes, 5).collect()


def test_couplets_and_leaves(spark):
    v = spark.createDataFrame([("p", 1, "right", "a"), ("p", 2, "left", "b"), ("p", 3, "right", "c"), ("p", 4, "comment", "d")], "poem string, n int, pos string, text string")
    got = [(r["n"], r["unit_type"], r["hemistichs"]) for r in readers.couplets(v, "poem", "n", "pos", "text").orderBy("n").collect()]
    assert got == [(1, "bayt", ["a", "b"]), (3, "single_line", ["c"]), (4, "single_line", ["d"])]
    t = spark.createDataFrame([("k", "abcdef", [(0, 2), (2, 6)])], "k string, t string, s array<struct<start:int,end:int>>")
    assert [(r["leaf"], r["text"]) for r in readers.leaves(t, "k", "t", "s").collect()] == [(0, "ab"), (1, "cdef")]


def test_heading_paths_and_notes(spark):
    rows = [("k", 1, 1, "A"), ("k", 2, 2, "a"), ("k", 3, None, None), ("k", 4, 1, "B"), ("k", 5, None, None), ("k", 6, 3, "x")]
    df = spark.createDataFrame(rows, "key string, n int, level int, title string")
    got = [r["path"] for r in readers.heading_paths(df, "key", "n", "level", "title").orderBy("n").collect()]
    assert got == [["A"], ["A", "a"], ["A", "a"], ["B"], ["B"], ["B", "x"]]
    notes = readers.body_and_notes(spark.createDataFrame([("a\n__________b",), ("c",)], "t string"), "t")
    assert {(r["body"], r["notes"]) for r in notes.collect()} == {("a", "b"), ("c", None)}


def test_marked_verdicts_and_checksums(spark):
    lines = ["skip", "12 - text", "goes on", "=> sound", "by him", "and more", "too far", "13 - other"]
    df = spark.createDataFrame([("p", i, v) for i, v in enumerate(lines)], "path string, line int, value string")
    got = {r["number"]: (r["text"], r["verdict"]) for r in readers.marked_verdicts(df, "path", "line", "value", r"^(\d+) - ", "^=>", 2).collect()}
    assert got == {"12": ("12 - text goes on", "=> sound by him and more"), "13": ("13 - other", "")}
    files = spark.createDataFrame([("f", bytearray(b"abc"))], "path string, content binary")
    good = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert readers.verified(files, spark.createDataFrame([("f", good)], "path string, sha256 string")).count() == 1
    with pytest.raises(Exception, match="checksum"):
        readers.verified(files, spark.createDataFrame([("f", "0")], "path string, sha256 string")).collect()


def test_markdown_is_never_cut(spark):
    assert sinks.markdown(spark.createDataFrame([(1, "a|b")], "k int, v string")) == "| k | v |\n|---|---|\n| 1 | a\\|b |\n"
    with pytest.raises(ValueError, match="more than"):
        sinks.markdown(spark.range(5), limit=4)
