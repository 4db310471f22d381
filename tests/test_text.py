"""Text functions under the profiles, on small hand-made frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweft.functions import text as T
from lexweft.functions.profiles import ARABIC, LATIN, PERSIAN


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).first()["x"]


def test_norm_folds_marks_and_variants(spark):
    assert one(spark, "إِنَّمَا الأَعْمَالُ بِالنِّيَّاتِ", T.norm("t", ARABIC)) == "انما الاعمال بالنيات"
    assert one(spark, "مَدْرَسَةٌ ١٢ ۳۴ کتاب", T.norm("t", PERSIAN)) == "مدرسه 12 34 كتاب"
    assert one(spark, "Café ÑANDÚ", T.norm("t", LATIN)) == "cafe nandu"
    assert one(spark, None, T.norm("t", LATIN)) == ""


def test_vowelled_and_bare_texts_have_the_same_stems(spark):
    bare, vowelled = "والكتاب بالحق كنزا", "وَالْكِتَابِ بِالْحَقِّ كَنْزًا"
    assert one(spark, bare, T.stems("t", ARABIC)) == one(spark, vowelled, T.stems("t", ARABIC)) == one(spark, "كتاب بالحق كنز", T.stems("t", ARABIC))


def test_tokens_follow_the_profile(spark):
    assert one(spark, "كَتَبَ الْوَلَدُ ٣", T.tokens("t", ARABIC)) == one(spark, "كتب الولد 3", T.tokens("t", ARABIC)) == ["كتب", "الولد", "3"]
    assert one(spark, "L'Été 12a—b", T.tokens("t")) == ["l", "ete", "12a", "b"]


def test_a_query_is_normalised_like_a_text(spark):
    for p in (ARABIC, PERSIAN, LATIN):
        for t in ("Café ÑANDÚ l'été 12a_b", "إِنَّمَا الأَعْمَالُ", "مَدْرَسَةٌ ١٢ ۳۴ کتاب", "", "a\u0301\u00ad-B c\u200cd"):
            row = spark.createDataFrame([(t,)], "t string").select(T.norm("t", p).alias("n"), T.tokens("t", p).alias("k"), T.clean("t", p).alias("c")).first()
            assert (p.norm(t), p.tokens(t), p.clean(t)) == (row["n"], row["k"], row["c"])


def test_splits(spark):
    tail = lambda t: tuple(one(spark, t, T.split_tail("t", "”", "reported|rated")))
    assert tail("he said “this” reported by him") == ("he said “this”", "reported by him") and tail("reported “this” end") == ("", "reported “this” end")
    assert tail("none") == ("none", "") and tail(None) == ("", "")
    chain = lambda t: tuple(one(spark, t, T.split_chain("t", "*", "the Prophet", "said:", 12)))
    assert chain("a from b * text the Prophet") == ("a from b", "text the Prophet", "marker") and chain("a the Prophet he said: text") == ("a the Prophet he said:", "text", "prophet_mention")
    assert chain("a the Prophet, who then went and said: text")[1] == ", who then went and said: text" and chain("text") == ("", "text", "none")
    assert one(spark, "A one B two A three", T.items("t", "A", "B")) == ["A one", "A three"] and one(spark, "", T.items("t", "A", "B")) == []


def test_named_collections(spark):
    names = [("the Four", "four", ["a", "b"]), ("B", "[Bb]ee", ["b"]), ("C", "cee", ["c"])]
    f = lambda t: tuple(one(spark, t, T.named("t", names, "with a chain")))
    assert f("the four and bee, with a chain of cee") == (["the Four", "B"], ["a", "b"]) and f("with a chain of cee") == (["C"], ["c"]) and f("none") == ([], [])


def test_matches_are_where_they_stand(spark):
    assert [tuple(m) for m in one(spark, "ab xab ab", T.matches(F.col("t"), "ab"))] == [(0, 2, "ab"), (4, 6, "ab"), (7, 9, "ab")]
    assert one(spark, "none", T.matches(F.col("t"), "ab")) == [] and [tuple(m) for m in one(spark, "aaa", T.matches(F.col("t"), "a"))] == [(0, 1, "a"), (1, 2, "a"), (2, 3, "a")]


def test_pages_and_cues(spark):
    got = one(spark, "a PageV01P002 b PageEndV02P009 c", T.exact_pages("t", F.lit(1), F.lit(1)))
    assert [(s["vol"], s["page"], s["text"].strip()) for s in got] == [(1, 2, "a"), (1, 3, "b"), (2, 10, "c")]
    rules = [("weak", "weak|poor"), ("sound", "sound")]
    assert [one(spark, t, T.cues("t", rules, "^see ")) for t in ("sound, not poor", "see there", "nothing", "see sound")] == ["sound,weak", "cross_reference", "", "sound"]
    near = one(spark, "x weak word one two sound poor", T.near_cues(T.tokens("t"), F.lit(3), F.lit(4), {"w": " (?:weak|poor)", "s": " good"}, before=2, after=5))
    assert [(c["class"], c["words"]) for c in near] == [("w", ["poor", "weak"])]


def test_json_and_numbers(spark):
    j = '{"id": "u:1", "lang": "ar", "a": {"b": 5, "edition": "x"}, "t": "é"}'
    assert one(spark, j, T.json_peek("t")) == "u:1" and one(spark, j, T.json_get("t", "a.b", "-")) == "5" and one(spark, j, T.json_get("t", "a.c", "-")) == "-"
    assert one(spark, j, T.flat_json("t")) == "u:1 5 é" and one(spark, None, T.flat_json("t")) is None and one(spark, "{}", T.json_peek("t")) is None
    assert one(spark, "1,5", T.decimal("t")) == 1.5 and one(spark, "x", T.decimal("t")) is None and one(spark, "abc def", T.entry_id("t")) == 2025106606 % 100000


def test_chain_grade_overrides(spark):
    f = T.verdict_class("t", [("weak", "weak")], [("sound", "sound")], "but", "support", "differ", "fair chain")
    assert one(spark, "sound, by a fair chain", f) == "fair" and one(spark, "a fair chain", f) == "unclassified"


def test_stem_keeps_three_letters(spark):
    assert one(spark, "unred bus cats", T.stems("t", LATIN)) == ["red", "bus", "cat"]
    assert one(spark, "ابن", T.stems("t", ARABIC)) == ["بن"]


def test_grams_and_shingles(spark):
    assert one(spark, "a b c d", T.grams(T.tokens("t"), 3)) == ["a b c", "b c d"]
    assert one(spark, "a b", T.grams(T.tokens("t"), 3)) == []
    assert one(spark, "abc def", T.shingles(T.tokens("t"), 2)) == [2025106606]


def test_root_variants(spark):
    assert one(spark, "w.k#", T.root_token("t")) == "wkـ"
    assert one(spark, "وكل", T.root_variants("t")) == sorted(["وكل", "ـكل"])


def test_split_and_first_match(spark):
    head, rest, how = T.split_marker("t", "*")
    assert one(spark, "chain * text", F.concat_ws("|", head, rest, how)) == "chain|text|marker"
    assert one(spark, "no mark", F.concat_ws("|", head, rest, how)) == "|no mark|none"
    rules = [("worst", "bad"), ("weak", "ba")]
    assert one(spark, "bad", T.first_match("t", rules, "none")) == "worst" and one(spark, "bar", T.first_match("t", rules, "none")) == "weak"
    assert one(spark, "x", T.first_match("t", rules, "none")) == "none"


def test_verdict_class(spark):
    f = T.verdict_class("t", [("weak", "weak")], [("sound", "sound")], "but", "support", "differ")
    assert [one(spark, t, f) for t in ("sound", "weak", "sound weak", "sound but", "support weak", "differ", "?")] == ["sound", "weak", "disputed", "disputed", "sound_by_support", "disputed_narrator", "unclassified"]


def test_page_segments_and_kwic(spark):
    got = one(spark, "a PageV01P002 b PageV01P003 c", T.page_segments("t", r"PageV\d+P\d+", r"PageV\d+P(\d+)"))
    assert [(s["mark"], s["text"].strip()) for s in got] == [(None, "a"), ("002", "b"), ("003", "c")]
    assert one(spark, "a b key c d", T.kwic(T.tokens("t"), "key", 1, 1)) == "b key c" and one(spark, "a b", T.kwic(T.tokens("t"), "key")) is None


def test_quality_needs_eight_tokens(spark):
    good, total = T.ocr_quality(T.tokens("t"))
    assert one(spark, "one two", good) is None
    assert one(spark, "one two three 4 five six seven eight", F.struct(good.alias("g"), total.alias("n"))).asDict() == {"g": 7, "n": 8}


def test_digits_year_and_compact(spark):
    assert one(spark, "۱۲٣", T.digits("t")) == "123"
    assert one(spark, "0852Author", T.year_of("t", "([0-9]{4})[A-Z]")) == 852 and one(spark, "Author", T.year_of("t", "([0-9]{4})[A-Z]", F.lit(9999))) == 9999
    number, same = T.compact("t")
    assert one(spark, "12", number) == 12 and one(spark, "12.3", number) is None and one(spark, "7#9", same) == "7#9"
