"""Queries for the text functions (F), filters (P) and record readers, over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import LATIN
from ._register import CRC_TABLE, clean_sql, crc_sql, norm_sql, query, stems_sql, table, tok_sql, toks_sql

FOLD, CLEAN = norm_sql(), clean_sql()


@query(f"SELECT doc_id, md5({FOLD}) AS norm_md5 FROM documents")
def f1_norm(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.norm("text").cast("binary")).alias("norm_md5"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '([\p{L}]{2,})', 1)) AS n_words, array_to_string(list_slice(regexp_extract_all(text, '([\p{L}]{2,})', 1), 1, 5), ' ') AS head FROM documents")
def f2_words(spark, sf):
    w = T.words("text", least=2)
    return table(spark, sf, "documents").select("doc_id", F.size(w).cast("long").alias("n_words"), F.array_join(F.slice(w, 1, 5), " ").alias("head"))


@query("""WITH r AS (SELECT DISTINCT lower(p_brand) AS b FROM part), v AS (SELECT b, replace(b, '#', 'ـ') AS token, unnest(list_distinct(list_append(list_transform(list_filter(range(1, length(b) + 1), lambda i: contains('aeiou', substr(b, i, 1))), lambda i: substr(b, 1, i - 1) || 'ـ' || substr(b, i + 1)), b))) AS variant FROM r) SELECT b AS root, token, variant FROM v""")
def f3_root_token(spark, sf):
    r = table(spark, sf, "part").select(F.lower("p_brand").alias("root")).distinct()
    return r.select("root", T.root_token("root").alias("token"), F.explode(T.root_variants("root", weak="aeiou")).alias("variant"))


@query(f"SELECT doc_id, md5({CLEAN}) AS clean_md5, length({CLEAN}) AS n FROM documents")
def f4_clean(spark, sf):
    c = T.clean("text")
    return table(spark, sf, "documents").select("doc_id", F.md5(c.cast("binary")).alias("clean_md5"), F.length(c).cast("long").alias("n"))


@query(r"SELECT page_id, md5(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>|[#|*~]+', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))) AS text_md5 FROM pages")
def f5_clean_markers(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(T.clean_markup("html", r"<[^>]*>|[#|*~]+").cast("binary")).alias("text_md5"))


@query(f"SELECT stem, count(*) AS n FROM (SELECT unnest({stems_sql()}) AS stem FROM documents) GROUP BY stem")
def f6_stem(spark, sf):
    return table(spark, sf, "documents").select(F.explode(T.stems("text")).alias("stem")).groupBy("stem").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, len({toks_sql()}) AS n_content FROM documents")
def f7_toks(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(T.content(T.tokens("text"), LATIN.stop)).cast("long").alias("n_content"))


@query(f"""WITH {CRC_TABLE}, g AS (SELECT item_id, unnest(list_distinct(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))) AS g FROM (SELECT item_id, {toks_sql()} AS t FROM benchmark))
    SELECT item_id, count(*) AS n_shingles, sum(n) AS total FROM (SELECT DISTINCT item_id, {crc_sql('g')} AS n FROM g, crc) GROUP BY item_id""")
def f8_shingles(spark, sf):
    """Sets of crc32 sums of runs of three content words."""
    s = table(spark, sf, "benchmark").select("item_id", T.shingles(T.content(T.tokens("text"), LATIN.stop), 3).alias("s")).where(F.size("s") > 0)
    return s.select("item_id", F.size("s").cast("long").alias("n_shingles"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query(r"SELECT n_nationkey, trim(regexp_replace(replace(replace(' ' || replace(trim(regexp_replace(lower(n_name), '[^\p{L}]+', ' ', 'g')), ' ', '  ') || ' ', ' united ', ' un '), ' kingdom ', ' k '), ' +', ' ', 'g')) AS name_key FROM nation")
def f9_name_norm(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", T.name_norm("n_name", [("united", "un"), ("kingdom", "k")]).alias("name_key"))


@query(r"""SELECT conv_id, turn, CASE WHEN contains(text, chr(10)) THEN replace(text, chr(10), ' / ') WHEN turn % 2 = 0 THEN text || ' ' || role ELSE coalesce(text, '') END AS flat FROM conversations""")
def f12_flat(spark, sf):
    """Half lines with ` / `, a structured text without its language and edition, or the plain text."""
    rest = F.when(F.col("turn") % 2 == 0, F.to_json(F.struct(F.lit("en").alias("lang"), F.lit("first").alias("edition"), F.struct(F.col("text").alias("source"), F.col("role").alias("note")).alias("body"))))
    c = table(spark, sf, "conversations").withColumns({"half": F.when(F.contains("text", F.lit("\n")), F.split("text", "\n")), "odd": rest})
    return c.select("conv_id", "turn", T.flat("half", T.flat_json("odd"), "text", F.lit("")).alias("flat"))


@query(rf"""WITH s AS (SELECT doc_id, coalesce(text, '') AS t, instr(coalesce(text, ''), ' * ') AS ps, regexp_extract(coalesce(text, ''), '(?s)^.*?(?:public license|rights)(?:.{{0,12}}?(?:reserved))?', 0) AS head FROM documents)
    SELECT doc_id, CASE WHEN ps > 0 THEN 'marker' WHEN head <> '' THEN 'prophet_mention' ELSE 'none' END AS how, md5(trim(CASE WHEN ps > 0 THEN substr(t, 1, ps - 1) WHEN head <> '' THEN head ELSE '' END, ' ')) AS isnad, md5(trim(CASE WHEN ps > 0 THEN substr(t, ps + 3) WHEN head <> '' THEN substr(t, length(head) + 1) ELSE t END, ' ')) AS matn FROM s""")
def f13_split(spark, sf):
    """A text cut at its marker, else after a mention with a word that may follow within twelve characters."""
    s = T.split_chain("text", " * ", "public license|rights", "reserved")
    return table(spark, sf, "documents").select("doc_id", s.alias("s")).select("doc_id", "s.how", F.md5(F.col("s.isnad").cast("binary")).alias("isnad"), F.md5(F.col("s.matn").cast("binary")).alias("matn"))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' ELSE 'other' END AS label FROM documents")
def f15_label_map(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.labelled("lang", {"en": "English", "de": "German", "fr": "French"}, "other").alias("label"))


@query(r"SELECT doc_id, len(m) AS n_grades, array_to_string(m, ';') AS grades FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), 'version ([0-9]+)', 1) AS m FROM documents) WHERE len(m) > 0")
def f16_inline_extract(spark, sf):
    m = T.extracted("text", "version ([0-9]+)")
    return table(spark, sf, "documents").select("doc_id", F.size(m).cast("long").alias("n_grades"), F.array_join(m, ";").alias("grades")).where("n_grades > 0")


@query(r"SELECT doc_id, array_to_string(list_slice(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+[.!?]', 0), 1, 5), '|') AS first_five FROM documents")
def f17_first_five(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.extracted("text", r"[A-Z][a-z]+[.!?]", 0, 5), "|").alias("first_five"))


CUES = [("licence", "licensed under|License"), ("rights", "[Rr]ights reserved"), ("contact", "@"), ("shout", "!!"), ("table", r" \| ")]
_FOUND = ", ".join(f"{{'at': CASE WHEN regexp_matches(text, '{lit}') THEN length(regexp_extract(text, '(?s)^(.*?)(?:{lit})', 1)) + 1 ELSE 0 END, 'label': '{lab}'}}" for lab, lit in CUES)


@query(f"SELECT doc_id, CASE WHEN c = '' AND regexp_matches(text, '^[A-E]') THEN 'cross_reference' ELSE c END AS cues FROM (SELECT doc_id, text, array_to_string(list_transform(list_sort(list_filter([{_FOUND}], lambda s: s.at > 0)), lambda s: s.label), ',') AS c FROM documents)")
def f18_cues(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.cues("text", CUES, "^[A-E]").alias("cues"))


CLASSES = [("table", r" \| .* \| "), ("shouting", "!! "), ("symbols", r"[#*$%&]{3}"), ("licence", "licensed under|rights reserved"), ("contact", "@")]


@query("SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{c}'" for c, p in CLASSES) + " ELSE 'unclassified' END AS class FROM documents")
def f20_classify(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.first_match("text", CLASSES, "unclassified").alias("class"))


NEG, POS = [("weak", "pathetic|worthless"), ("unknown", "clown|moron")], [("sound", "licensed under"), ("fair", "rights reserved|reserved")]
RESERVE, SUPPORT, DISPUTED, CHAIN = "General Public", r"@mail[0-9]", r"\+1 ", "under CC BY"
_CASE = lambda rules: "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{c}'" for c, p in rules) + " END"


@query(f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{SUPPORT}') THEN 'sound_by_support' WHEN regexp_matches(text, '\\+1 ') THEN 'disputed_narrator'
    WHEN neg IS NOT NULL AND pos IS NOT NULL THEN 'disputed' ELSE coalesce(neg, pos, 'unclassified') END AS class
    FROM (SELECT doc_id, text, CASE WHEN pos IS NOT NULL AND regexp_matches(text, '{CHAIN}') THEN 'fair' ELSE pos END AS pos, CASE WHEN neg IS NULL AND pos IS NOT NULL AND regexp_matches(text, '{RESERVE}') THEN 'weak' ELSE neg END AS neg
          FROM (SELECT doc_id, text, {_CASE(NEG)} AS neg, {_CASE(POS)} AS pos FROM documents))""")
def f21_verdict_class(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.verdict_class("text", NEG, POS, RESERVE, SUPPORT, DISPUTED, CHAIN).alias("class"))


NAMES = [("the public one", "[Pp]ublic", ["P", "GPL"]), ("the lamp", "lamp|License", ["L", "GPL"]), ("rights", "rights", ["R"])]
_SCAN = lambda t: "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({t}, '{p}') THEN {{'name': '{n}', 'keys': [{', '.join(repr(k) for k in ks)}]}} END" for n, p, ks in NAMES) + "], lambda x: x IS NOT NULL)"


@query(f"""WITH s AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract(coalesce(text, ''), '(?s)^(.*?)(?:under|reserved)', 1) AS head, regexp_matches(coalesce(text, ''), 'under|reserved') AS cut FROM documents), f AS (SELECT doc_id, t, CASE WHEN cut AND len({_SCAN('head')}) > 0 THEN {_SCAN('head')} ELSE {_SCAN('t')} END AS f FROM s)
    SELECT doc_id, CASE WHEN regexp_matches(t, '^[A-E]') THEN 'hadith' ELSE 'chain' END AS scope, array_to_string(list_transform(f, lambda x: x.name), ';') AS named, array_to_string(list_sort(list_distinct(flatten(list_transform(f, lambda x: x.keys)))), ',') AS collections FROM f""")
def f22_scope_names(spark, sf):
    """What a verdict speaks of, and the collections it names: before the chain's cue, if it names any there."""
    n = T.named("text", NAMES, "under|reserved")
    out = table(spark, sf, "documents").select("doc_id", T.first_match(T.text("text"), [("hadith", "^[A-E]")], "chain").alias("scope"), n.alias("n"))
    return out.select("doc_id", "scope", F.array_join("n.names", ";").alias("named"), F.array_join(F.array_sort("n.collections"), ",").alias("collections"))


@query(f"""WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN NULL ELSE {tok_sql()} END AS own FROM conversations), n AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t FROM c),
    p AS (SELECT *, lag(t) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM n) SELECT conv_id, turn, len(t) AS n_names, CASE WHEN len(t) > 0 AND len(p) > 0 THEN list_has_any(t, p) END AS same FROM p""")
def f25_same_as_before(spark, sf):
    """Whether a turn has a word of the turn before; one that says `of the same` (the assistant's) has the words of the last other turn."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    own = F.when(F.col("role") != "assistant", T.tokens("text"))
    c = table(spark, sf, "conversations").withColumn("own", own)
    c = c.withColumn("t", F.last("own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("p", F.lag("t").over(w))
    return c.select("conv_id", "turn", F.when(F.col("t").isNotNull(), F.size("t")).cast("long").alias("n_names"), T.same_names(F.col("t"), F.col("p")).alias("same"))


@query(f"""WITH d AS (SELECT doc_id, {tok_sql()} AS t FROM documents), f AS (SELECT doc_id, t, list_position(list_transform(t, lambda w: contains(w, 'licens')), true) AS p FROM d)
    SELECT doc_id, array_to_string(list_slice(t, greatest(p - 12, 1), p + 14), ' ') AS kwic FROM f WHERE p > 0""")
def f27_kwic(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.kwic(T.tokens("text"), "licens").alias("kwic")).where("kwic IS NOT NULL")


@query(r"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts, doc_id % 4 AS v, n_chars % 90 AS pb FROM documents) SELECT doc_id, seg, CASE WHEN seg = 1 THEN v ELSE 3 END AS vol, CASE WHEN seg = 1 THEN pb + 1 ELSE 8 + doc_id % 50 END AS page, length(parts[seg]) AS n FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS seg FROM d)""")
def f29_page_segments(spark, sf):
    """Texts with a page mark at each line's end, cut there; what follows the mark of page P is on page P + 1."""
    marked = F.replace(T.text("text"), F.lit("\n"), F.concat(F.lit("PageV03P00"), (7 + F.col("doc_id") % 50).cast("string"), F.lit(" ")))
    pages = T.exact_pages(marked, F.col("doc_id") % 4, F.col("n_chars") % 90)
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(pages).alias("p", "s"))
    return d.select("doc_id", (F.col("p") + 1).cast("long").alias("seg"), F.col("s.vol").cast("long").alias("vol"), F.col("s.page").cast("long").alias("page"), (F.length("s.text") - F.when(F.col("p") > 0, 1).otherwise(0)).cast("long").alias("n"))


@query("SELECT l_orderkey, l_linenumber, concat_ws(' ', 'order=' || l_orderkey, CASE WHEN l_linenumber > 1 THEN 'line=' || l_linenumber END, 'flag=' || l_returnflag) AS loc FROM lineitem")
def f30_locator(spark, sf):
    loc = T.locator({"order": F.col("l_orderkey"), "line": F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")), "flag": F.col("l_returnflag")})
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", loc.alias("loc"))


@query(rf"SELECT doc_id, CASE WHEN len(t) >= 8 THEN len(list_filter(t, lambda w: regexp_matches(w, '^\p{{L}}{{2,15}}$'))) END AS good, CASE WHEN len(t) >= 8 THEN len(t) END AS total FROM (SELECT doc_id, {tok_sql()} AS t FROM documents)")
def f31_ocr_quality(spark, sf):
    good, total = T.ocr_quality(T.tokens("text"))
    return table(spark, sf, "documents").select("doc_id", good.cast("long").alias("good"), total.cast("long").alias("total"))


@query(r"SELECT n_nationkey, regexp_replace(regexp_replace(trim(regexp_replace(lower(n_name), '[^\p{L}]+', ' ', 'g')), '\b(?:al|the|el|la|le|der|die|das) ', '', 'g'), '[aeiouy ]', '', 'g') AS skeleton FROM nation")
def f32_skeleton(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", T.skeleton("n_name").alias("skeleton"))


HEADINGS = [("rights", "^All rights"), ("licence", "^This work"), ("quote", "^[\"']"), ("plain", "^[A-Z]")]


@query("SELECT doc_id, CASE " + " ".join(f"""WHEN regexp_matches(text, '{p.replace("'", "''")}') THEN '{c}'""" for c, p in HEADINGS) + " ELSE 'other' END AS kind FROM documents")
def f33_heading_kind(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.first_match("text", HEADINGS, "other").alias("kind"))


@query("SELECT page_id, coalesce(try_cast(nullif(regexp_extract(url, '([0-9]{1,4})', 1), '') AS INTEGER), 9999) AS year FROM pages")
def f34_year(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.year_of("url", "([0-9]{1,4})", F.lit(9999)).alias("year"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.x') AS INTEGER) AS as_int, CASE WHEN regexp_matches(CAST(user_id AS VARCHAR), '^[0-9]{1,18}$') THEN user_id END AS compact, round(try_cast(replace(replace(CAST(value AS VARCHAR), '.', ','), ',', '.') AS DOUBLE), 6) AS as_float, try_cast(event_type AS DOUBLE) AS no_float FROM events")
def f36_lenient_cast(spark, sf):
    number, _ = T.compact(F.col("user_id").cast("string"))
    comma = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.x").try_cast("int").alias("as_int"), number.alias("compact"), F.round(T.decimal(comma), 6).alias("as_float"), T.decimal("event_type").alias("no_float"))


@query(f"WITH {CRC_TABLE} SELECT c_custkey, md5(c_name) AS md5, sha256(c_name) AS sha256, {crc_sql('c_name')} % 100000 AS entry FROM customer, crc")
def f37_hashes(spark, sf):
    b = F.col("c_name").cast("binary")
    return table(spark, sf, "customer").select("c_custkey", F.md5(b).alias("md5"), F.sha2(b, 256).alias("sha256"), T.entry_id("c_name").alias("entry"))


@query("SELECT p_partkey, translate(translate(p_name || p_size, '0123456789', '٠١٢٣٤٥٦٧٨٩'), '٠١٢٣٤٥٦٧٨٩', '0123456789') AS name FROM part")
def f39_digits(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.digits(F.translate(F.concat("p_name", F.col("p_size").cast("string")), "0123456789", "٠١٢٣٤٥٦٧٨٩")).alias("name"))


@query("""SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, coalesce(json_extract_string(props, '$.a.b'), 'none') AS nested, CAST(event_id AS VARCHAR) AS peeked, 'é ' || event_type AS dumped FROM events""")
def f40_json(spark, sf):
    """Nested values with a default; a line's id by a pattern alone; Unicode as it is in what is written."""
    line = F.to_json(F.struct(F.col("event_id").alias("id"), F.concat(F.lit("é "), "event_type").alias("t")))
    e = table(spark, sf, "events").withColumn("line", line)
    return e.select("event_id", T.json_get("props", "k", "none").alias("k"), T.json_get("props", "a.b", "none").alias("nested"), T.json_peek("line").alias("peeked"), F.regexp_extract("line", '"t":"([^"]*)"', 1).alias("dumped"))


@query(r"SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n, bool_and(regexp_matches(strftime(o_orderdate, '%Y-%m-%d'), '^\d{4}-\d{2}-\d{2}$')) AS well_formed FROM orders GROUP BY 1")
def f41_dates(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").groupBy(day.alias("day")).agg(F.count("*").alias("n"), F.bool_and(day.rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("well_formed"))


@query("SELECT c_custkey, CASE WHEN n = 'customer' THEN 'client' ELSE n END AS name FROM (SELECT c_custkey, trim(regexp_replace(lower(string_split(c_name, '#')[1]), '[^\\p{L}]+', ' ', 'g')) AS n FROM customer)")
def f10_cut_name(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", T.cut_name("c_name", "#", {"customer": "client"}).alias("name"))


@query(f"SELECT doc_id, md5(replace({CLEAN}, ' ', '')) AS plain_md5 FROM documents")
def f35_plain(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.plain("text").cast("binary")).alias("plain_md5"))
