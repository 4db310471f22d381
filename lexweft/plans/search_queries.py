"""Queries for filters (P), full-text search (Q), record fetch and lookups, over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import LATIN
from ..operators import cite as C, match as M, search as S
from ._register import clean_sql, posts_sql, query, table, tok_sql

POSTS, CLEAN = posts_sql(), clean_sql()


def _posts(spark, sf):
    return S.postings(table(spark, sf, "documents"))


#: The library's tables as search sees them: documents are units, sources works, nations their meta data, orders link units to
#: hadith, which customers stand for, lines are references to verses, toxic labels to a concept.
LIBRARY = f"""num AS (SELECT *, CAST(replace(source, 'src', '') AS INTEGER) AS k FROM documents),
    units AS (SELECT doc_id AS uid, source AS work, 'author' || k % 5 AS author, lang, CASE WHEN k % 4 = 0 THEN 'attributed' ELSE 'own' END AS attribution, CASE WHEN k % 3 = 0 THEN 'typed' ELSE 'ocr' END AS source_type, doc_id % 7 <> 0 AS primary_version, text, n_chars FROM num),
    work_meta AS (SELECT 'src' || n_nationkey AS work, CASE WHEN n_nationkey % 7 > 0 THEN 100 + 40 * n_nationkey END AS death, n_name AS title FROM nation),
    unit_conf AS (SELECT doc_id AS uid, ['unmatched', 'divergent', 'partial', 'corroborated', 'verified'][n_chars % 5 + 1] AS level FROM documents WHERE doc_id % 3 > 0),
    unit_loc AS (SELECT doc_id AS uid, doc_id % 4 AS vol, CASE WHEN doc_id % 2 = 0 THEN n_chars % 100 END AS page_before, doc_id % 40 AS head FROM documents), heads AS (SELECT item_id AS head, substr(text, 1, 20) AS heading FROM benchmark),
    unit_reading AS (SELECT page_id AS uid, html AS reading FROM pages), verse_refs AS (SELECT l_orderkey AS uid, l_linenumber AS sura, l_partkey % 5 AS aya, CASE l_returnflag WHEN 'N' THEN 'cited' WHEN 'R' THEN 'lemma' ELSE 'verse' END AS how FROM lineitem),
    concept_refs AS (SELECT doc_id AS uid FROM labels WHERE toxic = 1), hadith_units AS (SELECT o_orderkey AS uid, o_custkey AS hadith_id FROM orders),
    hadith AS (SELECT c_custkey AS hadith_id, lower(c_name) AS narrator_key, c_mktsegment AS caliph, 'grade ' || c_mktsegment AS grades, c_acctbal > 0 AS agreed_upon, CASE WHEN c_nationkey > 0 THEN c_nationkey % 13 END AS weakest_rank, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS parallel_group FROM customer)"""


def library(spark, sf):
    k = F.replace("source", F.lit("src"), F.lit("")).cast("int")
    docs = table(spark, sf, "documents")
    units = docs.select(
        F.col("doc_id").alias("uid"), F.col("source").alias("work"), F.concat(F.lit("author"), (k % 5).cast("string")).alias("author"), "lang", F.when(k % 4 == 0, "attributed").otherwise("own").alias("attribution"),
        F.when(k % 3 == 0, "typed").otherwise("ocr").alias("source_type"), (F.col("doc_id") % 7 != 0).alias("primary_version"), "text",
    )
    n, l, o, c = (table(spark, sf, t) for t in ("nation", "lineitem", "orders", "customer"))
    level = F.element_at(F.array(*[F.lit(x) for x in S.LEVELS]), (F.col("n_chars") % 5 + 1).cast("int"))
    nothing = {f: F.lit(None).cast("int").alias(f) for f in S.LOC_FIELDS}
    loc = nothing | {"vol": (F.col("doc_id") % 4).alias("vol"), "page_before": F.when(F.col("doc_id") % 2 == 0, F.col("n_chars") % 100).alias("page_before")}
    return {
        "units": units, "postings": S.postings(docs),
        "work_meta": n.select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("work"), F.when(F.col("n_nationkey") % 7 > 0, 100 + 40 * F.col("n_nationkey")).alias("death"), F.col("n_name").alias("title")),
        "unit_conf": docs.where("doc_id % 3 > 0").select(F.col("doc_id").alias("uid"), level.alias("level")),
        "unit_loc": docs.select(F.col("doc_id").alias("uid"), *loc.values(), (F.col("doc_id") % 40).alias("head")), "heads": table(spark, sf, "benchmark").select(F.col("item_id").alias("head"), F.substring("text", 1, 20).alias("heading")),
        "unit_reading": table(spark, sf, "pages").select(F.col("page_id").alias("uid"), F.col("html").alias("reading")),
        "verse_refs": l.select(F.col("l_orderkey").alias("uid"), F.col("l_linenumber").alias("sura"), (F.col("l_partkey") % 5).alias("aya"), F.when(F.col("l_returnflag") == "N", "cited").when(F.col("l_returnflag") == "R", "lemma").otherwise("verse").alias("how")),
        "concept_refs": table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("uid"), F.lit("toxic").alias("concept")), "hadith_units": o.select(F.col("o_orderkey").alias("uid"), F.col("o_custkey").alias("hadith_id")),
        "hadith": c.select(
            F.col("c_custkey").alias("hadith_id"), F.lower("c_name").alias("narrator_key"), F.col("c_mktsegment").alias("caliph"), F.concat(F.lit("grade "), "c_mktsegment").alias("grades"), (F.col("c_acctbal") > 0).alias("agreed_upon"),
            F.when(F.col("c_nationkey") > 0, F.col("c_nationkey") % 13).alias("weakest_rank"), F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).alias("parallel_group"),
        ),
    }


def _without(t, *names):
    return {k: v for k, v in t.items() if k not in names}


# ---- filters


@query(f"WITH {LIBRARY} SELECT uid FROM units WHERE lang IN ('en', 'de') AND work IN ('src1', 'src2', 'src3') AND author IN ('author1', 'author2') AND attribution = 'own' AND primary_version")
def p1_in_filters(spark, sf):
    spec = S.QuerySpec(langs=["en", "de"], works=["src1", "src2", "src3"], authors=["author1", "author2"], attributions=["own"])
    return library(spark, sf)["units"].where(S.unit_filter(spec)).select("uid")


@query(f"WITH {LIBRARY} SELECT uid FROM units JOIN work_meta USING (work) WHERE death <= 600 AND death >= 200")
def p2_before_after(spark, sf):
    t = library(spark, sf)
    return t["units"].join(t["work_meta"], "work").where(S.citation_filter(S.QuerySpec(before=600, after=200))).select("uid")


@query(f"WITH {LIBRARY} SELECT uid FROM units LEFT JOIN unit_conf USING (uid) WHERE source_type = 'typed' OR level IN ('partial', 'corroborated', 'verified')")
def p3_min_level(spark, sf):
    t = library(spark, sf)
    return t["units"].join(t["unit_conf"], "uid", "left").where(S.citation_filter(S.QuerySpec(min_level="partial"))).select("uid")


@query(f"WITH {LIBRARY} SELECT hadith_id FROM hadith WHERE caliph = 'BUILDING' AND grades ILIKE '%e BUIL%' AND agreed_upon AND weakest_rank <= 9 UNION ALL SELECT hadith_id FROM hadith WHERE narrator_key = 'customer#000000007'")
def p4_hadith_filters(spark, sf):
    h = library(spark, sf)["hadith"]
    several = S.QuerySpec(caliph="BUILDING", graded="E buil", agreed=True, max_weakest_rank=9)
    return h.where(S.hadith_filter(several)).select("hadith_id").union(h.where(S.hadith_filter(S.QuerySpec(narrator="customer#000000007"))).select("hadith_id"))


@query(f"WITH {LIBRARY} SELECT uid FROM units WHERE uid IN (SELECT uid FROM verse_refs WHERE sura = 2 AND aya = 3 AND how IN ('lemma', 'verse')) AND uid IN (SELECT uid FROM concept_refs) OR uid IN (SELECT uid FROM verse_refs WHERE sura = 1 AND aya = 1)")
def p5_membership(spark, sf):
    t = library(spark, sf)
    some = S.members(t["verse_refs"], S.QuerySpec(verse=(2, 3), how=["lemma", "verse"])).join(t["concept_refs"].select("uid"), "uid", "left_semi")
    return t["units"].select("uid").join(some.union(S.members(t["verse_refs"], S.QuerySpec(verse=(1, 1)))), "uid", "left_semi")


@query("SELECT page_id FROM pages WHERE contains(lower(url), 'site') OR starts_with(url, 'http://')")
def p6_name_contains(spark, sf):
    return table(spark, sf, "pages").where(F.contains(F.lower("url"), F.lit("site")) | F.col("url").startswith("http://")).select("page_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, ' ' || {CLEAN} || ' ' AS c FROM documents) WHERE regexp_matches(c, ' (?:[qld]?all [qld]?rights [qld]?reserved) ')")
def p7_phrase(spark, sf):
    pattern = S.phrase_pattern("all rights reserved", "qld")
    return S.phrase_scan(table(spark, sf, "documents").select("doc_id", "text"), {"p": pattern}).select("doc_id")


BRIDGE = {"All Rights reserved": ["GENERAL public license", "idiot"], "other": ["clown"]}


@query(f"SELECT phrase, doc_id FROM (SELECT doc_id, ' ' || {CLEAN} || ' ' AS c FROM documents), (VALUES ('term', ' (?:[qld]?all [qld]?rights [qld]?reserved|general public license|idiot) '), ('longer', ' (?:[qld]?all [qld]?rights) ')) AS v(phrase, p) WHERE regexp_matches(c, p)")
def p8_term_bridge(spark, sf):
    """A query that is a term of the bridge is looked for with its synonyms; one that only holds it is not."""
    phrases = {name: S.bridged_pattern(text, BRIDGE, "qld") for name, text in (("term", "all RIGHTS reserved"), ("longer", "All rights"))}
    return S.phrase_scan(table(spark, sf, "documents").select("doc_id", "text"), phrases).select("phrase", "doc_id")


@query(f"""WITH q AS (SELECT item_id, list_distinct(list_filter({tok_sql()}, lambda w: length(w) >= 3)) AS w FROM benchmark), d AS (SELECT doc_id, {CLEAN} AS t FROM documents)
    SELECT item_id, doc_id FROM q, d WHERE len(w) > 0 AND len(list_filter(w, lambda x: contains(t, x))) >= ceil(len(w) / 2)""")
def p10_candidate_terms(spark, sf):
    """Documents in which at least half of a passage's words occur, be it within others: a cheap test before a score."""
    words = F.array_distinct(F.filter(T.tokens("text"), lambda w: F.length(w) >= 3))
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("q"), words.alias("w"))
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("d"), T.clean("text").alias("t"))
    return M.half_contained(d, q).select(F.col("q").alias("item_id"), F.col("d").alias("doc_id"))


_LIC = "(SELECT doc_id, t, ws, i, CASE WHEN i > 1 THEN length(array_to_string(ws[1:i - 1], ' ')) + 1 ELSE 0 END AS ps FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT doc_id, t, string_split(t, ' ') AS ws FROM (SELECT doc_id, " + CLEAN + " AS t FROM documents))) WHERE ws[i] = 'license')"


@query(f"""WITH n AS (SELECT doc_id, ' ' || substr(t, greatest(ps - 150, 0) + 1, ps - greatest(ps - 150, 0)) || ' ' || substr(t, ps + 8, 150) || ' ' AS near, i > 1 AND ws[i - 1] = 'public' AS several FROM {_LIC})
    SELECT doc_id AS record, CAST(count(*) AS INTEGER) AS raw, CAST(count(*) FILTER (WHERE several OR (regexp_matches(near, ' (?:under|gnu) ') AND NOT regexp_matches(near, ' (?:rights) '))) AS INTEGER) AS kept FROM n GROUP BY 1""")
def p11_sense_filter(spark, sf):
    """A word counts if within 150 characters a cue stands and no excluded word; a match of two words always does."""
    from ..operators import passages as P

    concept = P.Concept("licence", ("license", "public license"), ("under", "gnu"), ("rights",))
    return P.concept_hits(table(spark, sf, "documents"), [concept], "doc_id", "text").select("record", "raw", "kept")


# ---- full text


@query(f"SELECT uid FROM {POSTS} WHERE term IN ('rights', 'reserved') GROUP BY uid HAVING count(DISTINCT term) = 2")
def q1_all_terms(spark, sf):
    """What a user writes is normalised like the texts: capitals, marks and punctuation don't matter."""
    return S.matched(S.QuerySpec(query="RÍGHTS, reserv́ed!"), _posts(spark, sf), None)


EXPRESSIONS = {
    "phrase": '"General  Public license"', "or": "idiot OR clown", "prefix": "licens*", "not": "license NOT (rights OR idiot)", "near": "NEAR(public license, 2) rights",
    "mixed": '(rights AND "all rights" OR moron) NOT clown', "phrase_prefix": '"public lic"*',
}


@query(f"""WITH p AS {POSTS}, h AS (SELECT uid, bool_or(term = 'idiot') AS idiot, bool_or(term = 'clown') AS clown, bool_or(term = 'moron') AS moron, bool_or(term = 'license') AS license, bool_or(term = 'rights') AS rights, bool_or(starts_with(term, 'licens')) AS pre FROM p GROUP BY uid),
    gpl AS (SELECT DISTINCT a.uid FROM p a JOIN p b ON a.uid = b.uid AND b.pos = a.pos + 1 JOIN p c ON c.uid = a.uid AND c.pos = a.pos + 2 WHERE a.term = 'general' AND b.term = 'public' AND c.term = 'license'), al AS (SELECT DISTINCT a.uid FROM p a JOIN p b ON a.uid = b.uid AND b.pos = a.pos + 1 WHERE a.term = 'all' AND b.term = 'rights'),
    pl AS (SELECT DISTINCT a.uid FROM p a JOIN p b ON a.uid = b.uid AND b.pos = a.pos + 1 WHERE a.term = 'public' AND starts_with(b.term, 'lic')), nr AS (SELECT DISTINCT a.uid FROM p a JOIN p b ON a.uid = b.uid AND abs(a.pos - b.pos) - 1 <= 2 WHERE a.term = 'public' AND b.term = 'license')
    SELECT uid, 'phrase' AS how FROM gpl UNION ALL SELECT uid, 'or' FROM h WHERE idiot OR clown UNION ALL SELECT uid, 'prefix' FROM h WHERE pre UNION ALL SELECT uid, 'not' FROM h WHERE license AND NOT (rights OR idiot) UNION ALL SELECT uid, 'near' FROM h WHERE rights AND uid IN (SELECT uid FROM nr)
    UNION ALL SELECT uid, 'mixed' FROM h WHERE (rights AND uid IN (SELECT uid FROM al) OR moron) AND NOT clown UNION ALL SELECT uid, 'phrase_prefix' FROM pl""")
def q2_raw_syntax(spark, sf):
    """Queries in the search language: phrases, prefixes, OR, NOT, NEAR, brackets."""
    p = _posts(spark, sf)
    out = None
    for name, text in EXPRESSIONS.items():
        part = S.match_expression(p, text).select("uid", F.lit(name).alias("how"))
        out = part if out is None else out.union(part)
    return out


#: A word's root under the Latin profile: its stem's consonants.
_ROOT_SQL = "regexp_replace(CASE WHEN length(s) >= 4 AND s[-1] = 's' THEN s[:-2] ELSE s END, '[aeiouy]', '', 'g')"
ROOTS = f"(SELECT term, {_ROOT_SQL} AS root FROM (SELECT term, regexp_replace(term, '^(?:un|re)?(.{{3,}})$', '\\1') AS s FROM (SELECT DISTINCT term FROM {POSTS}) WHERE length(term) >= 3) WHERE {_ROOT_SQL} <> '')"


def _analysis(spark, sf):
    root = F.regexp_replace(T.stem(F.col("term"), LATIN), "[aeiouy]", "")
    analyse = F.when((F.length("term") >= 3) & (root != ""), F.array(root)).otherwise(F.array().cast("array<string>"))
    return S.root_analysis(_posts(spark, sf), analyse)


def _roots(spark, sf):
    return S.root_postings(_posts(spark, sf), _analysis(spark, sf))


@query(f"WITH r AS (SELECT uid, root FROM {POSTS} p JOIN {ROOTS} x ON x.term = p.term) SELECT uid FROM r GROUP BY uid HAVING bool_or(root IN ('dt', 'dut')) AND bool_or(root IN ('mrn', 'mrun'))")
def q3_root_groups(spark, sf):
    """Documents with a word of each of two roots, in any of a root's forms."""
    spec = S.QuerySpec(roots=["dt", "mrn"])
    return S.matched(spec, _posts(spark, sf), _roots(spark, sf), variants=lambda r: [r, r[:-1] + "u" + r[-1]])


@query(f"WITH r AS (SELECT uid, pos, root FROM {POSTS} p JOIN {ROOTS} x ON x.term = p.term), p AS (SELECT * FROM r WHERE root IN ('dt', 'mrn', 'clwn')) SELECT DISTINCT a.uid FROM p a JOIN p b ON b.uid = a.uid JOIN p c ON c.uid = a.uid WHERE a.root = 'dt' AND b.root = 'mrn' AND c.root = 'clwn' AND greatest(a.pos, b.pos, c.pos) - least(a.pos, b.pos, c.pos) - 1 <= 40")
def q4_near(spark, sf):
    """Words of three roots close to each other."""
    return S.matched(S.QuerySpec(roots=["dt", "mrn", "clwn"], near=40), _posts(spark, sf), _roots(spark, sf))


BM25 = f"""p AS {POSTS}, l AS (SELECT uid, count(*) AS len FROM p GROUP BY uid), s AS (SELECT count(*) AS docs, avg(len) AS avg_len FROM l),
    tf AS (SELECT uid, term, count(*) AS tf FROM p WHERE term IN ('license', 'rights', 'idiot') GROUP BY uid, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    bm AS (SELECT uid, sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS score FROM tf JOIN df USING (term) JOIN l USING (uid), s GROUP BY uid)"""


@query(f"WITH {BM25} SELECT uid, round(score, 6) AS score FROM bm")
def q5_bm25(spark, sf):
    return S.bm25(_posts(spark, sf), ["license", "rights", "idiot"]).select("uid", F.round("score", 6).alias("score"))


#: All layers joined to the units that have a word, a verse or a concept.
_JOINED = "LEFT JOIN work_meta USING (work) LEFT JOIN unit_conf USING (uid) LEFT JOIN unit_loc USING (uid) LEFT JOIN heads USING (head) LEFT JOIN unit_reading USING (uid) LEFT JOIN (SELECT uid, min(hadith_id) AS hadith_id FROM hadith_units JOIN hadith USING (hadith_id) GROUP BY uid) h USING (uid) LEFT JOIN hadith USING (hadith_id)"
_LOC = "concat_ws(' ', 'vol=' || vol, 'page=' || (page_before + 1))"


@query(f"WITH {LIBRARY} SELECT uid, work, author, death, title, level, {_LOC} AS loc, heading, hadith_id, caliph, md5(coalesce(reading, text)) AS shown FROM units {_JOINED} WHERE primary_version AND uid IN (SELECT uid FROM {POSTS} WHERE term = 'license')")
def q6_hit_assembly(spark, sf):
    """All units with a word, with everything that the eight layers say of each."""
    out = S.assembled(S.QuerySpec(query="License"), library(spark, sf))
    return out.select("uid", "work", "author", "death", "title", "level", "loc", "heading", "hadith_id", "caliph", F.md5(F.col("shown").cast("binary")).alias("shown"))


@query(f"""WITH {LIBRARY}, {BM25}, f AS (SELECT u.uid, death, level, round(coalesce(score, 0), 9) AS score FROM units u {_JOINED} LEFT JOIN bm USING (uid) WHERE u.lang <> 'es' AND (source_type = 'typed' OR level IN ('divergent', 'partial', 'corroborated', 'verified')) AND death <= 800
    AND uid IN (SELECT uid FROM p WHERE term IN ('rights', 'idiot') UNION SELECT uid FROM p WHERE term = 'license')) SELECT uid, death, level, row_number() OVER (ORDER BY score DESC, uid) AS rank FROM f ORDER BY score DESC, uid LIMIT 15""")
def q6_search(spark, sf):
    """The search front end: a query in the search language, filters, relevance, the first hits."""
    spec = S.QuerySpec(query="rights OR idiot OR license", raw=True, langs=["en", "de", "fr"], all_versions=True, min_level="divergent", before=800, limit=15)
    return S.search(spec, library(spark, sf)).select("uid", "death", "level", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {LIBRARY}, f AS (SELECT u.uid, death, (SELECT array_to_string(list_sort(list(DISTINCT how)), ',') FROM verse_refs v WHERE v.uid = u.uid AND sura = 2 AND aya = 3) AS verse_how FROM units u {_JOINED} WHERE primary_version AND uid IN (SELECT uid FROM verse_refs WHERE sura = 2 AND aya = 3 AND how IN ('cited', 'lemma')))
    SELECT uid, death, verse_how, row_number() OVER (ORDER BY coalesce(death, 9999), uid) AS rank FROM f ORDER BY coalesce(death, 9999), uid LIMIT 40""")
def q6_verse_chrono(spark, sf):
    """Units that have a verse in some of its ways, the oldest first."""
    spec = S.QuerySpec(verse=(2, 3), how=["cited", "lemma"], chrono=True, limit=40)
    return S.search(spec, _without(library(spark, sf), "postings")).select("uid", "death", "verse_how", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {LIBRARY} SELECT count(DISTINCT uid) AS total FROM units WHERE primary_version AND uid IN (SELECT uid FROM hadith_units JOIN hadith USING (hadith_id) WHERE caliph = 'BUILDING' AND agreed_upon) AND uid IN (SELECT uid FROM {POSTS} WHERE term = 'the')")
def q7_total(spark, sf):
    return S.total(S.QuerySpec(query="the", caliph="BUILDING", agreed=True), library(spark, sf))


@query(f"WITH {LIBRARY}, f AS (SELECT author, work, attribution, count(DISTINCT uid) AS n FROM units WHERE primary_version AND uid IN (SELECT uid FROM {POSTS} WHERE term IN ('idiot', 'license')) GROUP BY ALL) SELECT *, sum(n) OVER (PARTITION BY author) AS total FROM f")
def q8_by_author(spark, sf):
    return S.by_author(S.QuerySpec(query="idiot OR license", raw=True), library(spark, sf))


@query(f"WITH {LIBRARY} SELECT h.hadith_id, h.narrator_key FROM hadith h JOIN hadith g ON g.parallel_group = h.parallel_group WHERE g.hadith_id = 17")
def q9_parallels(spark, sf):
    return S.parallels(library(spark, sf)["hadith"], 17).select("hadith_id", "narrator_key")


@query(f"WITH {LIBRARY} SELECT uid, array_to_string(list_sort(list(DISTINCT how)), ',') AS verse_how FROM verse_refs WHERE sura = 1 AND aya = 2 GROUP BY uid")
def q10_how_list(spark, sf):
    return S.how_list(library(spark, sf)["verse_refs"], 1, 2)


@query(f"WITH {LIBRARY} SELECT uid, md5(coalesce(reading, text)) AS reading, md5(text) AS ocr FROM units LEFT JOIN unit_reading USING (uid) WHERE uid IN (SELECT uid FROM concept_refs)")
def q11_reading_overlay(spark, sf):
    """The best reading in place of the text, unless the raw one is asked for."""
    t = _without(library(spark, sf), "postings", "hadith")
    shown = lambda ocr: S.assembled(S.QuerySpec(concept="toxic", all_versions=True, ocr=ocr), t).select("uid", F.md5(F.col("shown").cast("binary")).alias("ocr" if ocr else "reading"))
    return shown(False).join(shown(True), "uid")


@query(f"""WITH c AS (SELECT doc_id, source, ' ' || {CLEAN} || ' ' AS c FROM documents), h AS (SELECT 'rights' AS phrase, doc_id, source, c, instr(c, ' all rights reserved ') AS ps, 21 AS n FROM c WHERE contains(c, ' all rights reserved ') UNION ALL SELECT 'gpl', doc_id, source, c, instr(c, ' general public license '), 24 FROM c WHERE contains(c, ' general public license '))
    SELECT phrase, source, works AS n, doc_id, trim(substr(c, greatest(ps - 60, 1), ps + n + 60 - greatest(ps - 60, 1))) AS context FROM (SELECT *, count(*) OVER (PARTITION BY phrase, source) AS works, row_number() OVER (PARTITION BY phrase ORDER BY doc_id) AS r FROM h) WHERE r <= 20""")
def q12_phrase_scan(spark, sf):
    """Two phrases in one pass without an index: hits by work, and the first twenty with their context."""
    phrases = {"rights": S.phrase_pattern("all rights reserved"), "gpl": S.phrase_pattern("general public license")}
    return S.phrase_contexts(table(spark, sf, "documents"), phrases, "source", "doc_id")


#: Documents as records with page marks for their line ends; an id names its source as folder. Phrases are asked of every record.
_RECORDS = """SELECT 'urn:lib:' || source || '.book:' || doc_id AS id, source AS folder, replace(text, chr(10), ' PageV02P0' || (10 + doc_id % 80) || ' ') AS text, CASE WHEN lang = 'es' THEN ['a', 'b'] END AS hemistichs, doc_id % 3 AS vol, CASE WHEN doc_id % 5 > 0 THEN n_chars % 90 END AS page_before, doc_id AS seq FROM documents"""
_PHRASES = "CASE doc_id % 4 WHEN 0 THEN 'all Rights, reserved' WHEN 1 THEN 'Public license' WHEN 2 THEN '' END"


def _records(spark, sf):
    d = table(spark, sf, "documents")
    urn = F.concat(F.lit("urn:lib:"), "source", F.lit(".book:"), F.col("doc_id").cast("string"))
    mark = F.concat(F.lit(" PageV02P0"), (10 + F.col("doc_id") % 80).cast("string"), F.lit(" "))
    return d.select(
        urn.alias("id"), F.col("source").alias("folder"), F.replace("text", F.lit("\n"), mark).alias("text"), F.when(F.col("lang") == "es", F.array(F.lit("a"), F.lit("b"))).alias("hemistichs"),
        (F.col("doc_id") % 3).cast("int").alias("vol"), F.when(F.col("doc_id") % 5 > 0, F.col("n_chars") % 90).cast("int").alias("page_before"), F.col("doc_id").alias("seq"), "doc_id",
    )


@query(rf"""WITH d AS (SELECT *, doc_id % 3 AS v, CASE WHEN doc_id % 5 > 0 THEN n_chars % 90 END AS pb, 11 + doc_id % 80 AS nxt, string_split(text, chr(10)) AS parts, {clean_sql(_PHRASES)} AS q, {_PHRASES} AS phrase FROM documents),
    s AS (SELECT doc_id, i, CASE WHEN i = 1 THEN v || ':' || (pb + 1) ELSE '2:' || nxt END AS page, {clean_sql('parts[i]')} AS t, q FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM d)),
    a AS (SELECT doc_id, list(page ORDER BY i) AS pages, list(page ORDER BY i) FILTER (WHERE contains(t, q)) AS hit, trim(string_agg(nullif(t, ''), ' ' ORDER BY i)) AS whole FROM s GROUP BY doc_id, q),
    u AS (SELECT doc_id, i, page, t, q, trim(string_agg(nullif(t, ''), ' ') OVER (PARTITION BY doc_id ORDER BY i)) AS upto FROM s), x AS (SELECT doc_id, arg_min(page, i) FILTER (WHERE contains(t, split_part(q, ' ', 1))) AS start, arg_min(page, i) FILTER (WHERE contains(coalesce(upto, ''), q)) AS stop FROM u GROUP BY doc_id),
    k AS (SELECT d.*, pages, hit, start, stop, CASE WHEN lang = 'es' THEN 'verse' WHEN pb IS NULL THEN 'locator' WHEN q = '' THEN 'pages' WHEN len(hit) > 0 THEN 'on' WHEN stop IS NOT NULL THEN 'across' ELSE 'missing' END AS kind FROM d JOIN a USING (doc_id) JOIN x USING (doc_id))
    SELECT 'urn:lib:' || source || '.book:' || doc_id AS id, phrase, kind, CASE WHEN kind IN ('verse', 'locator') THEN concat_ws(' ', 'vol=' || v, 'seq=' || doc_id) WHEN kind = 'pages' THEN pages[1] || ' to ' || pages[-1] WHEN kind = 'on' THEN array_to_string(hit, ', ') WHEN kind = 'across' THEN coalesce(start, '?') || '-' || stop ELSE '' END AS loc FROM k
    UNION ALL SELECT 'urn:lib:none.book:1', 'x', 'absent', ''""")
def q13_cite(spark, sf):
    """Each record by its id, and the page or pages of a phrase in it; one id that isn't there."""
    records = _records(spark, sf)
    phrase = F.when(F.col("doc_id") % 4 == 0, "all Rights, reserved").when(F.col("doc_id") % 4 == 1, "Public license").when(F.col("doc_id") % 4 == 2, "")
    wanted = records.select("id", phrase.alias("phrase")).union(spark.createDataFrame([("urn:lib:none.book:1", "x")], "id string, phrase string"))
    return C.cite(records.drop("doc_id"), wanted)


@query(f"SELECT root, count(*) AS words, min(term) AS first_word FROM {ROOTS} GROUP BY root")
def q14_root_analysis(spark, sf):
    """Each distinct word is analysed once; here by a rule of the Latin profile, the consonants of its stem."""
    return _analysis(spark, sf).groupBy("root").agg(F.count("*").alias("words"), F.min("term").alias("first_word"))


@query(f"SELECT term, count(*) AS freq FROM {POSTS} GROUP BY term")
def q15_vocabulary(spark, sf):
    return S.vocabulary(_posts(spark, sf))


@query(f"""WITH {LIBRARY}, h AS (SELECT uid, count(*) AS n FROM {POSTS} WHERE term IN ('license', 'idiot', 'rights') GROUP BY uid), t AS (SELECT u.work, u.uid, n, row_number() OVER (PARTITION BY u.work ORDER BY n DESC, u.uid) AS rank FROM units u JOIN h USING (uid) WHERE u.work IN ('src1', 'src5', 'src7', 'src12'))
    SELECT t.work, uid, n, rank, death, title FROM t LEFT JOIN work_meta USING (work) WHERE rank <= 3""")
def q16_lookup(spark, sf):
    """A concept's passages in some works, three of each, the oldest work first."""
    t = library(spark, sf)
    n = _posts(spark, sf).where(F.col("term").isin("license", "idiot", "rights")).groupBy("uid").agg(F.count("*").alias("n"))
    index = t["units"].select("uid", "work").join(n, "uid")
    return S.lookup(index, t["work_meta"], ["src1", "src5", "src7", "src12"], 3, [F.desc("n"), F.col("uid")]).select("work", "uid", "n", "rank", "death", "title")


@query(f"WITH {LIBRARY} SELECT t.work, record, kept, rank, death FROM (SELECT u.work, r.record, kept, row_number() OVER (PARTITION BY u.work ORDER BY kept DESC, record) AS rank FROM (SELECT doc_id AS record, len(list_filter(string_split({CLEAN}, ' '), lambda w: w = 'idiot')) AS kept FROM documents) r JOIN units u ON u.uid = r.record WHERE kept > 0) t LEFT JOIN work_meta USING (work) WHERE rank <= 2")
def q16_concept_lookup(spark, sf):
    from ..operators import passages as P

    hits = P.concept_hits(table(spark, sf, "documents"), [P.Concept("insult", ("idiot",))], "doc_id", "text")
    out = P.concept_lookup(hits, table(spark, sf, "documents"), library(spark, sf)["work_meta"], "insult", "source", "doc_id", 2)
    return out.select("work", "record", "kept", "rank", "death")
