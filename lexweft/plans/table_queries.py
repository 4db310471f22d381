"""Queries for sources (S), sinks (K), joins, aggregates (A), segmentation (U), collation (W) and the ledger (L)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import LATIN
from ..operators import catalog as A, collate as C, graph, ledger as L, match as M, names as N, search as S, segment as G, verdicts as V
from ..sources import readers, sinks
from ._register import gram_sql, posts_sql, query, table, tok_sql

# ---- sources


@query("""SELECT doc_id, n_name AS work, CASE WHEN n_regionkey = 3 OR n_name = 'NATION_7' THEN 'fa' ELSE 'l' || n_regionkey END AS lang, n_nationkey % 2 = 0 AS primary_version FROM documents JOIN nation ON source = 'src' || n_nationkey WHERE trim(text) <> '' AND NOT starts_with(source, 'src18') AND regexp_matches(lower(n_name), 'on_1|_2')""")
def s4_catalog_units(spark, sf):
    records = table(spark, sf, "documents").select("doc_id", F.col("source").alias("path"), "text")
    n = table(spark, sf, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("path"), F.col("n_name").alias("work"), F.col("n_name").alias("author"), F.concat(F.lit("l"), F.col("n_regionkey").cast("string")).alias("lang"), F.when(F.col("n_regionkey") == 3, "ganjoor").otherwise("other").alias("version"), (F.col("n_nationkey") % 2 == 0).alias("primary"))
    return A.catalog_units(records, n, persian=("ganjoor", "NATION_7"), skip=("src18",), only=("ON_1", "_2")).select("doc_id", "work", "lang", "primary_version")


_MARKED = "array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda l, i: CASE WHEN i % 7 = 1 THEN '### ' || repeat('|', CAST(1 + length(l) % 3 AS INTEGER)) || ' ' || l WHEN i % 3 = 2 THEN '~~' || l ELSE '# ' || l || ' PageV01P0' || (10 + i % 80) END), chr(10))"
_LINES = f"(SELECT doc_id, i, l FROM (SELECT doc_id, unnest(x) AS l, unnest(range(len(x))) AS i FROM (SELECT doc_id, string_split({_MARKED}, chr(10)) AS x FROM documents)))"


@query(rf"""WITH m AS (SELECT *, CASE WHEN regexp_matches(l, 'PageV\d+P\d+') THEN CAST(regexp_extract(l, '(?s)^.*PageV\d+P(\d+)', 1) AS INTEGER) END AS here FROM {_LINES}), s AS (SELECT *, last_value(here IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS page, sum(CASE WHEN trim(l, ' ') = '' OR starts_with(l, '~~') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS unit FROM m),
    u AS (SELECT doc_id, unit, max(CASE WHEN regexp_matches(l, '^### \|+') THEN length(regexp_extract(l, '^### (\|+)', 1)) END) AS level, arg_min(coalesce(page, -1), i) AS page, string_agg(regexp_replace(regexp_replace(l, '^(?:### \|+ ?|# |~~)', ''), 'Page(?:End)?V\d+P\d+|ms\d+', ' ', 'g'), ' ' ORDER BY i) AS raw FROM s WHERE trim(l, ' ') <> '' GROUP BY 1, 2)
    SELECT doc_id, unit, CASE WHEN level IS NULL THEN 'para' ELSE 'heading' END AS kind, level, CASE WHEN page >= 0 THEN page END AS page_before, md5(trim(regexp_replace(raw, '\s+', ' ', 'g'), ' ')) AS text FROM u""")
def s5_markup_units(spark, sf):
    """Documents written as marked-up text, each line a heading, a paragraph with a page mark, or more of one; and parsed."""
    def written(l, i):  # noqa: E741
        n = i + 1
        head = F.concat(F.lit("### "), F.repeat(F.lit("|"), 1 + F.length(l) % 3), F.lit(" "), l)
        return F.when(n % 7 == 1, head).when(n % 3 == 2, F.concat(F.lit("~~"), l)).otherwise(F.concat(F.lit("# "), l, F.lit(" PageV01P0"), (10 + n % 80).cast("string")))

    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.posexplode(F.transform(F.split(T.text("text"), "\n"), written)).alias("line", "value"))
    out = readers.marked_up(lines)
    return out.select(F.col("path").alias("doc_id"), "unit", "kind", "level", "page_before", F.md5(F.col("text").cast("binary")).alias("text"))


@query("""WITH v AS (SELECT source, lang, doc_id, n_chars, doc_id % 5 = 0 AS typed, CASE WHEN n_chars % 4 > 0 THEN n_chars % 4 END AS pri FROM documents), b AS (SELECT source, lang, arg_min(doc_id, r) AS doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY typed DESC, pri ASC NULLS LAST, n_chars DESC, doc_id) AS r FROM v) GROUP BY 1, 2)
    SELECT b.source, b.lang, coalesce(f.doc_id, b.doc_id) AS doc_id FROM b LEFT JOIN (SELECT source, lang, max(doc_id) AS doc_id FROM documents WHERE source = 'src3' GROUP BY 1, 2) f ON f.source = b.source AND f.lang = b.lang""")
def s15_version_choice(spark, sf):
    """The best version of each work: typed, then by priority, then the longest; of one work it is named outright."""
    d = table(spark, sf, "documents")
    forced = d.where("source = 'src3'").groupBy("source", "lang").agg(F.max("doc_id").alias("doc_id"))
    return A.best_versions(d, ["source", "lang"], F.col("doc_id") % 5 == 0, F.when(F.col("n_chars") % 4 > 0, F.col("n_chars") % 4), F.col("n_chars"), "doc_id", forced)


@query("SELECT coalesce(d.doc_id, p.page_id) AS name, CASE WHEN p.page_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'extra' WHEN d.n_chars <> length(p.html) THEN 'mismatch' ELSE 'ok' END AS state FROM documents d FULL JOIN pages p ON p.page_id = d.doc_id")
def s17_size_check(spark, sf):
    """Files that should be there against those that are: name and size."""
    expected = table(spark, sf, "documents").select(F.col("doc_id").alias("name"), F.col("n_chars").alias("size"))
    return A.size_check(expected, table(spark, sf, "pages").select(F.col("page_id").alias("name"), F.length("html").cast("long").alias("size")))


@query("SELECT o_orderkey AS place, c_custkey || '/' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE '' END AS id, o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE '' END AS number, o_orderkey % 3 = 0 AS interpolation_candidate FROM orders JOIN customer ON c_custkey = o_custkey")
def s18_renumber(spark, sf):
    """Orders with the numbers of a table that must agree on the customer; a letter after the number marks an interpolation."""
    o = table(spark, sf, "orders")
    number = F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, "a").otherwise(""))
    numbers = o.select("o_orderkey", "o_custkey", number.alias("number"))
    records = o.join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("o_orderkey", "o_custkey")
    id_of = F.concat(F.col("o_custkey").cast("string"), F.lit("/"), F.col("n_number"))
    out = A.renumbered(records, numbers, ["o_orderkey"], ["o_custkey"], "number", id_of, "first")
    return out.select(F.col("o_orderkey").alias("place"), "id", F.element_at("concordance", -1)["number"].alias("number"), "interpolation_candidate")


# ---- sinks


@query("SELECT doc_id, source, quality FROM (SELECT doc_id, source, NULL AS quality FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, NULL, quality FROM labels)")
def k4_merge(spark, sf):
    old, new = table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels").select("doc_id", "quality")
    return sinks.merged(old, new, "doc_id").select("doc_id", "source", "quality")


@query("SELECT coalesce(doc_id, page_id) AS path, CASE WHEN doc_id IS NULL THEN 'add' WHEN page_id IS NULL THEN 'drop' WHEN md5(text) <> md5(html) THEN 'refresh' ELSE 'keep' END AS action FROM documents FULL JOIN pages ON page_id = doc_id")
def k7_manifest_diff(spark, sf):
    old = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.md5(F.col("text").cast("binary")).alias("sha"))
    return sinks.manifest_diff(old, table(spark, sf, "pages").select(F.col("page_id").alias("path"), F.md5(F.col("html").cast("binary")).alias("sha")))


@query("""WITH n AS (SELECT CAST(doc_id AS VARCHAR) AS path, sha256(text) AS sha FROM documents), k AS (SELECT CAST(doc_id AS VARCHAR) AS path, sha256(text) AS sha FROM documents WHERE lang = 'fr' UNION ALL SELECT CAST(doc_id AS VARCHAR), 'other' FROM documents WHERE source = 'src2' AND lang <> 'fr')
    SELECT n.path, CASE WHEN n.sha IN (SELECT sha FROM k) OR n.path <> min(n.path) OVER (PARTITION BY n.sha) THEN 'skip' WHEN n.path IN (SELECT path FROM k) THEN 'refuse' ELSE 'place' END AS action FROM n""")
def k8_content_placement(spark, sf):
    """New files beside known ones: content that is there is skipped, a path with other content refused."""
    d = table(spark, sf, "documents")
    path, sha = F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("sha")
    known = d.where("lang = 'fr'").select(path, sha).union(d.where("source = 'src2' AND lang <> 'fr'").select(path, F.lit("other")))
    return A.placement(d.select(path, sha), known)


@query("WITH u AS (SELECT s_suppkey AS k, s_name AS name, 0 AS l FROM supplier UNION ALL SELECT c_custkey, c_name, 1 FROM customer), w AS (SELECT k, name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l DESC) AS r FROM u) WHERE r = 1) SELECT w.k, coalesce(p_brand, name) AS name FROM w LEFT JOIN part ON p_partkey = w.k")
def k9_catalog_rebuild(spark, sf):
    s, c = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    over = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_brand")
    return sinks.last_wins([s, c], "k").join(over, "k", "left").select("k", F.coalesce("p_brand", "name").alias("name"))


ROUTES = [("sites/secure", "^https://"), ("sites/plain", "^http://"), ("files", r"\.(?:html?|txt)$")]


@query("SELECT page_id, CASE " + " ".join(f"WHEN regexp_matches(url, '{p}') THEN '{d}'" for d, p in ROUTES) + " ELSE 'other' END AS dest FROM pages")
def k10_router(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.first_match("url", ROUTES, "other").alias("dest"))


# ---- joins by kind


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey")
def join_equi(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    return table(spark, sf, "orders").join(c, "o_custkey", "left").join(table(spark, sf, "nation"), "n_nationkey", "left").select("o_orderkey", "c_name", "n_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def join_anti(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(o, "c_custkey", "left_anti").select("c_custkey")


@query("SELECT o_orderkey, i.k FROM orders JOIN (SELECT c_custkey AS k, 1000 * c_custkey AS lo, 1000 * c_custkey + 200 * (c_nationkey + 1) * (c_custkey % 40) AS hi FROM customer) i ON CAST(floor(o_totalprice) AS BIGINT) BETWEEN i.lo AND i.hi")
def join_interval(spark, sf):
    """Orders whose price lies in intervals of very different widths, which overlap."""
    price = table(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").alias("price"))
    lo = 1000 * F.col("c_custkey")
    intervals = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), lo.alias("lo"), (lo + 200 * (F.col("c_nationkey") + 1) * (F.col("c_custkey") % 40)).alias("hi"))
    return A.interval_join(price, intervals, "price", "lo", "hi").select("o_orderkey", "k")


@query("SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_acctbal > 300 * n_nationkey AND s_nationkey <> n_nationkey AND contains(s_name, CAST(n_regionkey AS VARCHAR))")
def join_theta(spark, sf):
    """A condition without an equality; the smaller side is met whole."""
    condition = (F.col("s_acctbal") > 300 * F.col("n_nationkey")) & (F.col("s_nationkey") != F.col("n_nationkey")) & F.contains("s_name", F.col("n_regionkey").cast("string"))
    return A.theta_join(table(spark, sf, "supplier"), table(spark, sf, "nation"), condition).select("s_suppkey", "n_nationkey")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS after_signup FROM events")
def join_as_of(spark, sf):
    e = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return G.carried(e, "user_id", "at", F.when(F.col("event_type") == "signup", F.col("event_id")), "after_signup", before=True).select("event_id", "after_signup")


@query("SELECT conv_id, turn, lag(role) OVER w AS before, lead(role) OVER w AS after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def join_sequence(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.lag("role").over(w).alias("before"), F.lead("role").over(w).alias("after"))


@query(f"""WITH b AS {gram_sql('benchmark', 'item_id', 3)}, d AS {gram_sql('documents', 'doc_id', 3)}, n AS (SELECT key, count(*) AS n FROM b GROUP BY key), s AS (SELECT b.key AS entry, d.key AS record, count(*) / any_value(n) AS share FROM b JOIN d USING (gram) JOIN n ON n.key = b.key GROUP BY 1, 2),
    num AS (SELECT entry, arg_min(record, -share * 1000000 + record / 1e9) AS r FROM s WHERE record % 40 = entry AND share >= 0.25 GROUP BY 1), w AS (SELECT entry, count(*) AS c, min(record) AS one, max(share) AS top FROM s WHERE share >= 0.5 GROUP BY 1)
    SELECT item_id AS entry, coalesce(num.r, CASE WHEN c = 1 AND top >= 0.7 THEN one END) AS record, CASE WHEN num.r IS NOT NULL THEN 'number' WHEN c = 1 AND top >= 0.7 THEN 'wording' END AS how FROM benchmark LEFT JOIN num ON num.entry = item_id LEFT JOIN w ON w.entry = item_id""")
def join_number_guard(spark, sf):
    """Passages and the documents that have their number, if the wording shares a quarter; else the only one of that wording."""
    b, d = (M.gram_table(table(spark, sf, t), k, "text", 3) for t, k in (("benchmark", "item_id"), ("documents", "doc_id")))
    shares = graph.checkpointed(M.shared_grams(b, M.within(d, b)).join(M.sizes(b, "l"), "l").select(F.col("l").alias("entry"), F.col("r").alias("record"), (F.col("votes") / F.col("n_l")).alias("share")))
    entries = table(spark, sf, "benchmark").select(F.col("item_id").alias("entry"))
    return A.number_guard(entries, shares.where(F.col("record") % 40 == F.col("entry")), shares.where("share >= 0.5"))


# ---- aggregates


@query("SELECT role, n FROM (SELECT role, count(*) AS n FROM conversations GROUP BY role) ORDER BY n DESC, role LIMIT 10")
def a1_counter(spark, sf):
    return table(spark, sf, "conversations").groupBy("role").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "role").limit(10)


@query("SELECT l_returnflag AS class, count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS verdicts, count(DISTINCT l_partkey) AS parts, count(*) FILTER (WHERE l_discount = 0) AS undiscounted FROM lineitem GROUP BY 1")
def a2_table_summary(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("class")).agg(F.count("*").alias("row_count"), F.countDistinct("l_orderkey", "l_linenumber").alias("verdicts"), F.countDistinct("l_partkey").alias("parts"), F.count_if(F.col("l_discount") == 0).alias("undiscounted"))


@query("SELECT coalesce(source, 'all') AS source, count(*) AS n, sum(CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS labelled, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ROLLUP (source)")
def a3_coverage_rollup(spark, sf):
    l = table(spark, sf, "labels").withColumn("has", F.lit(1))
    out = table(spark, sf, "documents").join(l, "doc_id", "left").rollup("source").agg(F.count("*").alias("n"), F.sum(F.coalesce("has", F.lit(0))).alias("labelled"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"))
    return out.withColumn("source", F.coalesce("source", F.lit("all")))


@query("SELECT source, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS good_share, round(avg(toxic), 6) AS toxic_share FROM documents JOIN labels USING (doc_id) GROUP BY source")
def a4_shares(spark, sf):
    j = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id")
    return j.groupBy("source").agg(F.round(F.avg((F.col("quality") == 1).cast("double")), 6).alias("good_share"), F.round(F.avg("toxic"), 6).alias("toxic_share"))


QUALITY = rf"(SELECT doc_id, source, CASE WHEN len(t) >= 8 THEN 100 * len(list_filter(t, lambda w: regexp_matches(w, '^\p{{L}}{{2,15}}$'))) // len(t) END AS q FROM (SELECT doc_id, source, {tok_sql()} AS t FROM documents))"


def _quality(spark, sf):
    good, total = T.ocr_quality(T.tokens("text"))
    return table(spark, sf, "documents").select("doc_id", "source", F.floor(100 * good / total).alias("q"))


@query(f"SELECT source, count(q) AS aligned, count(*) AS n, count(*) FILTER (WHERE q >= 85) AS high, count(*) FILTER (WHERE q < 60) AS low FROM {QUALITY} GROUP BY source")
def a5_collation_summary(spark, sf):
    return _quality(spark, sf).groupBy("source").agg(F.count("q").alias("aligned"), F.count("*").alias("n"), F.count_if(F.col("q") >= 85).alias("high"), F.count_if(F.col("q") < 60).alias("low"))


@query(f"SELECT source, count(*) FILTER (WHERE q >= 95) AS verified, count(*) FILTER (WHERE q >= 85 AND q < 95) AS corroborated, count(*) FILTER (WHERE q >= 60 AND q < 85) AS partial, count(*) FILTER (WHERE q < 60) AS divergent, count(*) FILTER (WHERE q IS NULL) AS unmatched FROM {QUALITY} GROUP BY source")
def a6_level_pivot(spark, sf):
    level = F.when(F.col("q").isNull(), "unmatched").when(F.col("q") >= 95, "verified").when(F.col("q") >= 85, "corroborated").when(F.col("q") >= 60, "partial").otherwise("divergent")
    return _quality(spark, sf).withColumn("level", level).groupBy("source").pivot("level", ["verified", "corroborated", "partial", "divergent", "unmatched"]).count().fillna(0)


@query(f"SELECT source, doc_id, q, r FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY q, doc_id) AS r FROM {QUALITY} WHERE q IS NOT NULL) WHERE r <= 25")
def a7_triage_worst(spark, sf):
    return S.top_per(_quality(spark, sf).where("q IS NOT NULL"), ["source"], [F.col("q"), F.col("doc_id")], 25).select("source", "doc_id", "q", F.col("rank").alias("r"))


@query("WITH b AS (SELECT item_id, g, count(*) AS c FROM (SELECT item_id, unnest(list_transform(range(1, len(t) - 2), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] || ' ' || t[i + 3])) AS g FROM (SELECT item_id, " + tok_sql() + " AS t FROM benchmark)) GROUP BY 1, 2), d AS (SELECT doc_id, g, count(*) AS c FROM (SELECT doc_id, unnest(list_transform(range(1, len(t) - 2), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] || ' ' || t[i + 3])) AS g FROM (SELECT doc_id, " + tok_sql() + " AS t FROM documents)) GROUP BY 1, 2), n AS (SELECT item_id, sum(c) AS total FROM b GROUP BY 1) SELECT item_id AS l, doc_id AS r, sum(least(b.c, d.c)) AS shared, total FROM b JOIN d USING (g) JOIN n USING (item_id) GROUP BY 1, 2, 4")
def a8_multiset_share(spark, sf):
    b, d = (C.gram_positions(table(spark, sf, t), k, "text", 4) for t, k in (("benchmark", "item_id"), ("documents", "doc_id")))
    return C.multiset_share(b, d)


@query("SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def a9_argmax(spark, sf):
    best = F.max_by(F.struct("l_partkey", "l_quantity"), F.struct("l_quantity", -F.col("l_partkey"), -F.col("l_linenumber"))).alias("b")
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(best).select("l_orderkey", "b.l_partkey", "b.l_quantity")


@query("SELECT user_id, bool_or(event_type = 'signup') AND bool_or(event_type = 'purchase') AS agreed, count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id")
def a10_agreed(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").groupBy("user_id").agg((F.bool_or(kind == "signup") & F.bool_or(kind == "purchase")).alias("agreed"), F.countDistinct(kind).alias("kinds"))


@query("SELECT l_orderkey, max(CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 WHEN 'R' THEN 3 END) AS weakest, count(*) AS names FROM lineitem GROUP BY l_orderkey")
def a11_weakest_rank(spark, sf):
    rank = F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "R", 3)
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max(rank).alias("weakest"), F.count("*").alias("names"))


@query("SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 AS repeated, coalesce(l_partkey NOT BETWEEN lag(l_partkey) OVER w AND lead(l_partkey) OVER w, false) AS out_of_order FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)")
def a12_sequence_flags(spark, sf):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    between = F.col("l_partkey").between(F.lag("l_partkey").over(w), F.lead("l_partkey").over(w))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.count("*").over(Window.partitionBy("l_orderkey", "l_suppkey")) > 1).alias("repeated"), F.coalesce(~between, F.lit(False)).alias("out_of_order"))


@query("SELECT l_orderkey, l_returnflag, l_linestatus, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1, 2, 3")
def a13_same_verdict_once(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(F.min("l_linenumber").alias("first_line"))


@query("SELECT doc_id, source, r, CAST(replace(source, 'src', '') AS INTEGER) AS year FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents)")
def a14_round_robin(spark, sf):
    year = F.replace("source", F.lit("src"), F.lit("")).cast("int")
    ranked = table(spark, sf, "documents").withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")))
    return ranked.select("doc_id", "source", "r", year.alias("year")).orderBy("r", "year")


@query("SELECT c_custkey, row_number() OVER (ORDER BY coalesce(d, 9999), c_acctbal DESC, c_custkey) AS place FROM (SELECT *, CASE WHEN c_nationkey % 5 > 0 THEN c_nationkey END AS d FROM customer)")
def a15_death_order(spark, sf):
    """The place of every customer in the order by year, unknown ones last, then by score."""
    c = table(spark, sf, "customer").withColumn("d", F.when(F.col("c_nationkey") % 5 > 0, F.col("c_nationkey")))
    return S.placed(c, [F.coalesce("d", F.lit(9999)), F.desc("c_acctbal"), F.col("c_custkey")], "place").select("c_custkey", "place")


@query("SELECT source, array_to_string(list(doc_id ORDER BY n_chars DESC, doc_id)[1:5], ',') AS top_five FROM documents GROUP BY source")
def a16_top_five(spark, sf):
    top = S.top_per(table(spark, sf, "documents"), ["source"], [F.desc("n_chars"), F.col("doc_id")], 5)
    return top.groupBy("source").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"].cast("string")), ",").alias("top_five"))


@query("SELECT 'doc' AS layer, doc_id AS id, n_chars FROM documents UNION ALL SELECT 'page', page_id, NULL FROM pages")
def a17_union(spark, sf):
    d = table(spark, sf, "documents").select(F.lit("doc").alias("layer"), F.col("doc_id").alias("id"), "n_chars")
    return d.unionByName(table(spark, sf, "pages").select(F.lit("page").alias("layer"), F.col("page_id").alias("id")), allowMissingColumns=True)


@query("SELECT 'common' AS kind, id FROM (SELECT doc_id AS id FROM documents INTERSECT SELECT page_id FROM pages) UNION ALL SELECT 'lost', id FROM (SELECT doc_id AS id FROM documents EXCEPT ALL SELECT page_id FROM pages)")
def a18_set_operations(spark, sf):
    d, p = table(spark, sf, "documents").select(F.col("doc_id").alias("id")), table(spark, sf, "pages").select(F.col("page_id").alias("id"))
    return d.intersect(p).select(F.lit("common").alias("kind"), "id").union(d.exceptAll(p).select(F.lit("lost"), "id"))


FORMS = {"License": ["license", "licensed", "lícense"], "Insult": ["idiot", "moron"], "None": ["xyzzy"]}


@query(f"""WITH d AS (SELECT doc_id, {tok_sql()} AS t FROM documents), f AS ({" UNION ALL ".join(f"SELECT '{n}' AS name, {sorted({LATIN.norm(x) for x in fs})} AS forms" for n, fs in FORMS.items())}) SELECT name, count(doc_id) AS docs, coalesce(sum(len(list_filter(t, lambda w: list_contains(forms, w)))), 0) AS n, min(doc_id) AS first_doc FROM f LEFT JOIN d ON list_has_any(t, forms) GROUP BY name""")
def a19_name_forms(spark, sf):
    """A table of names: for each the records that have one of its forms, how often, and the first one."""
    return S.name_table(table(spark, sf, "documents"), FORMS, "doc_id", "text")


# ---- segmentation


@query("""WITH f AS (SELECT *, CASE WHEN turn = 0 THEN 'heading' WHEN role = 'user' THEN 'start' WHEN role = 'assistant' THEN 'sub' ELSE 'more' END AS k FROM conversations), u AS (SELECT *, sum(CASE WHEN k IN ('start', 'heading') THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS grp, sum(CASE WHEN k = 'start' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS num FROM f),
    s AS (SELECT *, sum(CASE WHEN k = 'sub' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, grp ORDER BY turn) AS sub FROM u), o AS (SELECT *, max(CASE WHEN k = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, grp) = 1 AS intro FROM s WHERE true)
    SELECT conv_id, CASE WHEN intro THEN 'intro.' || sub WHEN sub > 0 THEN num || '.' || sub ELSE CAST(num AS VARCHAR) END AS number, count(*) AS parts, md5(string_agg(coalesce(text, ''), ' ' ORDER BY turn)) AS md5 FROM o WHERE k <> 'heading' AND NOT (intro AND sub = 0) GROUP BY 1, 2""")
def u1_unit_grouping(spark, sf):
    """Records grouped to units: headings close one, starts and further versions of it open one, others go on."""
    c = table(spark, sf, "conversations")
    first = F.col("turn") == 0
    kind = F.when(first, "heading").when(F.col("role") == "user", "start").when(F.col("role") == "assistant", "sub").otherwise("more")
    out = G.numbered_units(c, "conv_id", "turn", kind, "text")
    return out.select("conv_id", "number", "parts", F.md5(F.col("text").cast("binary")).alias("md5"))


@query("""WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN r = 1 THEN CAST(l_suppkey % 3 AS VARCHAR) ELSE l_suppkey % 3 || '#' || r END AS number_id FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3 ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem)) SELECT l_orderkey, number_id, count(*) AS n FROM n GROUP BY 1, 2""")
def u2_duplicate_numbers(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns({"number": F.col("l_suppkey") % 3, "at": F.struct("l_linenumber", "l_partkey", "l_suppkey")})
    return G.suffixed(lines, "l_orderkey", "number", "at").groupBy("l_orderkey", "number_id").agg(F.count("*").alias("n"))


@query("""WITH h AS (SELECT source, doc_id, starts_with(coalesce(text, ''), 'A') AS note, starts_with(coalesce(text, ''), 'T') AS head, coalesce(text, '') AS t FROM documents), u AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id) AS unit FROM h), c AS (SELECT *, coalesce(sum(CASE WHEN note THEN 1 ELSE 0 END) OVER (PARTITION BY source, unit ORDER BY doc_id), 0) AS notes FROM u WHERE unit > 0),
    k AS (SELECT source, unit, count(*) AS parts, substr(string_agg(t, ' ' ORDER BY doc_id), 1, 40) AS head, min(doc_id) AS first FROM c WHERE notes = 0 GROUP BY 1, 2) SELECT source, first, parts FROM (SELECT *, row_number() OVER (PARTITION BY source, head ORDER BY first) AS r FROM k) WHERE r = 1""")
def u2_closed_units(spark, sf):
    """Units that a heading opens and a footnote closes; one printed twice (by its first forty characters) counts once."""
    t = T.text("text")
    return G.closed_units(table(spark, sf, "documents"), "source", "doc_id", "text", t.startswith("T"), t.startswith("A")).select("source", "first", "parts")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN 'old' || o_orderkey ELSE 'p' || o_custkey || ':' || sum(CASE WHEN o_orderkey % 4 > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END AS id, o_orderkey % 4 > 0 AS kept_id FROM orders")
def u3_rebuild_ids(spark, sf):
    """Units that were there keep their id, new ones get one; no old id may be lost."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    old = o.where("o_orderkey % 4 > 0").select(F.concat(F.lit("old"), F.col("o_orderkey").cast("string")).alias("id"), "o_orderkey")
    return A.rebuilt_ids(o, old, "o_orderkey", [F.col("o_orderkey")], "o_custkey", "p").select("o_orderkey", "id", "kept_id")


@query("""WITH f AS (SELECT conv_id, turn, text, role, CASE WHEN regexp_matches(text, '^[A-H]') THEN 'a' || substr(text, 1, 1) WHEN regexp_matches(text, '^[I-R]') THEN 'b' || substr(text, 1, 1) END AS num FROM (SELECT *, coalesce(text, '') AS t FROM conversations)), u AS (SELECT *, sum(CASE WHEN num IS NOT NULL OR role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS unit FROM f),
    b AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY conv_id, unit ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u WHERE unit > 0 AND role <> 'system') SELECT conv_id, unit, arg_min(num, turn) AS number, count(*) AS parts, md5(string_agg(text, ' ' ORDER BY turn)) AS md5 FROM b WHERE before < 900 GROUP BY 1, 2 HAVING arg_min(num, turn) IS NOT NULL""")
def u4_cutoff(spark, sf):
    """Entries that open in one of two formats; their lines until 900 characters."""
    formats = [("a", "^([A-H])"), ("b", "^([I-R])")]
    out = V.entries(table(spark, sf, "conversations"), "conv_id", "turn", "text", formats, F.col("role") == "system")
    return out.select("conv_id", "unit", "number", "parts", F.md5(F.col("text").cast("binary")).alias("md5"))


CHAIN_SQL = "l AS (SELECT l_orderkey AS chain, p_name || CASE WHEN l_linenumber % 2 = 0 THEN ' of ' || l_suppkey ELSE '' END AS name, CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS entry FROM lineitem JOIN part ON p_partkey = l_partkey)"


def _linked(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    name = F.concat("p_name", F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" of "), F.col("l_suppkey").cast("string"))).otherwise(""))
    return lines.select(F.col("l_orderkey").alias("chain"), F.col("l_linenumber").alias("at"), name.alias("name"), F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("entry"))


# ---- collation


def _gram_pos(source, key, k):
    join = " || ' ' || ".join(f"t[i + {j}]" for j in range(k))
    return f"(SELECT {key} AS key, unnest(list_transform(range(1, len(t) - {k - 2}), lambda i: {join})) AS gram, unnest(range(0, len(t) - {k - 1})) AS pos FROM (SELECT {key}, {tok_sql()} AS t FROM {source}) WHERE len(t) >= {k})"


@query(f"WITH p AS {_gram_pos('documents', 'doc_id', 5)} SELECT key, count(*) AS kept, count(DISTINCT gram) AS grams FROM (SELECT *, count(*) OVER (PARTITION BY key, gram) AS c FROM p) WHERE c <= 4 GROUP BY key")
def w1_witness_index(spark, sf):
    return C.gram_positions(table(spark, sf, "documents"), "doc_id", "text", 5, 4).groupBy("key").agg(F.count("*").alias("kept"), F.countDistinct("gram").alias("grams"))


@query(f"""WITH d AS {_gram_pos('documents', 'doc_id', 5)}, b AS {_gram_pos('benchmark', 'item_id', 5)}, few AS (SELECT key, gram FROM d GROUP BY 1, 2 HAVING count(*) <= 4), o AS (SELECT d.key AS w, b.key AS r, d.pos - b.pos AS d FROM d JOIN few USING (key, gram) JOIN b ON b.gram = d.gram),
    v AS (SELECT w, r, CAST(floor(d / 25.0) AS BIGINT) AS bucket, count(*) AS votes, list(d ORDER BY d) AS ds FROM o GROUP BY 1, 2, 3) SELECT w, r, bucket, votes, ds[len(ds) // 2 + 1] AS "offset" FROM (SELECT *, row_number() OVER (PARTITION BY w, r ORDER BY votes DESC, bucket) AS k FROM v) WHERE k = 1 AND votes >= 2""")
def w2_offset_votes(spark, sf):
    record = C.gram_positions(table(spark, sf, "benchmark"), "item_id", "text", 5)
    return C.offset_votes(C.gram_positions(table(spark, sf, "documents"), "doc_id", "text", 5, 4, wanted=record), record)


@query(f"WITH q AS {QUALITY} SELECT q.doc_id, CASE WHEN d.n_chars < 90 THEN NULL WHEN l.quality = 1 THEN 'verified' WHEN l.doc_id IS NULL THEN 'no_witness' WHEN q.q IS NULL THEN 'unmatched' WHEN q.q >= 85 THEN 'corroborated' WHEN q.q >= 60 THEN 'partial' ELSE 'divergent' END AS level FROM q JOIN documents d USING (doc_id) LEFT JOIN labels l USING (doc_id)")
def w4_levels(spark, sf):
    l = table(spark, sf, "labels").select("doc_id", "quality")
    out = _quality(spark, sf).join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").join(l, "doc_id", "left")
    return out.select("doc_id", C.level(F.col("q"), F.floor(F.col("n_chars") / 6), F.coalesce(F.col("quality") == 1, F.lit(False)), F.col("quality").isNotNull()).alias("level"))


@query(f"SELECT term, count(*) AS freq FROM {posts_sql()} WHERE uid IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY term HAVING count(*) >= 2")
def w6_lexicon(spark, sf):
    typed = table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("uid"))
    return S.vocabulary(S.postings(table(spark, sf, "documents")).join(typed, "uid", "left_semi")).where("freq >= 2")


@query(f"""WITH lex AS (SELECT term FROM {posts_sql()} GROUP BY term HAVING count(*) >= 5), w AS (SELECT DISTINCT uid AS key, term FROM {posts_sql()}), odd AS (SELECT * FROM w WHERE term NOT IN (SELECT term FROM lex)), p AS (SELECT a.doc_id AS record, b.doc_id AS text, a.lang AS work, b.source AS witness FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
    n AS (SELECT work, witness, count(*) AS unknown, count(h.term) AS reproduced FROM p JOIN odd ON odd.key = p.record LEFT JOIN w h ON h.key = p.text AND h.term = odd.term GROUP BY 1, 2)
    SELECT q.work, q.witness, coalesce(unknown, 0) AS unknown, coalesce(reproduced, 0) AS reproduced, coalesce(unknown, 0) = 0 OR 100 * reproduced < 40 * unknown OR q.work = 'es' AS used FROM (SELECT DISTINCT work, witness FROM p) q LEFT JOIN n USING (work, witness)""")
def w8_independence(spark, sf):
    """How many of a record's unknown words the witness at the next place has too, by language and source."""
    lexicon = S.vocabulary(S.postings(table(spark, sf, "documents"))).where("freq >= 5").select("term")
    words = S.postings(table(spark, sf, "documents")).select(F.col("uid").alias("key"), "term").distinct()
    d = table(spark, sf, "documents")
    pairs = d.select(F.col("doc_id").alias("record"), F.col("lang").alias("work"), (F.col("doc_id") + 1).alias("text")).join(d.select(F.col("doc_id").alias("text"), F.col("source").alias("witness")), "text")
    return C.independence(words, words, pairs, lexicon, exempt=F.col("work") == "es")


# ---- ledger and validation


@query("SELECT 'duplicate_text' AS \"check\", md5(text) AS key FROM documents GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'label_without_document', CAST(doc_id AS VARCHAR) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'order_without_customer', CAST(o_custkey AS VARCHAR) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) UNION ALL SELECT 'page_without_document', CAST(page_id AS VARCHAR) FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def l2_violations(spark, sf):
    d = table(spark, sf, "documents")
    hashed = d.select(F.md5(F.col("text").cast("binary")).alias("m"))
    return L.violations({
        "duplicate_text": L.duplicates(hashed, "m"),
        "label_without_document": L.dangling(table(spark, sf, "labels"), "doc_id", d, "doc_id"),
        "order_without_customer": L.dangling(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer"), "c_custkey"),
        "page_without_document": L.dangling(table(spark, sf, "pages"), "page_id", d.where("lang = 'en'"), "doc_id"),
    })


@query("WITH s AS (SELECT DISTINCT role AS v, conv_id AS t, CASE WHEN length(text) % 3 = 0 THEN 'affirms' WHEN length(text) % 3 = 1 THEN 'rejects' ELSE 'nuances' END AS s FROM conversations), p AS (SELECT x.v AS a, y.v AS b, x.s AS sa, y.s AS sb FROM s x JOIN s y ON x.t = y.t AND x.v < y.v) SELECT a, b, count(*) FILTER (WHERE sa = sb) AS agree, count(*) FILTER (WHERE sa <> sb AND sa <> 'nuances' AND sb <> 'nuances') AS differ, count(*) FILTER (WHERE sa <> sb AND (sa = 'nuances' OR sb = 'nuances')) AS partly FROM p GROUP BY a, b")
def l4_agreement_matrix(spark, sf):
    n = F.length("text") % 3
    s = table(spark, sf, "conversations").withColumn("stance", F.when(n == 0, "affirms").when(n == 1, "rejects").otherwise("nuances"))
    return L.agreement(s, "role", "conv_id", "stance")


@query("SELECT o_orderkey, concat_ws(',', CASE WHEN o_totalprice < 1000 THEN 'cheap' END, CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status' END, CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-5]-') THEN 'priority' END) AS errors FROM orders")
def l5_row_errors(spark, sf):
    rules = {"cheap": F.col("o_totalprice") < 1000, "status": ~F.col("o_orderstatus").isin("O", "F"), "priority": ~F.col("o_orderpriority").rlike("^[1-5]-")}
    return table(spark, sf, "orders").select("o_orderkey", L.errors(rules).alias("errors"))


@query("SELECT c_mktsegment, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def l5_status_pivot(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    out = table(spark, sf, "orders").join(c, "o_custkey").groupBy("c_mktsegment").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)
    return out.select("c_mktsegment", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


@query(f"""WITH sec AS (SELECT p_partkey AS section, p_partkey * 75 AS first_id, p_partkey * 75 + 74 AS last_id FROM part), st AS (SELECT s_suppkey AS story, s_name, s_suppkey * 20 AS a, s_suppkey * 20 + 25 AS b FROM supplier), v AS (SELECT l_orderkey % 40 AS passage, l_partkey AS record FROM lineitem WHERE l_linenumber = 7)
    SELECT o_orderkey AS couplet, section, story, s_name, v.record, round(max(c_acctbal), 2) AS reading FROM orders JOIN sec ON o_orderkey BETWEEN first_id AND last_id JOIN st ON section BETWEEN a AND b JOIN v ON v.passage = story % 40 AND o_orderstatus = 'F' LEFT JOIN customer ON c_custkey = v.record GROUP BY 1, 2, 3, 4, 5""")
def l6_story_lookup(spark, sf):
    """From couplets to their section, its stories, the passages of each and what reads them."""
    # All sides are distinct, and so is what they make together: the result is never sorted or dealt out to find that.
    couplets = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("couplet")).distinct()
    k = F.col("p_partkey")
    sections = table(spark, sf, "part").select(k.alias("section"), (k * 75).alias("first_id"), (k * 75 + 74).alias("last_id")).distinct()
    stories = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("story"), "s_name", (20 * F.col("s_suppkey")).alias("a"), (20 * F.col("s_suppkey") + 25).alias("b")).distinct()
    passages = table(spark, sf, "lineitem").where("l_linenumber = 7").select((F.col("l_orderkey") % 40).alias("passage"), F.col("l_partkey").alias("record")).distinct()
    readings = table(spark, sf, "customer").groupBy(F.col("c_custkey").alias("record")).agg(F.round(F.max("c_acctbal"), 2).alias("reading"))
    found = A.interval_join(A.interval_join(couplets, sections, "couplet", "first_id", "last_id"), stories, "section", "a", "b")
    found = found.select("couplet", "section", "story", "s_name", (F.col("story") % 40).alias("passage"))
    out = A.hot_join(found, passages.join(readings, "record", "left"), "passage")
    return out.select("couplet", "section", "story", "s_name", "record", "reading")


@query(f"WITH {CHAIN_SQL}, r AS (SELECT chain, name, entry, p_size % 13 AS rank FROM l JOIN part ON p_partkey = entry) SELECT chain, name, entry, rank FROM r WHERE rank >= 8 AND len(string_split(name, ' ')) >= 3 AND chain NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def u7_weak_links(spark, sf):
    """Weak entries that names of three words and more are linked to, in chains without a verdict."""
    ranks = table(spark, sf, "part").select(F.col("p_partkey").alias("entry"), (F.col("p_size") % 13).alias("rank"))
    graded = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("chain"))
    return N.weak_narrators(_linked(spark, sf), ranks, graded).select("chain", "name", "entry", "rank")


@query(f"WITH {CHAIN_SQL} SELECT chain, count(*) AS names, count(p_partkey) AS linked, max(CASE WHEN p_size % 13 > 0 THEN p_size % 13 END) AS weakest FROM l LEFT JOIN part ON p_partkey = entry AND p_size % 13 > 0 GROUP BY chain")
def a11_weakest_chain(spark, sf):
    """The worst rank among the linked names of each chain."""
    ranks = table(spark, sf, "part").where("p_size % 13 > 0").select(F.col("p_partkey").alias("entry"), (F.col("p_size") % 13).alias("rank"))
    return N.weakest_links(_linked(spark, sf), ranks)
