"""Queries for loose matching (M), similarity joins (J), grouping (G) and the passage index (I)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import LATIN
from ..operators import catalog as A, collate as C, graph, match as M, names as N, passages as P, search as S
from ._register import clean_sql, gram_sql, list_sql, norm_sql, posts_sql, query, stems_sql, table, tok_sql, toks_sql

MODEL = f"""(SELECT item_id AS q, len(t) AS all_n, w, len(list_distinct(w)) AS set_size, greatest(1, CAST(ceil(len(list_distinct(w)) / 2) AS INTEGER)) AS need, greatest(10, 3 * len(t)) AS win
    FROM (SELECT item_id, t, CASE WHEN len(c) >= 2 THEN c ELSE t END AS w FROM (SELECT item_id, t, list_filter(t, lambda w: NOT list_contains({list_sql(LATIN.stop)}, w)) AS c FROM (SELECT item_id, {stems_sql()} AS t FROM benchmark))))"""


def loose_sql(text: str = "text", name: str = "") -> str:
    """The loose matches of the benchmark's passages in documents, as tables of a WITH clause; `name` goes to their names."""
    n = name
    return f"""model{n} AS {MODEL}, terms{n} AS (SELECT q, set_size, need, win, unnest(list_distinct(w)) AS term FROM model{n}),
    pos0{n} AS (SELECT q, uid, pos, p.term, set_size, need, win FROM {posts_sql(text=text, toks=stems_sql)} p JOIN terms{n} t ON p.term = t.term),
    cand{n} AS (SELECT q, uid FROM pos0{n} GROUP BY q, uid, need HAVING count(DISTINCT term) >= need), pos{n} AS (SELECT pos0{n}.* FROM pos0{n} JOIN cand{n} USING (q, uid)),
    pairs{n} AS (SELECT q, i, w[i] AS a, w[i + 1] AS b FROM (SELECT q, w, unnest(range(1, len(w))) AS i FROM model{n}) WHERE w[i] <> w[i + 1]),
    np{n} AS (SELECT q, count(*) AS np FROM pairs{n} GROUP BY q),
    ends{n} AS (SELECT e.q, e.uid, e.pos AS stop, e.set_size, e.win, count(DISTINCT s.term) AS cov, min(s.pos) AS start FROM pos{n} e JOIN pos{n} s ON s.q = e.q AND s.uid = e.uid AND s.pos <= e.pos AND s.pos > e.pos - e.win GROUP BY ALL),
    steps{n} AS (SELECT x.q, x.uid, p.i, x.pos AS px, y.pos AS py FROM pairs{n} p JOIN pos{n} x ON x.q = p.q AND x.term = p.a JOIN pos{n} y ON y.q = p.q AND y.uid = x.uid AND y.term = p.b AND y.pos - x.pos BETWEEN 1 AND 3),
    okc{n} AS (SELECT e.q, e.uid, e.stop, count(DISTINCT i) AS ok FROM ends{n} e JOIN steps{n} s ON s.q = e.q AND s.uid = e.uid AND s.py <= e.stop AND s.px > e.stop - e.win GROUP BY ALL),
    scored{n} AS (SELECT e.q, e.uid, e.stop, e.start, CASE WHEN np IS NULL THEN 10 * cov ELSE 7 * cov * np + 3 * coalesce(ok, 0) * set_size END AS num, CASE WHEN np IS NULL THEN 10 * set_size ELSE 10 * set_size * np END AS den
        FROM ends{n} e LEFT JOIN np{n} USING (q) LEFT JOIN okc{n} USING (q, uid, stop)),
    loose{n} AS (SELECT q, uid, num, den, start, stop FROM (SELECT *, row_number() OVER (PARTITION BY q, uid ORDER BY num DESC, stop) AS r FROM scored{n}) WHERE r = 1 AND num * 10 >= den * 7)"""


LOOSE = loose_sql()


def _model(spark, sf):
    return M.query_model(table(spark, sf, "benchmark"), "item_id", "text")


def _loose(spark, sf):
    return M.loose_matches(_model(spark, sf), table(spark, sf, "documents"))


@query(f"SELECT q, all_n, len(w) AS n_words, set_size, need, win AS window_size, set_size < 3 AS short FROM {MODEL}")
def m0_query_model(spark, sf):
    m = _model(spark, sf)
    return m.select("q", F.col("all_n").cast("long").alias("all_n"), F.size("words").cast("long").alias("n_words"), F.col("set_size").cast("long").alias("set_size"), "need", F.col("window").cast("long").alias("window_size"), (F.col("set_size") < 3).alias("short"))


@query(f"WITH {LOOSE} SELECT q, uid, num, den, start, stop FROM loose")
def m1_loose_score(spark, sf):
    return _loose(spark, sf)


#: A document's text after its first sentence, and the whole of it.
_AFTER = "CASE WHEN instr(text, '. ') > 0 THEN substr(text, instr(text, '. ') + 2) ELSE text END"


@query(f"""WITH {loose_sql(_AFTER, "_a")}, {loose_sql("text", "_b")}, every AS (SELECT q, uid, num, den, 'text' AS how FROM loose_a UNION ALL SELECT q, uid, num, den, 'whole' FROM loose_b WHERE (q, uid) NOT IN (SELECT (q, uid) FROM loose_a))
    SELECT q, how, count(*) AS docs, max(num * 1000 // den) AS best FROM every GROUP BY q, how""")
def m2_scan_summary(spark, sf):
    """Matches in what follows a document's first sentence, and, where there are none, in all of it."""
    at = F.instr("text", ". ")
    d = table(spark, sf, "documents").select("doc_id", "text", F.when(at > 0, F.expr("substring(text, instr(text, '. ') + 2)")).otherwise(F.col("text")).alias("body"))
    out = M.retried_matches(_model(spark, sf), d, "doc_id", "body", "text")
    return out.groupBy("q", "how").agg(F.count("*").alias("docs"), F.max(F.floor(F.col("num") * 1000 / F.col("den"))).alias("best"))


@query("""WITH c AS (SELECT conv_id, turn, text, len(list_filter(regexp_split_to_array(trim(text), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS n, lead(text, 1) OVER w AS t1, lead(text, 2) OVER w AS t2 FROM conversations WHERE role <> 'system' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    f AS (SELECT *, n < 40 AND t1 IS NOT NULL AND NOT regexp_matches(t1, '^[A-E]') AS o1 FROM c), g AS (SELECT *, o1 AND t2 IS NOT NULL AND NOT regexp_matches(t2, '^[A-E]') AS o2 FROM f)
    SELECT conv_id, turn, CASE WHEN o2 THEN 2 WHEN o1 THEN 1 ELSE 0 END AS follows, md5(coalesce(text, '') || CASE WHEN o1 THEN ' ' || t1 ELSE '' END || CASE WHEN o2 THEN ' ' || t2 ELSE '' END) AS md5 FROM g""")
def m3_follow_on(spark, sf):
    """Short turns take along the next two, up to one that opens a new entry; turns of the system are headings."""
    out = M.follow_on(table(spark, sf, "conversations"), "conv_id", "turn", "text", F.col("role") == "system", "^[A-E]")
    return out.select("conv_id", "turn", "follows", F.md5(F.col("joined").cast("binary")).alias("md5"))


_SIDE = """groups AS (SELECT doc_id AS uid, min(doc_id) OVER (PARTITION BY text) AS grp, count(*) OVER (PARTITION BY text) AS c FROM documents), verdicts AS (SELECT doc_id AS uid, 'critic' || doc_id % 3 AS critic, CASE WHEN doc_id % 5 > 0 THEN 100 * (doc_id % 5) END AS death,
    CASE WHEN toxic = 1 THEN 'modern' ELSE 'classical' END AS layer, CASE WHEN quality = 1 THEN 'sound' ELSE 'weak' END AS class FROM labels), remarks AS (SELECT doc_id AS uid, CASE WHEN lang = 'en' THEN 'sound' ELSE 'unique' END AS class FROM documents)"""


def _enriched(spark, sf):
    d = table(spark, sf, "documents")
    sha = d.select(F.col("doc_id").alias("uid"), F.sha2("text", 256).alias("sha"))
    groups = sha.join(sha.groupBy("sha").agg(F.min("uid").alias("group"), F.count("*").alias("c")).where("c > 1"), "sha").select("uid", "group")
    chains = table(spark, sf, "orders").select(F.col("o_orderkey").alias("uid"), (F.col("o_custkey") % 12).alias("weakest"), F.lit(3).alias("names"))
    verdicts = table(spark, sf, "labels").select(
        F.col("doc_id").alias("uid"), F.concat(F.lit("critic"), (F.col("doc_id") % 3).cast("string")).alias("critic"), F.when(F.col("doc_id") % 5 > 0, 100 * (F.col("doc_id") % 5)).cast("int").alias("death"),
        F.when(F.col("toxic") == 1, "modern").otherwise("classical").alias("layer"), F.when(F.col("quality") == 1, "sound").otherwise("weak").alias("class"),
    )
    sources = table(spark, sf, "pages").select(F.col("page_id").alias("uid"), F.substring_index("url", ":", 1).alias("source"))
    remarks = d.select(F.col("doc_id").alias("uid"), F.when(F.col("lang") == "en", "sound").otherwise("unique").alias("class"))
    return M.enriched(_loose(spark, sf), groups, chains, verdicts, sources, remarks)


_LAYER = lambda name: f"(SELECT array_to_string(list(critic || '=' || class ORDER BY coalesce(death, 9999), critic, class), ',') FROM (SELECT DISTINCT critic, class, death FROM verdicts v WHERE v.uid = l.uid AND layer = '{name}'))"


@query(f"""WITH {LOOSE}, {_SIDE} SELECT q, l.uid, (SELECT array_to_string(list(g2.uid ORDER BY g2.uid), ',') FROM groups g1 JOIN groups g2 ON g1.grp = g2.grp AND g2.uid <> g1.uid WHERE g1.uid = l.uid) AS members,
    o_custkey % 12 AS weakest, {_LAYER('classical')} AS classical, {_LAYER('modern')} AS modern, split_part(url, ':', 1) AS sources, CASE WHEN NOT EXISTS (SELECT 1 FROM verdicts v WHERE v.uid = l.uid AND layer = 'classical' AND v.class = r.class) THEN r.class END AS remarks
    FROM loose l LEFT JOIN orders ON o_orderkey = l.uid LEFT JOIN pages ON page_id = l.uid LEFT JOIN remarks r ON r.uid = l.uid""")
def m4_side_data(spark, sf):
    """Each match with its parallels, chain, verdicts of both layers by the critics' death years, sources and own remarks."""
    said = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda v: F.concat(v["critic"], F.lit("="), v["class"])), ","))
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return _enriched(spark, sf).select("q", "uid", listed("members"), "weakest", said("classical").alias("classical"), said("modern").alias("modern"), listed("sources"), listed("remarks"))


@query(f"WITH {LOOSE}, {_SIDE} SELECT layer, count(DISTINCT q) AS queries, count(*) AS hits FROM loose l JOIN verdicts v ON v.uid = l.uid GROUP BY 1")
def m5_layers(spark, sf):
    """Verdicts by layer; a modern one never stands in the classical list."""
    e = _enriched(spark, sf).select("q", "uid", F.explode(F.array(*[F.struct(F.lit(x).alias("layer"), F.col(x).alias("verdicts")) for x in ("classical", "modern")])).alias("l"))
    return e.select("q", "uid", "l.layer", F.explode("l.verdicts")).groupBy("layer").agg(F.countDistinct("q").alias("queries"), F.count("*").alias("hits"))


@query(f"WITH {LOOSE.replace('documents', 'conv')} SELECT q, uid, r FROM (SELECT q, uid, row_number() OVER (PARTITION BY q ORDER BY num DESC, uid) AS r FROM loose) WHERE r <= 3".replace("WITH model", "WITH conv AS (SELECT conv_id * 100 + turn AS doc_id, text FROM conversations), model", 1))
def m6_best_entries(spark, sf):
    """The table of entries (turns of conversations) scored against each passage: the three best."""
    entries = table(spark, sf, "conversations").select((100 * F.col("conv_id") + F.col("turn")).alias("doc_id"), "text")
    hits = M.loose_matches(_model(spark, sf), entries)
    return S.top_per(hits, ["q"], [F.desc("num"), F.col("uid")], 3).select("q", "uid", F.col("rank").alias("r"))


@query(f"WITH {LOOSE}, {_SIDE} SELECT q, bool_or(page_id IS NOT NULL OR v.uid IS NOT NULL) AS has_verdict FROM loose l LEFT JOIN pages ON page_id = l.uid LEFT JOIN verdicts v ON v.uid = l.uid AND layer = 'classical' GROUP BY q")
def m8_has_verdict(spark, sf):
    return _enriched(spark, sf).groupBy("q").agg(F.bool_or(M.has_classical_verdict()).alias("has_verdict"))


@query(f"WITH {LOOSE} SELECT q, uid, num, den, start, stop FROM loose")
def m11_parallel_scan(spark, sf):
    """The scan in many small tasks, sorted at the end: what one task would find, in the same order."""
    d = table(spark, sf, "documents").repartition(32, "doc_id")
    return M.loose_matches(_model(spark, sf), d).orderBy("q", F.desc(F.col("num") / F.col("den")), "uid")


B3, D3 = gram_sql("benchmark", "item_id", 3, toks=toks_sql), gram_sql("documents", "doc_id", 3, toks=toks_sql)
B5, D5 = gram_sql("benchmark", "item_id", 5), gram_sql("documents", "doc_id", 5)


def _verdict_grams(spark, sf, name, key):
    """Runs of three words without those of the stop list."""
    return M.gram_table(table(spark, sf, name), key, "text", 3, toks=T.content(T.tokens("text"), LATIN.stop))


@query(f"""WITH b AS {B3}, d AS {D3}, f AS (SELECT gram FROM d GROUP BY gram HAVING count(*) > 3000), n AS (SELECT key, count(*) AS n FROM b GROUP BY key HAVING count(*) >= 3),
    v AS (SELECT b.key AS l, d.key AS r, count(*) AS votes FROM b JOIN d USING (gram) WHERE gram NOT IN (SELECT gram FROM f) GROUP BY 1, 2),
    g AS (SELECT l, r, votes, n AS n_l FROM v JOIN n ON n.key = l WHERE 100 * votes >= 50 * n AND votes >= least(4, n)),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l ORDER BY votes DESC, r) AS rk FROM g) WHERE rk <= 40 AND r IN (SELECT doc_id FROM documents WHERE lang IN ('en', 'de'))),
    m AS (SELECT *, max(votes) OVER (PARTITION BY l) AS best FROM k)
    SELECT l, r, votes, n_l FROM (SELECT *, count(*) OVER (PARTITION BY l) AS c FROM m WHERE 100 * votes >= 90 * best) WHERE c <= 5""")
def j1_vote_join(spark, sf):
    """Documents of two languages that share most words in a row with each passage; the others vote too."""
    only = table(spark, sf, "documents").where(F.col("lang").isin("en", "de")).select(F.col("doc_id").alias("key"))
    return M.vote_join(_verdict_grams(spark, sf, "benchmark", "item_id"), _verdict_grams(spark, sf, "documents", "doc_id"), only=only)


@query(f"""WITH b AS {B5}, d AS {D5}, n AS (SELECT key, count(*) AS n FROM b GROUP BY key), v AS (SELECT b.key AS l, d.key AS r, count(*) AS votes FROM b JOIN d USING (gram) GROUP BY 1, 2)
    SELECT l, r, votes FROM (SELECT l, r, votes, row_number() OVER (PARTITION BY l ORDER BY votes DESC, r) AS rk FROM v JOIN n ON n.key = l WHERE 2 * votes >= n) WHERE rk = 1""")
def j2_gram_argmax(spark, sf):
    return M.argmax_join(M.gram_table(table(spark, sf, "benchmark"), "item_id", "text", 5), M.gram_table(table(spark, sf, "documents"), "doc_id", "text", 5))


CONTAINED = f"""b AS {B3}, d AS {D3}, nb AS (SELECT key, count(*) AS n FROM b GROUP BY key), nd AS (SELECT key, count(*) AS n FROM d GROUP BY key),
    v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l ORDER BY votes DESC, r) AS rk FROM (SELECT b.key AS l, d.key AS r, count(*) AS votes FROM b JOIN d USING (gram) GROUP BY 1, 2)) WHERE rk <= 30 AND votes >= 4),
    contained AS (SELECT l, r, votes, nb.n AS n_l, nd.n AS n_r FROM v JOIN nb ON nb.key = l JOIN nd ON nd.key = r WHERE nb.n >= 4 AND nd.n >= 4 AND 100 * votes >= 60 * least(nb.n, nd.n))"""


@query(f"""WITH {CONTAINED}, s AS (SELECT c.*, CASE WHEN lang IN ('en', 'fr') THEN l % 2 = r % 2 END AS same, l % 5 = r % 5 AS grp, quality = 1 AS critic FROM contained c JOIN documents ON doc_id = r LEFT JOIN labels USING (doc_id)),
    k AS (SELECT *, CASE WHEN same THEN 'same' WHEN NOT same THEN 'other' ELSE 'unknown' END AS companion, CASE WHEN same THEN 0 WHEN same IS NULL THEN 1 ELSE 2 END AS place FROM s WHERE coalesce(same, true) OR (100 * votes >= 80 * least(n_l, n_r) AND least(n_l, n_r) >= 8))
    SELECT l, r, votes, companion, CASE WHEN grp THEN 'parallel_group' ELSE 'wording' END || CASE WHEN coalesce(critic, false) THEN '+critic_takhrij' ELSE '' END AS basis FROM (SELECT *, min(place) OVER (PARTITION BY l) AS best FROM k) WHERE place = best""")
def j3_containment(spark, sf):
    """Passages and documents of one wording, by names that agree, are unknown or differ, and what speaks for each link."""
    links = M.containment_join(_verdict_grams(spark, sf, "benchmark", "item_id"), _verdict_grams(spark, sf, "documents", "doc_id"), distinct_keys=False)
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("r"), "lang")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("r"), "quality")
    same = F.when(F.col("lang").isin("en", "fr"), F.col("l") % 2 == F.col("r") % 2)
    out = M.wording_links(links.join(d, "r").join(labels, "r", "left"), same, F.col("l") % 5 == F.col("r") % 5, F.col("quality") == 1)
    return out.select("l", "r", "votes", "companion", "basis")


WORDS = gram_sql("documents", "doc_id", 1)


@query(f"""WITH RECURSIVE w AS {WORDS}, f AS (SELECT gram FROM w GROUP BY gram HAVING count(*) < 400), r AS (SELECT key, gram FROM w JOIN f USING (gram)), n AS (SELECT key, count(*) AS n FROM r GROUP BY key HAVING count(*) >= 3),
    v AS (SELECT x.key AS a, y.key AS b, count(*) AS votes FROM r x JOIN r y ON x.gram = y.gram AND x.key < y.key GROUP BY 1, 2),
    e AS (SELECT a, b FROM v JOIN n na ON na.key = a JOIN n nb ON nb.key = b JOIN documents da ON da.doc_id = a JOIN documents db ON db.doc_id = b WHERE da.source <> db.source AND 100 * votes >= 60 * (na.n + nb.n - votes)),
    two AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach AS (SELECT a, b FROM two UNION SELECT r.a, t.b FROM reach r JOIN two t ON r.b = t.a) SELECT a AS doc_id, least(a, min(b)) AS grp FROM reach GROUP BY a""")
def j4_word_set_jaccard(spark, sf):
    """Documents of different sources whose sets of rarer words are 60 per cent alike, as groups."""
    d = table(spark, sf, "documents")
    groups = M.jaccard_groups(M.gram_table(d, "doc_id", "text", 1), 60, least_size=3, most_df=399, across=d.select(F.col("doc_id").alias("key"), F.col("source").alias("of")))
    return groups.select(F.col("key").alias("doc_id"), F.col("group").alias("grp"))


_PRIME, _FAMILY = M.hash_parameters()
_LEAST = ", ".join(f"list_min(list_transform(s, lambda x: (x * {a} + {b}) % {_PRIME})) AS m{i}" for i, (a, b) in enumerate(_FAMILY))
_NUMBERS = f"(SELECT doc_id, list_distinct(list_transform(range(1, len(t) - 1), lambda i: CAST('0x' || substr(md5(t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]), 1, 7) AS BIGINT))) AS s FROM (SELECT doc_id, {toks_sql()} AS t FROM documents) WHERE len(t) >= 3)"


@query(f"""WITH RECURSIVE g AS (SELECT * FROM {_NUMBERS} WHERE len(s) >= 4), sig AS (SELECT doc_id, {_LEAST} FROM g),
    m AS ({" UNION ALL ".join(f"SELECT doc_id, {i} AS band, m{2 * i} AS x, m{2 * i + 1} AS y FROM sig" for i in range(16))}), f AS (SELECT *, min(doc_id) OVER (PARTITION BY band, x, y) AS first FROM m),
    c AS (SELECT DISTINCT first AS a, doc_id AS b FROM f WHERE first <> doc_id), e AS (SELECT a, b FROM c JOIN g x ON x.doc_id = a JOIN g y ON y.doc_id = b WHERE 100 * len(list_intersect(x.s, y.s)) >= 30 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))),
    two AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach AS (SELECT a, b FROM two UNION SELECT r.a, t.b FROM reach r JOIN two t ON r.b = t.a) SELECT a AS doc_id, least(a, min(b)) AS grp FROM reach GROUP BY a""")
def g1_near_duplicate_groups(spark, sf):
    """Groups by MinHash banding over runs of three words; in a bucket each member is compared with the first one only."""
    numbers = M.gram_numbers(T.grams(T.content(T.tokens("text"), LATIN.stop), 3))
    return M.minhash_groups(table(spark, sf, "documents"), "doc_id", numbers).select(F.col("key").alias("doc_id"), F.col("group").alias("grp"))


RULES = N.NameRules(("red", "navy"), ("blue", "green"), "s")


#: A part's name as a dictionary has it: name, lineage, epithet.
_FULL = "lower(p_name) || ' blue k' || p_partkey % 200 || ' s' || p_size"


def _full_name():
    return F.concat(F.lower("p_name"), F.lit(" blue k"), (F.col("p_partkey") % 200).cast("string"), F.lit(" s"), F.col("p_size").cast("string"))


def _entries(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("entry"), _full_name().alias("name"))


_RUN = "array_to_string(list_slice(w, j, j + {n} - 1), ' ')"
NAME_INDEX = f"""w AS (SELECT p_partkey AS entry, p_brand AS code, list_filter(string_split({_FULL}, ' '), lambda x: x <> '') AS w FROM part), t AS (SELECT *, w[j] AS x, w[j - 1] AS before FROM (SELECT *, unnest(range(1, len(w) + 1)) AS j FROM w)),
    idx AS (SELECT DISTINCT entry, 'prefix' AS kind, unnest(list_transform(range(1, 9), lambda n: array_to_string(list_slice(w, 1, n), ' '))) AS gram FROM w UNION SELECT DISTINCT entry, 'inside', unnest(CASE WHEN x IN ('red', 'navy') AND (j = 1 OR before NOT IN ('blue', 'green')) THEN [{", ".join(_RUN.format(n=n) for n in (2, 3, 4))}]
        WHEN starts_with(x, 's') AND j > 1 THEN [x] WHEN x = 'blue' AND j > 1 THEN [{", ".join(_RUN.format(n=n) for n in (2, 3, 4))}] ELSE [] END) FROM t)"""


@query(f"WITH {NAME_INDEX} SELECT kind, gram, count(*) AS n, min(entry) AS first_key FROM idx GROUP BY 1, 2")
def g3_name_index(spark, sf):
    return N.name_index(_entries(spark, sf), RULES).groupBy("kind", "gram").agg(F.count("*").alias("n"), F.min("entry").alias("first_key"))


#: The names to resolve: of each line's part a run of its name's words, from and to places that differ by line and part.
_WRITTEN = f"array_to_string(list_slice(string_split({_FULL}, ' '), 1 + l_linenumber % 5, 1 + l_linenumber % 5 + l_partkey % 5), ' ')"
CHAINS = f"ch AS (SELECT l_orderkey AS chain, l_linenumber * 10000000000 + l_partkey * 100000 + l_suppkey AS ps, {_WRITTEN} AS name, CASE WHEN l_returnflag <> 'A' THEN p_brand ELSE 'none' END AS code FROM lineitem JOIN part ON p_partkey = l_partkey)"
RESOLVED = f"""{NAME_INDEX}, {CHAINS}, pn AS (SELECT gram, count(*) AS n, min(entry) AS one FROM idx WHERE kind = 'prefix' GROUP BY 1), pc AS (SELECT gram, p_brand AS code, count(*) AS n, min(entry) AS one FROM idx JOIN part ON p_partkey = entry WHERE kind = 'prefix' GROUP BY 1, 2),
    iin AS (SELECT gram, count(*) AS n, min(entry) AS one FROM idx WHERE kind = 'inside' GROUP BY 1), ic AS (SELECT gram, p_brand AS code, count(*) AS n, min(entry) AS one FROM idx JOIN part ON p_partkey = entry WHERE kind = 'inside' GROUP BY 1, 2), al AS (SELECT lower(split_part(p_name, ' ', 1)) AS name, min(p_partkey) AS entry FROM part WHERE p_size = 50 GROUP BY 1),
    nm AS (SELECT x.name, x.code, al.entry AS al, coalesce(pn.n, 0) AS pn, pn.one AS p1, pc.n AS pcn, pc.one AS pc1, coalesce(iin.n, 0) AS inn, iin.one AS i1, ic.n AS icn, ic.one AS ic1, len(string_split(x.name, ' ')) = 2 AND split_part(x.name, ' ', 1) IN ('red', 'navy') AS bare, starts_with(x.name, 's') OR starts_with(x.name, 'red ') OR starts_with(x.name, 'navy ') AS special
        FROM (SELECT DISTINCT name, code FROM ch) x LEFT JOIN al ON al.name = x.name LEFT JOIN pn ON pn.gram = x.name LEFT JOIN pc ON pc.gram = x.name AND pc.code = x.code LEFT JOIN iin ON iin.gram = x.name LEFT JOIN ic ON ic.gram = x.name AND ic.code = x.code),
    how AS (SELECT *, CASE WHEN al IS NOT NULL THEN 'alias' WHEN pn = 1 THEN 'prefix' WHEN pn > 1 AND pcn = 1 AND NOT bare THEN 'prefix+book_code' WHEN pn > 0 THEN NULL WHEN NOT special AND icn = 1 AND starts_with(name, 'blue ') THEN 'contains+book_code' WHEN NOT special THEN NULL WHEN inn = 1 THEN 'contains' WHEN inn > 1 AND icn = 1 AND NOT bare THEN 'contains+book_code' END AS how FROM nm),
    res AS (SELECT name, code, how, CASE how WHEN 'alias' THEN al WHEN 'prefix' THEN p1 WHEN 'prefix+book_code' THEN pc1 WHEN 'contains' THEN i1 WHEN 'contains+book_code' THEN ic1 END AS entry, CASE WHEN how = 'alias' THEN 1 WHEN pn > 0 THEN pn ELSE inn END AS candidates FROM how)"""


def _chains(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), _full_name().alias("full"), "p_brand")
    lines = table(spark, sf, "lineitem").join(part.hint("merge"), "l_partkey")  # its file looks small to the planner
    written = F.array_join(F.slice(F.split("full", " "), 1 + F.col("l_linenumber") % 5, (1 + F.col("l_partkey") % 5).cast("int")), " ")
    at = F.col("l_linenumber") * F.lit(10000000000) + F.col("l_partkey") * 100000 + F.col("l_suppkey")
    return lines.select(F.col("l_orderkey").alias("chain"), at.alias("at"), written.alias("name"), F.when(F.col("l_returnflag") != "A", F.col("p_brand")).otherwise("none").alias("code"))


def _names(spark, sf):
    part = table(spark, sf, "part")
    codes = part.select(F.col("p_partkey").alias("entry"), F.col("p_brand").alias("code"))
    aliases = part.where("p_size = 50").groupBy(F.lower(F.substring_index("p_name", " ", 1)).alias("name")).agg(F.min("p_partkey").alias("entry"))
    return N.name_index(_entries(spark, sf), RULES), codes, aliases


@query(f"WITH {RESOLVED} SELECT name, code, how, entry, candidates FROM res")
def g4_name_cascade(spark, sf):
    """Distinct names of lines' parts, resolved step by step against the names of all parts."""
    return N.resolve(_chains(spark, sf), *_names(spark, sf), RULES)


@query(f"""WITH {RESOLVED}, s AS (SELECT ch.*, res.entry, res.how, res.candidates, lag(res.entry) OVER w AS lft, lead(res.entry) OVER w AS rgt FROM ch JOIN res USING (name, code) WINDOW w AS (PARTITION BY chain ORDER BY ps)),
    adj AS (SELECT entry AS x, rgt AS y, count(*) AS n FROM s WHERE entry IS NOT NULL AND rgt IS NOT NULL GROUP BY 1, 2),
    op AS (SELECT DISTINCT name, lft, rgt FROM s WHERE entry IS NULL AND candidates > 1 AND contains(name, ' blue ') AND NOT starts_with(name, 'blue ') AND name <> 'never this' AND NOT starts_with(name, 'red ') AND NOT starts_with(name, 'navy ')),
    cd AS (SELECT DISTINCT op.name, i.entry AS c FROM op JOIN idx i ON i.gram = op.name AND i.kind = 'prefix' UNION SELECT DISTINCT op.name, i.entry FROM op JOIN idx i ON i.gram = op.name AND i.kind = 'inside' WHERE op.name NOT IN (SELECT gram FROM pn) AND starts_with(op.name, 's')),
    sc AS (SELECT op.name, lft, rgt, c, coalesce(a.n, 0) + coalesce(b.n, 0) AS score FROM op JOIN cd USING (name) LEFT JOIN adj a ON a.x = lft AND a.y = c LEFT JOIN adj b ON b.x = c AND b.y = rgt WHERE coalesce(a.n, 0) + coalesce(b.n, 0) > 0),
    one AS (SELECT name, lft, rgt, min(c) AS c FROM sc GROUP BY 1, 2, 3 HAVING count(*) = 1 AND max(score) >= 1)
    SELECT coalesce(CASE WHEN s.entry IS NULL AND one.c IS NOT NULL THEN 'neighbour' ELSE s.how END, 'open') AS how, count(*) AS n, sum(coalesce(s.entry, one.c, 0)) AS entries FROM s LEFT JOIN one ON one.name = s.name AND one.lft IS NOT DISTINCT FROM s.lft AND one.rgt IS NOT DISTINCT FROM s.rgt AND s.entry IS NULL GROUP BY 1""")
def g5_neighbour_support(spark, sf):
    """How all names of all orders' lines are resolved, neighbours included."""
    out = N.chains_resolved(_chains(spark, sf), *_names(spark, sf), ["never this"], RULES, least=1)
    return out.groupBy(F.coalesce("how", F.lit("open")).alias("how")).agg(F.count("*").alias("n"), F.sum(F.coalesce("entry", F.lit(0))).alias("entries"))


@query("WITH r AS (SELECT CASE WHEN p_partkey <= 500 THEN 1 WHEN p_partkey <= 1200 THEN 2 ELSE 3 END AS vol, p_partkey AS page, p_name AS record FROM part), l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_partkey <= 500 THEN 1 WHEN l_partkey <= 1200 THEN 2 ELSE 3 END AS vol FROM lineitem) SELECT l_orderkey, l_linenumber, l_suppkey, l.vol, a.record AS record_1, b.record AS record_2 FROM l LEFT JOIN r a ON a.vol = l.vol AND a.page = l_partkey + 1 LEFT JOIN r b ON b.vol = l.vol AND b.page = l_partkey + 2")
def g7_page_model(spark, sf):
    volumes = [(500, 1), (1200, 2), (0, 3)]
    vol = F.when(F.col("p_partkey") <= 500, 1).when(F.col("p_partkey") <= 1200, 2).otherwise(3)
    records = table(spark, sf, "part").select(vol.alias("vol"), F.col("p_partkey").alias("page"), F.col("p_name").alias("record"))
    out = A.paged(table(spark, sf, "lineitem"), "l_partkey", volumes, records)
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "vol", "record_1", "record_2")


B4 = gram_sql("benchmark", "item_id", 4)
DPOS4 = f"(SELECT key, gram, min(ps) AS ps FROM (SELECT doc_id AS key, unnest(list_transform(range(1, len(t) - 2), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] || ' ' || t[i + 3])) AS gram, unnest(range(0, len(t) - 3)) AS ps FROM (SELECT doc_id, {tok_sql()} AS t FROM documents) WHERE len(t) >= 4) GROUP BY 1, 2)"
HITS = f"""hits AS (SELECT d.key AS record, b.key AS passage, sum(CASE WHEN ps + 4 <= 60 THEN weight ELSE 0 END) AS head, sum(weight) AS hits FROM (SELECT key, gram, CASE WHEN df = 1 THEN 2 ELSE 1 END AS weight FROM (SELECT key, gram, count(*) OVER (PARTITION BY gram) AS df FROM {B4}) WHERE df <= 3) b JOIN {DPOS4} d ON d.gram = b.gram GROUP BY 1, 2)"""


def _hits(spark, sf):
    return P.passage_hits(table(spark, sf, "documents"), P.passage_grams(table(spark, sf, "benchmark"), "item_id", "text"), "doc_id", "text")


@query(f"WITH {HITS} SELECT record, passage, head, hits FROM hits WHERE hits >= 2")
def i1_gram_index(spark, sf):
    return _hits(spark, sf).where("hits >= 2")


@query(f"WITH {HITS} SELECT record, passage, hits, CASE WHEN row_number() OVER (PARTITION BY record ORDER BY hits DESC, passage) = 1 THEN 'lemma' ELSE 'cited' END AS how FROM hits WHERE hits >= 2")
def i2_cite_only(spark, sf):
    return P.cited_only(_hits(spark, sf))


@query(f"""WITH {HITS}, lem AS (SELECT DISTINCT record FROM hits WHERE hits >= 2) SELECT d.source AS work, count(DISTINCT d.doc_id) AS passages, count(DISTINCT l.record) AS placed, count(DISTINCT h.passage) AS reached, CASE WHEN count(l.record) > 0 THEN 100 END AS lemma_percent
    FROM documents d LEFT JOIN lem l ON l.record = d.doc_id LEFT JOIN hits h ON h.record = d.doc_id AND h.hits >= 2 GROUP BY 1""")
def i3_coverage(spark, sf):
    return P.coverage(table(spark, sf, "documents"), P.cited_only(_hits(spark, sf)), "source", "doc_id")


CONCEPTS = [P.Concept("licence", ("license", "licensed", "public license"), ("general", "gnu", "under"), ("trash",)), P.Concept("insult", ("idiot", "clown", "moron"), (), ("rights",)), P.Concept("rights", ("rights",), ("reserved",), (), ("reserved",))]
_WORDY = f"c AS (SELECT doc_id, lang, {clean_sql()} AS t FROM documents), w AS (SELECT doc_id, lang, t, string_split(t, ' ') AS ws FROM c WHERE t <> ''), p AS (SELECT doc_id, lang, t, ws, i, ws[i] AS w, CASE WHEN i > 1 THEN length(array_to_string(ws[1:i - 1], ' ')) + 1 ELSE 0 END AS ps FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM w) WHERE regexp_matches(ws[i], '^[qld]?(?:licensed|license|idiot|clown|moron|rights|public|reserved)$'))"
_NEAR = "' ' || substr(t, greatest(ps - 150, 0) + 1, ps - greatest(ps - 150, 0)) || ' ' || substr(t, ps + length(w) + 1, 150) || ' '"
_ONE = lambda c, forms, cue, bad: f"SELECT doc_id, lang, '{c}' AS concept, 1 AS raw, CASE WHEN {cue} AND {bad} THEN 1 ELSE 0 END AS kept FROM p WHERE regexp_matches(w, '^[qld]?(?:{forms})$')"


@query(f"""WITH {_WORDY}, h AS (SELECT doc_id, lang, 'licence' AS concept, 1 AS raw, 1 AS kept FROM p WHERE regexp_matches(w, '^[qld]?public$') AND ws[i + 1] = 'license'
    UNION ALL {_ONE('licence', 'licensed|license', f"regexp_matches({_NEAR}, ' [qld]?(?:general|gnu|under) ')", f"NOT regexp_matches({_NEAR}, ' [qld]?(?:trash) ')")} AND NOT (i > 1 AND regexp_matches(ws[i - 1], '^[qld]?public$') AND w = 'license')
    UNION ALL {_ONE('insult', 'idiot|clown|moron', 'true', f"NOT regexp_matches({_NEAR}, ' [qld]?(?:rights) ')")} UNION ALL {_ONE('rights', 'rights', f"regexp_matches({_NEAR}, ' [qld]?(?:reserved) ')", 'true')}
    UNION ALL SELECT doc_id, lang, 'rights', 1, 1 FROM p WHERE lang = 'fr' AND w = 'reserved') SELECT doc_id AS record, concept, CAST(sum(raw) AS INTEGER) AS raw, CAST(sum(kept) AS INTEGER) AS kept FROM h GROUP BY 1, 2""")
def i4_concepts(spark, sf):
    """Concepts that each document names, in all and in their sense; in French ones by their bridge words too."""
    return P.concept_hits(table(spark, sf, "documents"), CONCEPTS, "doc_id", "text", "qld", bridged=F.col("lang") == "fr")


@query(r"""WITH w AS (SELECT 's' || s_nationkey || '.' || s_suppkey || CASE WHEN s_suppkey % 4 = 0 THEN 'Author.' || s_suppkey ELSE '.x' END AS work, s_name AS title, s_suppkey, s_nationkey, CASE WHEN s_acctbal > 0 THEN 'typed' ELSE 'ocr' END AS st FROM supplier), n AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
    c AS (SELECT l_suppkey AS k, count(*) FILTER (WHERE l_returnflag = 'N') AS corr, count(*) AS rec FROM lineitem WHERE l_linenumber > 3 GROUP BY 1), r AS (SELECT DISTINCT w.work, 'ref' || n_nationkey AS ref FROM w JOIN nation ON starts_with(w.work, 's' || n_nationkey || '.') WHERE n_regionkey < 3)
    SELECT w.work, title, CASE WHEN regexp_extract(w.work, '(?:^|\.)(\d{4})[A-Z]', 1) <> '' THEN CAST(regexp_extract(w.work, '(?:^|\.)(\d{4})[A-Z]', 1) AS INTEGER) WHEN contains(lower(w.work), 'author.8') THEN 808 WHEN s_nationkey = 3 THEN 333 END AS death, st AS source_type, coalesce(n.n, 0) AS witnesses, corr || '/' || rec AS corroborated, coalesce(ref, '') AS refs
    FROM w LEFT JOIN n ON n.k = s_suppkey LEFT JOIN c ON c.k = s_suppkey LEFT JOIN r ON r.work = w.work""")
def i5_works_meta(spark, sf):
    """What is known of each work: suppliers as works, their lines as witnesses, nations as references by prefix."""
    key = F.concat(F.lit("s"), F.col("s_nationkey").cast("string"), F.lit("."), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("Author."), F.col("s_suppkey").cast("string"))).otherwise(".x"))
    s = table(spark, sf, "supplier").select("s_suppkey", key.alias("work"), F.col("s_name").alias("title"), F.when(F.col("s_acctbal") > 0, "typed").otherwise("ocr").alias("source_type"))
    lines = table(spark, sf, "lineitem").join(s.select(F.col("s_suppkey").alias("l_suppkey"), "work"), "l_suppkey")
    confidence = lines.where("l_linenumber > 3").groupBy("work").agg(F.count_if(F.col("l_returnflag") == "N").alias("corroborated"), F.count("*").alias("records"))
    refs = table(spark, sf, "nation").where("n_regionkey < 3").select(F.concat(F.lit("s"), F.col("n_nationkey").cast("string"), F.lit(".*")).alias("covers"), F.concat(F.lit("ref"), F.col("n_nationkey").cast("string")).alias("ref"))
    return A.works_meta(s, lines, confidence, refs, {"author.8": 808}, {"s3": 333})
