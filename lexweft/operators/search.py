"""Full-text search over postings: boolean, phrase, prefix and NEAR queries, root queries, BM25, the whole search front end.

Postings are one row for each token: (uid, term, pos), normalised under a profile, so that vowelled and bare texts are found
alike. They are built once, in a scan without a shuffle, and are meant to be stored sorted by term (see sources.sinks); every
query reads the rows of its own terms only. Terms given to the functions are normalised already; `search` and
`match_expression` normalise what a user writes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import LATIN, Profile
from . import graph


def postings(docs: DataFrame, uid: str = "doc_id", text_col: str = "text", p: Profile = LATIN) -> DataFrame:
    return docs.select(F.col(uid).alias("uid"), F.posexplode(T.tokens(text_col, p)).alias("pos", "term"))


def root_analysis(words: DataFrame, analyse: Column) -> DataFrame:
    """(term, root) of distinct words (term), each analysed once; analyse gives an array of roots for `term`, empty for words
    of no root. Any function over the words will do: a Column expression, or a kernel of an analyser."""
    return words.select("term").distinct().select("term", F.explode(F.array_distinct(analyse)).alias("root"))


def root_postings(posts: DataFrame, analysis: DataFrame) -> DataFrame:
    """(uid, term, pos) with roots in the place of terms; a word of several roots stands there several times."""
    return posts.join(analysis, "term").select("uid", F.col("root").alias("term"), "pos")


def match_all(posts: DataFrame, terms: list[str]) -> DataFrame:
    """uid of the documents that have every term."""
    return posts.where(F.col("term").isin(*terms)).groupBy("uid").agg(F.countDistinct("term").alias("n")).where(F.col("n") == len(set(terms))).select("uid")


def match_any(posts: DataFrame, terms: list[str]) -> DataFrame:
    return posts.where(F.col("term").isin(*terms)).select("uid").distinct()


def match_prefix(posts: DataFrame, prefix: str) -> DataFrame:
    return posts.where(F.col("term").startswith(prefix)).select("uid").distinct()


def match_groups(posts: DataFrame, groups: list[list[str]]) -> DataFrame:
    """uid of the documents that have at least one term of each group (a root's variants, or-ed within and-ed ones)."""
    hit = F.array_compact(F.array(*[F.when(F.col("term").isin(*g), F.lit(i)) for i, g in enumerate(groups)]))
    wanted = posts.where(F.col("term").isin(*sorted({t for g in groups for t in g})))
    return wanted.select("uid", F.explode(hit).alias("g")).groupBy("uid").agg(F.countDistinct("g").alias("n")).where(F.col("n") == len(groups)).select("uid")


def match_phrase(posts: DataFrame, terms: list[str], prefix: bool = False) -> DataFrame:
    """uid and number of places where the terms stand one after the other; prefix: the last one is the start of a term.

    Each posting votes for the place where its phrase would start; a place with a vote for every term is a hit. One
    aggregation, and no join of positions with positions.
    """
    whole = terms[:-1] if prefix else terms
    fits = lambda i: F.col("term").startswith(terms[i]) if prefix and i == len(terms) - 1 else F.col("term") == terms[i]
    wanted = posts.where(F.col("term").isin(*whole) | fits(len(terms) - 1) if whole else fits(0))
    starts = F.array_compact(F.array(*[F.when(fits(i), F.col("pos") - i) for i in range(len(terms))]))
    found = wanted.select("uid", F.explode(starts).alias("start")).groupBy("uid", "start").agg(F.count("*").alias("n")).where(F.col("n") == len(terms))
    return found.groupBy("uid").agg(F.count("*").alias("hits"))


def match_near(posts: DataFrame, groups: list[list[str]], k: int) -> DataFrame:
    """uid of the documents where a term of each group stands, with at most k terms between the first and the last of them.

    For each posting the nearest term of every group up to it is enough: one window over the wanted postings, no pairs.
    """
    wanted = posts.where(F.col("term").isin(*sorted({t for g in groups for t in g})))
    w = Window.partitionBy("uid").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = [F.last(F.when(F.col("term").isin(*g), F.col("pos")), ignorenulls=True).over(w).alias(f"g{i}") for i, g in enumerate(groups)]
    nearest = [F.col(f"g{i}") for i in range(len(groups))]
    every = reduce(lambda a, b: a & b, [c.isNotNull() for c in nearest])
    first = F.least(*nearest) if len(nearest) > 1 else nearest[0]
    return wanted.select("uid", "pos", *seen).where(every & (F.col("pos") - first - 1 <= k)).select("uid").distinct()


# ---- the query language

_LEXER = re.compile(r'"[^"]*"\*?|NEAR\s*\(|[()+]|[^\s()"+]+')


def parse(text: str, p: Profile = LATIN) -> tuple:
    """A query as a tree: ("and" | "or", parts), ("not", a, b), ("phrase", terms, prefix) or ("near", groups, k).

    Words stand for themselves, all of them wanted; "..." is a phrase, x* a prefix, AND, OR and NOT combine (in this order of
    strength, after words that simply follow each other), NEAR(a b, k) wants its terms close, brackets group.
    """
    tokens, at = _LEXER.findall(text), 0

    def peek() -> str | None:
        return tokens[at] if at < len(tokens) else None

    def take() -> str:
        nonlocal at
        if at >= len(tokens):
            raise ValueError(f"the query ends too early: {text!r}")
        at += 1
        return tokens[at - 1]

    def chain(word: str, below):
        parts = [below()]
        while peek() == word:
            take()
            parts.append(below())
        return parts

    def any_of() -> tuple:
        parts = chain("OR", all_of)
        return parts[0] if len(parts) == 1 else ("or", parts)

    def all_of() -> tuple:
        parts = chain("AND", without)
        return parts[0] if len(parts) == 1 else ("and", parts)

    def without() -> tuple:
        parts = chain("NOT", row)
        return reduce(lambda a, b: ("not", a, b), parts)

    def row() -> tuple:
        parts = [one()]
        while peek() not in (None, ")", "OR", "AND", "NOT"):
            parts.append(one())
        parts = [x for x in parts if x != ("phrase", (), False)]
        return parts[0] if len(parts) == 1 else ("and", parts) if parts else ("phrase", (), False)

    def one() -> tuple:
        token = take()
        if token == "(":
            tree = any_of()
            if take() != ")":
                raise ValueError(f"a bracket is open: {text!r}")
            return tree
        if token.startswith("NEAR") and token.endswith("("):
            inside = []
            while peek() not in (None, ")"):
                inside.append(take())
            take()
            words, _, k = " ".join(inside).partition(",")
            groups = [[t] for t in p.tokens(words)]
            if not groups:
                raise ValueError(f"NEAR without words: {text!r}")
            return ("near", groups, int(k) if k.strip() else 10)
        if token in (")", "+", "OR", "AND", "NOT"):
            raise ValueError(f"{token} stands alone: {text!r}")
        prefix = token.endswith("*")
        return ("phrase", tuple(p.tokens(token)), prefix)

    tree = any_of()
    if at < len(tokens):
        raise ValueError(f"a bracket too many: {text!r}")
    return tree


def _leaves(tree: tuple, found: list[tuple]) -> tuple:
    """The tree with numbers of its distinct leaves."""
    if tree[0] in ("and", "or"):
        return (tree[0], [_leaves(x, found) for x in tree[1]])
    if tree[0] == "not":
        return ("not", _leaves(tree[1], found), _leaves(tree[2], found))
    if tree not in found:
        found.append(tree)
    return ("leaf", found.index(tree))


def matching(posts: DataFrame, tree: tuple) -> DataFrame:
    """uid of the documents that a query tree holds for; each leaf is found by itself, and one aggregation combines them."""
    leaves: list[tuple] = []
    numbered = _leaves(tree, leaves)
    single = {x[1][0]: i for i, x in enumerate(leaves) if x[0] == "phrase" and len(x[1]) == 1 and not x[2]}
    parts = []
    if len(leaves) - len(single) + bool(single) > 1:  # several passes: over the rows of the query's own terms, kept once
        whole = {t for x in leaves for t in (x[1] if x[0] == "phrase" else [t for g in x[1] for t in g])}
        starts = [F.col("term").startswith(x[1][-1]) for x in leaves if x[0] == "phrase" and x[2] and x[1]]
        posts = graph.checkpointed(posts.where(reduce(lambda a, b: a | b, starts, F.col("term").isin(*sorted(whole)))))
    if single:
        number = F.create_map(*[F.lit(v) for kv in single.items() for v in kv])
        parts.append(posts.where(F.col("term").isin(*single)).select("uid", number[F.col("term")].alias("leaf")))
    for i, leaf in enumerate(leaves):
        if i in single.values():
            continue
        if leaf[0] == "near":
            hits = match_near(posts, leaf[1], leaf[2])
        elif not leaf[1]:
            hits = posts.limit(0)
        else:
            hits = match_phrase(posts, list(leaf[1]), leaf[2])
        parts.append(hits.select("uid", F.lit(i).alias("leaf")))

    def holds(t: tuple) -> Column:
        if t[0] == "leaf":
            return F.col(f"l{t[1]}")
        if t[0] == "not":
            return holds(t[1]) & ~holds(t[2])
        return reduce((lambda a, b: a & b) if t[0] == "and" else (lambda a, b: a | b), [holds(x) for x in t[1]])

    flags = reduce(DataFrame.unionByName, parts).groupBy("uid").agg(*[F.bool_or(F.col("leaf") == i).alias(f"l{i}") for i in range(len(leaves))])
    return flags.where(holds(numbered)).select("uid")


def match_expression(posts: DataFrame, text: str, p: Profile = LATIN) -> DataFrame:
    return matching(posts, parse(text, p))


def query_terms(tree: tuple) -> list[str]:
    """The terms of a query that may stand in a text; those after NOT don't count."""
    if tree[0] in ("and", "or"):
        return sorted({t for x in tree[1] for t in query_terms(x)})
    if tree[0] == "not":
        return query_terms(tree[1])
    return sorted(set(tree[1])) if tree[0] == "phrase" else sorted({t for g in tree[1] for t in g})


def vocabulary(posts: DataFrame) -> DataFrame:
    return posts.groupBy("term").agg(F.count("*").alias("freq"))


def bm25(posts: DataFrame, terms: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """uid and BM25 score of the documents that have a term. Only one row of collection statistics and one for each term
    are joined to the postings."""
    lengths = posts.groupBy("uid").agg(F.count("*").alias("len"))
    stats = lengths.agg(F.count("*").alias("docs"), F.avg("len").alias("avg_len"))
    tf = posts.where(F.col("term").isin(*terms)).groupBy("uid", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    joined = tf.join(F.broadcast(df), "term").join(lengths, "uid").crossJoin(F.broadcast(stats))  # one row, and one a term
    idf = F.log1p((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return joined.groupBy("uid").agg(F.sum(part).alias("score"))


# ---- the front end

#: Levels of collated pages from the least on, and source types that are always kept.
LEVELS = ["unmatched", "divergent", "partial", "corroborated", "verified"]
TYPED = ["ganjoor", "openiti", "shamela", "typed"]
LOC_FIELDS = ["vol", "part", "page_before", "page", "leaf", "printed_page", "poem_number"]


@dataclass
class QuerySpec:
    """A search: what is asked, the filters, and how hits are shown. Filters that are empty, null or 0 are off."""

    query: str = ""
    raw: bool = False
    roots: list[str] = field(default_factory=list)
    near: int = 0
    authors: list[str] = field(default_factory=list)
    works: list[str] = field(default_factory=list)
    langs: list[str] = field(default_factory=list)
    attributions: list[str] = field(default_factory=list)
    all_versions: bool = False
    hadith_only: bool = False
    caliph: str = ""
    narrator: str = ""
    graded: str = ""
    agreed: bool = False
    max_weakest_rank: int = 0
    verse: tuple[int, int] | None = None
    how: list[str] = field(default_factory=list)
    concept: str = ""
    min_level: str = ""
    before: int | None = None
    after: int | None = None
    chrono: bool = False
    ocr: bool = False
    limit: int = 20


def spec_tree(spec: QuerySpec, p: Profile = LATIN) -> tuple | None:
    """The query tree of the words asked for, or null if none are."""
    if not spec.query:
        return None
    return parse(spec.query, p) if spec.raw else ("and", [("phrase", (t,), False) for t in p.tokens(spec.query)])


def matched(spec: QuerySpec, posts: DataFrame, roots: DataFrame | None, p: Profile = LATIN, variants=lambda r: [r]) -> DataFrame | None:
    """uid of the units that the words and the roots are found in; null if neither is asked for.

    roots: postings of roots. variants gives the forms of a root that count as it; near wants all roots within so many words.
    """
    parts = []
    tree = spec_tree(spec, p)
    if tree is not None:
        parts.append(matching(posts, tree) if tree[1] else posts.select("uid").limit(0))
    if spec.roots:
        groups = [list(variants(r)) for r in spec.roots]
        parts.append(match_near(roots, groups, spec.near) if spec.near and len(groups) > 1 else match_groups(roots, groups))
    return reduce(lambda a, b: a.join(b, "uid", "left_semi"), parts) if parts else None


def unit_filter(spec: QuerySpec) -> Column:
    """The filters over a unit's own columns: author, work, lang, attribution, primary_version."""
    tests = [F.col(c).isin(*v) for c, v in (("author", spec.authors), ("work", spec.works), ("lang", spec.langs), ("attribution", spec.attributions)) if v]
    if not spec.all_versions:
        tests.append(F.col("primary_version"))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def citation_filter(spec: QuerySpec) -> Column:
    """The filters over source_type, level and death; a unit without a death year fails the bounds, one without a level any level."""
    tests = []
    if spec.min_level:
        tests.append(F.col("source_type").isin(*TYPED) | F.col("level").isin(*LEVELS[LEVELS.index(spec.min_level) :]))
    if spec.before is not None:
        tests.append(F.col("death") <= spec.before)
    if spec.after is not None:
        tests.append(F.col("death") >= spec.after)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def hadith_filter(spec: QuerySpec) -> Column:
    """The filters over hadith_id, caliph, narrator_key, grades, agreed_upon, weakest_rank; a null rank fails a bound."""
    tests = []
    if spec.hadith_only or spec.caliph or spec.narrator or spec.graded or spec.agreed or spec.max_weakest_rank:
        tests.append(F.col("hadith_id").isNotNull())
    if spec.caliph:
        tests.append(F.col("caliph") == spec.caliph)
    if spec.narrator:
        tests.append(F.col("narrator_key") == spec.narrator)
    if spec.graded:
        tests.append(F.ilike("grades", F.lit(f"%{spec.graded}%")))
    if spec.agreed:
        tests.append(F.col("agreed_upon"))
    if spec.max_weakest_rank:
        tests.append(F.col("weakest_rank") <= spec.max_weakest_rank)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def members(refs: DataFrame, spec: QuerySpec) -> DataFrame:
    """uid of the units that a verse index (uid, sura, aya, how) has at the verse asked for, in one of the ways asked for."""
    sura, aya = spec.verse
    found = refs.where((F.col("sura") == sura) & (F.col("aya") == aya))
    return (found.where(F.col("how").isin(*spec.how)) if spec.how else found).select("uid").distinct()


def how_list(refs: DataFrame, sura: int, aya: int) -> DataFrame:
    """(uid, verse_how): the ways in which each unit has a verse, sorted."""
    return refs.where((F.col("sura") == sura) & (F.col("aya") == aya)).groupBy("uid").agg(F.array_join(F.array_sort(F.collect_set("how")), ",").alias("verse_how"))


def assembled(spec: QuerySpec, t: dict[str, DataFrame], p: Profile = LATIN, variants=lambda r: [r]) -> DataFrame:
    """The units that a search finds, one row each, with what the layers say of them.

    t: units (uid, work, author, lang, attribution, source_type, primary_version, text), postings, and where they are needed
    roots, work_meta (work, death, title, page_note), unit_conf (uid, level), unit_loc (uid, LOC_FIELDS, head), heads (head,
    heading), unit_reading (uid, reading, changes), verse_refs, concept_refs (uid, concept), hadith_units (uid, hadith_id) and
    hadith. A unit of several hadith that pass has the one with the smallest id.
    """
    units = t["units"].where(unit_filter(spec))
    hits = matched(spec, t.get("postings"), t.get("roots"), p, variants)
    if hits is None and not spec.verse and not spec.concept:
        raise ValueError("a search needs words, roots, a verse or a concept")
    if hits is not None:
        units = units.join(hits, "uid", "left_semi")
    if spec.verse:
        units = units.join(members(t["verse_refs"], spec), "uid", "left_semi").join(how_list(t["verse_refs"], *spec.verse), "uid", "left")
    if spec.concept:
        units = units.join(t["concept_refs"].where(F.col("concept") == spec.concept).select("uid").distinct(), "uid", "left_semi")
    for name, key in (("work_meta", "work"), ("unit_conf", "uid"), ("unit_loc", "uid"), ("heads", "head"), ("unit_reading", "uid")):
        if name in t and key in units.columns:
            units = units.join(t[name], key, "left")
    if "death" in units.columns or spec.min_level or spec.before is not None or spec.after is not None:
        units = units.where(citation_filter(spec))
    if "hadith" in t:
        # Joined and filtered before one is chosen, as a unit counts if one of its hadith passes.
        units = units.join(t["hadith_units"].join(t["hadith"], "hadith_id"), "uid", "left").where(hadith_filter(spec))
        units = first_of(units, "uid", [F.col("hadith_id").asc_nulls_last()])
    if set(LOC_FIELDS) <= set(units.columns):
        parts = {("page" if c == "page_before" else c): (F.col(c) + 1 if c == "page_before" else F.col(c)) for c in LOC_FIELDS if c != "page"}
        units = units.withColumn("loc", T.locator(parts))
    shown = F.col("text") if spec.ocr or "reading" not in units.columns else F.coalesce("reading", "text")
    return units.withColumn("shown", shown)


def search(spec: QuerySpec, t: dict[str, DataFrame], p: Profile = LATIN, variants=lambda r: [r]) -> DataFrame:
    """The first `limit` hits, with their rank: by relevance, else by unit, or by the author's death year (chrono)."""
    found = assembled(spec, t, p, variants)
    tree = spec_tree(spec, p)
    order = [F.col("uid")]
    if spec.chrono:
        order = [F.coalesce("death", F.lit(9999)), F.col("uid")]
    elif tree is not None and query_terms(tree):
        found = found.join(bm25(t["postings"], query_terms(tree)), "uid", "left")
        order = [F.desc(F.round(F.coalesce("score", F.lit(0.0)), 9)), F.col("uid")]
    top = found.orderBy(*order).limit(spec.limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # of `limit` rows


def total(spec: QuerySpec, t: dict[str, DataFrame], p: Profile = LATIN) -> DataFrame:
    return assembled(spec, t, p).agg(F.countDistinct("uid").alias("total"))


def by_author(spec: QuerySpec, t: dict[str, DataFrame], p: Profile = LATIN) -> DataFrame:
    """(author, work, attribution, n, total) of the units found; authors with most units first, or the oldest (chrono)."""
    found = assembled(spec, t, p)
    n = found.groupBy("author", "work", "attribution").agg(F.countDistinct("uid").alias("n"), F.min(F.coalesce("death", F.lit(9999)) if "death" in found.columns else F.lit(9999)).alias("death"))
    author = n.groupBy(F.col("author").alias("a")).agg(F.sum("n").alias("total"), F.min("death").alias("first"))
    out = n.join(author, F.col("author").eqNullSafe(F.col("a")))
    return out.orderBy(*([F.col("first")] if spec.chrono else [F.desc("total")]), "author", F.desc("n"), "work").select("author", "work", "attribution", "n", "total")


def parallels(hadith: DataFrame, hadith_id, id_col: str = "hadith_id", group_col: str = "parallel_group") -> DataFrame:
    """All versions of a record's group, itself included; none if it has no group."""
    group = hadith.where((F.col(id_col) == hadith_id) & F.col(group_col).isNotNull()).select(F.col(group_col).alias("g_"))
    return hadith.join(F.broadcast(group), F.col(group_col) == F.col("g_"), "left_semi")  # one row


def first_of(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row for each key: the first in the given order."""
    return df.withColumn("rank_", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("rank_ = 1").drop("rank_")


def top_per(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """At most n rows for each key, with their rank. Each task keeps n of a key before they meet, so a hot key is no hot task."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def placed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with each row's place (from 1) in an order of all rows.

    Rows are dealt by ranges of the order and sorted there; a row's place is its place in its part after the rows of the parts
    before, so no task sees them all. The sorted rows are kept, so that counting and numbering see the same parts.
    """
    dealt = graph.checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part_", F.spark_partition_id()).withColumn("at_", F.monotonically_increasing_id()))
    sizes = dealt.groupBy("part_").agg(F.count("*").alias("n"), F.min("at_").alias("first")).collect()  # one row a part
    starts, before = [], 0
    for r in sorted(sizes, key=lambda r: r["part_"]):
        starts.append((r["part_"], before - r["first"]))
        before += r["n"]
    start = df.sparkSession.createDataFrame(starts, "p_ int, start_ long")
    return dealt.join(F.broadcast(start), F.col("part_") == F.col("p_")).withColumn(name, F.col("at_") + F.col("start_") + 1).drop("part_", "at_", "p_", "start_")


def name_table(records: DataFrame, names: dict[str, list[str]], key: str, text_col: str, p: Profile = LATIN) -> DataFrame:
    """(name, docs, n, first_doc): for each name the records that have one of its forms, how often they have them, and the first
    such record; names without any have 0 and null."""
    forms = {form: name for name, fs in names.items() for form in {t for f in fs for t in p.tokens(f)}}
    number = F.create_map(*[F.lit(x) for kv in forms.items() for x in kv])
    found = postings(records, key, text_col, p).where(F.col("term").isin(*forms)).groupBy("uid", number[F.col("term")].alias("name")).agg(F.count("*").alias("c"))
    counts = found.groupBy("name").agg(F.count("*").alias("docs"), F.sum("c").alias("n"), F.min("uid").alias("first_doc"))
    every = records.sparkSession.createDataFrame([(n,) for n in names], "name string")
    return every.join(counts, "name", "left").fillna(0, ["docs", "n"])


# ---- phrase scan without an index


def phrase_pattern(phrase: str, proclitics: str = "", bridged: list[str] = ()) -> str:
    """A pattern for a cleaned text between spaces: each word with an optional proclitic, or a bridged phrase without."""
    own = " ".join(f"[{proclitics}]?{w}" if proclitics else w for w in phrase.split())
    return " (?:" + "|".join([own, *bridged]) + ") "


def bridged_pattern(phrase: str, bridge: dict[str, list[str]], proclitics: str = "", p: Profile = LATIN) -> str:
    """The pattern of what a user writes; if it is a term of the bridge, its synonyms count too (without proclitics)."""
    clean = p.clean(phrase)
    synonyms = next((v for k, v in bridge.items() if p.clean(k) == clean), [])
    return phrase_pattern(clean, proclitics, [p.clean(s) for s in synonyms])


def line_pattern(phrase: str, variants: dict[str, str], marks: str, p: Profile = LATIN) -> str:
    """A pattern that every raw line with the phrase matches: its longest word, letters with their variants' classes and
    optional marks between them. It is looked for without regard to case."""
    word = max(p.clean(phrase).split(), key=lambda w: (len(w), w), default="")
    classes = [f"[{re.escape(c + variants.get(c, ''))}]" for c in word]
    return "(?iu)" + f"[{marks}]*".join(classes)


def phrase_scan(docs: DataFrame, phrases: dict[str, str], uid: str = "doc_id", text_col: str = "text", p: Profile = LATIN) -> DataFrame:
    """(phrase, uid) of every document that has a phrase; all phrases in one pass over the texts. phrases: pattern by name.

    The phrases are literals of the plan, so nothing is shuffled or broadcast.
    """
    padded = F.concat(F.lit(" "), T.clean(text_col, p), F.lit(" "))
    hits = F.array_compact(F.array(*[F.when(F.col("cleaned_").rlike(x), F.lit(n)) for n, x in phrases.items()]))
    kept = [c for c in docs.columns if c != text_col]
    return docs.withColumn("cleaned_", padded).select(*kept, "cleaned_", F.explode(hits).alias("phrase")).drop("cleaned_")


def phrase_contexts(docs: DataFrame, phrases: dict[str, str], work: str, uid: str = "doc_id", text_col: str = "text", p: Profile = LATIN, limit: int = 20, around: int = 60) -> DataFrame:
    """The first `limit` documents of each phrase by uid, with the number of documents of the same work that have it, and the
    cleaned text around its first place there, `around` characters on either side."""
    padded = F.concat(F.lit(" "), T.clean(text_col, p), F.lit(" "))

    def hit(name: str, pattern: str) -> Column:
        at = F.regexp_instr("cleaned_", F.lit(pattern))
        return F.when(at > 0, F.struct(F.lit(name).alias("phrase"), at.alias("at"), F.length(F.regexp_extract("cleaned_", pattern, 0)).alias("n")))

    hits = F.array_compact(F.array(*[hit(n, x) for n, x in phrases.items()]))
    found = docs.select(uid, work, padded.alias("cleaned_")).select(uid, work, "cleaned_", F.explode(hits).alias("h"))
    start = F.greatest(F.col("h.at") - around, F.lit(1))
    context = F.trim(F.substring("cleaned_", start, F.col("h.at") + F.col("h.n") + around - start))
    found = found.select(uid, work, "h.phrase", context.alias("context"))
    n = found.groupBy(F.col("phrase").alias("c_phrase"), F.col(work).alias("c_work")).agg(F.count("*").alias("n"))
    top = top_per(found, ["phrase"], [F.col(uid)], limit)
    return top.join(n, (F.col("phrase") == F.col("c_phrase")) & F.col(work).eqNullSafe(F.col("c_work"))).select("phrase", work, "n", uid, "context")


# ---- lookup


def lookup(index: DataFrame, meta: DataFrame, works: list[str] = (), per_work: int = 3, order: list[Column] | None = None) -> DataFrame:
    """Passages of an index (work, uid, ...), at most per_work of each work, with the work's meta data (work, death, ...); the
    oldest works first. works: keys, their prefixes before a dot, or their folders (what stands before the first dot)."""
    wanted = reduce(lambda a, b: a | b, [(F.col("work") == w) | F.col("work").startswith(f"{w}.") | (F.substring_index("work", ".", 1) == w) for w in works], F.lit(not works))
    top = top_per(index.where(wanted), ["work"], order or [F.col("uid")], per_work)
    return top.join(meta, "work", "left").orderBy(F.coalesce("death", F.lit(9999)), "work", "rank")
