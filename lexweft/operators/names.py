"""Entity names: an index of a dictionary's names, a cascade that resolves names, neighbours in chains that settle the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass(frozen=True)
class NameRules:
    """Words that open a by-name (`kunya`), that stand between a name and the father's (`lineage`; the first one is the usual
    form), and what an epithet starts with (`article`)."""

    kunya: tuple[str, ...]
    lineage: tuple[str, ...]
    article: str
    longest: int = 8


def _shuffled(df: DataFrame) -> DataFrame:
    """df as a side that no join broadcasts: what grows with the dictionary or the chains looks small to the planner, which goes
    by the size of compressed files."""
    return df.hint("merge")


def _runs(w: Column, j: Column, sizes: tuple[int, ...]) -> Column:
    return F.transform(F.array(*[F.lit(n) for n in sizes]), lambda n: F.array_join(F.slice(w, j + 1, n), " "))


def name_index(entries: DataFrame, rules: NameRules) -> DataFrame:
    """(entry, kind, gram), each once, of a dictionary's names (entry, name: normalised).

    prefix: a name's first 1 to `longest` words. inside: what identifies a person in the middle of a name, that is a by-name
    that isn't an ancestor's and lineages (each with up to three further words), and epithets.
    """
    w = F.filter(F.split("name", " "), lambda x: x != "")
    prefix = T.let(w, lambda t: F.transform(F.sequence(F.lit(1), F.lit(rules.longest)), lambda n: F.array_join(F.slice(t, F.lit(1), n), " ")))

    def at(t: Column, x: Column, j: Column) -> Column:
        before = F.when(j > 0, F.get(t, j - 1))
        by_name = x.isin(*rules.kunya) & ((j == 0) | ~before.isin(*rules.lineage))
        none = F.array().cast("array<string>")
        return F.when(by_name, _runs(t, j, (2, 3, 4))).when(x.startswith(rules.article) & (j > 0), F.array(x)).when((x == rules.lineage[0]) & (j > 0), _runs(t, j, (2, 3, 4))).otherwise(none)

    inside = T.let(w, lambda t: F.flatten(F.transform(t, lambda x, j: at(t, x, j))))
    rows = entries.where(F.size(w) > 0).select("entry", F.explode(F.array(F.struct(F.lit("prefix").alias("kind"), prefix.alias("grams")), F.struct(F.lit("inside").alias("kind"), inside.alias("grams")))).alias("k"))
    return rows.select("entry", "k.kind", F.explode(F.array_distinct("k.grams")).alias("gram"))


def _counts(index: DataFrame, kind: str, codes: DataFrame | None = None) -> DataFrame:
    rows = index.where(F.col("kind") == kind)
    if codes is None:
        return rows.groupBy("gram").agg(F.count("*").alias("n"), F.min("entry").alias("one"))
    return rows.join(_shuffled(codes), "entry").groupBy("gram", "code").agg(F.count("*").alias("n"), F.min("entry").alias("one"))


def _special(rules: NameRules) -> Column:
    """Whether a name is a by-name or an epithet."""
    out = F.col("name").startswith(rules.article)
    for k in rules.kunya:
        out = out | F.col("name").startswith(f"{k} ")
    return out


def resolve(names: DataFrame, index: DataFrame, codes: DataFrame, aliases: DataFrame, rules: NameRules) -> DataFrame:
    """(name, code, entry, how, candidates) of distinct names (name, code); a name that isn't resolved has a null entry.

    In order: an alias (aliases: name, entry); the only entry that starts with the name; of several the only one with the
    book's code (codes: entry, code), unless the name is a bare by-name; then, for by-names and epithets, the only entry that
    has it inside, again with the code; a lineage alone counts only with the code. Where a step has candidates but no choice,
    their number is given and later steps don't count.
    """
    distinct = names.select("name", "code").distinct()
    out = distinct.join(_shuffled(aliases.groupBy("name").agg(F.min("entry").alias("alias"))), "name", "left")
    for kind, short in (("prefix", "p"), ("inside", "i")):
        n = _counts(index, kind).select(F.col("gram").alias(f"{short}_gram"), F.col("n").alias(f"{short}_n"), F.col("one").alias(f"{short}_one"))
        c = _counts(index, kind, codes).select(F.col("gram").alias(f"{short}c_gram"), F.col("code").alias(f"{short}c_code"), F.col("n").alias(f"{short}c_n"), F.col("one").alias(f"{short}c_one"))
        out = out.join(_shuffled(n), F.col("name") == F.col(f"{short}_gram"), "left").join(_shuffled(c), (F.col("name") == F.col(f"{short}c_gram")) & (F.col("code") == F.col(f"{short}c_code")), "left")
    bare = (F.size(F.split("name", " ")) == 2) & F.substring_index("name", " ", 1).isin(*rules.kunya)
    special, lineage = _special(rules), F.col("name").startswith(f"{rules.lineage[0]} ")
    step = lambda entry, how, n: F.struct(entry.alias("entry"), F.lit(how).alias("how"), n.alias("candidates"))
    none = F.lit(None).cast(out.schema["p_one"].dataType)
    p_n, i_n = F.coalesce("p_n", F.lit(0)), F.coalesce("i_n", F.lit(0))
    choice = (
        F.when(F.col("alias").isNotNull(), step(F.col("alias"), "alias", F.lit(1).cast("long")))
        .when(p_n == 1, step(F.col("p_one"), "prefix", p_n))
        .when((p_n > 1) & (F.col("pc_n") == 1) & ~bare, step(F.col("pc_one"), "prefix+book_code", p_n))
        .when(p_n > 0, step(none, None, p_n))
        .when(~special & (F.col("ic_n") == 1) & lineage, step(F.col("ic_one"), "contains+book_code", i_n))
        .when(~special, step(none, None, i_n))
        .when(i_n == 1, step(F.col("i_one"), "contains", i_n))
        .when((i_n > 1) & (F.col("ic_n") == 1) & ~bare, step(F.col("ic_one"), "contains+book_code", i_n))
        .otherwise(step(none, None, i_n))
    )
    return out.select("name", "code", choice.alias("c")).select("name", "code", "c.entry", "c.how", "c.candidates")


def candidate_entries(names: DataFrame, index: DataFrame, rules: NameRules) -> DataFrame:
    """(name, entry) of all that a distinct name could be: what starts with it, else, for by-names and epithets, what has it inside."""
    prefix = names.select("name").distinct().join(_shuffled(index.where("kind = 'prefix'").select(F.col("gram").alias("name"), "entry")), "name")
    rest = names.select("name").distinct().where(_special(rules)).join(_shuffled(prefix.select("name")), "name", "left_anti")
    return prefix.unionByName(rest.join(_shuffled(index.where("kind = 'inside'").select(F.col("gram").alias("name"), "entry")), "name"))


def chains_resolved(chains: DataFrame, index: DataFrame, codes: DataFrame, aliases: DataFrame, never: list[str], rules: NameRules, least: int = 2) -> DataFrame:
    """chains (chain, at, name, code) with entry, how and candidates.

    Names are resolved one by one first. A name of several candidates is then settled by its neighbours, if it has a father's
    name and isn't one of `never`: by the only candidate that was found (at least `least` times, in the first step) next to
    the entry before or after it.
    """
    known = chains.join(_shuffled(resolve(chains, index, codes, aliases, rules)), ["name", "code"])
    w = Window.partitionBy("chain").orderBy("at")
    placed = known.withColumns({"left_": F.lag("entry").over(w), "right_": F.lead("entry").over(w)})
    adjacent = placed.where("entry IS NOT NULL AND right_ IS NOT NULL").groupBy(F.col("entry").alias("x"), F.col("right_").alias("y")).agg(F.count("*").alias("n"))
    middle = F.contains("name", F.lit(f" {rules.lineage[0]} ")) & ~F.col("name").startswith(f"{rules.lineage[0]} ") & ~F.col("name").isin(*never, "")
    for k in rules.kunya:
        middle = middle & ~F.col("name").startswith(f"{k} ")
    # Each distinct name between the same neighbours once, however often it stands there.
    open_ = placed.where(F.col("entry").isNull() & (F.col("candidates") > 1) & middle).select("name", "left_", "right_").distinct()
    options = open_.join(_shuffled(candidate_entries(open_, index, rules).withColumnRenamed("entry", "c")), "name")
    before = adjacent.select(F.col("x").alias("left_"), F.col("y").alias("c"), F.col("n").alias("n_left"))
    after = adjacent.select(F.col("x").alias("c"), F.col("y").alias("right_"), F.col("n").alias("n_right"))
    score = options.join(_shuffled(before), ["left_", "c"], "left").join(_shuffled(after), ["c", "right_"], "left").withColumn("score", F.coalesce("n_left", F.lit(0)) + F.coalesce("n_right", F.lit(0))).where("score > 0")
    settled = score.groupBy("name", "left_", "right_").agg(F.count("*").alias("n"), F.min("c").alias("by_neighbour"), F.max("score").alias("score")).where((F.col("n") == 1) & (F.col("score") >= least))
    settled = settled.select(F.col("name").alias("s_name"), F.col("left_").alias("s_left"), F.col("right_").alias("s_right"), "by_neighbour")
    on = (F.col("name") == F.col("s_name")) & F.col("left_").eqNullSafe(F.col("s_left")) & F.col("right_").eqNullSafe(F.col("s_right")) & F.col("entry").isNull()
    out = placed.join(_shuffled(settled), on, "left")
    return out.select("chain", "at", "name", "code", F.coalesce("entry", "by_neighbour").alias("entry"), F.when(F.col("by_neighbour").isNotNull(), "neighbour").otherwise(F.col("how")).alias("how"), "candidates")


def weakest_links(resolved: DataFrame, ranks: DataFrame) -> DataFrame:
    """(chain, names, linked, weakest): how many names each chain has, how many are linked to an entry with a rank, and the
    largest rank among them."""
    r = resolved.join(ranks.select("entry", "rank"), "entry", "left")
    return r.groupBy("chain").agg(F.count("*").alias("names"), F.count("rank").alias("linked"), F.max("rank").alias("weakest"))


def weak_narrators(resolved: DataFrame, ranks: DataFrame, graded: DataFrame, least_rank: int = 8, words: int = 3) -> DataFrame:
    """(chain, at, name, entry, rank) of names of at least `words` words that are linked to an entry of least_rank or worse, in
    chains without a verdict (graded: chain)."""
    weak = ranks.where(F.col("rank") >= least_rank).select("entry", "rank")
    r = resolved.where(F.size(F.split("name", " ")) >= words).join(weak, "entry")
    return r.join(graded.select("chain").distinct(), "chain", "left_anti").select("chain", "at", "name", "entry", "rank")
