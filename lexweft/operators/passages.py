"""Passage and concept indexes: which records quote a passage, where each record of a work stands, which concepts it names."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import text as T
from ..functions.profiles import LATIN, Profile
from . import match, search


def passage_grams(passages: DataFrame, key: str, text_col: str, k: int = 4, most: int = 3, p: Profile = LATIN) -> DataFrame:
    """(gram, passage, weight): grams of at most `most` passages; 2 if the gram is one passage's only, else 1."""
    g = match.rare(match.gram_table(passages, key, text_col, k, p), most)
    return g.select("gram", F.col("key").alias("passage"), F.when(F.col("df") == 1, 2).otherwise(1).alias("weight"))


def passage_hits(records: DataFrame, grams: DataFrame, key: str, text_col: str, k: int = 4, head_words: int = 60, p: Profile = LATIN) -> DataFrame:
    """(record, passage, head, hits): the weights of the passage's grams that a record has, in its first head_words words and
    in all. Records' grams are filtered where they are read, so only hits are shuffled."""
    toks = T.tokens(text_col, p)
    whole = F.transform(T.grams(toks, k), lambda g, i: F.struct(g.alias("gram"), i.alias("at")))
    each = records.select(F.col(key).alias("record"), F.explode(whole).alias("g")).select("record", "g.gram", "g.at").join(match.small(grams), "gram")
    once = each.groupBy("record", "passage", "gram").agg(F.min("at").alias("at"), F.max("weight").alias("weight"))
    inside = F.col("at") + k <= head_words
    return once.groupBy("record", "passage").agg(F.coalesce(F.sum(F.when(inside, F.col("weight"))), F.lit(0)).alias("head"), F.sum("weight").alias("hits"))


def placed(records: DataFrame, hits: DataFrame, work: str, order: str, key: str, group: Column, number: Column, heading: Column | None = None, least: int = 2, sure: int = 4, near: tuple[int, int] = (-20, 60)) -> DataFrame:
    """(work, record, passage, how, hits): where each record of a work stands, and what else it cites.

    A heading's passage wins. Else of the passages with `least` hits in the record's head the one with most (the earlier of
    equals) is its lemma, if it is near the present one in the same group (group, number over `passage`), or there is none
    yet, or it has `sure` hits. Other passages with `least` hits in all of the record are cited. A record without any of its
    own continues the present one.

    What is taken depends on what was taken before, but a heading or a sure lemma doesn't: a work's records are dealt out in
    stretches that begin with such a record, so that a large work isn't one task.
    """
    best = hits.withColumn("g", group).withColumn("n", number).groupBy("record").agg(F.array_sort(F.collect_list(F.struct("g", "n", "passage", "head", "hits"))).alias("by"))
    rows = records.select(F.col(work).alias("work"), F.col(order).alias("at"), F.col(key).alias("record"), (F.lit(None).cast("struct<g:long,n:long,passage:long>") if heading is None else heading).alias("heading"))
    rows = rows.join(best, "record", "left")
    top = F.array_max(F.transform("by", lambda x: x["head"]))
    firm = F.col("heading").isNotNull() | (F.coalesce(top, F.lit(0)) >= sure)
    part = F.sum(firm.cast("int")).over(Window.partitionBy("work").orderBy("at", "record"))
    dealt = rows.withColumn("part", part)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "record"])
        by = [[dict(zip(("g", "n", "passage", "head", "hits"), (x["g"], x["n"], x["passage"], x["head"], x["hits"]), strict=True)) for x in b] if b is not None else [] for b in pdf["by"]]
        out = K.place(list(zip(pdf.record, by, pdf.heading, strict=True)), least, sure, near)
        return pd.DataFrame([(pdf.work.iloc[0], *r) for r in out], columns=["work", "record", "passage", "how", "hits"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return dealt.groupBy("work", "part").applyInPandas(run, f"work {types['work']}, record {types['record']}, passage long, how string, hits long")


def cited_only(hits: DataFrame, least: int = 2) -> DataFrame:
    """(record, passage, hits, how) without an order of records: the passage with most hits (the smaller of equals) is the lemma."""
    w = Window.partitionBy("record").orderBy(F.desc("hits"), "passage")
    return hits.where(F.col("hits") >= least).withColumn("r_", F.row_number().over(w)).select("record", "passage", "hits", F.when(F.col("r_") == 1, "lemma").otherwise("cited").alias("how"))


def coverage(records: DataFrame, index: DataFrame, work: str, key: str) -> DataFrame:
    """(work, passages, placed, reached, lemma_percent): records of each work, those that the index places, the distinct
    passages they reach, and the share of placed ones (in per cent, rounded down) that stand at a lemma of their own."""
    own = index.groupBy("record").agg(F.bool_or(F.col("how") == "lemma").alias("lemma"))
    n = records.select(F.col(work).alias("work"), F.col(key).alias("record")).join(own, "record", "left")
    counts = n.groupBy("work").agg(F.countDistinct("record").alias("passages"), F.countDistinct(F.when(F.col("lemma").isNotNull(), F.col("record"))).alias("placed"), F.countDistinct(F.when(F.col("lemma"), F.col("record"))).alias("lemmas"))
    reach = records.select(F.col(work).alias("r_work"), F.col(key).alias("record")).join(index.select("record", "passage"), "record").groupBy("r_work").agg(F.countDistinct("passage").alias("reached"))
    out = counts.join(reach, F.col("work").eqNullSafe(F.col("r_work")), "left")
    return out.select("work", "passages", "placed", F.coalesce("reached", F.lit(0)).alias("reached"), F.when(F.col("placed") > 0, F.floor(100 * F.col("lemmas") / F.col("placed"))).alias("lemma_percent"))


# ---- concepts


@dataclass(frozen=True)
class Concept:
    """A concept's words, and, for words of several senses, those of which one must stand near, and those that must not."""

    name: str
    forms: tuple[str, ...]
    cues: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    bridge: tuple[str, ...] = field(default=())


def _pattern(forms: tuple[str, ...], proclitics: str, p: Profile) -> str:
    words = sorted({p.clean(f) for f in forms}, key=lambda f: (-len(f), f))
    return rf"(?:^|(?<=\s)){f'[{proclitics}]?' if proclitics else ''}(?:{'|'.join(words)})(?=\s|$)"


def concept_hits(records: DataFrame, concepts: list[Concept], key: str, text_col: str, proclitics: str = "", around: int = 150, bridged: Column | None = None, p: Profile = LATIN) -> DataFrame:
    """(record, concept, raw, kept): how often a record names a concept, and how often in its sense.

    Words are found longest first, with an optional proclitic. A match of several words always counts; another one only if,
    within `around` characters of cleaned text on either side, no excluded word stands and (if the concept has cues) a cue.
    In records for which `bridged` holds, the concept's bridge words count too, without proclitic or test.
    """

    def counts(c: Concept) -> Column:
        cue, bad = (_pattern(x, proclitics, p) if x else None for x in (c.cues, c.exclude))

        def good(t: Column, m: Column) -> Column:
            before = F.substring(t, F.greatest(m["start"] - around, F.lit(0)) + 1, m["start"] - F.greatest(m["start"] - around, F.lit(0)))
            near = F.concat(before, F.lit(" "), F.substring(t, m["end"] + 1, F.lit(around)))
            single = ~F.contains(F.trim(m["text"]), F.lit(" "))
            tests = ([~near.rlike(bad)] if bad else []) + ([near.rlike(cue)] if cue else [])
            return ~single | (tests[0] if len(tests) == 1 else tests[0] & tests[1]) if tests else F.lit(True)

        found = T.matches(F.col("t_"), _pattern(c.forms, proclitics, p))
        more = F.lit(0)
        if c.bridge and bridged is not None:
            more = F.when(F.col("bridged_"), F.size(T.matches(F.col("t_"), _pattern(c.bridge, "", p)))).otherwise(0)
        return T.let(found, lambda ms: F.struct(F.lit(c.name).alias("concept"), (F.size(ms) + more).alias("raw"), (F.size(F.filter(ms, lambda m: good(F.col("t_"), m))) + more).alias("kept")))

    rows = records.select(F.col(key).alias("record"), T.clean(text_col, p).alias("t_"), (F.lit(False) if bridged is None else bridged).alias("bridged_"))
    rows = rows.select("record", F.explode(F.array(*[counts(c) for c in concepts])).alias("c")).select("record", "c.*")
    return rows.where("raw > 0")


def concept_lookup(hits: DataFrame, records: DataFrame, meta: DataFrame, concept: str, work: str, key: str, per_work: int = 3) -> DataFrame:
    """A concept's passages by work, the oldest first: those that name it most often in its sense."""
    index = hits.where((F.col("concept") == concept) & (F.col("kept") > 0)).join(records.select(F.col(key).alias("record"), F.col(work).alias("work")), "record")
    return search.lookup(index, meta, per_work=per_work, order=[F.desc("kept"), F.col("record")])
