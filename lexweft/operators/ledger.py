"""The append-only ledger of findings: current entries, validation as queries for violations, views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import cite


def current(entries: DataFrame) -> DataFrame:
    """Entries (id, status, links array<struct<rel,to>>) that aren't superseded, by status or by another's link."""
    gone = entries.select(F.explode("links").alias("l")).where(F.col("l.rel") == "supersedes").select(F.col("l.to").alias("gone")).distinct()
    return entries.where(F.col("status") != "superseded").join(gone, F.col("id") == F.col("gone"), "left_anti")


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, key): one row for each offence; each check is a query for the offending keys (one column)."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("check"), F.col(df.columns[0]).cast("string").alias("key")) for name, df in checks.items()])


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)


def dangling(df: DataFrame, key: str, target: DataFrame, target_key: str) -> DataFrame:
    """Keys of df that target lacks."""
    return df.select(F.col(key)).where(F.col(key).isNotNull()).distinct().join(target.select(F.col(target_key).alias("t_")), F.col(key) == F.col("t_"), "left_anti")


def validate(entries: DataFrame, types: DataFrame, relations: DataFrame) -> DataFrame:
    """All offences of ledger entries (id, type, status, title, text, data, links, cites)."""
    links = entries.select("id", F.explode("links").alias("l"))
    need = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.col(c) == "") for c in ("id", "type", "status", "title")])
    return violations({
        "missing": entries.where(need).select("id"),
        "duplicate": duplicates(entries, "id"),
        "type": dangling(entries, "type", types, "type"),
        "relation": dangling(links.select(F.col("l.rel").alias("rel")), "rel", relations, "rel"),
        "link": dangling(links.select(F.col("l.to").alias("to")), "to", entries, "id"),
        "prefix": entries.where(F.substring_index("id", ":", 1) != F.col("type")).select("id"),
        "layer": entries.where((F.col("type") == "reading") & F.get_json_object("data", "$.layer").isNull()).select("id"),
        "voice": entries.where((F.col("type") == "passage") & F.get_json_object("data", "$.voice").isNull()).select("id"),
    })


def agreement(stances: DataFrame, voice: str, target: str, stance: str) -> DataFrame:
    """(a, b, agree, differ, partly) of each two voices over the targets that both speak of; the same stance agrees, two
    that exclude each other (affirms, rejects) differ."""
    s = stances.select(F.col(voice).alias("v"), F.col(target).alias("t"), F.col(stance).alias("s")).distinct()
    x, y = s.select(F.col("v").alias("a"), "t", F.col("s").alias("sa")), s.select(F.col("v").alias("b"), "t", F.col("s").alias("sb"))
    pairs = x.join(y, "t").where("a < b")
    both = pairs.groupBy("a", "b")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    same = F.col("sa") == F.col("sb")
    opposite = F.col("sa").isin("affirms", "rejects") & F.col("sb").isin("affirms", "rejects") & ~same
    return both.agg(n(same).alias("agree"), n(opposite).alias("differ"), n(~same & ~opposite).alias("partly"))


def errors(rules: dict[str, Column]) -> Column:
    """The names of the rules whose offence holds for a row, joined by commas."""
    return F.concat_ws(",", *[F.when(c, F.lit(name)) for name, c in rules.items()])


def matching_cites(cites: DataFrame, records: DataFrame) -> DataFrame:
    """(cite, found) of the records (id, folder) that entries cite: those that name a folder are looked for in that folder
    only, so that others aren't read; the rest anywhere."""
    wanted = cites.select(F.col("cite").alias("id")).distinct()
    there = cite.fetched(records, wanted).select(F.col("id").alias("r_")).distinct()
    return wanted.join(there, F.col("id") == F.col("r_"), "left").select(F.col("id").alias("cite"), F.col("r_").isNotNull().alias("found"))


def open_questions(entries: DataFrame) -> DataFrame:
    """(id, title) of current entries of type question that no current entry answers."""
    now = current(entries)
    answered = now.select(F.explode("links").alias("l")).where(F.col("l.rel") == "answers").select(F.col("l.to").alias("q_")).distinct()
    return now.where(F.col("type") == "question").join(answered, F.col("id") == F.col("q_"), "left_anti").select("id", "title")


def inferences(entries: DataFrame) -> DataFrame:
    """(id, title, basis) of current entries of type inference, with what they rest on, sorted."""
    now = current(entries).where(F.col("type") == "inference")
    basis = F.array_sort(F.transform(F.filter("links", lambda x: x["rel"] == "rests_on"), lambda x: x["to"]))
    return now.select("id", "title", F.array_join(basis, ",").alias("basis"))


def tree(entries: DataFrame, depth: int = 4) -> DataFrame:
    """(root, id, depth, path) of current entries under those that are part of nothing, down to `depth` steps of part_of."""
    now = current(entries)
    parts = now.select("id", F.explode("links").alias("l")).where(F.col("l.rel") == "part_of").select(F.col("id").alias("child"), F.col("l.to").alias("parent"))
    level = now.join(parts.select("child").distinct(), F.col("id") == F.col("child"), "left_anti").select(F.col("id").alias("root"), "id", F.lit(0).alias("depth"), F.col("id").alias("path"))
    out = level
    for k in range(1, depth + 1):  # a few levels of a small table: one join each
        level = level.join(parts, F.col("id") == F.col("parent")).select("root", F.col("child").alias("id"), F.lit(k).alias("depth"), F.concat_ws("/", "path", "child").alias("path"))
        out = out.unionByName(level)
    return out
