"""Language identification by rank-order profiles of character n-grams.

A language's profile is the rank of each of its most frequent n-grams (one to three letters, with a mark for a word's
border). A document's most frequent n-grams are ranked in the same way, over its whole text; each is charged how far its
rank is from the language's rank, or the full profile size where the language lacks it. The language with the smallest
sum wins; of equal ones, the first by name.

A text that is null or has no letter gets `und` and score 0. Rows with a null language are not learned from; repeated rows
count as often as they are there, and an empty table gives no profiles (all texts are `und` then) or no rows. Columns that
are kept may have any names (see map_text).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import column, map_text, ship, slices

#: N-grams in a profile and in a document's ranking.
PROFILE_SIZE = 300
#: Labelled rows of each language that are learned from, about: a language with more is thinned by a hash of the id.
ROWS_PER_LANGUAGE = 1500
SEED = 11

BITS = 18  # of a letter's number; three letters and a row's number fit a 64-bit integer
_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point 0, or from 2 on the letter's number; 1 stands for a word's border."""
    global _LETTERS
    if _LETTERS is None:
        is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        table = np.zeros(0x110000, np.int64)
        table[is_letter] = np.arange(2, 2 + is_letter.sum())
        _LETTERS = table
    return _LETTERS


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, n-gram code and count, by row and code; up to 512 texts."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("\0".join(["", *low, ""]).encode("utf-32-le"), "<u4")
    row = np.repeat(np.arange(len(low) + 1), [1, *[len(t) + 1 for t in low]])  # each text with the border after it
    row = np.maximum(row - 1, 0)
    n = letters()[points]
    keep = np.empty(len(n), bool)
    keep[0] = True
    keep[1:] = (n[1:] != 0) | (n[:-1] != 0)
    n, row = np.where(n == 0, 1, n)[keep], row[keep]
    inside = n > 1
    keys = [(row << 3 * BITS | n)[inside]]
    two = inside[:-1] | inside[1:]
    keys.append((np.where(inside[:-1], row[:-1], row[1:]) << 3 * BITS | n[:-1] << BITS | n[1:])[two])
    mid = inside[1:-1]
    keys.append((row[1:-1] << 3 * BITS | n[:-2] << 2 * BITS | n[1:-1] << BITS | n[2:])[mid])
    key = np.concatenate(keys)
    key.sort()
    if not len(key):
        return key, key, key
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return key >> 3 * BITS, key & (1 << 3 * BITS) - 1, count


def ranked(row: np.ndarray, code: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and rank of each row's `size` most frequent n-grams; of equal counts the smaller code comes first."""
    if not len(row):
        return row, code, row
    top = (1 << 22) - 1
    if count.max() <= top:  # row, falling count and place in one number: a plain sort
        order = row << 54 | (top - count) << 32 | np.arange(len(row))
        order.sort()
        at = order & (1 << 32) - 1
    else:
        at = np.lexsort((-count, row))
    row, code = row[at], code[at]
    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    rank = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
    few = rank < size
    return row[few], code[few], rank[few]


@dataclass
class Profiles:
    """The learned profiles: sorted distinct n-gram codes; from start[i] to start[i + 1] the languages that have code i, with its ranks.

    A profile is `size` entries of 16 bytes, so all natural languages together are some 30 MB; they go to every task.
    """

    languages: list[str]
    codes: np.ndarray
    start: np.ndarray
    lang: np.ndarray
    rank: np.ndarray
    size: int

    @classmethod
    def of(cls, rows: list[tuple[str, int, int]], size: int) -> Profiles:
        """rows: language, code, rank."""
        languages = sorted({r[0] for r in rows})
        number = {x: i for i, x in enumerate(languages)}
        rows = sorted((code, number[x], rank) for x, code, rank in rows)
        every = np.array([r[0] for r in rows], np.int64)
        codes, start = np.unique(every, return_index=True)
        return cls(languages, codes, np.append(start, len(rows)), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), size)

    def distances(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place distance of each text to each language, and each text's number of ranked n-grams."""
        row, code, rank = ranked(*gram_counts(texts), self.size)
        grams, wide = np.bincount(row, minlength=len(texts)), len(self.languages)
        near = np.zeros(len(texts) * wide, np.int64)
        if len(row) and len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = np.flatnonzero(self.codes[at] == code)
            at, many = at[known], np.diff(self.start)[at[known]]
            # Each n-gram once for each language that has it: what it is nearer than an n-gram that the language lacks.
            entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.start[at], many)
            gain = self.size - np.minimum(np.abs(self.rank[entry] - np.repeat(rank[known], many)), self.size)
            near = np.bincount(np.repeat(row[known], many) * wide + self.lang[entry], gain, len(near)).astype(np.int64)
        return grams[:, None] * self.size - near.reshape(len(texts), wide), grams

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        far, grams = self.distances(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = far.argmin(axis=1)
        score = 1 - far[np.arange(len(texts)), best] / np.maximum(grams * self.size, 1)
        return [self.languages[i] if n else "und" for i, n in zip(best.tolist(), grams.tolist(), strict=True)], np.where(grams > 0, score, 0.0)


def learn(df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE, size: int = PROFILE_SIZE) -> Profiles:
    """Learns a profile for each non-null language of df.

    A language of more than rows_per_language rows is thinned to about so many by a hash of the id. The n-grams of the
    chosen rows' whole texts are counted on the executors; only profiles come to the driver.
    """
    spark = df.sparkSession
    ship(spark)
    known = df.where(column(lang_col).isNotNull()).select(column(id_col).alias("id"), column(lang_col).cast("string").alias("lang"), column(text_col).cast("string").alias("text"))
    rows = known.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("rows"))
    # One row for each language.
    chosen = known.join(F.broadcast(rows), F.col("lang") == F.col("l")).where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1_000_000)) * F.col("rows") < 1_000_000 * rows_per_language).select("lang", "text")

    def count(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch, texts in slices(batches):
            langs = batch.column("lang").to_pylist()
            row, code, n = gram_counts(texts)
            for lang in set(langs):
                mine = np.array([x == lang for x in langs])[row]
                old = total.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                codes, at = np.unique(np.concatenate([old[0], code[mine]]), return_inverse=True)
                total[lang] = codes, np.bincount(at, np.concatenate([old[1], n[mine]]), len(codes)).astype(np.int64)
        for lang, (codes, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "code", "n"])

    counted = chosen.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # The best of each part of a language's n-grams first, so that no task ranks all of a language.
    part = Window.partitionBy("lang", F.pmod(F.hash("code"), F.lit(64))).orderBy(F.desc("n"), "code")
    whole = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counted.withColumn("r", F.row_number().over(part)).where(F.col("r") <= size).withColumn("r", F.row_number().over(whole) - 1).where(F.col("r") < size)
    return Profiles.of([tuple(r) for r in top.select("lang", "code", "r").collect()], size)


def identify(df: DataFrame, profiles: Profiles, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, lang_pred string, score double (1: every n-gram has the profile's rank) for each whole text."""

    def kernel(texts):
        langs, score = profiles.predict(texts)
        return [pa.array(langs, pa.string()), pa.array(score)]

    return map_text(df, keep, text_col, [("lang_pred", "string"), ("score", "double")], kernel)
