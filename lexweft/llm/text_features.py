"""Sparse indicator features of texts for the linear classifiers: vocabulary, training matrix, scoring."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import column, map_text, ship, slices

Featurizer = Callable[[str | None], set[str]]
#: Features that a task counts before it passes its counts on, and rows that it passes on at once.
COUNTED, ROWS = 150_000, 20_000


@dataclass
class Rows:
    """A sparse 0/1 matrix by rows: row i has the columns index[start[i]:start[i + 1]]."""

    start: np.ndarray
    index: np.ndarray
    width: int
    ids: list = field(default_factory=list)

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(w[self.index])])
        return sums[self.start[1:]] - sums[self.start[:-1]]

    def weigh(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, np.repeat(g, np.diff(self.start)), self.width)


def one_row_per_id(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and text: of rows with the same id the one with the least text, so that ids bound rows."""
    return df.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text")).groupBy("id").agg(F.min("text").alias("text"))


def count_features(sample: DataFrame, featurize: Featurizer) -> DataFrame:
    """feature, n1 and n0: the weights of the sample's rows (text, y, weight) with label 1, and of the others, that have the feature."""
    ship(sample.sparkSession)

    def count(batches):
        seen: dict[bool, dict[str, int]] = {True: defaultdict(int), False: defaultdict(int)}
        for batch, texts in slices(batches):
            for t, y, w in zip(texts, batch.column("y").to_pylist(), batch.column("weight").to_pylist(), strict=True):
                mine = seen[y == 1]
                for f in featurize(t):
                    mine[f] += w
                if len(seen[True]) + len(seen[False]) > COUNTED:
                    yield from rows(seen)
        yield from rows(seen)

    def rows(seen):
        """What has been counted, in parts; the counts begin anew."""
        for y in (True, False):
            names, counts = list(seen[y]), list(seen[y].values())
            seen[y].clear()
            for at in range(0, len(names), ROWS):
                n, zero = pa.array(counts[at : at + ROWS], pa.int64()), pa.array([0] * len(counts[at : at + ROWS]), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(names[at : at + ROWS], pa.string()), *((n, zero) if y else (zero, n))], names=["feature", "n1", "n0"])

    inner = sample.select("text", "y", F.col("weight").cast("long").alias("weight"))
    return inner.mapInArrow(count, "feature string, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def top_features(counts: DataFrame, weight: Column, limit: int) -> list[tuple[str, int, int]]:
    """At most `limit` features of the largest weight, by name."""
    rows = counts.withColumn("w", weight).where("w > 0").orderBy(F.desc("w"), "feature").limit(limit).collect()
    return sorted((r["feature"], r["n1"], r["n0"]) for r in rows)


def matrix(sample: DataFrame, featurize: Featurizer, names: list[str]) -> tuple[Rows, np.ndarray, np.ndarray]:
    """The sample's rows (a bounded number) as indicators of the named features, their labels and weights; in an order of their own."""
    column_of = {f: i for i, f in enumerate(names)}

    def kernel(texts):
        return [pa.array([sorted(column_of[f] for f in featurize(t) if f in column_of) for t in texts], pa.list_(pa.int32()))]

    rows = map_text(sample.select("y", "weight", "text"), ["y", "weight"], "text", [("f", "array<int>")], kernel).collect()
    rows = sorted((r["f"], r["y"], r["weight"]) for r in rows)
    start = np.concatenate([[0], np.cumsum([len(f) for f, _, _ in rows])]).astype(np.int64)
    return Rows(start, np.array([i for f, _, _ in rows for i in f], np.int64), len(names)), np.array([y for _, y, _ in rows], np.float64), np.array([w for _, _, w in rows], np.float64)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def score_with(df: DataFrame, keep: list[str], text_col: str, featurize: Featurizer, weights: dict[str, float], finish: Callable[[float], float], threshold: float) -> DataFrame:
    """keep, score double (finish of the sum of the text's features' weights) and predicted int."""

    def kernel(texts):
        get = weights.get
        score = [min(1.0, max(0.0, finish(sum(w for f in sorted(featurize(t)) if (w := get(f)) is not None)))) for t in texts]
        return [pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32())]

    return map_text(df, keep, text_col, [("score", "double"), ("predicted", "int")], kernel)
