"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over indicators (words and the first letters of words, in lower case, that toxic texts have more often)
is trained in numpy from confirmed toxic texts and unlabelled ones. Unlabelled texts hold toxic ones in the share `prior`; the risk of calling them
all clean is corrected by what the toxic ones contribute. Where the corrected part turns negative (overfitting) the step
goes the other way, as non-negative risk estimation asks.

The prior is the toxic share of the rows labelled for training. Copies among the rows that are learned from count as one
row together: a row's weight is one over the number of rows that share a shingle minimum with it.

A null or blank text has no features and gets the base score. Without a confirmed toxic text the score is the prior for
all. Scores depend on the text only, so repeated rows have equal ones; of rows with the same id the least text is learned
from, and an id with several labels counts as toxic if one of them says so. An empty table gives an empty one; columns that
are kept may have any names (see map_text).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import column, durable, hash_order, map_text
from .minhash import hash_family, minima, shingle_set
from .text_features import Rows, count_features, logistic, matrix, one_row_per_id, score_with

#: Confirmed toxic and unlabelled rows that are learned from, at most (chosen by a hash of the id).
MAX_POSITIVE, MAX_UNLABELLED = 2500, 7500
#: Features: those of at least so many toxic texts (or one in so many), with so large an excess (in standard errors) and lift over clean texts.
LEAST_POSITIVE, LEAST_SHARE, LEAST_EXCESS, LEAST_LIFT = 4, 400, 6.0, 6.0
#: The weight of a row without copies; weights are integers, so that sums don't depend on the order.
UNIT = 10_000
STEPS, RATE, DECAY = 400, 0.05, 1e-4
THRESHOLD = 0.3
SEED = 7
_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7)
#: Characters from which on a word's feature is its hash, and it isn't kept by a worker.
LONG = 41


def _whole(word: str) -> str:
    return f"={word}" if len(word) < LONG else f"#{xxhash.xxh3_128_hexdigest(word)}"


def featurize(text: str | None) -> set[str]:
    words = set(_WORD.findall(text.lower())) if text else set()
    out = {_whole(w) for w in words}
    for n in PREFIXES:
        out.update([w[:n] for w in words if len(w) > n])
    return out


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, df: DataFrame, keep: list[str], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
        """keep, score double, predicted int (1 if score >= threshold) for each whole text."""
        weights, bias = self.weights, self.bias
        return score_with(df, keep, text_col, _Active(weights), weights, lambda s: 1 / (1 + math.exp(-max(-500.0, min(500.0, s + bias)))), threshold)


class _Active:
    """featurize(), but only features with a weight; a worker looks each word up once in a slice's texts."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.known = weights, {}

    def __call__(self, text: str | None) -> set[str]:
        out: set[str] = set()
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for w in set(_WORD.findall(text.lower())) if text else ():
            f = known.get(w)
            if f is None:
                f = tuple(x for x in [_whole(w), *[w[:n] for n in PREFIXES if len(w) > n]] if x in self.weights)
                if len(w) < LONG:
                    known[w] = f
            if f:
                out.update(f)
        return out


def risk(g: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk at margins g: that of calling toxic texts clean, and the corrected one of calling clean ones toxic."""
    pos, unl = np.where(y == 1, weight, 0.0), np.where(y == 1, 0.0, weight)
    pos, unl = pos / max(pos.sum(), 1e-12), unl / max(unl.sum(), 1e-12)
    return prior * float(pos @ np.logaddexp(0, -g)), float(unl @ np.logaddexp(0, g) - prior * (pos @ np.logaddexp(0, g)))


def slopes(g: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float) -> np.ndarray:
    """The direction of a step by each margin: the gradient of the risk, or, where its corrected part is negative, of minus that part."""
    pos, unl = np.where(y == 1, weight, 0.0), np.where(y == 1, 0.0, weight)
    pos, unl = pos / max(pos.sum(), 1e-12), unl / max(unl.sum(), 1e-12)
    p = logistic(g)
    corrected = unl * p - prior * pos * p
    return prior * pos * (p - 1) + corrected if risk(g, y, weight, prior)[1] >= 0 else -corrected


def fit(x: Rows, y: np.ndarray, weight: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss, by Adam. y: 1 confirmed, 0 unlabelled."""
    w, b = np.zeros(x.width), math.log(prior / (1 - prior))
    m, v = np.zeros(x.width + 1), np.zeros(x.width + 1)
    for step in range(1, steps + 1):
        grad = slopes(x.dot(w) + b, y, weight, prior)
        full = np.append(x.weigh(grad) + decay * w, grad.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def _weighted(sample: DataFrame) -> DataFrame:
    """The sample (y, text) with `weight`: UNIT over the number of rows of its class that share one of three shingle minima with it, the most of the three."""
    mul, add = hash_family(3)

    def kernel(texts):
        low = np.array([minima(shingle_set(t, 3), mul, add) for t in texts], np.int64).reshape(len(texts), 3)
        return [pa.array(low[:, k]) for k in range(3)]

    out = durable(map_text(sample, ["y", "text"], "text", [("m0", "long"), ("m1", "long"), ("m2", "long")], kernel), MAX_POSITIVE + MAX_UNLABELLED)
    for k in range(3):
        # At most as many rows as the sample has, of three numbers.
        n = out.groupBy(F.col("y").alias("c_y"), F.col(f"m{k}").alias("c_m")).agg(F.count("*").alias(f"n{k}"))
        out = out.join(F.broadcast(n), (F.col("y") == F.col("c_y")) & (F.col(f"m{k}") == F.col("c_m"))).drop("c_y", "c_m")
    return out.select("y", "text", F.greatest(F.lit(1), F.floor(F.lit(UNIT) / F.greatest("n0", "n1", "n2"))).cast("long").alias("weight"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Learns from docs (all of them may be used) and labels (id_col, label_col) for some of them."""
    texts = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    known = labels.select(column(id_col).alias("id"), column(label_col).alias("y")).where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    known = durable(known.join(texts.select("id"), "id", "left_semi"), labels.count())
    prior = known.agg(F.avg("y")).first()[0] or 0.0
    prior = min(max(prior, 0.001), 0.9)
    confirmed = hash_order(known.where("y = 1"), "id", max_positive, SEED).withColumn("y", F.lit(1))
    unlabelled = hash_order(texts, "id", max_unlabelled, SEED + 1).withColumn("y", F.lit(0))
    # At most max_positive + max_unlabelled rows of two numbers.
    chosen = F.broadcast(durable(confirmed.unionByName(unlabelled), max_positive + max_unlabelled))
    found = durable(one_row_per_id(texts.join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi"), "id", "text"), max_positive + max_unlabelled)
    sample = durable(_weighted(found.join(chosen, "id").select("y", "text")), max_positive + max_unlabelled)
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.sum("weight").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return Model({}, math.log(prior / (1 - prior)))
    least = max(LEAST_POSITIVE * UNIT, n[1] // LEAST_SHARE)
    # The share of clean texts that have the feature: what unlabelled ones have, less the toxic ones among them.
    rate = F.col("n1") / n[1]
    clean = F.greatest(F.lit(0.0), F.col("n0") / n[0] - prior * rate) / (1 - prior)
    expected = clean * (n[1] / UNIT)
    excess = (F.col("n1") / UNIT - expected) / F.sqrt(expected + 1)
    strong = (F.col("n1") >= least) & (excess >= LEAST_EXCESS) & (rate >= LEAST_LIFT * clean)
    names = sorted(r["feature"] for r in count_features(sample, featurize).where(strong).select("feature").collect())
    if not names:
        return Model({}, math.log(prior / (1 - prior)))
    x, y, weight = matrix(sample, featurize, names)
    w, b = fit(x, y, weight, prior)
    return Model({f: float(v) for f, v in zip(names, w, strict=True) if v}, float(b))
