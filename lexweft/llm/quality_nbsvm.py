"""Quality classifier: naive-Bayes-scaled support vectors.

Indicators of n-grams (words, pairs of words, and runs of one to four word shapes) are scaled by the log ratio of their
frequencies in the two classes; a linear hinge-loss model over them is fitted by dual coordinate descent. A logistic curve
fitted to the training margins turns a margin into a score.

A word's shape has one letter for each run of capitals (A), other letters (a) and digits (0), and its other characters
once for each run. A word of more than LONG characters (a text without spaces is one) also has features of its parts: runs
of three characters, and of four in its shape.

A null or blank text has one feature that says so. If the labels are of one class only, the score is that class for all.
Scores depend on the text only, so repeated rows have equal ones; of rows with the same id the least text is learned from,
and an id with several labels counts with the least. An empty table gives an empty one; columns that are kept may have any
names (see map_text).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import column, durable, hash_order, worker_cache
from .text_features import Rows, count_features, logistic, matrix, one_row_per_id, score_with, top_features

#: Labelled rows of each class that are learned from, at most (chosen by a hash of the id).
MAX_ROWS = 4000
#: Features of the model at most (those that most rows have), and the rows that one must have.
MAX_FEATURES, LEAST_ROWS = 60_000, 8
EPOCHS, COST, SMOOTH = 12, 1.0, 1.0
THRESHOLD = 0.5
SEED = 5
#: Characters up to which a word is a feature as a whole.
LONG = 12
#: Shapes that a worker keeps, and the characters of a word up to which it keeps them.
CACHE_WORDS, CACHE_CHARS = 200_000, 64


def shape(word: str) -> str:
    out = ""
    last = ""
    for c in word:
        c = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if c != last:
            out += c
            last = c
    return out


@dataclass
class Parts:
    """What a text's features are made of: distinct words and pairs of words (in lower case), runs of shapes, and parts of long words."""

    words: set[str]
    pairs: set[tuple[str, str]]
    runs: set[tuple[str, ...]]
    pieces: set[str]


def parts(text: str | None) -> Parts | None:
    words = text.split() if text else []
    if not words:
        return None
    known = worker_cache("shapes")
    if len(known) > CACHE_WORDS:
        known.clear()
    mine = {}
    for w in set(words):
        k = known.get(w)
        if k is None:
            k = shape(w), _short(w)
            if len(w) <= CACHE_CHARS:
                known[w] = k
        mine[w] = k
    each = [mine[w] for w in words]
    shapes, low, pieces = [k[0] for k in each], [k[1] for k in each], set()
    for w, (s, _) in mine.items():
        if len(w) > LONG:
            whole = w.lower()
            pieces.update([f"c {whole[i : i + 3]}" for i in range(len(whole) - 2)])
            pieces.update([f"s {s[i : i + 4]}" for i in range(max(1, len(s) - 3))])
    runs = set(zip(shapes, strict=True)).union(*[zip(*(shapes[k:] for k in range(n)), strict=False) for n in (2, 3, 4)])
    return Parts(set(low), set(zip(low, low[1:], strict=False)), runs, pieces)


def featurize(text: str | None) -> set[str]:
    p = parts(text)
    if p is None:
        return {"blank"}
    return p.pieces.union([f"w {w}" for w in p.words], [f"p {a} {b}" for a, b in p.pairs], [f"{len(r)} {' '.join(r)}" for r in p.runs])


class _Active:
    """featurize(), but only features with a weight; names are made for those only."""

    def __init__(self, weights: dict[str, float]):
        kind = lambda k: [f[2:] for f in weights if f.startswith(f"{k} ")]
        self.words, self.pieces = set(kind("w")), {f for f in weights if f[:2] in ("c ", "s ")}
        self.pairs = {tuple(f.split(" ")) for f in kind("p")}
        self.runs = {tuple(f.split(" ")) for n in (1, 2, 3, 4) for f in kind(n)}

    def __call__(self, text: str | None) -> set[str]:
        p = parts(text)
        if p is None:
            return {"blank"}
        out = p.pieces & self.pieces
        out.update([f"w {w}" for w in p.words & self.words], [f"p {a} {b}" for a, b in p.pairs & self.pairs], [f"{len(r)} {' '.join(r)}" for r in p.runs & self.runs])
        return out


def _short(word: str) -> str:
    """The word in lower case; one of more than CACHE_CHARS characters as its hash."""
    return word.lower() if len(word) <= CACHE_CHARS else f"#{xxhash.xxh3_128_hexdigest(word.lower())}"


@dataclass
class Model:
    weights: dict[str, float]
    scale: float
    shift: float

    def score(self, df: DataFrame, keep: list[str], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
        """keep, score double, predicted int (1 if score >= threshold) for each whole text."""
        scale, shift = self.scale, self.shift
        return score_with(df, keep, text_col, _Active(self.weights), self.weights, lambda m: 1 / (1 + math.exp(-max(-500.0, min(500.0, scale * m + shift)))), threshold)


def dual_coordinate_descent(x: Rows, values: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> np.ndarray:
    """Weights (the last one is the bias) of the L2-regularised hinge-loss model. values: of x's entries; y: 1 or -1."""
    w, alpha = np.zeros(x.width + 1), np.zeros(len(y))
    rng = np.random.default_rng(seed)
    norm = np.array([values[a:b] @ values[a:b] for a, b in zip(x.start[:-1], x.start[1:], strict=True)]) + 1
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            at = slice(x.start[i], x.start[i + 1])
            index, v = x.index[at], values[at]
            grad = y[i] * (w[index] @ v + w[-1]) - 1
            new = min(max(alpha[i] - grad / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[index] += step * v
                w[-1] += step
                alpha[i] = new
    return w


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the margins, by Newton steps on smoothed targets."""
    n1, n0 = (y == 1).sum(), (y != 1).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = logistic(a * margin + b)
        g, h = p - target, p * (1 - p) + 1e-9
        hess = np.array([[h @ margin**2 + 1e-6, h @ margin], [h @ margin, h.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, [g @ margin, g.sum()])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    return float(max(a, 1e-3)), float(b)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Learns from the rows of docs that labels (id_col, label_col) covers."""
    texts = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    known = labels.select(column(id_col).alias("id"), column(label_col).alias("y")).where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.min("y").alias("y"))
    known = durable(known.join(texts.select("id"), "id", "left_semi"), labels.count())
    picks = [hash_order(known.where(c), "id", max_rows, SEED).withColumn("y", F.lit(y)) for c, y in (("y = 1", 1), ("y <> 1", 0))]
    # At most 2 x max_rows rows of two numbers.
    chosen = F.broadcast(durable(picks[0].unionByName(picks[1]), 2 * max_rows))
    found = one_row_per_id(texts.join(chosen, "id", "left_semi"), "id", "text")
    sample = durable(found.join(chosen, "id").select("text", "y", F.lit(1).alias("weight")), 2 * max_rows)
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return Model({}, 1.0, 10.0 if n.get(1) or not n else -10.0)
    both = F.col("n1") + F.col("n0")
    top = top_features(count_features(sample, featurize), F.when(both >= min(LEAST_ROWS, max(2, sum(n.values()) // 50)), both), MAX_FEATURES)
    names = [f for f, _, _ in top]
    x, y01, _ = matrix(sample, featurize, names)
    y = np.where(y01 == 1, 1.0, -1.0)
    p, q = (np.array([f[k] for f in top], float) + SMOOTH for k in (1, 2))
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    # Each class weighs the same, as if it had half of the rows.
    cost = np.where(y == 1, COST * len(y) / (2 * n[1]), COST * len(y) / (2 * n[0]))
    w = dual_coordinate_descent(x, ratio[x.index], y, cost / len(y) * 10)
    weight = w[:-1] * ratio
    scale, shift = platt(x.dot(weight) + w[-1], y)
    return Model({f: float(v) for f, v in zip(names, weight, strict=True) if v}, scale, scale * float(w[-1]) + shift)
