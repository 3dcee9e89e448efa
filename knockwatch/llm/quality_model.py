"""Text quality by naive Bayes support vectors.

Indicators of n-grams (of words, of word shapes, and of repetition) are scaled by the
log ratio of their counts in the two classes; a linear model with hinge loss is fitted on
them by dual coordinate descent, and its margin is calibrated on examples left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwatch.llm import textvec

FEATURE_BITS = 18
#: Bound on the labelled rows the model is fitted on (a hash sample, of about this size at most).
SAMPLE_ROWS = 8000
MIN_EXAMPLES = 3
HOLD_OUT = 5
THRESHOLD = 0.3

# Shape classes of a byte: one for each kind of letter, one for digits, each sign its own.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[textvec.LETTER] = 1
_SHAPE[textvec.UPPER] = 2
_SHAPE[textvec.DIGIT] = 3
_SALT = [np.uint64(x) for x in np.random.default_rng(3).integers(1, 1 << 62, 12)]
_TIMES = np.uint64(0x100000001B3)


def features(text: str | None) -> np.ndarray:
    """Sorted indices of the indicators that hold for a text; none for an empty text."""
    data = textvec.text_bytes(text)
    starts, at = textvec.runs(~textvec.SPACE[data])
    if not len(at):
        return np.zeros(0, dtype=np.int32)
    plain = data[at]
    word = textvec.hash_runs(textvec.LOWER[plain], starts)
    kind = _SHAPE[plain]
    turn = np.concatenate(([True], kind[1:] != kind[:-1]))
    turn[starts] = True
    kept = np.flatnonzero(turn)
    shape = textvec.hash_runs(kind[kept], np.searchsorted(kept, starts))
    again = np.concatenate(([False], word[1:] == word[:-1]))
    shape = np.where(again, shape ^ _SALT[0], shape)
    line = np.searchsorted(np.flatnonzero(data == 10), at[starts])
    first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    shape[first] ^= _SALT[1]
    place = np.arange(len(word)) - np.repeat(first, np.diff(np.append(first, len(word))))
    lines = np.add.reduceat(textvec.mix(word + (place.astype(np.uint64) * _SALT[2])), first)
    found = [word + _SALT[3], shape + _SALT[4]]
    if len(word) > 1:
        found.append(word[:-1] * _TIMES + word[1:] + _SALT[5])
        found.append(shape[:-1] * _TIMES + shape[1:] + _SALT[6])
    if len(word) > 2:
        found.append((shape[:-2] * _TIMES + shape[1:-1]) * _TIMES + shape[2:] + _SALT[7])
    repeats = int(4 * (len(lines) - len(np.unique(lines))) / len(lines))
    distinct = int(10 * len(np.unique(word)) / len(word))
    size = int(np.log2(len(word)))
    found.append(np.array([repeats, 100 + distinct, 200 + size], dtype=np.uint64) * _SALT[8] + _SALT[9])
    hashes = textvec.mix(np.concatenate(found))
    return np.unique(hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, indices: np.ndarray) -> float:
        values = self.weights[indices]
        return float(values.sum()) + self.bias

    def score(self, indices: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(indices) + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray) -> np.ndarray:
    """Log ratio of each indicator's rate in the two classes; 0 for rare indicators.

    Smoothing is shared out by class size, so that an indicator met equally often in both has ratio 0.
    """
    size = 1 << FEATURE_BITS
    yes = np.bincount(np.concatenate([r for r, y in zip(rows, positive) if y]), minlength=size)
    no = np.bincount(np.concatenate([r for r, y in zip(rows, positive) if not y]), minlength=size)
    n_yes, n_no = int(positive.sum()), int((~positive).sum())
    share = n_yes / (n_yes + n_no)
    ratio = np.log((yes + share) / n_yes) - np.log((no + 1 - share) / n_no)
    return np.where(yes + no >= MIN_EXAMPLES, ratio, 0.0)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], positive: np.ndarray, cost: float = 1.0, rounds: int = 12
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model with L2 penalty and hinge loss, classes weighted alike."""
    size = 1 << FEATURE_BITS
    weights, bias = np.zeros(size), 0.0
    sign = np.where(positive, 1.0, -1.0)
    limit = np.where(positive, cost * len(rows) / (2 * positive.sum()), cost * len(rows) / (2 * (~positive).sum()))
    square = np.array([float(v @ v) + 1.0 for v in values])
    dual = np.zeros(len(rows))
    rng = np.random.default_rng(1)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (float(weights[rows[i]] @ values[i]) + bias) - 1
            new = min(max(dual[i] - gradient / square[i], 0.0), limit[i])
            step = new - dual[i]
            if step:
                weights[rows[i]] += step * sign[i] * values[i]
                bias += step * sign[i]
                dual[i] = new
                moved = max(moved, abs(step) * square[i])
        if moved < 1e-3:
            break
    return weights, bias


def calibrate(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-back margins (Newton steps, light ridge)."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        w = p * (1 - p)
        g = np.array([((p - positive) * margins).sum() + 1e-3 * slope, (p - positive).sum()])
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(slope, 1e-3), offset


def fit(rows: list[np.ndarray], positive: np.ndarray) -> Model:
    """Fit on four fifths, calibrate on the rest; the share of label 1 where a class is missing."""
    positive = np.asarray(positive, dtype=bool)
    back = np.arange(len(rows)) % 5 == 4
    counts = [(positive & ~back).sum(), (~positive & ~back).sum()]
    if min(counts) < 1:
        share = float(positive.mean()) if len(rows) else 0.5
        return Model(np.zeros(1 << FEATURE_BITS), 0.0, 1.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    train = [r for r, b in zip(rows, back) if not b]
    ratio = log_count_ratios(train, positive[~back])
    values = [ratio[r] for r in train]
    norms = [float(np.sqrt(v @ v)) or 1.0 for v in values]
    scale = float(np.mean(norms))
    weights, bias = dual_coordinate_descent(train, [v / scale for v in values], positive[~back])
    model = Model((weights * ratio / scale).astype(np.float32), float(bias))
    if back.any():
        margins = np.array([model.margin(r) for r, b in zip(rows, back) if b])
        model.slope, model.offset = calibrate(margins, positive[back].astype(float))
    return model


def hash_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without an id are in fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(-1))


def sampled_labels(labels: DataFrame, label: str, usable: Column, bound: int) -> DataFrame:
    """``doc_id, label``, one row each: a hash sample of the usable labelled rows, of about ``bound`` at most.

    Where a document has several labels the largest counts.
    """
    known = labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    share = min(1.0, bound / max(1, one.count()))
    return one.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE_ROWS) -> Model:
    """The labelled sample, which is bounded, is broadcast to its texts and its features come to the driver."""
    sample = sampled_labels(labels, label, hash_fold(F.col("doc_id"), HOLD_OUT) > 0, bound)

    @F.pandas_udf("array<int>")
    def indices(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    table = texts.select("doc_id", "label", indices(F.col("text")).alias("indices")).toArrow()
    ids = table["doc_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    rows = table["indices"].combine_chunks()
    found = [rows[int(i)].values.to_numpy(zero_copy_only=False) for i in order]
    return fit(found, table["label"].to_numpy()[order] == 1)


def quality_scores(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Only the text is scored. A null or empty text has no indicators and gets the model's
    score for none; rows without an id are scored and not held out; repeated rows are
    scored as often as they occur. Without labels of both classes every score is the
    share of label 1 (one half without any label). An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, bound=bound))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.value.score(features(t)) for t in texts], dtype="float64")

    scored = docs.select(
        "doc_id", (hash_fold(F.col("doc_id"), HOLD_OUT) == 0).alias("held_out"), score(F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
