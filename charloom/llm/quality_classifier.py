"""Operator 3, quality classifier: naive Bayes support vectors.

Features are indicators hashed into ``2 ** bits`` buckets: the byte 1- to 4-grams of the
text, and the repetition patterns of its 5-word windows (which words equal the one
before), each with the powers of two that its count reaches.  Spark counts, over every labelled training document, in how
many documents of each class a feature occurs; a feature's weight scale is its
log-count ratio.  On the scaled indicators a linear hinge-loss model is fitted by dual
coordinate descent, and a logistic curve on its margins gives scores from 0 to 1.

Bounds: the counts use every training row; the fit uses at most ``fit_rows`` of them
(those whose id hashes lowest) and at most ``2 ** bits`` features, so what reaches the
driver does not grow with the input.

Defined results: null and empty texts have no features and get the score of the bias
alone.  Labels that are null are no labels; an id labelled twice counts once a row.
Without both classes in the training rows every score is the share of label 1 (0.5 if
there are no labels at all).
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
ORDERS = (1, 2, 3, 4)
WINDOW = 5
FIT_ROWS = 4000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct buckets of the whole text's features, ascending."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    seen = np.zeros(1 << bits, bool)
    code = np.zeros(len(raw), np.uint64)
    for order in ORDERS:
        if len(raw) < order:
            break
        # An n-gram code: its bytes, and a leading one that tells the order.
        code = (code[:len(raw) - order + 1] << np.uint64(8)) | raw[order - 1:]
        seen[((code + (np.uint64(1) << np.uint64(8 * order))) * _MIX) >> np.uint64(64 - bits)] = True
    words = (text or "").encode().split()
    if len(words) >= WINDOW:
        same = np.fromiter(map(operator.eq, words, words[1:]), np.int64, len(words) - 1)
        if same.any():
            pattern = sum(same[k:len(same) - WINDOW + 2 + k] << k for k in range(WINDOW - 1))
            for kind, n in enumerate(np.bincount(pattern)):
                if kind and n:
                    levels = np.arange(int(n).bit_length(), dtype=np.uint64) + np.uint64((1 << 48) + (kind << 8))
                    seen[(levels * _MIX) >> np.uint64(64 - bits)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Feature weights (log-count ratio times fitted weight), bias, logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, text: str | None) -> float:
        f = features(text, int(len(self.weights)).bit_length() - 1)
        return float(self.weights[f].sum() / np.sqrt(max(len(f), 1))) + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -35, 35)))


def class_counts(labelled: DataFrame, bits: int = BITS) -> DataFrame:
    """(bucket, y, n): documents of class y (0/1) that have the feature; bucket -1 counts
    the documents.  ``labelled`` has text and y.  Every task sends a row per feature and
    class at most."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((2, (1 << bits) + 1), np.int64)
        for frame in frames:
            for text, y in zip(frame["text"], frame["y"]):
                n[y, features(text, bits)] += 1
                n[y, -1] += 1
        for y in (0, 1):
            at = np.flatnonzero(n[y])
            yield pd.DataFrame({"bucket": np.where(at == 1 << bits, -1, at), "y": y, "n": n[y, at]})

    parts = labelled.select("text", "y").mapInPandas(count, "bucket int, y int, n long")
    return parts.groupBy("bucket", "y").agg(F.sum("n").alias("n"))


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float = 1.0,
                            epochs: int = 30, tolerance: float = 1e-3, seed: int = 1) -> tuple[np.ndarray, float]:
    """L2-regularised hinge loss.  Row i has the values scale[rows[i]] / sqrt(len) and a
    constant bias feature 1; y is -1 or 1.  Returns weights over unscaled rows and bias."""
    w, b = np.zeros(len(scale)), 0.0
    root = np.sqrt([max(len(r), 1) for r in rows])
    diagonal = np.array([scale[r] @ scale[r] for r in rows]) / root ** 2 + 1
    alpha = np.zeros(len(rows))
    order = np.arange(len(rows))
    shuffle = np.random.default_rng(seed).shuffle
    # Classes weigh alike whatever their sizes.
    limit = np.where(y > 0, cost * len(y) / (2 * max((y > 0).sum(), 1)), cost * len(y) / (2 * max((y < 0).sum(), 1)))
    for _ in range(epochs):
        shuffle(order)
        most = 0.0
        for i in order:
            values = scale[rows[i]] / root[i]
            gradient = y[i] * (w[rows[i]] @ values + b) - 1
            projected = min(gradient, 0) if alpha[i] <= 0 else max(gradient, 0) if alpha[i] >= limit[i] else gradient
            most = max(most, abs(projected))
            if projected:
                new = min(max(alpha[i] - gradient / diagonal[i], 0), limit[i])
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values
                b += step
                alpha[i] = new
        if most < tolerance:
            break
    return w * scale, b


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps on smoothed targets; each
    class weighs alike, so that 0.5 lies between the classes."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    weight = np.where(y > 0, 0.5 / up, 0.5 / down) * len(y)
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + c, -35, 35)))
        g = weight * (p - target)
        h = weight * p * (1 - p)
        ga, gc = g @ margins + 1e-3 * a, g.sum()
        haa, hac, hcc = h @ margins ** 2 + 1e-3, h @ margins, h.sum() + 1e-9
        det = haa * hcc - hac * hac
        if det <= 1e-12:
            break
        da, dc = (hcc * ga - hac * gc) / det, (haa * gc - hac * ga) / det
        a, c = a - da, c - dc
        if abs(da) + abs(dc) < 1e-8:
            break
    return float(a), float(c)


def fit_sample(docs: DataFrame, labels: DataFrame, y: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows of class ``y``: those whose id hashes lowest.  They
    are chosen by id alone, so that only their texts move."""
    order = (F.xxhash64("id"), F.col("id"))
    chosen = docs.select("id").join(labels.where(F.col("y") == y), "id").select("id").distinct().orderBy(*order).limit(rows)
    # ``rows`` ids at most.
    return docs.join(F.broadcast(chosen), "id").orderBy(*order, F.xxhash64("text")).limit(rows)


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, fit_rows: int = FIT_ROWS, smoothing: float = 1.0) -> Model:
    """``docs``: id and text, the training rows only; ``labels``: id and y (0/1)."""
    n = np.zeros((2, (1 << bits) + 1))
    # Labels grow with the documents: both sides shuffle, at every size.
    got = class_counts(docs.join(labels.hint("merge"), "id"), bits).toPandas()  # 2 * (2 ** bits + 1) rows at most
    n[got["y"], got["bucket"]] = got["n"]
    del got
    size = n[:, -1]
    if size.min() == 0:
        share = float(size[1] / size.sum()) if size.sum() else 0.5
        return Model(np.zeros(1 << bits), 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    p = (n[:, :-1] + smoothing) / (size[:, None] + 2 * smoothing)
    ratio = np.log(p[1] / p[0])
    ratio[n[:, :-1].sum(axis=0) == 0] = 0.0

    found = F.pandas_udf(_features_batch(bits), "array<int>")
    # Half the bound for each class, so that a rare class is seen.
    rows, y = [], []
    for value in (0, 1):
        got = fit_sample(docs, labels, value, fit_rows // 2).select(found("text").alias("f")).toPandas()["f"]
        rows += [np.asarray(f, np.int32) for f in got]
        y += [2 * value - 1] * len(got)
    y = np.array(y)
    weights, bias = dual_coordinate_descent(rows, ratio, y)
    margins = np.array([weights[r].sum() / np.sqrt(max(len(r), 1)) for r in rows]) + bias
    return Model(weights, bias, *_logistic(margins, y))


def _features_batch(bits: int):
    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, bits) for t in texts], dtype=object)

    batch.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return batch


def score(text: Column, model: Model, spark) -> Column:
    """Score in [0, 1] of a text; the model (``2 ** bits`` doubles) is broadcast."""
    sent = spark.sparkContext.broadcast(model)

    def batch(texts: pd.Series) -> pd.Series:
        m = sent.value
        return pd.Series(m.score(np.array([m.margin(t) for t in texts], float)))

    batch.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, "double")(text)


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", **options) -> DataFrame:
    """Fit on the labelled rows that are not held out; score every row.  Returns id,
    held_out, score, predicted."""
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    own = docs.select(ident.alias("id"), text.alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    known = labels.select(ident.alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y in (0, 1)")
    model = fit(own.where(~F.col("held_out")).select("id", "text"), known, **options)
    scored = own.select("id", "held_out", score(F.col("text"), model, docs.sparkSession).alias("score"))
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
