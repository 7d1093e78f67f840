"""Operator 5, language identification by multilingual mixture inference.

Spark counts hashed byte trigrams of lower-cased words per language over every training
row.  A document's words are taken as drawn from a mixture of the learned languages:
each word's likelihood under a language is the product of its trigrams' probabilities,
and expectation-maximisation estimates the proportions.  The language set is chosen by
penalised likelihood: languages enter in order of proportion, and each one must raise
the log-likelihood by more than ``penalty * log(words + 1)``.

The prediction is the language with the largest proportion in the chosen set; the score
is that proportion times the posterior of the language against the runner-up.

Bounds: counts use every training row; what reaches the driver is at most
languages * 2 ** BITS numbers.  Whole texts are read, in slices of about ``SLICE``
bytes of several documents (one very long document is one slice).

Defined results: null texts and texts without a letter get ``und`` and score 0; so does
every text when nothing was learned.  Ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
SLICE = 1 << 20
_MIX = np.uint32(2654435761)
# ASCII non-letters separate words; all bytes of other characters stay.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
UNDETERMINED = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_LETTERS).split()


def trigrams(words: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of ' word word ', and each word's first trigram: a word
    of n bytes has the n trigrams centred on its bytes and the one on the space after it."""
    raw = np.frombuffer(b" " + b" ".join(words) + b"  ", np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return (code * _MIX) >> np.uint32(32 - bits), np.cumsum(size) - size


def language_counts(training: DataFrame, bits: int = BITS, at_once: int = 32) -> DataFrame:
    """(lang, bucket, n) over all rows of ``training`` (text, lang)."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": n[at]})
            held.clear()

        for frame in frames:
            for text, lang in zip(frame["text"], frame["lang"]):
                words = words_of(text)
                if not words:
                    continue
                if lang not in held and len(held) >= at_once:
                    yield from flush()
                n = held.setdefault(lang, np.zeros(1 << bits, np.int64))
                got, times = np.unique(trigrams(words, bits)[0], return_counts=True)
                n[got] += times
        yield from flush()

    parts = training.select("text", "lang").mapInPandas(count, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    log_p: np.ndarray  # (2 ** bits, languages), float32


def fit(training: DataFrame, bits: int = BITS, smoothing: float = 0.5) -> Model:
    got = language_counts(training, bits).toPandas()
    langs = tuple(sorted(got["lang"].unique()))
    n = np.zeros((1 << bits, len(langs)))
    for k, lang in enumerate(langs):
        mine = got[got["lang"] == lang]
        n[mine["bucket"].to_numpy(), k] = mine["n"]
    kinds = max((n.sum(axis=1) > 0).sum(), 1)
    log_p = np.log((n + smoothing) / (n.sum(axis=0) + smoothing * kinds)) if langs else n
    return Model(langs, log_p.astype(np.float32))


def _mixture(p: np.ndarray, doc: np.ndarray, starts: np.ndarray, pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of the proportions of every document at once.  p: scaled
    likelihoods (word, language); returns proportions and log-likelihoods (scaled alike)."""
    size = np.diff(np.append(starts, len(p)))[:, None]
    for _ in range(rounds):
        r = p * pi[doc]
        r /= r.sum(axis=1, keepdims=True)
        pi = np.add.reduceat(r, starts) / size
        pi = (pi + 1e-12) / (pi + 1e-12).sum(axis=1, keepdims=True)
    return pi, np.add.reduceat(np.log((p * pi[doc]).sum(axis=1)), starts)


def infer(docs: list[list[bytes]], model: Model, rounds: int = 15, penalty: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """(proportions over the languages, 0 outside the chosen set; score) of documents
    that each have a word."""
    count = np.array([len(d) for d in docs])
    starts = np.cumsum(count) - count
    doc = np.repeat(np.arange(len(docs)), count)
    bucket, first = trigrams([w for d in docs for w in d], len(model.log_p).bit_length() - 1)
    ll = np.add.reduceat(model.log_p[bucket], first).astype(np.float64)
    alone = np.add.reduceat(ll, starts)
    best = alone.argmax(axis=1)
    every = np.arange(len(docs))
    k = len(model.langs)
    gap = alone[every, best] - (np.sort(alone, axis=1)[:, -2] if k > 1 else -np.inf)
    sure = 1 / (1 + np.exp(-np.clip(gap, 0, 50)))
    out = np.zeros((len(docs), k))
    out[every, best] = 1.0
    if k == 1:
        return out, sure
    top = ll.max(axis=1)
    p = np.exp(np.maximum(ll - top[:, None], -60))
    base = np.add.reduceat(top, starts)
    pi, joint = _mixture(p, doc, starts, np.full((len(docs), k), 1 / k), rounds)
    price = penalty * np.log(count + 1)
    # No set fits better than all languages do: only these can be mixed.
    mixed = np.flatnonzero(joint + base - alone[every, best] > price)
    if len(mixed):
        into = np.full(len(docs), -1)
        into[mixed] = np.arange(len(mixed))
        rows = into[doc] >= 0
        q, d = p[rows], into[doc[rows]]
        s = np.cumsum(count[mixed]) - count[mixed]
        rank = np.argsort(np.argsort(-pi[mixed], axis=1, kind="stable"), axis=1)
        value = alone[mixed, best[mixed]] - base[mixed]
        for size in range(2, k + 1):
            inside = rank < size
            share, fit_ = _mixture(q, d, s, np.where(inside, pi[mixed] + 1e-9, 0) /
                                   np.where(inside, pi[mixed] + 1e-9, 0).sum(axis=1, keepdims=True), rounds)
            better = fit_ - price[mixed] * (size - 1) > value
            value = np.where(better, fit_ - price[mixed] * (size - 1), value)
            out[mixed[better]] = np.where(inside, share, 0)[better]
            sure[mixed[better]] = 1.0
    return out, sure * out.max(axis=1)


def predict_batch(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    at: list[int] = []
    docs: list[list[bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if docs:
            share, score = infer(docs, model)
            for i, k, sc in zip(at, share.argmax(axis=1), score):
                langs[i], scores[i] = model.langs[k], float(min(max(sc, 0.0), 1.0))
        at.clear()
        docs.clear()
        held = 0

    for i, text in enumerate(texts if model.langs else ()):
        if has_letter(text) and (words := words_of(text)):
            at.append(i)
            docs.append(words)
            held += len(text)
            if held >= SLICE:
                flush()
    flush()
    return langs, scores


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             bits: int = BITS) -> DataFrame:
    """Learn from the rows that are not held out and have a language; predict every row.
    Returns id, held_out, lang_pred, score."""
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                      F.col(f"`{lang_col}`").alias("lang"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = fit(own.where(~F.col("held_out") & F.col("lang").isNotNull()), bits)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batch(texts: pd.Series) -> pd.DataFrame:
        langs, scores = predict_batch(texts.tolist(), sent.value)
        return pd.DataFrame({"lang_pred": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype=float)})

    batch.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    guess = F.pandas_udf(batch, "lang_pred string, score double")(F.col("text"))
    return own.select(F.col("id").alias(id_col), "held_out", guess.alias("g")).select(id_col, "held_out", "g.*")
