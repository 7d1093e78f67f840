"""Operator 2, benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

1. Over all documents, count in how many each 3-word n-gram of a test item occurs.
2. Seeds of an item: of every ``WINDOW`` n-grams in a row, the rarest.  So any five words
   copied in a row hold a seed, however common the item's n-grams are in the corpus.
3. A seed in a document joins it to the item and fixes a diagonal; the words around it
   are aligned with the item by Smith-Waterman (match 1, mismatch and gap -0.5).  An
   alignment of ``share`` of the item's words and at least ``least`` is a leak, so
   edited and paraphrased copies count as well as exact ones.  So is one of ``LONG``
   that covers a seed rare in the corpus (in at most ``RARE_SHARE`` of the documents, or
   in ``RARE_DOCS``), whatever its share of the item.

The join is a lookup: item n-grams come in blocks of at most about ``BLOCK_ITEMS`` items,
broadcast one block after the other, so a large benchmark costs more passes and no more
memory.  A document is read once to count and once to align, and only counts and leaks
leave the task.  An item that shares too few words with a window to reach the score is
skipped before aligning (the bound is exact), and a verbatim copy needs no table.

Words are lower-cased runs of letters, digits and non-ASCII characters; in scripts without
spaces each character is a word.  Defined results: null and empty texts leak nothing; null
or wordless items match nothing; items of fewer than three words are one seed of their own
length, looked up in every document, and must occur whole.  Repeated items are separate
items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 3
WINDOW = 3
SHARE = 0.5
LEAST = 6.0
# Matched words less penalties that are a leak in themselves.
LONG = 13.0
RARE_SHARE = 1e-3
RARE_DOCS = 10
BLOCK_ITEMS = 50_000
PENALTY = 0.5
LEAK = "array<struct<item:int,score:double,share:double,word_start:int,word_end:int>>"
_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
# Thai and Lao, Tibetan, Myanmar, Khmer, Kana, Bopomofo, Han.
_UNSPACED = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31ff"
                       "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")
# CJK punctuation and full-width signs end a word.
_SIGNS = re.compile("[\u3000-\u3004\u3008-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def words_of(text: str | None) -> list[bytes]:
    text = text or ""
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", _SIGNS.sub(" ", text))
    return text.lower().encode().translate(_WORDS).split()


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: score, start and end (exclusive) in ``window``.

    Row by row over the item; a gap along the row is a running maximum."""
    n = len(window)
    ramp = PENALTY * np.arange(1, n + 1)
    row, begin = np.zeros(n + 1), np.arange(n + 1)
    best = (0.0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(window == word, 1.0, -PENALTY)
        down = row[1:] - PENALTY
        top = np.maximum(diagonal, down)
        start = np.where(diagonal >= down, begin[:-1], begin[1:])
        lifted = top + ramp
        high = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == high, np.arange(n), 0))
        score = high - ramp
        start = start[source]
        fresh = score <= 0
        row[1:] = np.where(fresh, 0.0, score)
        begin[1:] = np.where(fresh, np.arange(1, n + 1), start)
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (float(row[at]), int(begin[at]), at)
    return best


@dataclass
class Index:
    """Words, n-grams and seeds of one block of items."""

    items: list[list[bytes]]
    vocab: dict[bytes, int] = field(default_factory=dict)
    codes: list[np.ndarray] = field(default_factory=list)
    grams: np.ndarray | None = None
    seeds: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    seed_codes: np.ndarray | None = None
    rare: set[int] = field(default_factory=set)
    short: list[int] = field(default_factory=list)  # lengths of items under SEED words

    def __post_init__(self) -> None:
        for words in self.items:
            self.codes.append(np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words], np.int64))
        every = [self.grams_of(c) for c in self.codes if len(c)]
        self.grams = np.unique(np.concatenate(every)) if every else np.zeros(0, np.int64)
        self.short = sorted({len(c) for c in self.codes if 0 < len(c) < SEED})

    def grams_of(self, codes: np.ndarray, size: int = 0) -> np.ndarray:
        """Codes of the n-grams of ``size`` words by position (-1 where a word is unknown).
        Those of fewer than SEED words are filled up with a word that none has; without a
        size, a sequence shorter than SEED is one n-gram."""
        base = len(self.vocab) + 1
        size = size or min(len(codes), SEED)
        if not 0 < size <= len(codes):
            return np.zeros(0, np.int64)
        out = np.zeros(len(codes) - size + 1, np.int64)
        known = np.ones(len(out), bool)
        for k in range(SEED):
            part = codes[k:k + len(out)] if k < size else np.int64(len(self.vocab))
            out = out * base + part
            known &= part >= 0
        return np.where(known, out, -1)

    def choose_seeds(self, frequency: np.ndarray, documents: int) -> None:
        """``frequency``: of ``documents``, those with a gram, in the order of ``grams``."""
        rare = frequency <= max(RARE_SHARE * documents, RARE_DOCS)
        for i, codes in enumerate(self.codes):
            g = self.grams_of(codes)
            f = frequency[np.searchsorted(self.grams, g)]
            chosen = {a + int(f[a:a + WINDOW].argmin()) for a in range(max(len(g) - WINDOW + 1, min(len(g), 1)))}
            for q in sorted(chosen):
                self.seeds.setdefault(int(g[q]), []).append((i, q))
        self.seed_codes = np.array(sorted(self.seeds), np.int64)
        self.rare = set(self.grams[rare].tolist()) & set(self.seeds)

    def known(self, words: list[bytes]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def found(self, codes: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and codes of the document's n-grams that are in ``among`` (sorted)."""
        spots, found = [], []
        for size in (*self.short, SEED):
            g = self.grams_of(codes, size)
            at = np.flatnonzero(g >= 0)
            if len(at) and len(among):
                place = np.searchsorted(among, g[at])
                at = at[among[np.minimum(place, len(among) - 1)] == g[at]]
                spots.append(at)
                found.append(g[at])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *spots]), np.concatenate([none, *found])

    def leaks(self, text: str | None, share: float, least: float) -> list[tuple[int, float, float, int, int]]:
        codes = self.known(words_of(text))
        at, g = self.found(codes, self.seed_codes)
        diagonals: dict[int, set[int]] = {}
        rare: dict[int, list[int]] = {}
        for p, code in zip(at.tolist(), g.tolist()):
            for item, q in self.seeds[code]:
                diagonals.setdefault(item, set()).add(p - q)
                if code in self.rare:
                    rare.setdefault(item, []).append(p)
        out = []
        for item, starts in sorted(diagonals.items()):
            target = self.codes[item]
            n = len(target)
            need = n * share if n < SEED else min(max(n * share, least), n)
            best = (0.0, 0, 0)
            for s in sorted(starts):
                if s >= 0 and np.array_equal(codes[s:s + n], target):
                    best = (float(n), s, s + n)
                    break
            else:
                pad = max(5, n // 4)
                count = Counter(target.tolist())
                for a, b in _merged(starts, n, pad, len(codes)):
                    window = codes[a:b]
                    kinds, times = np.unique(window[window >= 0], return_counts=True)
                    spots = [p for p in rare.get(item, ()) if a <= p < b]
                    if sum(min(t, count[k]) for k, t in zip(kinds.tolist(), times.tolist()) if k in count) < (min(need, LONG) if spots else need):
                        continue
                    score, x, y = align(target, window)
                    long = score >= LONG and any(a + x <= p and p + SEED <= a + y for p in spots)
                    if score > best[0] and (score >= need or long):
                        best = (score, a + x, a + y)
            if best[0] > 0:
                out.append((item, best[0], best[0] / n, best[1], best[2]))
        return out


def _merged(starts: set[int], n: int, pad: int, length: int) -> Iterator[tuple[int, int]]:
    """Windows around the diagonals, overlapping ones joined."""
    a = b = None
    for s in sorted(starts):
        lo, hi = max(0, s - pad), min(length, s + n + pad)
        if b is not None and lo <= b:
            b = max(b, hi)
        else:
            if b is not None:
                yield a, b
            a, b = lo, hi
    if b is not None:
        yield a, b


def _frequencies(docs: DataFrame, text_col: str, sent) -> tuple[np.ndarray, int]:
    """Documents per n-gram, and documents, over all of ``docs``."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = sent.value
        n = np.zeros(len(index.grams), np.int64)
        rows = 0
        for frame in frames:
            rows += len(frame)
            for text in frame["text"]:
                _, g = index.found(index.known(words_of(text)), index.grams)
                n[np.searchsorted(index.grams, np.unique(g))] += 1
        at = np.flatnonzero(n)
        yield pd.DataFrame({"gram": np.append(at, -1), "n": np.append(n[at], rows)})

    parts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInPandas(count, "gram long, n long")
    got = {r["gram"]: r["n"] for r in parts.groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # grams of one block at most
    documents = got.pop(-1, 0)
    total = np.zeros(len(sent.value.grams), np.int64)
    total[list(got.keys())] = list(got.values())
    return total, documents


def leak_columns(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 share: float = SHARE, least: float = LEAST, block_items: int = BLOCK_ITEMS) -> list[tuple[Column, list]]:
    """One (leaks, item ids) a block of items: leaks is an array column on ``docs``, whose
    ``item`` indexes the ids."""
    spark = docs.sparkSession
    own = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").alias("text")).where(F.col("text").isNotNull())
    blocks = max(1, -(-own.count() // block_items))
    out = []
    for k in range(blocks):
        rows = sorted(own.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect(),
                      key=lambda r: (r["item"] is None, r["item"], r["text"]))
        index = Index([words_of(r["text"]) for r in rows])
        sent = spark.sparkContext.broadcast(index)
        index.choose_seeds(*_frequencies(docs, text_col, sent))
        sent.unpersist()
        seeded = spark.sparkContext.broadcast(index)
        out.append((F.pandas_udf(_one_series(seeded, share, least), LEAK)(F.col(f"`{text_col}`")), [r["item"] for r in rows]))
    return out


def _one_series(seeded, share: float, least: float):
    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series([seeded.value.leaks(t, share, least) for t in texts], dtype=object)

    batch.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return batch


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", **options) -> DataFrame:
    """One row per document row and item that leaks into it: id, item_id, score (matched
    words less penalties), share (score by the item's words), word_start, word_end."""
    kind = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema[item_id].dataType)])
    found = None
    for column, ids in leak_columns(docs, items, text_col, item_id, **options):
        hits = docs.select(F.col(f"`{id_col}`").alias("_id"), column.alias("leaks")).select("_id", F.explode("leaks").alias("x"))
        # One row per item of the block.
        listed = docs.sparkSession.createDataFrame(list(enumerate(ids)), kind)
        hits = hits.join(F.broadcast(listed), F.col("x.item") == F.col("item")).select("_id", "item_id", "x")
        found = hits if found is None else found.unionAll(hits)
    return found.select(F.col("_id").alias(id_col), "item_id", "x.score", "x.share", "x.word_start", "x.word_end")


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` into which no item leaks."""
    for column, _ in leak_columns(docs, items, text_col, **options):
        docs = docs.where(F.size(column) == 0)
    return docs
