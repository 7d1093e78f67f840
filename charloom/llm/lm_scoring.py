"""Operator 4, language-model scoring by cross-entropy difference.

Two word-bigram models, one of target documents and one of all the others, share one
vocabulary, one set of bigrams, one discount and one smoothing, so that their losses per
token compare.  A document's score is its mean loss under the target model less that
under the background model: the lower, the more it reads like the target.

The vocabulary is every word of every document and the bigrams are all that occur; none
is cut or merged, at any size of corpus.  A bigram that one side has not seen gets its
context's left-over mass times the word's smoothed share, so each model sums to 1.
The models are neither broadcast nor joined row by row.  Documents are dealt into slices
of about ``SLICE_CHARS`` characters by a hash of id and text; the texts shuffle once.  A
slice sends its distinct bigrams with their counts to ranges of the hash, where the counts
of all slices add up, and gets back the totals of what it asked for, in the same order.
The same way its words, as words and as contexts, get their totals, and then the slice
has all it needs to score its own documents.  So no row per document and bigram is
shuffled, a key with very many occurrences is one entry a slice, and no task holds more
than a slice or a range.  Between slices and ranges go sorted arrays, as differences and
by planes of bytes (``pack``).  Words and bigrams are told apart by 64-bit hashes.  Rows
alike in id and text fall into one slice.

Defined results: null and empty texts have 0 tokens and null losses and score.  Without
target (or background) documents that model is uniform.  Documents whose id is null are
background.  An id with several labels is target if one of them says so.  Repeated rows
(same id and text) each get the same score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

DISCOUNT = 0.75
HELD_WORDS = 400_000
HELD_TOKENS = 1 << 21
UNKNOWN = 0
# Fixed value: the hash that stands for the context of a first word.
START = 0
SLICE_CHARS = 1 << 24
# Texts tokenized at a time within a slice.
CHUNK = 1000
# No longer read: no key is spread any more, at any number of rows.
HOT_ROWS = 10_000


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all of ``docs`` (text).  A task holds ``HELD_WORDS`` words at most."""
    def frame_of(held: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": pd.Series(list(held.keys()), dtype=object), "n": list(held.values())})

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for frame in frames:
            for text in frame["text"]:
                held.update(words_of(text))
                if len(held) >= HELD_WORDS:
                    yield frame_of(held)
                    held = Counter()
        if held:
            yield frame_of(held)

    return docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Word ids from 1; 0 is any other word, ``start`` the context of a first word."""

    def __init__(self, words: list[str]):
        self.ids = {w: i + 1 for i, w in enumerate(words)}
        self.start = len(words) + 1
        self.base = len(words) + 2

    def bigrams(self, text: str | None) -> np.ndarray:
        """context * base + word of every token."""
        words = words_of(text)
        get = self.ids.get
        ids = np.fromiter((get(w, UNKNOWN) for w in words), np.int64, len(words))
        before = np.concatenate([[self.start], ids[:-1]]) if len(ids) else ids
        return before * self.base + ids


def bigram_counts(docs: DataFrame, vocab) -> DataFrame:
    """(bigram, n0, n1): tokens of background and target documents, over all of ``docs``
    (text, target)."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocab.value
        held: list[list[np.ndarray]] = [[], []]
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            for side in (0, 1):
                if held[side]:
                    code, n = np.unique(np.concatenate(held[side]), return_counts=True)
                    yield pd.DataFrame({"bigram": code, "n0": n * (1 - side), "n1": n * side})
                held[side].clear()

        for frame in frames:
            for text, target in zip(frame["text"], frame["target"]):
                code = words.bigrams(text)
                held[int(target)].append(code)
                size += len(code)
                if size >= HELD_TOKENS:
                    yield from flush()
                    size = 0
        yield from flush()

    parts = docs.select("text", "target").mapInPandas(count, "bigram long, n0 long, n1 long")
    return parts.groupBy("bigram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


@dataclass(frozen=True)
class Models:
    vocab: Vocabulary
    bigrams: np.ndarray  # sorted
    seen: np.ndarray  # (bigram, side): discounted share of the context
    rest: np.ndarray  # (context, side): mass left over
    word: np.ndarray  # (word, side): smoothed share of the word

    def losses(self, code: np.ndarray) -> np.ndarray:
        """-log p of every bigram under both sides."""
        p = self.rest[code // self.vocab.base] * self.word[code % self.vocab.base]
        if len(self.bigrams):
            at = np.minimum(np.searchsorted(self.bigrams, code), len(self.bigrams) - 1)
            hit = self.bigrams[at] == code
            p[hit] += self.seen[at[hit]]
        return -np.log(p)


def fit(docs: DataFrame, sided: DataFrame, word_share: float = 0.0, bigram_share: float = 0.0, discount: float = DISCOUNT) -> Models:
    """The models held in one process, for small corpora and as the check of ``score``,
    which does not use it.  ``docs``: text of all documents; ``sided``: the same with
    target (boolean).  Words and bigrams under a share, if one is asked for, are cut."""
    counts = checkpointed(word_counts(docs))
    total = counts.agg(F.sum("n")).first()[0] or 0
    vocab = Vocabulary(sorted(r["word"] for r in counts.where(F.col("n") >= word_share * total).select("word").collect()))
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    pairs = checkpointed(bigram_counts(sided, sent))
    base = vocab.base

    def by(key: str) -> np.ndarray:
        out = np.zeros((base, 2))
        got = pairs.groupBy(F.expr(key).alias("k")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
        out[got["k"].to_numpy(np.int64)] = got[["n0", "n1"]].to_numpy(float)
        return out

    context, word = by(f"bigram div {base}"), by(f"bigram % {base}")
    n = word.sum(axis=0)
    kept = pairs.where((F.col("n0") >= F.greatest(F.lit(float(bigram_share * n[0])), F.lit(1.0))) |
                       (F.col("n1") >= F.greatest(F.lit(float(bigram_share * n[1])), F.lit(1.0)))).toPandas().sort_values("bigram")
    code = kept["bigram"].to_numpy(np.int64)
    number = kept[["n0", "n1"]].to_numpy(float).reshape(-1, 2)
    seen = np.maximum(number - discount, 0) / np.maximum(context[code // base], 1)
    used = np.zeros((base, 2))
    np.add.at(used, code // base, seen)
    return Models(vocab, code, seen, 1 - used, (word + 1) / (n + base))


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers by planes of bytes, without the planes that are zero, which the
    compression of shuffles makes small."""
    planes = np.ascontiguousarray(numbers, np.uint64).view(np.uint8).reshape(-1, 8).T
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    return bytes([width]) + planes[:width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :width] = planes.T
    return whole.view(np.uint64)[:, 0]


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): an order that sorts ``keys``, and where each distinct key starts in it."""
    order = np.argsort(keys).astype(np.int32 if len(keys) < 2 ** 31 else np.int64)
    ranked = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.zeros(0, np.int64)


def place_of(order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The number of the distinct key that each entry holds."""
    out = np.empty_like(order)
    out[order] = np.repeat(np.arange(len(starts), dtype=order.dtype), np.diff(starts, append=len(order)))
    return out


def token_hashes(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, number of tokens of every text)."""
    hashes, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at in range(0, len(texts), CHUNK):
        lists = [words_of(t) for t in texts[at:at + CHUNK].to_pylist()]
        lengths.append(np.array([len(x) for x in lists], np.int64))
        # Numbered by Arrow: pandas ends a string at a null character.
        coded = pa.array([w for x in lists for w in x], pa.string()).dictionary_encode()
        kinds = np.array(coded.dictionary.to_pylist(), dtype=object)
        hashes.append(pd.util.hash_array(kinds, categorize=False)[coded.indices.to_numpy()] if len(kinds) else hashes[0])
    return np.concatenate(hashes), np.concatenate(lengths)


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Slice:
    """The bigrams of some documents: ``keys`` (sorted hashes) with ``n0`` and ``n1``, the
    background and target tokens, ``context`` and ``word``; ``of`` is each token's bigram."""

    def __init__(self, rows: pa.Table):
        marked = pc.equal(rows["kind"], LABEL)
        docs = rows.filter(pc.invert(marked))
        wanted = pc.is_in(docs["id"], value_set=pc.drop_null(rows.filter(marked)["id"].combine_chunks()))
        self.ids = docs["id"]
        word, self.lengths = token_hashes(docs["text"])
        del rows, docs
        # Large arrays go as soon as they are used: two tasks share an executor's memory.
        pa.default_memory_pool().release_unused()
        before = np.concatenate([np.array([START], np.uint64), word[:-1]])[:len(word)]
        before[(np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]] = START
        keys = _mixed(before + np.uint64(0x9E3779B97F4A7C15))
        keys += word
        order, starts = grouped(_mixed(keys))
        at = order[starts]
        self.keys, self.context, self.word = keys[at], before[at], word[at]
        del keys, before, word
        n = np.diff(starts, append=len(order))
        side = np.repeat(np.asarray(wanted, bool), self.lengths)[order]
        self.n1 = np.add.reduceat(side, starts, dtype=np.int64) if len(starts) else n
        self.n0 = n - self.n1
        self.of = place_of(order, starts)

    def words(self) -> None:
        """``kinds``, the sorted hashes of words and START; the places in it of the words
        (``w_at``) and the contexts (``c_at``) of the bigrams."""
        both = np.concatenate([self.word, self.context])
        order, starts = grouped(both)
        self.kinds = both[order[starts]]
        self.w_at, self.c_at = np.split(place_of(order, starts), 2)
        del self.word, self.context

    def summed(self, at: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        return np.bincount(at, numbers, len(self.kinds)).astype(np.int64)


def _requests(number: int, buckets: int, keys: np.ndarray, counts: list[np.ndarray]) -> pa.Table:
    """One row a range of the hash, also of those that the slice has no key in."""
    low = [b * 2 ** 64 // buckets for b in range(buckets)]
    at = [*np.searchsorted(keys, np.array(low, np.uint64)), len(keys)]
    rows = [(number, b, pack(np.diff(keys[i:j], prepend=np.uint64(low[b]))), [pack(n[i:j]) for n in counts])
            for b, (i, j) in enumerate(zip(at, at[1:]))]
    return pa.table({name: pa.array(x, kind) for (name, kind), x in zip(REQUEST, zip(*rows))})


def _totals(buckets: int, stage: int):
    """The range's side: the counts of every key over all slices, sent back to each slice
    in its own order; ``first``: the keys that this slice alone is told to answer for;
    ``sums``: the range's distinct words, then the sums of its counts."""
    def add(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        low = np.uint64(bucket * 2 ** 64 // buckets)
        asked = [low + np.cumsum(unpack(x), dtype=np.uint64) for x in rows["keys"].to_pylist()]
        ends = np.cumsum([len(x) for x in asked])
        keys = np.concatenate(asked)
        order, starts = grouped(keys)
        of, counts = place_of(order, starts), list(zip(*rows["counts"].to_pylist()))
        first = np.zeros(len(keys), np.uint8)
        first[order[starts]] = 1
        sums, totals = [int((keys[order[starts]] != START).sum())], [[] for _ in asked]
        for column in counts:
            # Sums below 2 ** 53 are exact.
            total = np.bincount(of, np.concatenate([unpack(x) for x in column]), len(starts)).astype(np.int64)
            sums.append(int(total.sum()))
            for out, part in zip(totals, np.split(of, ends[:-1])):
                out.append(pack(total[part]))
        out = [rows["slice"].to_pylist(), [bucket] * len(asked), [stage] * len(asked), totals,
               [np.packbits(x).tobytes() for x in np.split(first, ends[:-1])], [sums] * len(asked)]
        return pa.table({name: pa.array(x, kind) for (name, kind), x in zip(ANSWER, out)})

    return add


def _answers(rows: pa.Table, stage: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(totals, first, sums) of a slice's keys, in their order."""
    rows = rows.filter(pc.equal(rows["stage"], stage)).sort_by("bucket")
    columns = list(zip(*[[unpack(x) for x in r] for r in rows["totals"].to_pylist()]))
    totals = [np.concatenate(c).astype(np.int64) for c in columns]
    sizes = [data[0] and (len(data) - 1) // data[0] for data, *_ in rows["totals"].to_pylist()]
    first = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["first"].to_pylist(), sizes)])
    return totals, first.astype(bool), np.array(rows["sums"].to_pylist(), np.int64).sum(axis=0)


REQUEST = [("slice", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.list_(pa.binary()))]
ANSWER = [("slice", pa.int64()), ("bucket", pa.int64()), ("stage", pa.int64()), ("totals", pa.list_(pa.binary())),
          ("first", pa.binary()), ("sums", pa.list_(pa.int64()))]
REQUEST_DDL = "slice long, bucket long, keys binary, counts array<binary>"
ANSWER_DDL = "slice long, bucket long, stage long, totals array<binary>, first binary, sums array<long>"
# Kinds of rows in a slice, and the two exchanges.
DOC, LABEL = 0, 1
PAIRS, WORDS = 0, 1


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          discount: float = DISCOUNT) -> DataFrame:
    """Fit on all rows (target: label 1) and score every row.  Returns id, n_tokens,
    loss_target, loss_background, score (nats per token)."""
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0
    buckets = max(1, -(-size // SLICE_CHARS))
    number = F.pmod(F.xxhash64(ident.isNull(), ident, text), F.lit(buckets)).alias("slice")
    own = docs.select(number, F.lit(DOC).alias("kind"), ident.alias("id"), text.alias("text"))
    wanted = labels.where(F.col(f"`{label_col}`") == 1).select(F.col(f"`{id_col}`").alias("id")).distinct()
    # Labels grow with the documents: ids shuffle, at every size, and mark the slices.
    marks = own.select("slice", "id").join(wanted.hint("merge"), "id").distinct().select(
        "slice", F.lit(LABEL).alias("kind"), "id", F.lit(None).cast("string").alias("text"))
    dealt = own.unionAll(marks).groupBy("slice")

    def send_pairs(key: tuple, rows: pa.Table) -> pa.Table:
        s = Slice(rows)
        return _requests(key[0].as_py(), buckets, s.keys, [s.n0, s.n1])

    def send_words(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        s = Slice(rows)
        s.words()
        totals, first, _ = _answers(answers, PAIRS)
        counts = [s.summed(at, n) for at in (s.w_at, s.c_at) for n in (s.n0, s.n1)]
        # Bigrams above the discount: their tokens and their number make the discounted mass.
        over = [first & (n > discount) for n in totals]
        counts += [s.summed(s.c_at, np.where(x, n, 0)) for x, n in zip(over, totals)] + [s.summed(s.c_at, x) for x in over]
        return _requests(key[0].as_py(), buckets, s.kinds, counts)

    def losses(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        s = Slice(rows)
        s.words()
        seen, _, _ = _answers(answers, PAIRS)
        totals, _, sums = _answers(answers, WORDS)
        base = sums[0] + 2  # the words, the unknown word and the start, as in Vocabulary
        doc, out = np.repeat(np.arange(len(s.lengths), dtype=np.int32), s.lengths), []
        for i in (0, 1):
            word, context, mass, above = (totals[k + i] for k in (0, 2, 4, 6))
            after = np.maximum(context, 1)
            rest = (1 - (mass - discount * above) / after)[s.c_at]
            p = np.maximum(seen[i] - discount, 0) / after[s.c_at] + rest * ((word + 1) / (sums[1 + i] + base))[s.w_at]
            with np.errstate(divide="ignore"):
                each = -np.log(p)
            out.append(np.bincount(doc, each[s.of], len(s.lengths)) / np.maximum(s.lengths, 1))
        none = s.lengths == 0
        return pa.table({"id": s.ids, "n_tokens": s.lengths, "loss1": pa.array(out[1], mask=none), "loss0": pa.array(out[0], mask=none)})

    pairs = dealt.applyInArrow(send_pairs, REQUEST_DDL).groupBy("bucket").applyInArrow(_totals(buckets, PAIRS), ANSWER_DDL)
    words = dealt.cogroup(pairs.groupBy("slice")).applyInArrow(send_words, REQUEST_DDL).groupBy("bucket").applyInArrow(
        _totals(buckets, WORDS), ANSWER_DDL)
    kind = docs.select(ident.alias("id")).schema["id"].dataType.simpleString()
    out = dealt.cogroup(pairs.unionAll(words).groupBy("slice")).applyInArrow(losses, f"id {kind}, n_tokens long, loss1 double, loss0 double")
    return out.select(F.col("id").alias(id_col), "n_tokens", F.col("loss1").alias("loss_target"), F.col("loss0").alias("loss_background"),
                      (F.col("loss1") - F.col("loss0")).alias("score"))
