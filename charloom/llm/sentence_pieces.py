"""Operator 9, SentencePiece encoding by sampling, and lossless decoding.

A text's spaces become the piece marker and one marker goes in front.  No piece reaches
from a letter into a following marker, so the piece lattice falls into independent
segments (a run of markers and the word after it).  For every distinct segment of a
slice of the input, forward filtering gives the probability of each last piece at each
position; then every occurrence is sampled backwards with random numbers drawn from the
row's key, the segment's place in the text and the position.  The same key and text give
the same pieces whatever the partitioning, batch or retry.

All segments of a slice advance together: they are laid out column by column (character
j of all segments that have one, longest segments first), so that every step of the
vocabulary trie, of the filter and of the sampler is one operation on whole columns.

A piece weighs 1 / (2.7 + rank) ** alpha by its rank in the vocabulary, since a merge-
based model file holds ranks instead of log-probabilities; with ``weights="score"`` it
weighs exp(alpha * score), as a unigram model needs.  A character that has no piece
becomes its UTF-8 bytes, and so does a marker that stands in the text itself: decoding
gives back every text exactly.

Memory: a slice is about ``SLICE`` characters of at most ``ROWS`` rows; long texts are cut
between segments.  Only
one segment longer than that (a word without a space) is held whole.  Defined results:
null text has null pieces; empty text has none; null keys seed like a value of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import internal

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 1 << 17
ROWS = 500
MARK = "▁"
# Stands for a marker of the text itself; valid text never holds a lone surrogate.
_OWN_MARK = "\ud800"
_SEGMENT = re.compile(MARK + "+[^" + MARK + "]*")
_EMPTY = -1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal, near inputs unrelated numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Vocabulary:
    """Piece strings by id, weights, byte pieces; and the trie as an open hash table from
    (node, character class) to node."""

    pieces: list[str]
    weights: np.ndarray
    byte_ids: np.ndarray  # id of each byte's piece
    raw: list[bytes]  # what each id decodes to

    def __post_init__(self) -> None:
        special = set(self.byte_ids.tolist()) | {i for i, r in enumerate(self.raw) if not r}
        usable = [(p, i) for i, p in enumerate(self.pieces) if i not in special]
        self.longest = max((len(p) for p, _ in usable), default=1)
        letters = sorted({c for p, _ in usable for c in p})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.base = len(letters) + 1
        edges: dict[int, int] = {}
        ids = [_EMPTY]
        for p, i in usable:
            node = 0
            for c in p:
                key = node * self.base + int(self.letter[ord(c)])
                if key not in edges:
                    edges[key] = len(ids)
                    ids.append(_EMPTY)
                node = edges[key]
            ids[node] = i
        self.piece_at = np.array(ids, np.int32)
        self.shift = np.uint64(64 - max(len(edges) * 4, 8).bit_length())
        self.keys = np.full((1 << int(64 - self.shift)) + 64, _EMPTY, np.int64)
        self.nodes = np.zeros(len(self.keys), np.int32)
        for key, node in edges.items():
            h = int(self._slot(np.array([key]))[0])
            while self.keys[h] != _EMPTY:
                h += 1
            self.keys[h], self.nodes[h] = key, node

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def child(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) * self.base + letter
        slot = self._slot(key)
        got = self.keys[slot]
        out = np.where(got == key, self.nodes[slot], _EMPTY)
        again = np.flatnonzero((got != key) & (got != _EMPTY))
        while len(again):
            slot[again] += 1
            got = self.keys[slot[again]]
            hit = got == key[again]
            out[again[hit]] = self.nodes[slot[again[hit]]]
            again = again[~hit & (got != _EMPTY)]
        return out


def load_vocabulary(path: str = MODEL, alpha: float = 1.0, weights: str = "rank") -> Vocabulary:
    """Read a model file on the driver; tasks get it as a broadcast."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    kind = ["byte" if model.is_byte(i) else "none" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            else "piece" for i in range(n)]
    byte_ids = np.zeros(256, np.int64)
    for i, k in enumerate(kind):
        if k == "byte":
            byte_ids[int(pieces[i][3:5], 16)] = i
    if weights == "rank":
        first = min((i for i, k in enumerate(kind) if k == "piece"), default=0)
        w = np.array([1 / (2.7 + max(i - first, 0)) for i in range(n)]) ** alpha
    else:
        w = np.exp(alpha * np.array([model.get_score(i) for i in range(n)]))
    raw = [bytes([int(p[3:5], 16)]) if k == "byte" else p.replace(MARK, " ").encode() if k == "piece" else b""
           for p, k in zip(pieces, kind)]
    return Vocabulary(pieces, w, byte_ids, raw)


class Lattice:
    """Forward-filtered lattices of distinct segments."""

    def __init__(self, segments: list[str], vocab: Vocabulary):
        size = np.array([len(s) for s in segments])
        order = np.argsort(-size, kind="stable")
        self.rank = np.empty(len(size), np.int64)
        self.rank[order] = np.arange(len(size))
        self.size = size
        size = size[order]
        longest = int(size[0])
        # Segments that have a character j, and where column j starts.
        active = np.searchsorted(-size, -np.arange(longest), side="left")
        self.start = np.concatenate([[0], np.cumsum(active)])
        flat = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = (np.cumsum(self.size) - self.size)[order]
        self.chars = np.concatenate([flat[begin[:k] + j] for j, k in enumerate(active)])
        total = len(self.chars)
        width = min(vocab.longest, longest)
        self.choice = np.zeros((total, width), np.float32)
        self.piece = np.full((total, width), _EMPTY, np.int32)

        letter = vocab.letter[self.chars]
        column = np.repeat(np.arange(longest), active)
        row = np.arange(total) - np.repeat(self.start[:-1], active)
        node = np.zeros(total, np.int32)
        for k in range(width):
            # (column, row, node): starts whose next k characters are on the trie.
            inside = column + k < size[row]
            column, row, node = column[inside], row[inside], node[inside]
            end = self.start[column + k] + row
            node = vocab.child(node, letter[end])
            on = node != _EMPTY
            column, row, node, end = column[on], row[on], node[on], end[on]
            found = vocab.piece_at[node]
            has = found != _EMPTY
            self.piece[end[has], k] = found[has]
            self.choice[end[has], k] = vocab.weights[found[has]]
        lone = self.choice[:, 0] == 0
        self.choice[lone, 0] = vocab.weights.min()
        self._filter(active, width)

    def _filter(self, active: np.ndarray, width: int) -> None:
        """Turn weights into cumulative probabilities of the last piece's length.  ``past``
        holds the sums over the last prefixes relative to the newest one, so that nothing
        under- or overflows however long the segment is."""
        past: list[np.ndarray] = [np.ones(active[0])]
        for j, k in enumerate(active):
            col = slice(self.start[j], self.start[j] + k)
            n = len(past)
            t = self.choice[col, :n] * np.stack([p[:k] for p in past], axis=1)
            sums = np.cumsum(t, axis=1)
            total = sums[:, -1:]
            self.choice[col, :n] = sums / total
            self.choice[col, n - 1:] = 1.0
            total = total[:, 0]
            past = [np.ones(k)] + [p[:k] / total for p in past[:width - 1]]

    def sample(self, which: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling of occurrences ``which`` (indices of segments) with one seed
        each: (pieces of all in order, number of pieces of each).  A character without a
        piece is -2 less its code point."""
        rank = self.rank[which]
        at = self.size[which].copy()
        live = np.arange(len(which))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        while len(live):
            end = self.start[at[live] - 1] + rank[live]
            draw = _mix(seed[live] + at[live].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
            u = (draw >> np.uint64(40)).astype(np.float32) * np.float32(2.0 ** -24)
            k = (self.choice[end] <= u[:, None]).sum(axis=1)
            got = self.piece[end, k].astype(np.int64)
            got = np.where(got == _EMPTY, -2 - self.chars[end].astype(np.int64), got)
            steps.append((live, got))
            at[live] -= k + 1
            live = live[at[live] > 0]
        count = np.zeros(len(which), np.int64)
        for who, _ in steps:
            count[who] += 1
        stop = np.cumsum(count)
        out = np.empty(int(stop[-1]) if len(stop) else 0, np.int64)
        for t, (who, got) in enumerate(steps):
            out[stop[who] - 1 - t] = got
        return out, count


def _with_bytes(pieces: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by byte pieces; also how many each became."""
    width = np.ones(len(pieces), np.int64)
    bare = np.flatnonzero(pieces < 0)
    if not len(bare):
        return pieces, width
    code = -2 - pieces[bare]
    known = {int(c): vocab.byte_ids[list((MARK if c == ord(_OWN_MARK) else chr(c)).encode())] for c in np.unique(code)}
    width[bare] = [len(known[int(c)]) for c in code]
    out = np.repeat(pieces, width)
    begin = np.cumsum(width) - width
    for b, c in zip(begin[bare].tolist(), code.tolist()):
        ids = known[c]
        out[b:b + len(ids)] = ids
    return out, width


def encode_batch(texts: list[str | None], keys: np.ndarray, vocab: Vocabulary) -> list[np.ndarray | None]:
    """Sampled piece ids of every text; ``keys``: one 64-bit seed a row."""
    parts: list[list[np.ndarray] | None] = [None if t is None else [] for t in texts]
    known: dict[str, int] = {}
    which: list[int] = []
    owners: list[tuple[int, int, int]] = []  # row, first segment's place in the text, segments
    held = 0

    def flush() -> None:
        nonlocal held
        if which:
            n = np.array([o[2] for o in owners])
            row = np.repeat([o[0] for o in owners], n)
            place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat([o[1] for o in owners], n)
            seed = _mix(keys[row].astype(np.uint64) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            pieces, count = Lattice(list(known), vocab).sample(np.array(which), seed)
            ids, width = _with_bytes(pieces, vocab)
            edge = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(count)])]
            last = np.cumsum(n)
            for (r, _, k), stop in zip(owners, last):
                parts[r].append(ids[edge[stop - k]:edge[stop]].astype(np.int32))
        known.clear()
        which.clear()
        owners.clear()
        held = 0

    for r, text in enumerate(texts):
        if not text:
            continue
        place = done = 0
        for m in _SEGMENT.finditer(MARK + text.replace(MARK, _OWN_MARK).replace(" ", MARK)):
            s = m[0]
            which.append(known.setdefault(s, len(known)))
            place += 1
            held += len(s)
            if held >= SLICE:
                owners.append((r, done, place - done))
                done = place
                flush()
        if place > done:
            owners.append((r, done, place - done))
    flush()
    none = np.zeros(0, np.int32)
    return [None if p is None else p[0] if len(p) == 1 else np.concatenate(p) if p else none for p in parts]


def decode_ids(ids, vocab_raw: list[bytes]) -> str:
    return b"".join(map(vocab_raw.__getitem__, ids))[1:].decode("utf-8", "replace")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "pieces",
           vocab: Vocabulary | None = None, seed: int = 0, lossless: str | None = None) -> DataFrame:
    """``docs`` with the sampled piece ids of every text.  With ``lossless``, a Boolean
    column of that name tells whether decoding the pieces gave the text back.  Input
    columns of these names give way."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab or load_vocabulary())
    told = [lossless] if lossless else []
    gone = {c.lower() for c in [out, *told]}
    kept = [f for f in docs.schema.fields if f.name.lower() not in gone]
    names = [f.name for f in kept]
    if text_col not in names:
        raise ValueError(f"{text_col} is the name of a result column")
    k, key = internal(docs, "_key"), F.col(f"`{id_col}`")
    rows = docs.select(*[F.col(f"`{n}`") for n in names],
                       F.xxhash64(F.lit(seed), key.isNull(), key).alias(k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = sent.value
        for batch in _small(batches):
            texts = batch.column(text_col).to_pylist()
            ids = encode_batch(texts, batch.column(k).to_numpy(), vocab)
            columns = [batch.column(n) for n in names] + [_lists(ids)]
            if lossless:
                same = [i is None or decode_ids(i.tolist(), vocab.raw) == x for x, i in zip(texts, ids)]
                columns.append(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names + [out] + told)

    schema = T.StructType(kept + [T.StructField(out, T.ArrayType(T.IntegerType()))]
                          + [T.StructField(c, T.BooleanType()) for c in told])
    return rows.mapInArrow(run, schema)


def decode(docs: DataFrame, pieces: str = "pieces", out: str = "decoded", vocab: Vocabulary | None = None) -> DataFrame:
    """``docs`` with the text of every piece sequence (an input column named ``out`` gives
    way)."""
    sent = docs.sparkSession.sparkContext.broadcast((vocab or load_vocabulary()).raw)
    kept = [f for f in docs.schema.fields if f.name.lower() != out.lower()]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = sent.value
        for batch in _small(batches):
            texts = [None if i is None else decode_ids(i, raw) for i in batch.column(pieces).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(texts, pa.string())], names + [out])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(
        run, T.StructType(kept + [T.StructField(out, T.StringType())]))


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    size = [0 if i is None else len(i) for i in ids]
    flat = np.concatenate([i for i in ids if i is not None] + [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat, pa.int32()),
                                    mask=pa.array([i is None for i in ids], pa.bool_()))
