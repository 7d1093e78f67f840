"""Operator 12, alignment of two tokenizers over the same bytes.

Every text, with one space in front, is tokenised whole by a byte-level vocabulary (A) and
by a piece vocabulary (B, which adds that space itself).  Byte offsets where tokens of
both end cut them into groups; every A token of a group is linked to every B token of it.

Anchors: a token that begins with a space usually begins a word for both vocabularies.
The ends of the tokens before such tokens are compared, and those that both share split
the batch into windows, mostly one word each.  A window's groups depend on its ids alone,
so they are worked out once and remembered by the window's two id tuples (in their packed
form); when the remembered windows hold ``REMEMBERED`` tokens, those met only once since
the last time are forgotten.

``align`` gives a row per row of the input.  Links are never written one by one: a row
holds each linked id pair once, with its number of links.  ``score_links`` counts, for
each id pair, the rows of the whole table that hold it, and gives each row its sums.  The
pair table meets the rows by a broadcast while it has at most ``BROADCAST_PAIRS`` rows
(24 bytes each) and by a shuffle beyond; pairs are summed per row before they are moved
on.  ``score_links`` reads its input twice, so that should be a written table.

Defined results: texts that are null, empty, or that either vocabulary does not give back
byte for byte (with the space in front) have no tokens: zeros, and null ``groups``.
Strings of special tokens inside a text are plain text.  Repeated rows count as documents
of their own.  Task memory: an Arrow batch with its groups, and the remembered windows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunk_encoder import ChunkEncoder, Memory, encoder_of, gather, woven
from .common import checkpointed

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED = 2_500_000
CACHE = 400_000
BROADCAST_PAIRS = 2_000_000
LARGE = 256  # A x B tokens of a group, beyond which distinct pairs are multiplied
SLICE_BYTES = 1 << 20
_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<struct<pair long, links long>>"


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both have; both in order, without
    repeats."""
    at = np.searchsorted(b, a)
    inside = at < len(b)
    inside[inside] = b[at[inside]] == a[inside]
    return np.flatnonzero(inside), at[inside]


def summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with the sum of its weights."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(weight[order], first)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = message[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(message):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, message[at:at + size]
            at += size


class Pieces:
    """The piece vocabulary: encoding, and each piece's bytes.

    Where the model changes no character, keeps every space, puts one in front, merges
    pieces (BPE) and has none with a space behind another character, nothing is ever merged
    across the space before a word: the ids of a text are those of its words, laid end to
    end (``by_words``)."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.token_bytes = [self._bytes(k) for k in range(self.processor.get_piece_size())]
        self.sizes = np.array([len(b) for b in self.token_bytes], np.int64)
        self.by_words = self._words_stand_alone(model)

    def _bytes(self, k: int) -> bytes:
        piece = self.processor.id_to_piece(k)
        if self.processor.is_byte(k):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _words_stand_alone(self, model: bytes) -> bool:
        # Fixed values of the published model format: trainer 2 (model type 3, BPE is 2),
        # normaliser 3 (character map 2, space in front 3, extra spaces removed 4).
        spec = {n: dict(_fields(v)) for n, v in _fields(model) if n in (2, 3)}
        rules = spec.get(3, {})
        plain = not rules.get(2) and rules.get(3, 1) == 1 and rules.get(4, 1) == 0
        pieces = map(self.processor.id_to_piece, range(len(self.token_bytes)))
        return plain and spec.get(2, {}).get(3, 1) == 2 and not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has."""
        ids = self.processor.encode(texts, num_threads=1)
        n = np.array([len(row) for row in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n


class Aligner:
    """Aligns batches of texts; remembers windows by their packed id tuples."""

    def __init__(self, encoder: ChunkEncoder, pieces: Pieces, cache: int = CACHE):
        self.a, self.b = encoder, pieces
        narrow = max(len(encoder.sizes), len(pieces.sizes)) <= 1 << 16
        self.dtype = np.dtype(np.uint16 if narrow else np.uint32)
        self.words = Memory(self._encode_words, self.dtype, cache)
        self.space_a = np.array([t.startswith(b" ") for t in encoder.token_bytes])
        self.space_b = np.array([t.startswith(b" ") for t in pieces.token_bytes])
        self.spelled = [(np.frombuffer(b"".join(v.token_bytes), np.uint8), np.cumsum(v.sizes) - v.sizes, v.sizes) for v in (encoder, pieces)]
        self.width = len(pieces.sizes)
        self.span = len(encoder.sizes) * self.width  # ids of a pair as one number below this
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}  # windows, numbered as they come
        self.text: list[str] = []
        self.totals = np.zeros((0, 3), np.int64)  # groups, links, distinct pairs of a window
        self.pairs = self.links = np.zeros(0, np.int64)  # of all windows, one after the other
        self.weight = 0
        self.met = np.zeros(0, np.int64)  # times a window was met since the last clearing

    def _clear_out(self) -> None:
        """Keeps the windows met more than once since the last time, if these leave room."""
        kept = np.flatnonzero(self.met > 1)
        keys, text = list(self.number), self.text
        weight = sum(len(keys[k]) for k in kept.tolist()) // 4
        if weight > REMEMBERED * 2 // 3:
            self.forget()
            return
        n = self.totals[:, 2]
        starts = (np.cumsum(n) - n)[kept]
        self.pairs, self.links = gather(self.pairs, starts, n[kept]), gather(self.links, starts, n[kept])
        self.number = {keys[k]: i for i, k in enumerate(kept.tolist())}
        self.text = [text[k] for k in kept.tolist()]
        self.totals, self.weight, self.met = self.totals[kept], weight, np.zeros(len(kept), np.int64)

    def _learn(self, keys: list[bytes]) -> None:
        """Groups, links and text of new windows."""
        packed = np.frombuffer(b"".join(keys), np.uint32).astype(np.int64)
        sizes = np.array([len(k) for k in keys], np.int64) // 4
        starts = np.cumsum(sizes) - sizes
        n_a = packed[starts]
        a, b = gather(packed, starts + 1, n_a), gather(packed, starts + 1 + n_a, sizes - 1 - n_a)
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        cut_a, cut_b = (np.concatenate(([0], at + 1)) for at in common(ends_a, ends_b))
        in_a, in_b = np.diff(cut_a), np.diff(cut_b)
        last = np.searchsorted(cut_a[1:], np.cumsum(n_a), "right")
        n_groups = np.diff(np.concatenate(([0], last)))
        window = np.repeat(np.arange(len(keys)), n_groups)
        # Every A token of a group with every B token; of a large group, each distinct pair once.
        large = in_a * in_b > LARGE
        of_a = np.repeat(np.arange(len(in_a)), in_a)
        times = np.where(large, 0, in_b)[of_a]
        pair = np.repeat(a, times) * self.width + gather(b, cut_b[:-1][of_a], times)
        key = [np.repeat(window[of_a], times) * self.span + pair]
        weight = [np.ones(len(pair), np.int64)]
        for g in np.flatnonzero(large).tolist():
            (x, n), (y, m) = (np.unique(ids[cut[g]:cut[g + 1]], return_counts=True) for ids, cut in ((a, cut_a), (b, cut_b)))
            key.append((window[g] * self.span + x[:, None] * self.width + y).ravel())
            weight.append((n[:, None] * m).ravel())
        key, weight = summed(np.concatenate(key), np.concatenate(weight))
        first = np.cumsum(n_groups) - n_groups
        totals = np.column_stack((n_groups, np.add.reduceat(in_a * in_b, first), np.bincount(key // self.span, minlength=len(keys))))
        self.totals = np.concatenate((self.totals, totals))
        self.pairs = np.concatenate((self.pairs, key % self.span))
        self.links = np.concatenate((self.links, weight))
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        ca, cb = cut_a.tolist(), cut_b.tolist()
        groups = [f"{','.join(text_a[i:j])}|{','.join(text_b[k:m])}" for i, j, k, m in zip(ca, ca[1:], cb, cb[1:])]
        self.text += [";".join(groups[i:j]) for i, j in zip(first.tolist(), last.tolist())]
        self.weight += len(a) + len(b)

    def _verified(self, text: np.ndarray, ends: np.ndarray, ids: np.ndarray, n: np.ndarray, side: int) -> np.ndarray:
        """Which texts (``text`` holds them end to end, up to ``ends``) the tokens give back
        byte for byte."""
        flat, starts, sizes = self.spelled[side]
        last = np.cumsum(n)
        spelled_ends = np.concatenate(([0], np.cumsum(sizes[ids])))
        ours = spelled_ends[last] - spelled_ends[last - n]
        good = ours == np.diff(np.concatenate(([0], ends)))
        back = gather(flat, starts[ids], sizes[ids])
        if good.all():
            wrong = np.flatnonzero(back != text)
            good[np.searchsorted(ends, wrong, "right")] = False
            return good
        from_, to = spelled_ends[last - n], spelled_ends[last]
        for k in np.flatnonzero(good).tolist():
            good[k] = np.array_equal(back[from_[k]:to[k]], text[ends[k] - ours[k]:ends[k]])
        return good

    def batch(self, column: pa.Array) -> dict[str, pa.Array]:
        if self.weight > REMEMBERED:
            self._clear_out()
        n = len(column)
        rows = np.flatnonzero(pc.greater(pc.binary_length(column), 0).fill_null(False).to_numpy(zero_copy_only=False))
        filled = column.take(pa.array(rows))
        joined = np.frombuffer("".join([" " + t for t in filled.to_pylist()]).encode(), np.uint8)
        lengths = pc.binary_length(filled).to_numpy().astype(np.int64) + 1
        a, n_a, b, n_b = self._tokens(filled)
        good = self._verified(joined, np.cumsum(lengths), a, n_a, 0) & self._verified(joined, np.cumsum(lengths), b, n_b, 1)
        if not good.all():
            a = gather(a, (np.cumsum(n_a) - n_a)[good], n_a[good])
            b = gather(b, (np.cumsum(n_b) - n_b)[good], n_b[good])
            rows, n_a, n_b, lengths = rows[good], n_a[good], n_b[good], lengths[good]
        code, per_row = self._windows(a, n_a, b, n_b, np.cumsum(lengths))
        totals = self.totals
        row = np.repeat(np.arange(len(rows)), per_row)
        first = np.cumsum(per_row) - per_row  # a verified text has a window at least
        n_groups, n_links = (np.add.reduceat(totals[code, k], first) if len(rows) else np.zeros(0, np.int64) for k in (0, 1))
        ends = np.concatenate(([0], np.cumsum(per_row))).tolist()
        listed = code.tolist()
        text = [";".join(map(self.text.__getitem__, listed[i:j])) for i, j in zip(ends, ends[1:])]
        at, pair, times = self._pairs_of(row, code, totals[:, 2], len(rows))

        def spread(values: np.ndarray) -> pa.Array:
            out = np.zeros(n, np.int64)
            out[rows] = values
            return pa.array(out)

        strings: list[str | None] = [None] * n
        for k, s in zip(rows.tolist(), text):
            strings[k] = s
        sizes = np.zeros(n, np.int64)
        sizes[rows] = np.diff(at)
        entries = pa.StructArray.from_arrays([pa.array((pair // self.width << 32) + pair % self.width), pa.array(times)], ["pair", "links"])
        return {"n_a": spread(n_a), "n_b": spread(n_b), "n_groups": spread(n_groups), "n_links": spread(n_links),
                "groups": pa.array(strings, pa.string()),
                "pairs": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), entries)}

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Of each word, with a space in front: how many A ids, the A ids, the B ids."""
        size, code = self.dtype.itemsize, self.dtype.char
        ids_a = self.a.encode_words(words)
        if self.a.dtype.itemsize != size:
            ids_a = [np.frombuffer(i, self.a.dtype).astype(self.dtype).tobytes() for i in ids_a]
        ids_b = self.b.processor.encode(words, num_threads=1)
        return [array(code, [len(i) // size]).tobytes() + i + array(code, j).tobytes() for i, j in zip(ids_a, ids_b)]

    def _tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The A and B ids of all texts with a space in front, and how many each text has.
        Where words stand alone for both vocabularies, distinct ones are encoded once and
        remembered; other texts are encoded whole."""
        if not self.b.by_words or not len(texts):
            return *self.a.encode(texts, " "), *self.b.encode(texts.to_pylist())
        words = pc.split_pattern(texts, " ")
        coded = words.flatten().dictionary_encode()
        spelled = coded.dictionary
        n_words = np.diff(words.offsets.to_numpy()).astype(np.int64)
        code = coded.indices.to_numpy()
        # Other spacing, or the pieces' own sign for a space.
        odd = pc.or_(pc.equal(spelled, ""), pc.not_equal(pc.utf8_trim_whitespace(spelled), spelled))
        odd = pc.or_(odd, pc.match_substring(spelled, "▁")).to_numpy(zero_copy_only=False)
        plain = np.ones(len(texts), bool)
        if odd.any():
            plain[np.repeat(np.arange(len(texts)), n_words)[odd[code]]] = False
            code, n_words = code[np.repeat(plain, n_words)], n_words[plain]
        used = np.zeros(len(odd), bool)
        used[code] = True
        code = (np.cumsum(used) - 1)[code]
        packed = self.words.packed(spelled.filter(pa.array(used)).to_pylist())
        flat = np.frombuffer(b"".join(packed), self.dtype).astype(np.int64)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes + 1
        in_a = flat[starts - 1]
        out = []
        ends = np.cumsum(n_words)
        for start, size in ((starts, in_a), (starts + in_a, sizes - 1 - in_a)):
            before = np.concatenate(([0], np.cumsum(size[code])))
            out.append((gather(flat, start[code], size[code]), before[ends] - before[ends - n_words]))
        if not plain.all():
            rest = texts.filter(pa.array(~plain))
            out = [woven(plain, out[0], self.a.encode(rest, " ")), woven(plain, out[1], self.b.encode(rest.to_pylist()))]
        return *out[0], *out[1]

    def _windows(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each window, text after text, and how many windows each text has."""
        if not len(text_ends):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        marked_a, marked_b = self.space_a[a], self.space_b[b]
        marked_a[np.cumsum(n_a)[:-1]] = marked_b[np.cumsum(n_b)[:-1]] = True  # a text begins
        before_a, before_b = np.flatnonzero(marked_a[1:]), np.flatnonzero(marked_b[1:])
        at_a, at_b = common(ends_a[before_a], ends_b[before_b])
        cut_a = np.concatenate(([0], before_a[at_a] + 1, [len(a)]))
        cut_b = np.concatenate(([0], before_b[at_b] + 1, [len(b)]))
        shared = ends_a[cut_a[1:] - 1]
        # A window's key: how many A ids it has, its A ids, its B ids.
        n, in_a, in_b = len(shared), np.diff(cut_a), np.diff(cut_b)
        starts = np.column_stack((np.arange(n), n + cut_a[:-1], n + len(a) + cut_b[:-1])).ravel()
        sizes = np.column_stack((np.ones_like(in_a), in_a, in_b)).ravel()
        packed = gather(np.concatenate((in_a, a, b)).astype(np.uint32), starts, sizes)
        offsets = np.concatenate(([0], np.cumsum(1 + in_a + in_b))) * 4
        keys = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
        known, before = self.number, len(self.number)
        number = np.array([known.setdefault(key, len(known)) for key in keys.dictionary.to_pylist()], np.int64)
        if len(known) > before:
            self._learn(list(islice(known, before, None)))
        per_text = np.diff(np.concatenate(([0], np.searchsorted(shared, text_ends, "right"))))
        code = number[keys.indices.to_numpy()]
        times = np.bincount(code, minlength=len(known))
        times[:len(self.met)] += self.met
        self.met = times
        return code, per_text

    def _pairs_of(self, row: np.ndarray, code: np.ndarray, n_pairs: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's distinct pairs with their links; ``at`` says where a row's begin."""
        if not len(code):
            return np.zeros(n_rows + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        used, times = np.unique(row * len(n_pairs) + code, return_counts=True)
        row, code = used // len(n_pairs), used % len(n_pairs)
        sizes = n_pairs[code]
        starts = (np.cumsum(n_pairs) - n_pairs)[code]
        links = gather(self.links, starts, sizes) * np.repeat(times, sizes)
        key, links = summed(np.repeat(row, sizes) * self.span + gather(self.pairs, starts, sizes), links)
        return np.searchsorted(key // self.span, np.arange(n_rows + 1)), key % self.span, links


_aligners: dict[tuple[int, int], Aligner] = {}


def aligner_of(model_a: bytes, model_b: bytes) -> Aligner:
    """One aligner per Python worker and pair of vocabularies."""
    key = (hash(model_a), hash(model_b))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(encoder_of(model_a, True, CACHE // 8), Pieces(model_b))
    return _aligners[key]


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """One row per row of ``docs``: the id; n_a, n_b, n_groups, n_links; ``groups``, text of the
    form ``a1,a2|b1;a3|b2,b3``; ``pairs``, each linked pair (A id * 2^32 + B id) with its links."""
    context = docs.sparkSession.sparkContext
    with open(vocabulary_a, "rb") as fa, open(vocabulary_b, "rb") as fb:
        model_a, model_b = context.broadcast(fa.read()), context.broadcast(fb.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(model_a.value, model_b.value)
        for batch in batches:
            # A text takes some hundred times its bytes while it is aligned.
            sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64))
            first = 0
            while first < batch.num_rows:
                seen = sizes[first - 1] if first else 0
                last = max(int(np.searchsorted(sizes, seen + SLICE_BYTES, "right")), first + 1)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_pydict({id_col: part.column(0)} | aligner.batch(part.column(1)))
                first = last

    own = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    kind = own.schema[0].dataType.simpleString()
    return own.mapInArrow(run, f"`{id_col}` {kind}, {_ALIGNED}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n_docs, best): rows that hold the pair, and whether no other pair of its A id
    is held by more.  An A id has at most as many pairs as the B vocabulary has ids."""
    n = aligned.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))
    most = F.max("n_docs").over(Window.partitionBy(F.shiftright("pair", 32)))
    return n.select("pair", "n_docs", (F.col("n_docs") == most).alias("best"))


def score_links(aligned: DataFrame, row_col: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Adds n_best (links whose pair is its A id's most frequent) and count_sum (the pairs'
    counts, over all links) to ``aligned``, whose rows ``row_col`` tells apart."""
    counts = checkpointed(pair_counts(aligned))
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    links = aligned.select(row_col, F.inline("pairs")).join(counts, "pair")
    sums = links.groupBy(row_col).agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("n_docs")).alias("count_sum"))
    return aligned.join(sums, row_col, "left").na.fill(0, ["n_best", "count_sum"])
