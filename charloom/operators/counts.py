"""Counting every character context of a corpus.

A corpus row is ``(line_id, text)`` with NFC text.  At each position the
reference counts the next character under every context of length 1..n-1 that
ends right before it.  We first count ONE window string per position (the up to
n-1 characters before it plus the character itself): tasks number the windows of
a slice of lines as integers and send on distinct ones only, Spark sums them, and
only then are the distinct windows exploded into their suffix contexts and summed again.  The number of contexts of a window depends
only on its length, so this is exact, and it explodes distinct windows instead
of every position of the corpus.

``first_seen`` = the smallest (line_id, pos) at which a key occurs keeps the
order in which characters were first seen; it is the tie key of every later
ranking.  It is packed into one decimal(38,0), ``line_id * 2**31 + pos``, so the
aggregations stay hash-based (a struct minimum forces a sort-based aggregate).
``pos`` fits because no string is longer than 2**31, and ``line_id`` may be any
number up to 29 digits: a 64-bit document id and a 31-bit line number (see
``line_key``), negative ids included.  A larger one stops the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import NEWLINES

STEP = 1 << 31
LINE_TYPE = "decimal(29,0)"
KEY_TYPE = "decimal(38,0)"
WINDOW_ROW = f"win string, cnt long, first_seen {KEY_TYPE}"


def _step():
    return F.lit(STEP).cast("decimal(10,0)")


def line_key(doc_id, piece):
    """One ordered number from a 64-bit document id and a line number below 2**31."""
    return (doc_id.cast("decimal(19,0)") * _step() + piece.cast("decimal(10,0)")).cast(LINE_TYPE)


def pack_position(line_id, pos):
    packed = (line_id.cast(LINE_TYPE) * _step() + pos.cast("decimal(10,0)")).cast(KEY_TYPE)
    return F.coalesce(packed, F.raise_error(F.lit("line id out of range for the first_seen key")).cast(KEY_TYPE))


def _split(c):
    low = F.pmod(c, _step())
    return ((c - low) / _step()).cast(LINE_TYPE), low


def unpack_position(col):
    """``struct(line_id, pos)`` from a packed ``first_seen``."""
    line, pos = _split(F.col(col) if isinstance(col, str) else col)
    return F.struct(line.alias("line_id"), pos.cast("long").alias("pos"))


def unpack_line(col):
    """``struct(doc_id, piece)`` from a ``line_key``."""
    doc, piece = _split(F.col(col) if isinstance(col, str) else col)
    return F.struct(doc.cast("long").alias("doc_id"), piece.cast("long").alias("piece"))


# Lines longer than this many code points are cut into chunks of this size, each
# carrying the n-1 characters before it, so no task ever holds the character
# array of a whole multi-megabyte line.
LINE_CHUNK = 8192
# Code points that a task numbers at a time (some 100 bytes each while it does).
SLICE_CHARS = 1 << 20
# Distinct windows that a task holds (32 bytes each) before it sends them on.
HELD_WINDOWS = 2_000_000
SENT_ROWS = 100_000


def line_chunks(corpus: DataFrame, order: int) -> DataFrame:
    """``(key, ov, text)``: the lines cut into chunks; ``key`` is the packed position of a
    chunk, ``ov`` how many characters before it lead ``text``."""
    n1 = order - 1
    chunk = max(LINE_CHUNK, order)
    text = F.col("text")
    # Exact code-point chunks: Java's '.' consumes one code point, (?s) includes
    # line breaks.  Short lines are a single chunk and skip the regex.
    chunks = F.when(F.length(text) > chunk,
                    F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).otherwise(F.array(text))
    x = corpus.where(F.length("text") > 0).select("line_id", F.make_valid_utf8("text").alias("text"))
    x = x.select("line_id", chunks.alias("_chunks"))
    x = x.select("line_id", "_chunks", F.posexplode("_chunks").alias("_c", "_chunk"))
    if n1 > 0:
        prev = F.when(F.col("_c") > 0, F.right(F.element_at("_chunks", F.col("_c")), F.lit(n1))).otherwise(F.lit(""))
    else:
        prev = F.lit("")
    return x.select(pack_position(F.col("line_id"), F.col("_c").cast("long") * chunk).alias("key"),
                    F.length(prev).alias("ov"), F.concat(prev, F.col("_chunk")).alias("text"))


def _halves(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The high and low 64 bits of packed positions (a decimal has 128 in Arrow)."""
    halves = np.frombuffer(keys.buffers()[1], np.int64).reshape(-1, 2)[keys.offset:keys.offset + len(keys)]
    return halves[:, 1], halves[:, 0].astype(np.uint64)


def _spelled(codes: np.ndarray, full: np.ndarray) -> pa.Array:
    """A string for each row of ``codes`` (code points) from those marked in ``full``."""
    width = (1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)) * full
    ends = np.concatenate([[0], np.cumsum(width.sum(axis=1))]).astype(np.int32)
    data = codes[full].astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(ends), pa.py_buffer(data))


class _Windows:
    """The windows of some chunks, in order of their packed position: for each ``at``, its place in
    ``padded`` (all characters, numbered by ``alphabet``, 0 before a line's start), and
    its ``row`` and ``pos`` in the chunk.  No position in a line is 2**31 or more, so adding
    ``pos`` to the low half of a key carries nothing over."""

    def __init__(self, rows: pa.RecordBatch, order: int):
        self.order = order
        hi, lo = _halves(rows.column("key"))
        by_line = np.lexsort((lo, hi))
        hi, lo, ov = hi[by_line], lo[by_line], rows.column("ov").to_numpy()[by_line]
        texts = rows.column("text").take(pa.array(by_line)).to_pylist()
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        row = np.repeat(np.arange(len(texts)), sizes)
        pos = np.arange(len(codes)) - (np.cumsum(sizes) - sizes + ov)[row]
        found = np.zeros(int(codes.max()) + 1, bool)
        found[codes] = True
        self.alphabet = np.concatenate([[0], np.flatnonzero(found)])
        ids = np.cumsum(found)
        self.padded = np.zeros(len(codes) + len(texts) * (order - 1), np.int64)
        at = np.arange(len(codes)) + (row + 1) * (order - 1)
        self.padded[at] = ids[codes]
        keep = np.flatnonzero((pos >= 0) & ~np.isin(codes, [ord(c) for c in NEWLINES]))
        same = (np.diff(hi) == 0) & (np.diff(lo) == 0)
        if same.any():  # repeated line ids
            number = np.concatenate([[0], np.cumsum(~same)])
            keep = keep[np.lexsort((pos[keep], number[row[keep]]))]
        self.at, self.row, self.pos, self._hi, self._lo = at[keep], row[keep], pos[keep], hi, lo

    def _renumbered(self, key: np.ndarray) -> tuple[np.ndarray, int]:
        distinct, key = np.unique(key, return_inverse=True)
        return key, len(distinct).bit_length()

    def keys(self, limit: int) -> np.ndarray:
        """A number of ``limit`` bits at most for each window, equal for equal ones."""
        step = len(self.alphabet).bit_length()
        key, bits = np.zeros(len(self.at), np.int64), 0
        for back in range(self.order - 1, -1, -1):
            if bits + step > limit:
                key, bits = self._renumbered(key)
            key, bits = (key << step) | self.padded[self.at - back], bits + step
        return key if bits <= limit else self._renumbered(key)[0]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The first of each distinct window, and how often it occurs."""
        n = len(self.at)
        low = n.bit_length()
        packed = np.sort((self.keys(63 - low) << low) | np.arange(n))
        start = np.flatnonzero(np.diff(packed >> low, prepend=-1))
        return packed[start] & ((1 << low) - 1), np.diff(start, append=n)

    def codes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code points of windows, and which of them are there."""
        ids = self.padded[self.at[which][:, None] + np.arange(1 - self.order, 1)]
        return self.alphabet[ids], ids > 0

    def place(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.row[which]
        return self._hi[row], self._lo[row] + self.pos[which].astype(np.uint64)


class _Held:
    """The distinct windows that a task has met: ``keys`` (ascending; the code points, each
    numbered from 1 as met, in 63 / order bits), counts and first places."""

    def __init__(self, order: int):
        self.order, self.width = order, 63 // order
        self.number, self.met = np.zeros(0x110000, np.int64), np.zeros(1, np.int64)
        self.clear()

    def clear(self) -> None:
        self.keys, self.cnt, self.hi, self.lo = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))

    def add(self, codes: np.ndarray, full: np.ndarray, cnt: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False, and nothing held, if there are too many characters for the width."""
        here = np.zeros(0x110000, bool)
        here[codes[full]] = True
        new = np.flatnonzero(here & (self.number == 0))
        if len(self.met) + len(new) > 1 << self.width:
            return False
        self.number[new] = np.arange(len(self.met), len(self.met) + len(new))
        self.met = np.concatenate([self.met, new])
        key = np.zeros(len(codes), np.int64)
        for j in range(self.order):
            key = (key << self.width) | (self.number[codes[:, j]] * full[:, j])
        order = np.argsort(key)
        key, cnt, hi, lo = key[order], cnt[order], hi[order], lo[order]
        at = np.searchsorted(self.keys, key)
        old = at < len(self.keys)
        old[old] = self.keys[at[old]] == key[old]
        hit = at[old]
        self.cnt[hit] += cnt[old]
        sooner = (hi[old] < self.hi[hit]) | ((hi[old] == self.hi[hit]) & (lo[old] < self.lo[hit]))
        self.hi[hit[sooner]], self.lo[hit[sooner]] = hi[old][sooner], lo[old][sooner]
        self.keys, self.cnt, self.hi, self.lo = (
            np.insert(have, at[~old], more[~old])
            for have, more in ((self.keys, key), (self.cnt, cnt), (self.hi, hi), (self.lo, lo)))
        return True

    def rows(self) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.keys), SENT_ROWS):
            part = slice(a, a + SENT_ROWS)
            ids = (self.keys[part, None] >> (np.arange(self.order - 1, -1, -1) * self.width)) & ((1 << self.width) - 1)
            yield _counted_rows(self.met[ids], ids > 0, self.cnt[part], self.hi[part], self.lo[part])


def _counted_rows(codes: np.ndarray, full: np.ndarray, cnt: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> pa.RecordBatch:
    halves = np.stack([lo.view(np.int64), hi], axis=1)
    first = pa.Array.from_buffers(pa.decimal128(38, 0), len(halves), [None, pa.py_buffer(np.ascontiguousarray(halves))])
    return pa.RecordBatch.from_arrays([_spelled(codes, full), pa.array(cnt), first], ["win", "cnt", "first_seen"])


def _slices(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[_Windows]:
    """The windows of runs of rows of about ``SLICE_CHARS`` code points."""
    for batch in batches:
        slots = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a and len((windows := _Windows(batch.slice(a, b - a), order)).at):
                yield windows


def position_windows(corpus: DataFrame, order: int) -> DataFrame:
    """G1: one row per (line, position): ``win`` = up to ``order-1`` previous
    characters + the character at the position, ``pos`` 0-based.  Positions whose
    character is a newline are dropped (F9)."""
    if order < 1:
        raise ValueError("order must be >= 1")

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _slices(batches, order):
            everywhere = np.arange(len(w.at))
            yield _counted_rows(*w.codes(everywhere), np.ones(len(w.at), np.int64), *w.place(everywhere))

    rows = line_chunks(corpus, order).mapInArrow(every, WINDOW_ROW)
    at = unpack_position("first_seen")
    return rows.select(at["line_id"].alias("line_id"), at["pos"].alias("pos"), "win")


def window_parts(corpus: DataFrame, order: int) -> DataFrame:
    """``(win, cnt, first_seen)``: the windows of G1, counted by each task: a row for each
    of its distinct windows (more only beyond ``HELD_WINDOWS`` of them, or with too many
    different characters to hold, where each slice is sent on)."""
    if order < 1:
        raise ValueError("order must be >= 1")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(order)
        for w in _slices(batches, order):
            first, cnt = w.distinct()
            row = (*w.codes(first), cnt, *w.place(first))
            if not held.add(*row):
                yield _counted_rows(*row)
            if len(held.keys) >= HELD_WINDOWS:
                yield from held.rows()
                held.clear()
        yield from held.rows()

    return line_chunks(corpus, order).mapInArrow(count, WINDOW_ROW)


def window_counts(corpus: DataFrame, order: int) -> DataFrame:
    """Distinct windows with their count and first position (pre-aggregation)."""
    return window_parts(corpus, order).groupBy("win").agg(F.sum("cnt").alias("cnt"), F.min("first_seen").alias("first_seen"))


def context_char_counts(windows: DataFrame) -> DataFrame:
    """A2 + G2: ``(context, ctx_len, ch, cnt, first_seen)`` for every context length
    up to the window length minus one."""
    wlen = F.length("win")
    lens = F.when(wlen > 1, F.sequence(F.lit(1), wlen - 1)).otherwise(F.array().cast("array<int>"))
    exploded = windows.select(
        F.explode(lens).alias("ctx_len"), "win", "cnt", "first_seen"
    ).select(
        F.substring("win", wlen - F.col("ctx_len"), F.col("ctx_len")).alias("context"),
        "ctx_len",
        F.right("win", F.lit(1)).alias("ch"),
        "cnt",
        "first_seen",
    )
    return exploded.groupBy("context", "ctx_len", "ch").agg(
        F.sum("cnt").alias("cnt"), F.min("first_seen").alias("first_seen"))


def unigram_counts(windows: DataFrame) -> DataFrame:
    """A1: count of every character (position 0 included, newlines excluded)."""
    return windows.groupBy(F.right("win", F.lit(1)).alias("ch")).agg(
        F.sum("cnt").alias("cnt"), F.min("first_seen").alias("first_seen"))


def bigram_types(pairs: DataFrame) -> DataFrame:
    """Distinct (left, ch) pairs whose left character is not a newline."""
    return pairs.where((F.col("ctx_len") == 1) & ~F.col("context").isin(*NEWLINES)).select(
        F.col("context").alias("left"), "ch", "first_seen")


def continuation_counts(pairs: DataFrame) -> DataFrame:
    """A3: number of distinct left neighbours of each character; ``first_seen`` is
    the first position of a valid bigram ending in it."""
    return bigram_types(pairs).groupBy("ch").agg(
        F.count(F.lit(1)).alias("cont"), F.min("first_seen").alias("first_seen"))
