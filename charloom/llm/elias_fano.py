"""Elias-Fano coding of an ordered sequence, with a select structure.

n values of a universe of u keep their low log2(u / n) bits in one bit array; the high
parts become a bit vector in which the i-th one stands at (high part of value i) + i.
That is at most 2 + log2(u / n) bits a value.  ``select`` finds the i-th one from the
nearest of the sampled ones (every ``EVERY``-th, 32 bits each) and so returns any value
without decoding those before it.
"""

from __future__ import annotations

import struct

import numpy as np

EVERY = 512
_HEAD = struct.Struct("<QQBQQ")
_BLOCK = 1 << 16


def _ones(highs: np.ndarray, first_bit: int, last_bit: int) -> np.ndarray:
    """Places of the ones from bit ``first_bit`` up to ``last_bit`` (not included)."""
    start = first_bit // 8
    bits = np.unpackbits(highs[start:(last_bit + 7) // 8], bitorder="little")
    bits[:first_bit - 8 * start] = 0
    return np.flatnonzero(bits[:last_bit - 8 * start]) + 8 * start


class EliasFano:
    def __init__(self, n: int, least: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.least, self.low_bits, self.lows, self.highs, self.samples = n, least, low_bits, lows, highs, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """``values``: ordered 64-bit numbers, repeats allowed."""
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        least = int(values[0])
        up = np.asarray(values, np.int64).view(np.uint64) - np.uint64(least % (1 << 64))
        low_bits = max((int(up[-1]) // n).bit_length() - 1, 0)
        powers = np.arange(low_bits, dtype=np.uint64)
        lows = [np.packbits(((up[k:k + _BLOCK, None] >> powers) & np.uint64(1)).astype(np.uint8), bitorder="little")
                for k in range(0, n, _BLOCK)]
        place = (up >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(place[-1]) + 1, np.uint8)
        bits[place] = 1
        return cls(n, least, low_bits, np.concatenate(lows), np.packbits(bits, bitorder="little"), place[::EVERY].astype(np.uint32))

    def select(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])

    def slice(self, first: int, last: int) -> np.ndarray:
        """Values number ``first`` up to ``last`` (not included), as signed 64-bit numbers."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last, self.n))
        if first == last:
            return np.zeros(0, np.int64)
        k, after = first // EVERY, -(-last // EVERY)
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.highs)
        high = _ones(self.highs, int(self.samples[k]), end)[first - k * EVERY:last - k * EVERY] - np.arange(first, last)
        out = high.astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            lo, hi = first * self.low_bits, last * self.low_bits
            bits = np.unpackbits(self.lows[lo // 8:(hi + 7) // 8], bitorder="little")[lo % 8:][:hi - lo]
            out |= (bits.reshape(-1, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (out + np.uint64(self.least % (1 << 64))).view(np.int64)

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.least % (1 << 64), self.low_bits, len(self.lows), len(self.highs))
        return b"".join((head, self.lows.tobytes(), self.highs.tobytes(), self.samples.astype("<u4").tobytes()))

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, least, low_bits, n_lows, n_highs = _HEAD.unpack_from(data)
        at = _HEAD.size
        lows = np.frombuffer(data, np.uint8, n_lows, at)
        highs = np.frombuffer(data, np.uint8, n_highs, at + n_lows)
        samples = np.frombuffer(data, "<u4", offset=at + n_lows + n_highs)
        return cls(n, least - (1 << 64) if least >> 63 else least, low_bits, lows, highs, samples)
