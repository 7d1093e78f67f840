"""Whole-text encoding by a byte-level tokenizer, with a bounded memory of text chunks.

A byte-level pre-tokenizer starts a new pre-token wherever white space follows something
else, and what comes before never changes how the rest is cut.  So a text is cut into
chunks (white space and what follows up to the next); the chunks of a batch that are not
remembered are joined and encoded by the tokenizers library in one call, and their ids,
laid end to end, are those of the whole text (a test compares the two over all code
points).  Texts whose only white space is single spaces and line feeds are cut and their
chunks numbered by Arrow; others by a regular expression.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .token_counts import _byte_letters

CACHE = 400_000
LONGEST_KEPT = 64
# The Unicode white space characters, as the pre-tokenizer's patterns see them.
WHITE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_WHITE = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))
# What stands before a word that Arrow cut out: nothing, a space, a line feed.
_BEFORE = ("", " ", "\n")


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Memory:
    """The packed ids of chunks, in two tables of at most ``cache`` chunks: when the newer
    one is full it becomes the older one, and chunks met again move back to the newer."""

    def __init__(self, encode_new, dtype: np.dtype, cache: int):
        self.encode_new, self.dtype, self.cache = encode_new, dtype, cache
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def packed(self, chunks: list[str]) -> list[bytes]:
        newer, older = self.newer, self.older
        out = list(map(newer.get, chunks))
        missing = []
        for k in [k for k, packed in enumerate(out) if packed is None]:
            chunk = chunks[k]
            packed = older.get(chunk)
            if packed is None:
                missing.append(k)
            else:
                newer[chunk] = out[k] = packed
        if missing:
            fresh = self.encode_new([chunks[k] for k in missing])
            for k, packed in zip(missing, fresh):
                out[k] = packed
                if len(chunks[k]) <= LONGEST_KEPT:
                    newer[chunks[k]] = packed
        if len(newer) > self.cache:
            self.newer, self.older = {}, newer
        return out

    def ids(self, chunks: list[str], code: np.ndarray, n_chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the distinct ``chunks`` numbered ``code``, and how many each text has."""
        coded = self.packed(chunks)
        flat = np.frombuffer(b"".join(coded), self.dtype)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // self.dtype.itemsize
        per_chunk = sizes[code]
        before = np.concatenate(([0], np.cumsum(per_chunk)))
        ends = np.cumsum(n_chunks)
        return gather(flat, (np.cumsum(sizes) - sizes)[code], per_chunk), before[ends] - before[ends - n_chunks]


def woven(plain: np.ndarray, first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of all texts from those of the ``plain`` ones and of the others."""
    counts, starts = np.zeros(len(plain), np.int64), np.zeros(len(plain), np.int64)
    counts[plain], counts[~plain] = first[1], second[1]
    starts[plain], starts[~plain] = np.cumsum(first[1]) - first[1], len(first[0]) + np.cumsum(second[1]) - second[1]
    return gather(np.concatenate((first[0], second[0])), starts, counts), counts


class ChunkEncoder:
    """Encodes batches of texts with the tokenizer in ``model`` (the bytes of its file)."""

    def __init__(self, model: bytes, plain_specials: bool = False, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(model)
        self.tokenizer.encode_special_tokens = plain_specials
        self.token_bytes = self._token_bytes()
        self.sizes = np.array([len(b) for b in self.token_bytes], np.int64)
        self.dtype = np.dtype("<u2" if len(self.sizes) <= 1 << 16 else "<u4")
        # Words that follow a space are remembered without it, apart from other chunks.
        self.memory = Memory(self.encode_words, self.dtype, cache)
        self.others = Memory(self._encode_new, self.dtype, cache // 4)

    def _token_bytes(self) -> list[bytes]:
        letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        out = [b""] * (1 + max(vocabulary.values()))
        for piece, k in vocabulary.items():
            out[k] = piece.encode() if k in added else bytes(letters[c] for c in piece)
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The packed ids of each word with a space in front."""
        return self._encode_joined([" " + w for w in words])

    def _encode_joined(self, chunks: list[str]) -> list[bytes]:
        """Chunks with white space in front and none at the end, encoded end to end."""
        joined = "".join(chunks)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.cumsum(self.sizes[ids])
        sizes = map(len, chunks) if joined.isascii() else [len(c.encode()) for c in chunks]
        wanted = np.cumsum(np.fromiter(sizes, np.int64, len(chunks)))
        cuts = np.searchsorted(ends, wanted, "right")
        if len(wanted) and not np.array_equal(ends[cuts - 1], wanted):
            raise ValueError("the tokenizer's tokens do not end where white space begins")
        raw = ids.tobytes()
        cuts = [0, *(cuts * self.dtype.itemsize).tolist()]
        return [raw[i:j] for i, j in zip(cuts, cuts[1:])]

    def _encode_new(self, chunks: list[str]) -> list[bytes]:
        apart = [not (c[0] in _WHITE and c[-1] not in _WHITE) for c in chunks]
        joined = iter(self._encode_joined([c for c, x in zip(chunks, apart) if not x]))
        single = iter(self.tokenizer.encode_batch_fast([c for c, x in zip(chunks, apart) if x], add_special_tokens=False))
        return [np.array(next(single).ids, self.dtype).tobytes() if x else next(joined) for x in apart]

    def _by_words(self, texts: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and counts of the texts that Arrow can cut, and which those are."""
        lines = pc.split_pattern(texts, "\n")
        words = pc.split_pattern(lines.flatten(), " ")
        coded = words.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        line_starts = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        text_starts = line_starts[lines.offsets.to_numpy() - lines.offsets[0].as_py()]
        n_words = np.diff(text_starts)
        # Words are cut at single spaces and line feeds: an empty one, or one with white
        # space at an end, stands for other spacing.
        odd = pc.or_(pc.equal(coded.dictionary, ""), pc.not_equal(pc.utf8_trim_whitespace(coded.dictionary), coded.dictionary))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = np.ones(len(texts), bool)
        if odd.any():
            plain[np.repeat(np.arange(len(texts)), n_words)[odd[code]]] = False
        # Words that follow no space are chunks of their own: few, one a line.
        first = line_starts[:-1] if not lead else np.setdiff1d(line_starts[:-1], text_starts[:-1])
        kept = np.repeat(plain, n_words)
        first = first[kept[first]]
        kind = np.where(np.isin(first, text_starts[:-1]), 0, 2)
        key, at = np.unique(code[first] * len(_BEFORE) + kind, return_inverse=True)
        spelled = coded.dictionary
        heads = [_BEFORE[k % len(_BEFORE)] + w for k, w in zip(key.tolist(), spelled.take(pa.array(key // len(_BEFORE))).to_pylist())]
        head_ids = self.others.ids(heads, np.arange(len(heads)), np.ones(len(heads), np.int64))
        code[first] = len(spelled) + at
        code = code[kept]
        used = np.zeros(len(spelled) + len(heads), bool)
        used[code] = True
        mine = np.flatnonzero(used[:len(spelled)])
        sizes, starts = np.zeros(len(used), np.int64), np.zeros(len(used), np.int64)
        flat, n = self.memory.ids(spelled.take(pa.array(mine)).to_pylist(), np.arange(len(mine)), np.ones(len(mine), np.int64))
        sizes[mine], starts[mine] = n, np.cumsum(n) - n
        sizes[len(spelled):], starts[len(spelled):] = head_ids[1], len(flat) + np.cumsum(head_ids[1]) - head_ids[1]
        per_word = sizes[code]
        before = np.concatenate(([0], np.cumsum(per_word)))
        ends = np.cumsum(n_words[plain])
        ids = gather(np.concatenate((flat, head_ids[0])), starts[code], per_word)
        return ids, before[ends] - before[ends - n_words[plain]], plain

    def encode(self, texts: pa.Array, lead: str = "") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (without nulls), one text after the other, and how many each
        has; ``lead`` ("" or a space) is put in front of every text."""
        ids, n, plain = self._by_words(texts, lead)
        if plain.all():
            return ids, n
        chunks = [_CHUNK.findall(lead + t) for t in texts.filter(pa.array(~plain)).to_pylist()]
        numbered = pa.array([c for cs in chunks for c in cs], pa.string()).dictionary_encode()
        others = self.others.ids(numbered.dictionary.to_pylist(), numbered.indices.to_numpy(), np.array([len(c) for c in chunks], np.int64))
        return woven(plain, (ids, n), others)


_encoders: dict[tuple[int, bool], ChunkEncoder] = {}


def encoder_of(model: bytes, plain_specials: bool = False, cache: int = CACHE) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary (a worker outlives its tasks)."""
    key = (hash(model), plain_specials)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ChunkEncoder(model, plain_specials, cache)
    return _encoders[key]
