"""Operator 7, token counts by a linear longest-match automaton.

The vocabulary is a trie.  Greedy longest match cuts the longest piece that starts a
word, then the longest that starts the rest, and so on.  Where the trie has no way on,
a node's failure link leads to the node where matching would stand after the pieces that
greedy matching is bound to cut by then, and the link stores how many those are.  So a
word's number of pieces comes out in one pass over its bytes, without backing up and
without building a piece.

Pieces are byte strings; a word is matched with ``marker`` in front, as a byte-level
vocabulary with a word-start marker wants it.  A word that cannot be cut counts as one
unknown token.  Defined results: null and empty texts have no words and no tokens.
A task keeps the counts of at most ``CACHE`` words at a time.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
MARKER = b" "
CACHE = 400_000
_ROOT, _NONE = 0, -1


class Automaton:
    def __init__(self, pieces: Iterable[bytes], marker: bytes = MARKER):
        self.marker = marker
        self.child: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = _ROOT
            for byte in piece:
                down = self.child[node]
                if byte not in down:
                    down[byte] = len(self.child)
                    self.child.append({})
                    whole.append(False)
                node = down[byte]
            whole[node] = node != _ROOT
        # Breadth first: a link only needs links of shorter strings.
        self.fail = [_NONE] * len(self.child)
        self.popped = [0] * len(self.child)
        todo = deque([_ROOT])
        while todo:
            above = todo.popleft()
            for byte, node in self.child[above].items():
                if whole[node]:
                    self.fail[node], self.popped[node] = _ROOT, 1
                else:
                    at, cut = self.fail[above], self.popped[above]
                    while at != _NONE and byte not in self.child[at]:
                        cut += self.popped[at]
                        at = self.fail[at]
                    if at != _NONE:
                        self.fail[node], self.popped[node] = self.child[at][byte], cut
                todo.append(node)

    def length(self, word: bytes) -> int:
        """Number of pieces of ``marker + word``, -1 if it cannot be cut."""
        child, fail, popped = self.child, self.fail, self.popped
        at = count = 0
        for byte in self.marker + word:
            down = child[at].get(byte)
            while down is None:
                count += popped[at]
                at = fail[at]
                if at < 0:
                    return -1
                down = child[at].get(byte)
            at = down
        while at:
            count += popped[at]
            at = fail[at]
            if at < 0:
                return -1
        return count


def _byte_letters() -> dict[str, int]:
    """The published byte-to-letter table of byte-level vocabularies: printable Latin-1
    letters stand for themselves, the other bytes for letters from U+0100 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def load_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a byte-level vocabulary file, as bytes (read on the driver)."""
    letters = _byte_letters()
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    return [bytes(letters[c] for c in piece) for piece in vocab if all(c in letters for c in piece)]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", automaton: Automaton | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_tokens (an unknown word is one), n_unknown."""
    sent = docs.sparkSession.sparkContext.broadcast(automaton or Automaton(load_pieces()))
    known: dict[bytes, int] = {}

    def batch(texts: pd.Series) -> pd.DataFrame:
        length = sent.value.length
        get = known.get
        out = []
        for text in texts:
            words = (text or "").encode().split()
            tokens = unknown = 0
            for w in words:
                n = get(w)
                if n is None:
                    if len(known) >= CACHE:
                        known.clear()
                    known[w] = n = length(w)
                if n < 0:
                    unknown += 1
                    n = 1
                tokens += n
            out.append((len(words), tokens, unknown))
        return pd.DataFrame(out, columns=["n_words", "n_tokens", "n_unknown"], dtype="int64")

    batch.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    call = F.pandas_udf(batch, "n_words long, n_tokens long, n_unknown long")
    return docs.select(F.col(f"`{id_col}`").alias(id_col), call(F.col(f"`{text_col}`")).alias("c")).select(id_col, "c.*")
