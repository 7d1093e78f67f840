"""Operator 13, periodic runs of words by maximal-pair enumeration.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) that no neighbouring word extends, of at least ``min_length`` words and
``min_exponent`` periods.  Where a run starts at s and is L long, the suffixes at s and
s + q agree in exactly L - q words and differ in the word to their left: they are a
maximal pair.  The other way round, a maximal pair at distance q that agrees in m words
with m + q >= max(min_length, min_exponent * q) spans a whole run, so nothing has to be
extended; pairs at multiples of the smallest period span the same words, and the
smallest distance of a span is its period.

A batch of texts is handled together.  Words become numbers of their text, suffixes are
sorted by prefix doubling, and neighbours' common lengths are read off the doubling
ranks.  Only suffixes that share ``m0`` words with a neighbour (the least that a run
needs) matter; among these, a group whose closest two positions are further apart than
its longest common length allows holds no run.  For the rest the tree of common-prefix
intervals is built bottom-up with a stack.  A node keeps its positions in order, cut into
classes of neighbours with the same left word; joining two nodes walks through the
smaller one and looks up, in the larger one, the positions near enough, hopping over
those with the same left word.  So work grows with words x log(words) plus the runs.

Memory of a task: the Arrow batch, and per word 4 bytes for each doubling (log2 of the
longest repeat).  Defined results: null, empty and wordless texts have no words, no runs
and an empty collapsed text; each row is judged by itself, so repeated rows repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, with_column

MIN_LENGTH, MIN_EXPONENT = 6, 4
RESULT = "n_words long, runs array<struct<start long, length long, period long>>, collapsed string"


class Node:
    """Positions of an interval of the tree, in order.  ``heads`` holds those whose left
    word differs from that of the position before them: the starts of the classes."""

    __slots__ = ("at", "heads")

    def __init__(self, position: int):
        self.at = [position]
        self.heads = [position]

    def add(self, x: int, left: np.ndarray) -> None:
        i = bisect_left(self.at, x)
        self.at.insert(i, x)
        if i == 0 or left[self.at[i - 1]] != left[x]:
            insort(self.heads, x)
        if i + 1 < len(self.at):
            after = self.at[i + 1]
            k = bisect_left(self.heads, after)
            is_head = k < len(self.heads) and self.heads[k] == after
            if (left[after] != left[x]) != is_head:
                if is_head:
                    del self.heads[k]
                else:
                    self.heads.insert(k, after)

    def others(self, x: int, reach: int, left: np.ndarray) -> Iterator[int]:
        """Positions at most ``reach`` from x whose left word is not that of x."""
        i, end = bisect_left(self.at, x - reach), bisect_right(self.at, x + reach)
        while i < end:
            y = self.at[i]
            if left[y] != left[x]:
                yield y
                i += 1
            else:
                k = bisect_right(self.heads, y)
                if k == len(self.heads):
                    return
                i = bisect_left(self.at, self.heads[k], i + 1)


def maximal_pairs(at: np.ndarray, common: np.ndarray, left: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(first position, distance, common length) of the maximal pairs that are runs, among
    the sorted suffixes ``at`` whose neighbours share ``common`` words."""
    open_nodes: list[tuple[int, Node]] = []
    found: list[tuple[int, int, int]] = []

    def joined(a: Node, b: Node, m: int) -> Node:
        big, small = (a, b) if len(a.at) >= len(b.at) else (b, a)
        reach = m // (min_exponent - 1)
        least = min_length - m
        for x in small.at:
            for y in big.others(x, reach, left):
                q = abs(x - y)
                if q >= least:
                    found.append((min(x, y), q, m))
        for x in small.at:
            big.add(x, left)
        return big

    here = Node(int(at[0]))
    for k, m in enumerate(common.tolist(), 1):
        while open_nodes and open_nodes[-1][0] >= m:
            depth, before = open_nodes.pop()
            here = joined(before, here, depth)
        open_nodes.append((m, here))
        here = Node(int(at[k]))
    while open_nodes:
        depth, before = open_nodes.pop()
        here = joined(before, here, depth)
    return iter(found)


def _sorted_suffixes(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``first`` (numbers from 1) and the common length of neighbours."""
    n = len(first)
    levels = [first.astype(np.int32)]
    width = 1
    while True:
        rank = levels[-1]
        ahead = np.zeros(n, np.int64)
        if width < n:
            ahead[:n - width] = rank[width:]
        pair = rank.astype(np.int64) * (n + 2) + ahead
        order = np.argsort(pair, kind="stable")
        step = np.empty(n, np.int32)
        step[order] = np.cumsum(np.concatenate(([1], (np.diff(pair[order]) != 0).astype(np.int32))))
        if step[order[-1]] == n:
            break
        levels.append(step)
        width *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = same.astype(np.int64) << k
        common += step
        a += step
        b += step
    return order, common


def least_common(min_length: int, min_exponent: int) -> int:
    """Fewest common words of a maximal pair that is a run."""
    return min(max(min_length - q, (min_exponent - 1) * q, 1) for q in range(1, max(min_length, 1) + 1))


def runs_of_batch(texts: list[list[str]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of every word list, by start, then period."""
    m0 = least_common(min_length, min_exponent)
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    flat = [w for t in texts for w in t]
    if not flat:
        return out
    # Arrow, not pandas, numbers the words: pandas ends a string at a null character.
    word = pa.array(flat, pa.string()).dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    # Texts in which m0 words in a row never come back have no run: their windows are
    # numbered two, four, ... words at a time, exactly.
    number = pd.factorize(text * (int(word.max()) + 1) + word)[0].astype(np.int64)
    windows, width = number, 1
    while width < m0:
        step = min(width, m0 - width)
        ahead = np.full(len(windows), -1, np.int64)
        ahead[:-step] = windows[step:]
        windows = pd.factorize(windows * (len(windows) + 1) + ahead + 1)[0].astype(np.int64)
        width += step
    # A window that ends in the next text holds its words, so it never equals one inside.
    again = np.bincount(windows)[windows] > 1
    keep = np.zeros(len(texts), bool)
    keep[text[again]] = True
    if not keep.any():
        return out
    kept = np.flatnonzero(keep)
    mask = keep[text]
    doc = text[mask]
    first = pd.factorize(number[mask], sort=True)[0] + 1
    starts = np.concatenate(([0], np.cumsum(sizes[kept])))
    left = np.concatenate(([-1], first[:-1])).astype(np.int64)
    left[starts[:-1]] = -1 - np.arange(len(kept))  # no word: a class of its own
    order, common = _sorted_suffixes(first)
    deep = common >= m0
    # Groups of neighbours that share m0 words; (group, position) sorted for the gaps.
    edge = np.diff(np.concatenate(([0], deep.astype(np.int8), [0])))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begins):
        return out
    lens = ends - begins + 1
    group = np.repeat(np.arange(len(begins)), lens)
    inside = np.repeat(begins - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(len(group))
    place = order[inside]
    sort = np.lexsort((place, group))
    gaps = np.diff(place[sort])
    gaps[np.diff(group[sort]) != 0] = len(order)
    gap_from = np.concatenate(([0], np.cumsum(lens)[:-1]))
    least_gap = np.minimum.reduceat(np.concatenate((gaps, [len(order)])), gap_from)
    most = np.maximum.reduceat(common, np.ravel(np.column_stack((begins, ends)))[: None if ends[-1] < len(common) else -1])[::2]
    spans: dict[tuple[int, int], int] = {}
    for g in np.flatnonzero(least_gap <= most // (min_exponent - 1)):
        b, e = begins[g], ends[g]
        for x, q, m in maximal_pairs(order[b:e + 1], common[b:e], left, min_length, min_exponent):
            span = (x, q + m)
            if q < spans.get(span, q + 1):
                spans[span] = q
    for (x, length), q in sorted(spans.items(), key=lambda s: (s[0][0], s[1])):
        t = doc[x]
        base = starts[np.searchsorted(kept, t)]
        out[t].append((int(x - base), length, q))
    return out


def collapse_words(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that a run holds after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    if not runs:
        return " ".join(words)
    return " ".join([w for w, g in zip(words, np.cumsum(gone).tolist()) if not g])


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
              result: str = "found") -> DataFrame:
    """Adds the struct column ``result`` to every row: n_words, runs (start, length, period;
    by start, then period) and collapsed, the kept words joined by one space.  An input
    column of that name gives way."""
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")
    one = re.compile(WORD)

    def batch(texts: pd.Series) -> pd.DataFrame:
        words = [one.findall(t) if t else [] for t in texts]
        runs = runs_of_batch(words, min_length, min_exponent)
        return pd.DataFrame({
            "n_words": [len(w) for w in words],
            "runs": [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs],
            "collapsed": [collapse_words(w, rs) for w, rs in zip(words, runs)],
        })

    batch.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return with_column(docs, result, F.pandas_udf(batch, RESULT)(F.col(f"`{text_col}`")))
