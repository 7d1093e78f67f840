"""The brute-force model of the parity tests, from the formulas of SURVEY 2.5-2.7.

All (context, next character, place) events of a small corpus are listed and sorted;
counts, first places and rankings are read off the sorted list, and a score is the
recursive definition from the longest known context down to the base.
"""

from __future__ import annotations

import unicodedata
from itertools import groupby

BREAKS = "\n\r"
BUILTIN = [" ", ".", ",", "。", "،", "।", "，", "・", "-"]


def nfc(text):
    return unicodedata.normalize("NFC", text)


def tally(events):
    """{key: (number of events, first place)} of (key, place) pairs."""
    return {key: (len(run), run[0][1]) for key, group in groupby(sorted(events), key=lambda e: e[0]) for run in [list(group)]}


class TinyModel:
    def __init__(self, order=6, alpha=1.0, kmax=64, min_count=3, max_contexts=1_000_000, discount=0.75):
        self.order, self.alpha, self.discount, self.kmax = order, alpha, discount, kmax
        self.bounds = (min_count, max_contexts, kmax)
        self.defaults = BUILTIN

    def fit(self, lines):
        places = [(text, (row, at)) for row, text in enumerate(map(nfc, lines)) for at in range(len(text)) if text[at] not in BREAKS]
        self.characters = tally((text[at], (row, at)) for text, (row, at) in places)
        pairs = tally((text[at - 1:at + 1], (row, at)) for text, (row, at) in places if at and text[at - 1] not in BREAKS)
        self.pairs = len(pairs)
        self.followers = tally((pair[1], first) for pair, (_, first) in pairs.items())
        longest = self.order - 1
        grams = tally(((text[at - k:at], text[at]), (row, at)) for text, (row, at) in places for k in range(1, min(longest, at) + 1))
        rows = [(context, ch, n, first) for (context, ch), (n, first) in grams.items()]
        # Contexts first met at one place were met longest first.
        met = {context: min((first, -len(context)) for _, _, _, first in group) for context, group in groupby(rows, key=lambda r: r[0])}
        self.ctx = self._cut(rows, met, *self.bounds)
        ranked = sorted(self.characters, key=lambda c: (-self.characters[c][0], self.characters[c][1]))
        if ranked:
            self.defaults = list(dict.fromkeys([*ranked[:max(self.kmax, 0)], *BUILTIN]))
        return self

    @staticmethod
    def _cut(rows, met, min_count, max_contexts, kmax):
        """rows: (context, character, count, order among the context's ties)."""
        total = {context: sum(r[2] for r in group) for context, group in groupby(rows, key=lambda r: r[0])}
        order = sorted((c for c in total if total[c] >= min_count), key=lambda c: (-total[c], met[c]))
        best = {c: place for place, c in enumerate(order) if max_contexts <= 0 or place < max_contexts}
        kept = sorted((best[c], -n, tie, c, ch) for c, ch, n, tie in rows if c in best)
        out = {}
        for _, same in groupby(kept, key=lambda r: r[0]):
            top = list(same)[:max(kmax, 0)]
            out.update({r[3]: {r[4]: -r[1]} for r in top[:1]})
            for r in top[1:]:
                out[r[3]][r[4]] = -r[1]
        return out

    @classmethod
    def trimmed(cls, table, min_count, max_contexts, kmax):
        """A second cut: ties keep the order of the first."""
        rows = [(c, ch, n, tie) for c, chars in table.items() for tie, (ch, n) in enumerate(chars.items())]
        return cls._cut(rows, {c: place for place, c in enumerate(table)}, min_count, max_contexts, kmax)

    def base(self, ch):
        seen = self.followers if self.pairs else self.characters
        mass = self.pairs if self.pairs else sum(n for n, _ in self.characters.values())
        return (seen[ch][0] + self.alpha) / (mass + self.alpha * max(1, len(seen))) if ch in seen else 0.0

    def share(self, context, ch):
        counts = self.ctx[context]
        return max(counts.get(ch, 0) - self.discount, 0.0) / sum(counts.values())

    def passed(self, context):
        counts = self.ctx[context]
        return (self.discount * len(counts)) / sum(counts.values())

    def seen_part(self, ch, known):
        """Interpolated share of ``ch`` over contexts ``known``, longest first."""
        return self.seen_part(ch, known[1:]) * self.passed(known[0]) + self.share(known[0], ch) if known else 0.0

    def base_part(self, known):
        return self.base_part(known[1:]) * self.passed(known[0]) if known else 1.0

    def predict(self, text, k=3):
        if text is None:
            return "".join(self.defaults)[:k].ljust(k)
        text = nfc(text)
        known = [text[-n:] for n in range(min(self.order - 1, len(text)), 0, -1) if text[-n:] in self.ctx]
        scored = {ch for c in known for ch in self.ctx[c] if self.share(c, ch) > 0 and ch not in BREAKS}
        seen = self.followers if self.pairs else self.characters
        others = sorted(seen.keys() - scored, key=lambda ch: (-self.base(ch), seen[ch][1]))[:k]
        rest = self.base_part(known)
        value = {ch: (self.seen_part(ch, known) + rest * self.base(ch), ch) for ch in [*scored, *others]}
        best = sorted(value, key=value.get, reverse=True)[:k]
        return "".join(dict.fromkeys([*best, *(c for c in self.defaults if c not in BREAKS)]))[:k].ljust(k)
