"""Operator 1, quality rules: a short-circuit cascade of native rules.

Every rule is a Boolean Spark expression over a document.  ``plan_cascade`` times
each rule and counts its rejections on a bounded sample, then orders the rules by
rejections per second, so that a cheap rule that rejects a lot runs first.
``apply_cascade`` evaluates them in that order in one CASE expression: a document
rejected by one rule never reaches the next.  The order changes the cost and which
rule is named first; it never changes the verdict.

Defined results: null or empty text has no words, all counts 0, and fails the base
rule (fewer than 20 words).  Repeated rows are judged each on their own.  Input
columns whose names clash with a result column give way to it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, internal, settled

# Fixed values of the base rule.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects(text, m)`` is true for a document that fails; ``m`` maps the base
    measures to columns."""

    name: str
    rejects: Callable[[Column, dict[str, Column]], Column]


@dataclass(frozen=True)
class RuleCost:
    name: str
    seconds: float
    selectivity: float


def _share(count: Column, total: Column, limit: float) -> Column:
    return count > F.lit(limit) * total


# The method's own rules.  Shares are of words, lines or characters of the text.
RULES: tuple[Rule, ...] = (
    Rule("symbols_per_word", lambda t, m: _share(m["n_symbols"], m["n_words"], 0.1)),
    Rule("mean_word_length", lambda t, m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
    Rule("duplicate_lines", lambda t, m: _share(m["n_dup_lines"], F.size(F.split(t, "\n")), 0.3) & (m["n_dup_lines"] > 2)),
    Rule("exclamations", lambda t, m: _share(F.regexp_count(t, F.lit("!")), m["n_words"], 0.5)),
    Rule("capitals", lambda t, m: _share(F.regexp_count(t, F.lit(r"\p{Lu}")), m["word_chars"], 0.6)),
    Rule("digits", lambda t, m: _share(F.regexp_count(t, F.lit("[0-9]")), m["word_chars"], 0.4)),
    Rule("stutter", lambda t, m: _share(m["n_stutter"], m["n_words"], 0.3)),
)


def _paired(x: Column, n: int) -> Column:
    """Hash of every element together with the one ``n`` places on."""
    rest = F.greatest(F.size(x) - n, F.lit(0))
    return F.zip_with(F.slice(x, 1, rest), F.slice(x, n + 1, rest), lambda a, b: F.xxhash64(a, b))


def _equal_neighbours(x: Column) -> Column:
    """How many elements equal the one after them."""
    rest = F.greatest(F.size(x) - 1, F.lit(0))
    return F.size(F.filter(F.zip_with(F.slice(x, 1, rest), F.slice(x, 2, rest), lambda a, b: a == b), lambda same: same)).cast("long")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the base measures and n_stutter, words equal to the next (long), to every row.

    A repeated word is one inside an 8-word window that occurs twice or more in the
    text.  Windows are compared by a 64-bit hash of their words; texts without two
    equal hashes (nearly all) stop there, the others sort (hash, position) pairs, so
    the work is O(n log n) in one row and no row leaves its partition.
    """
    own = {k: internal(docs, f"_{k}") for k in ("t", "a", "c", "w", "h2", "h4", "h", "s", "p", "l")}
    t, a, c, w, h2, h4, h, s, p, lines = (F.col(v) for v in own.values())
    keep = [c for c in docs.columns if c.lower() not in (*MEASURES, "n_stutter")]
    cols = [F.col(f"`{c}`") for c in keep]
    n = F.size(w)
    stutter = internal(docs, "_e")
    e = F.col(stutter)

    out = docs.select(*cols, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(own["t"]))
    words = F.array_remove(F.split(t, SPACE), "")
    out = out.select(*cols, t, words.alias(own["a"]))
    out = out.select(*cols, t, F.length(F.array_join(a, "")).cast("long").alias(own["c"]),
                     F.transform(a, lambda x: F.xxhash64(x)).alias(own["w"]))
    # Windows of 8 from pairs of 4 from pairs of 2 from pairs of words.  (slice() inside
    # a lambda would copy the whole array for every window.)
    out = out.select(*cols, t, c, w, _equal_neighbours(w).alias(stutter), _paired(w, 1).alias(own["h2"]))
    out = out.select(*cols, t, c, w, e, _paired(h2, 2).alias(own["h4"]))
    out = out.select(*cols, t, c, w, e, F.when(n > WINDOW, _paired(h4, 4))
                     .otherwise(F.array().cast("array<bigint>")).alias(own["h"]))
    keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    out = out.select(*cols, t, c, w, e, F.when(F.size(F.array_distinct(h)) < F.size(h), keyed)
                     .otherwise(F.array().cast("array<struct<x:bigint,i:int>>")).alias(own["s"]))
    twice = F.filter(s, lambda e, j: (F.try_element_at(s, j + 2)["x"] == e["x"]) |
                     F.when(j > 0, F.get(s, j - 1)["x"] == e["x"]).otherwise(F.lit(False)))
    with_word = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(*cols, t, c, w, e, F.sort_array(F.transform(twice, lambda x: x["i"])).alias(own["p"]),
                     with_word.alias(own["l"]))
    covered = F.aggregate(
        F.transform(p, lambda x, j: F.coalesce(F.least(F.lit(WINDOW), F.try_element_at(p, j + 2) - x), F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select(
        *cols,
        settled(n.cast("long")).alias("n_words"),
        c.alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        e.alias("n_stutter"),
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def _rejects(rule: Rule, text_col: str) -> Column:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return F.coalesce(rule.rejects(text, {k: F.col(k) for k in (*MEASURES, "n_stutter")}), F.lit(False))


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                 sample_rows: int = 2000, sample_fraction: float = 0.1, seed: int = 7, longest: int = 20_000,
                 passes: int = 8) -> list[RuleCost]:
    """Cost (seconds over the sample) and selectivity (share rejected) of each rule,
    best rejection per cost first.

    The sample is at most ``sample_rows`` texts of at most ``longest`` code points, taken
    from as few partitions as it needs (no scan of the whole table).  Each rule is timed alone over ``passes``
    passes of it (after one that warms up), less the time of a rule that looks at
    nothing.  An empty sample leaves the rules in their given order.
    """
    text = docs.select(F.col(f"`{text_col}`").alias("text")).where(F.length("text") <= longest)
    rows = [(r["text"],) for r in text.sample(sample_fraction, seed).take(sample_rows)]
    if not rows:
        return [RuleCost(r.name, 0.0, 0.0) for r in rules]
    sample = measure(docs.sparkSession.createDataFrame(rows, "text string")).where(~base_failed()).persist()
    try:
        total = sample.count()
        if total == 0:
            return [RuleCost(r.name, 0.0, 0.0) for r in rules]

        def timed(reject: Column) -> tuple[float, int]:
            hits = sample.agg(F.sum(reject.cast("long"))).first()[0] or 0
            again = sample.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
            began = time.perf_counter()
            again.agg(F.sum(reject.cast("long"))).first()
            return time.perf_counter() - began, hits

        idle, _ = timed(F.length("text") < 0)
        costs = []
        for r in rules:
            seconds, hits = timed(_rejects(r, "text"))
            costs.append(RuleCost(r.name, max(seconds - idle, 1e-4), hits / total))
    finally:
        sample.unpersist()
    return sorted(costs, key=lambda c: (-c.selectivity / c.seconds, c.seconds))


def apply_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                  plan: Sequence[RuleCost] | None = None) -> DataFrame:
    """Append the measures, ``base_failed``, ``kept`` and ``failed_rule`` (the first rule
    of the cascade that rejects, null for a kept document)."""
    plan = plan_cascade(docs, rules, text_col) if plan is None else plan
    by_name = {r.name: r for r in rules}
    out = measure(docs.select(*[F.col(f"`{c}`") for c in docs.columns
                                if c.lower() not in ("base_failed", "kept", "failed_rule")]), text_col)
    verdict = F.when(base_failed(), F.lit("base"))
    for c in plan:
        verdict = verdict.when(_rejects(by_name[c.name], text_col), F.lit(c.name))
    names = [F.col(f"`{c}`") for c in out.columns]
    out = out.select(*names, base_failed().alias("base_failed"), verdict.alias("failed_rule"))
    return out.select(*names, "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")
