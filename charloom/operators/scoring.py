"""Probability tables.

Scores are never stored as a table of floats per grid point.  A model keeps
counts; the discount D and the smoothing alpha enter as columns of the fold in
``predict``, so one table serves every (D, alpha).  The float operations are
done in the reference's order:

* base      b(c) = (bc + alpha) / (Tb + alpha * Vb)   (M1 when bigrams exist,
              bc = continuation count, Tb = bigram types, Vb = characters with a
              continuation count; M2 otherwise, bc = unigram count, Tb = corpus
              characters, Vb = unigram vocabulary)
* level     d(c) = max(cnt - D, 0) / total, dropped when 0               (M3)
* weight    lambda = (D * n_types) / total                               (M4)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import NEWLINES

# A character is one code point, so a table keyed by one character has at most
# this many rows: the proven bound that lets us broadcast base tables.
BROADCAST_VOCAB_LIMIT = 250_000


@dataclass(frozen=True)
class BaseStats:
    """Scalars of the base distribution."""
    use_continuation: bool
    tb: int  # T (bigram types) or corpus characters
    vb: int  # vocabulary of the base table, at least 1

    def denominator(self, alpha: float) -> float:
        # Same Python float arithmetic as the reference: int + float * int.
        return self.tb + alpha * self.vb


def base_counts(unigram: DataFrame, continuation: DataFrame, stats: BaseStats) -> DataFrame:
    """``(ch, bc, first_seen)``: the counts behind the base distribution."""
    if stats.use_continuation:
        src = continuation.select("ch", F.col("cont").alias("bc"), "first_seen")
    else:
        src = unigram.select("ch", F.col("cnt").alias("bc"), "first_seen")
    return src.where(~F.col("ch").isin(*NEWLINES))


def base_score(bc: Column, alpha: Column | float, denominator: Column | float) -> Column:
    """b = (bc + alpha) / denominator, 0 for a character outside the base table."""
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    d = denominator if isinstance(denominator, Column) else F.lit(float(denominator))
    return F.when(bc.isNull(), F.lit(0.0)).otherwise((bc.cast("double") + a) / d)


def base_table(base: DataFrame, alpha: float, stats: BaseStats) -> DataFrame:
    """M1/M2: ``(ch, b, first_seen)``."""
    return base.select("ch", base_score(F.col("bc"), alpha, stats.denominator(alpha)).alias("b"),
                       "first_seen")


def base_ranking_prefix(base: DataFrame, alpha: float, stats: BaseStats, length: int) -> list[tuple[str, int]]:
    """The first ``length`` characters by (b desc, first appearance).

    Bounded by ``length`` (k plus the largest number of characters a prediction
    can score), so collecting it is safe; it becomes a literal in the plan."""
    if length <= 0:
        return []
    ranked = base.select("ch", "bc", "first_seen", base_score(F.col("bc"), alpha, stats.denominator(alpha)).alias("b"))
    rows = ranked.orderBy(F.col("b").desc(), F.col("first_seen").asc()).limit(length).collect()
    return [(r["ch"], int(r["bc"])) for r in rows]


def levels(context_chars: DataFrame, base: DataFrame, keys: Sequence[str] = (),
           vocab_size: int | None = None, extra_cols: Sequence[str] = ()) -> DataFrame:
    """Per context the counts needed by M3/M4 and the base count of each of its
    characters: ``(keys..., context, ctx_len, total, n_types, ents)`` with
    ``ents: array<struct<ch, cnt, bc>>``.  ``total`` and ``n_types`` are taken
    after L7, as in the reference."""
    b = base.select("ch", "bc")
    if vocab_size is not None and vocab_size <= BROADCAST_VOCAB_LIMIT:
        b = F.broadcast(b)
    joined = context_chars.join(b, "ch", "left")
    extra = [F.max(c).alias(c) for c in extra_cols]  # constant per context
    return joined.groupBy(*keys, "context", "ctx_len").agg(
        F.sum("cnt").alias("total"),
        F.count(F.lit(1)).alias("n_types"),
        F.collect_list(F.struct("ch", "cnt", "bc")).alias("ents"),
        *extra,
    )


def level_rows(levels_df: DataFrame, discount: float) -> DataFrame:
    """M3 + M4 in long form: ``(context, lambda, ch, d)``, zero entries dropped."""
    D = F.lit(float(discount))
    lam = (D * F.col("n_types").cast("double")) / F.col("total").cast("double")
    ex = levels_df.select("context", lam.alias("lambda"), "total", F.explode("ents").alias("e"))
    d = F.greatest(F.col("e.cnt").cast("double") - D, F.lit(0.0)) / F.col("total").cast("double")
    out = ex.select("context", "lambda", F.col("e.ch").alias("ch"), d.alias("d"))
    return out.where((F.col("d") > 0) & ~F.col("ch").isin(*NEWLINES))
