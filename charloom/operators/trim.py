"""Pruning context tables (A5, A6, L6, L7 -> P4).

Works on a long-form table ``(keys..., context, ctx_len, ch, cnt, first_seen[,
ctx_rank, char_rank])``.  ``keys`` name a model inside a table holding several
models (the grid search trims 36 models in one job); an empty ``keys`` means one
model.

Ties follow the reference's insertion order (SURVEY 2.9-b, d):
* first trim of raw counts: contexts by (total desc, first_seen, ctx_len desc),
  next characters by (cnt desc, first_seen);
* trim of an already trimmed table: contexts by (total desc, ctx_rank), next
  characters by (cnt desc, char_rank).

L6 (keep the ``max_contexts`` most frequent contexts) never sorts everything
through one task: a per-model histogram of totals (one row per distinct total)
gives the smallest total that can still make the cut, everything below it is
dropped, and only the survivors are ranked with the distributed ``ordinal``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from charloom.operators.ranking import ordinal

_ONE_MODEL = "_model"


def context_totals(pairs: DataFrame, keys: Sequence[str] = (), ranked: bool = False) -> DataFrame:
    """A5: per context its total count and number of distinct next characters,
    plus the context's tie key."""
    tie = [F.min("ctx_rank").alias("ctx_rank")] if ranked else [F.min("first_seen").alias("first_seen")]
    return pairs.groupBy(*keys, "context", "ctx_len").agg(
        F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("n_types"), *tie)


def _context_order(ranked: bool):
    if ranked:
        return [F.col("total").desc(), F.col("ctx_rank").asc(), F.col("context").asc()]
    return [F.col("total").desc(), F.col("first_seen").asc(), F.col("ctx_len").desc(),
            F.col("context").asc()]


def _char_order(ranked: bool):
    if ranked:
        return [F.col("cnt").desc(), F.col("char_rank").asc(), F.col("ch").asc()]
    return [F.col("cnt").desc(), F.col("first_seen").asc(), F.col("ch").asc()]


def _val(v) -> "F.Column":
    """An int parameter or the name of a per-model parameter column."""
    return F.col(v) if isinstance(v, str) else F.lit(int(v))


def frequency_cut(totals: DataFrame, max_contexts, keys: Sequence[str]) -> DataFrame:
    """Drop every context whose total is below the ``max_contexts``-th largest
    total of its model.  What remains is the final set plus the tie bucket at the
    cut.  The histogram has one row per (model, distinct total)."""
    hist = totals.groupBy(*keys, "total").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.col("total").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("at_or_above", F.sum("n").over(w))
    if isinstance(max_contexts, str):
        caps = totals.select(*keys, max_contexts).distinct()
        hist = hist.join(F.broadcast(caps), list(keys))
    cut = hist.where(F.col("at_or_above") >= _val(max_contexts)).groupBy(*keys).agg(
        F.max("total").alias("_cut"))
    # Models with fewer contexts than the cap have no cut row: keep all of them.
    out = totals.join(F.broadcast(cut), on=list(keys), how="left")
    return out.where(F.col("_cut").isNull() | (F.col("total") >= F.col("_cut"))).drop("_cut")


def trim(pairs: DataFrame, min_context_count, max_contexts, max_chars_per_context: int,
         keys: Sequence[str] = (), ranked: bool = False) -> DataFrame:
    """A5 + A6 (total >= min) + L6 (top contexts) + L7 (top next characters).

    Returns ``(keys..., context, ctx_len, ch, cnt, first_seen, ctx_rank, char_rank,
    ctx_total)``; ``ctx_total`` is the total the context was ranked and tested by
    (before L7).
    ``max_contexts <= 0`` means no cap; ``max_chars_per_context <= 0`` keeps nothing.
    ``min_context_count`` and ``max_contexts`` may name columns that are
    constant within each model (the grid search's per-model parameters); a
    column cap must be positive.
    """
    param_cols = [c for c in (min_context_count, max_contexts) if isinstance(c, str)]
    keys = list(keys)
    work_keys = keys or [_ONE_MODEL]
    if not keys:
        pairs = pairs.withColumn(_ONE_MODEL, F.lit(0))
    capped = isinstance(max_contexts, str) or max_contexts > 0
    totals = context_totals(pairs, [*work_keys, *param_cols], ranked).where(
        F.col("total") >= _val(min_context_count))
    if capped:
        totals = frequency_cut(totals, max_contexts, work_keys)
    # The ranking reads its input up to three times (range sampling, sort,
    # per-partition counts); after the cut it is at most the cap plus the tie
    # bucket per model, so keep it instead of recomputing the counts.
    totals = totals.persist(StorageLevel.MEMORY_AND_DISK)
    totals = ordinal(totals, _context_order(ranked), work_keys, name="_new_ctx_rank")
    if capped:
        totals = totals.where(F.col("_new_ctx_rank") <= _val(max_contexts))
    kept = totals.select(*work_keys, "context", "_new_ctx_rank", F.col("total").alias("_ctx_total"))

    body = pairs.join(kept, on=[*work_keys, "context"], how="inner")
    per_ctx = Window.partitionBy(*work_keys, "context").orderBy(*_char_order(ranked))
    body = body.withColumn("_new_char_rank", F.row_number().over(per_ctx)).where(
        F.col("_new_char_rank") <= max_chars_per_context)
    body = body.drop("ctx_total")
    if ranked:
        body = body.drop("ctx_rank", "char_rank")
    body = body.withColumnRenamed("_new_ctx_rank", "ctx_rank").withColumnRenamed("_ctx_total", "ctx_total").withColumn(
        "char_rank", F.col("_new_char_rank").cast("int")).drop("_new_char_rank")
    cols = [*keys, "context", "ctx_len", "ch", "cnt", "first_seen", "ctx_rank", "char_rank", "ctx_total"]
    return body.select(*cols)
