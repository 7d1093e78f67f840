"""Grid search (P10: G5, P3, P9, M1-M5, P5, A8, L11, S11).

The corpus is counted ONCE at the largest order; the counts of a smaller order
are the rows with ``ctx_len <= order - 1`` (tie keys included).  Every model of
the grid lives in one long table keyed by ``mid``: the per-order first trim and
the per-(order, min count, cap) second trim each run as one job over all models
(``trim`` with model keys), and every (discount, alpha) pair is scored inside
the prediction fold from the same levels, so no model is materialised per grid
point.  With ``pretrim`` (the reference's behaviour, SURVEY 2.9-f) the grid trims
re-trim counts that the fit already trimmed with (3, 1,000,000).
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from charloom.functions.text import nfc
from charloom.operators import predict as pred_ops
from charloom.operators import scoring
from charloom.operators.scoring import BaseStats
from charloom.operators.trim import trim
from charloom.plans.model import (BUILTIN_DEFAULT_CHARS, ModelParams, count_corpus, frequent_chars,
                                  merge_defaults)

# The reference's grid and fixed setting.
REFERENCE_GRID = {
    "ngram_order": [5, 6, 7, 8],
    "kn_discount": [0.5, 0.75, 0.9],
    "laplace_alpha": [0.01, 0.1, 1.0],
    "min_context_count": [2, 3, 5],
    "max_contexts": [300000, 500000, 1000000],
}
FIXED_MAX_CHARS = 48

SMALL_GRID = {
    "ngram_order": [3, 4],
    "kn_discount": [0.5, 0.9],
    "laplace_alpha": [0.1, 1.0],
    "min_context_count": [2, 5],
    "max_contexts": [2000, 20000],
}

RESULT_COLUMNS = ["grid_idx", "ngram_order", "kn_discount", "laplace_alpha", "min_context_count",
                  "max_contexts", "ex_correct", "ex_total", "ex_acc", "dev_correct", "dev_total", "dev_acc", "rank"]


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """G5 in the reference's loop order: order, then (min, cap), then (D, alpha)."""
    out = []
    for n in grid["ngram_order"]:
        for m, c in itertools.product(grid["min_context_count"], grid["max_contexts"]):
            for d, a in itertools.product(grid["kn_discount"], grid["laplace_alpha"]):
                out.append(dict(ngram_order=n, min_context_count=m, max_contexts=c, kn_discount=d,
                                laplace_alpha=a))
    return [dict(grid_idx=i, **p) for i, p in enumerate(out)]


def grid_search(corpus: DataFrame, examples: DataFrame | Mapping[str, DataFrame], dev: DataFrame,
                grid: Mapping[str, Sequence] = REFERENCE_GRID, max_chars_per_context: int = FIXED_MAX_CHARS,
                pretrim: bool = True, fit_params: ModelParams = ModelParams(), k: int = 3) -> DataFrame:
    """Evaluate every grid point on ``dev`` and on the example set.

    ``examples`` / ``dev``: ``(qid, text, answer)`` tables (``examples`` also as a mapping
    with one entry).  Returns one row per grid point with ``rank`` by dev accuracy (ties in
    grid order).  Hit test is the case-sensitive substring test of tune (M10).

    Inputs are counted first: equal (order, set, suffix, answer) are one row with a weight.
    A suffix is scored once, into the vector of its guesses at every grid point of its
    order; a weighted row makes of it a vector of hits, and these are summed element by
    element.  So there is no row per input and grid point."""
    spark = corpus.sparkSession
    given = grid
    grid = {name: list(dict.fromkeys(values)) for name, values in given.items()}
    orders = sorted(grid["ngram_order"])
    raw = count_corpus(corpus, max(orders))
    K = max_chars_per_context

    # Models: one per (order, min count, cap); mid is their position.
    trims = list(itertools.product(grid["min_context_count"], grid["max_contexts"]))
    models = [(mid, n, m, c) for mid, (n, (m, c)) in enumerate(itertools.product(orders, trims))]

    # Per-order counts in one table (each order keeps its contexts of length <= n-1).
    order_col = F.explode(F.filter(F.array(*[F.lit(n) for n in orders]), lambda n: F.col("ctx_len") <= n - 1))
    by_order = raw.pairs.select(order_col.alias("ngram_order"), "*")
    if pretrim:
        # P3's own trim with the fit defaults, per order.
        by_order = trim(by_order, fit_params.min_context_count, fit_params.max_contexts, K,
                        keys=["ngram_order"])
    # Within one order every (min, cap) model ranks contexts the same way (total
    # desc, then the same tie key) and keeps the same K characters per context,
    # so a model is the prefix "ctx_total >= min and ctx_rank <= cap" of ONE
    # trim with the loosest bounds.  No count is copied per model; the filter is
    # applied to the matched levels inside the scoring row.
    caps = list(grid["max_contexts"])
    loosest_cap = 0 if any(c <= 0 for c in caps) else max(caps)
    trimmed = trim(by_order, min(grid["min_context_count"]), loosest_cap, K, keys=["ngram_order"], ranked=pretrim)
    trimmed = trimmed.persist(StorageLevel.MEMORY_AND_DISK)

    stats = BaseStats(raw.total_bigram_types > 0,
                      raw.total_bigram_types if raw.total_bigram_types > 0 else
                      int(raw.unigram.agg(F.sum("cnt")).first()[0] or 0),
                      max(1, raw.continuation.count() if raw.total_bigram_types > 0 else raw.n_unigram_types))
    base = scoring.base_counts(raw.unigram, raw.continuation, stats)
    levels = scoring.levels(trimmed, base, keys=["ngram_order"], vocab_size=stats.vb,
                            extra_cols=("ctx_total", "ctx_rank"))

    defaults = list(BUILTIN_DEFAULT_CHARS)
    if raw.n_unigram_types > 0:
        defaults = merge_defaults(frequent_chars(raw.unigram, K), defaults)
    prefix_len = k + (max(orders) - 1) * K
    discounts = [float(d) for d in grid["kn_discount"]]
    smoothings = []
    for i, a in enumerate(grid["laplace_alpha"]):
        rp = scoring.base_ranking_prefix(base, a, stats, prefix_len)
        smoothings.append(F.struct(F.lit(i).alias("I"), F.lit(float(a)).alias("A"), F.lit(float(stats.denominator(a))).alias("DEN"),
                                   pred_ops.lit_ranking(rp).alias("R")))

    # Inputs, counted by (order, set, suffix, answer).
    if isinstance(examples, Mapping):
        if len(examples) != 1:
            raise ValueError("grid_search reports one example set; union the sets first (with distinct qids)")
        (examples,) = examples.values()
    row = (F.col("qid").cast("string").alias("qid"), "text", "answer")
    sets = examples.select(F.lit("ex").alias("set"), *row).unionByName(dev.select(F.lit("dev").alias("set"), *row))
    # The null test reads the raw text: NFC keeps nulls null, and the UDF's
    # output then feeds projections only (never an aggregate expression).
    sets = sets.withColumn("_null", F.col("text").isNull()).withColumn("_t", nfc("text"))
    x = _inputs_per_order(sets, orders).groupBy("ngram_order", "set", "sfx", "answer", "_null").agg(
        F.count(F.lit(1)).alias("weight"))
    sfx = x.select("ngram_order", "sfx").where(F.col("sfx").isNotNull()).distinct()
    lv = pred_ops.matched_levels(sfx, levels, keys=["ngram_order"], extra=("ctx_total", "ctx_rank"))
    model_lit = F.array(*[F.struct(F.lit(mid).alias("mid"), F.lit(n).alias("n"), F.lit(m).alias("min_cc"),
                                   F.lit(c).alias("max_ctx")) for mid, n, m, c in models])
    # Models of this row's order and, per model, the matched levels it keeps.
    # Models that keep the same levels score identically, so each distinct set
    # of kept levels is scored once and fanned out to its model ids afterwards.
    def keeps(x, m):
        return (x["ctx_total"] >= m["min_cc"]) & ((m["max_ctx"] <= 0) | (x["ctx_rank"] <= m["max_ctx"]))

    mine = F.filter(model_lit, lambda m: m["n"] == F.col("ngram_order"))
    with_sig = F.transform(mine, lambda m: F.struct(
        m["mid"].alias("mid"), F.transform(F.filter("lv", lambda x: keeps(x, m)), lambda x: x["L"]).alias("sig")))
    groups = F.transform(F.array_distinct(F.transform(with_sig, lambda w: w["sig"])), lambda sg: F.struct(
        sg.alias("sig"), F.transform(F.filter(with_sig, lambda w: w["sig"] == sg), lambda w: w["mid"]).alias("mids")))
    lv = lv.select("ngram_order", "sfx", "lv", F.explode(groups).alias("g"))
    keep = F.filter("lv", lambda x: F.array_contains(F.col("g.sig"), x["L"]))
    # The fold depends on D only: fold once per D, then finish once per alpha.
    lv = lv.select("ngram_order", "sfx", F.col("g.mids").alias("mids"), keep.alias("lv"),
                   F.explode(F.array(*[F.lit(d) for d in discounts])).alias("kn_discount"))
    folded = pred_ops.fold_levels(lv, F.col("kn_discount")).drop("lv")
    folded = folded.select("*", F.explode(F.array(*smoothings)).alias("sm"))
    scored = pred_ops.finish_guesses(folded, F.col("sm.A"), F.col("sm.DEN"), k, F.col("sm.R"),
                                     pred_ops.lit_str_array(defaults))
    # The place of a grid point in its order's vector: model, then discount, then alpha.
    n_d, n_a, n_m = len(discounts), len(smoothings), len(trims)
    at = [(n, m, c, d, a) for n in orders for (m, c) in trims for d in discounts for a in map(float, grid["laplace_alpha"])]
    per_order = n_m * n_d * n_a
    entry = F.struct(F.transform("mids", lambda m: m % n_m).alias("models"),
                     (F.array_position(F.array(*[F.lit(d) for d in discounts]), F.col("kn_discount")) - 1).alias("d"),
                     F.col("sm.I").alias("a"), F.array_join("guesses", "").alias("pred"))
    # Grouped as the levels already are: no further shuffle.
    vectors = scored.groupBy("ngram_order", "sfx").agg(F.collect_list(entry).alias("e"))
    placed = F.flatten(F.transform("e", lambda e: F.transform(e["models"], lambda m: F.struct(
        (m * (n_d * n_a) + e["d"] * n_a + e["a"]).alias("place"), e["pred"].alias("pred")))))
    vectors = vectors.select("ngram_order", "sfx", F.transform(F.array_sort(placed), lambda p: p["pred"]).alias("preds"))
    fallback = "".join(pred_ops.fallback_guesses(defaults, k))
    j = x.join(vectors, ["ngram_order", "sfx"], "left")
    preds = F.when(F.col("_null"), F.array_repeat(F.lit(fallback), per_order)).otherwise(F.col("preds"))
    hits = F.transform(preds, lambda p: F.when(F.contains(p, F.col("answer")), F.col("weight")).otherwise(0))
    j = j.select("ngram_order", "set", "weight", hits.alias("hits"))
    sums = j.groupBy("ngram_order", "set").agg(
        F.sum("weight").alias("total"),
        F.array(*[F.coalesce(F.sum(F.get("hits", F.lit(i))), F.lit(0)) for i in range(per_order)]).alias("correct"))
    sums = sums.select("ngram_order", "set", "total", F.posexplode("correct").alias("place", "correct"))
    acc = sums.groupBy("ngram_order", "place").agg(*[
        F.coalesce(F.max(F.when(F.col("set") == name, F.col(c))), F.lit(0)).cast("long").alias(f"{name}_{c}")
        for name in ("ex", "dev") for c in ("correct", "total")])
    place_rows = [(i % per_order, *p) for i, p in enumerate(at)]
    places = spark.createDataFrame(place_rows, "place int, ngram_order int, min_context_count int, max_contexts int, "
                                               "kn_discount double, laplace_alpha double")

    points = spark.createDataFrame(
        [(p["grid_idx"], p["ngram_order"], float(p["kn_discount"]), float(p["laplace_alpha"]),
          p["min_context_count"], p["max_contexts"]) for p in grid_points(given)],
        "grid_idx long, ngram_order int, kn_discount double, laplace_alpha double, "
        "min_context_count int, max_contexts int")
    res = F.broadcast(points).join(places, ["ngram_order", "min_context_count", "max_contexts", "kn_discount", "laplace_alpha"]).join(
        acc, ["ngram_order", "place"], "left")
    for name in ("ex", "dev"):
        res = res.withColumn(f"{name}_acc", F.try_divide(F.col(f"{name}_correct").cast("double"), F.col(f"{name}_total")))
    # One row per grid point, so a single ordered window is small.
    res = res.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("dev_acc").desc(), F.col("grid_idx").asc())).cast("long"))
    return res.select(*RESULT_COLUMNS)


def _inputs_per_order(sets: DataFrame, orders: Sequence[int]) -> DataFrame:
    """Every input row once per order of the grid (bounded: #inputs x #orders),
    with that order's scoring suffix."""
    per = F.explode(F.array(*[F.lit(n) for n in orders]))
    x = sets.select("set", "qid", "answer", "_null", "_t", per.alias("ngram_order"))
    n1 = F.col("ngram_order") - 1
    sfx = F.when(F.col("_null"), F.lit(None)).when(n1 > 0, F.right("_t", n1)).otherwise(F.lit(""))
    return x.select("set", "qid", "answer", "_null", "ngram_order", sfx.alias("sfx"))


def best(results: DataFrame) -> DataFrame:
    """The best row (rank 1)."""
    return results.where(F.col("rank") == 1)


__all__ = ["grid_search", "grid_points", "best", "REFERENCE_GRID", "SMALL_GRID"]
