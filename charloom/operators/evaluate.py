"""Grading and comparison (P6, P7: F8, J4, J5, J6, M10, M11, A8)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import grader_view


def grade_rows(preds: DataFrame, gold: DataFrame, caseless: bool = True, limit: int | None = 3) -> DataFrame:
    """P6 verbose: one row per gold row.  Missing predictions count as '' (J4),
    extra predictions are ignored; the grader lowercases, then cuts the
    prediction to ``limit`` characters (F8)."""
    j = gold.select("qid", "answer").join(preds.select("qid", "pred"), "qid", "left")
    p = F.coalesce(F.col("pred"), F.lit(""))
    g = F.col("answer")
    if caseless:
        p, g = grader_view(p, limit), grader_view(g)
    elif limit is not None:
        p = F.substring(p, 1, limit)
    return j.select("qid", g.alias("gold"), p.alias("pred"), F.contains(p, g).alias("right"))


def grade(preds: DataFrame, gold: DataFrame, caseless: bool = True, limit: int | None = 3) -> DataFrame:
    """``(correct, total, success_rate)``; the rate is null for an empty gold set
    (the reference divides by zero there)."""
    rows = grade_rows(preds, gold, caseless, limit)
    return rows.agg(F.count_if("right").cast("long").alias("correct"),
                    F.count(F.lit(1)).cast("long").alias("total")).select(
        "correct", "total", F.try_divide(F.col("correct").cast("double"), F.col("total")).alias("success_rate"))


def check_aligned(inputs: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows whose qid is on one side only; empty when input and gold align."""
    a = inputs.select("qid", F.lit(True).alias("_in"))
    b = gold.select("qid", F.lit(True).alias("_gold"))
    return a.join(b, "qid", "full_outer").where(F.col("_in").isNull() | F.col("_gold").isNull())


def compare(preds_by_model: Mapping[str, DataFrame], gold: DataFrame,
            seconds: Mapping[str, float] | None = None, inputs: DataFrame | None = None) -> DataFrame:
    """Accuracy of every model on one dev set (case-sensitive substring test,
    0 for an empty set) and the winner: the first model wins ties (M11); on an
    exact tie the faster one is named when ``seconds`` are given.  With ``inputs``, they
    and the answers must align first (J5)."""
    if inputs is not None:
        require_aligned(inputs, gold)
    parts = []
    for order, (name, preds) in enumerate(preds_by_model.items()):
        j = gold.select("qid", "answer").join(preds.select("qid", "pred"), "qid", "left")
        hit = F.contains(F.coalesce(F.col("pred"), F.lit("")), F.col("answer"))
        agg = j.agg(F.count_if(hit).cast("long").alias("correct"), F.count(F.lit(1)).cast("long").alias("total"))
        parts.append(agg.select(F.lit(name).alias("model"), F.lit(order).alias("model_order"), "correct", "total"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("acc", F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(F.lit(0.0)))
    if seconds:
        out = out.withColumn("seconds", F.create_map(*[x for kv in seconds.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])[F.col("model")])
    return out


def require_aligned(inputs: DataFrame, gold: DataFrame) -> None:
    """J5 as the reference applies it: stop when inputs and answers differ in size
    or keys (one count action)."""
    bad = check_aligned(inputs, gold).count()
    if bad:
        raise ValueError(f"Mismatched input/answer rows: {bad} qid(s) on one side only")


def winner(comparison: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    """M11 over the comparison table (one row per model, so the unpartitioned
    windows below are small): the most accurate model, the earlier one on ties;
    with a ``seconds`` column and more than one model within ``tolerance`` of the
    best accuracy, also the fastest of those (the earlier one on ties)."""
    from pyspark.sql import Window
    everything = Window.partitionBy()
    t = comparison.withColumn("_best", F.max("acc").over(everything))
    t = t.withColumn("_tied", F.abs(F.col("acc") - F.col("_best")) < tolerance)
    t = t.withColumn("_n_tied", F.sum(F.col("_tied").cast("int")).over(everything))
    by_acc = F.row_number().over(Window.orderBy(F.col("acc").desc(), F.col("model_order").asc()))
    t = t.withColumn("_r", by_acc)
    cols = [F.first(F.when(F.col("_r") == 1, F.col("model")), ignorenulls=True).alias("winner_by_acc"),
            F.max("_best").alias("acc")]
    if "seconds" in comparison.columns:
        by_speed = Window.orderBy((~F.col("_tied")).asc(), F.col("seconds").asc(), F.col("model_order").asc())
        t = t.withColumn("_s", F.row_number().over(by_speed))
        cols.append(F.first(F.when((F.col("_s") == 1) & (F.col("_n_tied") > 1), F.col("model")),
                            ignorenulls=True).alias("tie_breaker_by_speed"))
    return t.agg(*cols)
