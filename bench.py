"""Headline benchmark: prints ONE JSON line.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]:
  fit_baseline      count + trim the published baseline configuration
                    (order 6, D 0.75, alpha 1.0, 48 chars, min 5, 300k contexts)
                    over all of documents
  prepare_scoring   build the scoring tables (what the reference does on load)
  predict           top-3 for every conversation turn (text minus last char);
                    scoring only, like the reference's published inference time
  predict_all_lines top-3 for every corpus line minus its last character
  grade             caseless top-3 success rate of those predictions
  trim_prepare_kn   the kn_initial model from the same counts, and its scoring tables
  predict_kn        its top-3 for every conversation turn, scoring only
  compare_models    baseline vs kn_initial, both scored anew
  prune             prune the baseline model to (min 10, 100k, 16)
  save_load         write the model as Parquet and predict from the loaded copy
  grid_small        grid search over 2 orders x 2 trims x 2 discounts x 2 alphas
  grid_reference_324  (only with BENCH_FULL_GRID=1) the reference's full grid
Every step forces full execution with a no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from charloom.operators import evaluate  # noqa: E402
from charloom.operators.corpus import load_capped  # noqa: E402
from charloom.plans import queries as Q  # noqa: E402
from charloom.plans.model import CharModel, count_corpus  # noqa: E402
from charloom.session import get_spark  # noqa: E402
from charloom.sources import model_io  # noqa: E402


# Fixed value: the published baseline inference time per row (57.2856 s / 8,200 rows).
BASELINE_MS_PER_ROW = 57.2856 / 8200 * 1000


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    t = time.time()
    corpus = Q._corpus(spark, sf)
    raw = count_corpus(corpus, 6)
    base = CharModel.from_counts(raw, Q.BASELINE)
    run(base.context_chars)
    base.base_stats()
    times["fit_baseline"] = time.time() - t

    t = time.time()
    base.prepare(3)
    times["prepare_scoring"] = time.time() - t

    dev = Q._dev(spark, sf).cache()
    n_dev = dev.count()
    t = time.time()
    preds = base.predict(dev).cache()
    run(preds)
    times["predict"] = time.time() - t
    extra["predict_rows"] = n_dev
    extra["predict_rows_per_sec"] = n_dev / times["predict"]
    extra["predict_ms_per_row"] = 1000 * times["predict"] / max(n_dev, 1)
    extra["predict_speedup_vs_baseline"] = BASELINE_MS_PER_ROW / extra["predict_ms_per_row"]

    t = time.time()
    g = evaluate.grade(preds, dev).first()
    times["grade"] = time.time() - t
    extra["top3_success_rate"] = g["success_rate"]

    t = time.time()
    lines = corpus.select(F.col("line_id").alias("qid"), "text").where(F.length("text") >= 2)
    lines = lines.select("qid", F.expr("substring(text, 1, length(text) - 1)").alias("text")).cache()
    n_lines = lines.count()
    t = time.time()
    run(base.predict(lines))
    times["predict_all_lines"] = time.time() - t
    extra["predict_all_lines_rows"] = n_lines
    extra["predict_all_lines_rows_per_sec"] = n_lines / times["predict_all_lines"]

    t = time.time()
    kn = CharModel.from_counts(raw, Q.KN_INITIAL).prepare(3)
    times["trim_prepare_kn"] = time.time() - t

    t = time.time()
    run(kn.predict(dev))
    times["predict_kn"] = time.time() - t
    extra["predict_kn_ms_per_row"] = 1000 * times["predict_kn"] / max(n_dev, 1)

    t = time.time()
    # Both models score the inputs again: nothing is taken from an earlier step.
    cmp = evaluate.compare({"baseline": base.predict(dev), "kn_initial": kn.predict(dev)}, dev)
    rows = {r["model"]: r["acc"] for r in cmp.collect()}
    times["compare_models"] = time.time() - t
    extra["acc_baseline"] = rows["baseline"]
    extra["acc_kn_initial"] = rows["kn_initial"]

    # Beside the total: every stored context scored once, inputs only looked up.
    t = time.time()
    base.prepare(3, guess_table=True)
    extra["guess_table_sec"] = time.time() - t
    t = time.time()
    run(base.predict(lines))
    extra["predict_all_lines_prepared_sec"] = time.time() - t
    t = time.time()
    run(base.predict(dev))
    extra["predict_prepared_ms_per_row"] = 1000 * (time.time() - t) / max(n_dev, 1)

    # Beside the total: the same configuration as kn_initial over a balanced, capped corpus.
    t = time.time()
    t5 = CharModel.fit(load_capped(Q._corpus(spark, sf, keep_blank=True, normalize=False), 50_000, balanced=True, normalize=True),
                       Q.KN_INITIAL).prepare(3)
    extra["fit_t5_balanced_sec"] = time.time() - t
    t = time.time()
    p5 = t5.predict(dev).cache()
    run(p5)
    extra["predict_t5_balanced_ms_per_row"] = 1000 * (time.time() - t) / max(n_dev, 1)
    extra["acc_t5_balanced"] = evaluate.compare({"t5": p5}, dev).first()["acc"]

    t = time.time()
    pruned = base.prune(10, 100_000, 16)
    run(pruned.context_chars)
    times["prune"] = time.time() - t

    t = time.time()
    path = model_io.scratch_path(spark, "bench-model")
    model_io.save(base, path)
    loaded = model_io.load(spark, path)
    run(loaded.predict(dev))
    times["save_load"] = time.time() - t
    extra["model_mb"] = model_io.model_size_bytes(path) / 2**20

    try:
        from charloom.plans import tune
        t = time.time()
        res = tune.grid_search(corpus, {"ex": dev}, dev, grid=tune.SMALL_GRID)
        res.collect()
        times["grid_small"] = time.time() - t
    except ImportError:
        pass

    if os.environ.get("BENCH_FULL_GRID") == "1":
        from charloom.plans import tune
        t = time.time()
        res = tune.grid_search(corpus, {"ex": Q._bench_examples(spark, sf)}, dev, grid=tune.REFERENCE_GRID)
        extra["full_grid_points"] = res.count()
        times["grid_reference_324"] = time.time() - t

    extra["contexts_stored"] = base.context_chars.select("context").distinct().count()
    total = sum(times.values())
    print(json.dumps({"metric": "total_pipeline_sec", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()},
                      "extra": {k: (round(v, 6) if isinstance(v, float) else v) for k, v in extra.items()},
                      "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
