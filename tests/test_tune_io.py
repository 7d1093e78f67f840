"""Grid search against the single-model path; model save/load round trip."""

import pytest
from pyspark.sql import functions as F

from charloom.operators import evaluate
from charloom.plans import tune
from charloom.plans.model import CharModel, ModelParams
from charloom.sources import model_io

GRID = {"ngram_order": [2, 4], "kn_discount": [0.5, 1.0], "laplace_alpha": [0.1],
        "min_context_count": [2, 4], "max_contexts": [150]}


def _acc(model, sets):
    return [evaluate.compare({"m": model.predict(s)}, s).first().correct for s in sets]


@pytest.mark.parametrize("pretrim", [True, False])
def test_grid_search(spark, small_corpus, small_dev, pretrim):
    dev = small_dev
    ex = small_dev.where(F.col("qid") % 2 == 0)
    res = tune.grid_search(small_corpus, {"ex": ex}, dev, grid=GRID, pretrim=pretrim).collect()
    assert len(res) == len(tune.grid_points(GRID)) == 8
    assert sorted(r["rank"] for r in res) == list(range(1, 9))
    ordered = sorted(res, key=lambda r: r["rank"])
    assert all((a.dev_acc, -a.grid_idx) >= (b.dev_acc, -b.grid_idx) for a, b in zip(ordered, ordered[1:]))
    fit_defaults = ModelParams()
    for r in res:
        if pretrim:
            m = CharModel.fit(small_corpus, ModelParams(ngram_order=r.ngram_order, max_chars_per_context=48,
                                                        min_context_count=fit_defaults.min_context_count,
                                                        max_contexts=fit_defaults.max_contexts))
            m = m.retrim(r.min_context_count, r.max_contexts)
        else:
            m = CharModel.fit(small_corpus, ModelParams(ngram_order=r.ngram_order, max_chars_per_context=48,
                                                        min_context_count=r.min_context_count,
                                                        max_contexts=r.max_contexts))
        m = m.with_scoring(r.kn_discount, r.laplace_alpha)
        assert _acc(m, [ex, dev]) == [r.ex_correct, r.dev_correct], r


def test_save_load_roundtrip(spark, small_corpus, small_dev):
    m = CharModel.fit(small_corpus, ModelParams(ngram_order=4, max_chars_per_context=6, min_context_count=2,
                                                max_contexts=300, kn_discount=0.6, laplace_alpha=0.3))
    path = model_io.scratch_path(spark, "test-model")
    model_io.save(m, path)
    back = model_io.load(spark, path)
    assert back.params == m.params and back.default_chars == m.default_chars
    assert back.total_bigram_types == m.total_bigram_types
    a = {r.qid: r.pred for r in m.predict(small_dev).collect()}
    b = {r.qid: r.pred for r in back.predict(small_dev).collect()}
    assert a == b
    # a second trim of the loaded model uses the stored ranks
    p1 = sorted(m.prune(3, 80, 3).context_chars.select("context", "ch", "ctx_rank", "char_rank").collect())
    p2 = sorted(back.prune(3, 80, 3).context_chars.select("context", "ch", "ctx_rank", "char_rank").collect())
    assert p1 == p2
    assert model_io.model_size_bytes(path) > 0
