"""P3 + P5 against the brute-force in-memory model on sf0.001."""

import pytest

from bruteforce import TinyModel
from charloom.plans.model import CharModel, ModelParams

CONFIGS = [
    ModelParams(ngram_order=3, max_chars_per_context=5, min_context_count=3, max_contexts=200),
    ModelParams(ngram_order=6, max_chars_per_context=48, min_context_count=5, max_contexts=3000,
                kn_discount=0.5, laplace_alpha=0.01),
    ModelParams(ngram_order=4, max_chars_per_context=2, min_context_count=2, max_contexts=50,
                kn_discount=1.0, laplace_alpha=0.1),
    ModelParams(ngram_order=1),
]


def _tiny(p, lines):
    return TinyModel(p.ngram_order, p.laplace_alpha, p.max_chars_per_context, p.min_context_count,
                     p.max_contexts, p.kn_discount).fit(lines)


@pytest.mark.parametrize("params", CONFIGS, ids=lambda p: f"n{p.ngram_order}-K{p.max_chars_per_context}-cap{p.max_contexts}")
def test_predictions_match_bruteforce(spark, small_corpus, small_lines, small_dev, params):
    model = CharModel.fit(small_corpus, params)
    got = {r.qid: r.pred for r in model.predict(small_dev).collect()}
    tiny = _tiny(params, small_lines)
    rows = small_dev.collect()
    exp = {r.qid: tiny.predict(r.text) for r in rows}
    assert got == exp
    assert model.default_chars == tiny.defaults
    stored = {(r.context, r.ch): r.cnt for r in model.context_chars.collect()}
    expected = {(c, ch): n for c, d in tiny.ctx.items() for ch, n in d.items()}
    assert stored == expected


@pytest.mark.parametrize("params", CONFIGS, ids=lambda p: f"n{p.ngram_order}-K{p.max_chars_per_context}-cap{p.max_contexts}")
def test_three_ways_to_look_a_context_up(spark, small_corpus, small_lines, small_dev, params, monkeypatch):
    from pyspark.sql import functions as F

    from charloom.plans import model as plan
    inputs = small_dev.select("qid", F.when(F.col("qid") % 7 == 0, None).when(F.col("qid") % 7 == 1, F.lit("")).otherwise(F.col("text")).alias("text"))
    model = CharModel.fit(small_corpus, params)
    tiny = _tiny(params, small_lines)
    exp = {r.qid: tiny.predict(r.text) for r in inputs.collect()}
    assert {r.qid: r.pred for r in model.predict(inputs).collect()} == exp
    model.prepare(3, guess_table=True)
    assert {r.context for r in model.guess_table(3).collect()} == set(tiny.ctx)
    assert {r.qid: r.pred for r in model.predict(inputs).collect()} == exp
    monkeypatch.setattr(plan, "BROADCAST_CONTEXTS", -1)
    assert {r.qid: r.pred for r in model.predict(inputs).collect()} == exp


def test_suffix_links(spark, small_corpus):
    model = CharModel.fit(small_corpus, ModelParams(ngram_order=5, max_chars_per_context=4, min_context_count=2, max_contexts=150))
    rows = {r.context: r for r in model.suffix_links().collect()}
    stored = {r.context for r in model.context_chars.select("context").distinct().collect()}
    assert set(rows) == stored
    for c, r in rows.items():
        lens = [n for n in range(1, len(c) + 1) if c[-n:] in stored]
        assert list(r.lens) == lens and r.link == (c[-lens[-2]:] if len(lens) > 1 else "")


def test_no_counts_move_with_the_inputs(spark, small_corpus, small_dev):
    """The levels meet distinct stored contexts only: below the join with ``ents`` there is an
    aggregation by context, and inputs meet guesses."""
    model = CharModel.fit(small_corpus, ModelParams(ngram_order=3, max_chars_per_context=4, max_contexts=100)).prepare(3, guess_table=True)
    plan = model.predict(small_dev)._jdf.queryExecution().optimizedPlan().toString()
    assert "ents" not in plan.split("InMemoryRelation")[0] and "Aggregate" not in plan.split("InMemoryRelation")[0]


def test_both_sides_of_the_key_join_are_shuffled(spark, small_corpus, small_dev):
    """So that AQE may split a hot context; the held levels do not move where counts do."""
    from charloom.operators.predict import stored_suffixes
    model = CharModel.fit(small_corpus, ModelParams(ngram_order=4, max_chars_per_context=4, max_contexts=100)).prepare(3)
    sfx = spark.createDataFrame([(r.text[-3:],) for r in small_dev.select("text").collect()], "sfx string").distinct()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = stored_suffixes(sfx, model.levels())
        plan = found._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(context") == 2


def test_prune_and_retrim_match_bruteforce(spark, small_corpus, small_lines, small_dev):
    params = ModelParams(ngram_order=4, max_chars_per_context=6, min_context_count=2, max_contexts=400)
    model = CharModel.fit(small_corpus, params)
    tiny = _tiny(params, small_lines)
    pruned = model.prune(min_context_count=4, max_contexts=120, max_chars_per_context=3)
    tiny.ctx = TinyModel.trimmed(tiny.ctx, 4, 120, 3)
    stored = {(r.context, r.ch): r.cnt for r in pruned.context_chars.collect()}
    assert stored == {(c, ch): n for c, d in tiny.ctx.items() for ch, n in d.items()}
    tiny.kmax = 3
    got = {r.qid: r.pred for r in pruned.predict(small_dev).collect()}
    assert got == {r.qid: tiny.predict(r.text) for r in small_dev.collect()}


def test_edge_inputs(spark, small_corpus, small_lines):
    params = ModelParams(ngram_order=3, max_chars_per_context=4, min_context_count=2, max_contexts=300)
    model = CharModel.fit(small_corpus, params)
    tiny = _tiny(params, small_lines)
    texts = ["", None, "zq\U0001F600x", "ć", "x\ry", "a\nb", "   ", "\x1c\x85\xa0　", "İ", "the"]
    inputs = spark.createDataFrame(list(enumerate(texts)), "qid long, text string")
    got = {r.qid: r.pred for r in model.predict(inputs).collect()}
    assert got == {i: tiny.predict(t) for i, t in enumerate(texts)}
    for k in (0, 1, 5):
        got = {r.qid: r.pred for r in model.predict(inputs, k=k).collect()}
        assert got == {i: tiny.predict(t, k) for i, t in enumerate(texts)}


def test_empty_corpus_pads_from_builtins(spark):
    corpus = spark.createDataFrame([], "line_id long, text string")
    model = CharModel.fit(corpus, ModelParams(ngram_order=3))
    inputs = spark.createDataFrame([(1, "abc"), (2, None)], "qid long, text string")
    got = {r.qid: r.pred for r in model.predict(inputs).collect()}
    assert got == {1: " .,", 2: " .,"}


def test_whole_documents_with_inner_newlines(spark, small_dev):
    """SURVEY 2.9-k: documents kept whole; newlines only ever inside contexts."""
    from conftest import SF_SMALL
    from charloom.sources.tables import corpus_lines
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    corpus = corpus_lines(docs, split_lines=False)
    texts = [r.text for r in corpus.orderBy("line_id").collect()]
    assert any("\n" in t for t in texts)
    params = ModelParams(ngram_order=4, max_chars_per_context=6, min_context_count=2, max_contexts=500)
    model = CharModel.fit(corpus, params)
    tiny = _tiny(params, texts)
    stored = {(r.context, r.ch): r.cnt for r in model.context_chars.collect()}
    assert stored == {(c, ch): n for c, d in tiny.ctx.items() for ch, n in d.items()}
    got = {r.qid: r.pred for r in model.predict(small_dev).collect()}
    assert got == {r.qid: tiny.predict(r.text) for r in small_dev.collect()}
