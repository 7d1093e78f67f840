"""Line and position keys, null groups, and caches that go away."""

import pytest
from pyspark.sql import functions as F

from bruteforce import TinyModel
from charloom.operators import corpus as C
from charloom.operators.counts import line_key, pack_position, unpack_line, unpack_position
from charloom.plans.model import CharModel, ModelParams, count_corpus
from charloom.sources.tables import corpus_lines

BIG = 2**63 - 1


@pytest.mark.parametrize("doc", [0, 5_497_559, -1, BIG, -BIG - 1])
def test_keys_come_apart_again(spark, doc):
    rows = spark.createDataFrame([(doc, p, q) for p in (0, 100_000, 2**31 - 1) for q in (0, 7, 2**31 - 1)], "d long, p int, q int")
    packed = rows.select("*", pack_position(line_key(F.col("d"), F.col("p")), F.col("q")).alias("k"))
    out = packed.select("d", "p", "q", "k", unpack_position("k").alias("u")).select("*", unpack_line("u.line_id").alias("l")).orderBy("k").collect()
    assert [(r.l.doc_id, r.l.piece, r.u.pos) for r in out] == sorted((r.d, r.p, r.q) for r in out)


def test_a_document_of_very_many_lines(spark):
    text = "\n".join("ab" if k % 2 else "xy" for k in range(100_003))
    docs = spark.createDataFrame([(1, text, "en"), (2, "ab\nxy", "en")], "doc_id long, text string, lang string")
    lines = corpus_lines(docs)
    assert lines.count() == lines.select("line_id").distinct().count() == 100_005
    assert C.dev_random(lines, 100_003).count() == 100_003


def test_ids_far_apart_and_null_groups(spark):
    docs = spark.createDataFrame(
        [(10**13, "late ab", "en"), (-10**18, "first ab", None), (3, "mid\nab", "de")], "doc_id long, text string, lang string")
    lines = corpus_lines(docs)
    rows = lines.orderBy("line_id").collect()
    assert [r.text for r in rows] == ["first ab", "mid", "ab", "late ab"]
    assert {r.grp: r.grp_idx for r in rows} == {None: 0, "de": 1, "en": 2}
    model = CharModel.fit(lines, ModelParams(ngram_order=3, min_context_count=1, max_chars_per_context=2))
    tiny = TinyModel(3, 1.0, 2, 1).fit([r.text for r in rows])
    assert {(r.context, r.ch): r.cnt for r in model.context_chars.collect()} == {
        (c, ch): n for c, t in tiny.ctx.items() for ch, n in t.items()}


def test_predictions_leave_no_cache(spark, small_corpus, small_dev):
    raw = count_corpus(small_corpus, 3)
    model = CharModel.from_counts(raw, ModelParams(ngram_order=3)).prepare()
    held = spark.sparkContext._jsc.getPersistentRDDs().size
    before = held()
    for k in range(5):
        model.predict(small_dev.where(F.col("qid") % 5 == k)).count()
    assert held() == before
    model.release()
    raw.release()
    assert not any(df.storageLevel.useMemory for df in (raw.pairs, raw.unigram, raw.continuation, model.context_chars))
