"""Operators 3, 4, 5 and 7: held-out accuracy, probabilities that sum to 1, brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from conftest import SF_MID, SF_SMALL
from llm.conftest import make_docs
from pyspark.sql import functions as F

from charloom.llm import language_id, lm_scoring, queries, token_counts
from charloom.llm import quality_classifier as qc


def auc(good, bad):
    good, bad = np.array(good), np.array(bad)
    return (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()


def test_classifier_held_out(spark):
    rows = {r.doc_id: r for r in queries.op3_quality_classifier(spark, SF_MID).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    held = [(rows[x.doc_id].score, x.quality) for x in labels if rows[x.doc_id].held_out]
    assert auc([s for s, q in held if q == 1], [s for s, q in held if q == 0]) > 0.97


def test_classifier_learns_nothing_from_held_out_rows(spark, sf_copy):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    a = {r.doc_id: r.score for r in queries.op3_quality_classifier(spark, SF_SMALL).collect()}
    flipped = labels.withColumn("quality", F.when(F.expr("crc32(cast(string(doc_id) as binary)) % 3 = 1"), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    b = {r.doc_id: r.score for r in queries.op3_quality_classifier(spark, sf_copy(documents=docs, labels=flipped)).collect()}
    assert a == b


def test_features_are_those_of_the_whole_text():
    tail = "ab cd " * 5000 + "#QZ"
    assert set(qc.features("#QZ")) <= set(qc.features(tail))
    assert len(qc.features(None)) == len(qc.features("")) == 0
    once, often = set(qc.features("a a a a a b c")), set(qc.features("a " * 50))
    assert once - often and often - once


def test_dual_coordinate_descent_reaches_the_minimum():
    rnd = np.random.default_rng(0)
    rows = [np.sort(rnd.choice(30, 6, replace=False)) for _ in range(80)]
    y = np.where(rnd.random(80) < 0.5, -1, 1)
    scale = rnd.normal(size=30)
    w, b = qc.dual_coordinate_descent(rows, scale, y, epochs=3000, tolerance=1e-9)
    cost = np.where(y > 0, 80 / (2 * (y > 0).sum()), 80 / (2 * (y < 0).sum()))
    x = np.zeros((80, 31))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / math.sqrt(6)
    x[:, 30] = 1

    def value(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()

    v = np.append(np.divide(w, scale), b)
    best = value(v)
    assert all(value(v + rnd.normal(size=31) * s) >= best - 1e-9 for s in (1e-3, 1e-2, 1e-1) for _ in range(200))


def test_classifier_odd_rows_and_no_labels(spark, odd_rows):
    docs = make_docs(spark, odd_rows, clashing=True)
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 1), (4, 0), (None, 1), (6, None)], "doc_id long, quality int")
    for known in (labels, labels.where("quality = 1"), labels.where("quality = 5")):
        rows = qc.classify(docs, known, F.lit(False)).collect()
        assert len(rows) == len(odd_rows)
        assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1  # null and empty alike
    assert {r.score for r in rows} == {0.5}
    assert qc.classify(docs.where("doc_id > 99"), labels, F.lit(False)).count() == 0


def test_language_held_out(spark):
    rows = {r.doc_id: r for r in queries.op5_language_id(spark, SF_MID).collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    held = [rows[d.doc_id].lang_pred == d.lang for d in docs if rows[d.doc_id].held_out]
    assert sum(held) / len(held) > 0.98


def test_mixtures_are_inferred(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where("length(text) > 600 and lang is not null").collect()
    model = language_id.fit(spark.read.parquet(f"{SF_MID}/documents.parquet").where("lang is not null").select("text", "lang"))
    by = {}
    for d in docs:
        by.setdefault(d.lang, language_id.words_of(d.text)[:100])
    langs = sorted(by)[:3]
    share, _ = language_id.infer([by[langs[0]], by[langs[0]][:70] + by[langs[1]][:30], by[langs[1]][:40] + by[langs[2]][:60]], model)
    k = {lang: i for i, lang in enumerate(model.langs)}
    assert (share[0] > 0).sum() == 1 and share[0, k[langs[0]]] == 1
    assert (share[1] > 0).sum() == 2 and abs(share[1, k[langs[0]]] - 0.7) < 0.12
    assert (share[2] > 0).sum() == 2 and abs(share[2, k[langs[2]]] - 0.6) < 0.12


def test_trigrams_cover_every_byte():
    words = [b"ab", b"c"]
    got, first = language_id.trigrams(words)
    code = [int.from_bytes(t, "big") for t in (b" ab", b"ab ", b"b c", b" c ", b"c  ")]
    want = [((c * 2654435761) % 2**32) >> (32 - language_id.BITS) for c in code]
    assert got.tolist() == want and first.tolist() == [0, 3]


def test_language_odd_rows(spark, odd_rows):
    rows = odd_rows + [(30, "1234 !!! 55", "en", "a"), (31, "éÉ", "fr", "b")]
    docs = make_docs(spark, rows, clashing=True)
    out = language_id.identify(docs, F.lit(False)).collect()
    assert len(out) == len(rows)
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 30) or (r.doc_id is None and r.score == 0)) for r in out)
    none = language_id.identify(docs, F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language_id.identify(docs.where("doc_id > 99"), F.lit(False)).count() == 0


def test_lm_models_sum_to_one_and_score_by_hand(spark):
    texts = [("a b a b c", True), ("a b d", True), ("c c a", False), ("d a b a", False)] * 3
    df = spark.createDataFrame(texts, "text string, target boolean")
    m = lm_scoring.fit(df, df, word_share=0.1, bigram_share=0.01)
    base = m.vocab.base
    for context in range(base):
        p = np.exp(-m.losses(context * base + np.arange(base)))
        assert np.allclose(p.sum(axis=0), 1)
    # The target's p(b | a) by hand.
    words = [w for t, side in texts if side for w in t.split()]
    pairs = Counter(p for t, side in texts if side for p in zip(t.split(), t.split()[1:]))
    context = Counter(p[0] for p in pairs.elements())
    kept = {p: n for p, n in pairs.items() if p[0] == "a"}
    smooth = (words.count("b") + 1) / (len(words) + base)
    rest = 1 - sum((n - 0.75) / context["a"] for n in kept.values())
    want = (kept["a", "b"] - 0.75) / context["a"] + rest * smooth
    code = np.array([m.vocab.ids["a"] * base + m.vocab.ids["b"]])
    assert math.isclose(math.exp(-m.losses(code)[0, 1]), want)


def test_lm_scores_prefer_the_target(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = queries.op4_lm_scoring(spark, SF_MID).collect()
    assert len(rows) == 1000
    good, bad = ([r.score for r in rows if labels.get(r.doc_id) == q] for q in (1, 0))
    assert auc([-x for x in good], [-x for x in bad]) > 0.95


def test_lm_odd_rows(spark, odd_rows):
    docs = make_docs(spark, odd_rows, clashing=True)
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 1), (None, 1), (6, None)], "doc_id long, quality int")
    for known in (labels, labels.where("quality = 5")):
        rows = lm_scoring.score(docs, known).collect()
        assert len(rows) == len(odd_rows)
        for r in rows:
            assert (r.n_tokens == 0) == (r.score is None)
    assert lm_scoring.score(docs.where("doc_id > 99"), labels).count() == 0


def test_lm_score_cuts_neither_words_nor_bigrams(spark, monkeypatch):
    rnd = random.Random(4)
    # 30,000 words that stand once, beside words and a bigram in every document.
    rows = [(i, " ".join(x for k in range(50) for x in (f"once{i}x{k}", rnd.choice("abcd"))) + " New York", "en", "s") for i in range(600)]
    rows += [rows[7], (None, "a b c New York", "en", "s"), (700, None, "en", "s"), (701, " ", "en", "s")]
    docs = make_docs(spark, rows, clashing=True)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int")
    sided = spark.createDataFrame([(t, i is not None and i < 600 and i % 3 == 0) for i, t, _, _ in rows], "text string, target boolean")
    models = lm_scoring.fit(sided, sided)
    assert len(models.vocab.ids) == 30_006
    want = {}
    for i, t, _, _ in rows:
        code = models.vocab.bigrams(t)
        want[i] = (len(code), *(models.losses(code).mean(axis=0) if len(code) else (None, None)))
    for hot_rows in (lm_scoring.HOT_ROWS, 50):
        monkeypatch.setattr(lm_scoring, "HOT_ROWS", hot_rows)
        out = lm_scoring.score(docs, labels).collect()
        assert len(out) == len(rows)
        for r in out:
            n, background, target = want[r.doc_id]
            assert r.n_tokens == n
            if n:
                assert math.isclose(r.loss_target, target, rel_tol=1e-9) and math.isclose(r.loss_background, background, rel_tol=1e-9)
            else:
                assert r.loss_target is r.loss_background is r.score is None


def test_lm_score_is_the_same_in_many_slices(spark, monkeypatch):
    rnd = random.Random(8)
    words = ["the"] * 20 + [f"w{k}" for k in range(300)] + ["a\0b", "a\0c", "\u0130x"]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 60))), "en", "s") for i in range(200)]
    rows += [rows[3], rows[3], (None, "the w1 the", "en", "s"), (5, "the same id", "en", "s"), (200, None, "en", "s")]
    docs = make_docs(spark, rows, clashing=True)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)] + [(None, 1)], "doc_id long, quality int")
    sided = spark.createDataFrame([(t, i is not None and i < 150 and i % 4 == 0) for i, t, _, _ in rows], "text string, target boolean")
    models = lm_scoring.fit(sided, sided)
    want = []
    for i, t, _, _ in rows:
        code = models.vocab.bigrams(t)
        want.append((i, len(code), *(models.losses(code).mean(axis=0).tolist() if len(code) else (None, None))))
    order = lambda r: tuple((x is None, x or 0) for x in r)
    # One slice, and more slices than some have words.
    for chars in (lm_scoring.SLICE_CHARS, 500):
        monkeypatch.setattr(lm_scoring, "SLICE_CHARS", chars)
        got = [(r.doc_id, r.n_tokens, r.loss_background, r.loss_target) for r in lm_scoring.score(docs, labels).collect()]
        assert len(got) == len(want)
        for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
            assert g[:2] == w[:2]
            assert all(x is y is None or math.isclose(x, y, rel_tol=1e-9) for x, y in zip(g[2:], w[2:]))


def test_lm_numbers_by_planes_of_bytes():
    for numbers in ([], [0], [0, 255, 256, 3], [2**64 - 1, 0, 2**40]):
        assert lm_scoring.unpack(lm_scoring.pack(np.array(numbers, np.uint64))).tolist() == numbers


def greedy(word, pieces, marker):
    word, n = marker + word, 0
    while word:
        k = next((k for k in range(len(word), 0, -1) if word[:k] in pieces), 0)
        if not k:
            return -1
        word, n = word[k:], n + 1
    return n


def test_automaton_against_greedy_matching():
    rnd = random.Random(1)
    for _ in range(60):
        pieces = {bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 14))}
        marker = rnd.choice([b"", b"a"])
        a = token_counts.Automaton(pieces, marker)
        for _ in range(200):
            w = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0 if marker else 1, 18)))
            assert a.length(w) == greedy(w, pieces, marker), (pieces, w)


def test_token_counts_on_table(spark):
    pieces = set(token_counts.load_pieces())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op7_token_counts(spark, SF_SMALL).collect():
        words = texts[r.doc_id].encode().split()
        cut = [greedy(w, pieces, b" ") for w in words]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(map(abs, cut)), cut.count(-1))


def test_token_counts_odd_rows(spark, odd_rows):
    docs = make_docs(spark, odd_rows, clashing=True)
    few = token_counts.Automaton([b" ", b"t", b"te", b"x"])
    rows = token_counts.count_tokens(docs, automaton=few).collect()
    assert len(rows) == len(odd_rows)
    assert all((r.n_words, r.n_tokens) == (0, 0) for r in rows if r.doc_id in (3, 4, 5))
    assert [(r.n_tokens, r.n_unknown) for r in rows if r.doc_id == 6] == [(2, 0)]
    assert token_counts.count_tokens(docs.where("doc_id > 99")).count() == 0
