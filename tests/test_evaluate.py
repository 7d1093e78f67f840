"""Grading and comparison."""

import pytest

from charloom.operators import evaluate


def test_grade_padding_and_extra_rows(spark):
    gold = spark.createDataFrame([(0, "a"), (1, "B"), (2, ""), (3, "z")], "qid long, answer string")
    preds = spark.createDataFrame([(0, "xAy"), (1, "bcd"), (9, "zzz")], "qid long, pred string")
    rows = {r.qid: r.right for r in evaluate.grade_rows(preds, gold).collect()}
    # missing predictions count as '', an empty answer is always a hit, extra rows are ignored
    assert rows == {0: True, 1: True, 2: True, 3: False}
    assert evaluate.grade(preds, gold).first().correct == 3
    empty = spark.createDataFrame([], "qid long, answer string")
    assert evaluate.grade(preds, empty).first().success_rate is None


def test_compare_and_winner(spark):
    gold = spark.createDataFrame([(0, "a"), (1, "b")], "qid long, answer string")
    a = spark.createDataFrame([(0, "abc"), (1, "xyz")], "qid long, pred string")
    b = spark.createDataFrame([(0, "abc"), (1, "ybz")], "qid long, pred string")
    cmp = evaluate.compare({"A": a, "B": b}, gold)
    assert {r.model: r.acc for r in cmp.collect()} == {"A": 0.5, "B": 1.0}
    assert evaluate.winner(cmp).first().winner_by_acc == "B"
    tie = evaluate.compare({"A": a, "B": a}, gold)
    assert evaluate.winner(tie).first().winner_by_acc == "A"
    assert evaluate.check_aligned(gold, gold).count() == 0
    assert evaluate.check_aligned(a.select("qid"), gold.where("qid = 0")).count() == 1


def test_winner_speed_tie_breaker(spark):
    gold = spark.createDataFrame([(0, "a"), (1, "b")], "qid long, answer string")
    a = spark.createDataFrame([(0, "abc"), (1, "xyz")], "qid long, pred string")
    cmp = evaluate.compare({"A": a, "B": a}, gold, seconds={"A": 2.0, "B": 1.0})
    row = evaluate.winner(cmp).first()
    assert (row.winner_by_acc, row.tie_breaker_by_speed) == ("A", "B")
    b = spark.createDataFrame([(0, "abc"), (1, "bbb")], "qid long, pred string")
    row = evaluate.winner(evaluate.compare({"A": a, "B": b}, gold, seconds={"A": 2.0, "B": 1.0})).first()
    assert (row.winner_by_acc, row.tie_breaker_by_speed) == ("B", None)
    with pytest.raises(ValueError):
        evaluate.require_aligned(a, gold.where("qid = 0"))
    evaluate.require_aligned(a, gold)
