"""Exact selections from histograms, against sorting."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from charloom.operators import corpus as ops
from charloom.operators.selection import cuts


@pytest.mark.parametrize("bins,slack", [(4, 0), (7, 3), (4096, 10)])
def test_cuts_hold_the_wanted_rows_and_little_more(spark, bins, slack):
    draw = random.Random(bins)
    rows = [(g, draw.choice([draw.randint(-10**18, 10**18), draw.randint(0, 30), 7]), draw.randint(0, 3))
            for g in ("a", "b", None) for _ in range(200)] + [("one", 5, 9)]
    df = spark.createDataFrame(rows, "g string, v long, w long")
    got = {r.g: r for r in cuts(df, F.col("v"), 40, F.col("w"), groups=["g"], slack=slack, bins=bins).collect()}
    assert set(got) == {"a", "b", None, "one"}
    for g, r in got.items():
        mine = sorted((v, w) for h, v, w in rows if h == g)
        inside = sum(w for v, w in mine if v <= r.cut)
        assert inside >= min(40, sum(w for _, w in mine))
        # What lies beyond is within the slack, or on the cut itself.
        assert sum(w for v, w in mine if v < r.cut) <= 40 + slack or inside <= 40 + slack


def test_cuts_of_nothing_and_of_all(spark):
    empty = spark.createDataFrame([], "v long")
    assert cuts(empty, F.col("v"), 3).first() is None
    few = spark.createDataFrame([(k,) for k in (3, 1, 2)], "v long")
    assert cuts(few, F.col("v"), 10, slack=0).first()["cut"] == 3
    assert cuts(few, F.col("v"), 2, slack=0, bins=2).first()["cut"] == 2


def lines(spark, n, groups=3, doc_lines=5):
    draw = random.Random(n)
    rows = []
    for k in range(n):
        g = draw.randrange(groups)
        rows.append((Decimal(k // doc_lines * 2**31 + k % doc_lines), f"g{g}", g, k // doc_lines, k % doc_lines,
                     "" if draw.random() < 0.2 else f"line number {k}"))
    return spark.createDataFrame(rows, "line_id decimal(29,0), grp string, grp_idx int, doc_id long, piece long, text string").repartition(4), rows


@pytest.mark.parametrize("n", [0, 1, 37, 5000])
@pytest.mark.parametrize("with_doc", [True, False])
def test_caps_equal_sorting(spark, monkeypatch, n, with_doc):
    import functools
    monkeypatch.setattr(ops, "cuts", functools.partial(cuts, bins=5))
    df, rows = lines(spark, 400)
    df = df if with_doc else df.drop("doc_id", "piece")
    kept = sorted((g, i, t) for i, _, g, _, _, t in rows if t)[:n]
    got = sorted((int(r.line_id), r.grp_idx, r.text) for r in ops.cap_first_n(df, n).collect())
    assert got == [(k, g, t) for k, (g, _, t) in enumerate(kept, 1)]
    turns = []
    for g in range(3):
        turns += [(k, g, t) for k, (_, t) in enumerate(sorted((i, t) for i, _, h, _, _, t in rows if h == g))]
    taken = [x for x in sorted(turns) if x[2]][:n]
    got = sorted((int(r.line_id), r.grp_idx, r.text) for r in ops.cap_round_robin(df, n).collect())
    assert got == [(k, g, t) for k, (_, g, t) in enumerate(taken, 1)]


@pytest.mark.parametrize("n", [0, 20, 1000])
def test_samples_equal_sorting(spark, monkeypatch, n):
    import functools
    import hashlib
    monkeypatch.setattr(ops, "cuts", functools.partial(cuts, bins=4))
    df, rows = lines(spark, 300)
    kept = [(hashlib.md5(f"42:{i}".encode()).hexdigest(), i, g, t) for i, g, _, _, _, t in rows if len(t) >= 2]
    want = [(k, i, t[:-1], t[-1]) for k, (_, i, _, t) in enumerate(sorted(kept)[:n], 1)]
    assert sorted((r.qid, int(r.line_id), r.text, r.answer) for r in ops.dev_random(df, n).collect()) == want
    chosen = [x for g in ("g0", "g1", "g2") for x in sorted(y for y in kept if y[2] == g)[:n]]
    order = sorted((hashlib.md5(f"42#{i}".encode()).hexdigest(), i, t) for _, i, _, t in chosen)
    want = [(k, i, t[:-1], t[-1]) for k, (_, i, t) in enumerate(order, 1)]
    assert sorted((r.qid, int(r.line_id), r.text, r.answer) for r in ops.dev_balanced(df, n).collect()) == want
