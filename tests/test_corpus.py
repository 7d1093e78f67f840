"""Corpus caps, samples and preparation (L1-L5, P1, P11, P12) against brute force."""

import re
import unicodedata

from pyspark.sql import Window
from pyspark.sql import functions as F

from charloom.operators import corpus as C
from charloom.operators.ranking import ordinal
from charloom.sources.tables import corpus_lines
from conftest import SF_SMALL


def _lines_by_group(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r.grp_idx, r.line_id)):
        groups.setdefault(r.grp_idx, []).append(r)
    return groups


def test_ordinal_equals_row_number(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    got = ordinal(df, [F.col("k")], partition_by=["g"], name="rn").select("g", "k", "rn")
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k"))).select("g", "k", "rn")
    assert sorted(got.collect()) == sorted(exp.collect())
    glob = ordinal(df, [F.col("k")], name="rn")
    assert sorted(r.rn for r in glob.collect()) == list(range(1, 5001))


def test_cap_first_n(spark, small_corpus):
    rows = small_corpus.collect()
    exp = [(r.doc_id, r.piece) for r in sorted(rows, key=lambda r: (r.grp_idx, r.line_id))][:700]
    got = C.cap_first_n(small_corpus, 700).orderBy("line_id").collect()
    assert [(r.doc_id, r.piece) for r in got] == exp
    assert C.cap_first_n(small_corpus, 0).count() == 0


def test_cap_round_robin(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    with_blank = corpus_lines(docs, keep_blank=True)
    groups = _lines_by_group(with_blank.collect())
    taken, turn = [], 0
    while len(taken) < 900 and any(turn < len(v) for v in groups.values()):
        for g in sorted(groups):
            if turn < len(groups[g]) and groups[g][turn].text:
                taken.append((groups[g][turn].doc_id, groups[g][turn].piece))
                if len(taken) >= 900:
                    break
        turn += 1
    got = C.cap_round_robin(with_blank, 900).orderBy("line_id").collect()
    assert [(r.doc_id, r.piece) for r in got] == taken


def test_prepare_matches_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {(r.grp, r.row_id): r.text for r in C.prepare(docs, 7, 10, 1000).collect()}
    exp, kept = {}, {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        t = re.sub(r"\s+", " ", unicodedata.normalize("NFC", r.text or "").replace("\n", " ")).strip()
        if 10 <= len(t) <= 1000 and kept.get(r.lang, 0) < 7:
            kept[r.lang] = kept.get(r.lang, 0) + 1
            exp[(r.lang, r.doc_id)] = t
    assert got == exp


def test_samples(spark, small_corpus):
    a = C.dev_random(small_corpus, 300, seed=42)
    rows = a.collect()
    assert len(rows) == 300 and sorted(r.qid for r in rows) == list(range(1, 301))
    assert len({r.line_id for r in rows}) == 300
    assert sorted(a.collect()) == sorted(C.dev_random(small_corpus, 300, seed=42).collect())
    assert {r.line_id for r in C.dev_random(small_corpus, 300, seed=7).collect()} != {r.line_id for r in rows}
    src = {r.line_id: r.text for r in small_corpus.collect()}
    assert all(src[r.line_id] == r.text + r.answer for r in rows)
    bal = C.dev_balanced(small_corpus, 25, seed=42)
    per = {r.grp: r.n for r in bal.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    stats = {r.grp: (r.taken, r.available) for r in C.dev_balanced_stats(small_corpus, 25).collect()}
    assert per == {g: t for g, (t, _) in stats.items()}
    assert C.holdout(small_corpus, a).count() == small_corpus.count() - 300


def test_load_capped_and_groups(spark, small_corpus):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    with_blank = corpus_lines(docs, keep_blank=True)
    assert C.load_capped(with_blank).count() == small_corpus.count()
    first = {r.line_id for r in C.load_capped(with_blank, 400).collect()}
    assert first == {r.line_id for r in C.cap_first_n(small_corpus, 400).collect()}
    rr = {r.line_id for r in C.load_capped(with_blank, 400, balanced=True).collect()}
    assert rr == {r.line_id for r in C.cap_round_robin(with_blank, 400).collect()}
    one_group = with_blank.where(F.col("grp") == "en")
    assert {r.line_id for r in C.load_capped(one_group, 50, balanced=True).collect()} == \
        {r.line_id for r in C.cap_first_n(one_group.where(F.col("text") != ""), 50).collect()}
    groups = C.resolve_groups(docs, ["src1*", "*5"], "source").orderBy("grp_idx").collect()
    names = sorted({r.source for r in docs.select("source").distinct().collect()
                    if r.source.startswith("src1") or r.source.endswith("5")})
    assert [g.grp for g in groups] == names and [g.grp_idx for g in groups] == list(range(len(names)))


def test_dev_random_normalize_first(spark):
    rows = spark.createDataFrame([(1, "g", "ab"), (2, "g", "ć"), (3, "g", "xyz")],
                                 "line_id long, grp string, text string")
    raw = {r.line_id: (r.text, r.answer) for r in C.dev_random(rows, 10).collect()}
    nf = {r.line_id: (r.text, r.answer) for r in C.dev_random(rows, 10, normalize_first=True).collect()}
    assert raw[2] == ("c", "́") and 2 not in nf and nf[1] == ("a", "b")


def test_ordinal_on_shuffled_input(spark):
    # Input straight out of an aggregation (row order inside shuffle partitions is
    # not fixed, AQE may coalesce): ranks must still equal row_number().
    agg = spark.range(0, 300_000, 1, 12).groupBy((F.col("id") * 7919 % 40_000).alias("k")).agg(
        F.count("*").alias("n"), F.sum("id").alias("s"))
    order = [F.col("s").desc(), F.col("k").asc()]
    got = {r.k: r.rn for r in ordinal(agg, order, name="rn").collect()}
    exp = {r.k: r.rn for r in agg.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == exp
