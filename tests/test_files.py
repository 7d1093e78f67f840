"""File sources and sinks against Python's own reading semantics."""

import os
import tempfile
import unicodedata

import pytest
from pyspark.sql import functions as F

from bruteforce import TinyModel
from charloom.plans.model import CharModel, ModelParams
from charloom.sources import files


def _py_lines(path):
    with open(path, "rt", encoding="utf-8", errors="ignore") as h:
        return [unicodedata.normalize("NFC", line.rstrip("\n")) for line in h]


def _read_parts(spark, path):
    """Lines of a written folder, in order."""
    return [r.answer for r in files.read_answers(spark, path).orderBy("qid").collect()]


def test_paths_that_need_care(spark):
    d = tempfile.mkdtemp(prefix="charloom-paths-")
    a = _write(d, "a b é.txt", b"one\ntwo\n")
    b = "file://" + _write(d, "plain.txt", b"three\n")
    got = [r.text for r in files.read_corpus(spark, [a, b, a]).orderBy("line_id").collect()]
    assert got == ["one", "two", "three", "one", "two"]
    hidden = _write(d, "_hidden.txt", b"lost\n")
    with pytest.raises(ValueError):
        files.read_corpus(spark, [a, hidden])
    with pytest.raises(FileNotFoundError):
        files.read_inputs(spark, os.path.join(d, "none"))


def test_load_order_and_a_path_listed_twice(spark):
    from charloom.operators import corpus as C
    d = tempfile.mkdtemp(prefix="charloom-order-")
    a, b = _write(d, "a", b"l1\nl2\nl3\n"), _write(d, "b", b"m1\nm2\nm3\n")
    lines = files.read_corpus(spark, [a, b, a], keep_blank=True)
    got = C.load_capped(lines, 5, balanced=True).orderBy("line_id").collect()
    assert [r.text for r in got] == ["l1", "m1", "l1", "l2", "m2"]
    x, y = _write(d, "x", b"xa\nxb\nxc\n"), _write(d, "y", b"xd\nxe\nxf\n")
    taken = C.load_capped(files.read_corpus(spark, [x, y], keep_blank=True), 4, balanced=True)
    model = CharModel.fit(taken, ModelParams(ngram_order=2, max_chars_per_context=2, min_context_count=1))
    tiny = TinyModel(2, 1.0, 2, 1).fit(["xa", "xd", "xb", "xe"])
    assert {(r.context, r.ch) for r in model.context_chars.collect()} == {(c, ch) for c, t in tiny.ctx.items() for ch in t} == {("x", "a"), ("x", "d")}


def _write(d, name, data: bytes):
    p = os.path.join(d, name)
    with open(p, "wb") as h:
        h.write(data)
    return p


def test_read_corpus_matches_python(spark):
    d = tempfile.mkdtemp(prefix="charloom-files-")
    a = _write(d, "a.txt", b"first line\nab\xffc\r\nx\ry\n\n   \nc\xcc\x81 mark\nlast no newline")
    b = _write(d, "b.txt", "zq😀x\n\nsecond\n".encode())
    corpus = files.read_corpus(spark, [a, b, os.path.join(d, "missing.txt"), a])
    got = [r.text for r in corpus.orderBy("line_id").collect()]
    exp = [t for p in (a, b, a) for t in _py_lines(p) if t]
    assert got == exp
    with_blank = files.read_corpus(spark, [a, b], keep_blank=True)
    assert [r.text for r in with_blank.orderBy("line_id").collect()] == _py_lines(a) + _py_lines(b)


def test_glob_resolution(spark):
    d = tempfile.mkdtemp(prefix="charloom-glob-")
    os.makedirs(os.path.join(d, "data", "sub"))
    os.makedirs(os.path.join(d, "data", ".d"))
    for rel in ("data/x.txt", "data/sub/y.txt", "data/z.csv", "data/.h.txt", "data/.d/k.txt"):
        _write(d, rel, b"hi\n")
    found = files.corpus_files(spark, patterns=[os.path.join(d, "data/**/*.txt")])
    assert [os.path.relpath(f, d) for f in found] == ["data/sub/y.txt", "data/x.txt"]
    assert files.corpus_files(spark, listed="a::b:a") == ["a", "b", "a"]
    assert files.corpus_files(spark, listed="hdfs://nn:8020/a.txt:b.txt:s3a://k/c") == ["hdfs://nn:8020/a.txt", "b.txt", "s3a://k/c"]
    assert files.corpus_files(spark, patterns=[os.path.join(d, "nope/*.txt")]) == [files.FALLBACK_FILE]


def test_inputs_answers_predictions_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="charloom-io-")
    train = _write(d, "train.txt", "the cat sat on the mat\nthe hat\nthat is that\n".encode())
    inp = _write(d, "input.txt", "the \n\nth\nc\xcc\x81".encode())
    ans = _write(d, "answer.txt", b"c\nx\na\nd\n")
    model = CharModel.fit(files.read_corpus(spark, [train]), ModelParams(ngram_order=3, min_context_count=1))
    inputs = files.read_inputs(spark, inp)
    assert [r.text for r in inputs.orderBy("qid").collect()] == _py_lines(inp)
    preds = model.predict(inputs)
    out = os.path.join(d, "pred")
    files.write_predictions(preds, out, partitions=3)
    lines = _read_parts(spark, out)
    assert lines == [r.pred for r in preds.orderBy("qid").collect()]
    assert len(lines) == 4 and all(len(x) == 3 for x in lines)
    answers = files.read_answers(spark, ans)
    assert [r.answer for r in answers.orderBy("qid").collect()] == ["c", "x", "a", "d"]


def test_write_dev_set_aligned(spark):
    d = tempfile.mkdtemp(prefix="charloom-dev-")
    dev = spark.range(50).select(F.col("id").alias("qid"), F.concat(F.lit("line\r"), F.col("id").cast("string")).alias("text"),
                                 (F.col("id") % 10).cast("string").alias("answer"))
    files.write_dev_set(dev, d, partitions=4)
    assert _read_parts(spark, os.path.join(d, "dev_input")) == [f"line {i}" for i in range(50)]
    assert _read_parts(spark, os.path.join(d, "dev_answer")) == [str(i % 10) for i in range(50)]


def test_write_prepared_and_results(spark):
    from charloom.operators import corpus as C
    d = tempfile.mkdtemp(prefix="charloom-out-")
    rows = spark.createDataFrame([(1, "en", "Hello   world!"), (2, "de", "Guten\nTag zusammen"), (3, "en", "short"),
                                  (4, "en", "Another fine line")], "doc_id long, lang string, text string")
    prepared = C.prepare(rows, 5, 10, 1000)
    files.write_prepared(prepared, os.path.join(d, "prep"))
    en = _read_parts(spark, os.path.join(d, "prep", "grp=en"))
    de = _read_parts(spark, os.path.join(d, "prep", "grp=de"))
    assert sorted(en) == ["Another fine line", "Hello world!"] and de == ["Guten Tag zusammen"]
    res = spark.createDataFrame([(0, 0.5, 2), (1, 0.9, 1)], "grid_idx long, dev_acc double, rank long")
    files.write_results(res, os.path.join(d, "res"))
    back = spark.read.option("header", True).csv(os.path.join(d, "res")).collect()
    assert [r.grid_idx for r in back] == ["1", "0"]
    typed = files.read_results(spark, os.path.join(d, "res"), "grid_idx long, dev_acc double, rank long")
    assert sorted(tuple(r) for r in typed.collect()) == [(0, 0.5, 2), (1, 0.9, 1)]
    with pytest.raises(Exception):
        files.read_results(spark, os.path.join(d, "res"), "rank long, dev_acc double, grid_idx long").collect()


def test_grade_from_files(spark):
    from charloom.operators import evaluate
    d = tempfile.mkdtemp(prefix="charloom-grade-")
    preds = _write(d, "pred.txt", "abc\n e \nXYZ\nİab\nqqqq\n".encode())
    gold = _write(d, "answer.txt", "b\ne\nz\ni\nq\nw\n".encode())
    p = files.read_lines(spark, [preds]).selectExpr("line_no AS qid", "text AS pred")
    g = files.read_answers(spark, gold)
    row = evaluate.grade(p, g).first()
    # caseless; 'İ' lowercases to two code points before the cut; the sixth
    # answer has no prediction and counts as a miss
    exp = ["b" in "abc", "e" in " e ", "z" in "xyz", "i" in "İab".lower()[:3], "q" in "qqq", False]
    assert (row.correct, row.total) == (sum(exp), 6)


def test_a_manifest_guards_the_parts(spark):
    import glob
    import shutil
    d = tempfile.mkdtemp(prefix="charloom-manifest-")
    out = os.path.join(d, "pred")
    preds = spark.range(40).select(F.col("id").alias("qid"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("pred"))
    files.write_predictions(preds, out, partitions=4)
    manifest = spark.read.parquet(os.path.join(out, files.MANIFEST)).collect()
    assert sum(r.n_rows for r in manifest) == 40
    assert [r.pred for r in files.read_predictions(spark, out).orderBy("qid").collect()] == [f"p{k}" for k in range(40)]
    part = sorted(glob.glob(os.path.join(out, "part-*.txt")))[1]
    kept = os.path.join(d, "kept")
    shutil.copy(part, kept)
    for check in glob.glob(os.path.join(out, ".part-*.crc")):
        os.remove(check)  # the local file system's own guard
    with open(part, "a") as f:
        f.write("one more\n")
    with pytest.raises(ValueError, match="manifest"):
        files.read_predictions(spark, out)
    shutil.copy(kept, part)
    shutil.copy(part, part.replace("part-", "part-9"))
    with pytest.raises(ValueError, match="manifest"):
        files.read_predictions(spark, out)


def test_empty_folders_and_files(spark):
    d = tempfile.mkdtemp(prefix="charloom-empty-")
    none = spark.createDataFrame([], "qid long, pred string")
    files.write_predictions(none, os.path.join(d, "pred"))
    assert files.read_predictions(spark, os.path.join(d, "pred")).collect() == []
    empty = _write(d, "empty.txt", b"")
    assert files.read_corpus(spark, [empty]).collect() == []
    assert files.read_corpus(spark, []).collect() == []
    assert files.read_inputs(spark, empty).collect() == []


def test_prepared_folders_are_groups(spark):
    d = tempfile.mkdtemp(prefix="charloom-prepared-")
    rows = [(g, k, f"{g}/{k} line") for g in ("en", "a b=c", "01") for k in range(30)] + [(None, k, f"none {k}") for k in range(3)]
    df = spark.createDataFrame(rows, "grp string, row_id long, text string").repartition(3)
    files.write_prepared(df, os.path.join(d, "prep"))
    got = files.read_prepared(spark, os.path.join(d, "prep"))
    assert [(r.grp, r.grp_idx, r.text) for r in got.orderBy("line_id").collect()] == [
        (g, i, t) for i, g in enumerate([None, "01", "a b=c", "en"]) for h, _, t in rows if h == g]
    with pytest.raises(FileNotFoundError):
        files.read_prepared(spark, os.path.join(d, "other"))


def test_a_corpus_is_one_scan_of_many_blocks(spark):
    d = tempfile.mkdtemp(prefix="charloom-blocks-")
    names = [_write(d, f"f{k}.txt", "".join(f"{k}:{i} " + "x" * (i % 50) + "\n" for i in range(400)).encode()) for k in range(3)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        corpus = files.read_corpus(spark, [names[2], names[0], names[1], names[0]])
        plan = corpus._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [value") == 1
        got = [r.text for r in corpus.orderBy("line_id").collect()]
        numbered = files.read_inputs(spark, names[1]).orderBy("qid").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [t for p in (names[2], names[0], names[1], names[0]) for t in _py_lines(p)]
    assert [(r.qid, r.text) for r in numbered] == list(enumerate(_py_lines(names[1])))


def test_train_and_test_from_files(spark):
    from charloom.plans import pipelines
    d = tempfile.mkdtemp(prefix="charloom-pipe-")
    a = _write(d, "a.txt", "the cat sat on the mat\n\nthe hat\n".encode())
    b = _write(d, "b.txt", "that is that\nthe end\n".encode())
    inp = _write(d, "input.txt", "the \n\nth\nzz".encode())
    params = ModelParams(ngram_order=3, min_context_count=1)
    pipelines.train(spark, os.path.join(d, "model"), [a, b], params=params, max_lines=3, balanced=True)
    tiny = TinyModel(3, 1.0, 64, 1).fit(["the cat sat on the mat", "that is that", "the end"])
    for table in (True, False):
        out = os.path.join(d, f"pred-{table}")
        pipelines.test(spark, os.path.join(d, "model"), inp, out, guess_table=table)
        assert _read_parts(spark, out) == [tiny.predict(t) for t in ("the ", "", "th", "zz")]


def test_compare_checks_sizes_first(spark):
    from charloom.operators import evaluate
    inputs = spark.createDataFrame([(1, "a"), (2, "b")], "qid long, text string")
    gold = spark.createDataFrame([(1, "x")], "qid long, answer string")
    preds = spark.createDataFrame([(1, "x")], "qid long, pred string")
    assert evaluate.compare({"m": preds}, gold).first().correct == 1
    with pytest.raises(ValueError, match="Mismatched"):
        evaluate.compare({"m": preds}, gold, inputs=inputs)
