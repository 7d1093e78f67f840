"""Registered queries (driver contract) and their DuckDB oracles.

Every query reads the fixture tables of ``sf_dir`` whole: the corpus is all of
``documents`` split into lines, the dev inputs are all ``conversations`` turns
(text minus its last character, the answer).  Query parameters are fixed here.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.functions.text import decode_ignore, nfc
from charloom.operators import corpus as corpus_ops
from charloom.operators import evaluate
from charloom.operators.counts import unpack_line, unpack_position
from charloom.operators.scoring import base_score
from charloom.operators.trim import context_totals, trim
from charloom.plans import oracle as O
from charloom.plans.model import CharModel, ModelParams, count_corpus
from charloom.session import allow_python_join_keys
from charloom.plans import pipelines
from charloom.sources import files, model_io
from charloom.sources.tables import corpus_lines

# Fixed query parameters.
SMALL = ModelParams(ngram_order=3, laplace_alpha=1.0, max_chars_per_context=8,
                    min_context_count=3, max_contexts=2000, kn_discount=0.75)
BASELINE = ModelParams(ngram_order=6, laplace_alpha=1.0, max_chars_per_context=48,
                       min_context_count=5, max_contexts=300_000, kn_discount=0.75)
KN_INITIAL = ModelParams(ngram_order=6, laplace_alpha=0.01, max_chars_per_context=48,
                         min_context_count=3, max_contexts=500_000, kn_discount=0.5)
PREP_LINES, PREP_MIN, PREP_MAX = 100, 10, 1000
CAP_LINES = 3000
DEV_SIZE, DEV_SEED, PER_GROUP = 500, 42, 60
GROUP_PATTERNS = ["src1*", "*5"]
PRUNE = (5, 800, 4)
RETRIM = (10, 600)
ROUND = 9


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    allow_python_join_keys(spark)
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def _corpus(spark, sf, keep_blank=False, normalize=True) -> DataFrame:
    return corpus_lines(_t(spark, sf, "documents"), keep_blank=keep_blank, normalize=normalize)


def _dev(spark, sf) -> DataFrame:
    conv = _t(spark, sf, "conversations")
    from charloom.functions.text import drop_last_char, last_char, nfc
    base = conv.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("qid"),
                       nfc("text").alias("_t")).where(F.length("_t") >= 2)
    return base.select("qid", drop_last_char("_t").alias("text"), last_char("_t").alias("answer"))


def _first(df: DataFrame, col: str = "first_seen") -> list:
    u = unpack_position(col)
    line = unpack_line(u["line_id"])
    return [line["doc_id"].alias("first_doc_id"), line["piece"].alias("first_piece"), u["pos"].alias("first_pos")]


def _model(spark, sf, params: ModelParams) -> CharModel:
    return CharModel.fit(_corpus(spark, sf), params)


def _cc_cols(df: DataFrame) -> DataFrame:
    return df.select("context", "ch", "cnt", F.col("ctx_rank").cast("long").alias("ctx_rank"),
                     F.col("char_rank").cast("long").alias("char_rank"))


# ---------------------------------------------------------------- Spark side
def q_corpus_lines(spark, sf):
    return _corpus(spark, sf).select("doc_id", "piece", "grp", F.col("grp_idx").cast("long").alias("grp_idx"), "text")


def q_prepare_corpus(spark, sf):
    out = corpus_ops.prepare(_t(spark, sf, "documents"), PREP_LINES, PREP_MIN, PREP_MAX)
    return out.select("grp", "row_id", "text", F.col("kept_rank").cast("long").alias("kept_rank"))


def q_kept_per_lang(spark, sf):
    out = corpus_ops.prepare(_t(spark, sf, "documents"), PREP_LINES, PREP_MIN, PREP_MAX)
    return out.groupBy("grp").agg(F.count(F.lit(1)).cast("long").alias("kept"))


def q_cap_first_n(spark, sf):
    # NFC is left to the lines that are kept, so that bounds on the document reach the scan.
    out = corpus_ops.cap_first_n(_corpus(spark, sf, keep_blank=True, normalize=False), CAP_LINES)
    return out.select("doc_id", "piece", "grp", "take_rank", nfc("text").alias("text"))


def q_cap_round_robin(spark, sf):
    out = corpus_ops.cap_round_robin(_corpus(spark, sf, keep_blank=True, normalize=False), CAP_LINES)
    return out.select("doc_id", "piece", "grp", "rr", "take_rank", nfc("text").alias("text"))


def q_distinct_groups(spark, sf):
    return corpus_ops.resolve_groups(_t(spark, sf, "documents"), GROUP_PATTERNS, "source")


def _with_doc(dev: DataFrame) -> DataFrame:
    line = unpack_line("line_id")
    return dev.select("qid", line["doc_id"].alias("doc_id"), line["piece"].alias("piece"), "grp", "text", "answer")


def q_dev_random(spark, sf):
    return _with_doc(corpus_ops.dev_random(_corpus(spark, sf), DEV_SIZE, DEV_SEED))


def q_dev_balanced(spark, sf):
    return _with_doc(corpus_ops.dev_balanced(_corpus(spark, sf), PER_GROUP, DEV_SEED))


def q_dev_balanced_stats(spark, sf):
    return corpus_ops.dev_balanced_stats(_corpus(spark, sf), PER_GROUP)


def q_holdout_corpus(spark, sf):
    c = _corpus(spark, sf)
    return corpus_ops.holdout(c, corpus_ops.dev_random(c, DEV_SIZE, DEV_SEED)).select("doc_id", "piece", "grp", "text")


def q_unigram_counts(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 3)
    return raw.unigram.select("ch", "cnt", *_first(raw.unigram))


def q_context_counts(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 3)
    return raw.pairs.select("context", F.col("ctx_len").cast("long").alias("ctx_len"), "ch", "cnt",
                            *_first(raw.pairs))


def q_whole_doc_context_counts(spark, sf):
    docs = corpus_lines(_t(spark, sf, "documents"), split_lines=False)
    raw = count_corpus(docs, 3)
    return raw.pairs.select("context", F.col("ctx_len").cast("long").alias("ctx_len"), "ch", "cnt",
                            *_first(raw.pairs))


def q_continuation_counts(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 3)
    return raw.continuation.select("ch", "cont", *_first(raw.continuation))


def q_bigram_totals(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 2)
    cont = raw.continuation.agg(F.sum("cont").cast("long").alias("total_bigram_types"),
                                F.count(F.lit(1)).cast("long").alias("continuation_vocab"))
    uni = raw.unigram.agg(F.count(F.lit(1)).cast("long").alias("unigram_vocab"),
                          F.sum("cnt").cast("long").alias("unigram_total"))
    # Two one-row aggregates side by side.
    return cont.withColumn("_k", F.lit(1)).join(uni.withColumn("_k", F.lit(1)), "_k").drop("_k")


def q_context_totals(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 3)
    t = context_totals(raw.pairs).where(F.col("total") >= 5)
    return t.select("context", F.col("ctx_len").cast("long").alias("ctx_len"), "total", "n_types")


def q_top_contexts(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 3)
    t = trim(raw.pairs, 2, 500, 1_000_000)
    return t.select("context", "ctx_rank").distinct().join(
        context_totals(raw.pairs).select("context", "total"), "context")


def q_top_chars_per_context(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 3)
    t = trim(raw.pairs, 1, 0, 3)
    return t.select("context", "ch", "cnt", F.col("char_rank").cast("long").alias("char_rank"))


def q_trimmed_model(spark, sf):
    return _cc_cols(_model(spark, sf, SMALL).context_chars)


def q_frequent_chars(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 2)
    from charloom.operators.ranking import top_n_exact
    top = top_n_exact(raw.unigram, 48, [F.col("cnt").desc(), F.col("first_seen").asc()], name="freq_rank")
    return top.select("ch", "cnt", "freq_rank")


def q_default_chars(spark, sf):
    m = _model(spark, sf, SMALL)
    rows = [(i, c) for i, c in enumerate(m.default_chars)]
    # The list is derived from the corpus (bounded by max_chars_per_context + 9).
    return spark.createDataFrame(rows, "idx long, ch string")


def q_kn_base(spark, sf):
    m = _model(spark, sf, SMALL)
    return m.base().select("ch", F.round("b", ROUND).alias("b"))


def q_base_ranking(spark, sf):
    m = _model(spark, sf, SMALL)
    from charloom.operators.ranking import ordinal
    return ordinal(m.base(), [F.col("b").desc(), F.col("first_seen").asc()], name="base_rank").select("ch", "base_rank")


def q_add_alpha_base(spark, sf):
    raw = count_corpus(_corpus(spark, sf), 2)
    agg = raw.unigram.agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("v")).first()
    den = int(agg["n"]) + SMALL.laplace_alpha * max(1, int(agg["v"]))
    return raw.unigram.select("ch", F.round(base_score(F.col("cnt"), SMALL.laplace_alpha, den), ROUND).alias("b"))


def q_context_levels(spark, sf):
    from charloom.operators.scoring import level_rows
    m = _model(spark, sf, SMALL)
    out = level_rows(m.levels(), SMALL.kn_discount)
    return out.select("context", F.round("lambda", ROUND).alias("lambda"), "ch", F.round("d", ROUND).alias("d"))


def q_input_suffixes(spark, sf):
    dev = _dev(spark, sf)
    sfx = F.right("text", F.lit(BASELINE.ngram_order - 1))
    return dev.groupBy(sfx.alias("sfx")).agg(F.count(F.lit(1)).cast("long").alias("n_inputs"))


def q_suffix_hits(spark, sf):
    from charloom.operators.predict import suffix_contexts
    m = _model(spark, sf, SMALL)
    sfx = _dev(spark, sf).select(F.right("text", F.lit(SMALL.ngram_order - 1)).alias("sfx")).distinct()
    sc = suffix_contexts(sfx).where(F.col("context").isNotNull())
    lv = m.levels().select("context", "total")
    return sc.join(lv, "context").select("sfx", F.col("L").cast("long").alias("ctx_len"), "context", "total")


def q_predict_top3(spark, sf):
    return _model(spark, sf, SMALL).predict(_dev(spark, sf)).select("qid", "pred")


def q_suffix_links(spark, sf):
    links = _model(spark, sf, SMALL).suffix_links()
    return links.select("context", "link", F.size("lens").cast("long").alias("n_stored"))


def q_predict_prepared(spark, sf):
    """Every stored context scored once; inputs look theirs up."""
    return _model(spark, sf, SMALL).prepare(3, guess_table=True).predict(_dev(spark, sf)).select("qid", "pred")


def q_predict_baseline_order6(spark, sf):
    return _model(spark, sf, BASELINE).predict(_dev(spark, sf)).select("qid", "pred")


def q_grade(spark, sf):
    dev = _dev(spark, sf)
    return evaluate.grade(_model(spark, sf, SMALL).predict(dev), dev)


def q_grade_verbose(spark, sf):
    dev = _dev(spark, sf)
    return evaluate.grade_rows(_model(spark, sf, SMALL).predict(dev), dev)


def q_compare_models(spark, sf):
    dev = _dev(spark, sf)
    c = _corpus(spark, sf)
    raw = count_corpus(c, 6)
    a = CharModel.from_counts(raw, BASELINE).predict(dev)
    b = CharModel.from_counts(raw, KN_INITIAL).predict(dev)
    cmp = evaluate.compare({"baseline": a, "kn_initial": b}, dev)
    return cmp.select("model", "correct", "total", "acc")


def q_compare_winner(spark, sf):
    cmp = q_compare_models(spark, sf).withColumn(
        "model_order", F.when(F.col("model") == "baseline", 0).otherwise(1))
    return evaluate.winner(cmp)


def q_prune_model(spark, sf):
    return _cc_cols(_model(spark, sf, SMALL).prune(*PRUNE).context_chars)


def q_retrim_model(spark, sf):
    return _cc_cols(_model(spark, sf, SMALL).retrim(*RETRIM).context_chars)


def q_model_stats(spark, sf):
    return _model(spark, sf, SMALL).stats()


def q_model_roundtrip(spark, sf):
    m = _model(spark, sf, SMALL)
    path = model_io.scratch_path(spark, "model_roundtrip")
    model_io.save(m, path)
    return _cc_cols(model_io.load(spark, path).context_chars)


def q_decode_ignore(spark, sf):
    d = _t(spark, sf, "documents")
    # A lone lead byte in front and a byte that UTF-8 never uses behind; both go.
    dirty = F.concat(F.unhex(F.lit("C3")), F.col("text").cast("binary"), F.unhex(F.lit("FF")))
    return d.select("doc_id", F.md5(decode_ignore(dirty).cast("binary")).alias("text_md5"))


def q_wide_ids_context_counts(spark, sf):
    far = _t(spark, sf, "documents").withColumn("doc_id", (F.col("doc_id") - 300) * 100_000_000_000)
    raw = count_corpus(corpus_lines(far), 3)
    return raw.pairs.select("context", F.col("ctx_len").cast("long").alias("ctx_len"), "ch", "cnt", *_first(raw.pairs))


def _capped(spark, sf, balanced: bool) -> DataFrame:
    return corpus_ops.load_capped(_corpus(spark, sf, keep_blank=True, normalize=False), CAP_LINES, balanced, normalize=True)


def q_fit_first_n(spark, sf):
    return _cc_cols(CharModel.fit(_capped(spark, sf, False), SMALL).context_chars)


def q_fit_balanced(spark, sf):
    return _cc_cols(CharModel.fit(_capped(spark, sf, True), SMALL).context_chars)


def q_predict_balanced(spark, sf):
    return CharModel.fit(_capped(spark, sf, True), SMALL).predict(_dev(spark, sf)).select("qid", "pred")


def q_grade_missing(spark, sf):
    """A third of the predictions missing, and predictions for unknown ids."""
    dev = _dev(spark, sf)
    preds = _model(spark, sf, SMALL).predict(dev).select("qid", "pred")
    part = preds.where(F.substring_index("qid", ":", 1).cast("long") % 3 != 0)
    more = preds.select(F.concat(F.lit("x"), "qid").alias("qid"), "pred")
    return evaluate.grade(part.unionByName(more), dev)


def q_predict_edge(spark, sf):
    """M7, M8: turns made blank, newline-only or null by their number, five guesses."""
    dev = _dev(spark, sf)
    turn = F.substring_index("qid", ":", -1).cast("int") % 4
    odd = dev.withColumn("text", F.when(turn == 0, "").when(turn == 1, F.lit(None)).otherwise(F.col("text")))
    return _model(spark, sf, SMALL).predict(odd, k=5).select("qid", "pred")


def _single_chars(spark, sf) -> DataFrame:
    """One-character lines: the first character of every line of the corpus."""
    return _corpus(spark, sf).withColumn("text", F.substring("text", 1, 1))


def q_predict_add_alpha(spark, sf):
    """M2: no bigram exists, so the base is the add-alpha unigram."""
    return CharModel.fit(_single_chars(spark, sf), SMALL).predict(_dev(spark, sf)).select("qid", "pred")


def _bench_examples(spark, sf) -> DataFrame:
    from charloom.sources.tables import dev_from_table
    return dev_from_table(_t(spark, sf, "benchmark"))


def q_grid_accuracy(spark, sf):
    from charloom.plans import tune
    return tune.grid_search(_corpus(spark, sf), {"ex": _bench_examples(spark, sf)}, _dev(spark, sf),
                            grid=tune.SMALL_GRID)


def _written_lines(spark, sf, name: str) -> str:
    """All lines of ``documents``, blank ones too, as a folder of text files per language."""
    path = model_io.scratch_path(spark, name)
    lines = _corpus(spark, sf, keep_blank=True, normalize=False)
    files.write_prepared(lines.select("grp", F.col("line_id").alias("row_id"), "text"), path)
    return path


def _numbered_in_group(corpus: DataFrame) -> DataFrame:
    from charloom.operators.ranking import ordinal
    return ordinal(corpus, [F.col("line_id")], partition_by=["grp_idx"], name="place")


def q_read_corpus(spark, sf):
    """The written part files found by a glob, read as a corpus in one scan; the
    language is part of a file's path."""
    path = _written_lines(spark, sf, "read_corpus")
    found = files.corpus_files(spark, patterns=[f"{path}/**/*.txt"])
    corpus = files.read_corpus(spark, found)
    by_lang = corpus.withColumn("grp", F.regexp_extract("grp", "grp=([^/]*)/", 1))
    numbered = _numbered_in_group(by_lang.withColumn("grp_idx", F.col("grp")))
    return numbered.select("grp", "place", "text")


def q_read_prepared(spark, sf):
    """A language folder of several part files is one group."""
    corpus = files.read_prepared(spark, _written_lines(spark, sf, "read_prepared"))
    return _numbered_in_group(corpus).select("grp", F.col("grp_idx").cast("long").alias("grp_idx"), "place", "text")


def q_prepared_roundtrip(spark, sf):
    """P1, S10 and back."""
    path = model_io.scratch_path(spark, "prepared")
    files.write_prepared(corpus_ops.prepare(_t(spark, sf, "documents"), PREP_LINES, PREP_MIN, PREP_MAX), path)
    numbered = _numbered_in_group(files.read_prepared(spark, path))
    return numbered.select("grp", F.col("place").alias("kept_rank"), "text")


def q_write_read_grade(spark, sf):
    """Dev set and predictions are written, read back, checked
    against their manifests and each other, and graded."""
    dev = _dev(spark, sf)
    path = model_io.scratch_path(spark, "dev")
    files.write_dev_set(dev, path)
    inputs, answers = files.read_inputs(spark, f"{path}/dev_input"), files.read_answers(spark, f"{path}/dev_answer")
    evaluate.require_aligned(inputs, answers)
    files.write_predictions(_model(spark, sf, SMALL).predict(inputs), f"{path}/dev_pred")
    preds = files.read_predictions(spark, f"{path}/dev_pred")
    evaluate.require_aligned(inputs, preds)
    return evaluate.grade(preds, answers)


def q_train_test_files(spark, sf):
    """From files to files: a balanced, capped corpus is read from language folders, a model
    fitted and saved; then loaded, the written inputs predicted, the output graded."""
    path = model_io.scratch_path(spark, "train_test")
    pipelines.train(spark, f"{path}/model", prepared=_written_lines(spark, sf, "train"), params=SMALL,
                    max_lines=CAP_LINES, balanced=True)
    files.write_dev_set(_dev(spark, sf), path)
    pipelines.test(spark, f"{path}/model", f"{path}/dev_input", f"{path}/dev_pred")
    return evaluate.grade(files.read_predictions(spark, f"{path}/dev_pred"), files.read_answers(spark, f"{path}/dev_answer"))


def q_grid_results_roundtrip(spark, sf):
    """The ranked grid results, written and read back with their types."""
    path = model_io.scratch_path(spark, "grid_results")
    files.write_results(q_grid_accuracy(spark, sf), path)
    return files.read_results(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


# --------------------------------------------------------------- DuckDB side
def _cfg_ctes(p: ModelParams, name: str) -> list[str]:
    return [O.pairs_cte(p.ngram_order, f"{name}_pairs"),
            O.trim_ctes(f"{name}_pairs", f"{name}_trim", p.min_context_count, p.max_contexts,
                        p.max_chars_per_context, ranked=False)]


def _model_sql(p: ModelParams, name: str, with_predict: bool = True) -> list[str]:
    ctes = _cfg_ctes(p, name)
    ctes.append(O.base_ctes(p.laplace_alpha, f"{name}_base"))
    ctes.append(O.defaults_cte(p.max_chars_per_context, f"{name}_def"))
    ctes.append(O.level_ctes(f"{name}_trim", p.kn_discount, f"{name}_lv"))
    if with_predict:
        ctes.append(O.predict_ctes("dev", p.ngram_order, f"{name}_lv", f"{name}_base", f"{name}_def", 3,
                                   f"{name}_pred"))
    return ctes


def _head(order: int, keep_blank: bool = False, dev: bool = False) -> list[str]:
    out = [O.lines_cte(keep_blank), O.seq_cte(order - 1), O.counts_ctes()]
    if dev:
        out.append(O.conv_inputs_cte("dev"))
    return out


FIRST = "fs.d AS first_doc_id, fs.p AS first_piece, fs.i AS first_pos"
CC = "SELECT context, ch, cnt, ctx_rank, char_rank FROM {t}"


def _ws(ctes, select):
    return O.with_(*ctes, select=select)


def oracle_sql() -> dict[str, str]:
    clean = (f"trim(regexp_replace(replace(nfc_normalize(coalesce(text, '')), chr(10), ' '), "
             f"'{_PY_WS}+', ' ', 'g'))")
    prep = f"""
prep AS (
  SELECT lang AS grp, doc_id AS row_id, {clean} AS text FROM documents),
prep_kept AS (
  SELECT grp, row_id, text, CAST(row_number() OVER (PARTITION BY grp ORDER BY row_id) AS BIGINT) AS kept_rank
  FROM prep WHERE length(text) BETWEEN {PREP_MIN} AND {PREP_MAX}
  QUALIFY kept_rank <= {PREP_LINES})"""
    dev_random = f"""
dr AS (
  SELECT line_id, doc_id, piece, grp, text AS line,
         CAST(row_number() OVER (ORDER BY md5('{DEV_SEED}:' || CAST(line_id AS VARCHAR)), line_id) AS BIGINT) AS qid
  FROM lines WHERE length(text) >= 2 QUALIFY qid <= {DEV_SIZE})"""
    s = SMALL
    q: dict[str, str] = {}
    q["corpus_lines"] = _ws([O.lines_cte()], "SELECT doc_id, piece, grp, grp_idx, text FROM lines")
    q["prepare_corpus"] = _ws([prep], "SELECT * FROM prep_kept")
    q["kept_per_lang"] = _ws([prep], "SELECT grp, CAST(count(*) AS BIGINT) AS kept FROM prep_kept GROUP BY grp")
    q["cap_first_n"] = _ws([O.lines_cte()], f"""
SELECT doc_id, piece, grp, CAST(row_number() OVER (ORDER BY grp_idx, doc_id, piece) AS BIGINT) AS take_rank, text
FROM lines QUALIFY take_rank <= {CAP_LINES}""")
    q["cap_round_robin"] = _ws([O.lines_cte(keep_blank=True)], f"""
SELECT doc_id, piece, grp, rr, CAST(row_number() OVER (ORDER BY rr, grp_idx) AS BIGINT) AS take_rank, text
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY grp ORDER BY doc_id, piece) AS BIGINT) AS rr FROM lines)
WHERE text <> '' QUALIFY take_rank <= {CAP_LINES}""")
    like = " OR ".join(f"source LIKE '{p.replace('*', '%')}'" for p in GROUP_PATTERNS)
    whole = "CAST(row_number() OVER (PARTITION BY grp ORDER BY doc_id, piece) AS BIGINT) AS place"
    q["read_corpus"] = _ws([O.lines_cte()], f"SELECT grp, {whole}, text FROM lines")
    q["read_prepared"] = _ws([O.lines_cte()], f"SELECT grp, grp_idx, {whole}, text FROM lines")
    q["prepared_roundtrip"] = _ws([prep], "SELECT grp, kept_rank, text FROM prep_kept")
    q["distinct_groups"] = f"""
SELECT grp, CAST(row_number() OVER (ORDER BY grp) - 1 AS BIGINT) AS grp_idx
FROM (SELECT DISTINCT source AS grp FROM documents WHERE {like})"""
    q["dev_random"] = _ws([O.lines_cte(), dev_random], """
SELECT qid, doc_id, piece, grp, substring(line, 1, length(line) - 1) AS text, right(line, 1) AS answer FROM dr""")
    q["dev_balanced"] = _ws([O.lines_cte()], f"""
SELECT CAST(row_number() OVER (ORDER BY md5('{DEV_SEED}#' || CAST(line_id AS VARCHAR)), line_id) AS BIGINT) AS qid,
       doc_id, piece, grp, substring(text, 1, length(text) - 1) AS text, right(text, 1) AS answer
FROM (SELECT * FROM lines WHERE length(text) >= 2
      QUALIFY row_number() OVER (PARTITION BY grp ORDER BY md5('{DEV_SEED}:' || CAST(line_id AS VARCHAR)), line_id)
              <= {PER_GROUP})""")
    q["dev_balanced_stats"] = _ws([O.lines_cte()], f"""
SELECT grp, CAST(least(count(*), {PER_GROUP}) AS BIGINT) AS taken, CAST(count(*) AS BIGINT) AS available
FROM lines WHERE length(text) >= 2 GROUP BY grp""")
    q["holdout_corpus"] = _ws([O.lines_cte(), dev_random],
                              "SELECT doc_id, piece, grp, text FROM lines WHERE line_id NOT IN (SELECT line_id FROM dr)")
    q["unigram_counts"] = _ws(_head(3), f"SELECT ch, cnt, {FIRST} FROM uni")
    q["context_counts"] = _ws(_head(3) + [O.pairs_cte(3)], f"SELECT context, ctx_len, ch, cnt, {FIRST} FROM pairs")
    q["whole_doc_context_counts"] = _ws([O.lines_cte(split_lines=False), O.seq_cte(2), O.counts_ctes(),
                                         O.pairs_cte(3)], f"SELECT context, ctx_len, ch, cnt, {FIRST} FROM pairs")
    q["continuation_counts"] = _ws(_head(3), f"SELECT ch, cont, {FIRST} FROM cont")
    q["bigram_totals"] = _ws(_head(2), """
SELECT CAST(t AS BIGINT) AS total_bigram_types, CAST(v_cont AS BIGINT) AS continuation_vocab,
       CAST(v_uni AS BIGINT) AS unigram_vocab, CAST(n_uni AS BIGINT) AS unigram_total FROM totals""")
    q["context_totals"] = _ws(_head(3) + [O.pairs_cte(3)], """
SELECT context, ctx_len, CAST(sum(cnt) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS n_types
FROM pairs GROUP BY context, ctx_len HAVING sum(cnt) >= 5""")
    q["top_contexts"] = _ws(_head(3) + [O.pairs_cte(3), O.trim_ctes("pairs", "tc", 2, 500, 1_000_000, False)], """
SELECT k.context, k.new_ctx_rank AS ctx_rank, CAST(t.total AS BIGINT) AS total
FROM tc_kept k JOIN tc_tot t USING (context)""")
    q["top_chars_per_context"] = _ws(_head(3) + [O.pairs_cte(3), O.trim_ctes("pairs", "tc", 1, 0, 3, False)],
                                     "SELECT context, ch, cnt, char_rank FROM tc")
    q["trimmed_model"] = _ws(_head(3) + _cfg_ctes(s, "m"), CC.format(t="m_trim"))
    q["model_roundtrip"] = q["trimmed_model"]
    q["frequent_chars"] = _ws(_head(2), """
SELECT ch, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, fs) AS BIGINT) AS freq_rank FROM uni
QUALIFY freq_rank <= 48""")
    q["default_chars"] = _ws(_head(2) + [O.defaults_cte(s.max_chars_per_context, "d")], """
SELECT CAST(generate_subscripts(chars, 1) - 1 AS BIGINT) AS idx, unnest(chars) AS ch FROM d""")
    q["kn_base"] = _ws(_head(2) + [O.base_ctes(s.laplace_alpha, "b")], f"SELECT ch, round(b, {ROUND}) AS b FROM b")
    q["base_ranking"] = _ws(_head(2) + [O.base_ctes(s.laplace_alpha, "b")], "SELECT ch, base_rank FROM b")
    a = O.dbl(s.laplace_alpha)
    q["add_alpha_base"] = _ws(_head(2), f"""
SELECT ch, round((CAST(cnt AS DOUBLE) + {a}) / (CAST((SELECT n_uni FROM totals) AS DOUBLE)
                 + {a} * CAST(greatest((SELECT v_uni FROM totals), 1) AS DOUBLE)), {ROUND}) AS b FROM uni""")
    q["context_levels"] = _ws(_head(3) + _model_sql(s, "m", with_predict=False), f"""
SELECT e.context, round(l.lam, {ROUND}) AS lambda, e.ch, round(e.d, {ROUND}) AS d
FROM m_lv_ent e JOIN m_lv_lam l USING (context)""")
    q["input_suffixes"] = _ws([O.conv_inputs_cte("dev")], f"""
SELECT right(text, {BASELINE.ngram_order - 1}) AS sfx, CAST(count(*) AS BIGINT) AS n_inputs FROM dev GROUP BY 1""")
    q["suffix_hits"] = _ws(_head(3, dev=True) + _model_sql(s, "m", with_predict=False), f"""
SELECT x.sfx, CAST(x.L AS BIGINT) AS ctx_len, right(x.sfx, x.L) AS context, CAST(c.total AS BIGINT) AS total
FROM (SELECT DISTINCT right(text, {s.ngram_order - 1}) AS sfx, unnest(range(1, length(right(text, {s.ngram_order - 1})) + 1)) AS L FROM dev) x
JOIN m_lv_ctx c ON c.context = right(x.sfx, x.L)""")
    q["predict_top3"] = _ws(_head(3, dev=True) + _model_sql(s, "m"), "SELECT qid, pred FROM m_pred")
    q["predict_prepared"] = q["predict_top3"]
    q["suffix_links"] = _ws(_head(3) + _model_sql(s, "m", with_predict=False), """
SELECT c.context, coalesce(max_by(d.context, length(d.context)), '') AS link, CAST(1 + count(d.context) AS BIGINT) AS n_stored
FROM m_lv_ctx c LEFT JOIN m_lv_ctx d ON suffix(c.context, d.context) AND length(d.context) < length(c.context)
GROUP BY c.context""")
    q["predict_baseline_order6"] = _ws(_head(6, dev=True) + _model_sql(BASELINE, "m"), "SELECT qid, pred FROM m_pred")
    grade_rows = """
gr AS (
  SELECT d.qid, lower(d.answer) AS gold, substring(lower(coalesce(p.pred, '')), 1, 3) AS pred
  FROM dev d LEFT JOIN m_pred p USING (qid))"""
    q["grade"] = _ws(_head(3, dev=True) + _model_sql(s, "m") + [grade_rows], """
SELECT CAST(count_if(contains(pred, gold)) AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(contains(pred, gold)) AS DOUBLE) / count(*) AS success_rate FROM gr""")
    q["grade_verbose"] = _ws(_head(3, dev=True) + _model_sql(s, "m") + [grade_rows],
                             "SELECT qid, gold, pred, contains(pred, gold) AS \"right\" FROM gr")
    q["compare_models"] = _ws(_head(6, dev=True) + _model_sql(BASELINE, "a") + _model_sql(KN_INITIAL, "b"), """
SELECT model, correct, total, CASE WHEN total > 0 THEN CAST(correct AS DOUBLE) / total ELSE 0.0 END AS acc FROM (
  SELECT 'baseline' AS model, CAST(count_if(contains(coalesce(p.pred, ''), d.answer)) AS BIGINT) AS correct,
         CAST(count(*) AS BIGINT) AS total FROM dev d LEFT JOIN a_pred p USING (qid)
  UNION ALL
  SELECT 'kn_initial', CAST(count_if(contains(coalesce(p.pred, ''), d.answer)) AS BIGINT),
         CAST(count(*) AS BIGINT) FROM dev d LEFT JOIN b_pred p USING (qid))""")
    q["compare_winner"] = q["compare_models"].replace(
        "\nSELECT model, correct, total,", "\n, cmp AS (SELECT model, correct, total,", 1) + """)
SELECT (SELECT model FROM cmp ORDER BY acc DESC, CASE model WHEN 'baseline' THEN 0 ELSE 1 END LIMIT 1)
         AS winner_by_acc,
       (SELECT max(acc) FROM cmp) AS acc"""
    q["prune_model"] = _ws(_head(3) + _cfg_ctes(s, "m") + [
        O.trim_ctes("m_trim", "pr", PRUNE[0], PRUNE[1], PRUNE[2], ranked=True)], CC.format(t="pr"))
    q["retrim_model"] = _ws(_head(3) + _cfg_ctes(s, "m") + [
        O.trim_ctes("m_trim", "rt", RETRIM[0], RETRIM[1], s.max_chars_per_context, ranked=True)], CC.format(t="rt"))
    q["model_stats"] = _ws(_head(3) + _cfg_ctes(s, "m"), """
SELECT CAST((SELECT count(DISTINCT context) FROM m_trim) AS BIGINT) AS contexts_stored,
       CAST((SELECT count(*) FROM m_trim) AS BIGINT) AS entries_stored,
       CAST(v_uni AS BIGINT) AS unigram_vocab_size, CAST(n_uni AS BIGINT) AS unigram_total,
       CAST(v_cont AS BIGINT) AS continuation_vocab_size, CAST(t AS BIGINT) AS total_bigram_types FROM totals""")
    q["grid_accuracy"] = _grid_sql()
    q["decode_ignore"] = "SELECT doc_id, md5(text) AS text_md5 FROM documents"
    far = "(SELECT * REPLACE ((doc_id - 300) * 100000000000 AS doc_id) FROM documents)"
    q["wide_ids_context_counts"] = _ws([O.lines_cte(table=far), O.seq_cte(2), O.counts_ctes(), O.pairs_cte(3)],
                                       f"SELECT context, ctx_len, ch, cnt, {FIRST} FROM pairs")
    for name, balanced in (("first_n", False), ("balanced", True)):
        head = [O.lines_cte(True, name="every"), O.capped_cte(CAP_LINES, balanced), O.seq_cte(2), O.counts_ctes()]
        q[f"fit_{name}"] = _ws(head + _cfg_ctes(s, "m"), CC.format(t="m_trim"))
    q["predict_balanced"] = _ws(head + [O.conv_inputs_cte("dev")] + _model_sql(s, "m"), "SELECT qid, pred FROM m_pred")
    # Written and read back: a line break inside a text has become a space.
    flat = """
dev AS (SELECT qid, regexp_replace(text, '[\r\n]', ' ', 'g') AS text, regexp_replace(answer, '[\r\n]', ' ', 'g') AS answer FROM conv)"""
    graded = q["grade"][q["grade"].rindex("SELECT CAST(count_if"):]
    written = [O.conv_inputs_cte("conv"), flat] + _model_sql(s, "m") + [grade_rows]
    q["write_read_grade"] = _ws(_head(3) + written, graded)
    q["train_test_files"] = _ws(head + written, graded)
    q["grid_results_roundtrip"] = q["grid_accuracy"]
    missing = """
m_part AS (SELECT * FROM m_pred WHERE CAST(split_part(qid, ':', 1) AS BIGINT) % 3 <> 0),
gr AS (
  SELECT d.qid, lower(d.answer) AS gold, substring(lower(coalesce(p.pred, '')), 1, 3) AS pred
  FROM dev d LEFT JOIN m_part p USING (qid))"""
    q["grade_missing"] = _ws(_head(3, dev=True) + _model_sql(s, "m") + [missing], q["grade"][q["grade"].rindex("SELECT CAST(count_if"):])
    odd = """
odd AS (
  SELECT qid, CASE CAST(split_part(qid, ':', 2) AS INT) % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE text END AS text FROM dev)"""
    q["predict_edge"] = _ws(_head(3, dev=True) + [odd] + _model_sql(s, "m", with_predict=False) + [
        O.predict_ctes("odd", s.ngram_order, "m_lv", "m_base", "m_def", 5, "m_pred")], "SELECT qid, pred FROM m_pred")
    first = """
lines AS (SELECT * REPLACE (substring(text, 1, 1) AS text) FROM every)"""
    q["predict_add_alpha"] = _ws([O.lines_cte(name="every"), first, O.seq_cte(2), O.counts_ctes(), O.conv_inputs_cte("dev")]
                                 + _model_sql(s, "m"), "SELECT qid, pred FROM m_pred")
    return q


def _grid_sql() -> str:
    from charloom.plans import tune
    grid = tune.SMALL_GRID
    K = tune.FIXED_MAX_CHARS
    fit = ModelParams()
    orders = sorted(set(grid["ngram_order"]))
    ctes = _head(max(orders), dev=True)
    ctes.append("""
ex_raw AS (
  SELECT CAST(item_id AS VARCHAR) AS qid, nfc_normalize(text) AS t FROM benchmark
  WHERE length(nfc_normalize(text)) >= 2),
ex AS (
  SELECT qid, substring(t, 1, length(t) - 1) AS text, right(t, 1) AS answer FROM ex_raw)""")
    ctes.append(O.defaults_cte(K, "dfl"))
    alphas = {a: f"b{i}" for i, a in enumerate(grid["laplace_alpha"])}
    for a, name in alphas.items():
        ctes.append(O.base_ctes(a, name))
    for n in orders:
        ctes.append(O.pairs_cte(n, f"o{n}_pairs"))
        ctes.append(O.trim_ctes(f"o{n}_pairs", f"o{n}", fit.min_context_count, fit.max_contexts, K, False))
    selects = []
    made: set[str] = set()
    for p in tune.grid_points(grid):
        n, m, c, d, a, gi = (p["ngram_order"], p["min_context_count"], p["max_contexts"], p["kn_discount"],
                             p["laplace_alpha"], p["grid_idx"])
        t = f"t{n}_{m}_{c}"
        if t not in made:
            made.add(t)
            ctes.append(O.trim_ctes(f"o{n}", t, m, c, K, ranked=True))
        lv = f"lv{gi}"
        ctes.append(O.level_ctes(t, d, lv))
        for st in ("ex", "dev"):
            ctes.append(O.predict_ctes(st, n, lv, alphas[a], "dfl", 3, f"p{gi}_{st}"))
        acc = []
        for st in ("ex", "dev"):
            acc.append(f"(SELECT CAST(count_if(contains(coalesce(p.pred, ''), s.answer)) AS BIGINT) "
                       f"FROM {st} s LEFT JOIN p{gi}_{st} p USING (qid)) AS {st}_correct, "
                       f"(SELECT CAST(count(*) AS BIGINT) FROM {st}) AS {st}_total")
        selects.append(f"SELECT CAST({gi} AS BIGINT) AS grid_idx, {n} AS ngram_order, {O.dbl(d)} AS kn_discount, "
                       f"{O.dbl(a)} AS laplace_alpha, {m} AS min_context_count, {c} AS max_contexts, "
                       + ", ".join(acc))
    union = "\n  UNION ALL ".join(selects)
    return O.with_(*ctes, select=f"""
SELECT grid_idx, ngram_order, kn_discount, laplace_alpha, min_context_count, max_contexts,
       ex_correct, ex_total, CAST(ex_correct AS DOUBLE) / ex_total AS ex_acc,
       dev_correct, dev_total, CAST(dev_correct AS DOUBLE) / dev_total AS dev_acc,
       CAST(row_number() OVER (ORDER BY CAST(dev_correct AS DOUBLE) / dev_total DESC, grid_idx) AS BIGINT) AS rank
FROM (
  {union})""")


_PY_WS = ("[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
          "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
