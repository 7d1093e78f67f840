"""The registered queries of this subpackage and their DuckDB SQL.

Each query reads whole tables with production parameters and returns its full result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    language_id,
    line_dedup,
    lm_scoring,
    quality_classifier,
    quality_rules,
    repeat_runs,
    secret_scan,
    sentence_pieces,
    simhash,
    token_alignment,
    token_counts,
    token_files,
)
from .common import WORD, crc_mod, shared_folder, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_cascade(docs).select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.classify(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) == 1)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_scoring.score(docs, table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs, crc_mod("doc_id", 4) == 2)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentence_pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), lossless="lossless")
    return coded.select("doc_id", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), "pieces", "lossless")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.scan(docs))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    token_files.write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return token_files.read_ids(spark, folder, with_ids=False)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # The digest stands in for the groups' text, which is several times the input.
    digest = F.when(F.col("groups").isNull(), "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    path = f"{shared_folder(spark)}/token-alignment-{uuid.uuid4().hex}"
    aligned.withColumn("groups_sha256", digest).drop("groups").withColumn("row", F.monotonically_increasing_id()) \
        .write.option("compression", "zstd").parquet(path)
    scored = token_alignment.score_links(spark.read.parquet(path), "row")
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's change of every tenth document (by crc32): from word a on, the words
    repeat with period p.  Words of a changed document are joined by one space."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1))
    w = docs.select("doc_id", "text", (h / 10).cast("long").alias("g"), words.alias("w"))
    n = F.size("w")
    w = w.withColumn("a", F.when(n > 0, F.col("g") % n))
    w = w.withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))))
    place = F.sequence(F.lit(0).cast("long"), n - 1)
    changed = F.transform(place, lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(
        F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return w.select("doc_id", F.when(n > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op13_repeat_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = repeat_runs.find_runs(docs).select("doc_id", "found.*")
    line = F.transform("runs", lambda r: F.concat(F.array_join(F.array(r["start"], r["length"], r["period"]), ","), F.lit("\n")))
    # Greatest length / period, exactly: the first run of a list in order wins ties.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    top = found.withColumn("top", best)
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


ORACLES: dict[str, str] = {}

# Base measures by unnesting; the rules follow RULES.
ORACLES["op1_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1),
m AS (
  SELECT d.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_stutter
  FROM d LEFT JOIN cover USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > 0.1 * n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR (n_dup_lines > 0.3 * n_lines AND n_dup_lines > 2)
            OR len(regexp_extract_all(t, '!')) > 0.5 * n_words
            OR len(regexp_extract_all(t, '\p{Lu}')) > 0.6 * word_chars
            OR len(regexp_extract_all(t, '[0-9]')) > 0.4 * word_chars
            OR n_stutter > 0.3 * n_words) AS kept
FROM b
"""

# Exact distinct sites per trimmed line that is not blank; the first copy stays.
ORACLES["op6_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
e AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS body FROM l),
common AS (SELECT body FROM e WHERE body <> '' GROUP BY body HAVING count(DISTINCT coalesce('=' || source, '')) >= 5),
r AS (
  SELECT e.*, body IN (SELECT body FROM common) AND row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) > 1 AS gone
  FROM e)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM r GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_sentence_pieces": op9_sentence_pieces,
    "op10_secret_scan": op10_secret_scan,
    "op11_token_files": op11_token_files,
    "op12_token_alignment": op12_token_alignment,
    "op13_repeat_runs": op13_repeat_runs,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
