"""The corpus pipeline: documents through five operators, one stage after the other.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the
columns of ``documents``; the last one adds its encoding.  ``run`` writes every stage
as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.llm import decontamination, line_dedup, quality_rules, sentence_pieces, simhash
from charloom.llm.common import bounded_batches, shared_folder


# The columns that the operators read; n_chars follows the text.
READ = ("doc_id", "text", "source")


def _aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column that no operator reads under a name of its own, so that
    no operator's result column takes its place; and the way back."""
    names = [c if c in READ else f"_own{i}" for i, c in enumerate(docs.columns)]
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    return renamed, [F.col(n).alias(c) for c, n in zip(docs.columns, names)]


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that a rule rejects go."""
    renamed, back = _aside(docs)
    return quality_rules.apply_cascade(renamed).where(F.col("kept")).select(*back)


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: all but the first copy of cross-site boilerplate lines go, however short."""
    renamed, back = _aside(docs)
    cut = line_dedup.dedup_lines(renamed)
    return cut.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else b for c, b in zip(docs.columns, back)])


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each SimHash component stays."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    bounded_batches(spark)
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: adds the sampled pieces of the text, their number, and whether decoding
    gives the text back (input columns of these names give way)."""
    added = ("pieces", "n_pieces", "lossless")
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    bounded_batches(spark)
    coded = sentence_pieces.encode(docs.select(*own), lossless="lossless")
    return coded.select(*own, "pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), "lossless")


STAGES = [
    ("quality_rules", stage_quality),
    ("line_dedup", stage_lines),
    ("simhash_near_dedup", stage_near_duplicates),
    ("benchmark_decontamination", stage_decontaminate),
    ("sentence_pieces", stage_pieces),
]

# Sampled segmentation is not expressible in SQL; tests/llm/ checks run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
