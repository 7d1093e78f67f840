"""Save and load a model as a directory of Parquet tables.

Layout: ``params`` (one row: the hyper-parameters, bigram types and the default
characters), ``context_chars`` (with ``ctx_rank``/``char_rank``/``first_seen``,
which the second trims need), ``unigram`` and ``continuation``.  Missing params
columns get the defaults on load.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from charloom.plans.model import BUILTIN_DEFAULT_CHARS, CharModel, ModelParams

TABLES = ("context_chars", "unigram", "continuation")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    from charloom.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def save(model: CharModel, path: str, mode: str = "overwrite") -> None:
    spark = model.context_chars.sparkSession
    p = model.params
    params = spark.createDataFrame(
        [(p.ngram_order, p.laplace_alpha, p.max_chars_per_context, p.min_context_count, p.max_contexts,
          p.kn_discount, int(model.total_bigram_types), list(model.default_chars))],
        "ngram_order int, laplace_alpha double, max_chars_per_context int, min_context_count int, "
        "max_contexts int, kn_discount double, total_bigram_types long, default_chars array<string>")
    params.coalesce(1).write.mode(mode).parquet(os.path.join(path, "params"))
    model.context_chars.write.mode(mode).option("compression", "zstd").parquet(os.path.join(path, "context_chars"))
    model.unigram.write.mode(mode).option("compression", "zstd").parquet(os.path.join(path, "unigram"))
    model.continuation.write.mode(mode).option("compression", "zstd").parquet(os.path.join(path, "continuation"))


def load(spark: SparkSession, path: str) -> CharModel:
    row = spark.read.parquet(os.path.join(path, "params")).first().asDict()
    d = ModelParams()
    params = ModelParams(
        ngram_order=int(row.get("ngram_order", d.ngram_order)),
        laplace_alpha=float(row.get("laplace_alpha", d.laplace_alpha)),
        max_chars_per_context=int(row.get("max_chars_per_context", d.max_chars_per_context)),
        min_context_count=int(row.get("min_context_count", d.min_context_count)),
        max_contexts=int(row.get("max_contexts", d.max_contexts)),
        kn_discount=float(row.get("kn_discount", d.kn_discount)),
    )
    tables: dict[str, DataFrame] = {t: spark.read.parquet(os.path.join(path, t)) for t in TABLES}
    return CharModel(params, tables["context_chars"], tables["unigram"], tables["continuation"],
                     int(row.get("total_bigram_types") or 0),
                     list(row.get("default_chars") or BUILTIN_DEFAULT_CHARS))


def model_size_bytes(path: str) -> int:
    total = 0
    for root, _, files in os.walk(path):
        total += sum(os.path.getsize(os.path.join(root, f)) for f in files)
    return total


__all__ = ["save", "load", "scratch_path", "model_size_bytes"]
