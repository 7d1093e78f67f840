"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.session import ensure_checkpoint_dir

# One word, and the white space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession) -> None:
    """Few and short Arrow batches for the Python functions of a session, so that a task's
    memory does not grow with the length of the texts.  Called by the registered queries
    and the pipeline; operators leave the session alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (a local one is chosen only
    where it is unset, on a local master)."""
    return ensure_checkpoint_dir(spark)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(col: Column | str, n: int) -> Column:
    """crc32 of the value's text, modulo n (null stays null)."""
    return F.crc32(F.col(col).cast("string").cast("binary") if isinstance(col, str)
                   else col.cast("string").cast("binary")) % n


def internal(df: DataFrame, stem: str) -> str:
    """A column name built on ``stem`` that no column of ``df`` has (in any case)."""
    have = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in have:
        name += "_"
    return name


def with_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a result column; an input column of that name (in any case) gives way."""
    clash = [c for c in df.columns if c.lower() == name.lower()]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in clash], value.alias(name))


def settled(value: Column) -> Column:
    """``value``, marked so that Catalyst computes its projection once.

    A filter on a column made by array lambdas would otherwise be pushed below the
    projections and repeat the whole computation, per element even inside lambdas.
    A projection that asks for the partition id is not rewritten that way.
    """
    return F.when(F.spark_partition_id() >= 0, value)
