"""Exact, distributed row numbers.

``row_number().over(Window.orderBy(...))`` without a partition key moves every
row into one task, and ``partitionBy(g)`` puts a hot group (one language can
hold a third of the corpus) into one task.  ``ordinal`` instead range-sorts the
rows over the whole cluster, tags each row with its position inside its sorted
partition, checkpoints the tagged rows (so every reader sees one partitioning),
and adds the sizes of the earlier partitions, which come from a table with one
row per (partition, group): its size is bounded by the number of shuffle
partitions times the groups inside each, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROWS_PER_PARTITION_BITS = 33  # layout of monotonically_increasing_id()


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordinal(df: DataFrame, order_by: Sequence[Column | str], partition_by: Sequence[str] = (),
            name: str = "rn") -> DataFrame:
    """Add ``name`` = 1-based row number in ``order_by`` order, restarting for each
    ``partition_by`` group.  ``order_by`` must be a total order (end with a unique
    key); the result is then deterministic and equals ``row_number()``."""
    parts = list(partition_by)
    keys = [_as_col(c) for c in parts] + [_as_col(c) for c in order_by]
    tagged = df.orderBy(*keys).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", _ROWS_PER_PARTITION_BITS))
    # The per-partition counts and the rows must see the SAME partitioning.
    # Evaluated twice, the range sort can be sampled or coalesced differently, so
    # the tagged rows are written once to the shared checkpoint folder (this also
    # keeps them stable when an executor is lost).
    from charloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    stats = tagged.groupBy("_pid", *parts).agg(F.count(F.lit(1)).alias("_n"),
                                               F.min("_mid").alias("_m0"))
    before = Window.partitionBy(*parts).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    stats = stats.select("_pid", *parts, "_m0", "_off")
    out = tagged.join(F.broadcast(stats), on=["_pid", *parts], how="inner")
    out = out.withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_m0")) + F.lit(1))
    return out.drop("_mid", "_pid", "_m0", "_off")


def top_n_exact(df: DataFrame, n: int, order_by: Sequence[Column | str],
                partition_by: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Keep the first ``n`` rows (per group) in ``order_by`` order, with their rank.
    ``n <= 0`` keeps nothing."""
    if n <= 0:
        return ordinal(df, order_by, partition_by, name).where(F.lit(False))
    return ordinal(df, order_by, partition_by, name).where(F.col(name) <= n)


# Rows of a key table that one task may number.
ONE_TASK_ROWS = 1_000_000


def indexed(keys: DataFrame, key: str, name: str) -> tuple[DataFrame, int]:
    """``keys`` (distinct values of one column) with their 0-based position in sorted order,
    nulls first, and how many there are.  They are written once; few are numbered in one
    task, many by ``ordinal``."""
    from charloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(keys.sparkSession)
    kept = keys.checkpoint(eager=True)
    n = kept.count()
    order = F.col(key).asc_nulls_first()
    if n <= ONE_TASK_ROWS:
        numbered = kept.withColumn(name, F.row_number().over(Window.orderBy(order)))
    else:
        numbered = ordinal(kept, [order], name=name)
    return numbered.withColumn(name, (F.col(name) - 1).cast("long")), n
