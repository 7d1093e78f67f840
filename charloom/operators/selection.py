"""Exact selection of the smallest keys without sorting all of them.

``cuts`` finds, per group (or overall), a key value such that the rows up to it hold the
wanted weight and little more.  Each round counts the rows still in question into
``BINS`` equal bins of their key range: one partial aggregation, so that a task sends at
most groups x bins rows, and nothing is sorted or shuffled but histograms.  The bin in
which the wanted weight is reached is the next round's range; a bin of at most ``slack``
rows, or one key, ends the search.  Evenly spread keys (hashes, ids) shrink by ``BINS`` a
round, so two rounds do for billions of rows.  The caller ranks the rows up to the cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from charloom.session import ensure_checkpoint_dir

BINS = 4096
SLACK = 1_000_000
# Rows of keys (about 40 bytes each) that may be broadcast.
BROADCAST_KEYS = 1_000_000
_NUMBER = "decimal(30,0)"


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of two aliased sides on ``columns``, with a null equal to a null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its known number of rows allows it."""
    return F.broadcast(df) if rows <= BROADCAST_KEYS else df


def cuts(rows: DataFrame, key: Column, wanted: int, weight: Column | None = None,
         groups: Sequence[str] = (), slack: int = SLACK, bins: int = BINS) -> DataFrame:
    """``(groups..., cut, rest)``, a row per group: the rows with ``key <= cut`` hold at least
    ``wanted`` of the weight (or all there is), and those beyond the first ``wanted`` are at
    most ``slack``, or have the key ``cut``.  ``rest`` is what is wanted of the last bin.
    ``key`` is a whole number of at most 30 digits, ``weight`` (1 if not given) a whole
    number.  Reads ``rows`` once per round and once before."""
    ensure_checkpoint_dir(rows.sparkSession)
    by = list(groups) or ["_all"]
    r = rows.withColumn("_all", F.lit(0)) if not groups else rows
    r = r.select(*by, key.cast(_NUMBER).alias("_key"), (F.lit(1) if weight is None else weight).cast("long").alias("_weight"))
    state = r.groupBy(*by).agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi"), F.sum("_weight").alias("_in"))
    state = state.withColumn("_rest", F.lit(wanted).cast("long")).withColumn("_open", F.lit(True))

    def still_open(s: DataFrame) -> DataFrame:
        """Ends the groups whose range holds few enough rows beyond the wanted ones."""
        return s.withColumn("_open", (F.col("_in") > F.col("_rest") + slack) & (F.col("_hi") > F.col("_lo"))).checkpoint(eager=True)

    state = still_open(state)
    done = []
    while True:
        done.append(state.where(~F.col("_open")))
        todo = state.where("_open").withColumn(
            "_width", F.expr(f"(_hi - _lo) div {bins}").cast(_NUMBER) + F.lit(1).cast(_NUMBER))
        n = todo.count()
        if not n:
            break
        s = small(todo, n).alias("s")
        inside = r.alias("r").join(s, same("r", "s", by) & F.expr("r._key BETWEEN s._lo AND s._hi"))
        bin_no = F.expr("(r._key - s._lo) div s._width")
        kept = [F.col(f"s.{c}").alias(c) for c in (*by, "_lo", "_hi", "_rest", "_width")]
        hist = inside.select(*kept, bin_no.alias("_bin"), F.col("r._weight").alias("_weight"))
        hist = hist.groupBy(*by, "_lo", "_hi", "_rest", "_width", "_bin").agg(F.sum("_weight").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_bin"))  # at most ``bins`` rows a group
        hit = hist.withColumn("_upto", upto).where("_upto >= _rest AND _upto - _n < _rest")
        low = F.expr(f"cast(_lo + cast(_bin AS {_NUMBER}) * _width AS {_NUMBER})")
        state = still_open(hit.select(
            *by, low.alias("_lo"), F.least(F.col("_hi"), (low + F.col("_width") - 1).cast(_NUMBER)).alias("_hi"),
            F.col("_n").alias("_in"), (F.col("_rest") - (F.col("_upto") - F.col("_n"))).alias("_rest")))
    out = reduce(DataFrame.unionByName, [d.drop("_width") if "_width" in d.columns else d for d in done])
    return out.select(*groups, F.col("_hi").alias("cut"), F.least("_rest", "_in").alias("rest"))

