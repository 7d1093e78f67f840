"""Operator 6, line dedup: boilerplate lines that spread over many sites.

Per line hash a HyperLogLog sketch of the distinct sites is aggregated (partial sketches
merge after the shuffle, so a line that a third of all rows hold sends one sketch a
task).  A line whose estimate is clearly at or above ``min_sites`` is boilerplate, one
clearly below is not; the lines whose estimate lies within the sketch's error of the
threshold get an exact distinct count.  Every occurrence but the first (smallest id,
then position) of a boilerplate line is removed, so the corpus keeps one copy.

Every line that is not blank counts, however short.  Lines are compared trimmed, by a
64-bit hash.  All of it is DataFrame functions; the boilerplate lines meet the others by
a broadcast while there are at most ``BROADCAST_LINES``, by a shuffle beyond; the text
itself shuffles once, to meet the positions to remove.

Defined results: null text stays null and has no lines; an emptied document stays, with
empty text; a null site is a site of its own; repeated rows (same id and text) hold the
same first occurrence and keep it alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, internal, settled

MIN_SITES = 5
LOG_BINS = 12
# Boilerplate lines (about 70 bytes each) that may be broadcast.
BROADCAST_LINES = 500_000
# Standard errors of the estimate that count as near the threshold.
SIGMAS = 4.0


def line_hashes(text: Column) -> Column:
    """Hash of every line, null for blank lines."""
    def one(line: Column) -> Column:
        body = F.trim(line, F.lit(" \t\r\x0b\x0c"))
        return F.when(body != "", F.xxhash64(body))

    return F.transform(F.split(text, "\n"), one)


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, log_bins: int = LOG_BINS) -> DataFrame:
    """(h, first) of the lines on ``min_sites`` sites or more.  ``lines``: h, site (not
    null), at (an orderable place); first is the smallest place."""
    error = SIGMAS * 1.04 / (2 ** log_bins) ** 0.5
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    spread = checkpointed(
        lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(log_bins)).alias("sketch"), F.min("at").alias("first"))
        .select("h", "first", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low))
    near = spread.where(F.col("sites") < high).select("h", "first")
    keys = near.select("h")
    exact = (lines.join(F.broadcast(keys) if spread.count() <= BROADCAST_LINES else keys, "h", "left_semi").select("h", "site").distinct()
             .groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("h"))
    return spread.where(F.col("sites") >= high).select("h", "first").unionAll(near.join(exact, "h", "left_semi"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the text cut, and n_lines and n_removed (long; input columns of these
    names give way)."""
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    own = [F.col(f"`{c}`") for c in keep]
    ident, text, site = F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.col(f"`{site_col}`")
    row = F.xxhash64(ident.isNull(), ident, text)
    lines = checkpointed(
        docs.select(row.alias("row"), ident.alias("id"), F.coalesce(F.concat(F.lit("="), site.cast("string")), F.lit("")).alias("site"),
                    F.posexplode(line_hashes(text)).alias("pos", "h"))
        .where(F.col("h").isNotNull())
        .select("h", "site", F.struct(F.col("id").isNull().alias("none"), "id", "row", "pos").alias("at")))
    common = checkpointed(boilerplate(lines, min_sites))
    few = common.count() <= BROADCAST_LINES
    gone = (lines.join(F.broadcast(common) if few else common, "h")
            .where((F.col("at.row") != F.col("first.row")) | (F.col("at.pos") != F.col("first.pos")))
            .groupBy(F.col("at.row").alias("_row")).agg(F.collect_set("at.pos").alias("_gone")))
    r, g = internal(docs, "_row"), internal(docs, "_gone")
    gone = gone.select(F.col("_row").alias(r), F.col("_gone").alias(g))
    p = internal(docs, "_pieces")
    # The places that stay are the difference of two sets of places: linear in the lines.
    met = docs.select(*own, row.alias(r)).join(gone, r, "left").withColumn(p, settled(F.split(text, "\n")))
    places = F.sequence(F.lit(0), F.size(p) - 1)
    left = F.transform(F.array_except(places, g), lambda i: F.get(F.col(p), i))
    cut = F.when(F.col(g).isNull(), text).otherwise(F.array_join(left, "\n"))
    return met.select(
        *[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in keep],
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(p)).cast("long").alias("n_lines"),
        F.when(F.col(g).isNull(), F.lit(0)).otherwise(F.size(g)).cast("long").alias("n_removed"))
