"""Corpus, inputs and gold answers from tables (S2, S4, S5, S12 over a table).

A corpus row is ``(line_id, grp, grp_idx, line_no, text)``.  For a table of
documents a line is a piece of ``text`` between ``\\n``; ``line_id`` is
``operators.counts.line_key(doc_id, piece)``, which orders lines the way a reader of
the documents in id order would see them, for any 64-bit id and any number of lines.
A null group is a group of its own, before the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import drop_last_char, last_char, nfc
from charloom.operators.counts import line_key
from charloom.operators.ranking import indexed
from charloom.operators.selection import small
from charloom.session import spread


def group_index(df: DataFrame, group_col: str = "grp", groups: Sequence[str] | None = None) -> tuple[DataFrame, int]:
    """``(grp, grp_idx)``, the position of each group in an explicit list, else in sorted
    order (the order a sorted file glob gives), and the number of groups.  Without a list
    the group column is read once, on the call."""
    if groups is not None:
        rows = [(g, i) for i, g in enumerate(groups)]
        return df.sparkSession.createDataFrame(rows, "grp string, grp_idx int"), len(rows)
    distinct, n = indexed(df.select(F.col(group_col).alias("grp")).distinct(), "grp", "grp_idx")
    return distinct.withColumn("grp_idx", F.col("grp_idx").cast("int")), n


def corpus_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 group_col: str | None = "lang", groups: Sequence[str] | None = None,
                 normalize: bool = True, keep_blank: bool = False, split_lines: bool = True) -> DataFrame:
    """S2 + F7 + F1 + F4 on a table: split every document into lines, NFC them and
    drop empty lines (``keep_blank`` keeps them, as the round-robin cap needs).

    ``split_lines=False`` keeps each document whole (SURVEY 2.9-k): its inner
    newlines are never predicted and never a bigram's left neighbour (F9) but
    may sit inside contexts.  ``groups`` restricts and orders the groups (the
    explicit file list); a missing text reads as the empty string (S12)."""
    grp = F.col(group_col) if group_col else F.lit("")
    base = docs.select(F.col(id_col).cast("long").alias("_doc"), grp.cast("string").alias("grp"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    if groups is not None:
        base = base.where(F.col("grp").isin(list(groups)))
    keys = base.select("grp")
    base = spread(base)
    pieces = F.split("_text", "\n") if split_lines else F.array("_text")
    lines = base.select("_doc", "grp", F.posexplode(pieces).alias("_piece", "text"))
    lines = lines.select(
        line_key(F.col("_doc"), F.col("_piece")).alias("line_id"),
        "grp",
        F.col("_doc").alias("doc_id"),
        F.col("_piece").cast("long").alias("piece"),
        (nfc("text") if normalize else F.col("text")).alias("text"),
    )
    if not keep_blank:
        lines = lines.where(F.col("text") != "")
    # Groups may be as many as URLs or paths: they are counted, and few are broadcast, so
    # that the text stays where it is.
    gi, n_groups = group_index(keys, "grp", groups)
    out = lines.join(small(gi.withColumnRenamed("grp", "_grp"), n_groups), F.col("grp").eqNullSafe(F.col("_grp")), "inner")
    return out.select("line_id", "grp", "grp_idx", "doc_id", "piece", "text")


def dev_from_table(df: DataFrame, text_col: str = "text", id_col: str = "item_id",
                   min_len: int = 2) -> DataFrame:
    """Inputs and gold answers from whole texts: ``(qid, text, answer)`` with
    ``text = t[:-1]`` and ``answer = t[-1]`` (F5, F6), texts NFC'd first."""
    t = nfc(F.col(text_col))
    base = df.select(F.col(id_col).cast("long").alias("qid"), t.alias("_t"))
    base = base.where(F.length("_t") >= min_len)
    return base.select("qid", drop_last_char("_t").alias("text"), last_char("_t").alias("answer"))
