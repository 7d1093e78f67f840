"""Corpus caps, samples and preparation.

Corpus rows are ``(line_id, grp, grp_idx, ..., text)``; ``line_id`` orders lines
inside a group and ``grp_idx`` orders the groups (the file list).
Every "first N" / "sample N" is exact and distributed.  ``selection.cuts`` finds, from
histograms, a key up to which the wanted rows lie; only keys up to there are ranked, by
``ordinal``, which has no single-task window, and text is read for chosen keys only, which
meet the corpus by a broadcast while N allows it.  Per-group limits with a small N use
Spark's window group limit, which keeps only N rows per group before the shuffle.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from charloom.functions.text import clean_line, drop_last_char, in_length_band, last_char, nfc
from charloom.operators.counts import STEP
from charloom.operators.ranking import indexed, ordinal
from charloom.operators.selection import cuts, same, small
from charloom.session import ensure_checkpoint_dir


def _block(corpus: DataFrame) -> Column:
    """What orders the lines of a group coarsely: the document, or the block of a line
    number.  A plain column where there is one, so that a bound on it reaches the scan."""
    return F.col("doc_id") if "doc_id" in corpus.columns else F.expr(f"line_id div {STEP}L")


def _block_counts(corpus: DataFrame) -> DataFrame:
    """``(grp_idx, block, n)``: non-empty lines per block, written once."""
    ensure_checkpoint_dir(corpus.sparkSession)
    kept = corpus.where(F.col("text") != "")
    return kept.groupBy("grp_idx", _block(corpus).alias("block")).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)


def cap_first_n(corpus: DataFrame, n: int) -> DataFrame:
    """L1: the first ``n`` non-empty lines in (grp_idx, line_id) order; ``take_rank``
    is the position in that order, and ``line_id`` becomes it, so that a model fitted
    on the result breaks ties in load order.  ``n <= 0`` keeps nothing (SURVEY 2.9-j).
    Line counts per block tell the group and the block in which the cap falls; only the
    lines up to there are ranked and read."""
    kept = corpus.where(F.col("text") != "")
    counts = _block_counts(corpus) if n > 0 else None
    cut = cuts(counts.groupBy("grp_idx").agg(F.sum("n").alias("n")), F.col("grp_idx"), n, F.col("n"), slack=0).first() if counts else None
    if cut is None:
        kept = kept.where(F.lit(False))
    else:
        last = int(cut["cut"])
        mine = counts.where(F.col("grp_idx") == last)
        block = int(cuts(mine, F.col("block"), cut["rest"], F.col("n"), slack=max(n, 1000)).first()["cut"])
        kept = kept.where((F.col("grp_idx") < last) | ((F.col("grp_idx") == last) & (_block(corpus) <= block)))
    keys = ordinal(kept.select("grp_idx", "line_id"), [F.col("grp_idx"), F.col("line_id")], name="take_rank")
    chosen = keys.where(F.col("take_rank") <= n).select("grp_idx", "line_id", "take_rank")
    return _in_load_order(kept.join(small(chosen, n), ["grp_idx", "line_id"]))


def _in_load_order(taken: DataFrame) -> DataFrame:
    return taken.withColumn("line_id", F.col("take_rank"))


def cap_round_robin(corpus_with_blanks: DataFrame, n: int) -> DataFrame:
    """L2: take line r of every group before line r+1 of any group.  ``rr`` counts
    blank lines too (a blank line uses up its group's turn), then blanks are
    dropped and the first ``n`` lines in (rr, grp_idx) order are kept; ``line_id``
    becomes that order.  A group is a position in the list (``grp_idx``): a file
    listed twice takes two turns.  No group gives more than its first ``n`` non-empty
    lines, so only the blocks that hold these are ranked (keys) and read."""
    lines = corpus_with_blanks
    if n > 0:
        each = cuts(_block_counts(lines), F.col("block"), n, F.col("n"), groups=["grp_idx"], slack=max(n, 1000))
        each = small(each.select(F.col("grp_idx").alias("_g"), "cut"), each.count())
        lines = lines.join(each, F.col("grp_idx") == F.col("_g")).where(_block(lines) <= F.col("cut")).drop("_g", "cut")
    else:
        lines = lines.where(F.lit(False))
    narrow = lines.select("grp_idx", "line_id", (F.col("text") == "").alias("_blank"))
    turns = ordinal(narrow, [F.col("line_id")], partition_by=["grp_idx"], name="rr")
    ranked = ordinal(turns.where(~F.col("_blank")).select("grp_idx", "line_id", "rr"),
                     [F.col("rr"), F.col("grp_idx")], name="take_rank")
    chosen = ranked.where(F.col("take_rank") <= n)
    return _in_load_order(lines.join(small(chosen, n), ["grp_idx", "line_id"]))


def load_capped(corpus_with_blanks: DataFrame, max_lines: int | None = None,
                balanced: bool = False, normalize: bool = False) -> DataFrame:
    """The training lines with an optional global cap, round robin when
    ``balanced`` and there is more than one group.  ``normalize`` applies NFC (F1) to the
    lines that are kept; a line is blank before it if it is after it."""
    if max_lines is None:
        out = corpus_with_blanks.where(F.col("text") != "")
    elif balanced and corpus_with_blanks.select("grp_idx").distinct().limit(2).count() > 1:
        out = cap_round_robin(corpus_with_blanks, max_lines)
    else:
        out = cap_first_n(corpus_with_blanks, max_lines)
    return out.withColumn("text", nfc("text")) if normalize else out


def resolve_groups(df: DataFrame, patterns: Sequence[str], group_col: str) -> DataFrame:
    """S1 + U1: the distinct groups matching any of the glob ``patterns``, sorted,
    with their position ``grp_idx``.  One row per group."""
    cond = F.lit(False)
    for p in patterns:
        cond = cond | F.col(group_col).rlike("^" + fnmatch.translate(p).removeprefix("(?s:").removesuffix(")\\Z") + "$")
    groups = df.select(F.col(group_col).alias("grp")).where(cond).distinct()
    return indexed(groups, "grp", "grp_idx")[0]


def prepare(rows: DataFrame, lines_per_group: int, min_chars: int = 10, max_chars: int = 1000,
            group_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Clean every row (F2), keep lengths in [min_chars, max_chars] (F3), and the
    first ``lines_per_group`` kept rows of each group in id order (L3).  A missing
    text reads as ''.  With whole-number ids the kept ids of each group are counted first,
    and only rows up to the id that the limit falls on are cleaned again and ranked."""
    own = rows.select(F.col(group_col).alias("grp"), F.col(id_col).alias("row_id"), F.col(text_col).alias("text"))

    def kept(df: DataFrame) -> DataFrame:
        return df.withColumn("text", clean_line(F.coalesce("text", F.lit("")))).where(in_length_band("text", min_chars, max_chars))

    if isinstance(own.schema["row_id"].dataType, IntegralType) and lines_per_group > 0:
        ensure_checkpoint_dir(own.sparkSession)
        # A null id comes first in the order; below every number here.
        number = F.coalesce(F.col("row_id").cast("decimal(30,0)"), F.lit(str(-1 << 64)).cast("decimal(30,0)"))
        keys = kept(own).select("grp", "row_id").checkpoint(eager=True)
        each = cuts(keys, number, lines_per_group, groups=["grp"], slack=max(lines_per_group, 1000))
        near = own.alias("o").join(small(each, each.count()).alias("c"), same("o", "c", ["grp"])).where(number <= F.col("cut"))
        own = near.select("o.*")
    w = Window.partitionBy("grp").orderBy("row_id")
    # row_number() <= N over a window is planned as a window group limit: each
    # task keeps N rows per group before the shuffle, so a hot group is cheap.
    return kept(own).withColumn("kept_rank", F.row_number().over(w)).where(F.col("kept_rank") <= lines_per_group)


def sample_key(seed: int | str, row_id: Column, salt: str = ":") -> Column:
    """Seeded, reproducible sort key: md5 of ``seed + salt + id``."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(salt), row_id.cast("string")))


def _key_number(key: str) -> Column:
    """The first 60 bits of a sample key, in the order of the keys."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("long")


def split_example(text: Column) -> tuple[Column, Column]:
    """(prefix, answer)."""
    return drop_last_char(text), last_char(text)


def dev_random(corpus: DataFrame, size: int, seed: int = 42, min_len: int = 2,
               normalize_first: bool = False) -> DataFrame:
    """``size`` lines of length >= ``min_len`` sampled without replacement by a
    seeded hash order, each split into (text = line[:-1], answer = line[-1]).
    ``normalize_first`` applies NFC before the length test and split (the tune
    form); the script form splits raw lines."""
    t = nfc("text") if normalize_first else F.col("text")
    base = corpus.select("line_id", "grp", t.alias("_line")).where(F.length("_line") >= min_len)
    keys = base.select("line_id", sample_key(seed, F.col("line_id")).alias("_key"))
    cut = cuts(keys, _key_number("_key"), size).first() if size > 0 else None
    keys = keys.where(F.lit(False) if cut is None else _key_number("_key") <= int(cut["cut"]))
    picked = ordinal(keys, [F.col("_key"), F.col("line_id")], name="qid").where(F.col("qid") <= size)
    picked = base.join(small(picked.select("line_id", "qid"), size), "line_id")
    prefix, answer = split_example(F.col("_line"))
    return picked.select("qid", "line_id", "grp", prefix.alias("text"), answer.alias("answer"))


def dev_balanced(corpus: DataFrame, per_group: int, seed: int = 42, min_len: int = 2,
                 normalize_first: bool = False) -> DataFrame:
    """``per_group`` lines from every group (seeded hash order inside the
    group), then shuffled by a second seeded hash into ``qid`` order."""
    t = nfc("text") if normalize_first else F.col("text")
    base = corpus.select("line_id", "grp", t.alias("_line")).where(F.length("_line") >= min_len)
    keys = base.select("line_id", "grp", sample_key(seed, F.col("line_id")).alias("_key"))
    each = cuts(keys, _key_number("_key"), max(per_group, 1), groups=["grp"], slack=max(per_group, 1000))
    n_groups = each.count()
    near = keys.alias("k").join(small(each, n_groups).alias("c"), same("k", "c", ["grp"])).where(_key_number("_key") <= F.col("cut"))
    w = Window.partitionBy("grp").orderBy("_key", "line_id")
    picked = near.select("k.*").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_group)
    again = picked.select("line_id", sample_key(seed, F.col("line_id"), salt="#").alias("_key2"))
    order = ordinal(again, [F.col("_key2"), F.col("line_id")], name="qid").select("line_id", "qid")
    picked = base.join(small(order, per_group * n_groups), "line_id")
    prefix, answer = split_example(F.col("_line"))
    return picked.select("qid", "line_id", "grp", prefix.alias("text"), answer.alias("answer"))


def dev_balanced_stats(corpus: DataFrame, per_group: int, min_len: int = 2,
                       normalize_first: bool = False) -> DataFrame:
    """Per group the lines taken and the lines available."""
    t = nfc("text") if normalize_first else F.col("text")
    base = corpus.select("grp", t.alias("_line")).where(F.length("_line") >= min_len)
    avail = base.groupBy("grp").agg(F.count(F.lit(1)).alias("available"))
    return avail.select("grp", F.least(F.col("available"), F.lit(per_group)).alias("taken"), "available")


def holdout(corpus: DataFrame, dev: DataFrame) -> DataFrame:
    """SURVEY 2.9-g: the corpus without the sampled dev lines (anti join)."""
    return corpus.join(dev.select("line_id"), "line_id", "left_anti")
