"""Text-file sources and sinks.

Files are read with Spark's text reader on any Hadoop file system.  The reader
splits lines at ``\\n``, ``\\r\\n`` and ``\\r`` (universal newlines) and keeps the
raw bytes, so invalid UTF-8 is repaired per row (S3) and only bad rows reach
Python.

Line order.  A corpus needs an order of its lines, not their numbers: its key is made of
the bytes of the files before, the start of the block (``_metadata.file_block_start``)
and the row's place in its task, so a corpus is one scan.  Inputs and answers meet by
position and need exact numbers: there, row counts per block (one row per input split,
written once) give each block's offset.

Written folders carry a manifest, ``_manifest``: their part files with the number of rows,
checked when the folder is read, so that a lost or doubled part cannot shift lines.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from charloom.functions.text import decode_ignore, nfc
from charloom.operators.counts import LINE_TYPE
from charloom.operators.selection import small
from charloom.session import ensure_checkpoint_dir

# The default corpus globs and the fallback file, in order.
DEFAULT_PATTERNS = ["data/**/*.txt", "corpus/**/*.txt", "train/**/*.txt"]
FALLBACK_FILE = "example/input.txt"

_ROW_BITS = 33  # layout of monotonically_increasing_id(): the row's place in its task
MANIFEST = "_manifest"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _listing(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, int]]:
    """``path -> (URI as Spark names it, bytes)`` of the regular files among ``paths``.  A
    folder that holds several of them is listed once."""
    folders: dict[str, list[str]] = {}
    for path in dict.fromkeys(paths):
        folders.setdefault(posixpath.dirname(path), []).append(path)
    found = {}
    for folder, inside in folders.items():
        fs, p = _fs(spark, folder or "." if len(inside) > 1 else inside[0])
        if not fs.exists(p):
            continue
        at = {st.getPath().getName(): st for st in (fs.listStatus(p) if len(inside) > 1 else [fs.getFileStatus(p)]) if st.isFile()}
        for path in inside:
            st = at.get(posixpath.basename(path))
            if st is not None:
                found[path] = (_one_slash(fs.makeQualified(st.getPath()).toUri().toString()), st.getLen())
    return found


def _existing(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str, int]]:
    """``(path, URI, bytes)`` of the listed files that exist, in list order, repeats kept.  A
    file with content that Spark's reader passes over (``_`` or ``.`` in front) is an error."""
    found = _listing(spark, paths)
    lost = [p for p, (_, size) in found.items() if size > 0 and posixpath.basename(p).startswith(("_", "."))]
    if lost:
        raise ValueError(f"Spark's text reader passes over these files: {lost}")
    return [(p, *found[p]) for p in paths if p in found]


def _parts(spark: SparkSession, path: str) -> list[str]:
    """A file itself, or the part files of a written folder in name order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isFile():
        return [path]
    names = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())
    return [posixpath.join(path, n) for n in names if not n.startswith(("_", "."))]


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Regular files matching ``pattern``; ``**`` matches any number of folders
    (including none), as Python's recursive glob does."""
    if "**" not in pattern:
        fs, p = _fs(spark, pattern)
        found = fs.globStatus(p) or []
        return [str(s.getPath().toUri().getPath()) if s.getPath().toUri().getScheme() in (None, "file")
                else str(s.getPath()) for s in found if s.isFile() and not s.getPath().getName().startswith(".")]
    root = pattern.split("**", 1)[0].rstrip("/") or "."
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    it = fs.listFiles(p, True)
    root_uri = fs.makeQualified(p).toUri().getPath().rstrip("/")
    while it.hasNext():
        st = it.next()
        full = st.getPath().toUri().getPath()
        rel = posixpath.join(root, full[len(root_uri):].lstrip("/")) if root != "." else full[len(root_uri):].lstrip("/")
        # Hidden files and folders do not match a wildcard.
        inner = full[len(root_uri):].lstrip("/").split("/")
        if not any(name.startswith(".") for name in inner) and _glob_match(rel, pattern):
            out.append(rel)
    return out


def _glob_match(path: str, pattern: str) -> bool:
    # '**/' may stand for zero folders.
    if fnmatch.fnmatchcase(path, pattern):
        return True
    return "**/" in pattern and fnmatch.fnmatchcase(path, pattern.replace("**/", "", 1))


# One path of a ':'-separated list: a URI (its scheme and its port keep their colons), or
# a plain path.
_LISTED = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^/:]*(?::\d+)?[^:]*|[^:]+")


def corpus_files(spark: SparkSession, listed: Sequence[str] | str | None = None,
                 patterns: Sequence[str] = DEFAULT_PATTERNS, fallback: str = FALLBACK_FILE) -> list[str]:
    """The training files, in order.

    A list given as text is cut at its colons; order and duplicates stay.  Without one,
    every pattern's regular files are merged and sorted (U1); without any file the
    fallback is named, whether it exists or not."""
    if isinstance(listed, str):
        listed = _LISTED.findall(listed)
    chosen = [path for path in listed or () if path != ""]
    if chosen:
        return chosen
    merged: set[str] = set().union(*(_glob(spark, pattern) for pattern in patterns))
    return sorted(merged) if merged else [fallback]


def _one_slash(uri: str) -> str:
    return re.sub("^file:/+", "file:/", uri)


def _scan(spark: SparkSession, existing: Sequence[tuple[str, str, int]]) -> DataFrame:
    """One scan, each file once: ``(uri, _block, _mid, value)``; ``_mid`` grows along a block."""
    return spark.read.text(list({uri: path for path, uri, _ in existing}.values())).select(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("uri"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mid"), "value")


def _numbered_blocks(raw: DataFrame) -> DataFrame:
    """``(uri, _block, _m0, _n, _off)``: rows of every block and of the blocks of its file
    before it, one row per input split, written once."""
    ensure_checkpoint_dir(raw.sparkSession)
    blocks = raw.groupBy("uri", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.partitionBy("uri").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).checkpoint(eager=True)


def _with_line_no(raw: DataFrame, blocks: DataFrame) -> DataFrame:
    b = small(blocks.select("uri", "_block", "_m0", "_off"), blocks.count())
    return raw.join(b, ["uri", "_block"]).withColumn("line_no", F.col("_off") + F.col("_mid") - F.col("_m0"))


def read_lines(spark: SparkSession, paths: Sequence[str], repair_utf8: bool = True) -> DataFrame:
    """Every line of every file: ``(grp, grp_idx, line_no, text)``, raw (no NFC,
    blank lines kept).  Missing files are skipped (the reference skips unreadable
    files); a path listed twice is read twice.  A file that exists but that Spark's
    reader would pass over (a name that starts with ``_`` or ``.``) is an error."""
    existing = _existing(spark, paths)
    if not existing:
        return spark.createDataFrame([], "grp string, grp_idx int, line_no long, text string")
    raw = _scan(spark, existing)
    numbered = _with_line_no(raw, _numbered_blocks(raw))
    files = spark.createDataFrame([(uri, p, i) for i, (p, uri, _) in enumerate(existing)], "uri string, grp string, grp_idx int")
    text = decode_ignore(F.col("value")) if repair_utf8 else F.col("value")
    return numbered.join(small(files, len(existing)), "uri").select("grp", "grp_idx", "line_no", text.alias("text"))


def _order_key(before: Column, block: Column, mid: Column) -> Column:
    """One number that orders lines by (bytes of the files before + block start, place)."""
    place = mid.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return ((before + block).cast(LINE_TYPE) * F.lit(1 << _ROW_BITS).cast("decimal(10,0)") + place.cast("decimal(10,0)")).cast(LINE_TYPE)


def _read_ordered(spark: SparkSession, existing: Sequence[tuple[str, str, int]], groups: Sequence[tuple[str | None, int]],
                  keep_blank: bool) -> DataFrame:
    """The corpus of the files ``existing``, file by file, each with its (grp, grp_idx)."""
    if not existing:
        return spark.createDataFrame([], f"line_id {LINE_TYPE}, grp string, grp_idx int, text string")
    rows, before = [], 0
    for (_, uri, size), (grp, idx) in zip(existing, groups):
        rows.append((uri, grp, idx, before))
        before += size + 1
    files = spark.createDataFrame(rows, "uri string, grp string, grp_idx int, _before long")
    lines = _scan(spark, existing).join(small(files, len(rows)), "uri")
    out = lines.select(_order_key(F.col("_before"), F.col("_block"), F.col("_mid")).alias("line_id"), "grp", "grp_idx",
                       nfc(decode_ignore(F.col("value"))).alias("text"))
    return out if keep_blank else out.where(F.col("text") != "")


def read_corpus(spark: SparkSession, paths: Sequence[str], keep_blank: bool = False) -> DataFrame:
    """The corpus table ``(line_id, grp, grp_idx, text)``: NFC lines, empty lines
    dropped (F4) unless ``keep_blank``, in one scan; ``line_id`` orders lines by (file
    position in the list, position in the file).  Missing files are skipped, a path listed
    twice is read twice, a file that Spark's reader would pass over is an error."""
    existing = _existing(spark, paths)
    return _read_ordered(spark, existing, [(p, i) for i, (p, _, _) in enumerate(existing)], keep_blank)


def read_prepared(spark: SparkSession, folder: str, group_col: str = "grp", keep_blank: bool = False) -> DataFrame:
    """S1 + S2 over a prepared corpus: ``(line_id, grp, grp_idx, text)``.  A sub-folder
    ``<group_col>=<value>`` is one group, however many part files it has; groups are in
    sorted order (a null one first), lines in part-file order."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        raise FileNotFoundError(folder)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = {n: unescape(n.split("=", 1)[1]) for n in names if n.startswith(f"{group_col}=")}
    nameless = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how Spark's writer names null
    order = sorted(values, key=lambda n: (values[n] != nameless, values[n]))
    existing, groups = [], []
    for i, name in enumerate(order):
        parts = _parts(spark, posixpath.join(folder, name))
        part_files = _existing(spark, parts)
        existing += part_files
        groups += [(None if values[name] == nameless else values[name], i)] * len(part_files)
    return _read_ordered(spark, existing, groups, keep_blank)


def read_inputs(spark: SparkSession, path: str) -> DataFrame:
    """``(qid, text)``, one row per line, blank lines kept, NFC.  ``path`` is a file, or
    a folder as the writers below leave it; it must exist."""
    return _numbered(spark, path).select("qid", nfc("text").alias("text"))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """``(qid, answer)``, newline stripped only; a file or a folder."""
    return _numbered(spark, path).select("qid", F.col("text").alias("answer"))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``(qid, pred)`` as ``write_predictions`` wrote them, or the lines of a file."""
    return _numbered(spark, path).select("qid", F.col("text").alias("pred"))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """``(qid, text)``: the lines of a file, or of a folder's parts one after the other.  The
    parts must be those of the folder's manifest, if it has one, with its row counts."""
    existing = _existing(spark, _parts(spark, path))
    if not existing:
        return spark.createDataFrame([], "qid long, text string")
    raw = _scan(spark, existing)
    blocks = _numbered_blocks(raw)
    rows = {r["uri"]: r["n"] for r in blocks.groupBy("uri").agg(F.sum("_n").alias("n")).collect()}  # a row per file
    _check_manifest(spark, path, {posixpath.basename(p): rows.get(uri, 0) for p, uri, _ in existing})
    offsets, before = [], 0
    for _, uri, _ in existing:
        offsets.append((uri, before))
        before += rows.get(uri, 0)
    files = spark.createDataFrame(offsets, "uri string, _before long")
    lines = _with_line_no(raw, blocks).join(small(files, len(offsets)), "uri")
    return lines.select((F.col("_before") + F.col("line_no")).alias("qid"), decode_ignore(F.col("value")).alias("text"))


def _check_manifest(spark: SparkSession, path: str, found: dict[str, int]) -> None:
    fs, p = _fs(spark, posixpath.join(path, MANIFEST))
    if not fs.exists(p):
        return
    expected = {r["file"]: r["n_rows"] for r in spark.read.parquet(posixpath.join(path, MANIFEST)).collect()}  # a row per file
    wrong = sorted(f for f in expected.keys() | found.keys() if expected.get(f) != found.get(f))
    if wrong:
        told = [(f, expected.get(f), found.get(f)) for f in wrong[:5]]
        raise ValueError(f"{path}: {len(wrong)} part files differ from the manifest (file, rows written, rows found): {told}")


def _write_ordered_text(df: DataFrame, col: str, path: str, order_col: str, partitions: int | None) -> None:
    # A line break inside a value would shift every later line: it becomes a space.
    spark = df.sparkSession
    value = F.regexp_replace(F.coalesce(F.col(col).cast("string"), F.lit("")), "[\r\n]", " ")
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    (df.repartitionByRange(parts, order_col).sortWithinPartitions(order_col)
       .select(value.alias(col)).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").text(path))
    names = [posixpath.basename(p) for p in _parts(spark, path)]
    counted = {r["f"]: r["n"] for r in spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("f"))
               .agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per part file
    if sum(counted.values()) != seen.get["n"]:
        raise ValueError(f"{path}: {seen.get['n']} rows written, {sum(counted.values())} found")
    manifest = spark.createDataFrame([(f, counted.get(f, 0)) for f in names], "file string, n_rows long")
    manifest.coalesce(1).write.mode("overwrite").parquet(posixpath.join(path, MANIFEST))


def write_predictions(preds: DataFrame, path: str, partitions: int | None = None) -> None:
    """One prediction per line in qid order.  The rows are range-partitioned
    on qid, so the part files, read in name order, are the ordered file."""
    _write_ordered_text(preds, "pred", path, "qid", partitions)


def write_dev_set(dev: DataFrame, out_dir: str, partitions: int | None = None) -> None:
    """Aligned ``dev_input`` and ``dev_answer`` outputs in qid order."""
    _write_ordered_text(dev, "text", os.path.join(out_dir, "dev_input"), "qid", partitions)
    _write_ordered_text(dev, "answer", os.path.join(out_dir, "dev_answer"), "qid", partitions)


def write_prepared(prepared: DataFrame, out_dir: str) -> None:
    """One folder per group (``grp=<lang>``), rows in id order per group; a large group
    is cut by id ranges into several part files."""
    (prepared.repartitionByRange("grp", "row_id").sortWithinPartitions("grp", "row_id")
     .select("grp", "text").write.mode("overwrite").partitionBy("grp").text(out_dir))


# Fixed by ``plans.tune.RESULT_COLUMNS``: the types of a results table.
RESULT_TYPES = ("grid_idx long, ngram_order int, kn_discount double, laplace_alpha double, min_context_count int, "
                "max_contexts int, ex_correct long, ex_total long, ex_acc double, dev_correct long, dev_total long, "
                "dev_acc double, rank long")


def write_results(results: DataFrame, path: str) -> None:
    """The ranked grid results (one row per grid point) as one CSV file."""
    results.orderBy("rank").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_results(spark: SparkSession, path: str, types: str = RESULT_TYPES) -> DataFrame:
    """S11, the way back: the written table with its types.  A header that does not name
    these columns, or a value that does not fit its type, stops the job."""
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return reader.schema(types).csv(path)
