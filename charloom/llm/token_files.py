"""Operator 11, binary token files with Elias-Fano document boundaries.

``write_ids`` encodes every text, ends each document with ``end_id`` and lays the ids of
all documents end to end, in ascending id order, in binary files; ``read_ids`` gets the
documents back from them.  Rows are dealt to tasks by ranges of the document id, so the
files, in their order, are one array, and no task sees more than its range.

File: magic, then the ids (2 bytes each where the vocabulary allows it, else 4, little
end first), then two Elias-Fano sequences, the boundaries (n + 1 of them, from 0) and the
document ids, then a trailer with their sizes.  A document's start is select(i), its
length select(i + 1) - select(i): there is no 64-bit table of offsets, and a part of a
file is read without the rest.  ``manifest`` (Parquet, beside the files) has a row per
file, with the number of ids in the files before it.

A task streams its ids to a file with a name of its own and reports the file when it has
been closed; the manifest lists reported files only, so what a lost or repeated attempt
left behind is never read.  The folder must be a shared one that pyarrow can open
(local or mounted paths, ``file:``, ``hdfs:``, ``s3:``, ``gs:``).  Driver memory: a row per
file.  Task memory: an Arrow batch, and 16 bytes a document of its range.

Defined results: null and empty texts have no ids but the end id; null document ids come
first; rows of one id are ordered by the hash of their text, equal rows in any order;
an empty table gives a manifest without rows.  Other columns are left out.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_encoder import encoder_of, gather
from .elias_fano import EliasFano

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
END_ID = 2
DOCS_A_READ = 20_000
IDS_A_READ = 1 << 21
MAGIC = b"TOKENID1"
_TRAILER = "<QQQQQB8s"  # ids, documents, null document ids, bytes of both sequences, width, magic
_FILE = "shard int, file string, n_docs long, n_ids long"


def _open(folder: str):
    """(file system, path) of a folder given as a path or URI."""
    from pyarrow import fs
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlsplit(folder).path)
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def write_ids(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
              vocabulary: str = VOCABULARY, end_id: int | None = END_ID) -> None:
    """Write the token files of ``docs`` and their manifest into ``folder`` (a new one)."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = encoder_of(model.value)
        end = [] if end_id is None else [end_id]
        shard = TaskContext.get().partitionId()
        name = f"{shard:07d}-{uuid.uuid4().hex}.ids"
        sizes, doc_ids, n_nulls, out = [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system, path = _open(folder)
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}")
                out.write(MAGIC)
            ids, n = encoder.encode(batch.column(1).fill_null(""))
            # The end id goes behind the ids of each document.
            flat = np.concatenate((ids, np.array(end, encoder.dtype)))
            cuts = np.cumsum(n)
            if end:
                starts = np.column_stack((cuts - n, np.full(len(n), len(ids)))).ravel()
                flat = gather(flat, starts, np.column_stack((n, np.ones_like(n))).ravel())
            out.write(flat.tobytes())
            sizes.append(n + len(end))
            column = batch.column(0)
            n_nulls += column.null_count
            doc_ids.append(column.drop_null().to_numpy())
        if out is None:
            return
        size = np.concatenate(sizes)
        bounds = EliasFano.of(np.concatenate(([0], np.cumsum(size)))).to_bytes()
        names = EliasFano.of(np.concatenate(doc_ids)).to_bytes()
        out.write(bounds)
        out.write(names)
        out.write(struct.pack(_TRAILER, int(size.sum()), len(size), n_nulls, len(bounds), len(names), encoder.dtype.itemsize, MAGIC))
        out.close()
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "file": [name],
                                          "n_docs": pa.array([len(size)], pa.int64()), "n_ids": pa.array([int(size.sum())], pa.int64())})

    order = [F.col("doc").asc_nulls_first(), F.col("tie"), F.col("row")]
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "text")
    files = sorted(tuple(r) for r in ordered.mapInArrow(write, _FILE).collect())
    before, rows = 0, []
    for shard, name, n_docs, n_ids in files:
        rows.append((shard, name, n_docs, n_ids, before))
        before += n_ids
    spark.createDataFrame(rows, f"{_FILE}, before long").coalesce(1).write.parquet(f"{folder}/manifest")


class TokenFile:
    """One file; ids of any document or stretch of documents by select."""

    def __init__(self, folder: str, name: str):
        system, path = _open(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        tail = struct.calcsize(_TRAILER)
        self.n_ids, self.n_docs, self.n_nulls, n_bounds, n_names, width, magic = struct.unpack(
            _TRAILER, self.file.read_at(tail, size - tail))
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a token file: {name}")
        self.dtype = np.dtype(f"<u{width}")
        at = size - tail - n_names - n_bounds
        if at != len(MAGIC) + self.n_ids * width:
            raise ValueError(f"token file of the wrong length: {name}")
        self.bounds = EliasFano.from_bytes(self.file.read_at(n_bounds, at))
        self.names = EliasFano.from_bytes(self.file.read_at(n_names, at + n_bounds))

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        known = self.names.slice(max(first - self.n_nulls, 0), max(last - self.n_nulls, 0)).tolist()
        return [None] * (last - first - len(known)) + known

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids number ``start`` up to ``end`` of the file."""
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((end - start) * width, len(MAGIC) + start * width), self.dtype)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True, docs_a_read: int = DOCS_A_READ) -> DataFrame:
    """One row per document in the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of its ids as little-endian 32-bit numbers) and, on request, ids.
    A task's stretch of a file is read in parts of about ``IDS_A_READ`` ids."""
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                file = TokenFile(folder, name)
                bounds = file.bounds.slice(first, last + 1)
                k = 0
                while k < last - first:
                    n = max(int(np.searchsorted(bounds, bounds[k] + IDS_A_READ, "right")) - 1 - k, 1)
                    n = min(n, last - first - k)
                    cut = bounds[k:k + n + 1]
                    ids = file.ids(int(cut[0]), int(cut[-1])).astype("<u4")
                    raw, at = memoryview(ids.tobytes()), ((cut - cut[0]) * 4).tolist()
                    columns = {
                        "doc_id": pa.array(file.doc_ids(first + k, first + k + n), pa.int64()),
                        "start": pa.array(cut[:-1] + before),
                        "n_tokens": pa.array(np.diff(cut)),
                        "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), pa.array(ids.astype(np.int64)))
                    yield pa.RecordBatch.from_pydict(columns)
                    k += n

    stretches = spark.read.parquet(f"{folder}/manifest").where("n_docs > 0").select(
        "file", "before", "n_docs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(docs_a_read).cast("long"))).alias("first"))
    stretches = stretches.select("file", "before", "first", F.least(F.col("n_docs"), F.col("first") + docs_a_read).alias("last"))
    # A task reads a few stretches; the number of tasks is that of the shuffles, or the cores'.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return stretches.repartition(tasks).mapInArrow(read, schema)
