"""Operator 8, SimHash near-duplicates by deletion-variant signatures.

A document's fingerprint has 64 bits, each the majority bit of the XXH64 hashes of its
3-word shingles.  Two fingerprints link at 3 or fewer differing bits.  Cut into two
halves of 32 bits, one half of such a pair differs by at most one bit, so the pair
shares either that half exactly or one of its 32 variants with one bit made a wildcard:
33 keys a half, 66 a distinct fingerprint.  An equality self-join on the key, done in
blocks, finds every pair, and the whole fingerprints are verified.

Scale: exact copies fall together first (one row per distinct fingerprint).  A wildcard
key counts only where both values of the wildcard bit occur.  The members of a key are
numbered in a spillable window and cut into blocks of ``BLOCK``; each pair of blocks is
one row of bounded size, of which only a spanning forest of the verified links is
emitted, so neither a group nor its pairs ever gather in one task.  Components come from
``components.connected_components``.

Defined results: null, empty and wordless texts have fingerprint zero, which links like
any other.  Rows with a null id get their group's component; a group of null ids only
has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, internal
from .components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
HALF = 32
BLOCK = 2048


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    # bytes.lower and bytes.split know exactly A-Z and the six white-space bytes.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * set_bits > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long (an Arrow function over batches of texts)."""

    def batch(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint_of(t, shingle) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64))

    batch.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, "long")(text)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _spanning_links(members: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """A forest of the links among ``members`` (uint64): breadth first, so that a dense
    group costs far fewer comparisons than it has pairs."""
    if len(members) == 2:
        if (int(members[0]) ^ int(members[1])).bit_count() <= max_bits:
            yield 0, 1
        return
    left = np.arange(len(members))
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            u = todo.pop()
            near = np.bitwise_count(members[left] ^ members[u]) <= max_bits
            for v in left[near]:
                yield u, v
                todo.append(v)
            left = left[~near]


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): verified links that connect exactly what all links would.  ``fps`` has one
    row per distinct ``fp``.  Two halves find every pair for ``max_bits`` up to 3."""
    if max_bits > 3:
        raise ValueError("two halves with one wildcard cover at most 3 differing bits")
    half = F.when(F.col("j") < HALF + 1, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", HALF))
    keyed = (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * HALF + 1))).alias("j"))
        .select("fp", "j", half.alias("v"), (F.col("j") % (HALF + 1)).alias("pos"))
        .select("fp", "j", "v", F.expr(f"if(pos = {HALF}, 0L, shiftleft(1L, pos))").alias("bit"))
        .select("fp", F.expr("shiftleft(cast(j as bigint), 32) | (v & ~bit)").alias("key"),
                F.expr("if(bit = 0, -1, if((v & bit) = 0, 0, 1))").alias("side"))
    )
    whole = Window.partitionBy("key").orderBy("fp").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.partitionBy("key").orderBy("fp")
    shared = (
        keyed.select("key", "fp", F.count("*").over(whole).alias("n"), F.min("side").over(whole).alias("lo"),
                     F.max("side").over(whole).alias("hi"), F.row_number().over(upto).alias("r"))
        .where((F.col("n") > 1) & ((F.col("lo") < F.col("hi")) | (F.col("lo") < 0)))
    )
    blocks = F.expr(f"sequence(0L, (n - 1) div {block})")
    own = F.expr(f"cast((r - 1) div {block} as bigint)")
    dealt = (
        shared.select("key", "fp", own.alias("own"), F.explode(blocks).alias("other"))
        .groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("k"))
        .agg(F.collect_list("fp").alias("members"))
    )

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for members in frame["members"]:
                at = np.asarray(members, np.int64)
                out += [(at[u], at[v]) for u, v in _spanning_links(at.view(np.uint64), max_bits)]
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return dealt.select("members").mapInPandas(verify, "a long, b long")


def _row_hash(id_col: str, text_col: str) -> Column:
    """Two hashes of id and text: 64 bits would meet by chance at some 10^10 rows."""
    own = (F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return F.struct(F.xxhash64(F.lit(1), *own).alias("a"), F.xxhash64(F.lit(2), *own).alias("b"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows has id, fp and th (128 bits that tell id and text) of every row
    of ``docs``; classes has fp, root and component_id of every distinct fingerprint."""
    rows = checkpointed(docs.select(
        F.col(f"`{id_col}`").alias("id"), fingerprint(F.col(f"`{text_col}`"), shingle).alias("fp"),
        _row_hash(id_col, text_col).alias("th")))
    smallest = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("id")))
    roots = connected_components(links(smallest.select("fp"), max_bits))
    member = smallest.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = member.join(lowest, "root").select("fp", "root", "component_id")
    return rows, checkpointed(classes)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id (the
    smallest id that links reach)."""
    rows, classes = components(docs, id_col, text_col, shingle, max_bits)
    return rows.join(classes, "fp", "left").select(
        F.col("id").alias(id_col), as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The row with the smallest id of every component (of equal ids, the one whose text
    hashes lowest; of repeated rows, one).  A component of null ids keeps one row."""
    rows, classes = components(docs, id_col, text_col, shingle, max_bits)
    named = rows.join(classes, "fp", "left")
    # One narrow row per component; a null id sorts after every id.
    first = named.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("th").alias("th"))).alias("first"))
    key = [internal(docs, "_th1"), internal(docs, "_th2")]
    winners = first.select(F.col("first.th.a").alias(key[0]), F.col("first.th.b").alias(key[1])).distinct()
    mine = _row_hash(id_col, text_col)
    own = [F.col(f"`{c}`") for c in docs.columns]
    return (docs.select(*own, mine["a"].alias(key[0]), mine["b"].alias(key[1])).join(winners, key, "left_semi")
            .dropDuplicates(key).select(*own))
