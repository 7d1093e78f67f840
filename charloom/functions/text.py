"""Column functions on text.

Everything here returns a ``Column``.  Only two operations leave the JVM:
Unicode NFC normalisation (F1) and dropping invalid UTF-8 bytes (S3); both are
Arrow-batched and only receive the rows that can change.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The two characters that are never predicted and never act as a
# left neighbour in a bigram.
NEWLINES = ("\n", "\r")

# Fixed value: Python's ``\s`` for str patterns, written out because Java's
# ``\s`` is ASCII-only and ``(?U)\s`` misses U+001C..U+001F.
PY_WHITESPACE_CLASS = (
    "[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)

# Every code point below U+0300 is NFC-stable and none of them composes with a
# neighbour below U+0300 (tests/test_text.py checks all pairs): a first, cheap test.
_BEYOND_LATIN = "[^\\x{00}-\\x{2ff}]"
# Neighbouring ranges of the quick-check class this near are joined, which only sends a
# few more rows to Python: a pattern tests range after range.
_JOIN_GAP = 64


@lru_cache(maxsize=1)
def nfc_quick_check() -> list[tuple[int, int]]:
    """Ranges that cover every code point that NFC can change or that can change a
    neighbour: with a combining class, replaced by NFC, or the second half of a canonical
    pair (Hangul vowels and final consonants included).  Text without any is in NFC."""
    found = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for c in range(0x110000):
        ch = chr(c)
        if unicodedata.combining(ch):
            found.add(c)
        parts = unicodedata.decomposition(ch)
        if parts and parts[0] != "<":
            if unicodedata.normalize("NFC", ch) != ch:
                found.add(c)
            found.update(int(p, 16) for p in parts.split()[1:])
    ranges: list[tuple[int, int]] = []
    for c in sorted(found):
        if ranges and c - ranges[-1][1] <= _JOIN_GAP:
            ranges[-1] = (ranges[-1][0], c)
        else:
            ranges.append((c, c))
    return ranges


def _may_change_under_nfc() -> str:
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in nfc_quick_check()) + "]"


@F.arrow_udf(StringType())
def _nfc_arrow(texts: pa.Array) -> pa.Array:
    out = [None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()]
    return pa.array(out, type=pa.string())


@F.arrow_udf(StringType())
def _decode_ignore_arrow(raw: pa.Array) -> pa.Array:
    out = [None if b is None else b.decode("utf-8", "ignore") for b in raw.to_pylist()]
    return pa.array(out, type=pa.string())


# Nondeterministic only so that the optimizer never copies the call into a
# pushed-down filter (which would run it twice); the function itself is pure.
_nfc_arrow = _nfc_arrow.asNondeterministic()
_decode_ignore_arrow = _decode_ignore_arrow.asNondeterministic()


def nfc(col: Column | str) -> Column:
    """Unicode NFC.  Rows without a code point of ``nfc_quick_check`` pass through
    untouched (most text in any script but those written with combining marks); the UDF
    sees a null for them, so only the rows that can change cross to Python."""
    c = F.col(col) if isinstance(col, str) else col
    needs = c.rlike(_BEYOND_LATIN) & c.rlike(_may_change_under_nfc())
    return F.coalesce(_nfc_arrow(F.when(needs, c)), c)


def decode_ignore(raw: Column | str) -> Column:
    """S3: decode bytes as UTF-8 dropping invalid bytes (``errors='ignore'``).

    ``raw`` is a string column straight from the text reader (it keeps the raw
    bytes) or a binary column.  Valid rows never reach Python."""
    c = F.col(raw) if isinstance(raw, str) else raw
    as_bin = c.cast("binary")
    valid = F.is_valid_utf8(as_bin.cast("string"))
    fixed = _decode_ignore_arrow(F.when(~valid, as_bin))
    return F.when(valid, as_bin.cast("string")).otherwise(fixed)


def clean_line(col: Column | str) -> Column:
    """NFC, newline -> space, collapse whitespace runs to one space, strip."""
    c = nfc(col)
    c = F.regexp_replace(c, "\n", " ")
    c = F.regexp_replace(c, PY_WHITESPACE_CLASS + "+", " ")
    return F.trim(c)


def in_length_band(col: Column | str, lo: int, hi: int) -> Column:
    """lo <= length <= hi (code points)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.length(c).between(lo, hi)


def is_blank(col: Column | str) -> Column:
    """F4 complement: the empty string (whitespace-only lines are kept)."""
    c = F.col(col) if isinstance(col, str) else col
    return c == F.lit("")


def drop_last_char(col: Column | str) -> Column:
    """``line[:-1]``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - 1, F.lit(0)))


def last_char(col: Column | str) -> Column:
    """``line[-1]``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.right(c, F.lit(1))


def scoring_suffix(col: Column | str, order: int) -> Column:
    """the last ``order-1`` characters, empty when ``order-1 <= 0``."""
    c = F.col(col) if isinstance(col, str) else col
    if order - 1 <= 0:
        return F.lit("")
    return F.right(c, F.lit(order - 1))


def grader_view(col: Column | str, limit: int | None = None, from_file: bool = False) -> Column:
    """F8: lowercase, then cut to ``limit`` characters.  ``from_file`` also drops the
    last code unit first, as a line read with its newline would."""
    c = F.col(col) if isinstance(col, str) else col
    if from_file:
        c = drop_last_char(c)
    c = F.lower(c)
    if limit is not None:
        c = F.substring(c, F.lit(1), F.lit(limit))
    return c
