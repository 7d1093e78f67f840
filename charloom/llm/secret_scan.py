"""Operator 10, secret scans: fixed patterns plus a battery of randomness tests.

Three patterns give the base spans.  Every other run of 20 or more base-64 letters is a
candidate: its encoding is inferred (decimal, hex, base 32, base 36, base 64, or without a
digit the 26 letters of one case or the 52 of both), and three tests of
"these symbols are uniform and independent" are taken together by Fisher's method:
chi-squared uniformity over the encoding's alphabet, runs above and below the middle of
the alphabet, and lag-1 serial correlation.  ``-``, ``_``, ``+`` and ``/`` are symbols of
base 64 in a run with letters of both cases, and separators in one that is hex or decimal
without them (as a UUID is).  Any other run with these has no encoding and is not judged:
words of one case joined by hyphens cannot be told from keys at their usual length (of 180
planted ones 98 passed as random when they were judged over their letters and these four).
Nor is one of fewer than ``MIN_SYMBOLS`` letters and digits.  A word-like run fails at once, a generated
key does not.  Dismissals are controlled length-aware: within each encoding and length
class (powers of two) the Benjamini-Hochberg step-up at level ``q`` decides which
candidates are not random; the rest become spans of kind ``random``.

All of it is DataFrame functions.  P-values are rounded up to tenths of a decade, so the
step-up needs only a histogram (encodings x length classes x 301 rows), which is what is
aggregated; its cut-offs, one per encoding and length class, come back as a literal map.
Text never shuffles.

Offsets are code points, end exclusive.  Defined results: null is empty text; empty text
has no spans, and base_sha256 is that of the empty string.  Repeated rows are scanned
each on its own.  Positions of a kind accumulate in one array per text, so a text with
n matches costs O(n) scanning and O(n * n) pointer copies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

# The patterns, and their shortest forms.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(AKIA[A-Z0-9]{16,})"  # 20 characters or more
HEX = r"([0-9a-f]{24,})"
ASSIGN_SEEN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
MIN_VALUE = 6
MIN_SYMBOLS = 10
RUN = r"([A-Za-z0-9+/_-]{20,}+)"
KINDS = ("assign", "access", "hex", "random")

# The alphabets of the encodings, in index order.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "letters26": "abcdefghijklmnopqrstuvwxyz",
    "letters52": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
}
Q = 0.01
MAX_BIN = 300
_SPAN = "array<struct<s:int,e:int,v:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _matches(text: Column, pattern: str, seen: Column, value_group: int = 2) -> Column:
    """Leftmost non-overlapping matches as (start, end, value).  The text before each
    match is a group too, so that lengths add up to positions."""
    # \G: only where the last match ended.  Without it the search after the last match
    # would start again at every position and read to the end each time.
    whole = rf"(?s)\G(.*?){pattern}"
    parts = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(whole), F.lit(g)).alias(n)
                           for g, n in ((1, "gap"), (2, "hit"), (value_group, "val"))])

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(
            start.alias("s"), end.alias("e"), x["val"].alias("v"))).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.when(seen, F.aggregate(parts, zero, step, lambda acc: acc["out"])).otherwise(F.array().cast(_SPAN))


def _upper_tail(z: Column) -> Column:
    """Upper tail of the standard normal, a rational approximation in exp and division."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    # Coefficients of the published approximation.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.greatest(F.exp(-a * a / 2) * 0.3989422804014327 * poly, F.lit(1e-300))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def randomness_p(x: Column, k: Column) -> Column:
    """Fisher's combined p-value of the three tests; ``x``: symbol indices (double), ``k``:
    size of the alphabet (double)."""
    def tests(n: Column) -> Column:
        counts = F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda s: F.size(F.filter(x, lambda v: v == s)).cast("double"))
        df = k - 1
        chi = k / n * _sum(F.transform(counts, lambda c: c * c)) - n
        third = 2 / (9 * df)
        uniform = _upper_tail((F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - third)) / F.sqrt(third))

        high = F.size(F.filter(x, lambda v: v >= k / 2)).cast("double")
        pairs = F.sequence(F.lit(0), F.size(x) - 2)
        turns = F.size(F.filter(pairs, lambda i: (F.get(x, i) >= k / 2) != (F.get(x, i + 1) >= k / 2))).cast("double")
        both = 2 * high * (n - high)
        spread = both * (both - n) / (n * n * (n - 1))
        runs = F.when(spread <= 0, F.lit(1e-300)).otherwise(
            2 * _upper_tail(F.abs(turns - both / n) / F.sqrt(F.greatest(spread, F.lit(1e-12)))))

        mean = _sum(x) / n
        var = _sum(F.transform(x, lambda v: (v - mean) * (v - mean)))
        lag = _sum(F.transform(pairs, lambda i: (F.get(x, i) - mean) * (F.get(x, i + 1) - mean)))
        serial = F.when(var <= 0, F.lit(1e-300)).otherwise(
            2 * _upper_tail(F.abs(lag / F.greatest(var, F.lit(1e-12)) + 1 / n) * F.sqrt(n)))
        total = -sum((F.log(F.least(p, F.lit(1.0))) for p in (uniform, runs, serial)), F.lit(0.0))
        return let(total, lambda f: F.exp(-f) * (1 + f + f * f / 2))

    return let(F.size(x).cast("double"), tests)


def _judged(run: Column) -> Column:
    """(encoding, size class, bin) of a candidate; encoding null where it has too few symbols."""
    both_cases = run.rlike("[A-Z]") & run.rlike("[a-z]")
    bare = F.regexp_replace(run, "[-_+/]", "")
    core = (F.when(both_cases, F.translate(run, "-_", "+/"))
            .when(F.length(bare) < MIN_SYMBOLS, F.lit(""))
            .when(bare.rlike("^([0-9a-f]+|[0-9A-F]+)$") & bare.rlike("[0-9]"), bare).otherwise(run))

    def for_core(core: Column) -> Column:
        encoding = (
            F.when(core == "", F.lit(None).cast("string"))
            .when(core.rlike("^[0-9]+$"), F.lit("decimal"))
            # A key of any encoding that happens to have no digit is uniform over its letters.
            .when(core.rlike("^([a-z]+|[A-Z]+)$"), F.lit("letters26"))
            .when(core.rlike("^[A-Za-z]+$"), F.lit("letters52"))
            .when(core.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit("hex"))
            .when(core.rlike("^[A-Z2-7]+$"), F.lit("base32"))
            .when(core.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), F.lit("base36"))
            .when(core.rlike("[A-Z]") & core.rlike("[a-z]"), F.lit("base64"))
        )
        return let(encoding, lambda enc: for_encoding(core, enc))

    def for_encoding(core: Column, enc: Column) -> Column:
        letters = F.element_at(F.create_map(*[F.lit(v) for kv in ALPHABETS.items() for v in kv]), enc)
        norm = F.when(enc.isin("hex", "base36", "letters26"), F.lower(core)).otherwise(core)
        chars = F.filter(F.split(norm, ""), lambda c: c != "")
        p = F.when(enc.isNotNull(), let(letters, lambda a: let(
            F.transform(chars, lambda c: F.call_function("instr", a, c).cast("double") - 1),
            lambda x: randomness_p(x, F.length(a).cast("double")))))
        decade = F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300)))), F.lit(MAX_BIN)).cast("int")
        return F.struct(enc.alias("enc"), F.floor(F.log2(F.length(core).cast("double"))).cast("int").alias("cls"),
                        F.when(enc.isNotNull(), decade).alias("bin"))

    return let(core, for_core)


def _of_kind(spans: Column | str, k: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))


def _cutoffs(scanned: DataFrame, q: float) -> dict[str, int]:
    """By 'encoding:class', the smallest bin that the step-up dismisses."""
    hist = (scanned.select(F.explode("cand").alias("c")).select("c.j.*")
            .groupBy("enc", "cls", "bin").agg(F.count("*").alias("n")))
    group = Window.partitionBy("enc", "cls")
    beyond = group.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    cut = (hist.select("enc", "cls", "bin", F.sum("n").over(beyond).alias("beyond"), F.sum("n").over(group).alias("m"))
           .where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= q * F.col("beyond") / F.col("m"))
           .groupBy("enc", "cls").agg(F.min("bin").alias("cut")))
    return {f"{r['enc']}:{r['cls']}": r["cut"] for r in cut.collect()}  # encodings x length classes


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """One row per row of ``docs``: id, base (array of (s, k, e), sorted; k indexes KINDS)
    and found, the same with the random spans."""
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    t = F.col("t")
    spans = own.select(
        "id",
        F.filter(_matches(t, ASSIGN, t.rlike(ASSIGN_SEEN), 3), lambda x: F.length(x["v"]) >= MIN_VALUE).alias("assign"),
        _matches(t, ACCESS, t.contains("AKIA")).alias("access"),
        _matches(t, HEX, t.rlike("[0-9a-f]{24}")).alias("hex"),
        _matches(t, RUN, t.rlike("[A-Za-z0-9+/_-]{20}")).alias("run"),
    )
    # A checkpoint here keeps the scan to one pass: what follows reads spans only.
    spans = checkpointed(spans)
    based = spans.select("id", "run", F.sort_array(F.concat(*[
        _of_kind(kind, k) for k, kind in enumerate(KINDS[:3])])).alias("base"))
    free = F.filter("run", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    judged = F.filter(F.transform(free, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), _judged(x["v"]).alias("j"))),
                      lambda x: x["j"]["enc"].isNotNull())
    scanned = checkpointed(based.select("id", "base", judged.alias("cand")))
    cuts = _cutoffs(scanned, q)
    table = F.create_map(*[F.lit(v) for kv in cuts.items() for v in kv]) if cuts else F.create_map().cast("map<string,int>")
    limit = lambda j: F.coalesce(F.try_element_at(table, F.concat_ws(":", j["enc"], j["cls"].cast("string"))), F.lit(MAX_BIN + 1))
    random = _of_kind(F.filter("cand", lambda x: x["j"]["bin"] < limit(x["j"])), 3)
    return scanned.select(F.col("id").alias(id_col), "base", F.sort_array(F.concat("base", random)).alias("found"))


def as_text(spans: Column) -> Column:
    """'kind:start:end' of sorted spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return scanned.select(id_col, *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
                          F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("found")).alias("spans"))
