"""Text functions (F1-F10, S3) and their edge rows."""

import re
import unicodedata

import pytest

from charloom.functions import text as T


def test_below_u0300_is_nfc_stable_in_pairs():
    # The NFC shortcut skips rows whose code points are all below U+0300.
    cps = [chr(c) for c in range(0x300) if not 0xD800 <= c <= 0xDFFF]
    for a in cps:
        assert unicodedata.is_normalized("NFC", a)
        for b in cps:
            s = a + b
            assert unicodedata.normalize("NFC", s) == s


def _covered():
    return {c for a, b in T.nfc_quick_check() for c in range(a, b + 1)}


def test_nfc_quick_check_covers_every_code_point_that_can_change():
    covered = _covered()
    pairs = set()
    for c in range(0x110000):
        ch = chr(c)
        if unicodedata.normalize("NFC", ch) != ch or unicodedata.combining(ch):
            assert c in covered
        parts = unicodedata.normalize("NFD", ch)
        if len(parts) > 1:
            pairs.add((unicodedata.normalize("NFC", parts[:-1]), parts[-1]))
    # Every pair that composes has its second half in the class.
    assert all(ord(b) in covered for a, b in pairs if unicodedata.normalize("NFC", a + b) != a + b)
    assert len(pairs) > 10_000


def test_nfc_quick_check_leaves_common_scripts_alone():
    covered = _covered()
    for text in ("Привет мир", "漢字かな交じりカタカナ", "한국어 문장", "Ελλην", "ქართული", "“quoted” – 10 €"):
        assert not covered & set(map(ord, text))


@pytest.mark.parametrize("seed", range(3))
def test_nfc_of_mixed_text(spark, seed):
    import random
    draw = random.Random(seed)
    pool = [chr(c) for a, b in T.nfc_quick_check() for c in range(a, min(b, a + 3) + 1)] + list("aeiouAEо漢각각Αאक")
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 6))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.nfc("t").alias("o"))
    assert [r.o for r in df.orderBy("i").collect()] == [unicodedata.normalize("NFC", t) for t in texts]


def _one(spark, col, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first()["o"]


@pytest.mark.parametrize("value", ["c\u0301", "zq😀x", "plain", "", "e\u0301\u0301", "\u1100\u1161"])
def test_nfc(spark, value):
    assert _one(spark, T.nfc("t"), value) == unicodedata.normalize("NFC", value)


def test_nfc_null(spark):
    assert _one(spark, T.nfc("t"), None) is None


@pytest.mark.parametrize("value", ["  a \t b\n c  ", "\x1c\x1d x \x85\xa0y\u3000", "\u2028z\u2029", "", "   ", "a\u200bb"])
def test_clean_line_matches_python(spark, value):
    exp = re.sub(r"\s+", " ", unicodedata.normalize("NFC", value).replace("\n", " ")).strip()
    assert _one(spark, T.clean_line("t"), value) == exp


def test_whitespace_class_is_pythons():
    py = {chr(c) for c in range(0x110000) if re.fullmatch(r"\s", chr(c))}
    java_class = T.PY_WHITESPACE_CLASS
    ranges = re.findall(r"\\x\{([0-9a-f]+)\}(?:-\\x\{([0-9a-f]+)\})?", java_class)
    ours = set()
    for lo, hi in ranges:
        ours.update(chr(c) for c in range(int(lo, 16), int(hi or lo, 16) + 1))
    assert ours == py


def test_decode_ignore(spark):
    raw = b"ab\xffc\xe2\x82 ok \xf0\x9f\x98\x80"
    got = spark.createDataFrame([(bytearray(raw),)], "b binary").select(T.decode_ignore("b").alias("o")).first()["o"]
    assert got == raw.decode("utf-8", "ignore")


def test_split_and_grader_view(spark):
    row = spark.createDataFrame([("héllo",)], "t string").select(
        T.drop_last_char("t").alias("p"), T.last_char("t").alias("a"),
        T.grader_view("t", 3).alias("g"), T.scoring_suffix("t", 3).alias("s"), T.scoring_suffix("t", 1).alias("s1")).first()
    assert (row.p, row.a, row.g, row.s, row.s1) == ("héll", "o", "hél", "lo", "")
    # Lowercase before the cut: 'İ' lowercases to two code points.
    assert _one(spark, T.grader_view("t", 2), "İX") == "İX".lower()[:2]
