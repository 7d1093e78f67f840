"""Window counting: chunked long lines give exactly the unchunked windows."""

import pytest
from pyspark.sql import functions as F

from charloom.operators import counts


@pytest.mark.parametrize("order", [1, 2, 3, 6])
def test_chunked_windows_equal_whole_lines(spark, small_corpus, monkeypatch, order):
    texts = small_corpus.select("line_id", "text").unionByName(spark.createDataFrame(
        [(10**9, "a😀b😀😀cdé́\n\rxy" * 9), (10**9 + 1, "q" * 23)], "line_id long, text string"))
    monkeypatch.setattr(counts, "LINE_CHUNK", 10**9)
    whole = sorted(counts.position_windows(texts, order).collect())
    monkeypatch.setattr(counts, "LINE_CHUNK", 7)
    chunked = sorted(counts.position_windows(texts, order).collect())
    assert chunked == whole
    # and against Python directly for the hand-made rows
    s = "a😀b😀😀cdé́\n\rxy" * 9
    exp = sorted((i, s[max(0, i - order + 1): i + 1]) for i, ch in enumerate(s) if ch not in "\n\r")
    got = sorted((r.pos, r.win) for r in chunked if r.line_id == 10**9)
    assert got == exp


def _expected(lines, order):
    """(count, first (line, pos)) of every window of ``lines`` (line_id, text)."""
    out = {}
    for line, s in lines:
        for i, ch in enumerate(s):
            if ch not in "\n\r":
                win = s[max(0, i - order + 1): i + 1]
                n, first = out.get(win, (0, (line, i)))
                out[win] = (n + 1, min(first, (line, i)))
    return out


@pytest.mark.parametrize("order", [1, 3, 6, 17])
@pytest.mark.parametrize("size", [1 << 20, 40])
def test_window_counts_of_slices(spark, monkeypatch, order, size):
    """Null characters, astral characters, line breaks inside, repeated and negative line
    ids, lines out of order, and a null text: counts and first places are exact, however
    the lines are cut."""
    monkeypatch.setattr(counts, "LINE_CHUNK", 7)
    monkeypatch.setattr(counts, "SLICE_CHARS", size)
    monkeypatch.setattr(counts, "HELD_WINDOWS", 50 if size < 99 else 10**6)
    monkeypatch.setattr(counts, "SENT_ROWS", 30)
    lines = [(9, "abab\x00ab\x00\x00"), (3, "xxabab"), (3, "ab"), (-5, "b😀\nab\r\n😀ab"), (2**90, "zzab" * 9),
             (4, "\n"), (5, ""), (2**31, "".join(chr(0x4E00 + k % 997) for k in range(60)))]
    df = spark.createDataFrame([(str(a), b) for a, b in [*lines, (7, None)]], "line_id string, text string").coalesce(1)
    df = df.withColumn("line_id", F.col("line_id").cast("decimal(29,0)"))
    got = counts.window_counts(df, order).select("win", "cnt", counts.unpack_position("first_seen").alias("u")).collect()
    assert {r.win: (r.cnt, (int(r.u.line_id), r.u.pos)) for r in got} == _expected(lines, order)
    assert len(got) == len(_expected(lines, order))


def test_tasks_send_on_distinct_windows_only(spark):
    """A row per distinct window of a slice leaves a task's Python, none per character."""
    corpus = spark.createDataFrame([(i, "abc " * 500) for i in range(50)], "line_id long, text string").coalesce(1)
    sent = counts.window_parts(corpus, 3)
    assert sent.agg(F.sum("cnt")).first()[0] == 50 * 2000
    assert sent.count() < 100
