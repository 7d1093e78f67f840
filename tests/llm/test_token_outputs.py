"""Operators 11 to 13: exact round trips and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from llm.conftest import make_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from charloom.llm import queries, repeat_runs, token_alignment, token_files
from charloom.llm.chunk_encoder import ChunkEncoder
from charloom.llm.common import WORD
from charloom.llm.elias_fano import EliasFano

MODEL = open(token_files.VOCABULARY, "rb").read()
STRANGE = ["", " ", "\n", "a", "two  spaces", " lead", "trail ", "x\ny z", "a\n\nb", "<|endoftext|>", "a <|endoftext|>\nb", "<s> </s> <unk>",
           "▁ piece ▁", "漢字かな交じり文です", "tab\tand\rreturn", "　wide space", "\x1cfile\x1d sep", "🙂 é́ ﷺ", "a" * 5000, "-" * 301,
           "ab" * 900 + "\x00", "don't we'll I'm", "1234567 89", "nul\x00 byte"]


# ---- operator 11

def test_elias_fano_gives_every_stretch_back():
    draw = random.Random(5)
    for n in (0, 1, 2, 7, 511, 512, 513, 2000):
        for most in (0, 1, 50, 10**6, 2**62):
            values = np.sort(np.array([draw.randint(-most, most) for _ in range(n)], np.int64))
            coded = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
            for _ in range(5):
                a = draw.randint(0, n)
                b = draw.randint(a, n)
                assert np.array_equal(coded.slice(a, b), values[a:b])
            assert all(coded.select(i) == values[i] for i in draw.sample(range(n), min(n, 5)))
    ends = np.array([-2**63, 0, 2**63 - 1])
    assert EliasFano.of(ends).slice(0, 3).tolist() == ends.tolist()


def test_elias_fano_is_near_the_least_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 3000, 100_000))
    size = 8 * len(EliasFano.of(values).to_bytes()) / len(values)
    assert size < 2 + np.log2(values[-1] / len(values)) + 0.2
    with pytest.raises(IndexError):
        EliasFano.of(values).slice(0, len(values) + 1)


@pytest.mark.parametrize("plain", [False, True])
def test_chunks_encode_like_the_whole_text(plain):
    encoder = ChunkEncoder(MODEL, plain, cache=500)
    whole = Tokenizer.from_buffer(MODEL)
    whole.encode_special_tokens = plain
    for lead in ("", " "):
        for texts in (STRANGE, STRANGE[::-1], [], [""]):
            ids, n = encoder.encode(pa.array(texts, pa.string()), lead)
            wanted = [whole.encode(lead + t, add_special_tokens=False).ids for t in texts]
            assert n.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]


def test_chunks_encode_like_the_whole_text_for_every_white_or_odd_code_point():
    encoder, whole = ChunkEncoder(MODEL), Tokenizer.from_buffer(MODEL)
    points = [c for c in range(0x3100) if not 0xD800 <= c <= 0xDFFF] + [0xFEFF, 0x1F600, 0x10FFFF]
    texts = [t for c in points for t in (f"a{chr(c)}b {chr(c)} c {chr(c)}{chr(c)}d\n{chr(c)}'s{chr(c)} ", f"a {chr(c)}\n{chr(c)}b{chr(c)}c")]
    ids, _ = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for e in whole.encode_batch(texts, add_special_tokens=False) for i in e.ids]


def read_back(spark, folder, **how):
    return sorted(token_files.read_ids(spark, folder, **how).collect(), key=lambda r: r.start)


def test_token_files_round_trip(spark, odd_rows, tmp_path):
    rows = odd_rows + [(100 + k, t, "en", "a") for k, t in enumerate(STRANGE)] + [(-2**63, "least", "en", "a"), (2**63 - 1, "most", "en", "a")]
    folder = str(tmp_path / "ids")
    token_files.write_ids(make_docs(spark, rows, clashing=True), folder)
    got = read_back(spark, folder, docs_a_read=3)
    whole = Tokenizer.from_buffer(MODEL)
    coded = [(i, tuple(whole.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t, *_ in rows]
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter(coded)
    assert [r.doc_id for r in got] == sorted((i for i, _ in coded), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0] + [len(r.ids) for r in got])[:-1].tolist()
    assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write_ids(make_docs(spark, []), folder)
    assert read_back(spark, folder) == []


def test_left_over_files_are_not_read_and_damage_is_noticed(spark, tmp_path):
    folder = tmp_path / "ids"
    token_files.write_ids(make_docs(spark, [(k, f"text {k}", "en", "a") for k in range(50)]), str(folder))
    (folder / "0000000-left-over.ids").write_bytes(b"half a file")
    assert len(read_back(spark, folder.as_uri())) == 50
    (file,) = [f for f in folder.glob("*.ids") if "left" not in f.name][:1]
    file.write_bytes(file.read_bytes()[:20] + file.read_bytes()[22:])
    with pytest.raises(Exception, match="wrong length"):
        read_back(spark, str(folder))


def test_token_file_query(spark):
    got = {r.doc_id: r for r in queries.op11_token_files(spark, SF_SMALL).collect()}
    whole, start = Tokenizer.from_buffer(MODEL), 0
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    for i, t in docs:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        assert got.pop(i)[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


# ---- operator 12

def aligned_by_hand(texts):
    """(n_a, n_b, groups, links by pair) of each text, or None, from whole-text ids."""
    a = Tokenizer.from_buffer(MODEL)
    a.encode_special_tokens = True
    b = token_alignment.Pieces(open(token_alignment.VOCABULARY_B, "rb").read())
    bytes_a = ChunkEncoder(MODEL, True).token_bytes

    def one(text):
        if not text:
            return None
        sides, want = [], (" " + text).encode()
        for ids, pieces in ((a.encode(" " + text, add_special_tokens=False).ids, bytes_a), (b.processor.encode(text), b.token_bytes)):
            if b"".join(pieces[i] for i in ids) != want:
                return None
            sides.append((ids, np.cumsum([len(pieces[i]) for i in ids]).tolist()))
        (ids_a, ends_a), (ids_b, ends_b) = sides
        groups, i, j = [], 0, 0
        for c in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(c, i) + 1, ends_b.index(c, j) + 1
            groups.append((ids_a[i:k], ids_b[j:m]))
            i, j = k, m
        return len(ids_a), len(ids_b), groups, Counter((x, y) for ga, gb in groups for x in ga for y in gb)

    return [one(t) for t in texts]


def digests(rows):
    """What op12 returns for (doc_id, text) rows, by hand."""
    hand = aligned_by_hand([t for _, t in rows])
    n = Counter(p for h in hand if h for p in h[3])
    top = {}
    for (x, _), k in n.items():
        top[x] = max(top.get(x, 0), k)
    out = []
    for (i, _), h in zip(rows, hand):
        if h is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in h[2])
        out.append((i, h[0], h[1], len(h[2]), sum(h[3].values()), sum(m for p, m in h[3].items() if n[p] == top[p[0]]),
                    sum(m * n[p] for p, m in h[3].items()), hashlib.sha256(text.encode()).hexdigest()))
    return out


def short(rows):
    return [r for r in rows if not r[1] or len(r[1]) < 6000]


@pytest.mark.parametrize("broadcast_pairs", [10**6, 0])
def test_alignment_by_broadcast_and_by_shuffle(spark, odd_rows, tmp_path, broadcast_pairs):
    rows = short(odd_rows + [(100 + k, t, "en", "a") for k, t in enumerate(STRANGE)])
    aligned = token_alignment.align(make_docs(spark, rows, clashing=True))
    path = str(tmp_path / "aligned")
    aligned.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    scored = token_alignment.score_links(spark.read.parquet(path), "row", broadcast_pairs)
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
            "" if r.groups is None else hashlib.sha256(r.groups.encode()).hexdigest()) for r in scored.collect()]
    assert Counter(got) == Counter(digests([(i, t) for i, t, *_ in rows]))


def test_words_encode_like_the_whole_text_for_both_vocabularies():
    pieces = token_alignment.Pieces(open(token_alignment.VOCABULARY_B, "rb").read())
    assert pieces.by_words
    aligner = token_alignment.Aligner(ChunkEncoder(MODEL, True, cache=50), pieces, cache=50)
    whole = Tokenizer.from_buffer(MODEL)
    whole.encode_special_tokens = True
    points = [c for c in range(0x3100)] + [0xFEFF, 0x1F600, 0x10FFFF]
    texts = [t for t in STRANGE if t] + [f"a{chr(c)}b {chr(c)} c{chr(c)} {chr(c)}d" for c in points]
    for part in (texts, texts[::-1][:500], texts[:3], []):
        a, n_a, b, n_b = aligner._tokens(pa.array(part, pa.string()))
        wanted = [whole.encode(" " + t, add_special_tokens=False).ids for t in part]
        assert n_a.tolist() == [len(w) for w in wanted] and a.tolist() == [i for w in wanted for i in w]
        wanted = [pieces.processor.encode(t) for t in part]
        assert n_b.tolist() == [len(w) for w in wanted] and b.tolist() == [i for w in wanted for i in w]


def test_alignment_forgets_and_stays_right():
    model_b = open(token_alignment.VOCABULARY_B, "rb").read()
    texts = [f"word{k % 7} and other{k}, words - here" for k in range(60)]
    hand = aligned_by_hand(texts)
    aligner = token_alignment.Aligner(ChunkEncoder(MODEL, True, cache=20), token_alignment.Pieces(model_b), cache=20)
    for k in range(0, 60, 6):
        aligner.weight = 10**9 if k % 12 else aligner.weight
        out = aligner.batch(pa.array(texts[k:k + 6]))
        assert out["n_links"].to_pylist() == [sum(h[3].values()) for h in hand[k:k + 6]]
        assert [{(p["pair"] >> 32, p["pair"] % 2**32): p["links"] for p in row} for row in out["pairs"].to_pylist()] == [dict(h[3]) for h in hand[k:k + 6]]


def test_alignment_of_an_empty_table(spark, tmp_path):
    aligned = token_alignment.align(make_docs(spark, [])).withColumn("row", F.monotonically_increasing_id())
    aligned.write.parquet(str(tmp_path / "a"))
    assert token_alignment.score_links(spark.read.parquet(str(tmp_path / "a")), "row").collect() == []


def test_alignment_query(spark, sf_copy):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.length("text") < 3000)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op12_token_alignment(spark, sf_copy(documents=docs)).collect()]
    assert sorted(got) == sorted(digests(rows))


# ---- operator 13

def runs_by_hand(w, min_length=6, min_exponent=4):
    out = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [(6, 4), (1, 2), (8, 3), (12, 2)])
def test_runs_against_brute_force(least):
    draw = random.Random(sum(least))
    for _ in range(300):
        texts = []
        for _ in range(draw.randint(0, 6)):
            n = draw.randint(0, 70)
            w = [draw.choice("abcdefgh"[:draw.choice([1, 2, 3, 8])]) for _ in range(n)]
            if n and draw.random() < 0.6:
                a, p = draw.randrange(n), draw.randint(1, 9)
                w = w[:a] + [w[a + k % min(p, n - a)] for k in range(n - a)]
            texts.append(w)
        assert repeat_runs.runs_of_batch(texts, *least) == [runs_by_hand(w, *least) for w in texts]


def test_runs_of_special_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    hard = [list(fib[-1]), list("ab" * 400 + "ba" * 300), ["x"] * 3000, [f"w{k % 37}" for k in range(3000)],
            [w for k in range(300) for w in ("the", "same", "five", "words", "again", f"u{k % 100}")]]
    assert repeat_runs.runs_of_batch(hard) == [runs_by_hand(w) for w in hard]
    assert repeat_runs.runs_of_batch(hard, 4, 2) == [runs_by_hand(w, 4, 2) for w in hard]


def test_runs_of_a_very_long_text_take_no_square_time():
    import time
    began = time.process_time()
    long = [["x"] * 200_000, [f"w{k % 4000}" for k in range(200_000)], [w for k in range(40_000) for w in ("a", "b", "c", "d", f"u{k}")]]
    assert repeat_runs.runs_of_batch(long) == [[(0, 200_000, 1)], [(0, 200_000, 4000)], []]
    assert time.process_time() - began < 60


def test_find_runs_on_odd_rows(spark, odd_rows):
    rows = odd_rows + [(50, "ha " * 9 + "end", "en", "a"), (51, "one two " * 5 + "one two", "en", "a")]
    docs = make_docs(spark, rows, clashing=True).withColumn("Found", F.lit("own"))
    out = repeat_runs.find_runs(docs)
    assert [c for c in out.columns if c.lower() == "found"] == ["found"]
    got = Counter((r.doc_id, r.text, r.found.n_words, tuple(tuple(x) for x in r.found.runs), r.found.collapsed) for r in out.collect())
    want = Counter()
    for i, t, *_ in rows:
        w = re.findall(WORD, t or "")
        runs = runs_by_hand(w) if len(w) < 5000 else []
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want[i, t, len(w), tuple(runs), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    assert got == want
    assert repeat_runs.find_runs(make_docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        repeat_runs.find_runs(docs, min_exponent=1)


def test_runs_query(spark, sf_copy):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.length("text") < 20_000).select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(STRANGE + ["a b " * k for k in range(20)])] + [(2 * 10**6, None)], docs.schema))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_repeat_runs(spark, sf_copy(documents=docs)).collect()}
    changed = 0
    for i, t in docs.collect():
        w, h = re.findall(WORD, t or ""), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        runs = runs_by_hand(w)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        s, m, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        assert got.pop(i) == (len(runs), s, m, q, 1000 * m // q if runs else None,
                              hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                              hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    assert not got and changed > 5
