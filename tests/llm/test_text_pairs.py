"""Operators 2, 8 and 9, the components, and the pipeline."""

import collections
import random
import re

import numpy as np
import pytest
import xxhash
from conftest import SF_MID, SF_SMALL
from llm.conftest import make_docs

import corpus_pipeline
from charloom.llm import components, decontamination, queries, sentence_pieces, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """{id: smallest id reachable} from {id: fingerprint}, over all pairs."""
    ids = sorted(fps)
    f = np.array([fps[i] for i in ids], np.uint64)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(f[k + 1:] ^ f[k]) <= 3):
            a, b = find(i), find(ids[k + 1 + j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_on_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = queries.op8_simhash_near_dedup(spark, SF_MID).collect()
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_components(fps)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{f:016x}", want[i]) for i, f in fps.items()}


@pytest.mark.parametrize("block", [4, 2048])
def test_links_connect_what_all_pairs_connect(spark, block):
    rnd = random.Random(block)
    fps = set()
    for _ in range(40):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 40])):
            fps.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))))
            if rnd.random() < 0.3:
                centre ^= 1 << rnd.randrange(32)
    fps |= {0, 1, 3, 7, 15 << 30, (1 << 64) - 1, (1 << 64) - 2}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.links(df, block=block)
    for a, b in links.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    unsigned = {s: f for s, f in zip(signed, fps)}
    want = plain_components({s: unsigned[s] for s in signed})
    assert {s: roots.get(s, s) for s in signed} == want


def test_components_of_chains_stars_and_self_links(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3), (1, 9), (9, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(200, 260)} | {7: 7, 1: 1, 9: 1}
    assert got == want
    assert components.connected_components(df.where("a > 1000")).count() == 0


def test_simhash_odd_rows_and_keep_one(spark, odd_rows):
    docs = make_docs(spark, odd_rows, clashing=True)
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(odd_rows)
    blank = {r.component_id for r in out if r.fingerprint == "0" * 16}
    assert blank == {3}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    # one row per component: 1 (three copies), 3 (blank texts), 6, 7, the two texts of 8, and the text without an id
    assert collections.Counter(r.doc_id for r in rows) == {1: 1, 3: 1, 6: 1, 7: 1, 8: 2, None: 1}
    nulls = docs.where("doc_id is null")
    assert simhash.keep_one(nulls).count() == 2
    assert simhash.near_duplicates(docs.where("doc_id > 99")).count() == 0


def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -0.5), h[i - 1, j] - 0.5, h[i, j - 1] - 0.5)
    return h.max()


def test_alignment_against_the_full_table():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        a = rnd.integers(0, 6, rnd.integers(1, 12))
        b = rnd.integers(-1, 6, rnd.integers(1, 30))
        score, x, y = decontamination.align(a, b)
        assert score == plain_align(a, b)
        assert score == 0 or plain_align(a, b[x:y]) == score


def edited(words, rnd, rate):
    out = []
    for w in words:
        r = rnd.random()
        if r < rate / 3:
            continue
        out.append("new" + str(rnd.randrange(99)) if r < 2 * rate / 3 else w)
        if r > 1 - rate / 3:
            out.append("extra")
    return out


def test_leaks_exact_and_edited_and_common(spark):
    rnd = random.Random(9)
    filler = [f"f{k}" for k in range(400)] + ["the", "of", "and"] * 60
    say = lambda n: [rnd.choice(filler) for _ in range(n)]
    items = [(k, [rnd.choice(["the", "of", f"q{k}x{j}", f"r{k}y{j}", f"s{rnd.randrange(50)}"]) for j in range(rnd.randint(14, 40))])
             for k in range(12)]
    rows, leaky = [], set()
    for i in range(400):
        words = say(rnd.randint(20, 150))
        if i % 4 == 0:  # one item sits in a quarter of all documents
            at = rnd.randrange(len(words))
            words[at:at] = items[0][1]
            leaky.add((i, 0))
        if i % 10 == 1:
            k = 1 + rnd.randrange(11)
            at = rnd.randrange(len(words))
            words[at:at] = edited(items[k][1], rnd, 0.2)
            leaky.add((i, k))
        rows.append((i, " ".join(w.title() if i % 3 else w for w in words) + ".", "en", "s"))
    docs = make_docs(spark, rows, clashing=True)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench).collect()}
    assert got <= leaky and len(got) >= len(leaky) - 2
    blocks = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench, block_items=3).collect()}
    assert blocks == got
    clean = decontamination.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(400)) - {i for i, _ in got}


def test_long_leaks_below_the_share(spark):
    rnd = random.Random(12)
    items = [[f"i{k}x{j}" for j in range(n)] for k, n in enumerate((59, 300, 59))]
    items[2] = [f"common{j}" for j in range(20)] + items[2][20:]
    swapped = [f"new{j}" if rnd.random() < 0.35 else w for j, w in enumerate(items[0])]
    parts = [items[0][10:35], items[1][100:240], swapped, items[0][:10], ["alone"]]
    rows = [(i, " ".join(["before", *p, "after"]), "en", "s") for i, p in enumerate(parts)]
    # Twenty words of item 2 that many documents hold are no leak.
    rows += [(i, " ".join(items[2][:20]) + f" own{i}", "en", "s") for i in range(10, 60)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id int, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.find_leaks(make_docs(spark, rows), bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 0)}
    assert got[0, 0] == 25 and got[1, 1] == 140


def test_short_and_unspaced_items_inside_documents(spark):
    rows = [(0, "here Xyzzy stands", "en", "s"), (1, "and plugh, twice it is", "en", "s"), (2, "plugh it twice", "en", "s"),
            (3, "我们今天去公园看花。明天再说", "zh", "s"), (4, "前文、日本の首都は東京である。後文", "ja", "s"), (5, "xyzzyx", "en", "s"), (6, "東京", "ja", "s")]
    bench = spark.createDataFrame([(0, "xyzzy"), (1, "plugh twice"), (2, "今天去公园看花"), (3, "日本の首都は東京である"), (4, "公园")],
                                  "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(make_docs(spark, rows), bench).collect()}
    assert got == {(0, 0), (1, 1), (3, 2), (4, 3), (3, 4)}


def test_leaks_odd_rows_and_items(spark, odd_rows):
    docs = make_docs(spark, odd_rows, clashing=True)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (4, "another text of the same id"), (4, "another text of the same id"),
                                   (None, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5 w6x6")], "item_id int, text string")
    got = collections.Counter((r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench).collect())
    assert got[8, 4] == 2 and got[7, None] == 1 and got[6, 3] == 1
    assert {k[1] for k in got} <= {3, 4, None}
    assert decontamination.find_leaks(docs.where("doc_id > 99"), bench).count() == 0
    assert decontamination.find_leaks(docs, bench.where("item_id > 9")).count() == 0
    assert decontamination.without_leaks(docs, bench.where("item_id > 9")).count() == len(odd_rows)


def test_leaks_on_table_hold_the_item(spark):
    docs = {r.doc_id: decontamination.words_of(r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    items = {r.item_id: decontamination.words_of(r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.op2_decontamination(spark, SF_MID).collect()}
    spaced = {i: b" " + b" ".join(w) + b" " for i, w in docs.items()}
    whole = {(d, k) for k, w in items.items() for d, t in spaced.items() if b" " + b" ".join(w) + b" " in t}
    assert whole <= got and len(got - whole) <= 2


@pytest.fixture(scope="module")
def vocab():
    return sentence_pieces.load_vocabulary()


ODD = ["", None, "a", " ", "   x  ", "▁x ▁▁ y", "漢字かな é🙂🙂\n\t", "x" * 3000 + " " + "ab" * 500, "\x00  a", "A  b\r\n"]


def test_pieces_lossless_and_independent_of_batches(vocab):
    keys = np.arange(len(ODD)) * 7919
    whole = sentence_pieces.encode_batch(ODD, keys, vocab)
    for text, key, ids in zip(ODD, keys, whole):
        one = sentence_pieces.encode_batch([text], np.array([key]), vocab)[0]
        assert (text is None) == (ids is None)
        if text is not None:
            assert ids.tolist() == one.tolist()
            assert sentence_pieces.decode_ids(ids.tolist(), vocab.raw) == text
    other = sentence_pieces.encode_batch(ODD, keys + 1, vocab)
    assert other[7].tolist() != whole[7].tolist()


def test_pieces_cut_between_slices_alike(vocab, monkeypatch):
    text = " ".join(f"word{k} there" for k in range(400))
    whole = sentence_pieces.encode_batch([text, "tail"], np.array([3, 4]), vocab)
    monkeypatch.setattr(sentence_pieces, "SLICE", 50)
    again = sentence_pieces.encode_batch([text, "tail"], np.array([3, 4]), vocab)
    assert [a.tolist() for a in again] == [w.tolist() for w in whole]


def test_pieces_follow_the_lattice_distribution(vocab):
    known = {p: i for i, p in enumerate(vocab.pieces) if i >= 259}

    def paths(word):
        if not word:
            yield (), 1.0
        for k in range(1, len(word) + 1):
            if word[:k] in known:
                i = known[word[:k]]
                for rest, p in paths(word[k:]):
                    yield (i, *rest), p * vocab.weights[i]

    truth = dict(paths("▁there"))
    total, n = sum(truth.values()), 40_000
    got = collections.Counter(tuple(i.tolist()) for i in sentence_pieces.encode_batch(["there"] * n, np.arange(n), vocab))
    assert set(got) <= set(truth)
    for path, p in truth.items():
        assert abs(got[path] / n - p / total) < 4 * (p / total / n) ** 0.5 + 1e-4


def test_pieces_query(spark, odd_rows, sf_copy):
    rows = queries.op9_sentence_pieces(spark, SF_SMALL).collect()
    assert all(r.lossless and r.n_pieces == len(r.pieces) for r in rows)
    again = {r.doc_id: r.pieces for r in queries.op9_sentence_pieces(spark, SF_SMALL).collect()}
    assert {r.doc_id: r.pieces for r in rows} == again
    odd = queries.op9_sentence_pieces(spark, sf_copy(documents=make_docs(spark, odd_rows, clashing=True))).collect()
    assert len(odd) == len(odd_rows) and all(r.lossless for r in odd)
    assert [(r.n_pieces, r.pieces) for r in odd if r.doc_id == 3] == [(0, None)]
    docs = make_docs(spark, odd_rows, clashing=True)
    back = sentence_pieces.decode(sentence_pieces.encode(docs)).collect()
    assert all(r.decoded == r.text for r in back)
    assert sentence_pieces.decode(sentence_pieces.encode(docs.where("doc_id > 99"))).count() == 0


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentence_pieces"]
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in seen.select("doc_id", "text").collect()}
        seen = stage(spark, seen, SF_MID).cache()
        after = {r.doc_id: r.text for r in seen.select("doc_id", "text").collect()}
        assert set(after) <= set(before)
        if name == "line_dedup":
            assert set(after) == set(before) and after != before
        elif name == "simhash_near_dedup":
            want = plain_components({i: plain_fingerprint(t) for i, t in before.items()})
            assert set(after) == set(want.values())
        elif name != "sentence_pieces":
            assert seen.columns == columns and len(after) < len(before)
        if name != "line_dedup":
            assert all(before[i] == t for i, t in after.items())
    assert seen.where("not lossless").count() == 0
    final = {r.doc_id: r.pieces for r in corpus_pipeline.run(spark, SF_MID).collect()}
    assert final == {r.doc_id: r.pieces for r in seen.collect()}


def test_pipeline_odd_and_empty_tables(spark, odd_rows, sf_copy):
    docs = make_docs(spark, odd_rows, clashing=True)
    folder = sf_copy(documents=docs, benchmark=spark.createDataFrame([(1, "x")], "item_id long, text string"))
    for table in (docs, docs.where("doc_id > 99")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, folder)
            assert out.columns[:len(docs.columns)] == docs.columns or name == "sentence_pieces"
            out.count()
    assert corpus_pipeline.run(spark, folder).count() >= 1


def test_pipeline_keeps_the_columns_of_its_input(spark, sf_copy):
    own = {"a.b": "concat('dot', doc_id)", "n_words": "doc_id * 3", "kept": "doc_id = 3", "N_Removed": "concat('r', doc_id)",
           "failed_rule": "'mine'", "n_stutter": "7", "_own0": "doc_id + 1", "n_lines": "-1"}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    docs = docs.selectExpr("*", *[f"{e} as `{c}`" for c, e in own.items()])
    folder = sf_copy(documents=docs, benchmark=spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows
        for r in rows:
            i = r["doc_id"]
            assert (r["a.b"], r["n_words"], r["kept"], r["N_Removed"], r["failed_rule"], r["n_stutter"], r["_own0"], r["n_lines"]) == (
                f"dot{i}", 3 * i, i == 3, f"r{i}", "mine", 7, i + 1, -1), name


def test_pipeline_cuts_boilerplate_of_any_length(spark):
    rows = [(i, f"own line {i}\n\nAll rights reserved.\n版权所有不得转载\nOnly here {i % 4}", "en", f"s{i % 6}" if i else None) for i in range(12)]
    cut = dict(corpus_pipeline.STAGES)["line_dedup"](spark, make_docs(spark, rows), SF_SMALL)
    got = {r.doc_id: r.text for r in cut.collect()}
    assert got[0] == rows[0][1]
    for i in range(1, 12):  # blank lines, and lines on three sites, stay
        assert got[i] == f"own line {i}\n\nOnly here {i % 4}"
