"""The operators against plain definitions, on small tables with every awkward case."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from kindred.llm import (
    arrays, bpe, bwt_merge, chat, components, decontaminate, graph_ann, licences, ngram_join, packs, quality, substrings, toxicity,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1, n=120):
    """Documents with copies, near copies, shared passages, nulls, empty and very long texts."""
    rng = random.Random(seed)
    passage, hot = prose(rng, 60), prose(rng, 45)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two three"), (5, "ONE two THREE"), (6, "x" * 5000), (7, "x" * 5000)]
    for i in range(8, n):
        text = prose(rng, rng.randrange(3, 200))
        kind = rng.random()
        if kind < 0.2 and i > 20:
            text = rows[rng.randrange(8, i)][1]
        elif kind < 0.4 and i > 20:
            w = rows[rng.randrange(8, i)][1].split()
            for _ in range(rng.randrange(1, 3)):
                w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind < 0.5:
            text += "\n" + passage + "éß " + prose(rng, 20)
        elif kind < 0.8:
            text = prose(rng, 5) + "  " + hot + "\r\n" + text
        rows.append((i, text))
    rows.append((n, prose(rng, 30_000)))
    rows.append((n + 1, "again and again " * 400))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    # extra columns whose names clash with those inside the operators
    return spark.createDataFrame([(i, t, 1, "p", "b") for i, t in rows], "doc_id long, text string, pack int, bucket string, codes string"), rows


def empty(spark, schema="doc_id long, text string"):
    return spark.createDataFrame([], schema)


# -------------------------------------------------------------------------- shared helpers


def test_words_do_not_depend_on_pieces(monkeypatch):
    texts = [t or "" for _, t in corpus()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    whole = arrays.words(data, offsets, arrays.NOT_SPACE)
    monkeypatch.setattr(arrays, "PIECE", 700)
    cut = arrays.words(data, offsets, arrays.NOT_SPACE)
    for a, b in zip(whole, cut):
        assert (a == b).all()
    assert [len(t.split()) for t in texts] == np.diff(whole[3]).tolist()
    runs = [np.concatenate(x) for x in zip(*arrays.anchored_runs(whole[2], whole[3], 8, 35))]
    starts = sorted(s for a, b in zip(runs[2], runs[3]) for s in range(a, b))
    assert starts == [s for a, b in zip(whole[3][:-1], whole[3][1:]) for s in range(a, b - 34)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1400)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    nodes = [*parent, 9999]
    got = components.connected(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame([(i,) for i in nodes], "doc_id long"))
    assert {r.doc_id: r.component for r in got.collect()} == {i: find(i) for i in nodes}


# -------------------------------------------------------------------------------- 1: tokens


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


PARTS = [
    "a", "b", "e", "th", "ing", " ", "  ", "\n", "'s", "'t", "'re", "'", "Σ", "ΑΣ", "İ", "é", "é", "́", "日本", "1", "٣", "½", "!", "#",
    "<|endoftext|>", "<|startoftext|>", "\x00", "\x1c", "\x85", " ", "​", "　", "ẞ", "ﬁ", "😀", "한", "²", "_", "LL", "'LL",
]


def test_tokens_are_those_of_the_library(tokenizer):
    encoder = bpe.Encoder(bpe.Model(PATH))
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(800)]
    texts += ["".join(rng.choice(x) for _ in range(30_000)) for x in ("ab", "the", "ain", "!-", "aaab")]
    for text in texts:
        found = [x for c in encoder.chunks(text) for x in c if x[1]]
        want = tokenizer.encode(text, add_special_tokens=False)
        assert " ".join(x[0] for x in found) == " ".join(map(str, want.ids))
        assert " ".join(x[2] for x in found) == tokenizer.decode(want.ids, skip_special_tokens=False)


def test_long_pieces_leave_the_buffer(monkeypatch):
    model = bpe.Model(PATH)
    monkeypatch.setattr(bpe, "CHUNK", 64)
    rng = random.Random(3)
    for alphabet in ("ab", "the", "reain"):
        word = "".join(rng.choice(alphabet) for _ in range(20_000))
        encoder, out, most = bpe.PieceEncoder(model), [], 0
        for i in range(0, len(word), 64):
            out += encoder.feed(word[i : i + 64])
            most = max(most, len(encoder.buffer))
        out += encoder.close()
        assert most < model.reach + 64 * 4 + 64
        assert out == bpe.merge([*word[:-1], word[-1] + "</w>"], model.ranks)


def test_decoder_is_incremental_and_readable():
    model = bpe.Model(PATH)
    encoder = bpe.Encoder(model)
    ids = [int(i) for c in encoder.chunks("Été 日本 naïve") for x in c for i in x[0].split()]
    decoder = bpe.Decoder(model, readable=True)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.close() == "été 日本 naïve "


def test_encode_rows(spark, docs, tokenizer):
    got = {r.doc_id: r for r in bpe.encode_digests(docs[0], PATH).collect()}
    for i, text in docs[1]:
        want = tokenizer.encode(text or "", add_special_tokens=False)
        assert got[i].n_tokens == len(want.ids)
        assert got[i].ids_sha256 == brute.sha(" ".join(map(str, want.ids)))
        assert got[i].decoded_sha256 == brute.sha(tokenizer.decode(want.ids, skip_special_tokens=False))
    assert bpe.encode_digests(empty(spark), PATH).count() == 0


# ------------------------------------------------------------------------------- 2: quality


def test_quality_separates_and_handles_awkward_rows(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, ("spam!! " * rng.randrange(20, 60)) if bad else prose(rng, rng.randrange(30, 90))))
        labels.append((i, int(not bad), 0))
    rows += [(1000, None), (1001, ""), (1002, "a"), (None, "no identifier"), (5, rows[5][1])]
    labels += [(5, 1, 0), (7, None, 0), (None, 1, 0), (9999, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trees = quality.train(docs, labels, lambda c: F.crc32(c.cast("string")) % 5 != 0)
    got = quality.score(docs, trees).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == int(r.doc_id % 3 != 0) for r in held) >= 0.97 * len(held)
    none = quality.train(docs, labels.limit(0), lambda c: F.lit(True))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(empty(spark), trees).count() == 0


# --------------------------------------------------------------------------- 3: near copies


def test_ngram_join_is_exact(spark, docs):
    want = brute.ngram_components(docs[1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs[0]).collect()}
    assert got == want
    assert any(c != i for i, (_, c) in got.items())


def test_ngram_join_near_the_threshold(spark):
    rng = random.Random(6)
    rows = []
    for i in range(0, 300, 6):
        base = prose(rng, rng.randrange(8, 150)).split()
        for j in range(6):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 22 + 2))):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            rows.append((i + j, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()} == brute.ngram_components(rows)


@pytest.mark.parametrize("block", [4, 2048])
def test_ngram_join_of_large_classes(spark, monkeypatch, block):
    """Variants of one text around the threshold, most pairs not linked, in blocks of any size."""
    rng = random.Random(12)
    base, rows = prose(rng, 120).split(), []
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice([1, 4, 5, 6, 7])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", 1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.ngram_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()} == want
    assert 2 < len({c for _, c in want.values()})


def test_rest_of_a_class_that_both_members_skip(spark):
    """The least class that a pair shares is probed by a third member only."""
    text = prose(random.Random(15), 60)
    spots = [(1, 10, False), (1, 11, False), (1, 12, True), (2, 10, True), (2, 11, False), (2, 12, True), (3, 10, True), (3, 11, True)]
    spots = spark.createDataFrame([(s, d, 57, p, d) for s, d, p in spots], "signature long, doc_id long, n long, probe boolean, component long")
    texts = spark.createDataFrame([(10, text), (11, text + " end"), (12, text + " last")], "doc_id long, text string")
    got = [tuple(r) for r in ngram_join._rest(spots, texts, 4, 85, 100).collect()]
    assert sorted(got) == [(10, 11), (10, 12), (11, 12)]


def test_ngram_join_of_long_variants(spark):
    """Variants of one long text, many of whose shared classes both members skip."""
    rng = random.Random(16)
    base, rows = prose(rng, 1000, 10**6).split(), []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(20, 50) if i else 0):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i + 1 if i else 500, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()} == brute.ngram_components(rows)


def test_sketches_bound_the_differences():
    rng = np.random.default_rng(13)
    for n in (1, 9, 100, 1500):
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate((a[: n - n // 5], rng.integers(0, 1 << 62, n // 7).astype(np.uint64)))
        width = ngram_join.width_for(n, 85, 100)
        unequal = sum(x != y for x, y in zip(ngram_join.sketch(a, width), ngram_join.sketch(b, width)))
        assert unequal <= len(set(a.tolist()) ^ set(b.tolist()))
        assert width >= 8 and width & (width - 1) == 0


def test_folding_sketches_bound_the_differences():
    rng = np.random.default_rng(14)
    for n in (1, 9, 100, 1500):
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate((a[: n - n // 5], rng.integers(0, 1 << 62, n // 7).astype(np.uint64)))
        wide, narrow = (np.frombuffer(ngram_join.folding_sketch(a, w), np.uint8) for w in (256, 64))
        assert (wide.reshape(-1, 64).sum(0, dtype=np.uint8) == narrow).all()
        unequal = (narrow != np.frombuffer(ngram_join.folding_sketch(b, 64), np.uint8)).sum()
        assert unequal <= len(set(a.tolist()) ^ set(b.tolist()))


def test_ngram_join_reads_texts_of_open_pairs_only(spark, monkeypatch):
    """Texts that share a passage but are far apart are candidates, and no pair of them is verified."""
    rng = random.Random(21)
    passage = prose(rng, 120)
    rows = [(i, f"{passage} {prose(rng, 200, 10**6)}") for i in range(40)]
    rows += [(100 + i, f"{rows[i][1]} more") for i in range(5)]
    seen, whole = [], ngram_join.verified

    def watched(pairs, texts, n):
        seen.extend((r.a, r.b) for r in pairs.collect())
        return whole(pairs, texts, n)

    monkeypatch.setattr(ngram_join, "verified", watched)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.ngram_components(rows)
    assert sorted(seen) == [(i, 100 + i) for i in range(5)]


def test_ngram_join_of_unlike_rows_of_one_identifier(spark):
    """An identifier's rows of unlike texts: the pairs of either stay open, and rows count once."""
    rng = random.Random(22)
    one = prose(rng, 150)
    rows = [(1, one), (2, one + " end"), (2, one + " end"), (2, one + " last end"), (3, one + " more"), (3, one + " more")]
    got = sorted(tuple(r)[:3] for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [(d, c) for d, _, c in got] == [(1, 1), (2, 1), (3, 1)]


def test_narrow_keys_never_count_less():
    rng = np.random.default_rng(23)
    parts = [np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64)) for _ in range(3)]
    parts[1] = np.union1d(parts[1], parts[0][:50])
    asked = [packs.sent(i, keys, np.ones(len(keys), np.int64), 3, narrow=True) for i, keys in enumerate(parts)]
    assert all(len(k.as_py()) == 4 * len(c.as_py()) for t in asked for k, c in zip(t["keys"], t["counts"]))
    table = pa.concat_tables(asked)
    answers = [packs.answered(table.filter(pc.equal(table["bucket"], b))) for b in range(3)]
    for i, keys in enumerate(parts):
        own = [(b, c) for t in answers for p, b, c in zip(*(t[n].to_pylist() for n in ("pack", "bucket", "codes"))) if p == i]
        codes = packs.codes_of(keys, 3, *zip(*own))
        often = sum(np.isin(keys, other).astype(int) for other in parts)
        assert (codes >= often).all() and (codes == often).mean() > 0.99


def test_small_classes_list_a_pair_once(spark):
    """Pairs of a class in different components, one side probing, that fit by size."""
    spots = [(1, 10, 57, True, 10), (1, 11, 57, False, 11), (1, 12, 57, False, 12), (1, 13, 90, True, 13), (1, 14, 57, False, 10)]
    spots += [(2, 10, 57, True, 10), (2, 11, 57, True, 11), (3, 11, 57, False, 11), (3, 12, 57, False, 12)]
    spots = spark.createDataFrame(spots, "signature long, doc_id long, n long, probe boolean, component long")
    got = sorted(tuple(r) for r in ngram_join._pairs(spots, 85, 100).distinct().collect())
    assert got == [(10, 11), (10, 12)]


@pytest.mark.parametrize("paired", [2, 32])
def test_ngram_join_of_classes_either_way(spark, monkeypatch, paired):
    """Small clusters around the threshold, by pairs of small classes or by blocks."""
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    rng, rows = random.Random(24), []
    for i in range(0, 120, 12):
        base = prose(rng, 90).split()
        for j in range(12):
            w = list(base)
            for _ in range(rng.choice([0, 1, 3, 4])):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            rows.append((i + j, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()} == brute.ngram_components(rows)


def test_tidy_functions_give_memory_back(monkeypatch):
    """Whatever the kind of function, memory goes back once it is done and its result is unchanged."""
    calls = []
    monkeypatch.setattr(arrays, "give_back", lambda: calls.append(1))
    rows = arrays.tidy(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert next(rows) == 2 and not calls
    assert list(rows) == [3] and len(calls) == 1
    assert arrays.tidy(lambda key, table: (key, table))(1, 2) == (1, 2) and len(calls) == 2
    assert arrays.tidy(lambda key, table, other: other)(1, 2, 3) == 3 and len(calls) == 3


def test_ngram_join_awkward_rows(spark):
    rows = [(3, "a b c d e"), (3, "a b c d e"), (1, "A b C d e"), (None, "a b c d e"), (9, None), (8, "")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, 2, 1), (3, 2, 1), (None, 2, None), (9, 0, 9), (8, 0, 8)], key=str)
    assert ngram_join.join(empty(spark)).count() == 0


def test_capacity_survives_every_pair_of_sizes():
    bands = ngram_join.bands_of(85, 100)
    for r in (*range(1, 300), 1000, 5000):
        for s in {r, r + 1, r * 100 // 85}:
            if 100 * r >= 85 * s:
                assert bands.of(s) in bands.schemes(r) and bands.of(s) in bands.schemes(s)
                least = math.ceil(85 * (r + s) / 185)
                assert r + s - 2 * least <= bands.differences(bands.of(s))


# -------------------------------------------------------------------------- 4, 6: substrings


@pytest.mark.parametrize("window", [3, 35])
def test_repeated_windows(spark, docs, window, monkeypatch):
    got = {r.doc_id: tuple(r) for r in substrings.remove_repeats(docs[0], window).collect()}
    assert [got[i] for i, _ in docs[1]] == brute.repeats(docs[1], window)


def test_repeated_windows_over_many_packs_and_hot_prefixes(spark, docs, monkeypatch):
    monkeypatch.setattr(packs, "PACK_BYTES", 20_000)
    monkeypatch.setattr(packs, "BUCKET_BYTES", 4_000)
    monkeypatch.setattr(substrings, "HOT", 3)
    monkeypatch.setattr(bwt_merge, "HOT", 3)
    got = {r.doc_id: tuple(r) for r in substrings.remove_repeats(docs[0]).collect()}
    assert [got[i] for i, _ in docs[1]] == brute.repeats(docs[1], 35)
    got = {r.doc_id: tuple(r) for r in bwt_merge.remove_repeated_bytes(docs[0]).collect()}
    assert [got[i] for i, _ in docs[1]] == brute.byte_repeats(docs[1], 50)


def test_texts_without_repeats(spark, docs):
    rows = {r.doc_id: r for r in substrings.remove_repeats(docs[0], with_text=True, keep=("bucket",)).collect()}
    for i, text in docs[1]:
        r = rows[i]
        assert r.bucket == "p"
        if text is None:
            assert r.text is None
        else:
            assert brute.sha(" ".join(brute.SPACES.findall(r.text))) == r.kept_sha256
            if not r.n_removed:
                assert r.text == text
    assert substrings.remove_repeats(empty(spark)).count() == 0


def test_repeated_rows_count_as_two(spark):
    text = prose(random.Random(7), 40)
    df = spark.createDataFrame([(1, text), (1, text), (None, "a b"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substrings.remove_repeats(df).collect()) == [(0, 2, 0), (1, 40, 40), (1, 40, 40), (2, 0, 0)]


@pytest.mark.parametrize("size", [12, 50])
def test_repeated_bytes(spark, docs, size):
    got = {r.doc_id: tuple(r) for r in bwt_merge.remove_repeated_bytes(docs[0], size).collect()}
    assert [got[i] for i, _ in docs[1]] == brute.byte_repeats(docs[1], size)
    assert bwt_merge.remove_repeated_bytes(empty(spark)).count() == 0


def test_repeated_bytes_of_equal_identifiers(spark):
    text = "abcdefghij" * 9
    df = spark.createDataFrame([(4, text), (4, text), (None, text), (2, "-" + text)], "doc_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.n_removed) for r in bwt_merge.remove_repeated_bytes(df).collect())
    assert got == [(2, 0), (4, 90), (4, 90), (99, 90)]


def test_merged_transforms_give_the_repeated_intervals():
    rng = random.Random(8)
    contexts = ["".join(rng.choice("ab") for _ in range(rng.randrange(6, 30))).encode() for _ in range(60)]
    docs = np.array([rng.randrange(40) for _ in contexts])
    want = defaultdict(lambda: 10**9)
    for c, d in zip(contexts, docs):
        for i in range(len(c) - 5):
            want[c[i : i + 6]] = min(want[c[i : i + 6]], d)
    old, bwt_merge.SHARD_SYMBOLS = bwt_merge.SHARD_SYMBOLS, 200
    try:
        got = bwt_merge.least_in_block(contexts, docs, 6)
    finally:
        bwt_merge.SHARD_SYMBOLS = old
    assert [g.tolist() for g in got] == [[want[c[i : i + 6]] for i in range(len(c) - 5)] for c in contexts]


@pytest.mark.parametrize("letters, size", [(b"ab", 7), (bytes(range(256)), 7), (bytes(range(60, 120)), 5)])
def test_merge_hands_on_repeated_suffixes_only(letters, size, monkeypatch):
    rng = random.Random(19)
    texts = [bytes(rng.choices(letters, k=rng.randrange(size, 90))) for _ in range(80)]
    texts += [t[3:] + b"x" * size for t in texts[::4]] + [letters]
    docs = np.array([rng.randrange(40) for _ in texts])
    want = defaultdict(lambda: 10**9)
    for t, d in zip(texts, docs):
        for i in range(len(t) - size + 1):
            want[t[i : i + size]] = min(want[t[i : i + size]], d)
    monkeypatch.setattr(bwt_merge, "SHARD_SYMBOLS", 400)
    handed, merge = [], bwt_merge.merged_blocks
    monkeypatch.setattr(bwt_merge, "merged_blocks", lambda *x: handed.append(merge(*x)) or handed[-1])
    got = bwt_merge.least_in_block(texts, docs, size)
    assert [g.tolist() for g in got] == [[want[t[i : i + size]] for i in range(len(t) - size + 1)] for t in texts]
    place, first = handed[0]
    heads = np.append(np.flatnonzero(first), len(place))
    assert len(place) == len(set(place.tolist())) and (np.diff(heads) > 1).all()
    if len(letters) > 2:
        assert len(place) < sum(map(len, texts)) / 2


def test_anchors_of_few_documents_and_many_places(monkeypatch):
    """Two log-like documents whose lines share bytes: their anchors are dealt out string by string."""
    rng = random.Random(17)
    shared = "GET /index.html HTTP/1.1 status 200 from"
    line = lambda: f"{rng.randrange(10**9):09d} {shared} {rng.randrange(10**9):09d}"
    lines = [line() for _ in range(300)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([line() for _ in range(300)] + lines[::3])), (3, "short")]
    monkeypatch.setattr(bwt_merge, "HOT", 127)
    # the steps of one pack and one bucket, in this process
    key, table = (pa.scalar(0),), pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    answers = getattr(bwt_merge, "answered", packs.answered)(bwt_merge._ask(1, 50)(key, table))
    pack = bwt_merge._Pack(table, 50)
    codes = np.frombuffer(answers["codes"][0].as_py(), np.uint8)
    assert (codes >= bwt_merge.HOT).any()
    _, _, _, _, anchors, texts, _, where = pack.contexts(codes)
    hot = np.isin(anchors, pack.keys[codes >= bwt_merge.HOT])
    assert {len(t) for t, h in zip(texts, hot) if h} == {50} and len(set(where[hot].tolist())) > 300
    masks = bwt_merge._judge(50)(bwt_merge._send(1, 1, 50)(key, table, answers))
    both = pa.concat_tables([t.append_column("kind", pa.array([k] * t.num_rows)) for t, k in ((answers, "filter"), (masks, "masks"))])
    got = bwt_merge._remove(1, 1, 50)(key, table, both).to_pylist()
    assert [tuple(r.values()) for r in got] == brute.byte_repeats(rows, 50)


def test_more_shards_than_a_byte_counts(monkeypatch):
    rng = random.Random(18)
    contexts = ["".join(rng.choice("ab") for _ in range(20)).encode() for _ in range(700)]
    docs = np.array([rng.randrange(400) for _ in contexts])
    want = defaultdict(lambda: 10**9)
    for c, d in zip(contexts, docs):
        for i in range(len(c) - 5):
            want[c[i : i + 6]] = min(want[c[i : i + 6]], d)
    monkeypatch.setattr(bwt_merge, "SHARD_SYMBOLS", 30)
    got = bwt_merge.least_in_block(contexts, docs, 6)
    assert [g.tolist() for g in got] == [[want[c[i : i + 6]] for i in range(len(c) - 5)] for c in contexts]
    with pytest.raises(ValueError):
        bwt_merge.merged_blocks([np.zeros(1, np.uint16)] * ((1 << 16) + 1), 1)


# ------------------------------------------------------------------------- 5: contamination


def leak_items(rows):
    words = rows[30][1].split()
    return [
        (1, " ".join(words[2:20])), (2, "CHANGED"), (3, None), (4, ""), (5, " ".join(words[2:20]).upper()), (5, "w1, w2"),
        (10, " ".join(words[5:15]) + "!"), (7, "not in any document at all, whatever one may try"), (2, "CHANGED"),
    ]


def test_clean_takes_one_python_worker_a_task(spark, docs, monkeypatch):
    benchmark = spark.createDataFrame(leak_items(docs[1]), "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)  # several blocks
    marked = decontaminate.mark(docs[0], benchmark, keep=("bucket",))
    clean = decontaminate.clean(docs[0], benchmark, keep=("bucket",))
    for df in (marked, clean):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = decontaminate.cleaned(marked)
    assert clean.schema == want.schema and sorted(map(str, clean.collect())) == sorted(map(str, want.collect()))
    texts = {i: t for i, t in docs[1]}
    assert any(r.text != texts[r.doc_id] for r in clean.collect())


def test_decontamination(spark, docs, monkeypatch):
    items = leak_items(docs[1])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    marked = decontaminate.mark(docs[0], benchmark, keep=("bucket",))
    got = {r.doc_id: tuple(r) for r in decontaminate.digests(marked).collect()}
    want = brute.leaks(docs[1], items, 10)
    assert [got[i] for i, _ in docs[1]] == want and any(w[5] for w in want)
    clean = decontaminate.cleaned(marked)
    assert clean.columns == ["doc_id", "text", "bucket"]
    texts = {r.doc_id: r.text for r in clean.collect()}
    for (i, text), w in zip(docs[1], want):
        if not w[2]:
            assert texts[i] == text
        else:
            assert len(brute.LETTERS.findall(texts[i])) == w[1] - w[2]
    # in blocks, one pass each
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    got = {r.doc_id: tuple(r) for r in decontaminate.digests(decontaminate.mark(docs[0], benchmark)).collect()}
    assert [got[i] for i, _ in docs[1]] == want
    none = decontaminate.digests(decontaminate.mark(docs[0], benchmark.limit(0))).collect()
    assert {(r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in none} == {(0, 0, hashlib.sha256(b"").hexdigest(), False)}
    assert decontaminate.mark(empty(spark), benchmark).count() == 0


# ------------------------------------------------------------------------------ 7: neighbours


def exact_neighbours(rows, k):
    out = {}
    for q, x in rows.items():
        if q % 100 == 0:
            near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))), v) for v, y in rows.items() if v != q and len(y) == len(x))
            out[q] = near[:k]
    return out


def test_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = {i: rng.normal(size=16).astype(np.float32).tolist() for i in range(1500)}
    for i in range(400, 700):
        rows[i] = rows[3]  # a vector that many rows hold
    rows[100] = rows[3]
    table = [*rows.items(), *list(rows.items())[:20], (5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5004, []), (None, rows[1]), (5100, [1.0, 2.0]), (5101, [1.0, 2.5])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
    monkeypatch.setattr(graph_ann, "SHARD_ROWS", 400)
    got = defaultdict(list)
    for r in graph_ann.nearest(df, df.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    want = exact_neighbours({**rows, 5100: [1.0, 2.0], 5101: [1.0, 2.5]}, 10)
    assert got.keys() == want.keys() and got[5100] == [(0.5, 5101)]
    found = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert found >= 0.95 * sum(map(len, want.values()))
    assert [v for _, v in got[100]] == [3, *range(400, 409)]
    assert graph_ann.nearest(df.limit(0), df.limit(0)).count() == 0


# -------------------------------------------------------------------------------- 8: licences


def test_licences(spark):
    mit = licences.TEMPLATES["MIT"]
    rows = [
        (1, "prose here\nReleased under the MIT License.\nmore"), (2, mit), (3, "Intro line\n\n" + mit.replace("free of charge", "gratis") + "\n\nend"),
        (4, "licensed under cc by-nc 4.0"), (5, None), (6, ""), (7, "nothing of the kind " * 3000), (8, "Licensed under CC BY 4.0.\nReleased under the MIT License."), (8, "mit"),
    ]
    got = licences.scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licence string")).collect()

    def best(text):
        hits = []
        for u in licences.units(text or ""):
            bag, top = licences.bigrams(u), None
            for i, (name, t) in enumerate(licences.TEMPLATES.items()):
                own = licences.bigrams(t)
                dice = 2 * sum((bag & own).values()) / max(1, sum(bag.values()) + sum(own.values()))
                if dice >= licences.THRESHOLD and (top is None or dice > top[0]):
                    top = dice, -i, name
            hits += [top] if top else []
        return max(hits)[2] if hits else None, len(hits)

    assert [(r.licence, r.n_matches) for r in got] == [best(t) for _, t in rows]
    assert [r.licence for r in got[:4]] == ["MIT-notice", "MIT", "MIT", "CC-BY-NC-4.0-notice"]
    assert licences.scan(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        licences.scan(empty(spark), {"x": "y" * (licences.TEMPLATE_BYTES + 1)})


def test_licences_inside_longer_texts(spark):
    rng = random.Random(19)
    mit, header = licences.TEMPLATES["MIT"], licences.TEMPLATES["Apache-2.0-header"]
    cut = lambda t, *at: "\n\n".join(t[a:b] for a, b in zip((0, *at), (*at, len(t))))
    w = mit.split()
    rows = [
        (1, cut(mit, mit.index("The above copyright"), mit.index("THE SOFTWARE IS")) + "\n\n" + prose(rng, 1000)),
        (2, prose(rng, 500) + "\n\n" + cut(header, header.index("You may obtain"), header.index("Unless")) + "\n\n" + prose(rng, 500)),
        (3, "Notes on the build. Released under the MIT License. See the wiki for all that is not said here, and ask."),
        (4, "Some words before it, released under\nthe MIT License. And then the paragraph goes on and on and on\nfor lines and more lines."),
        (5, prose(rng, 300) + "\n\n" + " ".join([*w[:80], *(f"v{i}" for i in range(35)), *w[80:]]) + " " + prose(rng, 300)),
        (6, prose(rng, 300) + " This work is licensed under the GNU General Public License, version 2. " + prose(rng, 300)),
        (7, "The license of the software is under the terms of others. " * 50),
    ]
    got = [(r.licence, r.n_matches) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert got == [("MIT", 1), ("Apache-2.0-header", 1), ("MIT-notice", 1), ("MIT-notice", 1), ("MIT", 1), ("GPL-2.0-notice", 1), (None, 0)]
    for _, text in corpus()[1:]:
        words, places = licences.placed(text or "")
        assert [words[a:b] for a, b in places] == [licences._WORD.findall(u.lower()) for u in licences.units(text or "")]


# ------------------------------------------------------------------------------------ 9: chats


def test_snapshots_collapse(spark):
    turns = [("user", "hi"), ("assistant", "hello"), ("user", None), ("assistant", ""), (None, "x" * 100_000)]
    rows = []
    for c in range(1, 6):
        rows += [(c, i, *t) for i, t in enumerate(turns[:c])]
    rows += [(6, i + 10, *t) for i, t in enumerate(turns)]  # equal to 5 under other turn numbers
    rows += [(7, 0, "user", "other"), (7, 0, "user", "other"), (7, 1, "assistant", "a"), (8, 0, "user", "other"), (8, 1, "assistant", "b")]
    rows += [(None, 0, "user", "lost"), (9, None, "user", "hi")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, place int")
    got = {r.conv_id: r for r in chat.render(df).collect()}
    assert {c: (r.n_turns, r.n_copies) for c, r in got.items()} == {5: (5, 2), 7: (2, 1), 8: (2, 1)}
    assert got[8].rendered == "<|user|>\nother\n<|end|>\n<|assistant|>\nb\n<|end|>"
    assert chat.render(df.limit(0)).count() == 0
    plan = chat.render(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --------------------------------------------------------------------------------- 10: toxicity


def test_toxicity(spark):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        words = prose(rng, 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(["scum", "loweiung", "loweiheit", "loweisch"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(2000, None), (2001, ""), (None, "scum"), (2002, "you SCUM"), (6, rows[6][1])]
    labels += [(6, 1, 1), (7, 1, None), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, label string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, labels, lambda c: F.crc32(c.cast("string")) % 4 != 2).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    of = {r.doc_id: r for r in got}
    assert of[2002].predicted == 1 and of[2001].predicted == 0 and of[2000].neighbours == []
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.predicted == int(r.doc_id % 6 == 0) for r in held)
    assert all(r.doc_id not in r.neighbours for r in got)
    none = toxicity.score(docs, labels.limit(0), lambda c: F.lit(True)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score(docs.limit(0), labels, lambda c: F.lit(True)).count() == 0


def test_terms_beside_stronger_ones_stay(spark):
    """A held-out text is toxic by a term that the labelled rows hold beside stronger terms only."""
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        # one row labelled wrongly holds a weaker term alone
        insults = ["scum", "idiot", *(["moron"] if i % 12 else []), *(["clown"] if i % 24 else [])] if bad else ["moron"] if i == 1 else []
        rows.append((i, " ".join([prose(rng, 40), *insults])))
        labels.append((i, int(bad)))
    rows += [(1000, prose(rng, 40) + " moron"), (1001, prose(rng, 40) + " clown"), (1002, prose(rng, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), lambda c: c < 1000)
    got = {r.doc_id: r for r in scored.filter("doc_id >= 1000").collect()}
    assert [got[i].predicted for i in (1000, 1001, 1002)] == [1, 1, 0]
    # every term tied to the label stays in the vocabulary, however strong the others are
    sample = toxicity.labelled_sample(spark.createDataFrame(labels, "doc_id long, toxic int"), lambda c: c < 1000).collect()
    assert {"scum", "idiot", "moron", "clown"} <= set(toxicity.vocabulary(docs, sample))


def test_block_max_search_is_exact():
    rng = random.Random(11)
    vectors = []
    for _ in range(500):
        raw = {rng.randrange(60): rng.random() + 0.1 for _ in range(rng.randrange(1, 9))}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / norm for t, w in raw.items()})
    index = toxicity.BlockMaxIndex(vectors, [i % 2 for i in range(500)], list(range(500)), 60)
    for q in vectors[:80]:
        every = sorted(((-round(sum(w * v.get(t, 0) for t, w in q.items()), 12), i) for i, v in enumerate(vectors)))
        want = [(-s, i) for s, i in every if s < 0][:15]
        places, sims = index.nearest(q, 15)
        assert np.allclose(sims, [s for s, _ in want]) and len(places) == len(want)
        assert min(sims) == pytest.approx(want[-1][0])
