"""Operator 11 against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kindred.llm import collocations


def plain(rows, least=10, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        rows_ = []
        for p, a in cands.items():
            cuts = [(a * a * 1_000_000 // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [q for q in cands if len(q) == 3 and len(p) == 2 and (q[:2] == p or q[1:] == p)]
            if any(100 * cands[q] >= 50 * a for q in longer):
                continue
            rows_.append((lang, " ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        rows_.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows_[:top])]
    return sorted(out)


def corpus(rng, n=300):
    words = "the of new york city big apple red wine Zed é x".split()
    rows = []
    for _ in range(n):
        text = " ".join(rng.choice(words) + rng.choice(["", "", ",", ".", "\n", "\t", "  "]) for _ in range(rng.randrange(0, 40)))
        rows.append((text if rng.random() > 0.05 else None, rng.choice(["en", "fr", None])))
    rows.append(("new york " * 2000, "en"))  # one long piece
    return rows


@pytest.mark.parametrize("shard_words", [7, 1 << 20])
def test_equals_plain_count(spark, shard_words):
    rows = corpus(random.Random(4))
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("phrase", F.lit("clash"))
    got = collocations.collocations(docs, least=10, top=25, shard_words=shard_words)
    assert got.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r)[:8] for r in got.collect()) == plain(rows, top=25)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    got = collocations.collocations(docs).collect()
    assert sorted(tuple(r)[:8] for r in got) == plain(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(docs).collect() == []


def test_pair_is_sent_once_with_its_third_words():
    words = "a b c a b d a b a b c".split()
    part = pa.array(words), *(np.array([x]) for x in (0, len(words), len(words)))
    rows = pa.Table.from_batches(list(collocations._shard_counts("en", [part]))).to_pylist()
    keys = [r["key"] for r in rows]
    assert len(keys) == len(set(keys))  # no row of its own for a three-word phrase
    assert all(r["key"].count(" ") < 2 for r in rows)
    got = {r["key"]: dict(zip(r["lasts"].split(" "), map(int, r["counts"].split(" ")))) for r in rows}
    assert got["en\t"] == {"": 11}
    assert got["en\ta"] == {"": 4}
    assert got["en\ta b"] == {"": 4, "c": 2, "d": 1, "a": 1}
    assert got["en\tb a"] == {"": 1, "b": 1}
