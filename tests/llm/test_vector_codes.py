"""Operator 12 against plain rounds of k-means without bounds."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from kindred.llm import vector_codes


def plain(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, vector, label).  Returns {vec_id: (code, error)}, per-label sums, digest."""
    kept = [
        (v, [math.floor(1024 * float(x)) for x in vec], lab)
        for v, vec, lab in rows
        if vec and all(x is not None and math.isfinite(x) for x in vec)
    ]
    kept.sort(key=lambda r: (r[0], r[1]))
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    w = dim // parts
    cut = lambda vec, p: vec[p * w : (p + 1) * w]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        best = min(range(len(d)), key=lambda j: (d[j], j))
        return best, d[best]

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for r in kept:
                x = cut(r[1], p)
                groups.setdefault(nearest(x, books[p])[0], []).append(x)
            for j, xs in groups.items():
                books[p][j] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = {}, {}
    for v, vec, lab in kept:
        code, err = "", 0
        for p in range(parts):
            j, d = nearest(cut(vec, p), books[p])
            code += f"{j:02x}"
            err += d
        out.setdefault(v, []).append((code, err))
        by_label[lab] = by_label.get(lab, 0) + err
    digest = hashlib.sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    return out, by_label, digest


def table(rng, n, dim=8):
    rows = []
    for i in range(n):
        centre = rng.randrange(5)
        rows.append((i * 7 % (n + 3), [rng.gauss(centre, 0.3) for _ in range(dim)], rng.choice([1, 2, None])))
    rows += [(n + 1, None, 1), (n + 2, [], 1), (n + 3, [1.0] * (dim - 1) + [float("nan")], 2),
             (n + 4, [float("inf")] * dim, None), (n + 5, [0.5] * (dim + 4), 1), (3, rows[3][1], 2)]
    return rows


@pytest.mark.parametrize("entries", [256, 6])
def test_codes_equal_plain_rounds(spark, entries):
    rows = table(random.Random(3), 120)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("clash"))
    # Compare on what Spark stored: single precision.
    stored = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    expected, by_label, digest = plain(stored, entries=entries)
    got = vector_codes.compress(df, entries=entries).collect()
    assert sum(len(v) for v in expected.values()) == len(got)
    for r in got:
        assert (r.code, r.error) in expected[r.vec_id]
        assert r.label_error == by_label[r.label]
        assert r.codebooks_sha256 == digest


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    stored = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    expected, by_label, digest = plain(stored)
    got = vector_codes.compress(df).collect()
    assert {r.vec_id: [(r.code, r.error)] for r in got} == expected
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_empty(spark):
    df = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(df).collect() == []
