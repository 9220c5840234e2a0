"""The pipeline's stages on given tables, against plain code, and on awkward rows."""

import random

import brute
import public_tokenizers
import pytest

import corpus_pipeline as cp
from kindred.llm import toxicity
from kindred.llm.queries import toxicity_rows

SMALL = "/root/testdata/sf0.001"


def test_run_is_the_stages_in_plain_code(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rejected = {r.doc_id for r in toxicity.score(docs, labels, toxicity_rows).filter("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in rejected]
    components = brute.ngram_components(rows)
    rows = [(i, t) for i, t in rows if components[i][1] == i]
    rows = [(i, brute.without_repeats(t, rows_seen, 35)) for rows_seen in [brute.window_counts(rows, 35)] for i, t in rows]
    rows = [(i, brute.without_leaks(t, items, 10)) for i, t in rows]
    want = {}
    for i, t in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), brute.sha(" ".join(map(str, ids))))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in cp.run(spark, SMALL).collect()}
    assert got == want and rejected


def test_stages_keep_the_columns_and_awkward_rows(spark):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    text = words(80)
    rows = [(1, text, "en", "s", 3), (2, text, "en", "s", 3), (2, text, "en", "s", 3), (3, None, None, None, None), (4, "", "en", "s", 0), (None, words(9), "en", "s", 1), (5, words(20_000), "de", "s", 1)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    for _, stage in cp.STAGES[:-1]:
        for d in (docs, docs.limit(0)):
            out = stage(spark, d, SMALL)
            assert out.columns == list(cp.COLUMNS) and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
            out.collect()
    kept = cp.drop_near_duplicates(spark, docs, SMALL).collect()
    assert sorted(r.doc_id if r.doc_id is not None else 0 for r in kept) == [0, 1, 3, 4, 5]
    assert cp.encode(spark, docs, SMALL).count() == len(rows)


def test_entry_lists_every_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and len(cp.STAGES) == 5
