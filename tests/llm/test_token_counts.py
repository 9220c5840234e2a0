"""Operator 13 against the tokenizers library, case by case and on a given table."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [
    "", " ", "\t\t\n  \r\n", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "<|endoftext", "  hello   world \n\n x",
    "don't I'll 123 4567 'S", "é" * 300, "x" * 20_000, "日本語のテキスト", "emoji 😀😀 ok", "aaaaaaaaaaaaaaaa",
    "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_heap_merging_equals_library(library):
    model = token_counts.ByteBPE(PATH)
    for text in AWKWARD:
        expected = len(library.encode(text, add_special_tokens=False).ids)
        assert model.count(text) == expected, text[:40]


def test_query_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(100, None), (None, "no id"), (3, "a<|endoftext|>b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = token_counts.count_tokens(docs, PATH, limit=5).collect()
    assert len(got) == len(rows)
    by_key = {(r.doc_id, r.n_bytes): r for r in got}
    for doc_id, text in rows:
        row = by_key[(doc_id, len((text or "").encode()))]
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert row.n_tokens == n and row.over_limit == (n > 5)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(docs, PATH).collect() == []


def test_given_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PATH).collect()}
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    encoded = library.encode_batch([t for _, t in texts], add_special_tokens=False)
    assert got == {i: len(e.ids) for (i, _), e in zip(texts, encoded)}
