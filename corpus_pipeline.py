"""Documents to training tokens: reject, deduplicate, clean, encode.

``run(spark, sf_dir)`` applies ``STAGES`` to the documents table in turn; each result is written
as Parquet in the cluster's shared folder and read again.  All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.deploy import ship
from kindred.llm import bpe, decontaminate, ngram_join, substrings, toxicity
from kindred.llm.queries import TOKENIZER, table, toxicity_rows
from kindred.operators.stage import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    ship(spark)
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), toxicity_rows)
    rejected = scored.filter("predicted = 1").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least identifier stays of each group; rows without identifier stay."""
    ship(spark)
    kept = ngram_join.join(docs).filter("doc_id = component_id").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*COLUMNS).union(
        docs.filter("doc_id is null").select(*COLUMNS)
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand elsewhere too are cut from the texts."""
    ship(spark)
    return _documents(substrings.remove_repeats(docs, with_text=True, keep=("lang", "source")))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark phrases are cut from the texts."""
    ship(spark)
    return _documents(decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), keep=("lang", "source")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that are left."""
    ship(spark)
    return bpe.encode_digests(docs, TOKENIZER)


STAGES = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", cut_benchmark),
    ("BPE encoding and decoding", encode),
]

#: SQL can't express the stages (nearest examples, encoding); tests/llm compares run() with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_folder(spark, f"stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
