"""The queries of this subpackage over the given tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..deploy import ship
from . import (
    bpe, bwt_merge, chat, collocations, decontaminate, graph_ann, licences, ngram_join, quality, substrings, token_counts,
    toxicity, vector_codes,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COUNTED = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(doc_id, modulus: int):
    """crc32 of the identifier's decimal text, modulo a number."""
    return F.crc32(doc_id.cast("string")) % modulus


def toxicity_rows(doc_id):
    """Rows whose toxicity labels may be learned from."""
    return remainder(doc_id, 4) != 2


def op1_bpe(spark, d):
    ship(spark)
    return bpe.encode_digests(table(spark, d, "documents"), TOKENIZER)


def op2_quality(spark, d):
    ship(spark)
    docs = table(spark, d, "documents")
    trees = quality.train(docs, table(spark, d, "labels"), lambda doc_id: remainder(doc_id, 5) != 0)
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return quality.score(docs, trees).select("doc_id", held_out, "score", "predicted")


def op3_ngram_join(spark, d):
    ship(spark)
    return ngram_join.join(table(spark, d, "documents"))


def op4_substring_dedup(spark, d):
    ship(spark)
    return substrings.remove_repeats(table(spark, d, "documents"))


def op5_decontamination(spark, d):
    ship(spark)
    return decontaminate.digests(decontaminate.mark(table(spark, d, "documents"), table(spark, d, "benchmark")))


def op6_suffix_dedup(spark, d):
    ship(spark)
    return bwt_merge.remove_repeated_bytes(table(spark, d, "documents"))


def op7_nearest_vectors(spark, d):
    ship(spark)
    vectors = table(spark, d, "embeddings")
    return graph_ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op8_licence_scan(spark, d):
    ship(spark)
    return licences.scan(table(spark, d, "documents"))


def op9_chat_format(spark, d):
    return chat.render(table(spark, d, "conversations"))


def op10_toxicity(spark, d):
    ship(spark)
    scored = toxicity.score(table(spark, d, "documents"), table(spark, d, "labels"), toxicity_rows)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "neighbours", "similarities"
    )


def op11_collocations(spark, d):
    ship(spark)
    return collocations.collocations(table(spark, d, "documents"), least=10, top=2000)


def op12_vector_codes(spark, d):
    ship(spark)
    return vector_codes.compress(table(spark, d, "embeddings"), rounds=4, entries=256)


def op13_token_counts(spark, d):
    ship(spark)
    return token_counts.count_tokens(table(spark, d, "documents"), COUNTED, limit=512)


def queries():
    return {
        "op1_bpe": op1_bpe,
        "op2_quality": op2_quality,
        "op3_ngram_join": op3_ngram_join,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_nearest_vectors": op7_nearest_vectors,
        "op8_licence_scan": op8_licence_scan,
        "op9_chat_format": op9_chat_format,
        "op10_toxicity": op10_toxicity,
        "op11_collocations": op11_collocations,
        "op12_vector_codes": op12_vector_codes,
        "op13_token_counts": op13_token_counts,
    }


def oracle_sql():
    return {"op9_chat_format": chat.SQL, "op11_collocations": collocations.SQL}
