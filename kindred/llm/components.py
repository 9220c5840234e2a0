"""Connected components by alternating star contractions, entirely in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import staged


def _edges(pairs: DataFrame) -> DataFrame:
    return pairs.filter("u <> v").distinct()


def connected(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, component): the least node that the links (a, b) reach from each node.

    Each round hangs every node's neighbours on its least neighbour, larger ones first, then
    smaller ones; a star is a fixed point.  Rounds grow with the logarithm of the diameter.  A
    node of very many links is grouped with map-side minima, never collected.
    """
    edges = staged(_edges(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours go to the least of the node and its neighbours
        large = _edges(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: the node and its smaller neighbours go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = staged(_edges(small))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return nodes.join(edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component")), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
