"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

1. ``vocabulary``: from a bounded sample of labelled rows (``SAMPLE`` rows), the terms seen in
   at least ``LEAST_DOCS`` rows and relatively more often in toxic ones, ranked by how strongly
   their presence is tied to the label (likelihood ratio), at most ``TERMS`` of them.
   Terms are words and word beginnings of 4 to 6 letters, which catches inflected forms.
2. One pass turns every whole text into counts of these terms; document frequencies for the
   weights are taken over all documents.
3. The sample's vectors form an inverted index in blocks of ``BLOCK`` examples with each term's
   largest weight in each block.  For a query, blocks are visited by falling upper bound until
   no block can hold one of the ``NEIGHBOURS`` best: the search is exact.
4. The score is the similarity-weighted share of toxic neighbours, drawn towards the rate that
   examples without a neighbour have; the evidence is the list of neighbours.

Null and empty texts, and texts without any term, have no neighbours and get that base rate.
Labels that are null, and labels of unknown documents, are ignored; a document labelled twice
counts as toxic if any label says so.  Without labels every score is 0.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import tidy

SAMPLE = 8192
TERMS = 4096
LEAST_DOCS = 2
REMEMBERED = 1 << 15  # searches a Python worker remembers by their term counts
LIFT = 2  # a term must be at least this much more frequent among toxic rows
BLOCK = 64
ROWS = 1024  # rows of a batch whose term counts are Python lists at once
COUNTED_TERMS = 1 << 17  # terms that one task counts before it hands them on
NEIGHBOURS = 15
PRIOR_WEIGHT = 0.25
PREDICTED_FROM = 0.3
_WORDS = regex.compile(r"\p{L}+")
_PREFIXES = (4, 5, 6)
OUT = "doc_id long, score double, predicted int, neighbours array<long>, similarities array<double>"


def terms_of(text: str) -> dict[str, int]:
    """Counts of a text's words and word beginnings; beginnings carry a mark."""
    words: dict[str, int] = {}
    for w in _WORDS.findall(text.lower()):
        words[w] = words.get(w, 0) + 1
    out = dict(words)
    for w, n in words.items():
        for k in _PREFIXES:
            if len(w) > k:
                p = w[:k] + "*"
                out[p] = out.get(p, 0) + n
    return out


def likelihood_ratio(a: int, b: int, n_a: int, n_b: int) -> float:
    """G of presence in a of n_a and b of n_b rows."""
    share = (a + b) / (n_a + n_b)
    part = lambda x, e: x * math.log(x / e) if x > 0 else 0.0
    return 2 * (part(a, n_a * share) + part(b, n_b * share) + part(n_a - a, n_a * (1 - share)) + part(n_b - b, n_b * (1 - share)))


def labelled_sample(labels: DataFrame, train, rows: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of at most ``rows`` training documents, chosen by a hash of the identifier."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & train(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def vocabulary(docs: DataFrame, sample: list) -> list[str]:
    """The most telling terms of the sampled documents."""
    toxic = {r.doc_id for r in sample if r.label == 1}
    if not toxic or len(toxic) == len(sample):
        return []
    ids = {r.doc_id for r in sample}

    def given(found):
        names = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([found[t][i] for t in names], pa.int64()) for i in (0, 1))],
            names=["term", "toxic", "clean"],
        )

    def count(batches):
        found: dict[str, list[int]] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                side = 0 if doc_id.as_py() in toxic else 1
                for t in terms_of(text.as_py() or ""):
                    found.setdefault(t, [0, 0])[side] += 1
                if len(found) > COUNTED_TERMS:  # the grouping adds up what goes out early
                    yield given(found)
                    found = {}
        yield given(found)

    spark = docs.sparkSession
    chosen = docs.join(F.broadcast(spark.createDataFrame([(i,) for i in ids], "doc_id long")), "doc_id", "left_semi")
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"))
    n_toxic, n_clean = len(toxic), len(ids) - len(toxic)
    counts = chosen.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    a, b = F.col("toxic"), F.col("clean")
    # Every term seen more often among toxic rows than among clean ones may vote; no bar on
    # the strength of the tie, so a small sample still yields terms.
    counts = counts.filter((a + b >= LEAST_DOCS) & (a * n_clean > LIFT * b * n_toxic))
    share = (a + b) / F.lit(n_toxic + n_clean)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(F.lit(0.0))
    ratio = 2 * (
        part(a, n_toxic * share) + part(b, n_clean * share)
        + part(n_toxic - a, n_toxic * (1 - share)) + part(n_clean - b, n_clean * (1 - share))
    )
    best = counts.withColumn("ratio", ratio)
    return [r.term for r in best.orderBy(F.desc("ratio"), "term").limit(TERMS).collect()]


class BlockMaxIndex:
    """Unit vectors of the examples in blocks, with the largest weight of each term per block."""

    def __init__(self, vectors: list[dict[int, float]], labels: list[int], ids: list[int], n_terms: int):
        # alike examples share blocks, so that few blocks have large bounds for a query
        order = sorted(range(len(ids)), key=lambda i: (max(vectors[i], key=lambda t: (vectors[i][t], -t)), ids[i]))
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.blocks = max(1, math.ceil(len(order) / BLOCK))
        self.bounds = np.zeros((n_terms, self.blocks))
        postings: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for place, i in enumerate(order):
            for t, w in vectors[i].items():
                postings[t].append((place, w))
                self.bounds[t, place // BLOCK] = max(self.bounds[t, place // BLOCK], w)
        self.places = [np.array([p for p, _ in x], np.int64) for x in postings]
        self.weights = [np.array([w for _, w in x]) for x in postings]
        self.edges = [np.searchsorted(p, np.arange(self.blocks + 1) * BLOCK) for p in self.places]

    def nearest(self, query: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples, by falling cosine, ties by identifier."""
        terms = sorted(query)
        weights = np.array([query[t] for t in terms])
        bounds = weights @ self.bounds[terms]
        found_p, found_s = [np.zeros(0, np.int64)], [np.zeros(0)]
        bar, have = 0.0, 0
        for b in np.argsort(-bounds, kind="stable"):
            # sums in another order may differ by rounding
            if bounds[b] <= 0 or (have >= k and bounds[b] < bar - 1e-12):
                break
            scores = np.zeros(BLOCK)
            for t, w in zip(terms, weights):
                x, y = self.edges[t][b], self.edges[t][b + 1]
                if x < y:
                    scores[self.places[t][x:y] - b * BLOCK] += w * self.weights[t][x:y]
            hit = np.flatnonzero(scores > 0)
            found_p.append(hit + b * BLOCK)
            found_s.append(scores[hit])
            have += len(hit)
            if have >= k:
                every = np.concatenate(found_s)
                bar = np.partition(every, len(every) - k)[len(every) - k]
        places, scores = np.concatenate(found_p), np.round(np.concatenate(found_s), 12)
        best = np.lexsort((self.ids[places], -scores))[:k]
        return places[best], scores[best]


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Per document: doc_id, and the vocabulary's terms in it with their counts."""
    number = {t: i for i, t in enumerate(terms)}
    whole = {t: i for t, i in number.items() if not t.endswith("*")}
    starts = {k: {t[:-1]: i for t, i in number.items() if t.endswith("*") and len(t) == k + 1} for k in _PREFIXES}
    starts = {k: v for k, v in starts.items() if v}

    def run(batches):
        for batch in batches:
            ids, counts = [], []
            for text in batch.column("text"):
                found: dict[int, int] = {}
                for w in _WORDS.findall((text.as_py() or "").lower()) if number else ():
                    t = whole.get(w)
                    if t is not None:
                        found[t] = found.get(t, 0) + 1
                    for k, own in starts.items():
                        if len(w) > k and (t := own.get(w[:k])) is not None:
                            found[t] = found.get(t, 0) + 1
                order = sorted(found)
                ids.append(order)
                counts.append([found[t] for t in order])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "terms", "counts"],
            )

    return docs.mapInArrow(tidy(run), "doc_id long, terms array<int>, counts array<int>")


def _weighted(terms, counts, idf) -> dict[int, float]:
    raw = {t: (1 + math.log(n)) * idf[t] for t, n in zip(terms, counts)}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / norm for t, w in raw.items()} if norm else {}


def score(docs: DataFrame, labels: DataFrame, train, sample_rows: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, score, predicted, and its neighbours with their similarities.

    ``train(doc_id column)`` says whose labels may be used.
    """
    from ..operators.stage import staged

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = labelled_sample(labels, train, sample_rows).collect()
    spark = docs.sparkSession
    terms = vocabulary(docs, sample)
    counted = staged(term_counts(docs, terms))
    label = {r.doc_id: int(r.label == 1) for r in sample}
    ids = spark.createDataFrame([(i,) for i in label], "doc_id long")
    n_docs = counted.count()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    idf = [math.log((1 + n_docs) / 1.0) + 1.0] * len(terms)
    for r in df:
        idf[r.term] = math.log((1 + n_docs) / (1 + r["count"])) + 1.0
    examples = (
        counted.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.max(F.struct("terms", "counts")).alias("v")).collect()
    )
    vectors = [(_weighted(r.v.terms, r.v.counts, idf), label[r.doc_id], r.doc_id) for r in examples]
    empty = [y for v, y, _ in vectors if not v]
    base = (sum(empty) + 0.5 * (bool(vectors))) / (len(empty) + 10) if vectors else 0.0
    vectors = [x for x in vectors if x[0]]
    index = BlockMaxIndex(*map(list, zip(*vectors)), len(terms)) if vectors else None
    shared = spark.sparkContext.broadcast((index, idf, base))

    def run(batches):
        index, idf, base = shared.value
        # Searches depend on the term counts only, which copies share: remembered, bounded.
        known: dict[bytes, tuple] = {}
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            scores, near, sims = [], [], []
            own_ids = batch.column("doc_id").to_pylist()
            for doc_id, terms, counts in zip(own_ids, batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                query = _weighted(terms, counts, idf) if terms else {}
                if not query or index is None:
                    scores.append(base)
                    near.append([])
                    sims.append([])
                    continue
                key = array("i", terms + counts).tobytes()
                found = known.get(key)
                if found is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    found = known[key] = index.nearest(query, NEIGHBOURS + 1)
                places, sim = found
                # an example's own row is no evidence about it
                keep = np.flatnonzero(index.ids[places] != (doc_id if doc_id is not None else -1))[:NEIGHBOURS]
                places, sim = places[keep], sim[keep]
                scores.append(float((sim @ index.labels[places] + PRIOR_WEIGHT * base) / (sim.sum() + PRIOR_WEIGHT)))
                near.append(index.ids[places].tolist())
                sims.append(sim.tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(scores, pa.float64()),
                    pa.array([int(s >= PREDICTED_FROM) for s in scores], pa.int32()),
                    pa.array(near, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float64())),
                ],
                names=["doc_id", "score", "predicted", "neighbours", "similarities"],
            )

    return counted.mapInArrow(tidy(run), OUT)
