"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text becomes a row of statistics (sizes, character classes, repetition of words and
lines, shape of words), computed where the text lies.  The trees are fitted on the statistics of
at most ``SAMPLE`` labelled rows: values are binned by quantiles, each level takes the best split
of gradient histograms, and the fitted trees are flattened into arrays of one complete binary
tree each, which a batch of rows walks together.

Null and empty texts have all statistics 0 and get the score of such a row.  Labels that are
null and labels of unknown documents are ignored; a document labelled twice counts as good if
any label says so.  Without labels of both kinds every score is their rate, or 0.5.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAST_ROWS = 8
RIDGE = 1.0
PREDICTED_FROM = 0.3
OUT = "doc_id long, score double, predicted int"
_CLASSES = np.zeros((256, 12))
for _i, _members in enumerate(
    (range(65, 91), range(97, 123), range(48, 58), b" ", b"\n", b".,;:'\"()", b"!?", b"#$%&*", b"|\t", b"<>[]{}=_/\\", range(128, 256))
):
    _CLASSES[list(_members), _i] = 1
_CLASSES[:, 11] = 1 - _CLASSES[:, :11].sum(axis=1)
NAMES = [
    "log_bytes", "log_words", "word_length", "longest_word", "distinct_words", "commonest_word", "distinct_pairs", "same_as_before",
    "capitalised", "capitals", "no_letter", "repeated_lines", "line_words", "ends_with_stop", "entropy",
    *(f"class_{i}" for i in range(12)),
]


def statistics(text: str) -> list[float]:
    """The statistics of one text, as in NAMES."""
    raw = text.encode()
    words = text.split()
    if not words:
        return [math.log1p(len(raw))] + [0.0] * (len(NAMES) - 1)
    n = len(words)
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = histogram / len(raw)
    present = share[share > 0]
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        math.log1p(len(raw)), math.log1p(n), len(raw) / n, float(max(map(len, counts))), len(counts) / n,
        max(counts.values()) / n, len(set(zip(words, words[1:]))) / max(n - 1, 1),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(c for w, c in counts.items() if w[0].isupper()) / n, sum(c for w, c in counts.items() if w.isupper()) / n,
        sum(c for w, c in counts.items() if not w[0].isalnum()) / n,
        1 - len(set(lines)) / len(lines), n / len(lines),
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines), float(-(present * np.log2(present)).sum()),
        *(share @ _CLASSES).tolist(),
    ]


# ------------------------------------------------------------------------------- boosting


class Trees:
    """Complete binary trees of one depth in flat arrays, and their vectorised walk."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.threshold, self.leaf = base, feature, threshold, leaf

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of statistics."""
        score = np.full(len(x), self.base)
        if len(self.leaf):
            rows = np.arange(len(x))[:, None]
            trees = np.arange(len(self.leaf))[None, :]
            node = np.zeros((len(x), len(self.leaf)), np.int64)
            depth = int(math.log2(self.leaf.shape[1]))
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
            score += self.leaf[trees, node - (self.leaf.shape[1] - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-score))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost logistic loss: per level one histogram of gradients over (node, feature, bin)."""
    none = np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth))
    if not len(y):
        return Trees(0.0, *none)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = math.log(rate / (1 - rate))
    if y.min() == y.max():
        return Trees(base, *none)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    cells = binned + np.arange(width) * BINS
    score = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (width * BINS) + cells).ravel()
            shape = (nodes, width, BINS)
            total = [
                np.bincount(place, np.repeat(v, width), nodes * width * BINS).reshape(shape).cumsum(axis=2)
                for v in (gradient, weight, np.ones(n))
            ]
            g, h, c = total
            left = g[:, :, :-1] ** 2 / (h[:, :, :-1] + RIDGE)
            rest_g, rest_h = g[:, :, -1:] - g[:, :, :-1], h[:, :, -1:] - h[:, :, :-1]
            gain = left + rest_g**2 / (rest_h + RIDGE) - g[:, :, -1:] ** 2 / (h[:, :, -1:] + RIDGE)
            gain[(c[:, :, :-1] < LEAST_ROWS) | (c[:, :, -1:] - c[:, :, :-1] < LEAST_ROWS)] = -np.inf
            flat = gain.reshape(nodes, -1)
            best = flat.argmax(axis=1)
            f, b = best // (BINS - 1), best % (BINS - 1)
            good = flat[np.arange(nodes), best] > 1e-9
            for k in np.flatnonzero(good):
                if b[k] < len(edges[f[k]]):
                    feature[first + k], threshold[first + k] = f[k], edges[f[k]][b[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf_of = node - (2**depth - 1)
        g, h = np.bincount(leaf_of, gradient, 2**depth), np.bincount(leaf_of, weight, 2**depth)
        leaf = -RATE * g / (h + RIDGE)
        score += leaf[leaf_of]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))


# ---------------------------------------------------------------------------------- Spark


def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _statistics(batches):
    for batch in batches:
        rows = [statistics(t.as_py() or "") for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "statistics"])


def train(docs: DataFrame, labels: DataFrame, usable, sample_rows: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample_rows`` labelled documents that ``usable`` admits."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect()
    )
    label = {r.doc_id: int(r.label == 1) for r in known}
    ids = docs.sparkSession.createDataFrame([(i,) for i in label], "doc_id long")
    rows = _text_rows(docs).join(F.broadcast(ids), "doc_id", "left_semi")  # at most sample_rows identifiers
    rows = rows.mapInArrow(_statistics, "doc_id long, statistics array<double>")
    rows = rows.groupBy("doc_id").agg(F.min("statistics").alias("statistics")).orderBy("doc_id").collect()
    x = np.array([r.statistics for r in rows]).reshape(len(rows), len(NAMES))
    return fit(x, np.array([label[r.doc_id] for r in rows], np.float64))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """Per document: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            rows = np.array([statistics(t.as_py() or "") for t in batch.column("text")]).reshape(batch.num_rows, len(NAMES))
            found = np.concatenate([shared.value.predict(rows[i : i + 2048]) for i in range(0, len(rows), 2048)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found), pa.array((found >= PREDICTED_FROM).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return _text_rows(docs).mapInArrow(run, OUT)
