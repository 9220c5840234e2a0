"""Benchmark decontamination with an FM-index for each training shard.

A shard is a bounded run of documents inside a task.  Its words become symbols: words of the
benchmark keep their number, all others part the text, and stretches too short for any phrase
are left out.  Over what remains stands an FM-index: the Burrows-Wheeler transform in a wavelet
matrix, whose ranks give backward search for all phrases at once, and every eighth suffix
position, from which occurrences are located by walking back.  The located spans are merged
per document.

A phrase is a window of ``window`` consecutive words of an item, or the whole item if it has
fewer (but some) words.  Words are maximal runs of ASCII letters and digits and of characters
beyond ASCII, with A-Z lower-cased.  Null documents and null items have no words.  Items are
broadcast in blocks of ``BLOCK_BYTES`` of text; each further block is one more pass over the
rows, without a shuffle.  Rows are judged one by one, so repeated rows and identifiers do no
harm, and an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LETTERS_DIGITS, covered, runs_of, text_buffers, tidy, words

WINDOW = 10
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 8 << 20
SAMPLED = 8


# ------------------------------------------------------------------------------- FM-index


class WaveletMatrix:
    """Symbols below 2^levels with rank and access, both for arrays of arguments."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.ranks, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ranks.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its end."""
        low = np.zeros_like(end)
        for i, (ones, zeros) in enumerate(zip(self.ranks, self.zeros)):
            bit = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            low = np.where(bit, zeros + ones[low], low - ones[low])
            end = np.where(bit, zeros + ones[end], end - ones[end])
        return end - low

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(place), np.int64)
        for ones, zeros in zip(self.ranks, self.zeros):
            bit = ones[place + 1] - ones[place]
            symbol = symbol * 2 + bit
            place = np.where(bit == 1, zeros + ones[place], place - ones[place])
        return symbol


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes by doubling; the last symbol is the only 0."""
    n = len(symbols)
    key, length = symbols.astype(np.int64), 1
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        following = np.zeros(n, np.int64)
        following[:-length] = rank[length:] + 1
        key = rank * (n + 1) + following
        length *= 2


class FMIndex:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_order(symbols)
        self.matrix = WaveletMatrix(symbols[order - 1], max(1, math.ceil(math.log2(n_symbols))))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=n_symbols))))
        self.sampled = order % SAMPLED == 0
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.samples = order[self.sampled]
        self.n = len(symbols)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of phrases (rows padded on the right), all searched backward together."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((back <= lengths) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - back]
            low[live] = self.before[symbol] + self.matrix.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.matrix.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back until one is sampled."""
        out, steps, todo = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(todo):
            done = self.sampled[rows]
            out[todo[done]] = self.samples[self.sample_rank[rows[done]]] + steps
            todo, rows = todo[~done], rows[~done]
            symbol = self.matrix.access(rows)
            rows = self.before[symbol] + self.matrix.rank(symbol, rows)
            steps += 1
        return out


# --------------------------------------------------------------------------------- phrases


class Phrases:
    """A block of benchmark items as phrases over a vocabulary of word fingerprints."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        table = pa.table({"text": pa.array([t for _, t in items], pa.large_string())})
        data, offsets = text_buffers(table["text"])
        _, _, values, edge = words(data, offsets, LETTERS_DIGITS, lower=True)
        self.vocabulary = np.unique(values)
        symbols = np.searchsorted(self.vocabulary, values) + 2
        holders: dict[tuple[int, ...], set[str]] = {}
        for (item, _), a, b in zip(items, edge[:-1].tolist(), edge[1:].tolist()):
            for i in range(a, max(b - window, a) + 1) if b > a else ():
                holders.setdefault(tuple(symbols[i : min(i + window, b)].tolist()), set()).add(item)
        self.lengths = np.array([len(x) for x in holders], np.int64)
        self.rows = np.zeros((len(holders), int(self.lengths.max(initial=1))), np.int64)
        for i, x in enumerate(holders):
            self.rows[i, : len(x)] = x
        self.items = list(holders.values())
        self.shortest = int(self.lengths.min()) if len(holders) else 0

    def occurrences(self, values: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of all occurrences in a shard's words; none crosses a document."""
        none = np.zeros(0, np.int64)
        if not len(self.items) or not len(values):
            return none, none
        place = np.minimum(np.searchsorted(self.vocabulary, values), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == values
        # stretches of known words inside one document
        head = known & np.concatenate(([True], ~known[:-1]))
        head[edge[:-1][edge[:-1] < len(values)]] = True
        head &= known
        start = np.flatnonzero(head)
        label = np.cumsum(head) - 1
        size = np.bincount(label[known], minlength=len(start)) if len(start) else none
        long = size >= self.shortest
        start, size = start[long], size[long]
        if not len(start):
            return none, none
        at = np.concatenate(([0], np.cumsum(size + 1)))
        symbols = np.ones(at[-1], np.int64)  # 1 parts the stretches
        origin = np.zeros(at[-1], np.int64)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        source, target = np.repeat(start, size) + step, np.repeat(at[:-1], size) + step
        symbols[target] = place[source] + 2
        origin[target] = source
        symbols[-1] = 0
        index = FMIndex(symbols, len(self.vocabulary) + 2)
        low, high = index.search(self.rows, self.lengths)
        hit = np.flatnonzero(high > low)
        count = (high - low)[hit]
        rows = np.repeat(low[hit] - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(hit, count), origin[index.locate(rows)]


_SPANS = pa.list_(pa.int32())
_ITEMS = pa.list_(pa.string())


def _slices(batches):
    """Batches cut so that one holds about SHARD_BYTES of text."""
    for batch in batches:
        offsets = text_buffers(batch.column("text"))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SHARD_BYTES, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def _scan(shared, names: list[str]):
    """Add a block's hits to each row: word spans [start, end) one after the other, and items."""

    def run(batches):
        phrases = shared.value
        for batch in _slices(batches):
            data, offsets = text_buffers(batch.column("text"))
            _, _, values, edge = words(data, offsets, LETTERS_DIGITS, lower=True)
            phrase, word = phrases.occurrences(values, edge)
            row = np.searchsorted(edge, word, side="right") - 1
            spans, items = batch.column("hit_words").to_pylist(), batch.column("hit_items").to_pylist()
            order = np.lexsort((word, row))
            for r, part in zip(*_grouped(row[order], order)):
                first = word[part] - edge[r]
                mask_starts, mask_ends = first, first + phrases.lengths[phrase[part]]
                spans[r] = _merged(spans[r], mask_starts, mask_ends)
                items[r] = sorted(set(items[r]).union(*(phrases.items[p] for p in np.unique(phrase[part]).tolist())))
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(edge[1:] - edge[:-1], pa.int64()), pa.array(spans, _SPANS), pa.array(items, _ITEMS)],
                names=[*names, "n_words", "hit_words", "hit_items"],
            )

    return run


def _grouped(rows: np.ndarray, order: np.ndarray):
    cut = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, np.int64)
    return rows[cut].tolist(), np.split(order, cut[1:]) if len(cut) else []


def _merged(spans: list[int], starts: np.ndarray, ends: np.ndarray) -> list[int]:
    starts, ends = np.concatenate((starts, spans[0::2])).astype(np.int64), np.concatenate((ends, spans[1::2])).astype(np.int64)
    first, last = runs_of(covered(int(ends.max()), starts, ends))
    return np.stack((first, last), axis=1).ravel().tolist()


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, *keep) with n_words, hit_words and hit_items.

    ``hit_words`` holds first and past-the-end word numbers of the merged spans, flat.
    """
    rows, scans = _scanning(docs, benchmark, window, keep)
    return rows.mapInArrow(tidy(_in_turn(scans)), rows.schema)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """``cleaned(mark(...))`` in one pass: a task needs one Python worker for both."""
    rows, scans = _scanning(docs, benchmark, window, keep)
    names = ["doc_id", "text", *keep]
    return rows.mapInArrow(tidy(_in_turn([*scans, _cut_out(names)])), rows.select(*names).schema)


def _scanning(docs: DataFrame, benchmark: DataFrame, window: int, keep: tuple[str, ...]):
    """Rows without hits as yet, and a scan for each block of the benchmark."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    names = ["doc_id", "text", *keep]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep,
        F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hit_words"),
        F.array().cast("array<string>").alias("hit_items"),
    )
    scans = []
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        phrases = Phrases([(r.item_id, r.text or "") for r in block.collect()], window)
        scans.append(_scan(spark.sparkContext.broadcast(phrases), names))
    return rows, scans


def _in_turn(steps):
    """The steps over batches as one function, each taking what the one before gives."""

    def run(batches):
        for step in steps:
            batches = step(batches)
        yield from batches

    return run


def digests(marked: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    ends = F.aggregate(
        F.transform("hit_words", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0), lambda a, x: a + x
    ).cast("long")
    return marked.select(
        "doc_id", "n_words", ends.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"), (ends > 0).alias("contaminated"),
    )


def cleaned(marked: DataFrame) -> DataFrame:
    """The marked rows with the hit spans cut out of their texts, without the marks."""
    names = [c for c in marked.columns if c not in ("n_words", "hit_words", "hit_items")]
    return marked.mapInArrow(tidy(_cut_out(names)), marked.select(*names).schema)


def _cut_out(names: list[str]):
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            spans = batch.column("hit_words").to_pylist()
            out = texts.to_pylist()
            for i in [i for i, s in enumerate(spans) if s]:
                raw = out[i].encode()
                data = np.frombuffer(raw, np.uint8)
                start, end, _, _ = words(data, np.array([0, len(data)]), LETTERS_DIGITS, lower=True)
                parts, at = [], 0
                for a, b in zip(spans[i][0::2], spans[i][1::2]):
                    parts.append(raw[at : start[a]])
                    at = int(end[b - 1])
                out[i] = b"".join((*parts, raw[at:])).decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if c == "text" else batch.column(c) for c in names], names=names
            )

    return run
