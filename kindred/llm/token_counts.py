"""Token counts of byte-level BPE without emitting tokens.

A text is cut at the tokenizer's added tokens (each counts one), the rest into pre-tokens by
its pattern, and each pre-token's bytes become symbols.  Merging keeps the symbols in a linked
list and the adjacent pairs that have a merge in a heap keyed by (rank, position): the lowest
rank is popped, stale entries are skipped, and the two new neighbour pairs are pushed.  The
count is the number of initial symbols minus the number of merges, so no token identifier is
ever looked up or written out.

Counts of short pre-tokens are remembered per Python worker in two bounded generations.

Nulls: a null text counts as empty (0 bytes, 0 tokens); a null doc_id is carried as null.
Empty and white-space-only texts follow the pattern like any other.  Texts of any length
are read whole; a pre-token of millions of bytes costs memory linear in its length.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols

REMEMBERED = 1 << 16  # entries of each of a worker's two generations of counts
LONGEST_REMEMBERED = 64  # bytes of the longest pre-token whose count is remembered
LIMIT = 512

# The pre-token pattern of byte-level BPE tokenizers whose file says
# "use_regex": true (the same text as public_tokenizers.PATTERN).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBPE:
    """Merge ranks of a tokenizer file of the public ``tokenizers`` JSON layout."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("type") != "BPE":
            raise ValueError(f"{path}: not a BPE model")
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space"):
            raise ValueError(f"{path}: only byte-level pre-tokens without prefix space are read")
        vocab = model["vocab"]
        self.byte_id = [vocab[s] for s in byte_symbols()]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ", 1) if isinstance(merge, str) else merge
            self.pairs[(vocab[left] << 20) | vocab[right]] = (rank, vocab[left + right])
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern = regex.compile(PATTERN)
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def merged(self, data: bytes) -> int:
        """Symbols left of one pre-token: initial symbols minus merges."""
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return n
        pairs = self.pairs
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        gone = [False] * n
        heap = []
        for i in range(n - 1):
            hit = pairs.get((ids[i] << 20) | ids[i + 1])
            if hit is not None:
                heap.append((hit[0], i, hit[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n:
                continue
            hit = pairs.get((ids[i] << 20) | ids[j])
            if hit is None or hit[0] != rank:
                continue  # the pair at i changed since it was pushed
            ids[i] = new
            gone[j] = True
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            merges += 1
            p = before[i]
            if p >= 0 and (hit := pairs.get((ids[p] << 20) | new)) is not None:
                heapq.heappush(heap, (hit[0], p, hit[1]))
            if k < n and (hit := pairs.get((new << 20) | ids[k])) is not None:
                heapq.heappush(heap, (hit[0], i, hit[1]))
        return n - merges

    def pre_token(self, data: bytes) -> int:
        if len(data) > LONGEST_REMEMBERED:
            return self.merged(data)
        n = self.young.get(data)
        if n is None:
            n = self.old.get(data)
            if n is None:
                n = self.merged(data)
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[data] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text, added tokens included."""
        total = 0
        start = 0
        spans = self.added.finditer(text) if self.added is not None else ()
        for hit in spans:
            total += self._plain(text, start, hit.start()) + 1
            start = hit.end()
        return total + self._plain(text, start, len(text))

    def _plain(self, text: str, start: int, stop: int) -> int:
        count = self.pre_token
        return sum(count(m.group().encode("utf-8")) for m in self.pattern.finditer(text, start, stop))

    def forget(self):
        self.young, self.old = {}, {}


@lru_cache(1)
def _model(path: str) -> ByteBPE:
    return ByteBPE(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    ``path`` is the tokenizer file, readable on every node.  Other columns of ``docs`` are
    not read.
    """

    def run(batches):
        model = _model(path)
        for batch in batches:
            counts = [model.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )
        model.forget()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
