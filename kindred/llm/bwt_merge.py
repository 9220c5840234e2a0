"""Byte-level deduplication through merged Burrows-Wheeler transforms.

A byte goes if a ``size``-byte string that covers it also starts in a document with a smaller
identifier; matches stay inside one document, strings are judged on the input.

1. Each string has an anchor, its k-gram of least fingerprint.  A filter over all packs keeps
   the strings whose anchor occurs in several documents; the rest can't recur.
2. A pack sends the context of each such anchor (the bytes of all strings it anchors), equal
   contexts once with their least document.  Contexts of one anchor meet in a bucket; those of
   an anchor with 4,096 and more contexts, counted pack by pack, are sent string by string,
   dealt out by content.  Such strings are equal or not and need no merging.
3. Where the contexts of an anchor are all equal, the least document decides.  The others of a
   bucket are cut into shards; each shard's transform is built once, and the transforms are
   merged by refining their interleave one symbol at a time.  The blocks of the interleave
   after h rounds are the intervals of suffixes with h common symbols, so after ``size``
   rounds they are the repeated intervals, without sorting suffixes across shards.
4. The answer, one bit per string of a context, goes back to the packs, which remove the spans.

Null texts count as empty; texts shorter than ``size`` stay whole; equal rows of one identifier
do not remove each other; a null identifier counts as the largest.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packs
from .arrays import BYTE_VALUES, anchored_runs, covered, runs_of, text_buffers

SIZE = 50
ANCHOR = 20
HOT = 128 + 5  # the code of 4,096 and more contexts
FEW_PLACES = 64  # up to so many in a pack, an anchor's places count as contexts
SEVERAL = 128  # marks a pack's count of an anchor that several of its documents hold
SHARD_SYMBOLS = 1 << 17
SHARDS = 8  # merged at once; a batch is at most about that many shards
LAST_ID = np.int64((1 << 63) - 1)
_CONTEXTS = "pack long, bucket long, anchors binary, docs binary, sizes binary, bytes binary"
_CONTEXT_SCHEMA = pa.schema(
    [("pack", pa.int64()), ("bucket", pa.int64()), *((c, pa.binary()) for c in ("anchors", "docs", "sizes", "bytes"))]
)
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_OUT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


# ------------------------------------------------------------- transforms and their merging


def transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and Burrows-Wheeler transform of a text that ends with its only 0.

    Symbols are below 512.  Seven symbols make the first sort key; then the sorted length
    doubles, and only suffixes that still equal another are sorted again.
    """
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(7, np.int64)))
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = (key << 9) | padded[i : i + n]
    order = np.argsort(key)
    slots, members, key = np.arange(n), order, key[order]
    rank = np.empty(n, np.int64)
    length = 7
    while True:
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        heads = np.flatnonzero(fresh)
        # the rank is the first place of the suffixes that are still equal
        rank[members] = np.repeat(slots[heads], np.diff(np.append(heads, len(key))))
        tied = ~(fresh & np.append(fresh[1:], True))
        slots, members = slots[tied], members[tied]
        if not len(slots):
            return order, symbols[order - 1]
        # equal suffixes hold no 0 yet, so more symbols follow
        key = rank[members] * n + rank[members + length]
        again = np.argsort(key)
        members, key = members[again], key[again]
        order[slots] = members
        length *= 2


def merged_blocks(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of sorted shards that share their first ``depth`` symbols with another one.

    Returns them block by block in the order of the merged interleave, as indexes into the
    joined shards, and a flag on the first suffix of every block.  A round lists each block's
    suffixes some symbols further left: a stable sort by those symbols keeps the order of the
    round before.  A suffix alone in its block stays alone in all further rounds and goes.
    """
    joined = np.concatenate(transforms)
    n = len(joined)
    if len(transforms) > 1 << 16 or n > np.iinfo(np.int32).max:
        raise ValueError(f"{len(transforms)} shards of {n} symbols are too many to merge at once")
    used = np.bincount(joined) > 0
    n_used = int(np.count_nonzero(used))
    number = (np.cumsum(used) - 1)[joined]
    # one symbol further left: the r-th suffix of a shard stays its r-th among those of its symbol
    back = np.empty(n, np.int32)
    base = 0
    for t in transforms:
        back[base + np.argsort(t, kind="stable")] = np.arange(base, base + len(t), dtype=np.int32)
        base += len(t)
    at_once = max((r for r in range(1, depth + 1) if n_used**r <= 1 << 16), default=1)
    place = np.arange(n, dtype=np.int32)
    first = np.zeros(n, bool)
    first[:1] = True
    reach = 0  # symbols that ``code`` and ``further`` take at once
    while depth and len(place):
        if reach != min(at_once, depth):
            reach = min(at_once, depth)
            code, further = number, back
            for i in range(1, reach):
                code, further = code + number[further] * n_used**i, back[further]
            code = code.astype(np.uint8 if n_used**reach <= 1 << 8 else np.uint16)
        block = np.cumsum(first, dtype=np.int32)
        symbols = code[place]
        order = np.argsort(symbols, kind="stable")
        symbols, block = symbols[order], block[order]
        first = np.concatenate(([True], (symbols[1:] != symbols[:-1]) | (block[1:] != block[:-1])))
        shared = ~(first & np.append(first[1:], True))
        place, first = further[place[order[shared]]], first[shared]
        depth -= reach
    return place, first


def least_in_block(contexts: list[bytes], docs: np.ndarray, size: int) -> list[np.ndarray]:
    """For each context, the least document that holds the string at each of its offsets."""
    shards, at, filled = [], [], 0
    for i, c in enumerate(contexts):
        if not shards or filled + len(c) + 1 > SHARD_SYMBOLS:
            shards.append([])
            filled = 0
        shards[-1].append(i)
        filled += len(c) + 1
    transforms, positions, owners, starts, base = [], [], [], np.zeros(len(contexts), np.int64), 0
    for members in shards:
        text = np.frombuffer(b"".join(contexts[i] for i in members), np.uint8).astype(np.uint16) + np.uint16(2)
        sizes = np.array([len(contexts[i]) for i in members])
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.full(len(text) + len(members), 1, np.uint16)
        keep = np.ones(len(symbols), bool)
        keep[ends] = False
        symbols[keep] = text
        symbols[-1] = 0
        order, bwt = transform(symbols)
        transforms.append(bwt)
        positions.append(order + base)
        owners.append(np.repeat(docs[members], sizes + 1))
        starts[members] = ends - sizes + base
        base += len(symbols)
    place, first = merged_blocks(transforms, size)
    where, heads = np.concatenate(positions)[place], np.flatnonzero(first)
    least = np.concatenate(owners)
    if len(heads):
        least[where] = np.repeat(np.minimum.reduceat(least[where], heads), np.diff(np.append(heads, len(where))))
    return [least[s : s + len(c) - size + 1] for s, c in zip(starts, contexts)]


# ----------------------------------------------------------------------------- Spark stages


def packed_counts(contexts: np.ndarray, several: np.ndarray) -> np.ndarray:
    """A byte each: contexts, exact below 96 and the next power of two above, and whether several documents hold them."""
    above = 90 + np.ceil(np.log2(np.maximum(contexts, 1))).astype(np.int64)
    return np.where(contexts < 96, contexts, above) + SEVERAL * several


def answered(table):
    """One bucket: for every key 1 if one document holds it, else the code of its contexts, 2 at least."""
    keys = [np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]]
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table["counts"]]).astype(np.int64)
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    low = counts[order] % SEVERAL
    total = np.add.reduceat(np.where(low < 96, low, 1 << np.maximum(low - 90, 0)), first)
    held = np.add.reduceat(1 + counts[order] // SEVERAL, first)
    code = np.where(total < 128, total, 121 + np.log2(total).astype(np.int64))
    code = np.where(held < 2, 1, np.maximum(code, 2)).astype(np.uint8)
    codes = np.empty(len(every), np.uint8)
    codes[order] = np.repeat(code, np.diff(np.append(first, len(every))))
    edge = np.cumsum([0, *map(len, keys)])
    return pa.table(
        [table["pack"], table["bucket"], pa.array([codes[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())],
        schema=packs._ANSWER,
    )


class _Pack:
    """Bytes and anchored strings of one pack."""

    def __init__(self, table: pa.Table, size: int):
        self.table = packs.in_order(table)
        self.data, self.offsets = text_buffers(self.table["text"])
        self.size = size
        ids = self.table["doc_id"].combine_chunks().fill_null(int(LAST_ID))
        self.ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        parts = []
        for place, anchor, first, last in anchored_runs(BYTE_VALUES[self.data], self.offsets, min(ANCHOR, size), size):
            parts.append((anchor, first, last))
        self.anchor, self.first, self.last = (
            np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t)
            for i, t in ((0, np.uint64), (1, np.int64), (2, np.int64))
        )
        self.row = np.searchsorted(self.offsets, self.first, side="right") - 1
        self.keys, places = packs.distinct(self.anchor)
        order = np.argsort(self.anchor, kind="stable")
        edge = np.concatenate(([0], np.cumsum(places)))
        own = self.ids[self.row][order]
        several = (np.minimum.reduceat(own, edge[:-1]) != np.maximum.reduceat(own, edge[:-1])) if len(own) else np.zeros(0, bool)
        for k in np.flatnonzero(places > FEW_PLACES):
            runs = order[edge[k] : edge[k + 1]]
            ends = (self.last[runs] + size - 1).tolist()
            places[k] = len({self.data[x:y].tobytes() for x, y in zip(self.first[runs].tolist(), ends)})
        self.counts = packed_counts(places, several)

    def contexts(self, codes: np.ndarray):
        """Distinct (anchor, context) entries with their least document, and who holds them."""
        code = codes[np.searchsorted(self.keys, self.anchor)] if len(self.keys) else np.zeros(0, np.uint8)
        run = np.flatnonzero(code >= 2)
        first, last, hot = self.first[run], self.last[run], code[run] >= HOT
        size = np.where(hot, last - first, 1)  # a lengthened anchor sends string by string
        anchor, row = np.repeat(self.anchor[run], size), np.repeat(self.row[run], size)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        first, last, hot = np.repeat(first, size) + np.where(np.repeat(hot, size), step, 0), np.repeat(last, size), np.repeat(hot, size)
        last = np.where(hot, first + 1, last)
        whole = self.data.tobytes()
        index: dict[tuple[int, bytes], int] = {}
        entry = np.empty(len(first), np.int64)
        more = self.size - 1
        for i, (a, x, y) in enumerate(zip(anchor.tolist(), first.tolist(), (last + more).tolist())):
            entry[i] = index.setdefault((a, whole[x:y]), len(index))
        least = np.full(len(index), LAST_ID, np.int64)
        np.minimum.at(least, entry, self.ids[row])
        texts = [c for _, c in index]
        anchors = np.fromiter((a for a, _ in index), np.uint64, len(index))
        is_hot = np.zeros(len(index), bool)
        is_hot[entry[hot]] = True
        where = anchors.copy()
        for i in np.flatnonzero(is_hot):
            where[i] ^= np.uint64(zlib.crc32(texts[i]))
        return first, last, row, entry, anchors, texts, least, where


def _ask(n_filter: int, size: int):
    def run(key, table):
        pack = _Pack(table, size)
        return packs.sent(key[0].as_py(), pack.keys, pack.counts, n_filter)

    return run


def _send(n_filter: int, n_buckets: int, size: int):
    def run(key, table, answers):
        if not table.num_rows or not answers.num_rows:
            return _CONTEXT_SCHEMA.empty_table()
        pack = _Pack(table, size)
        codes = packs.codes_of(pack.keys, n_filter, answers["bucket"].to_pylist(), answers["codes"].to_pylist())
        _, _, _, _, anchors, texts, least, where = pack.contexts(codes)
        rows = []
        for b, i in packs._by_bucket(where, n_buckets):
            own = [texts[x] for x in i]
            sizes = np.array([len(x) for x in own], np.int32)
            rows.append((key[0].as_py(), b, anchors[i].tobytes(), least[i].tobytes(), sizes.tobytes(), b"".join(own)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, _CONTEXT_SCHEMA)], schema=_CONTEXT_SCHEMA)

    return run


def _judge(size: int):
    """One bucket: for every entry a 64-bit mask of the strings that a smaller document holds."""

    def run(table):
        anchors = [np.frombuffer(x.as_py(), np.uint64) for x in table["anchors"]]
        edge = np.cumsum([0, *map(len, anchors)])
        anchors = np.concatenate(anchors)
        docs = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table["docs"]])
        texts = []
        for sizes, data in zip(table["sizes"], table["bytes"]):
            ends = np.cumsum(np.frombuffer(sizes.as_py(), np.int32)).tolist()
            data = data.as_py()
            texts += [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        index: dict[tuple[int, bytes], int] = {}
        entry = np.fromiter((index.setdefault((a, t), len(index)) for a, t in zip(anchors.tolist(), texts)), np.int64, len(texts))
        least = np.full(len(index), LAST_ID, np.int64)
        np.minimum.at(least, entry, docs)
        own = np.fromiter((a for a, _ in index), np.uint64, len(index))
        strings = [t for _, t in index]
        order = np.argsort(own, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], own[order][1:] != own[order][:-1])))
        group = np.diff(np.append(heads, len(order)))
        # contexts of an anchor stay together in a batch; most anchors have one and need no merging
        holders: list = [None] * len(index)
        batch, symbols = [], 0
        for h, n in zip(heads[group > 1].tolist(), group[group > 1].tolist()):
            members = order[h : h + n].tolist()
            more = sum(len(strings[m]) + 1 for m in members)
            if more == n * (size + 1):
                continue  # distinct single strings, whose least documents are known
            if batch and symbols + more > SHARDS * SHARD_SYMBOLS:
                _settle(batch, strings, least, size, holders)
                batch, symbols = [], 0
            batch += members
            symbols += more
        if batch:
            _settle(batch, strings, least, size, holders)
        bits = np.uint64(1) << np.arange(size, dtype=np.uint64)
        masks = np.zeros(len(entry), np.uint64)
        for i, (e, d) in enumerate(zip(entry.tolist(), docs.tolist())):
            if holders[e] is not None:
                masks[i] = bits[: len(holders[e])][holders[e] < d].sum(dtype=np.uint64)
            elif least[e] < d:
                masks[i] = np.uint64((1 << (len(strings[e]) - size + 1)) - 1)
        return pa.table(
            [table["pack"], table["bucket"], pa.array([masks[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())],
            schema=packs._ANSWER,
        )

    return run


def _settle(batch, strings, least, size, holders):
    for m, found in zip(batch, least_in_block([strings[m] for m in batch], least[batch], size)):
        holders[m] = found


def _remove(n_filter: int, n_buckets: int, size: int):
    def run(key, table, answers):
        if not table.num_rows:
            return _OUT_SCHEMA.empty_table()
        pack = _Pack(table, size)
        parts = {"filter": [], "masks": []}
        for bucket, codes, kind in zip(*(answers[c].to_pylist() for c in ("bucket", "codes", "kind"))):
            parts[kind].append((bucket, codes))
        gone = np.zeros(len(pack.data), bool)
        if parts["masks"]:
            codes = packs.codes_of(pack.keys, n_filter, *zip(*parts["filter"]))
            first, last, row, entry, _, _, least, where = pack.contexts(codes)
            masks = np.zeros(len(where), np.uint64)
            found = dict(parts["masks"])
            for b, i in packs._by_bucket(where, n_buckets):
                masks[i] = np.frombuffer(found[b], np.uint64)
            # a document after the pack's least holder of a context loses all its strings
            later = pack.ids[row] > least[entry]
            size_of = last - first
            start = np.repeat(first - np.cumsum(size_of) + size_of, size_of) + np.arange(size_of.sum())
            shift = (start - np.repeat(first, size_of)).astype(np.uint64)
            hit = np.repeat(later, size_of) | ((np.repeat(masks[entry], size_of) >> shift) & np.uint64(1)).astype(bool)
            gone = covered(len(pack.data), start[hit], start[hit] + size)
        rows = []
        for i in range(pack.table.num_rows):
            a, b = pack.offsets[i], pack.offsets[i + 1]
            own = gone[a:b]
            n = int(own.sum())
            kept = pack.data[a:b][~own] if n else pack.data[a:b]
            rows.append((int(b - a), n, len(runs_of(own)[0]) if n else 0, hashlib.sha256(kept.tobytes()).hexdigest()))
        return pa.table([pack.table["doc_id"], *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(_OUT_SCHEMA)[1:]))], schema=_OUT_SCHEMA)

    return run


def remove_repeated_bytes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.  ``size`` is at most 64."""
    if not 1 <= size <= 64:
        raise ValueError("size must be between 1 and 64")
    total = packs.text_bytes(docs)
    n_filter = packs.buckets_for(total, 2.0 / (size - min(ANCHOR, size) + 2), 9)
    n_buckets = packs.buckets_for(total, 1.0, 1)
    dealt = packs.in_packs(docs, total)
    asked = dealt.groupBy("pack").applyInArrow(_ask(n_filter, size), packs.SENT)
    answers = asked.groupBy("bucket").applyInArrow(answered, packs.ANSWER)
    contexts = dealt.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(_send(n_filter, n_buckets, size), _CONTEXTS)
    masks = contexts.groupBy("bucket").applyInArrow(_judge(size), packs.ANSWER)
    both = answers.withColumn("kind", F.lit("filter")).union(masks.withColumn("kind", F.lit("masks")))
    return dealt.groupBy("pack").cogroup(both.groupBy("pack")).applyInArrow(_remove(n_filter, n_buckets, size), OUT)
