"""Documents in packs of bounded size, and a filter that tells which keys recur anywhere.

A pack is a hash class of documents of about ``PACK_BYTES`` of text.  A pack sends each of its
distinct keys once, as packed binary, so a key that a third of all documents hold reaches a
reducer as one entry per pack.  The answer is one byte per key, in the order sent.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import tidy

PACK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
SENT = "pack long, bucket long, keys binary, counts binary"
ANSWER = "pack long, bucket long, codes binary"
_SENT = pa.schema([("pack", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("pack", pa.int64()), ("bucket", pa.int64()), ("codes", pa.binary())])


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def in_packs(docs: DataFrame, total: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, *keep, pack), dealt out by pack; read several times, shuffled once.

    Equal rows may share a pack; the hash takes the text in, so that rows which share an
    identifier spread.
    """
    n = max(1, math.ceil(total / PACK_BYTES))
    doc_id, text = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    pack = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("pack")
    return docs.select(doc_id, text, *keep, pack).repartition("pack")


def buckets_for(total: int, keys_per_byte: float, key_bytes: int) -> int:
    """So many key classes that one holds about BUCKET_BYTES."""
    return max(1, math.ceil(total * keys_per_byte * key_bytes / BUCKET_BYTES))


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a pack in an order that does not depend on how they arrived."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))


def _by_bucket(keys: np.ndarray, n_buckets: int):
    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(n_buckets + 1)) if n_buckets < 4096 else None
    if edge is not None:
        for b in np.flatnonzero(edge[1:] > edge[:-1]):
            yield int(b), order[edge[b] : edge[b + 1]]
    else:
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cut):
            if len(part):
                yield int(bucket[part[0]]), part


def sent(pack: int, keys: np.ndarray, counts: np.ndarray, n_buckets: int, narrow: bool = False) -> pa.Table:
    """The rows that ask for a pack's sorted distinct keys.

    ``narrow`` sends the upper half of each key only: of a bucket's million keys one in some
    four thousand then counts another as its own, and no key counts less than it occurs.
    """
    small = np.minimum(counts, 255).astype(np.uint8)
    part = (keys >> np.uint64(32)).astype(np.uint32) if narrow else keys
    rows = [(pack, b, part[i].tobytes(), small[i].tobytes()) for b, i in _by_bucket(keys, n_buckets)]
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * 4, _SENT)], schema=_SENT)


def answered(table):
    """One bucket: code the total count of every key, exact up to 127 and by its logarithm above."""
    counts = [np.frombuffer(x.as_py(), np.uint8) for x in table["counts"]]
    # keys of eight bytes or, if sent narrow, of four
    keys = [np.frombuffer(x.as_py(), f"u{len(x.as_py()) // len(c)}") for x, c in zip(table["keys"], counts)]
    counts = np.concatenate(counts)
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    total = np.add.reduceat(counts[order].astype(np.int64), first)
    code = np.where(total < 128, total, 121 + np.log2(total).astype(np.int64)).astype(np.uint8)
    codes = np.empty(len(every), np.uint8)
    codes[order] = np.repeat(code, np.diff(np.append(first, len(every))))
    edge = np.cumsum([0, *map(len, keys)])
    return pa.table(
        [table["pack"], table["bucket"], pa.array([codes[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())],
        schema=_ANSWER,
    )


def codes_of(keys: np.ndarray, n_buckets: int, buckets, codes) -> np.ndarray:
    """The codes of a pack's sorted distinct keys from its answers."""
    out = np.zeros(len(keys), np.uint8)
    found = dict(zip(buckets, codes))
    for b, i in _by_bucket(keys, n_buckets):
        out[i] = np.frombuffer(found[b], np.uint8)
    return out


def recurrence(asked: DataFrame) -> DataFrame:
    """Answers to all packs' keys: (pack, bucket, codes)."""
    return asked.groupBy("bucket").applyInArrow(tidy(lambda key, table: answered(table)), ANSWER)
