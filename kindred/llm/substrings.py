"""Substring deduplication: words covered by a window of words that also starts elsewhere.

Suffixes (window starts) are split by content-defined prefixes and each part becomes a suffix
tree cut off at the window's depth:

* A suffix's prefix is named by its anchor, the k-gram of least fingerprint inside the window.
  Prefixes that occur once anywhere are leaves near the root: a filter over all packs drops
  them, which is most of the corpus.
* Prefix classes fill buckets of bounded size.  A prefix met in more than ``HOT`` places is
  lengthened to the window's full depth, so its suffixes spread over all buckets.
* Inside a bucket, suffixes sorted by prefix and path fingerprint form the subtree; a node of
  the window's depth with two leaves is a deep internal node.  Consecutive deep nodes of a
  document join into its maximal repeats.

Prefix and path are independent 64-bit fingerprints, so nodes are told apart by 128 bits.

Null texts have no words.  Texts shorter than the window keep every word.  Equal rows, also
those of one identifier, count as different documents.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import packs
from .arrays import NOT_SPACE, anchored_runs, covered, grams, runs_of, text_buffers, tidy, words

WINDOW = 35
ANCHOR = 8
HOT = 128 + 5  # the code of 4,096 and more places
_PAIRS = "pack long, bucket long, prefix binary, path binary, counts binary"
_PAIR_SCHEMA = pa.schema(
    [("pack", pa.int64()), ("bucket", pa.int64()), ("prefix", pa.binary()), ("path", pa.binary()), ("counts", pa.binary())]
)


class _Pack:
    """Words and anchored suffixes of one pack."""

    def __init__(self, table: pa.Table, window: int):
        self.table = packs.in_order(table)
        data, offsets = text_buffers(self.table["text"])
        self.start, self.end, self.values, self.words = words(data, offsets, NOT_SPACE)
        self.data, self.offsets, self.window = data, offsets, window
        k = min(ANCHOR, window)
        parts = list(anchored_runs(self.values, self.words, k, window))
        self.anchor, self.first, self.last = (
            np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t)
            for i, t in ((1, np.uint64), (2, np.int64), (3, np.int64))
        )
        self.keys, self.counts = packs.distinct(self.anchor)

    def suffixes(self, codes: np.ndarray):
        """Suffixes whose prefix recurs: their starts, and sorted distinct (prefix, path) nodes."""
        code = codes[np.searchsorted(self.keys, self.anchor)] if len(self.keys) else np.zeros(0, np.uint8)
        run = np.flatnonzero(code >= 2)
        size = self.last[run] - self.first[run]
        starts = np.repeat(self.first[run] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        prefix = np.repeat(self.anchor[run], size)
        hot = np.repeat(code[run] >= HOT, size)
        path = grams(self.values, self.window, other=True)[starts] if len(starts) else np.zeros(0, np.uint64)
        order = np.lexsort((path, prefix))
        a, b = prefix[order], path[order]
        fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
        first = np.flatnonzero(fresh)
        node = np.empty(len(starts), np.int64)
        node[order] = np.cumsum(fresh) - 1
        counts = np.diff(np.append(first, len(a)))
        # the bucket goes by the prefix, a lengthened prefix by all of it
        where = np.where(hot[order][first], a[first] ^ b[first], a[first])
        return starts, node, a[first], b[first], counts, where


def _ask(n_buckets: int, window: int):
    def run(key, table):
        pack = _Pack(table, window)
        return packs.sent(key[0].as_py(), pack.keys, pack.counts, n_buckets)

    return run


def _grow(n_filter: int, n_buckets: int, window: int):
    def run(key, table, answers):
        if not table.num_rows or not answers.num_rows:
            return pa.table([[]] * 5, schema=_PAIR_SCHEMA)
        pack = _Pack(table, window)
        codes = packs.codes_of(pack.keys, n_filter, answers["bucket"].to_pylist(), answers["codes"].to_pylist())
        _, _, prefix, path, counts, where = pack.suffixes(codes)
        small = np.minimum(counts, 255).astype(np.uint8)
        rows = [
            (key[0].as_py(), b, prefix[i].tobytes(), path[i].tobytes(), small[i].tobytes())
            for b, i in packs._by_bucket(where, n_buckets)
        ]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, _PAIR_SCHEMA)], schema=_PAIR_SCHEMA)

    return run


def _subtrees(table):
    """One bucket of suffixes: code 2 for leaves under a deep internal node, 1 for others."""
    prefix = [np.frombuffer(x.as_py(), np.uint64) for x in table["prefix"]]
    edge = np.cumsum([0, *map(len, prefix)])
    prefix = np.concatenate(prefix)
    path = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["path"]])
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table["counts"]]).astype(np.int64)
    order = np.lexsort((path, prefix))
    a, b = prefix[order], path[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    leaves = np.add.reduceat(counts[order], first)
    codes = np.empty(len(order), np.uint8)
    codes[order] = np.repeat(np.minimum(leaves, 2).astype(np.uint8), np.diff(np.append(first, len(order))))
    return pa.table(
        [table["pack"], table["bucket"], pa.array([codes[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary())],
        schema=packs._ANSWER,
    )


def _cut(n_filter: int, n_buckets: int, window: int, schema: pa.Schema, with_text: bool):
    def run(key, table, answers):
        if not table.num_rows:
            return schema.empty_table()
        pack = _Pack(table, window)
        parts = {"filter": [], "nodes": []}
        for bucket, codes, kind in zip(*(answers[c].to_pylist() for c in ("bucket", "codes", "kind"))):
            parts[kind].append((bucket, codes))
        removed = np.zeros(len(pack.values), bool)
        if parts["nodes"]:
            codes = packs.codes_of(pack.keys, n_filter, *zip(*parts["filter"]))
            starts, node, _, _, _, where = pack.suffixes(codes)
            again = packs.codes_of(where, n_buckets, *zip(*parts["nodes"]))[node] >= 2
            removed = covered(len(pack.values), starts[again], starts[again] + window)
        rows = []
        whole = pack.data.tobytes()
        for i in range(pack.table.num_rows):
            a, b = pack.words[i], pack.words[i + 1]
            gone = removed[a:b]
            text = whole[pack.offsets[i] : pack.offsets[i + 1]]
            n = int(gone.sum())
            kept = list(compress(text.split(), (~gone).tolist())) if n else text.split()
            row = [int(b - a), n, hashlib.sha256(b" ".join(kept)).hexdigest()]
            if with_text:
                row.append(_without(text, pack, i, gone) if n else text)
            rows.append(row)
        columns = [table_column.combine_chunks() for table_column in (pack.table[c] for c in schema.names if c in pack.table.column_names and c != "text")]
        made = dict(zip(("n_words", "n_removed", "kept_sha256", "text"), map(list, zip(*rows))))
        if with_text:
            # a null text stays null
            made["text"] = [x if ok else None for x, ok in zip(made["text"], pack.table["text"].is_valid().to_pylist())]
            made["text"] = pa.array(made["text"], pa.binary()).cast(pa.string())
        kept_columns = iter(columns)
        out = [made[c] if c in made else next(kept_columns) for c in schema.names]
        return pa.table([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    return run


def _without(text: bytes, pack: _Pack, i: int, gone: np.ndarray) -> bytes:
    """The text without its removed runs of words; what stands around them stays."""
    a = pack.words[i]
    first, last = runs_of(gone)
    out, at = [], 0
    for x, y in zip(first, last):
        start, end = int(pack.start[a + x] - pack.offsets[i]), int(pack.end[a + y - 1] - pack.offsets[i])
        out.append(text[at:start])
        at = end
    out.append(text[at:])
    return b"".join(out)


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and with ``with_text`` what stays.

    ``keep`` names further columns of ``docs`` to hand on.  One lazy plan; the only action is
    the sum of text lengths that sizes the packs.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import to_arrow_type

    total = packs.text_bytes(docs)
    density = 2.0 / (window - min(ANCHOR, window) + 2) / 6
    n_filter = packs.buckets_for(total, density, 9)
    n_buckets = packs.buckets_for(total, 0.2 / 6, 17)
    dealt = packs.in_packs(docs, total, keep)
    answers = packs.recurrence(dealt.groupBy("pack").applyInArrow(tidy(_ask(n_filter, window)), packs.SENT))
    suffixes = dealt.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(tidy(_grow(n_filter, n_buckets, window)), _PAIRS)
    nodes = suffixes.groupBy("bucket").applyInArrow(tidy(lambda key, table: _subtrees(table)), packs.ANSWER)
    both = answers.withColumn("kind", F.lit("filter")).union(nodes.withColumn("kind", F.lit("nodes")))
    fields = [("doc_id", pa.int64()), *((c, to_arrow_type(dealt.schema[c].dataType)) for c in keep)]
    fields += [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + [("text", pa.string())] * with_text
    kinds = {c: dealt.schema[c].dataType.simpleString() for c in keep}
    ddl = ", ".join(
        f"`{name}` {kinds.get(name) or {'kept_sha256': 'string', 'text': 'string'}.get(name, 'long')}" for name, _ in fields
    )
    final = tidy(_cut(n_filter, n_buckets, window, pa.schema(fields), with_text))
    return dealt.groupBy("pack").cogroup(both.groupBy("pack")).applyInArrow(final, ddl)
