"""Self-join of documents on the Jaccard similarity of their word n-gram sets.

Universe partition and pigeonhole.  Sizes fall into bands.  In a band, a hash deals every n-gram
to one of m segments; two sets whose similarity reaches the threshold differ in at most H
n-grams, so they can't differ in too many segments:

* Every segment is a signature by itself (it fails if the sets differ there at all), and D of
  them also carry their one-deletion neighbourhood (they fail only at two differences).  With
  m = H + 1 the capacity is H + 1 + D, so any linked pair keeps at least D + 1 of it.
* Allocation by cost: a document need not probe its D costliest units, those whose signatures
  are met most often (empty segments, segments of common passages).  It still lists them, so
  that others may find it there.  Whatever it skips, one probe of either side must meet.
* A filter over all packs counts every signature; what occurs once is dropped unshuffled.

Candidates meet as small sketches first, whose unequal bytes bound the differences from below;
pairs that the bound leaves open are verified exactly on the whole sets.  Equal sets collapse to
one representative beforehand.  In each signature's class, members meet one hub after another
instead of each other; links found so join components.  Members of a small class that its first
hub leaves in different components then meet pair by pair, each pair once however many classes
it shares; those that several hubs of a large class leave apart meet in blocks of sketches.  So
no link between different components is lost and no list of all pairs arises.

A document with fewer than n words has its whole word sequence as its one n-gram; without words
its set is empty and linked with nothing.  N-grams are told apart by 64-bit fingerprints; equal
sets are recognised by 128 bits.  Rows of one identifier are one document, that of its largest
set fingerprint; a null identifier is linked with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import shared_folder, staged
from . import packs
from .arrays import NOT_SPACE, grams, mix, text_buffers, tidy, words
from .components import connected

N = 4
NUMERATOR, DENOMINATOR = 85, 100
BAND_GROWTH = 1.4
HUB_ROUNDS = 2
PAIRED = 32  # classes of up to so many members list their pairs once the first hub is met
BLOCK_ROWS = 2048  # members of a class whose sketches meet in one task
VERIFY_ROWS = 256  # pairs whose sets are in memory at once
BROADCAST_IDS = 1 << 20  # of 8 bytes each
_CAND = (
    "doc_id long, n_shingles long, high long, low long, signatures array<struct<signature:long,probe:boolean>>, sketch binary"
)


class Bands:
    """Size bands of a threshold p/q, and what their segments need."""

    def __init__(self, p: int = NUMERATOR, q: int = DENOMINATOR):
        self.p, self.q = p, q
        self.low, self.high = [1], [1]
        while self.low[-1] < 1 << 40:
            low = self.high[-1] + 1
            self.low.append(low)
            self.high.append(max(low, int(low * BAND_GROWTH)))

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.high, n))

    def differences(self, band: int) -> int:
        """Most n-grams in which two linked sets differ whose larger one is of the band.

        With i common of r and s, i / (r + s - i) >= p/q, so r + s - 2i <= (r + s)(q - p)/(q + p).
        """
        return 2 * self.high[band] * (self.q - self.p) // (self.q + self.p)

    def schemes(self, n: int) -> list[int]:
        """Bands whose members a set of n n-grams can be linked with as the smaller one, and its own."""
        own = self.of(n)
        largest = n * self.q // self.p
        return [b for b in range(own, self.of(largest) + 1)]

    @staticmethod
    def slack(differences: int) -> int:
        """D: segments with one-deletion neighbourhoods, and the capacity a probe may skip."""
        return (differences + 1 + 19) // 20 if differences else 0


_bands: dict[tuple[int, int], Bands] = {}


def bands_of(p: int, q: int) -> Bands:
    if (p, q) not in _bands:
        _bands[p, q] = Bands(p, q)
    return _bands[p, q]


def signatures(shingles: np.ndarray, band: int, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set in a band and the unit each belongs to.

    Unit 2s is segment s as it is; unit 2s + 1 its one-deletion neighbourhood.
    """
    h = bands.differences(band)
    m, d = h + 1, bands.slack(h)
    salt = mix(np.array([band + 1], np.uint64))[0]
    spread = mix(shingles ^ salt)
    segment = (spread % np.uint64(m)).astype(np.int64)
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, segment, spread)
    sizes = np.bincount(segment, minlength=m).astype(np.uint64)
    place = mix(np.arange(m, dtype=np.uint64) + salt)
    whole = mix(sums ^ place)
    if not d:
        return whole, np.arange(m) * 2
    inside = np.flatnonzero(segment < d)
    s = segment[inside]
    # what a neighbour of one element less has for its whole segment; marked apart from wholes
    mark = np.uint64(0xA5A5A5A5A5A5A5A5)
    less = mix((sums[s] - spread[inside]) ^ place[s] ^ mark)
    same = mix(sums[:d] ^ place[:d] ^ mark)
    return np.concatenate((whole, same, less)), np.concatenate((np.arange(m) * 2, np.arange(d) * 2 + 1, s * 2 + 1))


class _Pack:
    """Shingle sets and signatures of one pack."""

    def __init__(self, table: pa.Table, n: int, bands: Bands):
        self.table = packs.in_order(table)
        self.sets = shingle_sets(self.table, n)
        self.signatures = []
        for i, own in enumerate(self.sets):
            for band in bands.schemes(len(own)) if len(own) else ():
                self.signatures.append((i, band, *signatures(own, band, bands)))
        every = np.concatenate([s for _, _, s, _ in self.signatures]) if self.signatures else np.zeros(0, np.uint64)
        self.keys, self.counts = packs.distinct(every)

    def fingerprint(self, i: int) -> tuple[int, int]:
        """128 bits of the set."""
        own = self.sets[i]
        a, b = mix(own).sum(dtype=np.uint64), mix(own ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)
        return int(a.astype(np.int64)), int(b.astype(np.int64))


def shingle_sets(table: pa.Table, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram fingerprints of every row."""
    data, offsets = text_buffers(table["text"])
    _, _, values, edge = words(data, offsets, NOT_SPACE, lower=True)
    every = grams(values, n)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(every[a : b - n + 1]))
        else:
            out.append(grams(values[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def _ask(n: int, n_filter: int, p: int, q: int):
    def run(key, table):
        pack = _Pack(table, n, bands_of(p, q))
        return packs.sent(key[0].as_py(), pack.keys, pack.counts, n_filter, narrow=True)

    return run


_CAND_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("high", pa.int64()), ("low", pa.int64()),
        ("signatures", pa.list_(pa.struct([("signature", pa.int64()), ("probe", pa.bool_())]))), ("sketch", pa.binary()),
    ]
)


def _allocate(n: int, n_filter: int, p: int, q: int):
    def run(key, table, answers):
        if not table.num_rows:
            return _CAND_SCHEMA.empty_table()
        bands = bands_of(p, q)
        pack = _Pack(table, n, bands)
        codes = packs.codes_of(pack.keys, n_filter, answers["bucket"].to_pylist(), answers["codes"].to_pylist())
        rows, named, probed = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for i, band, own, unit in pack.signatures:
            code = codes[np.searchsorted(pack.keys, own)].astype(np.int64)
            met = np.flatnonzero(code >= 2)
            if not len(met):
                continue
            # up to D units may go unprobed: those whose signatures are met most often
            cost = np.zeros(int(unit.max()) + 1, np.int64)
            np.maximum.at(cost, unit, code)
            dear = np.flatnonzero(cost >= 3)
            dear = dear[np.argsort(-cost[dear], kind="stable")][: bands.slack(bands.differences(band))]
            skipped = np.zeros(len(cost), bool)
            skipped[dear] = True
            rows.append(np.full(len(met), i))
            named.append(own[met].astype(np.int64))
            probed.append(~skipped[unit[met]])
        edge = np.searchsorted(np.concatenate(rows), np.arange(len(pack.sets) + 1))
        listed = pa.ListArray.from_arrays(
            pa.array(edge, pa.int32()),
            pa.StructArray.from_arrays([pa.array(np.concatenate(named)), pa.array(np.concatenate(probed))], ["signature", "probe"]),
        )
        prints = [pack.fingerprint(i) if len(s) else (0, 0) for i, s in enumerate(pack.sets)]
        sketches = [
            folding_sketch(s, width_for(len(s), p, q) // 2) if b > a else None for s, a, b in zip(pack.sets, edge[:-1], edge[1:])
        ]
        return pa.table(
            [
                pack.table["doc_id"], pa.array([len(s) for s in pack.sets], pa.int64()),
                pa.array([x for x, _ in prints], pa.int64()), pa.array([x for _, x in prints], pa.int64()),
                listed, pa.array(sketches, pa.binary()),
            ],
            schema=_CAND_SCHEMA,
        )

    return run


def _similarities(n: int):
    """Sizes of two texts' sets and of their intersection."""

    def run(batches):
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, VERIFY_ROWS):
                part = batch.slice(at, VERIFY_ROWS)
                sides = [shingle_sets(pa.table({"text": part.column(c)}), n) for c in ("text_a", "text_b")]
                for a, b in zip(*sides):
                    joined = np.sort(np.concatenate((a, b)))
                    out.append((len(a), len(b), int((joined[1:] == joined[:-1]).sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3))],
                names=["a", "b", "n_a", "n_b", "common"],
            )

    return run


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder; texts take less there than in a checkpoint."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the given identifiers: a broadcast of at most BROADCAST_IDS of them, else a shuffle."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")


def _may_link(p: int, q: int):
    """Pairs whose sketches leave the link open; a pair without both sketches stays."""

    def run(batches):
        for batch in batches:
            sides = [batch.column(c) for c in ("sketch_a", "sketch_b")]
            known = np.flatnonzero(np.logical_and(*(s.is_valid().to_numpy(zero_copy_only=False) for s in sides)))
            keep = np.ones(batch.num_rows, bool)
            data, start, width = zip(*((d, o[known], o[known + 1] - o[known]) for d, o in map(text_buffers, sides)))
            both = sum(batch.column(c).to_numpy(zero_copy_only=False)[known] for c in ("n_a", "n_b"))
            for wa, wb in set(zip(*(w.tolist() for w in width))):
                at = np.flatnonzero((width[0] == wa) & (width[1] == wb))
                w = min(wa, wb)
                for i in range(0, len(at), VERIFY_ROWS):
                    some = at[i : i + VERIFY_ROWS]
                    # a wider sketch folds to the narrower one's width
                    a, b = (
                        data[k][start[k][some][:, None] + np.arange(own)].reshape(len(some), -1, w).sum(1, dtype=np.uint8)
                        for k, own in enumerate((wa, wb))
                    )
                    keep[known[some]] = np.count_nonzero(a != b, axis=1) * (q + p) <= both[some] * (q - p)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in "ab"], names=["a", "b"])

    return run


def open_pairs(pairs: DataFrame, sketches: DataFrame, p: int, q: int) -> DataFrame:
    """The candidate pairs (a, b) that their sketches (doc_id, n, sketch) leave open."""
    left, right = (
        sketches.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab"
    )
    return pairs.select("a", "b").join(right, "b").join(left, "a").mapInArrow(tidy(_may_link(p, q)), "a long, b long")


def one_text_each(docs: DataFrame, wanted: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text) of the wanted identifiers; only texts of repeated identifiers are shuffled."""
    repeated = staged(found.groupBy("doc_id").count().filter("count > 1").select("doc_id").join(wanted, "doc_id", "left_semi"))
    if repeated.isEmpty():
        return with_ids(docs, wanted)
    once = with_ids(docs, wanted.join(repeated, "doc_id", "left_anti"))
    return once.union(with_ids(docs, repeated).dropDuplicates(["doc_id"]))


def verified(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(a, b, n_a, n_b, common) of candidate pairs (a, b)."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = with_ids(texts, ids)
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    return both.mapInArrow(tidy(_similarities(n)), "a long, b long, n_a long, n_b long, common long")


def join(docs: DataFrame, n: int = N, p: int = NUMERATOR, q: int = DENOMINATOR) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, the least document reachable by links."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = packs.text_bytes(docs)
    n_filter = packs.buckets_for(total, 0.3 / 6, 9)
    dealt = packs.in_packs(docs, total)
    answers = packs.recurrence(dealt.groupBy("pack").applyInArrow(tidy(_ask(n, n_filter, p, q)), packs.SENT))
    found = staged(dealt.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(tidy(_allocate(n, n_filter, p, q)), _CAND))
    # one row per identifier; equal sets have one representative
    single = found.filter("doc_id is not null and n_shingles > 0 and size(signatures) > 0")
    classes = single.groupBy("high", "low", "n_shingles").agg(F.min("doc_id").alias("rep"))
    member = single.join(classes, ["high", "low", "n_shingles"]).select("doc_id", "rep")
    heads = single.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    listed = staged(
        heads.select("doc_id", F.col("n_shingles").alias("n"), F.explode("signatures").alias("s"))
        .select(F.col("s.signature").alias("signature"), "doc_id", "n", F.col("s.probe").alias("probe")).dropDuplicates(["signature", "doc_id"])
    )
    shared = listed.groupBy("signature").agg(
        F.count(F.lit(1)).alias("members"), F.max("probe").alias("probed"), F.min(F.struct("doc_id", "n")).alias("h")
    ).filter("members > 1 and probed")
    spots = staged(
        listed.join(shared.select("signature", "members", F.col("h.doc_id").alias("hub"), F.col("h.n").alias("hub_n")), "signature")
    )
    fits = F.expr(f"n * {q} >= hub_n * {p} and hub_n * {q} >= n * {p}")
    wanted = spots.select("doc_id").distinct()
    wanted = staged(wanted)
    texts = written(one_text_each(docs, wanted, found), "texts")
    # rows of one identifier that differ have no sketch in common, and all their pairs stay open
    print_of = F.struct("high", "low", "n_shingles")
    sketches = staged(
        single.join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.min("n_shingles").alias("n"), F.min(print_of).alias("_least"), F.max(print_of).alias("_most"),
            F.first("sketch").alias("sketch"),
        ).select("doc_id", "n", F.when(F.col("_least") == F.col("_most"), F.col("sketch")).alias("sketch"))
    )
    distances = None
    linked = F.expr(f"{q} * common >= {p} * (n_a + n_b - common)")
    label = None
    for turn in range(HUB_ROUNDS + 1):
        if not turn:
            pairs = spots.filter("doc_id <> hub").filter(fits).select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
        else:
            # classes of more than the one pair already compared whose members are still apart
            some = "members > 2" if turn == 1 else f"members > {PAIRED}"
            placed = spots.filter(some).drop("hub", "hub_n").join(label, "doc_id")
            apart = placed.groupBy("signature").agg(
                F.min("component").alias("c1"), F.max("component").alias("c2"),
                F.min(F.struct(F.xxhash64("doc_id", F.lit(turn)), "doc_id", "n", "component")).alias("h"),
            ).filter("c1 <> c2").select(
                "signature", F.col("h.doc_id").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.component").alias("hub_component")
            )
            now = staged(placed.join(apart, "signature"))
            if now.isEmpty():
                break
            large = now.filter(f"members > {PAIRED}")
            if turn < HUB_ROUNDS:
                pairs = large.filter("component <> hub_component").filter(fits).select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
            else:
                pairs = _rest(large, texts, n, p, q)
            if turn == 1:
                pairs = pairs.union(_pairs(now.filter(f"members <= {PAIRED}"), p, q))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if distances is not None:
            pairs = pairs.join(distances, ["a", "b"], "left_anti")
        if turn < HUB_ROUNDS or turn == 1:
            pairs = open_pairs(pairs, sketches, p, q)
        new = staged(verified(staged(pairs), texts, n))
        distances = new if distances is None else distances.union(new)
        label = staged(connected(distances.filter(linked).select("a", "b"), spots.select("doc_id").distinct()))
    reached = member.join(label.select(F.col("doc_id").alias("rep"), "component"), "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component")
    )
    reached = reached.groupBy("doc_id").agg(F.min("component").alias("component"))
    return found.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")).join(reached, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def width_for(n: int, p: int, q: int) -> int:
    """Segments of a sketch for sets of up to n n-grams: three times the differences of a link."""
    return 1 << max(3, (3 * (2 * n * (q - p) // (q + p) + 1) - 1).bit_length())


def sketch(shingles: np.ndarray, width: int) -> bytes:
    """A byte of each segment's content.

    An n-gram that two sets don't share changes one segment at most, so the number of unequal
    bytes never exceeds the number of n-grams in which the sets differ.
    """
    spread = mix(shingles ^ np.uint64(0x3C3C3C3C3C3C3C3C))
    sums = np.zeros(width, np.uint64)
    np.add.at(sums, (spread & np.uint64(width - 1)).astype(np.int64), spread)
    return (mix(sums) >> np.uint64(56)).astype(np.uint8).tobytes()


def folding_sketch(shingles: np.ndarray, width: int) -> bytes:
    """A sketch whose segments are sums of bytes modulo 256.

    Its first and second half, added, are the sketch of half the width, so those of sets of
    unlike size compare.  The bound of ``sketch`` holds.
    """
    spread = mix(shingles ^ np.uint64(0x3C3C3C3C3C3C3C3C))
    segment = (spread & np.uint64(width - 1)).astype(np.int64)
    sums = np.bincount(segment, (spread >> np.uint64(56)).astype(np.float64), width)
    return sums.astype(np.int64).astype(np.uint8).tobytes()


def _sketches(n: int):
    def run(batches):
        for batch in batches:
            sets = shingle_sets(pa.Table.from_batches([batch]), n)
            made = [sketch(s, w) for s, w in zip(sets, batch.column("width").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("width"), pa.array(made, pa.binary())], names=["doc_id", "width", "sketch"]
            )

    return run


def _close_pairs(p: int, q: int):
    """Pairs of a class that their sketches allow, from rows sorted by class and block pair.

    A pair that shares several classes is given only by the least of those that either probes.
    """

    def pairs_of(rows):
        ids, parts, sizes = rows["doc_id"], rows["component"], rows["n"]
        signature = rows["signature"][0]
        own = rows["own"]
        order = np.arange(len(ids))
        left, right = (order, order) if rows["low"][0] == rows["high"][0] else (order[own == rows["low"][0]], order[own == rows["high"][0]])
        if not len(left) or not len(right):
            return []
        bits = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(ids), -1)
        other, out = bits[right], []
        probed: dict[int, frozenset] = {}
        listed: dict[int, frozenset] = {}
        for i in left.tolist():
            near = (ids[right] > ids[i]) if left is right else np.ones(len(right), bool)
            near = near & (parts[right] != parts[i]) & (rows["probe"][right] | rows["probe"][i])
            near &= (sizes[right] * q >= sizes[i] * p) & (sizes[i] * q >= sizes[right] * p)
            at = np.flatnonzero(near)
            if len(at):
                unequal = np.count_nonzero(other[at] != bits[i], axis=1)
                at = at[unequal * (q + p) <= (sizes[right[at]] + sizes[i]) * (q - p)]
            for j in right[at].tolist():
                for k in (i, j):
                    if k not in probed:
                        probed[k] = frozenset(rows["probed"][k])
                        listed[k] = probed[k].union(rows["skipped"][k])
                if min((probed[i] & listed[j]) | (listed[i] & probed[j])) == signature:
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return out

    names = ["signature", "low", "high", "own", "doc_id", "component", "n", "probe", "sketch", "probed", "skipped"]

    def run(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch]).select(names)
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not held.num_rows:
                continue
            key = [held[c].to_numpy() for c in names[:3]]
            cut = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in key], axis=0))))
            ready = cut if batch is None else cut[:-1]  # the last group may go on
            found = []
            for a, b in zip(ready, np.append(cut[1:], held.num_rows)):
                part = held.slice(a, b - a)
                rows = {c: part[c].to_numpy() for c in names[:8]}
                rows |= {c: part[c].to_pylist() for c in names[8:]}
                found += pairs_of(rows)
            held = None if batch is None else held.slice(cut[-1])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 2)], names=["a", "b"])

    return run


def _with_end(batches):
    yield from batches
    yield None


def _pairs(spots: DataFrame, p: int, q: int) -> DataFrame:
    """All pairs of small classes in different components, one side probing, that fit by size."""
    left, right = (
        spots.select("signature", *(F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "n", "probe", "component"))) for side in "ab"
    )
    met = left.join(right, "signature").filter("doc_id_a < doc_id_b and component_a <> component_b and (probe_a or probe_b)")
    fitting = met.filter(f"n_a * {q} >= n_b * {p} and n_b * {q} >= n_a * {p}")
    return fitting.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))


def _rest(spots: DataFrame, texts: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """All pairs of a class in different components that can be linked, by blocks of sketches.

    A class of k members meets itself in blocks of at most BLOCK_ROWS; only pairs whose sketches
    leave the link open go out.
    """
    top = spots.groupBy("signature").agg(F.max("n").alias("top"), F.count(F.lit(1)).alias("here"))
    differences = F.expr(f"2 * top * {q - p} div {q + p}")
    width = F.pow(F.lit(2), F.greatest(F.lit(3), F.ceil(F.log2(3 * (differences + 1))))).cast("long").alias("width")
    rows = spots.select("signature", "doc_id", "n", "probe", "component").join(
        top.select("signature", width, F.ceil(F.col("here") / BLOCK_ROWS).alias("blocks")), "signature"
    )
    rows = staged(rows)
    classes = rows.groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("probe"), F.col("signature"))).alias("probed"),
        F.collect_set(F.when(~F.col("probe"), F.col("signature"))).alias("skipped"),
    )
    wanted = rows.select("doc_id", "width").distinct()
    sketches = with_ids(texts, wanted.select("doc_id").distinct()).join(wanted, "doc_id").select("doc_id", "text", "width")
    # joined by document first: the rows, many for each, then carry both in one shuffle
    sketches = sketches.mapInArrow(tidy(_sketches(n)), "doc_id long, width long, sketch binary").join(classes, "doc_id")
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("own")
    dealt = (
        rows.select("*", own).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("met"))
        .withColumn("low", F.least("own", "met")).withColumn("high", F.greatest("own", "met"))
        .join(sketches, ["doc_id", "width"])
        .repartition("signature", "low", "high").sortWithinPartitions("signature", "low", "high", "doc_id")
    )
    return dealt.select("signature", "low", "high", "own", "doc_id", "component", "n", "probe", "sketch", "probed", "skipped").mapInArrow(
        tidy(_close_pairs(p, q)), "a long, b long"
    )
