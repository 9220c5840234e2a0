"""Product codes of integer vectors by rounds of k-means with norm-of-sum bounds.

Each component x becomes floor(1024 x); a vector is cut into ``PARTS`` equal consecutive
parts, and each part position has a codebook of up to ``ENTRIES`` entries, started from the
parts of the vectors with the smallest vec_ids.  A round assigns every part to its nearest
entry (squared Euclidean distance, ties to the lower index) and moves each used entry to the
componentwise floor of the mean of its parts; unused entries stay.  After the last round the
parts are assigned once more.

Bounds spare most distance computations without changing any result.  Each part keeps an
upper bound of the distance to its entry, a lower bound of the distance to every other
entry, and the round (stamp) in which both were exact.  The driver keeps every round's
codebook, so a bound is moved by the true net displacement of entries between its stamp and
now (the norm of the summed moves, never more than the sum of the moves' norms).  Only where
the moved upper bound is not clearly below the moved lower bound is the part rescanned
exactly.  A part kept by its bounds has a strictly nearest entry, so ties never depend on them.

Spark runs each round as one pass over a checkpointed state table (vectors as integers,
entries, bounds, stamps) and one grouping of partial sums (at most parts x entries rows per
task).  Codebooks, their history and displacements are bounded by rounds x parts x entries x
part width, whatever the number of rows, and are the only data the driver holds.

Defined cases: rows whose vector is null, empty, holds null or non-finite components, or has
another length than the vector of the smallest kept vec_id are dropped; a length not
divisible by ``PARTS`` raises.  Rows of equal vec_id are ordered by their integer vectors for
the starting codebook.  Null labels form one group of their own in ``label_error``.  An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import staged

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Bounds are compared in double precision; a margin this much of their size is left.
MARGIN = 1e-9
STATE = "vec_id long, label long, ints array<long>, entry array<int>, upper array<double>, lower array<double>, stamp array<int>"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, ints): kept rows with components floor(1024 x), as bigints."""
    vec = F.col("embedding")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ok = vec.isNotNull() & (F.size(vec) > 0) & finite
    ints = F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    label = F.col("label").cast("long") if "label" in vectors.columns else F.lit(None).cast("long")
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), ints.alias("ints"))


def _split(ints: np.ndarray, width: int) -> np.ndarray:
    return ints.reshape(len(ints), PARTS, width)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts (n, w) to entries (k, w), as int64."""
    return (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)[None, :]


def _assign(rows: dict, history: list[np.ndarray], width: int):
    """One assignment against ``history[-1]``: new entry, bounds and stamp of every part."""
    now = len(history) - 1
    books = history[-1]
    x = _split(rows["ints"], width)
    entry, upper, lower, stamp = rows["entry"], rows["upper"], rows["lower"], rows["stamp"]
    n = len(x)
    for p in range(PARTS):
        book = books[p]
        todo = np.ones(n, bool)
        if now > 0:
            # Net moves since each stamp, entry by entry, and the largest of the others.
            moved = np.stack([np.sqrt(((book - history[s][p]) ** 2).sum(1).astype(np.float64)) for s in range(now)])
            s = stamp[:, p]
            a = entry[:, p]
            own = moved[s, a]
            others = moved[s].copy()
            others[np.arange(n), a] = 0.0
            up = upper[:, p] + own
            low = lower[:, p] - others.max(1)
            todo = ~(up * (1 + MARGIN) + MARGIN < low)
        at = np.flatnonzero(todo)
        if at.size:
            d = _distances(x[at, p], book)
            best = np.argmin(d, axis=1)
            entry[at, p] = best
            upper[at, p] = np.sqrt(d[np.arange(at.size), best].astype(np.float64))
            if book.shape[0] > 1:
                second = np.partition(d, 1, axis=1)[:, 1]
                lower[at, p] = np.sqrt(second.astype(np.float64))
            else:
                lower[at, p] = np.inf
            stamp[at, p] = now
    return entry, upper, lower, stamp


def _columns(batch: pa.RecordBatch, width: int) -> dict:
    n = batch.num_rows
    flat = batch.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = {"ints": flat.reshape(n, PARTS * width)}
    for name, kind, empty in (("entry", np.int64, 0), ("upper", np.float64, 0.0), ("lower", np.float64, -np.inf), ("stamp", np.int64, 0)):
        column = batch.column(name)
        if column.null_count == n:
            out[name] = np.full((n, PARTS), empty, kind)
        else:
            out[name] = column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, PARTS)
    return out


def _round(history: list[np.ndarray], width: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = _columns(batch, width)
            entry, upper, lower, stamp = _assign(rows, history, width)
            listed = lambda a, t: pa.FixedSizeListArray.from_arrays(pa.array(a.ravel(), t), PARTS).cast(pa.list_(t))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"), batch.column("ints"),
                    listed(entry, pa.int32()), listed(upper, pa.float64()), listed(lower, pa.float64()), listed(stamp, pa.int32()),
                ],
                names=["vec_id", "label", "ints", "entry", "upper", "lower", "stamp"],
            )

    return run


def _final(history: list[np.ndarray], width: int):
    """The last assignment, with each row's code and exact squared error."""
    books = history[-1]

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = _columns(batch, width)
            entry = _assign(rows, history, width)[0]
            x = _split(rows["ints"], width)
            error = np.zeros(batch.num_rows, np.int64)
            for p in range(PARTS):
                diff = x[:, p] - books[p][entry[:, p]]
                error += (diff * diff).sum(1)
            code = ["".join(f"{int(j):02x}" for j in row) for row in entry]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def _sums(state: DataFrame, width: int) -> DataFrame:
    """Per (part, entry): number of parts and their componentwise sums, partial per task."""
    names = [f"s{i}" for i in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names)

    def run(batches):
        total = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _split(batch.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1), width)
            entry = batch.column("entry").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, PARTS)
            for p in range(PARTS):
                used, where = np.unique(entry[:, p], return_inverse=True)
                sums = np.zeros((used.size, width), np.int64)
                np.add.at(sums, where, x[:, p])
                counts = np.bincount(where, minlength=used.size)
                for j, s, c in zip(used, sums, counts):
                    key = (p, int(j))
                    if key in total:
                        total[key][0] += int(c)
                        total[key][1] += s
                    else:
                        total[key] = [int(c), s.copy()]
        if total:
            keys = list(total)
            cols = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([total[k][0] for k in keys], pa.int64())]
            cols += [pa.array([int(total[k][1][i]) for k in keys], pa.int64()) for i in range(width)]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "entry", "n", *names])

    partial = state.select("ints", "entry").mapInArrow(run, schema)
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])


def _moved(books: np.ndarray, sums: list) -> np.ndarray:
    """Used entries to the floor of their parts' mean; unused ones stay."""
    new = books.copy()
    for row in sums:
        p, j, n = row["part"], row["entry"], row["n"]
        total = np.array([row[f"s{i}"] for i in range(books.shape[2])], dtype=object)
        new[p, j] = np.array([int(t) // int(n) for t in total], np.int64)
    return new


def codebook_digest(books: np.ndarray) -> str:
    """sha256 of all entries' components by part, entry, position, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """Per kept vector: vec_id, label, code, error, label_error, codebooks_sha256.

    ``code``: the entry indexes in part order, two lowercase hex digits each (entries must
    be at most 256); ``error``: final squared distances summed over parts; ``label_error``:
    ``error`` summed over rows of equal label.
    """
    if entries > 256:
        raise ValueError("codes hold two hex digits: at most 256 entries")
    spark = vectors.sparkSession
    kept = integer_vectors(vectors)
    first = kept.orderBy("vec_id", "ints").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, label long, code string, error long, label_error long, codebooks_sha256 string")
    dim = len(first[0]["ints"])
    if dim % PARTS:
        raise ValueError(f"vectors of {dim} components cannot be cut into {PARTS} parts")
    width = dim // PARTS
    kept = kept.filter(F.size("ints") == dim)
    first = [r for r in first if len(r["ints"]) == dim]
    books = np.array([r["ints"] for r in first], np.int64).reshape(len(first), PARTS, width).transpose(1, 0, 2).copy()
    history = [books]
    unset = F.lit(None)
    state = kept.select(
        "vec_id", "label", "ints", unset.cast("array<int>").alias("entry"), unset.cast("array<double>").alias("upper"),
        unset.cast("array<double>").alias("lower"), unset.cast("array<int>").alias("stamp"),
    )
    for _ in range(rounds):
        state = staged(state.mapInArrow(_round(list(history), width), STATE))
        sums = _sums(state, width).collect()
        history.append(_moved(history[-1], sums))
    digest = codebook_digest(history[-1])
    rows = staged(state.mapInArrow(_final(history, width), "vec_id long, label long, code string, error long"))
    totals = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    joined = rows.join(totals, rows["label"].eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
