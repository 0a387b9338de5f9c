"""Vector code compression: product quantisation over Hilbert-sorted flat blocks.

Vectors are cut into equal parts, and each part position has a codebook of ``ENTRIES``
integer entries. All part vectors are sorted once along a Hilbert curve and stored in flat
blocks with the least and greatest value of each component and the sum of the vectors. In
each round the distances between a block's box and the entries bound what any vector of the
block can be nearest to: entries whose least distance exceeds another's greatest distance
drop out, and the rest are the block's shortlist. A shortlist of one takes the block as a
whole, by its stored sum; longer ones are compared vector by vector, in integers. So rounds
are exact whatever the bounds prune.

The codebooks (4 x 256 entries) travel with the tasks and come back as sums per entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rillmart.llm.common import materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: vectors of a block
BLOCK = 128
#: components saturate here, so that squared distances and their sums stay exact longs
RANGE = 1 << 26
#: float products of integers are exact below this size of their sum
EXACT = 1 << 53
#: bits of a place on the curve
CURVE_BITS = 60


# -- the curve ---------------------------------------------------------------------


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along the Hilbert curve of each row of cell numbers below 2**bits.

    Undoes the curve's turns and mirrors from the highest bit down, axis by axis, then reads
    the bits of all axes in turn; at most ``CURVE_BITS`` bits in all.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        low = bit - 1
        for i in range(n):
            mirrored = (x[i] & bit) != 0
            swapped = np.where(mirrored, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(mirrored, low, swapped)
            x[i] ^= swapped
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[n - 1] & bit, bit - 1, 0)
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def places(part: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Places on the curve of part vectors whose components lie within lo to hi."""
    axes = min(part.shape[1], CURVE_BITS)
    bits = max(1, min(16, CURVE_BITS // max(1, axes)))
    shift = max(0, int(hi - lo).bit_length() - bits)
    return hilbert((part[:, :axes] - lo) >> shift, bits)


# -- kept vectors ------------------------------------------------------------------


def kept(vectors: DataFrame) -> DataFrame:
    """_row, vec_id, label and integer components ``_x`` of the rows that take part, stored once."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), x.alias("_v")).where(
        F.col("_v").isNotNull()
        & (F.size("_v") > 0)
        & F.forall("_v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    rows = rows.select(
        F.monotonically_increasing_id().alias("_row"), "vec_id", "label",
        F.transform(
            "_v",
            lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(RANGE))), F.lit(float(-RANGE)))).cast("int"),
        ).alias("_x"),
    )
    return materialize(rows)


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def part_rows(rows: DataFrame, dims: int, width: int, lo: int, hi: int) -> DataFrame:
    """One row per part of a vector: _part, _place, _row and its components as bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("_x"), dims)
            x = np.pad(x, ((0, 0), (0, PARTS * width - dims)))
            for p in range(PARTS):
                part = np.ascontiguousarray(x[:, p * width:(p + 1) * width])
                data = part.astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), p, np.int32)),
                        pa.array(places(part, lo, hi)),
                        b.column("_row"),
                        pa.array([r.tobytes() for r in data], pa.binary()),
                    ],
                    ["_part", "_place", "_row", "_data"],
                )

    return rows.select("_row", "_x").mapInArrow(each, "_part int, _place long, _row long, _data binary")


_BLOCK_SCHEMA = "_part int, n int, lo binary, hi binary, total binary, ids binary, data binary"


def blocks(parts: DataFrame, width: int) -> DataFrame:
    """Flat blocks of neighbours along the curve, with their boxes and sums; stored once.

    Ranges of (part, place, row) spread a place that many vectors share.
    """
    size = BLOCK

    def block(part: int, ids: list[np.ndarray], data: list[bytes]) -> tuple:
        x = np.frombuffer(b"".join(data), "<i4").reshape(-1, width).astype(np.int64)
        as_bytes = [v.astype("<i8").tobytes() for v in (x.min(axis=0), x.max(axis=0), x.sum(axis=0))]
        return (part, len(x), *as_bytes, np.array(ids, "<i8").tobytes(), x.astype("<i4").tobytes())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, data = None, [], []
        for b in batches:
            out = []
            for p, row, d in zip(*(b.column(n).to_pylist() for n in ("_part", "_row", "_data"))):
                if ids and (p != part or len(ids) == size):
                    out.append(block(part, ids, data))
                    ids, data = [], []
                part = p
                ids.append(row)
                data.append(d)
            if out:
                yield _block_batch(out)
        if ids:
            yield _block_batch([block(part, ids, data)])

    order = ["_part", "_place", "_row"]
    dealt = parts.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.mapInArrow(each, _BLOCK_SCHEMA))


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    names = ["_part", "n", "lo", "hi", "total", "ids", "data"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


# -- rounds ------------------------------------------------------------------------


def shortlist(lo: np.ndarray, hi: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Indexes, ascending, of the entries that some point of the box may be nearest to.

    An entry further from every point than another is from the furthest point drops out;
    one that may tie stays.
    """
    below, above = lo - entries, entries - hi
    nearest = np.maximum(np.maximum(below, above), 0)
    furthest = np.maximum(np.abs(below), np.abs(above))
    least = (nearest * nearest).sum(axis=1)
    return np.flatnonzero(least <= (furthest * furthest).sum(axis=1).min())


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the index of the nearest entry (ties to the lower) and its squared distance.

    Products go through floats where every sum in them is an exact integer, else through longs.
    """
    most = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))) ** 2 * 4 * x.shape[1]
    if most < EXACT:
        e = entries.astype(np.float64)
        score = (e * e).sum(axis=1) - 2.0 * (x.astype(np.float64) @ e.T)
    else:
        score = (entries * entries).sum(axis=1) - 2 * (x @ entries.T)
    at = score.argmin(axis=1)
    apart = x - entries[at]
    return at, (apart * apart).sum(axis=1)


def _blocks_of(batch: pa.RecordBatch, width: int):
    """(part, n, lo, hi, total, ids, vectors) of each block of a batch."""
    columns = [batch.column(n).to_pylist() for n in ("_part", "n", "lo", "hi", "total", "ids", "data")]
    for part, n, lo, hi, total, ids, data in zip(*columns):
        yield (
            part, n, *(np.frombuffer(v, "<i8") for v in (lo, hi, total)), np.frombuffer(ids, "<i8"),
            np.frombuffer(data, "<i4").reshape(n, width).astype(np.int64),
        )


def summed(stored: DataFrame, books: np.ndarray) -> DataFrame:
    """_part, _entry, n, s0, s1, ...: count and sums of the vectors each entry is nearest to.

    A task sends one row for each entry it uses.
    """
    width = books.shape[2]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(books.shape[:2], np.int64)
        sums = np.zeros(books.shape, np.int64)
        for b in batches:
            for part, n, lo, hi, total, _, x in _blocks_of(b, width):
                near = shortlist(lo, hi, books[part])
                if len(near) == 1:
                    counts[part, near[0]] += n
                    sums[part, near[0]] += total
                    continue
                at = near[nearest(x, books[part][near])[0]]
                counts[part] += np.bincount(at, minlength=counts.shape[1])
                order = np.argsort(at, kind="stable")
                used, firsts = np.unique(at[order], return_index=True)
                sums[part, used] += np.add.reduceat(x[order], firsts, axis=0)
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], names)

    names = ["_part", "_entry", "n", *(f"s{i}" for i in range(width))]
    schema = ", ".join(f"{n} long" for n in names)
    sums = stored.mapInArrow(each, schema).groupBy("_part", "_entry")
    return sums.agg(*[F.sum(n).alias(n) for n in names[2:]])


def improved(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round; entries that no vector is nearest to stay."""
    out = books.copy()
    for row in summed(stored, books).collect():  # PARTS x ENTRIES rows at most
        part, entry, n, *sums = row
        out[part, entry] = np.array(sums, np.int64) // n
    return out


def assigned(stored: DataFrame, books: np.ndarray) -> DataFrame:
    """_row, _part, _entry and _error of every part vector."""
    width = books.shape[2]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, n, lo, hi, _, ids, x in _blocks_of(b, width):
                near = shortlist(lo, hi, books[part])
                at, error = nearest(x, books[part][near])
                columns = [ids, np.full(n, part, np.int64), near[at], error]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], ["_row", "_part", "_entry", "_error"]
                )

    return stored.mapInArrow(each, "_row long, _part long, _entry long, _error long")


def first_books(rows: DataFrame, dims: int, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, ``ENTRIES`` rows at most."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "_x").limit(ENTRIES).select("_x").collect()
    x = np.zeros((len(first), PARTS * width), np.int64)
    x[:, :dims] = np.array([r["_x"] for r in first], np.int64).reshape(-1, dims)
    return np.ascontiguousarray(x.reshape(-1, PARTS, width).transpose(1, 0, 2))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


_OUT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that takes part.

    Null vectors and ones that are empty or hold null or non-finite components are dropped.
    The length that most vectors have, the greater among equally frequent ones, is the length
    of all; vectors of another length are dropped, and one that four does not divide is filled
    with zeros. Components saturate at 2**26 (65,536 before scaling). Fewer vectors than
    entries give shorter codebooks. Rows of one vec_id are vectors of their own, ordered by
    their integer components; a null vec_id comes last. Labels of null are one group. No vectors, no
    rows. Columns other than vec_id, embedding and label are not read.
    """
    rows = kept(vectors)
    lengths = rows.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], _OUT)
    dims = lengths["d"]
    width = -(-dims // PARTS)
    rows = rows.where(F.size("_x") == dims)
    bounds = rows.select(F.array_min("_x").alias("lo"), F.array_max("_x").alias("hi"))
    lo, hi = bounds.agg(F.least(F.min("lo"), F.lit(0)), F.greatest(F.max("hi"), F.lit(0))).first()
    books = first_books(rows, dims, width)
    stored = blocks(part_rows(rows, dims, width, lo, hi), width)
    for _ in range(rounds):
        books = improved(stored, books)
    coded = assigned(stored, books).groupBy("_row").agg(
        F.concat(*[F.lpad(F.hex(F.max(F.when(F.col("_part") == p, F.col("_entry")))), 2, "0") for p in range(PARTS)]).alias("code"),
        F.sum("_error").alias("error"),
    )
    found = materialize(rows.select("_row", "vec_id", "label").join(coded, "_row"))
    by_label = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return found.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", F.lower("code").alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
