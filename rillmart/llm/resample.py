"""Importance resampling towards a target distribution, by hashed n-gram features.

A text's features are its runs of one to three words, hashed into buckets. Two counting
jobs give the share of each bucket in the corpus and in the target; their log ratio is an
array of ``BUCKETS`` gains, and a text's weight is the sum of the gains at its features.
Weights with Gumbel noise are persisted scores, of which the highest are drawn: the cutoff
is found by bisecting the numbers, each step a job that counts rows exactly, first by score
and then by doc_id among rows tied at the cutoff. Only the drawn rows are sorted, by range
partitions, whose sizes give the ranks.

Nothing but counts reaches the driver: one number a bucket, a few a bisection step, one a
partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rillmart.llm.common import materialize

BUCKETS = 10_000
SEED = 42
#: the least words of a text that may be drawn, and the share drawn of those, in per cent
LEAST_WORDS = 20
PER_CENT = 5
#: parts that one counting job cuts the interval of the cutoff into
PARTS = 1024

#: bytes to word bytes: A-Z lowered, 0-9, a-z and all of non-ASCII kept, the rest parted
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def buckets(found: list[bytes]) -> np.ndarray:
    """The bucket of every run of one to three words; a run's checksum continues a shorter one's."""
    spaced = [b" " + w for w in found]
    one = list(map(crc32, found))
    two = list(map(crc32, spaced[1:], one))
    three = list(map(crc32, spaced[2:], two))
    return np.array(one + two + three, np.int64) % BUCKETS


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts each bucket holds; a task sends one row a bucket."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                total += np.bincount(buckets(words(t)), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(each, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():  # BUCKETS rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * the log of the smoothed share in the target over that in the source)."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row; map side only."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column("text").to_pylist():
                found = words(t)
                at = buckets(found)
                rows.append((len(found), len(at), int(gain[at].sum())))
            n_words, n_features, weight = np.array(rows, np.int64).reshape(-1, 3).T
            columns = [b.column("doc_id"), *(pa.array(np.ascontiguousarray(c)) for c in (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        each, "doc_id long, n_words long, n_features long, weight long"
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id; a null id hashes as an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


# -- the cutoff --------------------------------------------------------------------


def least(rows: DataFrame, value: str, wanted: int) -> tuple[int, int, int]:
    """The least number c with at least ``wanted`` rows of value <= c, and the rows below and at it.

    Each step counts the rows in ``PARTS`` even parts of the interval that holds c, exactly
    and over all rows, and goes on in the part where the wanted row falls.
    """
    lo, hi, at = rows.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
    below = 0
    while lo < hi:
        step = -(-(hi - lo + 1) // PARTS)
        inside = rows.where(F.col(value).between(lo, hi))
        # as decimals: two longs may lie further apart than a long holds
        part = F.expr(f"(cast({value} as decimal(20,0)) - cast('{lo}' as decimal(20,0))) div {step}BD")
        counts = dict(map(tuple, inside.groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect()))
        for k in sorted(counts):
            if below + counts[k] >= wanted:
                break
            below += counts[k]
        lo, hi, at = lo + k * step, min(hi, lo + (k + 1) * step - 1), counts[k]
    return lo, below, at


def cutoff(rows: DataFrame, order: list[str], wanted: int) -> Column:
    """A predicate that holds for the first ``wanted`` rows by the numbers in ``order``, which
    together must tell rows apart; ``wanted`` is at most their number."""
    if wanted <= 0:
        return F.lit(False)
    drawn, tied = F.lit(False), F.lit(True)
    for name in order:
        c, below, at = least(rows.where(tied), name, wanted)
        drawn = drawn | (tied & (F.col(name) < F.lit(c)))
        tied = tied & (F.col(name) == F.lit(c))
        wanted -= below
        if wanted == at:
            break
    return drawn | tied


def ranked(rows: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """rows with their number, from 1, in the order of these columns.

    Range partitions are sorted and numbered apart, once, and what lies before a partition is
    the sum of the sizes before it, one number a partition.
    """
    schema = rows.withColumns({"_part": F.lit(0).cast("long"), "_at": F.lit(0).cast("long")}).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            own = pa.array(np.arange(at + 1, at + b.num_rows + 1))
            at += b.num_rows
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part)), own], [*b.schema.names, "_part", "_at"]
            )

    numbered = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(each, schema))
    sizes = numbered.groupBy("_part").agg(F.max("_at").alias("n")).orderBy("_part").collect()
    before, starts = 0, []
    for row in sizes:
        starts.append((row["_part"], before))
        before += row["n"]
    offsets = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    return numbered.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop(
        "_part", "_at", "_before"
    )


def resampled(
    docs: DataFrame, target: DataFrame, seed: int = SEED, least_words: int = LEAST_WORDS, per_cent: int = PER_CENT
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) for every row of docs.

    Of the rows with ``least_words`` words, floor(per_cent / 100 of their number) are drawn:
    those of the highest scores, ties to the smaller doc_id. Null and empty texts have no
    words and weight 0; a null doc_id comes last among ties and hashes as an empty string.
    Rows equal in score and doc_id are drawn in an order of their own, one by one. Empty
    tables give no rows, an empty target a target without features. Other columns are not read.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = weighed(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = materialize(
        scored.select(
            "doc_id", "n_features", "weight", "score", (F.col("n_words") >= least_words).alias("_fit"),
            (-F.col("score")).alias("_down"), F.col("doc_id").isNull().cast("long").alias("_no_id"),
            F.coalesce("doc_id", F.lit(0)).alias("_id"), F.monotonically_increasing_id().alias("_row"),
        )
    )
    order = ["_down", "_no_id", "_id", "_row"]
    fit = rows.where("_fit")
    drawn = F.col("_fit") & cutoff(fit, order, per_cent * fit.count() // 100)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return (
        ranked(rows.where(drawn), order)
        .select(*columns)
        .unionByName(rows.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(*columns))
    )
