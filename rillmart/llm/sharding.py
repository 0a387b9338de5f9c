"""Shuffled shards by a two-pass external shuffle.

Pass one scatters records evenly into buckets that fit in memory, by a seeded hash of the
record; pass two shuffles each bucket (Fisher-Yates) and writes it. The buckets, one after
the other, are a uniformly shuffled corpus; a manifest of one row per bucket tells where each
begins, and cutting the corpus in equal runs of records gives shards whose counts are at most
one apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rillmart.llm.common import materialize
from rillmart.session import shared_dir

SHARDS = 16
#: text bytes that a bucket holds on average
BUCKET_BYTES = 16 << 20
#: a record key repeated more often than this is counted and dealt out copy by copy
HOT_COPIES = 1000


def _key(seed: int, *more: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.crc32(F.coalesce("text", F.lit(""))), *more)


def scattered(docs: DataFrame, seed: int, buckets: int) -> DataFrame:
    """docs with ``_h``, the record's hash, and ``_bucket``.

    Copies of one record have one hash. A record key that is repeated so often that its
    bucket would grow large is found by counting, its equal rows are counted before any
    shuffle, and each copy's number goes into its hash.
    """
    hot = docs.groupBy("doc_id").count().where(F.col("count") > HOT_COPIES).select(F.col("doc_id").alias("_hot"))
    plain = docs.withColumn("_h", _key(seed))
    if hot.limit(1).count():
        hot = materialize(hot)
        same = docs["doc_id"].eqNullSafe(hot["_hot"])
        names = docs.columns
        copies = docs.join(hot, same, "left_semi").groupBy(*[F.col(f"`{c}`") for c in names]).agg(
            F.count(F.lit(1)).alias("_n")
        )
        dealt = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
        plain = (
            docs.join(hot, same, "left_anti").withColumn("_h", _key(seed))
            .unionByName(dealt.withColumn("_h", _key(seed, F.col("_copy"))).drop("_n", "_copy"))
        )
    return plain.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "_h"), F.lit(buckets)).cast("int"))


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniformly random order of n records: each place, from the last, swaps with one at or before it."""
    return np.random.default_rng([seed & 0xFFFFFFFF, bucket]).permutation(n)


def shuffled(docs: DataFrame, seed: int, buckets: int) -> DataFrame:
    """docs with ``_bucket`` and ``_place``: the buckets, each in its random order.

    Rows come sorted by bucket and hash, so the order depends on the records and the seed
    alone; a task holds one bucket.
    """
    rows = scattered(docs, seed, buckets)
    schema = rows.withColumn("_place", F.lit(0).cast("long")).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def whole() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            table = table.take(pa.array(fisher_yates(len(table), seed, now)))
            table = table.append_column("_place", pa.array(np.arange(len(table))))
            yield from table.combine_chunks().to_batches(max_chunksize=256)

        for b in batches:
            at = 0
            ids = b.column("_bucket").to_numpy()
            cuts = [*(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else []
            for cut in cuts:
                if held and ids[at] != now:
                    yield from whole()
                    held = []
                now = int(ids[at])
                held.append(b.slice(at, cut - at))
                at = cut
        if held:
            yield from whole()

    return (
        rows.repartitionById(max(1, buckets), "_bucket")
        .sortWithinPartitions("_bucket", "_h", *[c for c in ("doc_id", "text") if c in docs.columns])
        .mapInArrow(each, schema)
    )


def bucket_count(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    return max(1, ceil(size / BUCKET_BYTES))


def write(docs: DataFrame, path: str, seed: int = 11) -> str:
    """Write the shuffled buckets under ``path`` (shared storage) and their manifest.

    Columns named ``_bucket``, ``_place``, ``_h`` of docs would clash: records travel as one
    struct, so docs' own names don't matter.
    """
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(1).alias("_")]).alias("_rest"))
    found = shuffled(packed, seed, bucket_count(docs))
    found.drop("_h").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/records")
    spark = docs.sparkSession
    counts = _records(spark, path, packed).groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("_bucket")  # one row per bucket, not per record
    counts.withColumn("begin", F.sum("rows").over(before) - F.col("rows")).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return path


def _records(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    schema = like.withColumn("_place", F.lit(0).cast("long")).withColumn("_bucket", F.lit(0)).schema
    return spark.read.schema(schema).parquet(f"{path}/records")


def read(spark: SparkSession, path: str, like: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The written records: shard, slot, then the columns of ``like`` (the docs written).

    A record's position is its bucket's begin plus its place; shard s takes positions from
    ceil(s * n / shards) on. An empty corpus has no records.
    """
    rest = [c for c in like.columns if c not in ("doc_id", "text")]
    packed = like.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(1).alias("_")]).alias("_rest"))
    manifest = spark.read.schema("_bucket int, rows long, begin long").parquet(f"{path}/manifest")
    total = manifest.agg(F.sum("rows")).first()[0] or 0
    position = F.col("begin") + F.col("_place")
    exact = F.expr(f"(begin + _place) * {shards} div {max(total, 1)}").cast("int")
    first = F.expr(f"(cast(_shard as bigint) * {total} + {shards - 1}) div {shards}")
    return (
        _records(spark, path, packed)
        .join(manifest.select("_bucket", "begin"), "_bucket")
        .withColumn("_shard", exact)
        .withColumn("_slot", position - first)
        .select(
            F.col("_shard").alias("shard"), F.col("_slot").cast("long").alias("slot"), "doc_id", "text",
            *[F.col(f"_rest.`{c}`").alias(c) for c in rest if c not in ("shard", "slot")],
        )
    )


def sharded(docs: DataFrame, seed: int = 11, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, read back from the files.

    The law is ``rows``: shards' counts are at most one apart. Null texts have size 1 and the
    checksum of no bytes. Repeated rows are records of their own.
    """
    like = docs.select("doc_id", "text")
    path = write(like, f"{shared_dir(docs.sparkSession)}/shards-{uuid4().hex}", seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    return read(docs.sparkSession, path, like, shards).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
