"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are documents, their components the weights of as many terms. Documents are packed in
blocks of consecutive ids; a block keeps its forward index (the vectors) and each term's
largest and smallest weight. What a block can score for a query is bounded by the sum over
terms of the query's weight times that extreme. Per query, blocks are ordered by this bound:
the first few give the score of the k-th best so far, and of the others only those are scored
whose bound does not fall below it, so the result is exact.

Queries are packed in blocks as well: all work is on pairs of a query block and a document
block, as matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rillmart.llm.common import materialize

K = 5
SCALE = 256
QUERY_STEP = 50
BLOCK, QUERY_BLOCK = 2048, 512
#: document blocks that each query scores for its first threshold
FIRST_BLOCKS = 2
#: document blocks whose extremes travel together
SUMMARY = 512
_LIMIT = 2**62
_LOW = np.iinfo(np.int64).min


def quantized(vectors: list) -> np.ndarray:
    """floor(256 * x) of each component; shorter vectors end in zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        scaled = np.floor(SCALE * np.asarray(v, float))
        out[i, : len(v)] = np.clip(scaled, -float(_LIMIT), float(_LIMIT)).astype(np.int64)
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a with all rows of b, saturated to 64 bits."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if top < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, _LOW, -(_LOW + 1)).astype(np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The most each document block can score for each query."""
    return np.maximum(
        product(np.maximum(queries, 0), high), _LOW // 2
    ) + np.maximum(product(np.minimum(queries, 0), low), _LOW // 2)


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(-1, width) if width else np.zeros((0, 0), np.int64)


_PACKED = "block long, ids binary, width int, vectors binary, low array<long>, high array<long>"


def _packer(size: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, n = TaskContext.get().partitionId() << 32, 0
        ids: list[int] = []
        vectors: list = []

        def whole() -> pa.RecordBatch:
            m = quantized(vectors)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([base + n], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                    pa.array([m.shape[1]], pa.int32()), pa.array([m.tobytes()], pa.binary()),
                    # against a query with more terms than the block, the block's weights are 0
                    pa.array([m.min(axis=0).tolist()], pa.list_(pa.int64())),
                    pa.array([m.max(axis=0).tolist()], pa.list_(pa.int64())),
                ],
                [p.split()[0] for p in _PACKED.split(", ")],
            )

        for b in batches:
            for i, v in zip(b.column("vec_id").to_pylist(), b.column("embedding").to_pylist()):
                ids.append(i)
                vectors.append(v)
                if len(ids) == size:
                    yield whole()
                    n, ids, vectors = n + 1, [], []
        if ids:
            yield whole()

    return each


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, embedding) as blocks of up to ``size`` consecutive ids."""
    order = ["vec_id", F.xxhash64(F.col("embedding").cast("string"))]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions("vec_id")
    return dealt.mapInArrow(_packer(size), _PACKED)


def _pairs(first: bool, k: int, blocks_first: int):
    """From query blocks joined to summaries of document blocks: which pairs to score.

    ``first``: each query's best blocks by bound; else all whose bound reaches its threshold.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                q = _matrix(row["vectors"], row["width"])
                width = max([q.shape[1], *map(len, row["lows"])])
                low, high = (
                    np.array([v + [0] * (width - len(v)) for v in row[c]], np.int64).reshape(-1, width)
                    for c in ("lows", "highs")
                )
                most = bounds(q, low, high)
                if first:
                    take = min(blocks_first, most.shape[1])
                    best = np.argpartition(-most.astype(float), take - 1, axis=1)[:, :take]
                    wanted = np.zeros(most.shape, bool)
                    np.put_along_axis(wanted, best, True, axis=1)
                else:
                    least = np.full(len(q), _LOW)
                    if row["kth"] is not None:
                        for at, score in zip(row["at"], row["kth"]):
                            least[at] = score
                    wanted = most >= least[:, None]
                for j in np.flatnonzero(wanted.any(axis=0)):
                    out.append((row["block"], row["members"][j], np.packbits(wanted[:, j]).tobytes()))
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], ["q_block", "block", "wanted"]
            )

    return each


def _score(k: int):
    """From pairs with both blocks' vectors: each query's k best in the block, above its threshold."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], [], [], []]
            for row in b.to_pylist():
                q, d = _matrix(row["q_vectors"], row["q_width"]), _matrix(row["vectors"], row["width"])
                q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                wanted = np.flatnonzero(np.unpackbits(np.frombuffer(row["wanted"], np.uint8), count=len(q_ids)))
                scores = product(q[wanted], d)
                for at, s in zip(wanted.tolist(), scores):
                    other = ids != q_ids[at]
                    s, own = s[other], ids[other]
                    if len(s) > k:  # all that reach the k-th score, then ties by id
                        near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                        s, own = s[near], own[near]
                    order = np.lexsort((own, -s))[:k]
                    for c, v in zip(out, ([row["q_block"]] * len(order), [at] * len(order), [int(q_ids[at])] * len(order), own[order].tolist(), s[order].tolist())):
                        c += v
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["q_block", "at", "query_id", "vec_id", "score"],
            )

    return each


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_block", "at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best vectors, ties to the smaller vec_id.

    ``vectors`` and ``queries`` have vec_id and embedding. Vectors that are null, or hold null
    or non-finite components, and rows without vec_id take no part. Rows with the query's id
    are its own and no candidates; of queries with one id, one is answered. Repeated vectors
    are candidates of their own; scores beyond 64 bits saturate. Other columns are not read.
    """

    def sound(df: DataFrame) -> DataFrame:
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
        ).where("vec_id is not null and embedding is not null").where(finite)

    docs = materialize(packed(sound(vectors), BLOCK))
    asked = sound(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = materialize(packed(asked, QUERY_BLOCK))
    summaries = materialize(
        docs.select("block", "low", "high", F.xxhash64("block").alias("h"))
        .withColumn("group", F.pmod("h", F.lit(max(1, -(-docs.count() // SUMMARY)))))
        .groupBy("group")
        .agg(F.sort_array(F.collect_list(F.struct("block", "low", "high"))).alias("s"))
        .select("group", F.col("s.block").alias("members"), F.col("s.low").alias("lows"), F.col("s.high").alias("highs"))
    )
    groups = summaries.agg(F.max("group")).first()[0]
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups if groups is not None else -1).cast("long"), F.lit(1).cast("long"))) if groups is not None else F.explode(F.array().cast("array<long>"))
    wide = asked.select("block", "width", "vectors", spread.alias("group"))
    pair_schema = "q_block long, block long, wanted binary"

    def scored(pairs: DataFrame) -> DataFrame:
        q = asked.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("width").alias("q_width"), F.col("vectors").alias("q_vectors"))
        both = pairs.join(docs.select("block", "ids", "width", "vectors"), "block").join(q, "q_block")
        columns = ["q_block", "q_ids", "q_width", "q_vectors", "ids", "width", "vectors", "wanted"]
        return both.select(*columns).mapInArrow(_score(k), "q_block long, at int, query_id long, vec_id long, score long")

    meet = wide.join(summaries, "group")
    seed = scored(meet.mapInArrow(_pairs(True, k, FIRST_BLOCKS), pair_schema))
    kth = (
        _best(seed, k).where(F.col("rank") == k).groupBy("q_block")
        .agg(F.collect_list("at").alias("at"), F.collect_list("score").alias("kth"))
        .withColumnRenamed("q_block", "block")
    )
    left = meet.join(kth, "block", "left").mapInArrow(_pairs(False, k, FIRST_BLOCKS), pair_schema)
    return _best(scored(left), k).select("query_id", "rank", "vec_id", "score")
