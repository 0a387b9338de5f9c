"""Near duplicates by SimHash, linked by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits meet: some bit string lies within r/2 of
both. So every distinct fingerprint emits all variants within half the radius, variants are
shuffled, and fingerprints that collide are verified and linked.

The ball of radius 2 around a 64-bit fingerprint has 2,081 variants. The operator takes
smaller balls that lose no link: the bits are cut in thirds, and of 4 differing bits at most 2
lie in the better two thirds, so for each third left out the ball has radius 1 around the
other two: 131 variants in all. Collisions there are candidates, verified over all 64 bits.
Where more than ``BUCKET`` fingerprints collide in one variant, those fingerprints also emit
the full ball, in which a collision proves a link, so each variant links its fingerprints to
the first of them and no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.llm.common import materialize

SHINGLE = 4
RADIUS = 4
SEED = 42
THIRDS = ((0, 22), (22, 43), (43, 64))
#: fingerprints of one variant that are compared with each other; more go to the full ball
BUCKET = 128


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a text; 0 for one without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    n = max(1, len(words) - shingle + 1)
    ends = starts[min(shingle, len(words)):] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[:n].tolist())], dtype=">u8"
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = hashes[at:at + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, name: str = "fp") -> DataFrame:
    """docs with the fingerprint of ``text`` as a signed long; map side only."""
    schema = docs.withColumn(name, F.lit(0).cast("long")).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, _signed(found)], [*b.schema.names, name])

    return docs.mapInArrow(each, schema)


# -- links -------------------------------------------------------------------------


@contextmanager
def _large_batches(spark: SparkSession):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _masked(bits: range) -> int:
    return sum(1 << b for b in bits)


def third_flips() -> list[tuple[int, int, int]]:
    """(third left out, mask of the others, flip): all variants within 1 of the kept bits."""
    out = []
    for third, (lo, hi) in enumerate(THIRDS):
        kept = [b for b in range(64) if not lo <= b < hi]
        mask = sum(1 << b for b in kept)
        out += [(third, mask, flip) for flip in [0, *(1 << b for b in kept)]]
    return out


def ball_flips(radius: int = RADIUS // 2) -> list[int]:
    """All variants within the radius (0, 1 or 2) of a fingerprint."""
    one = [1 << b for b in range(64)] if radius else []
    two = [x | y for i, x in enumerate(one) for y in one[:i]] if radius > 1 else []
    return [0, *one, *two]


def _long(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def _literal(v: int) -> str:
    return f"(-{abs(_long(v) + 1)}L - 1L)" if v >> 63 else f"{v}L"


def third_variants(fps: DataFrame) -> DataFrame:
    items = ",".join(f"struct({t}, {_literal(m)}, {_literal(x)})" for t, m, x in third_flips())
    return (
        fps.select("fp", F.explode(F.expr(f"array({items})")).alias("v"))
        .select(F.col("v.col1").alias("third"), F.col("fp").bitwiseAND(F.col("v.col2")).bitwiseXOR(F.col("v.col3")).alias("key"), "fp")
    )


def ball_variants(fps: DataFrame) -> DataFrame:
    items = ",".join(_literal(x) for x in ball_flips())
    return fps.select("fp", F.explode(F.expr(f"array({items})")).alias("flip")).select(
        F.lit(3).alias("third"), F.col("fp").bitwiseXOR(F.col("flip")).alias("key"), "fp"
    )


def linked(fps: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the graph of these fingerprints that differ in few enough bits."""
    a = np.array(fps, dtype=np.int64)
    near = np.bitwise_count((a[:, None] ^ a[None, :]).view(np.uint64)) <= radius
    seen, edges = np.zeros(len(a), bool), []
    for root in range(len(a)):
        if seen[root]:
            continue
        seen[root], stack = True, [root]
        while stack:
            i = stack.pop()
            for j in np.flatnonzero(near[i] & ~seen):
                seen[j] = True
                edges.append((fps[i], fps[j]))
                stack.append(j)
    return edges


def _runs(batches: Iterator[pa.RecordBatch], most: int):
    """Sorted rows as runs of one (third, key): ('run', fps) for a whole run of 2 to ``most``
    rows, and ('hot', fps), in pieces, for a longer one. Holds ``most`` rows and one batch."""
    t, k, f = (np.empty(0, np.int64) for _ in range(3))
    hot = None
    for b in batches:
        t, k, f = (
            np.concatenate((held, b.column(n).to_numpy().astype(np.int64)))
            for held, n in ((t, "third"), (k, "key"), (f, "fp"))
        )
        if not len(t):
            continue
        cuts = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(t))
        if hot == (t[0], k[0]):
            yield "hot", f[: ends[0]]
            starts[0] = ends[0]
        if ends[-1] - starts[-1] > most:
            hot = (t[-1], k[-1])
            yield "hot", f[starts[-1]:]
            starts[-1] = len(t)
        size = ends[:-1] - starts[:-1]
        for i in np.flatnonzero(size > 1):
            yield ("run" if size[i] <= most else "hot"), f[starts[i]:ends[i]]
        t, k, f = t[starts[-1]:], k[starts[-1]:], f[starts[-1]:]
    if len(f) > 1:
        yield "run", f


def _edges(pairs: list[tuple[int, int | None]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among colliding fingerprints; (fp, null) for those of overfull variants."""
    out = []
    for kind, fps in _runs(batches, BUCKET):
        out += linked(fps.tolist()) if kind == "run" else [(x, None) for x in fps.tolist()]
        if len(out) > 10_000:
            yield _edges(out)
            out = []
    yield _edges(out)


def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from the first fingerprint of each run to every other, with one row held."""
    last, first = None, None
    for b in batches:
        out = []
        for t, k, f in zip(*(b.column(n).to_pylist() for n in ("third", "key", "fp"))):
            if (t, k) == last:
                out.append((first, f))
            else:
                last, first = (t, k), f
        yield _edges(out)


def _meet(variants: DataFrame, links) -> DataFrame:
    dealt = variants.repartition("third", "key").sortWithinPartitions("third", "key", "fp")
    return dealt.mapInArrow(links, "a long, b long")


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what differs in at most 4 bits, for distinct fingerprints."""
    with _large_batches(fps.sparkSession):
        found = materialize(_meet(third_variants(fps), _verified).distinct())
        edges, hot = found.where("b is not null"), found.where("b is null")
        if hot.limit(1).count():
            balls = ball_variants(hot.select(F.col("a").alias("fp")).repartition("fp"))
            edges = materialize(edges.unionByName(_meet(balls, _starred)).distinct())
    return edges


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for every node with an edge.

    Alternates two steps that connect each node's larger (then smaller) neighbours to its
    smallest one, until nothing changes; hot nodes are joins that AQE can split.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lower = large.join(smallest(large), "u")
        small = lower.select("u", F.col("m").alias("v")).unionByName(
            lower.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        now = materialize(small.distinct())
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def labelled(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (doc_id, fp): these rows, and for each fp its root fp and component_id."""
    narrow = materialize(marked.select("doc_id", "fp"))
    firsts = materialize(narrow.groupBy("fp").agg(F.min("doc_id").alias("first")))
    stars = components(links(firsts.select("fp")))
    members = stars.select(F.col("node").alias("fp"), "root").unionByName(
        stars.select(F.col("root").alias("fp"), "root").distinct()
    )
    known = firsts.join(members, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = materialize(known)
    ids = known.where("root <> fp or first is null").select("root").distinct()
    ids = known.join(ids, "root").groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = known.join(ids, "root", "left").select(
        "fp", "root", F.coalesce("component_id", "first").alias("component_id")
    )
    return narrow, materialize(by_fp)


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for every document.

    A component is what 4-bit links connect; its id is its smallest doc_id, null only if all
    its ids are null. Texts without words (null, empty) share fingerprint zero. Repeated rows
    come out repeated. Other columns of docs are not read.
    """
    narrow, by_fp = labelled(with_fingerprint(docs.select("doc_id", "text")))
    return narrow.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; docs' own columns.

    The texts are fingerprinted twice rather than shuffled twice.
    """
    packed = docs.select(
        F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    )
    narrow, by_fp = labelled(with_fingerprint(docs.select("doc_id", "text")))
    # which document stays: smallest id first, one without id only if no other is there
    keep = (
        narrow.join(by_fp, "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("k"))
        .select(F.col("k.doc_id").alias("_id"), F.col("k.fp").alias("_fp"))
    )
    marked = with_fingerprint(packed)
    chosen = marked.join(
        keep, marked["doc_id"].eqNullSafe(keep["_id"]) & (marked["fp"] == keep["_fp"]), "left_semi"
    )
    return chosen.dropDuplicates(["doc_id", "fp"]).select("_row.*")
