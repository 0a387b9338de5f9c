"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is one stream of words: its documents in a seeded random order, repeated as
often as its target asks. The streams are cut into blocks of equal numbers of words. Golden
ratio points, one per slot of the mix, fall into the cumulative weights of the sources and so
name the source whose next block the slot takes: a source's blocks are spread evenly over the
whole mix. Positions in a stream and ranks of slots are two-level prefix sums (sums of small
ranges, then within a range), so no source, however hot, is ordered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rillmart.llm.common import materialize, word_count

#: words of a block
BLOCK_WORDS = 1024
#: no source gives more than this many times its words
MAX_REPEATS = 3
#: sources the mix may have; their totals are the only thing the driver sees
MAX_SOURCES = 1000
#: hex digits of the order key that name a range of a stream: 4,096 ranges, and more where
#: ranges would otherwise hold more than RANGE_DOCS documents on average
RANGE_DIGITS, RANGE_DOCS = 3, 100_000
#: slots ranked together
SLOT_RANGE = 4096
#: the golden ratio as an odd step modulo 2**31
STEP, MODULUS = 1_327_217_885, 2**31


@dataclass(frozen=True)
class Share:
    """A source's part of the mix."""

    source: str | None
    size: int
    weight: float
    target: float

    @property
    def words(self) -> int:
        return int(self.target)


def water_fill(sizes: list[int], weights: list[float], budget: int, cap: int = MAX_REPEATS) -> list[float]:
    """Targets by weight, none above cap times its size; what is cut off is shared again."""
    out = [0.0] * len(sizes)
    free, left = list(range(len(sizes))), float(budget)
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def shares(sized: DataFrame, weights: list[float] = [1.0, 2.0, 3.0], cap: int = MAX_REPEATS) -> list[Share]:
    """Sources by code point, null last, with weights dealt out in turn."""
    totals = (
        sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    )
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in totals]
    dealt = [weights[i % len(weights)] for i in range(len(totals))]
    found = water_fill(sizes, dealt, sum(sizes), cap)
    return [Share(r["source"], r["size"], w, t) for r, w, t in zip(totals, dealt, found)]


def sized(docs: DataFrame, seed: int, payload: Column | None = None) -> DataFrame:
    """doc_id, source, size and the order key of every document.

    The key is drawn from id and text, so rows that share an id are spread over the stream.
    """
    text = F.col("text")
    digest = F.md5(F.coalesce(text, F.lit("")))
    extra = [payload.alias("payload")] if payload is not None else []
    return docs.select(
        "doc_id", "source", word_count(text).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)).alias("h"),
        digest.alias("text_md5"), *extra,
    )


def range_digits(docs: int) -> int:
    """Digits that name the ranges of streams of so many documents.

    Ranges are runs of the order key, so their number changes no document's place.
    """
    digits = RANGE_DIGITS
    while docs > RANGE_DOCS * 16**digits:
        digits += 1
    return digits


def ranged(rows: DataFrame, digits: int) -> DataFrame:
    return rows.withColumn("range", F.substring("h", 1, digits))


def _share_table(spark: SparkSession, of: list[Share]) -> DataFrame:
    rows = [(i, s.source, s.size, s.target, s.words) for i, s in enumerate(of)]
    return F.broadcast(
        spark.createDataFrame(
            rows, "src int, source string, source_size long, target double, words long"
        )
    )


def _ordered(rows: DataFrame):
    """Window of one range of one stream."""
    return Window.partitionBy("src", "range").orderBy("h", "doc_id", "size", "text_md5")


def placed(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Each document with its row number in its range and its first word in its stream."""
    within = _ordered(rows)
    return (
        rows.withColumn("row", F.row_number().over(within))
        .withColumn("before", F.sum("size").over(within) - F.col("size"))
        .join(starts, ["src", "range"])
        .withColumn("offset", F.col("start") + F.col("before"))
        .drop("before", "start")
    )


def range_starts(rows: DataFrame) -> DataFrame:
    """Where each range begins in its stream: one row per range and source."""
    sums = rows.groupBy("src", "range").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("src").orderBy("range")
    return sums.select("src", "range", (F.sum("n").over(before) - F.col("n")).alias("start"))


def schedule(spark: SparkSession, of: list[Share], block: int = BLOCK_WORDS) -> DataFrame:
    """src, rank, slot: the slot of the mix that takes each block of each source.

    A source takes exactly as many slots as its target has blocks. Points beyond that are
    passed over; the few blocks a source's points leave out come at the end of the mix.
    """
    quota = [ceil(s.words / block) for s in of]
    slots = sum(quota)
    bounds, total = [], 0
    for q in quota:
        total += q
        bounds.append(total / max(slots, 1))
    point = F.pmod(F.pmod(F.col("slot"), F.lit(MODULUS)) * F.lit(STEP), F.lit(MODULUS)) / F.lit(float(MODULUS))
    limits = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    quotas = F.array(*[F.lit(q).cast("long") for q in quota]) if quota else F.array().cast("array<long>")
    points = (
        spark.range(slots)
        .select(F.col("id").alias("slot"))
        .withColumn("point", point)
        .select("slot", F.size(F.filter(limits, lambda b: b <= F.col("point"))).alias("src"))
        .withColumn("chunk", F.floor(F.col("slot") / SLOT_RANGE))
    )
    counts = points.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("src").orderBy("chunk")
    before = counts.select("src", "chunk", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    ranked = (
        points.join(before, ["src", "chunk"])
        .withColumn(
            "rank",
            F.col("before") + F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1,
        )
        .where(F.col("rank") < F.element_at(quotas, F.col("src") + 1))
        .select("src", "rank", "slot")
    )
    wanted = spark.createDataFrame(list(enumerate(quota)), "src int, quota long")
    rest = (
        wanted.join(counts.groupBy("src").agg(F.sum("n").alias("got")), "src", "left")
        .where(F.coalesce("got", F.lit(0)) < F.col("quota"))
        .select("src", F.explode(F.sequence(F.coalesce("got", F.lit(0)), F.col("quota") - 1)).alias("rank"))
        .select("src", "rank", (F.lit(slots) + F.col("rank") * len(quota) + F.col("src")).alias("slot"))
    )
    return ranked.unionByName(rest)


def pieces(rows: DataFrame, slots: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The blocks joined to the schedule: which words of which document each slot takes.

    ``rows`` are placed documents; one that gives no word comes out once with null ``slot``.
    Words ``first`` up to (not including) ``last`` of the document go to ``slot``, in the
    ``epoch``-th pass over its source.
    """
    times = F.when(
        (F.col("size") > 0) & (F.col("words") > F.col("offset")),
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - F.col("offset") - 1) / F.col("source_size"))),
    )
    begin = F.col("epoch") * F.col("source_size") + F.col("offset")
    spread = (
        rows.withColumn("epoch", F.explode_outer(times))
        .withColumn("begin", begin)
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("words")))
        .withColumn(
            "rank",
            F.explode_outer(
                F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))
            ),
        )
    )
    return (
        spread.join(slots, ["src", "rank"], "left")
        .withColumn("first", F.greatest(F.col("begin"), F.col("rank") * block) - F.col("begin"))
        .withColumn("last", F.least(F.col("end"), (F.col("rank") + 1) * block) - F.col("begin"))
        .drop("begin", "end")
    )


def _plan(docs: DataFrame, seed: int, weights: list[float], block: int):
    """The words each placed document gives, by (src, range, row); the shares; digits of a range."""
    spark = docs.sparkSession
    narrow = materialize(sized(docs, seed))
    digits = range_digits(narrow.count())
    narrow = ranged(narrow, digits)
    of = shares(narrow, weights)
    table = _share_table(spark, of)
    known = narrow.join(table, narrow["source"].eqNullSafe(table["source"]), "left").drop(table["source"])
    starts = range_starts(known)
    rows = placed(known, starts)
    return pieces(rows, schedule(spark, of, block), block), table, digits


def mix(
    docs: DataFrame, seed: int = 7, weights: list[float] = [1.0, 2.0, 3.0], block: int = BLOCK_WORDS
) -> DataFrame:
    """Which words of which document go to which slot of the mix: see ``pieces``.

    Sources share as many words as all documents have, by weight; no source gives more than
    three times its words. Null texts have no words, null sources are one source, the last.
    Repeated rows are documents of their own; an empty table gives no rows. Other columns of
    docs are not read.
    """
    found, _, _ = _plan(docs, seed, weights, block)
    return found


def taken(docs: DataFrame, seed: int = 7, weights: list[float] = [1.0, 2.0, 3.0], block: int = BLOCK_WORDS) -> DataFrame:
    """How much the mix takes of each document, and where: doc_id, size, source_size, target,
    taken, first_slot, last_slot (null if it takes nothing), n_slots (blocks it has words in)."""
    given = F.col("slot").isNotNull()
    return (
        mix(docs, seed, weights, block)
        .groupBy("src", "range", "row", "doc_id", "size", "source_size", "target")
        .agg(
            F.coalesce(F.sum(F.when(given, F.col("last") - F.col("first"))), F.lit(0)).alias("taken"),
            F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"),
            F.count(F.when(given, 1)).alias("n_slots"),
        )
        .select("doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot", "n_slots")
    )


def mixed_documents(docs: DataFrame, seed: int = 7, weights: list[float] = [1.0, 2.0, 3.0], block: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents with the columns of docs: one row per document and pass, in the
    order of the slots that take their first words, over partitions and within them.

    A pass that takes a whole document keeps its text; the last pass of a source may end
    within a document, whose text is then cut behind the last word taken. Documents that give
    no word are not in the mix. ``n_chars``, if it is a column, follows the text.
    """
    found, table, digits = _plan(docs, seed, weights, block)
    passes = (
        found.where("slot is not null")
        .groupBy("src", "range", "row", "epoch", "size")
        .agg(F.max("last").alias("upto"), F.min("slot").alias("at"))
    )
    names = docs.columns
    whole = ranged(sized(docs, seed, F.struct(*[F.col(f"`{c}`") for c in names])), digits)
    known = whole.join(table, whole["source"].eqNullSafe(table["source"]), "left").select(
        "src", "range", "h", "doc_id", "size", "text_md5", "payload"
    )
    rows = known.withColumn("row", F.row_number().over(_ordered(known))).select("src", "range", "row", "payload")
    chosen = rows.join(passes, ["src", "range", "row"]).select(
        "payload.*",
        F.when(
            F.col("upto") < F.col("size"), first_words(F.col("payload.text"), F.col("upto"))
        ).otherwise(F.col("payload.text")).alias("__mixed_text"),
        F.col("at").alias("__slot"), F.concat("range", F.lit(":"), F.col("row")).alias("__place"),
    ).repartitionByRange("__slot", "__place").sortWithinPartitions("__slot", "__place")
    new = {"text": F.col("__mixed_text")}
    if "n_chars" in names:
        new["n_chars"] = F.length("__mixed_text").cast(docs.schema["n_chars"].dataType)
    return chosen.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in names])


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it is."""
    # each part is a word with the white space behind it; a first part may be white space only
    parts = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    kept = F.array_join(F.slice(parts, F.lit(1), (n + lead).cast("int")), "")
    return F.regexp_replace(kept, r"[\x20\x09-\x0D]+\z", "")
