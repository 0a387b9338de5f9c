"""Removing repeated byte strings by longest-previous-factor arrays.

A string of ``SPAN`` bytes is removed where it also starts earlier: in a smaller doc_id, or
earlier in its document. In a suffix array that is told by the longest previous factor: the
earlier starts with the longest match are the previous and the next smaller position in
suffix order, and a position's string is a repeat if one of them matches ``SPAN`` bytes.

Suffixes that can match are brought together first, so that arrays are built over small
pieces, apart, and texts are shuffled once:

* *Chunks.* Texts are cut where their own bytes say so. A chunk (with the bytes that its last
  strings reach into) that equals an earlier one holds repeats only; just its first copy
  goes on. Tasks drop their own later copies before the shuffle.
* *Anchors.* Each string has an anchor: of its ``GRAM``-byte grams the one with the least hash
  (the leftmost). Equal strings have equal anchors at equal places, so only anchors whose
  hash occurs elsewhere can hold repeats. What ships is a hash and a document number.
* *Pieces.* Neighbouring strings of one such anchor ship together, by anchor, in the order of
  documents. Over some thousand of them a task sorts the suffixes and builds the array.
* *Open strings.* An anchor with more strings than a piece is cut into several, and frequent
  anchors are dealt to many tasks to begin with. What such a piece finds first may not be the
  first, so each of these strings goes on by its digest, and the earliest stays.

Hashes only choose what meets. Repeats are decided by comparing bytes, or, for whole chunks
and open strings, 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rillmart.llm.common import materialize

SPAN = 100
GRAM = 32
#: grams among which the least hash ends a chunk; chunks are half as long on average
CHUNK = 512
#: items of a piece
PIECE = 4096
#: chunks a task remembers while it drops later copies
REMEMBERED = 100_000
#: of so many documents one is looked at for frequent anchors
SAMPLE = 64
#: an anchor is frequent from this many sampled documents, and from this share of all sampled
FREQUENT = 64
FREQUENT_SHARE = 20_000
#: tasks that a frequent anchor is dealt to
DEAL = 256

_SLOT = 18  # bits of a position within a segment
_SEGMENT = (1 << _SLOT) - 2 * CHUNK - 2 * SPAN
_NO_ID = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15


# -- anchors -----------------------------------------------------------------------


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the gram at each position; ``gram`` is a power of two.

    Polynomials of doubled length: two halves make a whole.
    """
    h = data.astype(np.uint64) + np.uint64(1)
    size, base = 1, _BASE
    while size < gram:
        h = h[:-size] * np.uint64(base) + h[size:] if len(h) > size else h[:0]
        size, base = 2 * size, base * base % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the place of its least one, the leftmost of equals."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    out = np.empty(n, np.int64)
    low = np.uint64((1 << _SLOT) - 1)
    for at in range(0, n, _SEGMENT):
        part = hashes[at:at + _SEGMENT + width - 1]
        best = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span < width:
            step = min(span, width - span)
            best = np.minimum(best[:-step], best[step:])
            span += step
        out[at:at + _SEGMENT] = (best & low).astype(np.int64) + at
    return out


def chunk_starts(hashes: np.ndarray) -> np.ndarray:
    """0 and the places where chunks end, told by the bytes around them."""
    ends = minima(hashes, CHUNK)
    if len(ends) == 0:
        return np.zeros(1, np.int64)
    ends = ends[np.append(True, ends[1:] != ends[:-1])]
    return np.append(0, ends[ends > 0])


class Strings:
    """The strings of one text as runs: neighbours with one anchor, all alive or all dead."""

    def __init__(self, data: bytes, dead: list | None = None) -> None:
        hashes = gram_hashes(np.frombuffer(data, np.uint8))
        owner = minima(hashes, SPAN - GRAM + 1)
        live = np.ones(len(owner), bool)
        for a, b in dead or ():
            live[a:b] = False
        new = np.append(True, (owner[1:] != owner[:-1]) | (live[1:] != live[:-1])) if len(owner) else live
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(owner))[: len(self.first)]
        self.owner = owner[self.first]
        self.hash = hashes[self.owner].view(np.int64)
        self.live = live[self.first]

    def live_anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchors of live strings, and those of two anchors or more."""
        at = np.unique(self.owner[self.live], return_index=True)[1]
        found, n = np.unique(self.hash[self.live][at], return_counts=True)
        return found, found[n > 1]


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if len(ordered) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _columns(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _signed(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _texts(batch: pa.RecordBatch):
    """(doc, row, bytes) of each row long enough to hold a string, with its place in the batch."""
    for i, (doc, row, text) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("doc_id", "row", "text")))):
        data = (text or "").encode()
        if len(data) >= SPAN:
            yield i, _NO_ID if doc is None else doc, row, data


# -- chunks ------------------------------------------------------------------------

_SPOTS = ["k1", "k2", "doc", "row", "start", "stop", "dead"]
_SPOT_SCHEMA = "k1 long, k2 long, doc long, row long, start long, stop long, dead boolean"
_SPOT_TYPES = [*[pa.int64()] * 6, pa.bool_()]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks by digest; a later copy of one that the task has met is dead at once."""
    first: dict[bytes, tuple] = {}

    def dead(spot: tuple) -> tuple:
        doc, row, a, b = spot
        return (row, a, doc, row, a, b, True)

    def candidates() -> list[tuple]:
        return [(*_signed(k), *spot, False) for k, spot in first.items()]

    for batch in batches:
        out = []
        for _, doc, row, data in _texts(batch):
            starts = chunk_starts(gram_hashes(np.frombuffer(data, np.uint8))).tolist()
            last = len(data) - SPAN + 1
            run = None
            for a, b in zip(starts, [*starts[1:], last]):
                b = min(b, last)
                if a >= b:
                    continue
                key = xxhash.xxh3_128_digest(data[a:b + SPAN - 1])
                spot = (doc, row, a, b)
                held = first.setdefault(key, spot)
                if held == spot:  # new, or the same place in an equal row
                    continue
                if spot < held:
                    first[key] = spot
                    out.append(dead(held))
                elif run and run[3] == a:
                    run = (*run[:3], b)
                else:
                    if run:
                        out.append(dead(run))
                    run = spot
            if run:
                out.append(dead(run))
        if len(first) > REMEMBERED:
            out += candidates()
            first.clear()
        yield _columns(out, _SPOTS, _SPOT_TYPES)
    yield _columns(candidates(), _SPOTS, _SPOT_TYPES)


def later(spots: DataFrame) -> DataFrame:
    """Of spots with one key all but the earliest, and the dead ones; a key has one spot a
    task or piece, so no window grows with the copies."""
    spot = F.struct("doc", "row", "start")
    marked = spots.withColumn("_first", F.min(spot).over(Window.partitionBy("k1", "k2")))
    return marked.where(F.col("dead") | (spot > F.col("_first"))).select("doc", "row", "start", "stop")


def by_text(spots: DataFrame, name: str) -> DataFrame:
    """One row a text with its spots."""
    return spots.groupBy("row").agg(F.collect_list(F.struct("doc", "start", "stop")).alias(name))


def _own(spots: list | None, doc: int) -> list[tuple[int, int]]:
    return [(s["start"], s["stop"]) for s in spots or () if s["doc"] == doc]


# -- anchors that occur elsewhere --------------------------------------------------


def _row_batch(hashes: list[np.ndarray], rows: list[np.ndarray]) -> pa.RecordBatch:
    h = np.concatenate(hashes) if hashes else np.empty(0, np.int64)
    r = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(h), pa.array(r)], ["h", "row"])


def _anchors(frequent: np.ndarray):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, rows = [], []
            dead = batch.column("dead").to_pylist()
            for i, doc, row, data in _texts(batch):
                found = Strings(data, _own(dead[i], doc)).live_anchors()[0]
                found = found[~_member(found, frequent)]
                hashes.append(found)
                rows.append(np.full(len(found), row, np.int64))
            yield _row_batch(hashes, rows)

    return each


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by h those that share theirs; holds one row besides a batch."""
    held, out_already = None, False
    for batch in batches:
        h, row = (batch.column(n).to_numpy() for n in ("h", "row"))
        if len(h) == 0:
            continue
        if held is not None:
            h, row = np.append(held[0], h), np.append(held[1], row)
        same = h[1:] == h[:-1]
        keep = np.append(False, same)
        keep[:-1] |= same
        if out_already:
            keep[0] = False
        held, out_already = (h[-1], row[-1]), bool(keep[-1])
        yield _row_batch([h[keep]], [row[keep]])


def frequent_anchors(texts: DataFrame) -> np.ndarray:
    """Anchors of many texts, in order, from a sample of documents: at most FREQUENT_SHARE.

    They are only dealt out otherwise; what is found stays the same.
    """
    sample = texts.where(F.pmod("row", F.lit(SAMPLE)) == 0).withColumn("dead", F.lit(None))
    counts = sample.mapInArrow(_anchors(np.empty(0, np.int64)), "h long, row long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") >= max(FREQUENT, total // FREQUENT_SHARE + 1)).select("h").collect()
    return np.sort(np.array([r["h"] for r in found], np.int64))


# -- items -------------------------------------------------------------------------

_ITEMS = ["h", "part", "doc", "row", "start", "stop", "data"]
_ITEM_SCHEMA = "h long, part int, doc long, row long, start long, stop long, data binary"
_ITEM_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]


def _items(frequent: np.ndarray):
    """Runs of live strings whose anchor occurs elsewhere, with their bytes; and, without bytes
    and spread by text, what is known to be repeats."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            dead, shared = (batch.column(n).to_pylist() for n in ("dead", "hs"))
            for i, doc, row, data in _texts(batch):
                gone = _own(dead[i], doc)
                out += [(row, -1, doc, row, a, b, None) for a, b in gone]
                s = Strings(data, gone)
                _, twice = s.live_anchors()
                known = np.sort(np.array(shared[i] or (), np.int64))
                often = _member(s.hash, frequent)
                wanted = np.flatnonzero(s.live & (often | _member(s.hash, known) | _member(s.hash, twice)))
                here = set(twice.tolist())
                met = set()
                for k in wanted.tolist():
                    h, a, b = int(s.hash[k]), int(s.first[k]), int(s.last[k])
                    run = data[a:b + SPAN - 1]
                    if h in here:
                        if (h, run) in met:
                            out.append((row, -1, doc, row, a, b, None))
                            continue
                        met.add((h, run))
                    out.append((h, 1 + row % DEAL if often[k] else 0, doc, row, a, b, run))
            yield _columns(out, _ITEMS, _ITEM_TYPES)

    return each


def previous_factors(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factors: for each position the longest match with a smaller one.

    ``order`` lists positions in suffix order and ``lcp[i]`` is the match of order[i] with
    order[i - 1]. The previous smaller position of each is found by following those of larger
    neighbours, all at once, with the least match on the way; the next smaller one likewise
    from behind.
    """

    def smaller_before(place: np.ndarray, match: np.ndarray) -> np.ndarray:
        n = len(place)
        low = np.concatenate(([-1], place))  # a sentinel below all
        to = np.arange(n + 1) - 1
        least = np.concatenate(([0], match))
        least[1] = 0
        open_ = np.arange(1, n + 1)
        while True:
            open_ = open_[low[to[open_]] > low[open_]]
            if not len(open_):
                return least[1:]
            via = to[open_]
            least[open_] = np.minimum(least[open_], least[via])
            to[open_] = to[via]

    if len(order) == 0:
        return np.empty(0, np.int64)
    before = smaller_before(order, lcp)
    back = np.append(0, lcp[1:][::-1])
    after = smaller_before(order[::-1], back)[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out


def repeats(runs: list[bytes]) -> np.ndarray:
    """For each string of these runs, in order, whether it also starts earlier in them.

    The suffixes at the strings' starts are sorted by their first ``SPAN`` bytes, ties by
    position, and get their longest previous factors, cut at SPAN.
    """
    text = np.frombuffer(b"".join(runs), np.uint8)
    sizes = np.array([len(r) for r in runs], np.int64)
    counts = sizes - SPAN + 1
    begins = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(counts) - counts), counts)
    starts = begins + np.arange(len(begins))
    strings = np.lib.stride_tricks.sliding_window_view(text, SPAN)[starts]
    order = np.argsort(strings.view(f"S{SPAN}").ravel(), kind="stable")
    ordered = strings[order]
    differ = ordered[1:] != ordered[:-1]
    lcp = np.append(0, np.where(differ.any(axis=1), differ.argmax(axis=1), SPAN))
    return previous_factors(order, lcp) >= SPAN


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spots of repeats, and of strings that are first in a piece but maybe not in all.

    Items come sorted by anchor, part and document; a piece ends between anchors if it can, and
    holds no two parts of one anchor, whose documents are not in order.
    """
    held: list[tuple] = []
    cut: set[tuple] = set()

    def flush() -> list[tuple]:
        out = []
        bad = repeats([r[6] for r in held]) if held else ()
        at = 0
        for h, part, doc, row, a, b, data in held:
            n = b - a
            mine = bad[at:at + n]
            at += n
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mine.astype(np.int8), [0]))))
            out += [(row, a + int(x), doc, row, a + int(x), a + int(y), True) for x, y in edges.reshape(-1, 2)]
            if part > 0 or (h, part) in cut:
                for x in np.flatnonzero(~mine).tolist():
                    out.append((*_signed(xxhash.xxh3_128_digest(data[x:x + SPAN])), doc, row, a + x, a + x + 1, False))
        held.clear()
        return out

    for batch in batches:
        out = []
        for item in zip(*(batch.column(n).to_pylist() for n in _ITEMS)):
            h, part, doc, row, a, b, data = item
            if data is None:
                out.append((row, a, doc, row, a, b, True))
                continue
            if held and held[-1][:5] == item[:5]:
                continue  # the same strings of an equal row
            last = held[-1][:2] if held else None
            if len(held) >= PIECE or last and last[0] == h and last[1] != part:
                goes_on = {last} if last == (h, part) else set()
                cut |= goes_on
                out += flush()
                cut = goes_on
            held.append(item)
        yield _columns(out, _SPOTS, _SPOT_TYPES)
    yield _columns(flush(), _SPOTS, _SPOT_TYPES)


# -- what stays --------------------------------------------------------------------


def kept_bytes(data: bytes, spots: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The bytes outside all strings that start in these spots, how many go, and in how many runs."""
    if not spots:
        return data, 0, 0
    change = np.zeros(len(data) + 1, np.int32)
    a, b = np.array(spots, np.int64).T
    np.add.at(change, a, 1)
    np.add.at(change, b + SPAN - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    rises = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(np.count_nonzero(gone)), rises


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, spots in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "spots"))):
            data = (text or "").encode()
            kept, n, runs = kept_bytes(data, _own(spots, _NO_ID if doc is None else doc))
            out.append((doc, len(data), n, runs, hashlib.sha256(kept).hexdigest(), kept))
        yield _columns(
            out, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            [*[pa.int64()] * 4, pa.string(), pa.binary()],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the remaining bytes ``kept`` of every row.

    Null and empty texts have no bytes; texts shorter than ``SPAN`` lose none. Documents come
    in the order of doc_id, a null one last; rows of one doc_id with different texts in an
    order of their own; rows equal in doc_id and text are one document and share its result.
    An empty table gives no rows. Columns other than doc_id and text are not read.

    Texts are exchanged once, by document, and read from there by all three steps.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.withColumn("row", F.xxhash64("doc_id", "text"))
    frequent = frequent_anchors(texts)

    def with_side(df: DataFrame, side: DataFrame) -> DataFrame:
        return df.join(side.hint("shuffle_hash"), "row", "left")

    dead = by_text(later(texts.mapInArrow(_chunks, _SPOT_SCHEMA)), "dead")
    living = with_side(texts, dead)
    anchors = living.mapInArrow(_anchors(frequent), "h long, row long")
    shared = anchors.repartition("h").sortWithinPartitions("h").mapInArrow(_repeated, "h long, row long")
    shared = shared.groupBy("row").agg(F.collect_list("h").alias("hs"))
    items = with_side(living, shared).mapInArrow(_items(frequent), _ITEM_SCHEMA)
    order = ["h", "part", "doc", "row", "start"]
    pieces = items.repartition("h", "part").sortWithinPartitions(*order).mapInArrow(_pieces, _SPOT_SCHEMA)
    spots = by_text(later(pieces), "spots")
    return with_side(texts, spots).mapInArrow(_results, _RESULT)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``without_repeats`` without the bytes themselves."""
    return without_repeats(docs).drop("kept")
