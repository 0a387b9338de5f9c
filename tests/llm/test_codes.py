"""Vector code compression against plain rounds."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rillmart.llm import codes
from rillmart.sources.tables import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """rows of (vec_id, vector, label), all kept, as the rows of the query."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, np.floor(1024 * np.array(r[1])).tolist()))
    x = np.floor(1024 * np.array([r[1] for r in rows])).astype(np.int64)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % parts)))
    cuts = np.split(x, parts, axis=1)
    books = [c[:entries].copy() for c in cuts]

    def nearest(p):
        d = np.array([((books[p] - v) ** 2).sum(axis=1) for v in cuts[p]])
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            at = nearest(p)[0]
            for e in set(at.tolist()):
                books[p][e] = cuts[p][at == e].sum(axis=0) // int((at == e).sum())
    final = [nearest(p) for p in range(parts)]
    error = sum(f[1] for f in final)
    labels = Counter()
    for r, e in zip(rows, error.tolist()):
        labels[r[2]] += e
    text = ",".join(str(v) for b in books for v in b.ravel().tolist())
    return sorted(
        (
            (r[0], "".join(f"{f[0][i]:02x}" for f in final), int(error[i]), labels[r[2]], hashlib.sha256(text.encode()).hexdigest())
            for i, r in enumerate(rows)
        ),
        key=repr,
    )


def found(df):
    return sorted((tuple(r) for r in codes.compressed(df).collect()), key=repr)


def test_the_curve_visits_every_cell_by_single_steps():
    for axes, bits in ((2, 4), (3, 3), (4, 2), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        place = codes.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_no_shortlist_loses_the_nearest_entry():
    rng = np.random.default_rng(2)
    pruned = 0
    for _ in range(300):
        entries = rng.integers(-50, 50, (30, 3))
        x = rng.integers(-50, 50, 3) + rng.integers(0, 8, (20, 3))
        near = codes.shortlist(x.min(axis=0), x.max(axis=0), entries)
        at, error = codes.nearest(x, entries)
        pruned += 30 - len(near)
        few, same = codes.nearest(x, entries[near])
        assert (near[few] == at).all() and (same == error).all()
    assert pruned > 300 * 15


def test_large_components_stay_exact():
    x, entries = np.array([[codes.RANGE, -codes.RANGE]]), np.array([[codes.RANGE - 1, -codes.RANGE], [codes.RANGE, 1 - codes.RANGE]])
    at, error = codes.nearest(x, entries)
    assert at.tolist() == [0] and error.tolist() == [1]


def clustered(n, dims, centres=9, seed=0):
    rng = random.Random(seed)
    base = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(centres)]
    return [
        (7 * i % n, [c + rng.uniform(-0.02, 0.02) for c in base[i % centres]], i % 4 or None) for i in range(n)
    ]


@pytest.mark.parametrize("block", [4, 128])
def test_clusters_copies_and_widths(llm, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    for dims in (8, 6):  # four does not divide six: filled with zeros
        rows = clustered(700, dims) + [(1000 + i, [0.25] * dims, None) for i in range(300)]
        assert found(llm.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_supplied_vectors(llm, sf):
    df = table(llm, sf, "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert found(df) == brute(rows)


def test_odd_vectors(llm):
    good = [(1, [0.5, -0.5, 0.25, 0.1], 1), (1, [0.5, -0.5, 0.25, 0.2], None), (None, [1.0, 2.0, 3.0, 4.0], None), (3, [0.5] * 4, 1), (3, [0.5] * 4, 1)]
    nan, inf = float("nan"), float("inf")
    bad = [(5, None, 1), (6, [], 1), (7, [1.0, None, 2.0, 3.0], 1), (8, [nan] * 4, 2), (9, [inf, 1.0, 1.0, 1.0], 2), (10, [-inf] * 4, 2), (0, [1.0] * 3, 1)]
    df = llm.createDataFrame(good + bad, SCHEMA).selectExpr("*", "'x' as code", "7 as _row", "1 as _x", "0 as error")
    assert found(df) == brute(good)
    assert found(df.where("vec_id > 4")) == []
    assert found(df.limit(0)) == []
    huge = llm.createDataFrame([(1, [1e300, -1e300, 0.0, 0.0], None), (2, [0.0] * 4, None)], SCHEMA)
    assert [r[2] for r in found(huge)] == [0, 0]
