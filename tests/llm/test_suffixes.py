"""Suffix-array dedup against sets of strings."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rillmart.llm import suffixes
from rillmart.sources.tables import table


def brute(rows):
    """rows: (doc_id, text); for each document (distinct row) its result."""
    seen, out = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(data[i:i + 100])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int(np.count_nonzero(np.diff(np.append(0, gone.astype(np.int8))) == 1))
        out[doc, text] = (doc, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return sorted((out[r] for r in rows), key=repr)


def found(docs):
    return sorted((tuple(r) for r in suffixes.deduplicated(docs.select("doc_id", "text")).collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b)))
def test_longest_previous_factors(data):
    n = len(data)
    order = sorted(range(n), key=lambda i: data[i:])

    def match(i, j):
        k = 0
        while max(i, j) + k < n and data[i + k] == data[j + k]:
            k += 1
        return k

    lcp = [0] + [match(a, b) for a, b in zip(order, order[1:])]
    got = suffixes.previous_factors(np.array(order, np.int64), np.array(lcp, np.int64))
    assert got.tolist() == [max((match(i, j) for j in range(i)), default=0) for i in range(n)]


@pytest.mark.parametrize("width", [1, 5, 69, 512])
def test_minima_are_the_leftmost_least(monkeypatch, width):
    rng = np.random.default_rng(width)
    hashes = (rng.integers(0, 40, 3000).astype(np.uint64)) << np.uint64(40)
    monkeypatch.setattr(suffixes, "_SEGMENT", 700)
    want = [i + int(np.argmin(hashes[i:i + width])) for i in range(len(hashes) - width + 1)]
    assert suffixes.minima(hashes, width).tolist() == want
    assert len(suffixes.minima(hashes[:0], width)) == 0


def test_supplied_documents(llm, sf):
    docs = table(llm, sf, "documents")
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def planted():
    rng = random.Random(8)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    line, passage = prose(15)[:90] + " ", prose(200)
    rows = [(i, prose(60) + line + prose(50)) for i in range(120)]  # a line too short to be removed by itself
    rows += [(200 + i, prose(20) + passage[i:i + 150 + 9 * i] + prose(20)) for i in range(80)]
    rows += [(300 + i, passage) for i in range(10)] + [(300, passage), (None, passage), (None, prose(30))]
    rows += [(400, "a" * 3000), (401, "word " * 700 + "a" * 250), (402, "a" * 99), (403, None), (404, ""), (402, prose(80))]
    rows += [(500, "é" * 60 + "😀" * 40), (501, "x" + "é" * 60 + "😀" * 40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_lines_passages_copies_and_runs(llm, monkeypatch, small):
    """Also with pieces of few items, short memory and anchors dealt out as frequent."""
    if small:
        for name, value in (("PIECE", 5), ("REMEMBERED", 10), ("SAMPLE", 1), ("FREQUENT", 4), ("DEAL", 3), ("CHUNK", 64), ("_SEGMENT", 300)):
            monkeypatch.setattr(suffixes, name, value)
    rows = planted()
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if small:
        assert len(suffixes.frequent_anchors(docs.selectExpr("*", "xxhash64(doc_id, text) as row"))) > 0
    assert found(docs) == brute(rows)


def test_texts_are_exchanged_once(llm, sf):
    df = suffixes.without_repeats(table(llm, sf, "documents"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2 and "BroadcastExchange" not in plan


def test_odd_rows(llm, odd, empty):
    assert found(odd) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    out = suffixes.without_repeats(odd)
    for r in out.collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    assert suffixes.deduplicated(empty).count() == 0
