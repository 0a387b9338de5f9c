"""Importance resampling against a plain reckoning."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from rillmart.llm import resample
from rillmart.sources.tables import table


def features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(docs, target):
    """docs of (doc_id, text); rows (doc_id, n_features, weight, score, rank)."""
    parts = [features(t) for _, t in docs]
    s, t = Counter(), Counter()
    for _, f in parts:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (s_all + 10_000) / ((s[k] + 1) * (t_all + 10_000)))) for k in range(10_000)]
    rows = []
    for (doc, _), (n, f) in zip(docs, parts):
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in f)
        rows.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(fit[: 5 * len(fit) // 100])]
    rest = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return sorted(drawn + [(*r, None) for r in rest.elements()], key=repr)


def found(docs, target):
    return sorted((tuple(r) for r in resample.resampled(docs, target).collect()), key=repr)


@pytest.mark.parametrize("parts", [2, 1024])
def test_supplied_documents(llm, sf, monkeypatch, parts):
    monkeypatch.setattr(resample, "PARTS", parts)
    docs, target = table(llm, sf, "documents"), table(llm, sf, "benchmark")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert found(docs, target) == want


def test_ties_copies_and_nulls(llm):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    same = prose(40)
    rows = [(i, prose(rng.randrange(10, 60))) for i in range(150)]
    rows += [(None, same)] * 60 + [(7, same)] * 60 + [(3, prose(25)), (3, None), (4, ""), (2**63 - 1, prose(30)), (-(2**63), prose(30))]
    rng.shuffle(rows)
    docs = llm.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, score int, rank string").repartition(4)
    target = llm.createDataFrame([(1, same), (2, None)], "item_id long, text string")
    assert found(docs, target) == brute(rows, [same, None])


def test_least_finds_any_number(llm):
    rng = random.Random(1)
    values = [rng.choice([-(2**63), 2**63 - 1, 0, 5, 5, 5, rng.getrandbits(62)]) for _ in range(60)]
    rows = llm.createDataFrame([(v,) for v in values], "v long")
    for wanted in (1, 17, 40, 60):
        c = sorted(values)[wanted - 1]
        assert resample.least(rows, "v", wanted) == (c, sum(v < c for v in values), values.count(c))


def test_ranks_run_through_all_partitions(llm):
    rows = llm.range(1000).selectExpr("id * 7919 % 1000 as a", "id as b").repartition(7)
    got = sorted(map(tuple, resample.ranked(rows, ["a", "b"]).collect()))
    assert [r[2] for r in got] == list(range(1, 1001))


def test_odd_rows(llm, odd, empty):
    target = llm.createDataFrame([(1, "word w1 w2 mail")], "item_id long, text string")
    assert found(odd, target) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], ["word w1 w2 mail"])
    assert found(odd, target.limit(0)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], [])
    assert found(empty, target) == []
