"""Quality rules, personal data, BPE, mixing, sharding, SimHash against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rillmart.llm import bpe, mixing, pii, quality, sharding, simhash
from rillmart.sources.tables import table

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# -- quality rules -----------------------------------------------------------------


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again = [], 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.append(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside))


def test_base_counts(llm, sf):
    found = [r["text"] for r in table(llm, sf, "documents").limit(60).collect()]
    for t in [*found, None, "", " \x1c\x85 a\x0bb", "a b c a b c a", "x\nx\n\n\nx", "a\r\nb\r\n"]:
        assert quality.base_counts(t) == brute_counts(t)


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 9):
        model = quality.Field(rng.normal(size=(2, 3)), rng.normal(size=(2, 2)), rng.normal(size=2))
        scores = rng.normal(size=(n, 2))

        def value(path):
            moves = sum(model.move[a, b] for a, b in zip(path, path[1:]))
            return model.start[path[0]] + moves + sum(scores[i, y] for i, y in enumerate(path))

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert tuple(quality.viterbi(model, scores)) == best
    assert quality.viterbi(model, np.zeros((0, 2))) == []


def test_training_gradient_matches_differences():
    rng = np.random.default_rng(5)
    model = quality.Field(rng.normal(size=(2, 16)), rng.normal(size=(2, 2)), rng.normal(size=2))
    x, y = rng.integers(0, 2, (1, 4, 16)).astype(float), np.array([1])
    real = np.ones((1, 4), bool)

    def likelihood(m):
        def value(path):
            s = m.start[path[0]] + sum(m.move[a, b] for a, b in zip(path, path[1:]))
            return s + sum(x[0, i] @ m.emit[k] for i, k in enumerate(path))

        all_paths = [value(p) for p in itertools.product((0, 1), repeat=4)]
        return value((1, 1, 1, 1)) - np.logaddexp.reduce(all_paths)

    emit, move, start = quality._gradient(model, x, real, y)
    for name, grad in (("emit", emit), ("move", move), ("start", start)):
        for at in list(np.ndindex(grad.shape))[::5]:
            up = {n: getattr(model, n).copy() for n in ("emit", "move", "start")}
            up[name][at] += 1e-5
            step = (likelihood(quality.Field(**up)) - likelihood(model)) / 1e-5
            assert abs(step - grad[at]) < 1e-3


def test_held_out_documents_are_told_apart(llm):
    sf = "/root/testdata/sf0.1"
    labels = table(llm, sf, "labels")
    docs = table(llm, sf, "documents")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"), sample=150)
    judged = quality.judge(docs.select("doc_id", "text"), model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    n = Counter((r["quality"], r["kept"]) for r in judged.where("not base_failed").select("quality", "kept").collect())
    assert n[1, True] >= 0.99 * (n[1, True] + n[1, False])
    assert n[0, False] >= 0.9 * (n[0, True] + n[0, False])


PROSE, MENU = "The harvest of the northern valley was early that year.", "HOME | LOGIN | CART | HELP"


def test_a_document_of_both_kinds_has_a_share_between(llm):
    rows = [(i, "\n".join([f"{PROSE[:-1]} {i} {k}." for k in range(20)])) for i in range(40)]
    rows += [(100 + i, "\n".join([f"{MENU} | {i} {k}" for k in range(20)])) for i in range(40)]
    labels = llm.createDataFrame([(i, int(i < 100), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = quality.fit(llm.createDataFrame(rows, "doc_id long, text string"), labels)
    for good, bad in ((12, 4), (6, 6), (3, 15)):
        prose, menu = [f"{PROSE} {k}." for k in range(good)], [f"{MENU} | {k}" for k in range(bad)]
        words = [len(" ".join(x).split()) for x in (prose, menu)]
        for lines in (prose + menu, menu + prose, prose[:good // 2] + menu + prose[good // 2:]):
            *_, share = quality.judged(model, ["\n".join(lines)])[0]
            assert share == words[0] / sum(words)
    # the share decides where the base rules pass: no three words come twice here
    line = lambda k: " ".join(chr(97 + k) * n for n in (3, 5, 4, 6, 2, 7, 8, 9)).capitalize() + "."
    prose = [line(k) for k in range(12)]
    for bad, verdict in ((10, True), (60, False)):
        menu = [f"LOGIN{k} | CART{k} | HELP{k}" for k in range(bad)]
        *_, failed, kept, share = quality.judged(model, ["\n".join(prose + menu)])[0]
        assert (failed, kept) == (False, verdict) and share == 96 / (96 + 5 * bad)


def test_training_reads_whole_documents(llm):
    """What tells the classes apart stands behind line 2,000; documents over the bound are left out."""
    same = "\n".join(f"Plain words number {k} stand here." for k in range(2000))
    rows = [(i, f"{same}\n" + "\n".join([MENU if i % 2 else PROSE] * 30)) for i in range(6)]
    rows.append((7, "\n".join([PROSE] * 3000)))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    labels = llm.createDataFrame([(i, 1 - i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, lines=25_000)
    tail = lambda line: np.array(quality.described("\n".join([line] * 9))[0]) @ model.emit.T
    assert sum(quality.viterbi(model, tail(PROSE))) > sum(quality.viterbi(model, tail(MENU))) == 0
    none = quality.fit(docs, labels, lines=100)
    assert not none.emit.any()


def test_quality_odd_rows(llm, odd, empty):
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, labels)
    rows = quality.judge(odd.select("doc_id", "text"), model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = brute_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 2 * want[4] > want[0])
        assert r["kept"] == (not r["base_failed"])  # no labels: the lines are all content
    kept = quality.kept_documents(odd, model)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [5, 5, 6, 7]
    assert quality.kept_documents(empty, model).count() == 0


# -- personal data -----------------------------------------------------------------

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{list(RULES)[k]}:{s}:{e}" for s, k, e in sorted(out))


TRICKY = [
    "a@b.c_x@d.e.f, 4111 1111 1111 1111 4111-1111-1111-1111", "a@b.c" * 5, "1.2.3.4.5.6.7.8 256.1.1.1 00001.2.3.4",
    "+1 (988) 555-2485 4785380592391139 +12 345 678 901)) 😀 4111111111111111", "a.b%+-@x-y.z.. @a.b x@.c y@d",
    "5" * 40, "1 2 3 4 5 6 7 8 9 0 1 2 ", "١٢.1.2.3.4 é4111111111111111é", "+1++1234567890 +1(2)3.4-5 6789012345",
]


def test_base_spans_equal_brute_force(llm, sf):
    docs = table(llm, sf, "documents").select("doc_id", "text").unionByName(
        llm.createDataFrame([(10_000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    )
    rows = {r["doc_id"]: r for r in pii.report(docs, pii.Model()).collect()}
    for i, t in texts(docs).items():
        assert rows[i]["spans"] == brute_spans(t) and rows[i]["base_sha256"] == sha(brute_spans(t)), t[:80]


def test_model_adds_what_the_rules_swallowed_and_no_more(llm):
    docs = table(llm, "/root/testdata/sf0.01", "documents")
    model = pii.fit(docs)
    assert set(model.thresholds) == {0, 1, 2, 3}
    swallowed = "zz 4465758382889437 4465758382889437 oo"
    plain = "in 2024 we had 1234567890123456 things and 404189 more, at 12:30"
    more = llm.createDataFrame([(-1, swallowed), (-2, plain)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(more, model).collect()}
    assert got[-1]["spans"] == "card:3:19,card:20:36" and got[-1]["n_card"] == 0
    assert got[-2]["spans"] == ""


def test_pii_odd_rows(odd, empty):
    model = pii.Model()
    rows = pii.report(odd, model).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    assert {r["spans"] for r in rows if r["doc_id"] != 9} == {""}
    out = pii.redact(odd, model)
    assert out.columns == odd.columns
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert by_id[9]["text"].startswith("mail [EMAIL] ") and by_id[9]["text"].endswith("and [IP]")
    assert by_id[9]["n_chars"] == len(by_id[9]["text"]) and by_id[1]["text"] is None
    assert pii.report(empty).count() == 0 and pii.redact(empty).count() == 0


# -- byte-pair encoding ------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def both(vocabulary):
    from tokenizers import Tokenizer

    return bpe.Codec(vocabulary), Tokenizer.from_str(vocabulary)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text_encodes_as_the_library_does(both, text):
    mine, theirs = both
    for t in (text, text * 3 + "<|endoftext|>" + text):
        ids = mine.encode(t)
        assert ids == theirs.encode(t, add_special_tokens=False).ids
        assert mine.decode(ids) == theirs.decode(ids, skip_special_tokens=False) == t


def test_long_words_take_linear_time(both):
    mine, theirs = both
    text = "a" * 50_000 + "!?" * 10_000 + "ing" * 5_000
    assert mine.encode(text) == theirs.encode(text, add_special_tokens=False).ids


def test_bpe_odd_rows(odd, empty, vocabulary, both):
    rows = bpe.encoded(odd, vocabulary).collect()
    assert len(rows) == odd.count()
    want = Counter((r["doc_id"], sha(",".join(map(str, both[1].encode(r["text"] or "").ids))), sha(r["text"] or "")) for r in odd.collect())
    assert Counter((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == want
    back = bpe.decoded(bpe.encoded(odd, vocabulary), vocabulary)
    assert Counter(r["text"] for r in back.collect()) == Counter(r["text"] or "" for r in odd.collect())
    assert bpe.encoded(empty, vocabulary).count() == 0


# -- mixing ------------------------------------------------------------------------


def test_water_filling():
    assert mixing.water_fill([100, 100], [1, 1], 200) == [100.0, 100.0]
    assert mixing.water_fill([10, 1000], [1, 1], 1010) == [30.0, 980.0]
    assert mixing.water_fill([0, 0], [1, 2], 0) == [0.0, 0.0] and mixing.water_fill([], [], 0) == []


def test_schedule_spreads_each_source(llm):
    of = [mixing.Share("a", 0, 1, 20_480.0), mixing.Share("b", 0, 1, 82_000.9), mixing.Share("c", 0, 1, 0.0)]
    rows = mixing.schedule(llm, of, 1024).collect()
    assert Counter(r["src"] for r in rows) == {0: 20, 1: 81} and len({r["slot"] for r in rows}) == 101
    for s, n in ((0, 20), (1, 81)):
        own = sorted((r["rank"], r["slot"]) for r in rows if r["src"] == s)
        assert [r for r, _ in own] == list(range(n)) and [x for _, x in own] == sorted(x for _, x in own)
        late = [slot for _, slot in own if slot >= 101]  # blocks that no point named, at the end
        assert len(late) <= 2
        assert all(abs(slot - rank * 101 / n) < 4 * 101 / n for rank, slot in own if slot < 101)


def test_mixing_odd_rows(odd, empty):
    rows = mixing.taken(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    sizes = Counter()
    for r in odd.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    targets = {(r["source_size"], r["target"]) for r in rows}
    assert {s for s, _ in targets} == set(sizes.values())
    assert sum(r["taken"] for r in rows) == sum(int(t) for _, t in targets)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.taken(odd.repartition(3)).collect()), key=repr)
    assert mixing.taken(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_ranges_change_no_place(llm, sf, monkeypatch):
    docs = table(llm, sf, "documents")
    few = sorted(map(tuple, mixing.taken(docs, block=64).collect()), key=repr)
    monkeypatch.setattr(mixing, "RANGE_DIGITS", 1)
    monkeypatch.setattr(mixing, "RANGE_DOCS", 2)
    assert [mixing.range_digits(n) for n in (0, 32, 33, 512, 513)] == [1, 1, 2, 2, 3]
    assert sorted(map(tuple, mixing.taken(docs, block=64).collect()), key=repr) == few


def test_mixed_documents_hold_the_words_taken(llm, sf):
    docs = table(llm, sf, "documents")
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(docs, block=64).collect()}
    out = mixing.mixed_documents(docs, block=64)
    assert out.columns == docs.columns
    whole, got = texts(docs), Counter()
    for r in out.collect():
        assert whole[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
        got[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert got == Counter({i: n for i, n in taken.items() if n})


def test_the_schedule_decides_the_mix(llm, sf, monkeypatch):
    """Slots of one source lie among all others'; without the schedule the mix is another."""
    docs = table(llm, sf, "documents")
    want = {r["doc_id"]: r for r in mixing.taken(docs, block=64).collect()}
    order = [r["doc_id"] for r in mixing.mixed_documents(docs, block=64).collect()]
    first = [want[i]["first_slot"] for i in dict.fromkeys(order)]
    assert first == sorted(first)
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    turns = sum(source[a] != source[b] for a, b in zip(order, order[1:]))
    assert turns > len(order) / 3

    def in_turn(spark, of, block=1024):
        rows = [(i, r) for i, s in enumerate(of) for r in range(-(-s.words // block))]
        return spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "src int, rank long, slot long")

    monkeypatch.setattr(mixing, "schedule", in_turn)
    other = {r["doc_id"]: r for r in mixing.taken(docs, block=64).collect()}
    assert all(other[i]["taken"] == want[i]["taken"] for i in want)
    assert sum(other[i]["first_slot"] != want[i]["first_slot"] for i in want) > len(want) / 2
    assert [r["doc_id"] for r in mixing.mixed_documents(docs, block=64).collect()] != order


def test_rows_of_one_id_spread_over_the_stream(llm):
    docs = llm.createDataFrame([(7, f"text {i} " * 20, "a") for i in range(300)], "doc_id long, text string, source string")
    rows = mixing.ranged(mixing.sized(docs, 7), 1).groupBy("range").count().collect()
    assert len(rows) == 16 and max(r["count"] for r in rows) < 60


# -- sharding ----------------------------------------------------------------------


def check_shards(rows, n):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == n and all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by.get(s, ())) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(16))


def test_shards_of_many_buckets(llm, sf, monkeypatch):
    import zlib

    monkeypatch.setattr(sharding, "BUCKET_BYTES", 40_000)
    docs = table(llm, sf, "documents")
    assert sharding.bucket_count(docs) > 10
    rows = sharding.sharded(docs).collect()
    check_shards(rows, docs.count())
    whole = texts(docs)
    for r in rows:
        t = whole[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 1, zlib.crc32(t), "rows")
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order != sorted(order)
    again = sharding.sharded(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)
    assert sorted(map(tuple, sharding.sharded(docs, seed=12).collect()), key=repr) != sorted(map(tuple, rows), key=repr)


def test_a_task_holds_one_bucket(llm, sf):
    docs = table(llm, sf, "documents").select("doc_id", "text")
    rows = sharding.shuffled(docs, 5, 9).selectExpr("_bucket", "spark_partition_id() as task").distinct().collect()
    assert sorted(map(tuple, rows)) == [(i, i) for i in range(9)]


def test_a_hot_record_is_dealt_out_copy_by_copy(llm, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_COPIES", 10)
    docs = llm.createDataFrame([(1, "same")] * 300 + [(i, f"t{i}") for i in range(2, 100)], "doc_id long, text string")
    rows = sharding.scattered(docs, 3, 8).where("doc_id = 1").groupBy("_bucket").count().collect()
    assert len(rows) == 8 and max(r["count"] for r in rows) < 80
    check_shards(sharding.sharded(docs).collect(), docs.count())


def test_sharding_odd_rows(odd, empty, tmp_path):
    check_shards(sharding.sharded(odd).collect(), odd.count())
    assert sharding.sharded(empty).count() == 0
    path = sharding.write(odd, str(tmp_path / "s"))
    back = sharding.read(odd.sparkSession, path, odd)
    key = lambda df: Counter((r["doc_id"], r["text"], r["source"], r["a b"]) for r in df.collect())
    assert key(back) == key(odd)


# -- near duplicates ---------------------------------------------------------------


def brute_fingerprint(text):
    import xxhash

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(found):
    """found: list of (id, fingerprint)."""
    parent = list(range(len(found)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(found)), 2):
        if (found[i][1] ^ found[j][1]).bit_count() <= 4:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    smallest = {}
    for i, (doc, _) in enumerate(found):
        old = smallest.get(root(i))
        smallest[root(i)] = doc if old is None else old if doc is None else min(old, doc)
    return Counter((d, f"{f:016x}", smallest[root(i)]) for i, (d, f) in enumerate(found))


def test_fingerprints_and_components(llm, sf, odd, empty):
    for docs in (table(llm, sf, "documents").select("doc_id", "text"), odd):
        found = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
        got = Counter(map(tuple, simhash.classes(docs).collect()))
        assert got == brute_components(found)
        kept = simhash.deduplicated(docs)
        assert kept.columns == docs.columns
        assert Counter(r["doc_id"] for r in kept.collect()) == Counter({c for _, _, c in got})
    assert simhash.classes(empty).count() == 0 and simhash.deduplicated(empty).count() == 0


@pytest.mark.parametrize("bucket", [128, 2])
def test_links_lose_nothing_whatever_the_bucket_size(llm, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(bucket)
    fps = []
    for _ in range(12):
        seed = rng.getrandbits(64)
        fps += [seed] + [seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(9)]
    fps = sorted(set(fps))
    rows = llm.createDataFrame([(i, simhash._long(f)) for i, f in enumerate(fps)], "doc_id long, fp long")
    narrow, by_fp = simhash.labelled(rows)
    got = Counter((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in narrow.join(by_fp, "fp").collect())
    assert got == brute_components(list(enumerate(fps)))


def test_balls_meet_exactly_within_the_radius():
    assert len(simhash.ball_flips()) == 2081 and len(simhash.third_flips()) == 131
    a, ball = 0x0123456789ABCDEF, simhash.ball_flips()
    for d in range(7):
        b = a ^ sum(1 << i * 9 for i in range(d))
        assert bool({a ^ x for x in ball} & {b ^ x for x in ball}) == (d <= 4)


def test_long_chain_is_one_component(llm):
    edges = llm.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    rows = simhash.components(edges).collect()
    assert {r["node"] for r in rows} == set(range(1, 41)) and {r["root"] for r in rows} == {0}
