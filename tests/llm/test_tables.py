"""Chat formatting, page extraction, top-k search, URL filters, the pipeline and the SQL."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from compare import differences, duck
from rillmart.llm import chat, pages, queries, topk, urls
from rillmart.sources.tables import table
from test_documents import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(llm, name):
    assert differences(queries.QUERIES[name](llm, SF), duck(SF), queries.oracle_sql()[name]) is None


# -- chat --------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("<turn/>\\ \nab", max_size=12), st.text("<turn/>\\ \nab", max_size=30)), max_size=5))
def test_turns_come_back_from_any_text(turns):
    assert chat.turns("".join(chat.turn(r, t)[0] for r, t in turns)) == turns


def test_examples_have_one_trainable_reply_each(llm):
    rows = [
        (1, 0, "user", "q <turn x>\n</turn>"), (1, 1, "assistant", "a\\</turn>\n"), (1, 2, "user", None),
        (1, 3, "assistant", "b"), (1, 4, "user", "left over"), (2, 0, None, "no reply"), (None, 0, "assistant", "lost"),
        (3, 1, "assistant", "tie"), (3, 1, "assistant", "tie"), (3, None, "user", "first"),
    ]
    turns = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as example")
    got = {}
    for r in chat.examples(turns).collect():
        loss = None if r["loss_start"] is None else chat.unescaped(r["formatted"][r["loss_start"]:r["loss_end"]])
        got.setdefault(r["conv_id"], []).append((r["n_context"], loss, chat.turns(r["formatted"])))
    assert [(n, x) for n, x, _ in got[1]] == [(1, "a\\</turn>\n"), (3, "b"), (5, None)]
    assert got[1][-1][2] == [(r, t or "") for _, _, r, t in rows[:5]]
    assert [(n, x) for n, x, _ in got[2]] == [(1, None)] and got[None][0][:2] == (0, "lost")
    assert [(n, x) for n, x, _ in got[3]] == [(1, "tie"), (2, "tie")] and got[3][1][2][0] == ("user", "first")
    none = llm.createDataFrame([], turns.schema)
    assert chat.examples(none).count() == 0 and chat.digests(chat.examples(none)).count() == 0


# -- pages -------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_common_is_a_longest_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    kept = [x for x, k in zip(a, pages.common(a, b)) if k]
    rest = iter(b)
    assert len(kept) == best[-1][-1] and all(x in rest for x in kept)


ARTICLE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li>Menu</li></ul></nav><header>Top</header><div class="cookie-notice">We use cookies</div>
<article><h1>A &amp; B&nbsp;&#233;</h1><p><b>One
  two<br>three<p>Four <i>fi</i>ve</p><div class="ad">Buy</div><ul><li>x<li>y</ul><form>Name</form>
<section id="comments"><p>I disagree</p></section></article><aside>Side</aside><footer>&copy;</footer>"""


def test_article_without_chrome():
    assert pages.main_lines(pages.lines(ARTICLE), None) == ["A & B é", "One two three", "Four five", "x", "y"]
    assert pages.lines(None) == [] and pages.lines("just text") == [("just text", "n")]


def test_differencing_deletes_what_neighbours_share(llm):
    page = lambda n: f"<div>Shop news</div><p>Story {n}</p><p>Call us</p>"
    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(4)]
    rows += [(10, "http://copy.org/1", page(7)), (11, "http://copy.org/2", page(7)), (12, "http://alone.org/", page(8))]
    rows += [(20, None, None), (21, "no scheme", ""), (None, "http://h.org/1", page(9)), (13, "http://a.org/1", ARTICLE), (14, "http://a.org/2", ARTICLE)]
    df = llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as texts")
    got = {r["page_id"]: r for r in pages.extracted(df).collect()}
    assert len(got) == len(rows)
    assert [got[i]["text"] for i in (*range(4), None)] == ["Story 0", "Story 1", "Story 2", "Story 3", "Story 9"]
    assert got[10]["text"] == "Shop news\n\nStory 7\n\nCall us" and got[12]["text"].startswith("Shop news")
    assert (got[20]["text"], got[20]["n_chars"], got[21]["n_chars"]) == ("", 0, 0)
    assert got[13]["text"] == got[14]["text"] and got[13]["text"].endswith("x\n\ny")
    assert pages.extracted(df.limit(0)).count() == 0


# -- top-k -------------------------------------------------------------------------


def brute_top(vectors, step=50, k=5):
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in vectors]
    out = []
    for q, x in whole:
        if q % step == 0:
            scored = sorted((-int(sum(a * b for a, b in zip(x.tolist(), y.tolist()))), i) for i, y in whole if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_search_equals_brute_force(llm, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "SUMMARY", 4)
    rng = random.Random(1)
    base = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(12)]
    vectors = [(i, [x + rng.uniform(-0.01, 0.01) for x in base[i % 12]]) for i in range(300)]
    vectors += [(i, [0.5] * 6) for i in range(300, 420)]  # many equal vectors: ties
    odd = [(500, None), (501, [1.0, None]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (None, [0.1] * 6)]
    df = llm.createDataFrame(vectors + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "'b' as block")
    got = sorted(map(tuple, topk.search(df, df.where("vec_id % 50 = 0")).collect()))
    assert got == brute_top([(i, np.array(v, np.float32).astype(float)) for i, v in vectors])


def test_search_small_and_empty(llm):
    two = llm.createDataFrame([(0, [1.0, 2.0]), (1, [3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1, 768 * 256)]
    none = two.limit(0)
    assert topk.search(none, none).count() == 0 and topk.search(two, none).count() == 0
    assert topk.product(np.array([[2**40]]), np.array([[2**40]]))[0, 0] == 2**63 - 1


# -- URL filters -------------------------------------------------------------------


def test_rules_and_precedence(llm):
    rules = urls.rule_table(llm, [
        ("block", "net", "/"), ("allow", "a.net", "/x/"), ("block", "a.net", "/x/y"), ("allow", "a.net", "/x/y"),
        ("block", None, "/"), ("block", "b.org", ""),
    ])
    want = {
        "http://A.NET/x/z?q": ("a.net/x/", "allow"), "http://s.a.net/x/yes": ("a.net/x/y", "block"),
        "http://na.net/": ("net/", "block"), "http://net/": ("net/", "block"), "http://net": (None, "allow"),
        "ftp://www.b.org?x": ("b.org", "block"), "http://bb.org/": (None, "allow"), "no scheme": (None, "allow"),
        None: (None, "allow"), "": (None, "allow"), "http://" + "s." * 3000 + "a.net/x/" + "p/" * 5000: ("a.net/x/", "allow"),
        "a\nb://c.net/\n": ("net/", "block"),
    }
    rows = [(i, u) for i, u in enumerate(want)] + [(0, next(iter(want)))]
    df = llm.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' as host", "1 as verdict")
    out = urls.judge(df, rules).collect()
    assert Counter((r["page_id"], r["rule"], r["verdict"]) for r in out) == Counter((i, *want[u]) for i, u in rows)
    assert urls.judge(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.judge(df, rules.limit(0)).collect()} == {"allow"}


# -- the pipeline ------------------------------------------------------------------


def test_near_duplicate_stage_keeps_one_text_of_each_component(llm, odd, empty):
    import corpus_pipeline

    for docs in (table(llm, SF, "documents"), odd, empty):
        found = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
        out = corpus_pipeline.near_duplicates(llm, docs, SF)
        assert out.columns == docs.columns
        want = Counter({c for _, _, c in brute_components(found)})
        assert Counter(r["doc_id"] for r in out.collect()) == want


def test_pipeline_stages(llm):
    import corpus_pipeline

    docs = table(llm, SF, "documents")
    now, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, now, SF)
        assert out.columns == docs.columns, name
        now = llm.createDataFrame(out.collect(), docs.schema)
        sizes.append(now.count())
    assert 0 < sizes[1] <= sizes[0] < docs.count() and sizes[2] == sizes[1]
    ids = {r["doc_id"] for r in now.collect()}
    final = corpus_pipeline.STAGES[-1][1](llm, now, SF)
    assert {r["doc_id"] for r in final.collect()} == ids
    assert corpus_pipeline.run(llm, SF).count() == sizes[3]
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
