"""Neighbours of pages on hosts that are cut into ranges."""

import pytest

from rillmart.llm import pages


@pytest.mark.parametrize("limit", [1, 2, 7])
def test_a_large_host_gives_each_page_its_true_neighbour(llm, monkeypatch, limit):
    rows = [
        (i, f"http://big.org/s{i // 10:02}/{i:03}", f"<div>Section {i // 10}</div><p>Story {i}</p><div>Pair {(i + 1) // 2}</div>")
        for i in range(90)
    ]
    rows += [(i, "http://big.org/s03/same", f"<p>Tie {i % 3}</p><div>Section 3</div>") for i in range(200, 212)]
    rows += [(None, "http://big.org/s01/010", "<p>no id</p>"), (300, "http://small.org/", "<p>one</p>")]
    df = llm.createDataFrame(rows, "page_id long, url string, html string")
    key = lambda out: sorted(map(tuple, out.collect()), key=repr)
    whole = key(pages.extracted(df))
    monkeypatch.setattr(pages, "GROUP_PAGES", limit)
    assert key(pages.extracted(df.repartition(5))) == whole
