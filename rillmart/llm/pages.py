"""Main text of web pages by differencing pages with near URLs of the same host.

A page is read into lines, one per block, each with the zone it stands in: chrome (menus,
headers, footers, sidebars, notices, adverts, forms, comments), article, or neither. Pages of
a host are sorted by URL path; each is aligned with its neighbour by a longest common
subsequence of lines, and the shared lines are deleted. Two rules keep the result right:
lines within an article element stay although a near copy of the page shares them, and lines
within chrome go although the neighbour lacks them. Differencing decides on all other lines,
unless the two pages share all of them (copies say nothing about templates).
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rillmart.llm.urls import host_of, path_of

#: pages of a host that are sorted together; a larger host is cut into ranges of about as many
GROUP_PAGES = 2000
CHROME, NEUTRAL, ARTICLE = "c", "n", "a"

_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_HIDDEN = set("script style noscript template head title svg math object iframe canvas audio video".split())
_CHROME = set("nav header footer aside form menu dialog button select textarea fieldset".split())
_MAIN = {"article", "main"}
#: class, id and role words that mark chrome
_MARKED = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar "
    "navigation newsletter notice notices overlay paywall popup promo promoted promotion related "
    "replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar widget".split()
)
_ENDS_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
_ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: what an implied end tag never reaches beyond
_WALLS = {"article", "main", "div", "section", "table", "ul", "ol", "nav", "footer", "header", "aside", "body", "form"}
_WORD = re.compile(r"[a-z]+")


class _Page(HTMLParser):
    """Collects blocks of text with their zones; tolerant of unclosed and stray tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str | None]] = []  # tag, 'hidden' | 'chrome' | 'main' | None
        self.blocks: list[tuple[str, str]] = []
        self.words: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            marks = {mark for _, mark in self.open}
            zone = CHROME if "chrome" in marks else ARTICLE if "main" in marks else NEUTRAL
            self.blocks.append((text, zone))

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in _INLINE:
            self.flush()
            if tag in _ENDS_P:
                self._end_implied({"p"})
            elif tag in _ENDS_SAME:
                self._end_implied(_ENDS_SAME[tag])
        elif tag in ("br", "wbr", "img"):
            self.words.append(" " if tag == "br" else "")
        if tag in _VOID:
            return
        mark = self._mark(tag, attrs)
        if mark == "chrome" and tag in _INLINE:
            self.flush()
        self.open.append((tag, mark))

    def _mark(self, tag: str, attrs) -> str | None:
        if tag in _HIDDEN:
            return "hidden"
        if tag in _CHROME:
            return "chrome"
        given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        if "hidden" in given or given.get("aria-hidden") == "true":
            return "hidden"
        said = f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".lower()
        if tag not in ("html", "body") and _MARKED.intersection(_WORD.findall(said)):
            return "chrome"
        return "main" if tag in _MAIN or given.get("role") in ("main", "article") else None

    def _end_implied(self, tags: set[str]) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                self._close(i)
                return
            if self.open[i][0] in _WALLS:
                return

    def _close(self, i: int) -> None:
        self.flush()
        del self.open[i:]

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if tag in _INLINE and self.open[i][1] is None and i == len(self.open) - 1:
                    self.open.pop()
                elif tag in _INLINE:
                    # a stray inline end closes that element only, not the blocks opened in it
                    if self.open[i][1]:
                        self.flush()
                    self.open.pop(i)
                else:
                    self._close(i)
                return
            if tag in _INLINE and self.open[i][0] in _WALLS:
                return
        if tag == "p" or tag not in _INLINE:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not any(mark == "hidden" for _, mark in self.open):
            self.words.append(data)


def lines(html: str | None) -> list[tuple[str, str]]:
    """The page's blocks as (text, zone), white space as single spaces, references decoded."""
    page = _Page()
    page.feed(html or "")
    page.close()
    page.flush()
    return page.blocks


def common(a: list, b: list) -> list[bool]:
    """Which items of a stand in a longest common subsequence of a and b.

    Bit-parallel: one row of bits per item of a, as long as b, kept for the way back.
    """
    keep = [False] * len(a)
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < min(hi_a, hi_b) and a[lo] == b[lo]:
        keep[lo] = True
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
        keep[hi_a] = True
    where: dict = {}
    for j in range(lo, hi_b):
        where[b[j]] = where.get(b[j], 0) | 1 << (j - lo)
    width = hi_b - lo
    full = (1 << width) - 1
    rows, v = [full], full
    for i in range(lo, hi_a):
        u = v & where.get(a[i], 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    # a zero bit j in row i: b's item j lengthens the common subsequence of a's first i items
    j = width - 1
    for i in range(hi_a - 1, lo - 1, -1):
        row, above = rows[i - lo + 1], rows[i - lo]
        while j >= 0 and row >> j & 1:
            j -= 1
        if j < 0:
            break
        if above >> j & 1:
            keep[i] = True
            j -= 1
    return keep


def main_lines(page: list[tuple[str, str]], partner: list[str] | None) -> list[str]:
    """What is left of a page when the lines it shares with its partner are deleted."""
    texts = [t for t, _ in page]
    shared = common(texts, partner) if partner else [False] * len(texts)
    if all(s for s, (_, zone) in zip(shared, page) if zone != CHROME):
        shared = [False] * len(texts)
    has_article = any(zone == ARTICLE for _, zone in page)
    return [
        t for (t, zone), s in zip(page, shared)
        if zone == ARTICLE or (zone == NEUTRAL and not has_article and not s)
    ]


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and path; each is aligned with the one before it, a group's first
    with the one behind it. A lent page is aligned with, but not put out. Three pages are held."""
    held: tuple | None = None  # (group, page_id, url, page) whose partner may come next
    before: list[str] | None = None
    out: list[tuple] = []

    def done(row: tuple, partner: list[str] | None) -> None:
        if row[4]:
            return
        text = "\n\n".join(main_lines(row[3], partner))
        out.append((row[1], row[2], text, len(text)))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int64(), pa.string(), pa.large_string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page_id", "url", "text", "n_chars"])

    for b in batches:
        for host, salt, page_id, url, texts, zones, lent in zip(
            *(b.column(n).to_pylist() for n in ("host", "salt", "page_id", "url", "texts", "zones", "lent"))
        ):
            row = ((host, salt), page_id, url, list(zip(texts, zones)), lent)
            if held is not None:
                same = held[0] == row[0]
                done(held, before if before is not None else (texts if same else None))
                before = [t for t, _ in held[3]] if same else None
            held = row
        yield batch()
        out.clear()
    if held is not None:
        done(held, before)
    yield batch()


def _key(path: str | None, page_id: int | None) -> tuple:
    return (path is not None, path or "", page_id is not None, page_id or 0)


def _ranges(rows: DataFrame) -> tuple[dict, dict]:
    """Of every host above GROUP_PAGES: the sorted keys that begin its ranges but the first, and
    for each range the greatest (path, page_id, url) in it.

    Rows are sampled by hash, four for each GROUP_PAGES, and every fourth begins a range, so no
    host is sorted for it.
    The first range has two pages at least: its first page is aligned with the one behind it.
    """
    large = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_PAGES).select("host")
    chosen = rows.where(F.pmod(F.xxhash64("path", "page_id"), F.lit(max(1, GROUP_PAGES // 4))) == 0).select("host", "path", "page_id").distinct()
    begins: dict = {}
    for host, path, page_id in chosen.join(large, "host", "left_semi").collect():
        begins.setdefault(host, []).append(_key(path, page_id))
    if not begins:
        return {}, {}
    for keys in begins.values():
        keys.sort()
        keys[:] = keys[3::4]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            salts = [
                bisect_right(begins[h], _key(p, i)) if h in begins else -1
                for h, p, i in zip(*(b.column(n).to_pylist() for n in ("host", "path", "page_id")))
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(salts, pa.int64())], [*b.schema.names, "salt"])

    narrow = rows.select("host", "path", "page_id", "url")
    ends = (
        narrow.mapInArrow(each, narrow.withColumn("salt", F.lit(0).cast("long")).schema)
        .where("salt >= 0").groupBy("host", "salt")
        .agg(F.max(F.struct("path", "page_id", "url")).alias("last"), F.count(F.lit(1)).alias("n"))
    )
    found: dict = {}
    for host, salt, last, n in ends.collect():
        found.setdefault(host, {})[salt] = (tuple(last), n)
    lasts = {}
    for host, keys in begins.items():
        pages = found[host].get(0, (None, 0))[1]
        while pages < 2 and keys:
            del keys[0]
            found[host] = {0: (None, 0)} | {k - 1: v for k, v in found[host].items() if k}
            pages += found[host][0][1]
        lasts[host] = {k: v[0] for k, v in found[host].items()}
    return begins, lasts


def _reader(begins: dict, lasts: dict):
    """Rows with their lines and range; the last page of a range is lent to the next one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, salts, lent = [], [], []
            for i, (host, path, page_id, url) in enumerate(
                zip(*(b.column(n).to_pylist() for n in ("host", "path", "page_id", "url")))
            ):
                keys = begins.get(host, ())
                salt = bisect_right(keys, _key(path, page_id))
                again = salt < len(keys) and lasts[host][salt] == (path, page_id, url)
                for more in range(1 + again):
                    at.append(i)
                    salts.append(salt + more)
                    lent.append(bool(more))
            pages = [lines(h) for h in b.column("html").to_pylist()]
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(n).take(taken) for n in ("page_id", "url", "host", "path")),
                    pa.array([[t for t, _ in pages[i]] for i in at], pa.list_(pa.string())),
                    pa.array(["".join(z for _, z in pages[i]) for i in at], pa.string()),
                    pa.array(salts, pa.int64()), pa.array(lent, pa.bool_()),
                ],
                ["page_id", "url", "host", "path", "texts", "zones", "salt", "lent"],
            )

    return read


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty html gives an empty text; pages whose URL is null or has no ``://`` are
    one host. Repeated rows come out repeated; other columns are not read. A host with more
    than GROUP_PAGES pages is cut into ranges of its path order, so the pages of no host are
    sorted in one task; each range is handed the page before it, so every page meets its
    neighbour at any size.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
    )
    return (
        rows.mapInArrow(
            _reader(*_ranges(rows.drop("html"))),
            "page_id long, url string, host string, path string, texts array<string>, zones string, salt long, lent boolean",
        )
        .select("host", "salt", "path", "page_id", "url", "texts", "zones", "lent")
        .repartition("host", "salt")
        .sortWithinPartitions("host", "salt", "path", "page_id", "url", "zones")
        .mapInArrow(_difference, "page_id long, url string, text string, n_chars long")
    )
