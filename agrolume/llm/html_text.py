"""Main text of web pages by differencing each page with the nearest one of its host.

Pages stand in order of host, URL path and id.  A page's blocks of visible text are its
lines.  Neighbours that are copies form a run: pages with the same lines, and pages of
one path (another crawl or query string) that share ``NEARLY`` of their lines.  A page's
partner is the page before its run or the one after, if it is of the same host and no
copy of the page; of two, the one whose path agrees longest (the former on a tie).  The
longest common subsequence aligns the two pages, and lines that both share are template,
not article: they are deleted.  A page that has only copies beside it loses nothing.

Navigation, headers, footers, sidebars, forms, scripts, styles and elements whose whole
name says notice, advert or comment are no lines at all.  Every page is differenced.  On
a page that marks articles (``article``, ``main``) an exact check follows: a marked
article with a line of its own is main text and keeps all its lines, also those that
another page shares, such as a quoted passage; one whose lines all stand on the partner,
and on the page at its other side if that is no copy either, is template (a teaser, a
notice) and goes; lines outside of articles go.  If no article has a line of its own,
differencing tells nothing and all of them stay.

Only hashes of lines are dealt and compared, by ranges of host and path, so a hot host
spreads over many tasks.  What a range has to know of the others is two pages: the one
before the run that its first page belongs to, and the one after the run of its last.
They are found from four pages of each range, so the text does not depend on the ranges.

Edges: a null html counts as empty and has an empty text; a null url is a host of its
own; rows that repeat are pages of their own, but the same page_id and url is always a
copy; a page without lines but those of its forms has those; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import sliced, stored

# Element names of HTML, and what elements call themselves.
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
LEFT_OUT = frozenset("nav footer aside form button select option datalist dialog menu svg math canvas object audio video map fieldset label input".split())
MAIN = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul caption".split()
)
#: Left out wherever they stand in a class or id.
NAMES = frozenset(
    "ads advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors gdpr newsletter paywall popup sidebar navbar navigation "
    "breadcrumb breadcrumbs masthead comments commentlist disqus pagination pager".split()
)
#: Left out if no word beside them says otherwise.
LOOSE_NAMES = frozenset(
    "ad promo promotion banner cookie cookies consent notice notices alert subscribe subscription signup login modal overlay side menu nav footer "
    "comment replies respond share sharing social related recommended widget toolbar skip disclaimer copyright tracking".split()
)
#: Words that say nothing.
PLAIN_NAMES = frozenset(
    "a area author bar block body bottom box button buttons col column container content div group header icon icons inline inner item items label left link "
    "links list main media message meta module outer page panel policy position post posts right row section site slot text title to top unit user wrap wrapper".split()
)
ROLES_LEFT_OUT = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())

TAG_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
TAG_END = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
ATTRIBUTE = re.compile(r"(class|id|role|style|aria-hidden|hidden)(?=[\s=/>]|$)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.I)
WORDS = re.compile(r"[a-z]+")
NEARLY = 0.9


def _named(name: str) -> bool:
    """Does one name of an element say that it is no main text?"""
    words = set(WORDS.findall(name))
    return not NAMES.isdisjoint(words) or (not LOOSE_NAMES.isdisjoint(words) and words <= LOOSE_NAMES | PLAIN_NAMES)


def _left_out(name: str, tag: str, inside: bool) -> bool:
    """Does the markup itself say that this element is no main text?"""
    if name in LEFT_OUT or (name == "header" and not inside):
        return True
    if name in ("html", "body", *MAIN) and not inside or " " not in tag:
        return False
    for key, value in ATTRIBUTE.findall(tag):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and any(map(_named, value.split())):
            return True
        if key == "role" and value in ROLES_LEFT_OUT:
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def lines_of(html: str | None) -> tuple[list[tuple[str, int]], bool]:
    """(line, number of the marked article it stands in or 0) for each block, and whether the page marks any.

    Articles inside one count as part of it; ``main`` is one of its own where no article is.
    """
    found = _lines_of(html or "", True)
    if not found[0] and re.search("<form", html or "", re.I):  # the whole body may stand in a form
        found = _lines_of(html, False)
    return found


def _lines_of(html: str, forms_out: bool) -> tuple[list[tuple[str, int]], bool]:
    lines: list[tuple[str, int]] = []
    buffer: list[str] = []
    marks: list[tuple[int, bool]] = []  # number of each open mark, and whether an article is open
    marked = 0  # articles so far
    skipping, skipped = "", 0  # the element left out, and how many of its name are open
    at, end = 0, len(html)

    def flush() -> None:
        if buffer:
            line = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                lines.append((line, marks[-1][0] if marks else 0))

    while at < end:
        opening = html.find("<", at)
        if opening < 0:
            opening = end
        if opening > at and not skipping:
            buffer.append(html[at:opening])
        if opening == end:
            break
        if html.startswith("<!--", opening):
            close = html.find("-->", opening + 4)
            at = end if close < 0 else close + 3
            continue
        if html.startswith(("<!", "<?"), opening):
            close = html.find(">", opening)
            at = end if close < 0 else close + 1
            continue
        named = TAG_NAME.match(html, opening + 1)
        if not named:  # a bare less-than sign
            if not skipping:
                buffer.append("<")
            at = opening + 1
            continue
        whole = TAG_END.match(html, named.end())
        close = whole.end() if whole else html.find(">", named.end()) + 1
        if not close:  # cut off in the middle of a tag
            break
        at = close
        name, closing = named[1].lower(), html[opening + 1] == "/"
        if name in RAW and not closing:
            found = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, close)
            after = html.find(">", found.end()) if found else -1
            at = end if after < 0 else after + 1
            continue
        if skipping:
            if closing and name == skipping:
                skipped -= 1
            elif not closing and name == skipping:
                skipped += 1
            if skipped and not (name in MAIN and not closing and not marks) and not (skipping == "p" and name in BLOCKS):
                continue
            ended = closing and name == skipping
            skipping = ""
            if ended:
                continue
        if not closing and name not in VOID and (forms_out or name != "form") and _left_out(name, html[opening:close], bool(marks)):
            flush()
            skipping, skipped = name, 1
            continue
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th", "wbr") and name != "wbr":
            buffer.append(" ")
        if name in MAIN:
            if not closing:
                number, inside = marks[-1] if marks else (0, False)
                if not number or (name == "article" and not inside):
                    number = marked = marked + 1
                marks.append((number, inside or name == "article"))
            elif marks:
                marks.pop()
            marked = marked or 1
    flush()
    return lines, marked > 0


def shared_lines(own: list[str], other: list[str]) -> set[int]:
    """Places in ``own`` of the longest common subsequence with ``other``.

    Common ends first; the middle by bit vectors, one integer per line of ``own``.
    """
    low = 0
    while low < min(len(own), len(other)) and own[low] == other[low]:
        low += 1
    high = 0
    while high < min(len(own), len(other)) - low and own[-1 - high] == other[-1 - high]:
        high += 1
    shared = {*range(low), *range(len(own) - high, len(own))}
    a, b = own[low : len(own) - high], other[low : len(other) - high]
    places: dict[str, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for line in a:
        hit = row & places.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    j = len(b)
    for i in range(len(a), 0, -1):  # zeros in rows[i] below j count the common lines of a[:i], b[:j]
        ones = lambda r: j - (r & ((1 << j) - 1)).bit_count()
        if ones(rows[i]) == ones(rows[i - 1]):
            continue
        while j and rows[i] >> (j - 1) & 1:
            j -= 1
        shared.add(low + i - 1)
        j -= 1
    return shared


def _agree(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Page:
    """What is compared of a page: its place, and the hashes of its lines."""

    def __init__(self, row: int, page_id: object, url: str | None, host: str, path: str, articles: bytes | None, hashes: bytes):
        self.row, self.id, self.host, self.path, self.articles, self.hashes = row, (page_id, url), host, path, articles, hashes

    def lines(self) -> list[int]:
        return np.frombuffer(self.hashes, np.int64).tolist()

    def copies(self, other: Page) -> bool:
        """Are two pages of one host versions of one page?"""
        if self.host != other.host:
            return False
        if self.id == other.id or self.hashes == other.hashes:
            return True
        if self.path != other.path:
            return False
        own, its = self.lines(), other.lines()
        return len(shared_lines(own, its)) >= NEARLY * max(len(own), len(its))

    def kept(self, before: Page | None, after: Page | None) -> list[int] | None:
        """Places of the lines left beside the partner, among those of the articles if any is marked; None for all."""
        near = [p for p in (before, after) if p and p.host == self.host and not p.copies(self)]
        if not near:
            return None
        near.sort(key=lambda p: -_agree(p.path, self.path))
        own = self.lines()
        shared = shared_lines(own, near[0].lines())
        if self.articles is None:
            return [i for i in range(len(own)) if i not in shared]
        articles = np.frombuffer(self.articles, np.int32).tolist()
        own_text = {a for i, a in enumerate(articles) if a and i not in shared}
        inside = [a for a in articles if a]
        if not own_text or own_text.issuperset(inside):
            return None
        if len(near) > 1:  # template stands on both sides
            shared &= shared_lines(own, near[1].lines())
            own_text.update(a for i, a in enumerate(articles) if a and i not in shared)
        return [i for i, a in enumerate(inside) if a in own_text]


COMPARED = ("row", "page_id", "url", "host", "path", "articles", "hashes")
EDGES = ("first", "last", "before_last_break", "at_first_break")


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Page]]:
    """(turn, page) of a range."""
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("turn", *COMPARED))
        for turn, *fields in zip(*columns):
            yield turn, Page(*fields)


def _edges(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """range, edge, row: the pages of a range by which others know it; a break stands before a page that is no copy of the last one."""
    first = last = before_break = at_break = None
    for _, page in _pages(batches):
        if first is None:
            first = page
        elif not last.copies(page):
            before_break, at_break = last, at_break or page
        last = page
    found = [(name, p.row) for name, p in zip(EDGES, (first, last, before_break, at_break)) if p]
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()] * len(found), pa.int32()), pa.array([n for n, _ in found], pa.string()), pa.array([r for _, r in found], pa.int64())], names=["range", "edge", "row"]
    )


def _carried(edges: pd.DataFrame) -> pd.DataFrame:
    """range, turn (0 for the page before, 2 for the one after), row: from the edges of all ranges, four pages each."""
    of: dict[int, dict[str, Page]] = {}
    for record in edges.itertuples():
        of.setdefault(record.range, {})[record.edge] = Page(*(getattr(record, c) for c in COMPARED))
    order, out = sorted(of), []
    breaks = {b: not of[a]["last"].copies(of[b]["first"]) for a, b in zip(order, order[1:])}
    before, after = {}, {}
    for a, b in zip(order, order[1:]):
        before[b] = of[a]["last"] if breaks[b] else of[a].get("before_last_break") or before.get(a)
    for a, b in zip(order[-2::-1], order[:0:-1]):
        after[a] = of[b]["first"] if breaks[b] else of[b].get("at_first_break") or after.get(b)
    for turn, pages in ((0, before), (2, after)):
        out += [(r, turn, page.row) for r, page in pages.items() if page]
    return pd.DataFrame(out, columns=["range", "turn", "row"])


def _compared(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, kept: the lines left of each page of a range that loses some."""
    before, after, run = None, None, []
    out: list[tuple[int, list[int]]] = []

    def close(next_page: Page | None) -> None:
        for page in run:
            if (kept := page.kept(before, next_page)) is not None:
                out.append((page.row, kept))

    def taken() -> pa.RecordBatch:
        rows, kept = [r for r, _ in out], [k for _, k in out]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(kept, pa.list_(pa.int32()))], names=["row", "kept"])

    for turn, page in _pages(batches):
        if turn == 0:
            before = page
        elif turn == 2:
            after = page
        elif run and run[-1].copies(page):
            if page.hashes == run[-1].hashes:
                page.hashes = run[-1].hashes  # equal lines are held once
            run.append(page)
        else:
            if run:
                close(page)
                before = run[-1]
            run = [page]
            if len(out) >= 256:
                yield taken()
    close(after)
    yield taken()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url, host, path, articles (of each line, null if none is marked), lines (those of the articles if any is marked), hashes (of all lines)."""
    for batch in sliced(batches):
        articles, lines, hashes = [], [], []
        for html in batch.column("html").to_pylist():
            found, marked = lines_of(html)
            articles.append(np.array([a for _, a in found], np.int32).tobytes() if marked else None)
            lines.append([line for line, a in found if a or not marked])
            hashes.append(np.array([xxhash.xxh3_64_intdigest(line) for line, _ in found], np.uint64).tobytes())
        columns = [*(batch.column(c) for c in ("page_id", "url", "host", "path")), pa.array(articles, pa.binary()), pa.array(lines, pa.list_(pa.string())), pa.array(hashes, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "path", "articles", "lines", "hashes"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*?)/?(?:[?#].*)?$", 1)


def extract(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """page_id, url, text of every page; ``ranges`` says in how many parts pages are compared."""
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    id_type = dict(pages.dtypes)["page_id"]
    parsed = keyed.mapInArrow(_parsed, f"page_id {id_type}, url string, host string, path string, articles binary, lines array<string>, hashes binary")
    parsed = stored(parsed.withColumn("row", F.monotonically_increasing_id()), "parsed")

    order = ["host", "path", "page_id", "url", "row"]
    ranged = parsed.select(*COMPARED)
    ranged = ranged.repartitionByRange(*((ranges,) if ranges else ()), *order).withColumns({"range": F.spark_partition_id(), "turn": F.lit(1)})
    ranged = stored(ranged, "ranged")
    in_order = lambda df: df.repartition("range").sortWithinPartitions("range", "turn", *order).groupBy("range")
    edges = stored(in_order(ranged).applyInArrow(_edges, "range int, edge string, row long"), "edges")
    # Four pages of each range meet in one task, of a page only the hashes of its lines.
    known = edges.join(ranged.drop("range", "turn"), "row").select("range", "edge", *COMPARED)
    carried = stored(known.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_carried, "range int, turn int, row long"), "carried")
    beside = carried.join(ranged.drop("range", "turn"), "row")
    kept = in_order(ranged.unionByName(beside)).applyInArrow(_compared, "row long, kept array<int>")

    whole = F.array_join("lines", "\n\n")
    left = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n\n")
    texts = parsed.select("row", "page_id", "url", "lines").join(stored(kept, "kept"), "row", "left")
    return texts.select("page_id", "url", F.when(F.col("kept").isNull(), whole).otherwise(left).alias("text"))
