"""Extraction on small pages, alignment against the plain dynamic programme."""

import re
from html import unescape

import pytest
from agrolume.llm import html_text
from hypothesis import given, settings
from hypothesis import strategies as st


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    shared = sorted(html_text.shared_lines(a, b))
    assert len(shared) == lcs(a, b)
    assert lcs([a[i] for i in shared], b) == len(shared)


def run(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    return {r.page_id: r.text for r in html_text.extract(df).collect()}


MARKED = """<!DOCTYPE html><html><head><title>T &am</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><header>Top</header><!-- no --><div class="ad">Buy</div><div id='cookie-notice'>We <b>bake</b></div>
<main><article><h1>Title&nbsp;one</h1><p><b>First <i>line</i>.<br><p>Second &amp; third&#33;</p><aside>Side</aside><form>Send</form>
<p class="lead">1 < 2</p><p class=ad>Ad<p>After</p><ul><li>a</li><li>b</li></ul><section class="comments"><p>Me too</p></section></article></main><footer>&copy; x</footer>"""


def test_marked_page(spark):
    expected = "\n\n".join(["Title one", "First line.", "Second & third!", "1 < 2", "After", "a", "b"])
    assert run(spark, [(1, "http://a/x", MARKED, None)]) == {1: expected}


def test_unmarked_pages_lose_what_they_share(spark):
    page = "<body><div>Welcome</div><div>{0} one</div><p>{0} two</p><div>Bye</div></body>"
    rows = [(i, f"http://h.example/p/{i}?q=1", page.format(f"text {i}"), "x") for i in range(3)]
    rows += [(9, "http://alone.example/p", page.format("alone"), "x")]
    got = run(spark, rows)
    assert got[1] == "text 1 one\n\ntext 1 two"
    assert got[9] == "Welcome\n\nalone one\n\nalone two\n\nBye"



def test_copies_are_no_partners(spark):
    page = "<body><div>Welcome</div><div>{0} one</div><p>{0} two</p><div>Bye</div></body>"
    dated = "<body><div>Welcome</div>" + "".join(f"<p>story {i}</p>" for i in range(20)) + "<p>seen {0}</p><div>Bye</div></body>"
    urls = ["http://h.example/a", "http://h.example/a", "http://h.example/a?page=2", "http://h.example/a?ref=x", "http://h.example/a/print"]
    rows = [(i, url, page.format("copied"), "x") for i, url in enumerate(urls)]
    rows += [(10, "http://h.example/b", page.format("other"), "x")]
    rows += [(20 + i, f"http://h.example/c?at={i}", dated.format(i), "x") for i in range(3)]
    rows += [(30 + i, f"http://only.example/a?{i}", page.format("only"), "x") for i in range(3)]
    rows += [(40 + i, f"http://q.example/show?id={i}", page.format(f"number {i}"), "x") for i in range(3)]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert all(got[i] == "copied one\n\ncopied two" for i in range(5))
    assert got[10] == "other one\n\nother two"
    assert all(got[20 + i] == "\n\n".join([*(f"story {j}" for j in range(20)), f"seen {i}"]) for i in range(3))
    assert all(got[30 + i] == "Welcome\n\nonly one\n\nonly two\n\nBye" for i in range(3))
    assert all(got[40 + i] == f"number {i} one\n\nnumber {i} two" for i in range(3))


@pytest.mark.parametrize("ranges", [1, 2, 6, 50])
def test_the_text_does_not_depend_on_the_ranges(spark, ranges):
    page = "<body><div>Welcome {1}</div><div>{0} one</div><p>{0} two</p><div>Bye</div></body>"
    rows = [(i, f"http://h.example/p/{i}", page.format(f"text {i}", ""), "x") for i in range(6)]
    rows += [(100 + i, f"http://hot.example/{i // 3}?n={i}", page.format(f"t {i % 40}" if i < 200 else "copies", i % 2), "x") for i in range(400)]
    rows += [(600 + i, "http://same.example/a", page.format("all alike", ""), "x") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(df, ranges).collect()}
    want = plain_extract([r[:3] for r in rows])
    assert got == want
    assert [got[i] for i in range(6)] == [f"text {i} one\n\ntext {i} two" for i in range(6)]


def plain_extract(rows):
    """The same in one loop over all pages, with the plain dynamic programme for what is shared."""
    host = lambda u: re.match(r"\w+://([^/?#]*)", u)[1]
    path = lambda u: re.sub(r"[?#].*", "", re.sub(r"^\w+://[^/?#]*", "", u)).rstrip("/")
    pages = sorted((host(u), path(u), i, u, tuple(x for x, _ in html_text.lines_of(h)[0])) for i, u, h in rows)
    alike = lambda a, b: a[0] == b[0] and (a[2:4] == b[2:4] or a[4] == b[4] or (a[1] == b[1] and lcs(a[4], b[4]) >= 0.9 * max(len(a[4]), len(b[4]))))
    runs = []
    for p in pages:
        if runs and alike(runs[-1][-1], p):
            runs[-1].append(p)
        else:
            runs.append([p])
    out = {}
    for n, run_ in enumerate(runs):
        before, after = runs[n - 1][-1] if n else None, runs[n + 1][0] if n + 1 < len(runs) else None
        for p in run_:
            near = [x for x in (before, after) if x and x[0] == p[0] and not alike(x, p)]
            agree = lambda x, p=p: next((i for i, (a, b) in enumerate(zip(x[1], p[1])) if a != b), min(len(x[1]), len(p[1])))
            shared = html_text.shared_lines(list(p[4]), list(max(near, key=agree)[4])) if near else set()
            if near:
                assert len(shared) == lcs(p[4], max(near, key=agree)[4])
            out[p[2]] = "\n\n".join(x for i, x in enumerate(p[4]) if i not in shared)
    return out


def test_names_are_whole_names(spark):
    article = '<article><p>Start</p><section id="social-history"><p>Kept one</p></section><p class="share-price">Kept two</p>{}</article>'
    out = "".join(f'<div class="{c}"><p>Gone</p></div>' for c in ("x ad", "ad-slot", "cookie-notice", "post-comments", "share", "related_posts", "social-links"))
    form = "<html><body><form action=x><p>All of</p><p>the page</p></form></body></html>"
    got = run(spark, [(1, "http://a/x", article.format(out), None), (2, "http://b/x", form, None)])
    assert got == {1: "Start\n\nKept one\n\nKept two", 2: "All of\n\nthe page"}


def test_edges(spark):
    rows = [(1, None, None, None), (2, None, "", None), (3, "no scheme", "plain", None), (None, "http://a/", "<p>x", None), (5, "http://a/b", "<p>x</p><div", None), (5, "http://a/b", "<p>x</p><div", None), (6, "http://l/", "<p>" + "long " * 100_000, None)]
    got = run(spark, rows)
    assert got[1] == got[2] == "" and got[3] == "plain" and got[6] == ("long " * 100_000).strip()
    assert run(spark, []) == {}


def test_the_test_table_keeps_whole_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_differencing_decides_which_marked_articles_are_template(spark):
    page = (
        "<main><article><h1>{0} title</h1><p>{0} body</p><p>Quoted by all</p></article></main>"
        "<article><p>Read our best stories</p><article><p>Teaser</p></article></article>"
    )
    plain = "<article><p>{0}</p><p>Quoted by all</p></article>"
    rows = [(i, f"http://h.example/p/{i}", page.format(f"text {i}"), None) for i in range(4)]
    rows += [(10 + i, f"http://p.example/p/{i}", plain.format(f"text {i}"), None) for i in range(3)]
    rows += [(20, "http://alone.example/", page.format("alone"), None)]
    # An article that only the nearest page quotes whole is no template; one without any line of its own stays too.
    quoted = "<article><p>{0}</p></article><article><p>From {1}</p></article>"
    rows += [(30 + i, f"http://q.example/p/{i}", quoted.format(f"text {i}", i // 2), None) for i in range(4)]
    rows += [(40, "http://s.example/a", "<article><p>a</p><p>b</p></article>", None), (41, "http://s.example/b", "<article><p>b</p></article>", None)]
    got = run(spark, rows)
    assert all(got[i] == f"text {i} title\n\ntext {i} body\n\nQuoted by all" for i in range(4))
    assert all(got[10 + i] == f"text {i}\n\nQuoted by all" for i in range(3))
    assert got[20] == "alone title\n\nalone body\n\nQuoted by all\n\nRead our best stories\n\nTeaser"
    assert got[31] == "text 1\n\nFrom 0" and got[32] == "text 2\n\nFrom 1"
    assert got[40] == "a\n\nb" and got[41] == "b"
