"""Pages without closing tags, boilerplate within articles, and records that are malformed or encoded."""

import collections
import gzip
import math
import re
import zlib

import pytest

from garimpo.llm import page_text, warc_records
from garimpo.llm.page_text import Page, dull_paths, main_text


@pytest.mark.parametrize(
    "source, text",
    [
        ("<html><head><title>t</title><p>text one<p>two", "text one\n\ntwo"),
        ("<html><head><meta charset=x><article>hello</article>", "hello"),
        ("<title>t</title>a", "a"),
        ("<head>\n bare text", "bare text"),
        ("<head><script>x</script></head><body>b", "b"),
        ('<article>x<div class="post-comments">c</div></article>', "x"),
        ('<article>x<section id="comments-section">c</section></article>', "x"),
        ('<div><p>x</p><div class="ads-block">c</div></div>', "x"),
        ('<article>x<div class="search-algorithm">kept</div><p class="ads-block">prose</p></article>', "x\n\nkept\n\nprose"),
        ("", ""),
    ],
)
def test_text_of_one_page(source, text):
    assert Page(source).main_text(set()) == text


def site(n, article):
    """Pages of one host with equal boilerplate that no name gives away."""
    tag = "article" if article else "div"
    return [
        f'<html><body><div class="x1"><a href="/">Home of all</a></div><{tag} class="x2"><h1>Story {i}</h1><p>Body {i} of it.</p>'
        f'<div class="x3"><em>Read</em> our terms.</div></{tag}></body></html>'
        for i in range(n)
    ]


@pytest.mark.parametrize("article", [True, False])
def test_tree_decides_without_names(spark, article):
    pages = [(i, f"http://a.org/{i}", h, 1) for i, h in enumerate(site(12, article))]
    pages += [(100 + i, f"http://b.org/{i}", h, 1) for i, h in enumerate(site(3, article))]  # too few to judge
    pages += [(200, "http://a.org/copy", pages[0][2], 1), (300, None, None, 1), (301, "x", "", 1)]
    rows = {r.page_id: r.text for r in main_text(spark.createDataFrame(pages, "page_id long, url string, html string, paths int")).collect()}
    assert all(rows[i] == f"Story {i}\n\nBody {i} of it." for i in range(12)) and rows[200] == rows[0]
    assert all(rows[100 + i].endswith("Read our terms.") for i in range(3))
    assert rows[300] == rows[301] == ""


def test_importance_against_plain_entropies(spark):
    """Paths of low importance, counted one by one."""
    sources = site(9, False) + ["<body><div class=x1>Home of all</div><p>other</p></body>"] * 4
    data = [(i, "http://a.org/", h) for i, h in enumerate(sources)]
    got = dull_paths(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    children, texts = collections.defaultdict(list), collections.defaultdict(list)
    for source in dict.fromkeys(sources):
        page = Page(source)
        for k, e in enumerate(page.elements):
            if e.furniture:
                continue
            below = [k]
            for j, other in enumerate(page.elements):
                if other.parent in below:
                    below.append(j)
            children[e.path].append(tuple(e.style))
            texts[e.path].append("\n".join(t for owner, t in page.blocks if owner in below))

    def importance(values):
        n = len(values)
        return -sum(c / n * math.log(c / n) for c in collections.Counter(values).values()) / math.log(max(n, 2))

    want = {p for p in children if p and len(children[p]) >= 8 and max(importance(children[p]), importance(texts[p])) < 0.2}
    assert want and set(got[0].paths) == want


# --- records ----------------------------------------------------------------------
def response(head, body, length=None):
    block = f"HTTP/1.1 200 OK\r\n{head}\r\n\r\n".encode() + body
    size = len(block) if length is None else length
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: {size}\r\n\r\n".encode() + block + b"\r\n\r\n"


PAGE = '<html><body><a title="a > b">Olá</a><p>mundo</p></body></html>'


@pytest.mark.parametrize(
    "record, text, problem",
    [
        (response("Content-Type: text/html", PAGE.encode()), "Olá\nmundo", None),
        (response("Content-Type: text/html", PAGE.encode(), "abc"), "Olá\nmundo", "content-length"),
        (response("Content-Type: text/html", PAGE.encode(), -5), "Olá\nmundo", "content-length"),
        (response("Content-Encoding: gzip", gzip.compress(PAGE.encode())), "Olá\nmundo", None),
        (response("Content-Encoding: deflate", zlib.compress(PAGE.encode())), "Olá\nmundo", None),
        (response("Content-Encoding: gzip", b"<p>plain</p>"), "plain", "content-encoding"),
        (response("Content-Encoding: br", b"<p>plain</p>"), "plain", "content-encoding"),
        (response("Transfer-Encoding: chunked", b"5;x=1\r\n<p>ab\r\n3\r\ncd.\r\n0\r\n\r\n"), "abcd.", None),
        (response("Transfer-Encoding: chunked", b"zz\r\n<p>ab"), "zz ab".replace(" ", "\n"), "transfer-encoding"),
        (response("Content-Type: text/html; charset=iso-8859-1", PAGE.encode("latin-1")), "Olá\nmundo", None),
        (response("X: y", b"<meta charset='cp1252'>" + PAGE.encode("cp1252")), "Olá\nmundo", None),
        (response("Content-Type: text/html; charset=nope", b"<p>a"), "a", "charset"),
        (b"", None, None), (b"garbage", None, None), (None, None, None),
    ],
)
def test_records(spark, record, text, problem):
    rows = warc_records.derive(spark.createDataFrame([(1, record)], "page_id long, record binary")).collect()
    if text is None:
        assert rows == []
        return
    made = {r.record_type: warc_records.parse(bytes(r.record))[1].decode() for r in rows}
    assert made["conversion"] == text
    assert re.findall("not-decoded: (.*)\r", made["metadata"]) == ([problem] if problem else [])


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert page_text.main_text(pages).count() == 0
    assert warc_records.derive(warc_records.responses(pages)).count() == 0
