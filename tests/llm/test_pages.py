"""Main text of pages: against a plain reading of the given pages, and page differencing on small sites."""

from html.parser import HTMLParser

import pytest
from hypothesis import given
from hypothesis import strategies as st

from logquarry.llm import pages

SKIPPED = {"nav", "footer", "aside", "form", "script", "style", "head", "header"}


class Reader(HTMLParser):
    """A second reading of plain pages: blocks inside the article element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.part, self.inside, self.skipped = [], [], 0, 0

    def end(self):
        text = " ".join("".join(self.part).split())
        if text:
            self.blocks.append(text)
        self.part = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside += 1
        if tag in SKIPPED or ("class", "ad") in attrs:
            self.skipped += 1
        if tag in ("p", "h1", "h2", "li", "div", "article"):
            self.end()
        if tag == "br":
            self.part.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "li", "div", "article"):
            self.end()
        if tag in SKIPPED or tag == "div":  # the only divs of these pages are adverts
            self.skipped -= 1
        if tag == "article":
            self.inside -= 1

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.part.append(data)


def read_plainly(page):
    reader = Reader()
    reader.feed(page)
    reader.close()
    reader.end()
    return "\n\n".join(reader.blocks)


def shown(page):
    found = pages.lines(page)
    return [line.text for line, c in zip(found, pages.candidates(found)) if c]


SF = "/root/testdata/sf0.001"


def test_given_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in pages.op11_extract_text(spark, SF).collect()}
    assert len(got) == rows.count()
    for row in rows.collect():
        text = read_plainly(row["html"])
        assert got[row["page_id"]]["text"] == text and got[row["page_id"]]["n_chars"] == len(text)
        assert got[row["page_id"]]["url"] == row["url"]


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []),
        ("plain &lt;text&gt; &amp; more", ["plain <text> & more"]),
        ("<article><p>a\n\t b<br>c<p>d<b>e</b>f</article><footer>x</footer>", ["a b c", "def"]),
        ("<body><div class='main-nav'>menu</div><article><header><h1>T</h1><p>by x</p></header><p>a</p></article>", ["T", "a"]),
        ("<main><div id='cookie-banner'>ok?</div><div>text</div><form>send</form></main><div>other</div>", ["text"]),
        ("<article>a<section id=comments><article class=comment>c</article></section>b</article>", ["a", "b"]),
        ("<aside><article>teaser</article></aside><div class='has-sidebar'>text</div>", ["text"]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes", ["yes"]),
        ("<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>yes</p>", ["yes"]),
        ("<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></table>", ["1 2", "3"]),
        ("<article><p>cut &am</article", ["cut &am"]),
        ("<p>1 < 2 and <a title='a > b'>3</a>", ["1 < 2 and 3"]),
        ("<ul><li>a<li>b</ul><p class=ad>no<p>yes", ["a", "b", "yes"]),
        ("<article>t<div role=search>no</div><div class='share-buttons'>no</div></article>", ["t"]),
    ],
)
def test_blocks(page, texts):
    assert shown(page) == texts


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40), st.sampled_from([16, 1 << 27]))
def test_alignment(a, b, bits):
    before, pages.LINE_BITS = pages.LINE_BITS, bits
    try:
        at = pages.common_lines(a, b)
    finally:
        pages.LINE_BITS = before
    assert at == sorted(set(at)) and len(at) == longest(a, b)
    rest = iter(b)
    assert all(x in rest for x in (a[i] for i in at))


def site(host, n, own):
    menu = "".join(f"<div>{x}</div>" for x in ("Start", "News", "About us"))
    return f"http://{host}/news/{n}", f"{menu}<div>{own}</div><div>Imprint</div>"


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, k1 int, lines int")
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.main_text(df).collect()}


def test_shared_lines_go(spark):
    rows = [(n, *site("a.example", n, f"only on {n}"), "x", "y", 1, 2) for n in range(40)]
    rows += [(100, *site("b.example", 1, "alone on its host"), None, None, None, None)]
    rows += [(101, None, "<div>Start</div>", None, None, None, None), (102, "http://a.example/news/7", None, None, None, None, None)]
    rows += [(103, "http://c.example/1", "<article>same</article>", None, None, None, None)]
    rows += [(104, "http://c.example/2", "<article>same</article><div>Start</div>", None, None, None, None)]
    got = texts(spark, rows)
    assert {n: got[n] for n in range(40)} == {n: (f"only on {n}", len(f"only on {n}")) for n in range(40)}
    assert got[100] == ("Start\n\nNews\n\nAbout us\n\nalone on its host\n\nImprint", 49)
    assert got[101] == ("Start", 5) and got[102] == ("", 0)
    assert got[103] == got[104] == ("same", 4)


def test_copies_on_one_host_are_one_page(spark):
    copy = site("a.example", 0, "copied")[1]
    rows = [(n, f"http://a.example/x/{n}", copy, None, None, None, None) for n in range(300)]
    rows += [(500, *site("a.example", 5, "other"), None, None, None, None)] * 2
    got = texts(spark, rows)
    assert {got[n][0] for n in range(300)} == {"copied"} and got[500][0] == "other"


def test_nearest_by_path(spark):
    rows = [(1, "http://h.example/a/1", "<p>left menu</p><p>one</p>"), (2, "http://h.example/a/2", "<p>left menu</p><p>two</p>")]
    rows += [(3, "http://h.example/b/1", "<p>right menu</p><p>two</p>"), (4, "http://h.example/b/2", "<p>right menu</p><p>four</p>")]
    got = texts(spark, [(*r, None, None, None, None) for r in rows])
    assert {k: v[0] for k, v in got.items()} == {1: "one", 2: "two", 3: "two", 4: "four"}
    assert pages.nearness("/a/2", "/a/1") > pages.nearness("/a/2", "/b/1")


def test_empty_table_and_odd_rows(spark):
    assert texts(spark, []) == {}
    rows = [(None, "http://a.example/", "<p>x &#xD800; &nbsp; y", None, None, None, None)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, k1 int, lines int")
    assert [tuple(r) for r in pages.main_text(df).collect()] == [(None, "http://a.example/", "x � y", 5)] * 2


def test_long_pages():
    many = "".join(f"<div>{i % 7}</div>" for i in range(30_000))
    found = pages.lines(many)
    assert len(found) == 30_000
    hashes = [hash(x.text) for x in found]
    assert len(pages.common_lines(hashes, hashes[1:])) == 29_999
    word = "x" * 2_000_000
    assert shown(f"<article>{word}</article>") == [word]
    assert len(shown("<b>" * 50_000 + "t")) == 1
