import html
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import html_extract as hx
from corpusprep.llm.queries import QUERIES
from tests.llm.frames import CLASHES


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    draw = random.Random(1)
    for i in range(600):
        monkeypatch.setattr(hx, "ALIGN_CELLS", draw.choice([4, 10**9]))
        a, b = (draw.choices("abc" if i % 2 else "abcdefghij", k=draw.randint(0, 14)) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                table[x + 1][y + 1] = table[x][y] + 1 if a[x] == b[y] else max(table[x][y + 1], table[x + 1][y])
        shared = hx.shared_lines(a, b)
        rest = iter(b)
        assert len(shared) == table[-1][-1] and sorted(set(shared)) == shared and all(a[k] in rest for k in shared)


MAIN = {
    "plain text": "plain text",
    "<p>a &amp; b &lt;c&gt; &eacute;&#233;&nbsp;x</p>": "a & b <c> éé x",
    "<article><h1>T</h1><p>one<p>two <b>bold</b>\n text<br>more</article><p>out": "T\none\ntwo bold text more",
    "<nav><p>menu</nav><main><p>in</p><aside>side</aside></main><footer>f</footer>": "in",
    "<div class='ad'>buy</div><article><p>x</p><div class=\"comments\"><p>me too</div><p>y</article>": "x\ny",
    "<article><header><h1>Title</h1><p>by me</p></header><p>x</article>": "Title\nx",
    "<script>var a='<p>no</p>';</script><style>p{}</style><p>yes": "yes",
    "<!-- <p>no --><p>yes<!-- open": "yes",
    "<p>a<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>": "a\none\ntwo\n1 2\n3",
    "<div class=cookie-notice>c<article><p>text</article></div>": "text",
    "<div id='sidebar'><p>s</div><p hidden>h</p><p>ok</p>": "ok",
    "<p>1 < 2 and <b>3</b": "1 < 2 and 3</b",
    "<form><p>q<input name=x></form><p>rest": "rest",
    "": "",
    "<title>only</title>": "",
}


@pytest.mark.parametrize("page", MAIN)
def test_main_text(page):
    lines, kinds = hx.lines_of(page)
    best = max([1, *kinds])
    assert "\n".join(x for x, k in zip(lines, kinds) if k == best) == MAIN[page]


OWN = {
    "<article><p>text</article><div id='comments'><article class='comment'><p>me</article></div>": "text",
    "<p>text</p><div id='comments'><article class='comment'><p>me</article></div>": "text",
    "<article><p>text<div id=comments><article><p>me</article></div></article>": "text",
    "<article><p>text</article><aside><div><article><p>teaser</article></div></aside>": "text",
    "<aside><div><article><p>teaser</article></div></aside><article><p>text</article>": "text",
    "<form><div>menu</div><article><header><h1>T</h1><p>by</header><p>text</article></form>": "T\ntext",
    "<nav><p>menu<article><p>text</article>": "text",
    "<nav><article><p>teaser</article></nav><p>text": "text",
}


@pytest.mark.parametrize("page", OWN)
def test_articles_in_dropped_elements(page):
    lines, kinds = hx.lines_of(page)
    best = max([1, *kinds])
    assert "\n".join(x for x, k in zip(lines, kinds) if k == best) == OWN[page]


def test_differencing_where_markup_leaves_a_choice(spark):
    several = "<article><p>own {0}</article><article><p>teaser</article>"
    dropped = "<form><div>Menu</div><div>text {0}</div></form>"
    rows = [(i, f"http://s/{i}", several.format(i)) for i in (1, 2)] + [(i, f"http://d/{i}", dropped.format(i)) for i in (3, 4)]
    rows += [(5, "http://alone/", dropped.format(5))]
    got = {r["page_id"]: r["text"] for r in hx.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "own 1", 2: "own 2", 3: "text 3", 4: "text 4", 5: ""}


def page(*lines):
    return "<body>" + "".join(f"<div>{x}</div>" for x in lines)


PAGES = [
    (1, "http://h/a/1", page("Home", "text of one", "Imprint")),
    (2, "http://h/a/2", page("Home", "text of two", "second", "Imprint")),
    (3, "http://h/b/1", page("Start", "text of three", "Imprint")),
    (4, "http://other/a/1", page("Home", "text of four", "Imprint")),  # alone on its host
    (5, "http://copy/1", page("same", "lines")),
    (6, "http://copy/2", page("same", "lines")),
    (7, "http://art/1", "<article><p>quoted</p><p>own 7</p></article><div>Menu</div>"),
    (8, "http://art/2", "<article><p>quoted</p><p>own 8</p></article><div>Menu</div>"),
    (9, None, page("Home", "no address")),
    (10, None, None),
    (11, "http://h/a/1", ""),
    (None, "http://h/z", page("Start", "no id", "Imprint")),
    (1, "http://h/a/1", page("Home", "text of one", "Imprint")),
    (1, "http://h/a/1", page("other page of the same id")),
    (12, "http://long/1", page(*[f"line {i}" for i in range(5000)])),
    (13, "http://long/2", page(*[f"line {i}" for i in range(0, 5000, 2)], "end")),
]
SCHEMA = "page_id bigint, url string, html string"


@pytest.mark.parametrize("block", [1, 2, 500])
def test_differencing(spark, monkeypatch, block):
    monkeypatch.setattr(hx, "BLOCK", block)
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES}).repartition(4)
    rows = hx.extract(pages)
    assert rows.columns == [*pages.columns, "text", "n_chars", "n_shared"]
    text = {}
    for r in rows.collect():
        text.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert len([t for v in text.values() for t in v]) == len(PAGES)
    assert text[2] in (["text of two\nsecond"], ["Home\ntext of two\nsecond\nImprint"])
    assert text[4] == ["Home\ntext of four\nImprint"]
    assert text[5] == text[6] == ["same\nlines"]  # a copy says nothing about what belongs to the site
    assert (text[7], text[8]) == (["quoted\nown 7"], ["quoted\nown 8"])  # the article is the text
    assert text[10] == text[11] == [""]
    assert len(text[1]) == 3 and "other page of the same id" in text[1]
    assert text[12][0].split("\n") == [f"line {i}" for i in range(1, 5000, 2)] and text[13] == ["end"]
    assert hx.extract(pages.where("false")).count() == 0


def test_neighbours_do_not_depend_on_partitions(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    results = []
    for parts, block in ((1, 500), (9, 3)):
        hx.BLOCK, before = block, hx.BLOCK
        try:
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            results.append(sorted((r["id"], r["shared"]) for r in hx.shared_with_nearest(pages.repartition(parts)).collect()))
        finally:
            hx.BLOCK = before
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] and results[0]


def test_query_gives_the_articles(spark, data):
    def article(source):
        inside = re.search(r"<article>(.*)</article>", source, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"<(?:p|/p|h1|/h1|br)>", inside))
        return "\n".join(b for b in blocks if b)

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = QUERIES["op10_html_extraction"](spark, data).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert (row["url"], row["text"]) == (pages[row["page_id"]]["url"], article(pages[row["page_id"]]["html"]))
