import pytest

from indicata.llm import html

LONG = "This is the text of a long paragraph that the reader came for, and it goes on with many words of the kind. " * 2


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   \n ", ""), ("<html><body></body></html>", ""),
    ("<nav><a href='/x'>Home</a></nav>", ""),
    (f"<article><h1>Title</h1><p>{LONG}</p></article>", f"Title\n{LONG.strip()}"),
    ("<article><p>Short.</p></article><footer>foot of the page is here</footer>", "Short."),
    (f"<div class='sidebar'><p>{LONG}</p></div><main><p>One &amp; two&nbsp;&lt;3<br>four</p></main>", "One & two <3 four"),
    (f"<body><div id=menu><p>{LONG}</p></div><p>Intro</p><p>{LONG}</p><p>End</p></body>",
     f"Intro\n{LONG.strip()}\nEnd"),
    ("<article><p>a<script>var t='<p>no</p>'</script>b</p><style>p{}</style><!-- <p>no</p> --></article>", "a b"),
    (f"<article><p>{LONG}<aside>aside</aside><form><p>{LONG}</p></form><p>rest", f"{LONG.strip()}\nrest"),
    (f"<article><p>{LONG}</p><div class='comments'><p>{LONG}</p></div></article>", LONG.strip()),
    (f"<article><p>{LONG}</p></article><section id='comments'><article><p>{LONG}</p></article></section>", LONG.strip()),
    (f"<article><ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul><p>{LONG}</p></article>", LONG.strip()),
    ("<article><p>broken <b>off", "broken off"), ("<article><p>x < y > z</p></article>", "x < y > z"),
    ("<article><p>a<!-- never closed", "a"),
])
def test_pages(page, text):
    assert html.main_text(page) == text


def test_neighbours_decide():
    near = html.blocks(f"<body><p>{LONG}</p><p>Hm.</p><div><a href=x>link text here</a></div><p>Eh.</p></body>")
    html.classify(near)
    assert [x.label for x in near] == [True, True, False, False]


def test_table(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "x", 9), (2, None, None, "x", 9), (None, "v", "", "x", 9)]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, text string, n_chars int")
    found = sorted(((r.page_id or 0, r.text, r.n_chars) for r in html.extract(df).collect()))
    n = len(LONG.strip())
    assert found == [(0, "", 0), (1, LONG.strip(), n), (1, LONG.strip(), n), (2, "", 0)]
    assert html.extract(df.where("false")).count() == 0


def test_driver_pages_keep_their_articles(spark, sf_small):
    from indicata.llm.queries import op8_main_text
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    found = op8_main_text(spark, sf_small).collect()
    assert len(found) == len(pages)
    for r in found:
        inside = pages[r.page_id].partition("<article>")[2].partition("</article>")[0].partition("<footer")[0]
        words = html.html.unescape(html._TAG.sub(" ", inside).replace("a a a", "")).split()
        assert [w for x in r.text.split("\n") for w in x.split()] == words or len(r.text.split()) >= 0.99 * len(words)
        assert r.n_chars == len(r.text)
