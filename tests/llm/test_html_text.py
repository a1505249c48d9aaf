import pytest
from pyspark.sql import functions as F

from quotemill.llm import html_text

PAGES = "page_id bigint, url string, html string, host string, slot string, constant string"


def page(n, body=None, extra=""):
    return (
        f'<!DOCTYPE html><html><head><title>t{n}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
        f'<div class="top-menu"><ul><li>Home</li><li>News {n}</li></ul></div><p>Read our rules before you write</p>'
        f'<div id="page"><div class="body"><h1>Title {n}</h1>{body or f"<p>First &amp; {n}<br>line<p>Second <b>b</b>  {n} of a long enough text"}</div></div>'
        f'{extra}<div class="site-footer">&copy; {n}</div></body></html>'
    )


def run(spark, rows):
    frame = spark.createDataFrame([(*row, "h", "s", "c") for row in rows], PAGES)
    return html_text.extract_text(frame)


def test_template_of_a_host_without_marks(spark):
    rows = [(n, f"http://a.example/{n}", page(n)) for n in range(8)]
    frame = run(spark, rows)
    assert frame.columns == [*PAGES.replace(" bigint", "").replace(" string", "").split(", "), "text"]
    for r in frame.collect():
        n = r.page_id
        assert r.text == f"Title {n}\nFirst & {n} line\nSecond b {n} of a long enough text"


def test_copies_of_an_article_are_no_template(spark):
    article = "<article><h1>Same</h1><p>Same text</p></article>"
    rows = [(n, "http://b.example/x", f"<body><nav>menu</nav>{article}<footer>f{n % 2}</footer></body>") for n in range(9)]
    assert {r.text for r in run(spark, rows).collect()} == {"Same\nSame text"}


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "http://c.example/", ""), (3, "no url", "plain &lt;text&gt;"), (None, "http://c.example/", "<p>x"),
        (5, "http://c.example/5", "<p>y</p><script>never closed <p>z"), (5, "http://c.example/5", "<p>y</p><script>never closed <p>z"),
        (6, "http://d.example/", "<article><p>" + "long " * 100_000 + "</p></article>"),
    ]
    got = run(spark, rows).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert (text[1], text[2], text[3], text[None], text[5]) == ("", "", "plain <text>", "x", "y")
    assert text[6] == ("long " * 100_000).strip()
    assert run(spark, []).collect() == []


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article>a<header>by h</header><aside>no</aside><p>b</article><p>out", "a\nby h\nb"),
        ("<main><h1>t</h1><form>f<input></form><div class='comments'><p>c</div>p</main>", "t\np"),
        ("<body class='has-sidebar'><div class='with-sidebar'><p>in</div><div class=sidebar>out</div>", "in"),
        ("<div class='cookie-notice'>no</div><p>a<!-- <p>c --> b<p>&#x41;&eacute;&nbsp;c", "a b\nAé c"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
        ("<p>1 < 2 <b title='>'>x</b><p hidden>no<p>end", "1 < 2 x\nend"),
    ],
)
def test_pages_on_their_own(html, text):
    assert html_text.main_text(html, None, frozenset()) == text


def test_classes_of_a_template(spark):
    rows = [(f"http://e.example/{n}", page(n)) for n in range(6)]
    frame = spark.createDataFrame(rows, "url string, html string").withColumn("host", html_text.host_of(F.col("url")))
    template, slots = html_text.deduce_templates(frame)
    assert slots.count() == 1
    # Elements and the fixed runs occur once in each page: one class.
    assert template.where("pages = 6").select("class").distinct().count() == 1
    assert template.where("NOT run AND pages != 6").count() == 0


def test_hosts(spark):
    urls = ["http://A.example/x", "https://u@b.example:80/", None, "x", "ftp://c.d?e"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string").select(html_text.host_of(F.col("u")).alias("h"))
    assert [r.h for r in frame.collect()] == ["a.example", "b.example", "", "", "c.d"]
