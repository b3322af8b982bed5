import html as python_html

from pyspark.sql import functions as F

from pagelens.functions import html
from pagelens.operators import extract


def visible(rows, *pages):
    df = rows(list(enumerate(pages)), "i int, html string")
    return [r.visible_text for r in html.with_visible_text(df).orderBy("i").collect()]


def test_decode(rows):
    df = rows([(bytearray(b"a\xffb"),), (bytearray("é".encode()),)], "p binary")
    assert [r.t for r in df.select(html.decode(F.col("p")).alias("t")).collect()] == ["a�b", "é"]


def test_split_payload(rows):
    data = [(0, "HTTP/1.1 200 OK\r\nServer: one\r\nSERVER:  two \r\nContent-Type: text/html\r\n\r\n<p>\r\n\r\nx"), (1, "no headers"),
            (2, "\r\n\r\nbody")]
    out = extract.split_payload(rows(data, "i int, payload string")).orderBy("i").collect()
    assert (out[0].content_type, out[0].server, out[0].html) == ("text/html", "two", "<p>\r\n\r\nx")
    assert (out[1].content_type, out[1].server, out[1].html) == ("", "", "no headers")
    assert out[2].html == "\r\n\r\nbody"


def test_is_xml(rows):
    pages = ["<?xml version='1'?>", " \n<rss>", "<html>", "x <?xml"]
    out = rows([(p,) for p in pages], "p string").select(html.is_xml(F.col("p")).alias("x")).collect()
    assert [r.x for r in out] == [True, True, False, False]


def test_title_and_description(rows):
    pages = [
        "<title lang=en> A &amp; B &eacute;&#233; </title><title>second</title>", "<p>none</p>",
        "<meta content='og' property='og:description'><meta name=\"description\" content=\"own\">",
        "<META PROPERTY=\"og:description\" CONTENT=\"only og\">", "<meta name=description content=bare>",
    ]
    df = rows(list(enumerate(pages)), "i int, html string")
    out = html.with_meta_description(html.with_title(df)).orderBy("i").collect()
    assert [r.title for r in out] == ["A & B éé", "", "", "", ""]
    assert [r.meta_description for r in out] == ["", "", "own", "only og", "bare"]


def test_entities_follow_python(rows):
    texts = ["&lt;b&gt; &amp;lt; &copy;2024", "&eacute;&#x41;&#66; AT&T &notanentity; &nbsp;x", "plain", "&amp;amp;copy;", "a & b",
             "&#8217;&#233; &#160;x &#54999;", "&#128;&#0150;&#55296;&#1;", "&apos;&Alpha;&thetasym;&", "&lt &amp", "&;&#;&&amp;;"]
    out = rows([(t,) for t in texts], "t string").select("t", html.decode_entities(F.col("t")).alias("d")).collect()
    for r in out:
        assert r.d == python_html.unescape(r.t)


def test_visible_text(rows):
    assert visible(
        rows,
        "<html><title>T</title><body><p>One<br>two</p><script>var t='</p>';</script><nav>menu</nav>three</body></html>",
        "a<!-- <p>hidden</p> -->b <style>p{}</style>c",
        "x <nav>out<nav>in</nav>still out</nav> y",
        "x <footer>never closed",
        "x <script>never closed <p>y</p>",
        '<a title="1 > 0">link</a> 3 < 4 &amp; 5',
        "<form>f</form><header>h</header><aside>a</aside>kept",
    ) == ["T One two three", "a b c", "x y", "x", "x", "link 3 < 4 & 5", "kept"]


def test_regular_pages_equal_the_parser(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html")
    for r in html.with_visible_text(df).collect():
        assert r.visible_text == html.visible_text_with_python(r.html)


def test_sentences(rows):
    texts = ["One. Two! Three?", "No end", "v1.2 is out. Yes.No", ""]
    out = rows([(t,) for t in texts], "t string").select(html.first_sentences(F.col("t")).alias("s")).collect()
    assert [r.s for r in out] == ["One. Two!", "No end", "v1.2 is out. Yes.No", ""]


def test_usable_and_rejected(rows):
    data = [("u", "t", "long enough text"), ("u", "", "long enough text"), ("u", "t", "ten chars."), ("", "t", "long enough text"),
            (None, None, None)]
    df = rows(data, "url string, title string, snippet string")
    assert extract.usable(df).count() == 1
    assert {r.reason: r.n for r in extract.rejected_count(df).collect()} == {"no title": 1, "short snippet": 1, "no url": 2}


def test_xml_pages_are_dropped_unless_wanted(rows):
    page = "<?xml version='1'?><title>A feed</title><p>With a body of some length.</p>"
    df = rows([("http://x/", page)], "url string, html string")
    assert extract.with_page_parts(df).count() == 0
    assert extract.with_page_parts(df, keep_xml=True).first().title == "A feed"


def test_cap_is_exact_for_a_hot_domain(spark):
    df = spark.range(5000).select(F.lit(1).alias("warc_file"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
                                  .alias("domain"), F.col("id").alias("record_no")).repartition(7)
    out = extract.cap_per_domain(df, 100)
    hot = sorted(r.record_no for r in out.filter("domain = 'hot'").collect())
    assert hot == [3 * i for i in range(100)]
    assert out.count() == 100 + 5000 - 1667


def test_unclosed_hidden_elements_take_linear_time(spark):
    import time
    page = "<p>before</p>" + "<nav>menu <b>" * 20_000
    nested = "<nav>a<nav>b</nav>c</nav>d<form>e</form><header><form>f</form></header>g"
    df = spark.createDataFrame([(page,), (nested,)], "html string")
    html.with_visible_text(df.limit(0), "html", "t").collect()
    start = time.time()
    found = [r.t for r in html.with_visible_text(df, "html", "t").collect()]
    assert found == ["before", "d g"] and time.time() - start < 20
