"""Golden rows for URL host, publish time and the HTML extractors."""

import pytest

from inkwell.functions import fields, html

URLS = [
    ("https://www.bbc.co.uk/news?x=1#f", "bbc.co.uk"),
    ("http://user:pw@www.h.com:8080/a", "user:pw@h.com:8080"),
    ("example.com/x", ""),
    ("//cdn.www.x.org/p", "cdn.x.org"),
    ("http://[bad/x", None),
    ("HTTP://WWW.Up.com/", "WWW.Up.com"),
    ("http://awww.com/", "acom"),
    ("mailto:a@b.c", ""),
    ("", ""),
    ("http://h.com?x=1", "h.com"),
    ("  http://www.t.com/\tx", "t.com"),
]


def test_source_host(spark):
    df = spark.createDataFrame(URLS, "url string, expected string")
    for r in df.select(fields.source_host("url").alias("h"), "expected").collect():
        assert r["h"] == r["expected"]


TIMES = [("201708240000", "2017-08-24T00:00:00"), ("20170824000", ""), ("garbage", ""),
         ("201713240000", ""), ("201708242460", ""), ("", ""), (None, ""), ("202402291230", "2024-02-29T12:30:00")]


def test_publish_time(spark):
    df = spark.createDataFrame(TIMES, "ts string, expected string")
    for r in df.select(fields.publish_time("ts").alias("p"), "expected").collect():
        assert r["p"] == r["expected"]


PAGES = [
    ("<html><body><nav>menu</nav><article><h1>T &amp; U</h1><p>one</p><p>two &lt;x&gt;</p></article>"
     "<p>outside</p></body></html>", True, "T & U one two <x>", "one two <x> outside"),
    ("<html><body><p>a</p><p>b &quot;q&quot; &#39;s&#39;&nbsp;</p></body></html>", False, "", "a b \"q\" 's'"),
    ("<body><article><script>var t='</p>';</script><style>p{}</style><!-- c --><p>x</p></article></body>",
     True, "x", "x"),
    ("<body><div><p>open one<p>open two</div><p>closed</p></body>", False, "", "open one open two closed"),
    ("<body></body>", False, "", ""),
]


@pytest.mark.parametrize("page,has,art,para", PAGES)
def test_html_text(spark, page, has, art, para):
    df = spark.createDataFrame([(page,)], "h string")
    r = df.select(html.has_article("h").alias("a"), html.article_text("h").alias("t"),
                  html.paragraph_text("h").alias("p")).first()
    assert (r["a"], r["t"], r["p"]) == (has, art, para)


@pytest.mark.parametrize("page,img", [
    ('<head><meta property="og:image" content="http://i/1.png"></head>', "http://i/1.png"),
    ("<head><meta content='http://i/2.png' property='og:image'/></head>", "http://i/2.png"),
    ('<head><meta property="og:image"></head>', ""),
    ('<head><meta property="og:title" content="x"></head>', ""),
    ('<head><meta property="og:image" content="a&amp;b"></head>', "a&b"),
])
def test_main_image(spark, page, img):
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(html.main_image("h")).first()[0] == img


@pytest.mark.parametrize("raw,text", [
    ("&#8217;s &#x27;q&#X27; &eacute;", "\u2019s 'q' \u00e9"), ("&amp;lt; &amp;#39;", "&lt; &#39;"),
    ("a & b &unknown; &#", "a & b &unknown; &#"), ("&#0; &#xD800; &#1114112; &#99999999999;", "\ufffd " * 3 + "\ufffd"),
    ("&#128512;&#65", "\U0001F600A"), ("", ""), (None, None)])
def test_character_references(spark, raw, text):
    assert spark.createDataFrame([(raw,)], "h string").select(html.unescape("h")).first()[0] == text


def test_article_tag_is_matched_by_its_whole_name(spark):
    df = spark.createDataFrame([("<article-card>x</article-card><p>y</p>",)], "h string")
    assert tuple(df.select(html.has_article("h"), html.main_text("h")).first()) == (False, "y")
