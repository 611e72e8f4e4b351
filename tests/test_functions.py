import datetime as dt
import hashlib
import html
import html.parser
import random
from urllib.parse import urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from newsflow.functions import text, times, urls
from newsflow.operators.extract import with_article

RUN = dt.datetime(2026, 1, 2, 3, 4, 5)


def apply(spark, values, build, kind="string"):
    """Values of ``build(col)`` in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    out = rows.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in out]


def std_normalize(url):
    p = urlparse(url)
    return urlunparse((p.scheme.lower(), p.netloc.lower(), p.path, p.params, p.query, ""))


@pytest.mark.parametrize(
    "title,expected",
    [
        ("Lamp maker opens AI lab", True),
        ("A course in machine learning for gardeners", True),
        ("Why LLMs forget names", True),
        ("Compiler notes for spring", False),
        ("Maintain your bicycle chain", False),
        ("Artificial Intelligence meets weather maps", True),
        ("Training neural networks on a phone", True),
        ("Counting with GPT-2", True),
        ("Tax rules for generative AI", True),
        ("Letters to OpenAI", True),
        ("Rainfall in the alps", False),
        ("AI, again", False),
        ("ai-powered", False),
        ("no ai\u2028here", True),
        ("", False),
        (None, False),
    ],
)
def test_topic(spark, title, expected):
    assert apply(spark, [title], text.is_topic) == [expected]


def test_normalize_known(spark):
    cases = {
        "https://Example.com/Foo?utm_source=bar": "https://example.com/Foo?utm_source=bar",
        "HTTPS://A.COM:80/p;x?y=1#f": "https://a.com:80/p;x?y=1",
        "http://a.com/b?": "http://a.com/b",
        "http://a.com/b;": "http://a.com/b",
        "http://a.com/b;?q=1": "http://a.com/b?q=1",
        "http://a.com/b;x;": "http://a.com/b;x;",
        "http://a.com/?a;": "http://a.com/?a;",
        "http://a.com/b;/c": "http://a.com/b;/c",
        "http://a.com/b;/c;": "http://a.com/b;/c",
        "http://a.com;": "http://a.com;",
        "http://A.com#x": "http://a.com",
        "//Host/p": "//host/p",
        "mailto:X@Y.com": "mailto:X@Y.com",
        "ftp://B.com/x;": "ftp://b.com/x",
        "http://u:P@H.com/Q?a=%2F#z?y": "http://u:p@h.com/Q?a=%2F",
        "no-scheme/Path;": "no-scheme/Path",
        "  http://A.com/x ": "http://a.com/x ",
        "\thttp://A.com/\ny": "http://a.com/y",
        "": "",
    }
    assert apply(spark, cases, urls.normalize_url) == list(cases.values())


def test_normalize_equals_standard_library(spark):
    rng = random.Random(7)
    heads = ["http:", "HTTPS:", "ftp:", "foo:", "mailto:", "", "a b:", "1x:", "svn+ssh:"]
    auths = ["//", "//Host.COM", "//u:P@H:8", "", "/", "///", "//h;x"]
    bits = ["/", ";", "?", "#", "A", "b=C", ".", "%2F", "é", "\n", " ", ":", "&", "//", "\u2028"]
    urls_in = {
        rng.choice(heads) + rng.choice(auths) + "".join(rng.choices(bits, k=rng.randrange(7)))
        for _ in range(3000)
    }
    cases = {}
    for u in urls_in:
        try:
            cases[u] = std_normalize(u)
        except ValueError:
            pass
    got = apply(spark, cases, urls.normalize_url)
    wrong = [(u, w, g) for (u, w), g in zip(cases.items(), got) if w != g]
    assert not wrong, wrong[:10]


def test_canonical_key(spark):
    want = hashlib.sha256(b"https://example.com/article").hexdigest()
    assert apply(spark, ["HTTPS://Example.com/article#top"], urls.canonical_key) == [want]


def test_url_checks(spark):
    cases = {
        "http://a.com": (True, True),
        "https://": (True, False),
        "ftp://b.com": (False, True),
        "HTTP://c.com": (False, True),
        "//host/p": (False, False),
        "plain": (False, False),
        "": (False, False),
        None: (False, False),
    }
    assert apply(spark, cases, urls.is_http_url) == [a for a, _ in cases.values()]
    assert apply(spark, cases, urls.is_well_formed_url) == [b for _, b in cases.values()]


PAGES = [
    "<p>Hello <b>you</b></p>",
    "<!DOCTYPE html><title>T</title><style>p{}</style><script>var a='</p>';</script><p>x &amp;lt; y",
    "a<!-- no <p>this</p> -->b  c   d\t\te\n\n f ",
    "AT&T &euro;5 &copy &#8212; &#x41; &nbsp; end",
    '<a title="1 > 0" href=x>link</a>',
    "<p class=it's>odd</p> 2 < 3 and 4 > 3",
    "one\x1ctwo\u2028three  four   five",
    "<script>open ended <p>never</p>",
    "<scripted>kept</scripted>",
    "",
    None,
]


class _Text(html.parser.HTMLParser):
    """Text outside script and style, a line end for each tag and comment; for comparison."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.pieces.append("\n")
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.pieces.append("\n")
        self.skip -= tag in ("script", "style")

    def handle_comment(self, data):
        self.pieces.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.pieces.append(data)


def std_text(page):
    if page is None:
        return None
    parser = _Text()
    parser.feed(page)
    parser.close()
    lines = (line.strip() for line in "".join(parser.pieces).splitlines())
    return "\n".join(c for line in lines for c in (p.strip() for p in line.split("  ")) if c)


def test_html_to_text(spark):
    got = apply(spark, PAGES, text.html_to_text)
    assert got == [std_text(p) for p in PAGES]
    assert got[1] == "T\nx &lt; y"


def test_html_to_text_on_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.select("html", text.html_to_text(F.col("html")).alias("t")).collect()
    assert [r.t for r in rows] == [std_text(r.html) for r in rows]


def test_strip_join(spark):
    assert apply(
        spark,
        ["Hello <b>you</b>", " a <i> b &nbsp;</i>\n<br> c d ", "x<!-- y -->z", "<p></p>", None],
        text.strip_join,
    ) == ["Helloyou", "abc d", "xz", "", None]


def articles(spark, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return with_article(rows).orderBy("i").collect()


def test_article(spark):
    page = (
        '<h1 class="big article__title x"> The <em>Title</em></h1>'
        '<div class="article-content-wide"><p>not this</p></div>'
        '<div id=a class="pre article-content"><div><p> one </p></div>gap<P>two <b>bold</b>'
        "<p></p><pre>gone? no</pre></div><p>outside</p>"
    )
    entry = "<div class='entry-content'><p>fallback &amp; more</p><script>'<p>no</p>'</script></div>"
    empty_title, empty_block = "<h1 class=article__title></h1><p>none</p>", "<div class=article-content>"
    got = articles(spark, [page, entry, empty_title, empty_block, None])
    assert [r.page_title for r in got] == ["TheTitle", "Unknown Title", "", "Unknown Title", "Unknown Title"]
    assert [r.content for r in got] == ["one\n\ntwobold\n\n", "fallback & more", "", "", ""]


def test_long_runs_stay_linear(spark):
    nasty = ["\t" * 200_000, "<p " + "a" * 200_000, "<div>" * 20_000, "&" * 100_000, "<!--" * 50_000]
    for value in nasty:
        apply(spark, [value], text.html_to_text)
        articles(spark, ["<div class='article-content'>" + value])


def test_meta_published(spark):
    pages = [
        '<meta property="article:published_time" content="2024-05-01T10:00:00+02:00">',
        "<meta content='May 1, 2024' property='article:published_time'/>",
        '<meta property="article:published_time" content="soon">',
        '<meta property="og:title" content="x">',
        '<meta property="article:published_time" content="">',
    ]
    raw = apply(spark, pages, text.meta_published)
    assert raw == ["2024-05-01T10:00:00+02:00", "May 1, 2024", "soon", "", ""]
    got = apply(spark, raw, lambda c: times.parse_page_date(c, RUN).cast("string"))
    assert got == ["2024-05-01 08:00:00", "2024-05-01 00:00:00", None] + ["2026-01-02 03:04:05"] * 2


def test_dates(spark):
    got = apply(
        spark,
        [
            "Tue, 05 Mar 2024 10:11:12 +0100",
            "5 Mar 2024 10:11:12 GMT",
            "2024-03-05T10:11:12Z",
            "Tuesday, March 5, 2024",
            "rubbish",
            None,
        ],
        lambda c: times.parse_page_date(F.coalesce(c, F.lit("?")), RUN).cast("string"),
    )
    assert got == [
        "2024-03-05 09:11:12",
        "2024-03-05 10:11:12",
        "2024-03-05 10:11:12",
        "2024-03-05 00:00:00",
        None,
        None,
    ]
    assert apply(spark, ["Tue, 05 Mar 2024 10:11:12 +0100"], lambda c: times.parse_feed_date(c).cast("string")) == [
        "2024-03-05 09:11:12"
    ]


def test_epoch_and_iso(spark):
    got = apply(spark, [0, 1_700_000_000, None], lambda c: times.isoformat(times.epoch_to_utc(c, RUN)), "long")
    assert got == ["1970-01-01T00:00:00", "2023-11-14T22:13:20", "2026-01-02T03:04:05"]
    stamps = ["2024-01-01 00:00:00.000120", "2024-01-01 00:00:00.5", "2024-01-01 00:00:00"]
    got = apply(spark, stamps, lambda c: times.isoformat(c.cast("timestamp")))
    assert got == ["2024-01-01T00:00:00.000120", "2024-01-01T00:00:00.500000", "2024-01-01T00:00:00"]
