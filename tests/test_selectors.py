"""Article selectors against a stdlib-parser walk: comments, scripts and quoted values hide nothing and show nothing."""

import random
from html.parser import HTMLParser

from newsflow.operators.extract import with_article


class Walk(HTMLParser):
    """Title, content paragraphs and meta date of the first live elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.pieces, self.meta, self.in_p = {}, {}, "", False

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        classes = (attrs.get("class") or "").split()
        if tag == "meta" and attrs.get("property") == "article:published_time":
            self.meta = self.meta or attrs["content"]
        for name, own, css in (("title", "h1", "article__title"), ("content", "div", "article-content")):
            if name in self.open and self.open[name] and tag == own:
                self.open[name] += 1
            elif tag == own and css in classes and name not in self.open:
                self.open[name], self.pieces[name] = 1, []
        if tag == "p" and self.open.get("content"):
            self.pieces["content"].append("")
            self.in_p = True

    def handle_endtag(self, tag):
        for name, own in (("title", "h1"), ("content", "div")):
            if tag == own and self.open.get(name):
                self.open[name] -= 1
        self.in_p = self.in_p and tag != "p"

    def handle_data(self, data):
        if self.open.get("title"):
            self.pieces["title"].append(data.strip())
        if self.open.get("content") and self.in_p and self.cdata_elem is None:
            self.pieces["content"][-1] += data.strip()

    def result(self):
        title = "".join(self.pieces["title"]) if "title" in self.pieces else "Unknown Title"
        return title, "\n\n".join(self.pieces.get("content", [])), self.meta


def extracted(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    rows = with_article(df).orderBy("i").collect()
    return [(r.page_title, r.content, r.published_raw) for r in rows]


def test_hidden_and_quoted_markup(spark):
    new = '<h1 class="article__title">New</h1>'
    pages = [
        f'<!-- <h1 class="article__title">Old</h1> -->{new}',
        f"<script>var a = '<h1 class=\"article__title\">JS</h1>';</script>{new}",
        '<div class="article-content"><!-- </div> --><p>kept</p></div>',
        '<div class="article-content"><script>x="</div>"</script><p>kept</p></div>',
        '<h1 data-x="a>b" class="article__title">New</h1>',
        "<div data-x='a>b' class='wide article-content'><p title=\"c>d\">kept</p></div>",
        '<!-- <meta property="article:published_time" content="2020-01-01"> --><meta property="article:published_time" content="2021-02-03">',
        '<h1 data-x=" class=article__title ">No</h1>' + new,
        "<h1 class=article__title>Plain</h1>",
    ]
    got = extracted(spark, pages)
    assert [g[0] for g in got] == ["New", "New", "Unknown Title", "Unknown Title", "New", "Unknown Title", "Unknown Title", "New", "Plain"]
    assert [g[1] for g in got[2:6]] == ["kept", "kept", "", "kept"]
    assert got[6][2] == "2021-02-03"


def test_random_nestings(spark):
    rng = random.Random(7)
    noise = [
        '<!-- <h1 class="article__title">x</h1></div> -->', "<script>'</div><h1 class=\"article__title\">'</script>", "<b>word</b>",
        '<i data-q="a>b">it</i>', "plain", '<div class="inner"><p>deep</p></div>', "<style>p > a {}</style>", "<p title='x>y'>para</p>",
    ]
    pages = []
    for _ in range(60):
        pick = lambda n: "".join(rng.choice(noise) for _ in range(rng.randrange(n)))
        quoted = rng.choice(["", ' data-x="1>0"', " id='a'"])
        pages.append(
            f'<html>{pick(4)}<h1{quoted} class="big article__title">T{rng.randrange(9)}</h1>'
            f'<div{quoted} class="article-content">{pick(6)}<p>end</p></div>{pick(3)}</html>'
        )
    want = []
    for page in pages:
        walk = Walk()
        walk.feed(page)
        walk.close()
        want.append(walk.result())
    assert extracted(spark, pages) == want


def test_long_and_hostile_tags(spark):
    many = " ".join(f'd{i}="{i}>"' for i in range(20_000))
    pages = [f'<h1 {many} class="article__title">T</h1>', "<h1 " + "x " * 200_000, '<div class="' * 20_000, "<!--" * 50_000, None, ""]
    got = extracted(spark, pages)
    assert [g[0] for g in got] == ["T"] + ["Unknown Title"] * 5
