"""Patterns and tokenizer: both must find the same wherever the patterns are trusted."""

import random

import pytest
from pyspark.sql import functions as F

from gladwire import fixed
from gladwire.functions import html, pages

PIECES = [
    '<meta property="og:image" content="/a.png">', "<META name='twitter:image' content=' /b.png '/>", "<meta property=og:image content=/c.png>",
    '<meta content="" property="og:image">', '<meta property="og:image" content="/caf&eacute;.png">', '<meta name="og:image" content="x">y">',
    '<img src="/i.gif">', "<img alt='a' src='/j.gif'/>", "<img src=/k.gif alt=x>", '<img src="data:image/gif;x">', '<img src="/cut.gif><b title="x">',
    '<img alt="say "so"" src="/l.gif">', "<img src>", '<a href="https://one.org/x?y=1#z">1</a>', "<a href='https://www.reddit.com/r/x'>r</a>",
    '<a class="c" href="https://two.org/&amp;q">2</a>', "<a>none</a>", '<a href="https://three.org/a&nbsp;b">3', "<!-- <img src=/no.gif> -->", "<!-- open",
    '<script>var a = "<img src=/no.gif>";</script>', "<style>a > b { }</style>", '<div data-testid="post-content" class="p">', "<div>", "</div>", "<section>",
    "</section>", "<p>", "</p>", "<br/>", '<shreddit-post content-href="https://el.org/x?y"></shreddit-post>', '<shreddit-post content-href="/r/x">',
    "plain &eacute; text < 3 > 2", 'text "quoted"', "<b title='it&#39;s'>b</b>", "<!DOCTYPE html>", "</ div>", "<img src='/m.gif' src='/n.gif'>",
]


def wanted(text):
    """Images and links by the tokenizer alone."""
    page = pages.page_of(text)
    image = None
    for name in fixed.IMAGE_META_NAMES:
        found = [m for m in page["metas"] if m["property"] == name] or [m for m in page["metas"] if m["name"] == name]
        image = image or ((found[0]["content"] or "").strip() or None if found else None)
    sources = [s.strip() for s in page["images"] if s.strip() and not s.strip().startswith("data:")]
    return image, sources[0] if sources else None, page["links"], page["content"], page["post"]


def test_patterns_are_trusted_only_where_they_agree(spark):
    rng = random.Random(5)
    texts = PIECES + ["".join(rng.choices(PIECES, k=rng.randint(2, 9))) for _ in range(1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, html string")
    body = html.markup("html")
    found = frame.select(
        "i", pages.is_doubtful("html").alias("doubtful"), html._named_image(html._metas(body)).alias("meta"),
        html._usable_image(html._images(body)).alias("image"), html.hrefs(body).alias("links"),
        F.coalesce(html.post_content_links(body), F.array()).alias("content"), html._post_target(body).alias("post"),
    ).collect()
    trusted = 0
    for r in found:
        if not r.doubtful:
            trusted += 1
            links = [[x for x in part if x is not None] for part in (r.links, r.content)]
            assert (r.meta, r.image, *links, r.post) == wanted(texts[r.i]), texts[r.i]
    assert trusted > 150 and sum(r.doubtful for r in found) > 500


def test_doubtful_pages_are_read_by_the_tokenizer(spark):
    texts = [
        ('<img src="/cut.gif><b title="x">', "https://a.org/cut.gif><b title="),
        ('<meta property="og:title" content="say "so""><meta property="og:image" content="/q.png">', "https://a.org/q.png"),
        ('<meta property="og:image" content="/&Eacute;&#x41;.png">', "https://a.org/ÉA.png"),
        ("<!-- never closed <img src='/no.gif'>", "https://a.org/favicon.ico"), ("", "https://a.org/favicon.ico"),
        (None, "https://a.org/favicon.ico"),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, html string")
    got = frame.select("i", html.thumbnail("html", F.lit("https://a.org/p")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [want for _, want in texts]


@pytest.mark.parametrize(("text", "content"), [
    ('<section><div data-testid="post-content"><p><a href="1"></section><a href="2">', ["1"]),
    ('<div data-testid="post-content"><div><a href="1"></div><a href="2"></div><a href="3">', ["1", "2"]),
    ('<div data-testid="post-content"><br><img src=x><a href="1"/><a href="2">', ["1", "2"]),
    ('<div data-testid="post-content"></b><a href="1"></div><div data-testid="post-content"><a href="2"></div>', ["1"]),
    ('<div data-testid="x"><a href="1"></div>', []),
])
def test_post_content_by_open_elements(text, content):
    assert pages.page_of(text)["content"] == content
