import datetime as dt
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gladwire import fixed
from gladwire.functions import dates, html, labels, text, urls


def test_hints_are_whole_words_in_any_case(spark, one):
    titles = ["Team WINS cup", "windy day", "Record High set", "record-high set", "  ", None, "won, hope!"]
    assert one(titles, "string", text.has_hint("v")) == [True, False, True, False, False, False, True]


def test_hint_counts_are_of_different_hints(spark, one):
    titles = ["win win wins", "c++ c++x", "émotion"]
    assert one(titles, "string", text.hint_hit_count("v", ["win", "wins", "c++", "motion"])) == [2, 1, 0]


def test_matched_hints_keep_the_list_order(spark, one):
    assert one(["hope and a win"], "string", text.matched_hints("v", ["win", "dead", "hope"])) == [["win", "hope"]]


def test_trim_takes_unicode_spaces(spark, one):
    spaced = ["\xa0 a b 　", "\x1fa\n", "", None, " "]
    assert one(spaced, "string", text.trim_title("v")) == [s.strip() if s is not None else None for s in spaced]


def test_word_count_and_short_texts_match_split(spark, one):
    texts = ["", " ", "a", "a\xa0b c", "w " * 29, "w " * 30, " w" * 30, "w " * 31]
    assert one(texts, "string", text.word_count("v")) == [len(t.split()) for t in texts]
    assert one(texts, "string", text.too_short("v")) == [len(t.split()) < 30 for t in texts]


def test_input_text_cuts_the_body(spark):
    frame = spark.createDataFrame([("t", "b" * 600), ("t", "b" * 500), ("t", ""), ("t", None)], "a string, b string")
    out = [r[0] for r in frame.select(text.input_text("a", "b")).collect()]
    assert out == ["t. " + "b" * 500, "t. " + "b" * 500, "t", "t"]


def test_lead_summary(spark, one):
    assert one(["..One.  Two!\nThree? Four."], "string", text.lead_summary("v")) == ["One. Two! Three?"]
    assert one(["w " * 200], "string", text.lead_summary("v")) == [("w " * 130).strip()]


@pytest.mark.parametrize(
    "written, moment",
    [
        ("Thu, 26 Mar 2026 10:00:00 +0000", "2026-03-26 10:00:00"),
        ("Thu, 26 Mar 2026 10:00:00 +0200", "2026-03-26 08:00:00"),
        ("26 Mar 2026 10:00:00 GMT", "2026-03-26 10:00:00"),
        ("Thu, 26 Mar 2026 10:00:00 EST", "2026-03-26 15:00:00"),
        ("Thu, 6 Mar 2026 10:00 Z", "2026-03-06 10:00:00"),
        ("2026-03-26T10:00:00+00:00", "2026-03-26 10:00:00"),
        ("2026-03-26T10:00:00-05:00", "2026-03-26 15:00:00"),
        ("2026-03-26", "2026-03-26 00:00:00"),
        ("soon", None), ("", None), (None, None), ("12:00", None), ("99 Mar 2026 10:00:00 GMT", None),
    ],
)
def test_feed_dates(spark, one, written, moment):
    assert one([written], "string", dates.format_datetime(dates.parse_feed_date("v"))) == [moment]


def test_iso_timestamp(spark, one):
    moment = dt.datetime(2026, 3, 26, 10, 0, 0, 123456, tzinfo=dt.timezone.utc)
    assert one([moment], "timestamp", dates.iso_timestamp("v")) == ["2026-03-26T10:00:00.123Z"]


def test_clean_url(spark, one):
    given = ["https://a.b/c?d#e", "https://a.b/c#e?d", "HTTPS://A.b/C?x", " http://a.b/c", "", None]
    assert one(given, "string", urls.clean_url("v")) == [
        "https://a.b/c", "https://a.b/c", "https://A.b/C", "http://a.b/c", "", None,
    ]


def test_reddit_domain_anywhere_counts(spark, one):
    given = ["https://www.reddit.com/r/x", "https://i.redd.it/x", "https://a.b/?ref=reddit.com", "https://a.b/"]
    assert one(given, "string", urls.is_reddit_internal("v")) == [True, True, True, False]


def test_favicon(spark, one):
    given = ["https://a.b:8/c?d", "not a url", "//a.b/c", "https:///x", None]
    assert one(given, "string", urls.favicon_url("v")) == ["https://a.b:8/favicon.ico", None, None, None, None]


RELATIVE = ["img.png", "../x.png", "/r.png?q=1#f", "./a/../b.png", "?q=2", "#f", "../../../x", "a//b", "x/..", ".", "a b.png", "q/./w", "data:image/x"]
BASES = ["https://h.org/a/b", "https://h.org", "http://h.org/d/", "https://h.org/a/b?z=1#y", "https://h.org/a/b/c/"]


def test_make_absolute_follows_the_url_rules(spark):
    pairs = [(u, b, urljoin(b, u)) for u in RELATIVE for b in BASES]
    frame = spark.createDataFrame(pairs, "u string, b string, want string")
    wrong = frame.withColumn("got", urls.make_absolute("u", "b")).filter("got <> want or got is null").collect()
    assert wrong == []


def test_make_absolute_of_schemeless_and_absolute(spark):
    frame = spark.createDataFrame([("//c.d/e",), ("http://x.y/z",)], "u string")
    got = [r[0] for r in frame.select(urls.make_absolute("u", F.lit("https://h.org/a"))).collect()]
    assert got == ["https://c.d/e", "http://x.y/z"]


PAGES = [
    ('<meta property="og:image" content="https://i/o.png"><meta name="twitter:image" content="https://i/t.png">', "https://i/o.png"),
    ('<meta name="twitter:image" content="https://i/t.png">', "https://i/t.png"),
    ("<META NAME='twitter:image:src' CONTENT='/s.png'>", "https://h.org/s.png"),
    ('<meta property="og:image" content=""><meta property="og:image" content="/second.png"><img src="/i.png">', "https://h.org/i.png"),
    ('<meta property="og:image"><img src=""><img src="data:image/gif,x"><img src="i.png">', "https://h.org/p/i.png"),
    ('<meta content="/x.png?a=1&amp;b=2" property="og:image" data-q="a>b">', "https://h.org/x.png?a=1&b=2"),
    ('<meta name="og:image" content="/n.png"><meta property="og:image" content="/p.png">', "https://h.org/p.png"),
    ('<!-- <img src="/no.png"> --><script>"<img src=/no.png>"</script>', "https://h.org/favicon.ico"),
    ('<img alt="src=/no.png" src="/yes.png">', "https://h.org/yes.png"),
    ('<metadata property="og:image" content="/no.png"><imgx src="/no.png">', "https://h.org/favicon.ico"),
    ("", "https://h.org/favicon.ico"), (None, "https://h.org/favicon.ico"),
]


def test_thumbnail_chain(spark):
    frame = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(PAGES)], "i int, h string")
    got = frame.orderBy("i").select(html.thumbnail("h", F.lit("https://h.org/p/q"))).collect()
    assert [r[0] for r in got] == [want for _, want in PAGES]


POSTS = [
    ('<shreddit-post content-href="https://a.b/c?x"></shreddit-post><a href="https://d.e/">x</a>', "https://a.b/c"),
    ('<shreddit-post content-href="https://i.redd.it/x"></shreddit-post><a href="https://d.e/?q">x</a>', "https://d.e/"),
    ('<a href="https://d.e/">early</a><div class="k" data-testid="post-content"><div><a href="/in">x</a></div>'
     '<a href="https://www.reddit.com/gallery/1">g</a><a href="https://f.g/#h">y</a></div>', "https://f.g/"),
    ('<a href="https://d.e/">early</a><div data-testid="post-content"><div>x</div></div><div><a href="https://late/">l</a></div>', "https://d.e/"),
    ('<a href="https://www.reddit.com/r/x">x</a><a href="/r/y">y</a><a>z</a>', None),
    ("", None), (None, None),
]


def test_reddit_page_link(spark):
    frame = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(POSTS)], "i int, h string")
    got = frame.orderBy("i").select(html.reddit_page_link("h")).collect()
    assert [r[0] for r in got] == [want for _, want in POSTS]


def test_reddit_entry_link_takes_blocks_in_order(spark):
    inner, outer = '<a href="https://redd.it/x">x</a>', '<a href="https://a.b/c?d">y</a>'
    frame = spark.createDataFrame([([inner, outer],), ([inner],), ([],), (None,)], "b array<string>")
    got = [r[0] for r in frame.select(html.reddit_entry_link("b")).collect()]
    assert got == ["https://a.b/c", None, None, None]


def test_categories(spark, one):
    given = ["Health", "arts-culture", "Human Interest", "Cats", "", None]
    assert one(given, "string", labels.canonical_category("v")) == [
        "Health", "Arts & Culture", "Community", "Cats", None, None,
    ]
    assert one(given, "string", labels.category_slug("v")) == [
        "health", None, "community", None, None, None,
    ]


def test_argmax_prefers_the_first_on_ties(spark):
    names = F.array(*[F.lit(n) for n in fixed.MODEL_TOPICS])
    frame = spark.createDataFrame(
        [([0.1, 0.2, 0.9, 0.9, 0.1, 0.1, 0.1, 0.95],), ([0.0] * 8,)], "p array<double>"
    ).withColumn("m", F.map_from_arrays(names, "p"))
    rows = frame.select(labels.argmax_label(labels.allowed_scores(F.col("m"), fixed.TOPICS)).alias("c"),
                        labels.allowed_scores(F.col("m"), ["x"]).alias("all")).collect()
    assert [r["c"] for r in rows] == ["Education", "Arts & Culture"]
    assert all(len(r["all"]) == 8 for r in rows)


def test_keys_do_not_depend_on_category_order(spark):
    frame = spark.createDataFrame([("t", "b")], "t string, b string")
    a, b = F.array(F.lit("x"), F.lit("y")), F.array(F.lit("y"), F.lit("x"))
    row = frame.select(labels.category_key("t", "b", a).alias("a"), labels.category_key("t", "b", b).alias("b"),
                       labels.category_key("b", "t", b).alias("c")).collect()[0]
    assert row["a"] == row["b"] != row["c"]
