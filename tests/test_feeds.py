import pytest
from pyspark.sql import functions as F

from gladwire.functions.dates import format_datetime
from gladwire.operators import limits
from gladwire.sources import feeds, registry

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>
<item><title> First &amp; best </title><link>https://a.org/1?utm=x#y</link><pubDate>Thu, 26 Mar 2026 10:00:00 +0000</pubDate><description>d</description></item>
<item><title>No link</title></item>
<item><link>https://a.org/untitled</link></item>
<item><title><![CDATA[Third <b>]]></title><link>https://a.org/3</link><content:encoded><![CDATA[<a href="https://out.org/x?q">o</a>]]></content:encoded></item>
</channel></rss>"""

ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>r/x</title><link href="https://www.reddit.com/.rss" rel="self"/>
<entry><title>Post one</title><link href="https://www.reddit.com/r/x/1/"/><updated>2026-03-26T10:00:00+00:00</updated>
<content type="html">&lt;a href="https://out.org/a?b"&gt;l&lt;/a&gt;</content></entry>
<entry><title>Post two</title><link rel="self" href="x"/><link rel="alternate" href="https://www.reddit.com/r/x/2/?s=1"/><updated>2026-03-26T09:00:00+02:00</updated></entry>
<entry><title>Post three</title><link href="https://www.reddit.com/r/x/3/"/><published>2026-03-25T09:00:00Z</published><updated>2026-03-26T09:00:00Z</updated></entry>
</feed>"""

EMPTY = "<?xml version='1.0'?><rss version='2.0'><channel><title>Empty</title></channel></rss>"
BROKEN = "<?xml this is no xml\n<rss><channel><title>Broken <TAG attr=\"open\n<item><title>x"


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(
        [("a", RSS), ("r", ATOM), ("e", EMPTY), ("b", BROKEN), ("n", None), ("off", RSS)], "source_id string, xml string"
    )


@pytest.fixture
def sources(spark):
    return spark.createDataFrame(
        [("a", 0, "https://a.org/rss", None, None), ("r", 1, "https://r.org/rss", "Reddit", 0.9), ("e", 2, "x", None, None),
         ("b", 3, "x", "NaN", None), ("n", 4, "x", "", None), ("off", 5, None, None, None)],
        "source_id string, source_ord int, rss_url string, adapter string, threshold double",
    )


def test_entries_of_both_kinds(spark, documents):
    got = feeds.feed_entries(documents.filter("source_id <> 'off'")).orderBy("source_id", "pos").collect()
    assert [(r.source_id, r.pos, r.link) for r in got] == [
        ("a", 0, "https://a.org/1?utm=x#y"), ("a", 1, None), ("a", 2, "https://a.org/untitled"), ("a", 3, "https://a.org/3"),
        ("r", 0, "https://www.reddit.com/r/x/1/"), ("r", 1, "https://www.reddit.com/r/x/2/?s=1"), ("r", 2, "https://www.reddit.com/r/x/3/"),
    ]
    assert got[0].title.strip() == "First & best" and got[3].title == "Third <b>"


def test_crawl(spark, documents, sources):
    pages = spark.createDataFrame(
        [("https://www.reddit.com/r/x/2/?s=1", '<div data-testid="post-content"><a href="https://page.org/p?q">p</a></div>')],
        "url string, html string",
    )
    got = feeds.crawl(documents, sources, pages=pages).orderBy("seq").collect()
    assert [(r.source_id, r.title, r.url, r.threshold) for r in got] == [
        ("a", "First & best", "https://a.org/1", 0.75), ("a", "Third <b>", "https://a.org/3", 0.75),
        ("r", "Post one", "https://out.org/a", 0.9), ("r", "Post two", "https://page.org/p", 0.9),
        ("r", "Post three", "https://www.reddit.com/r/x/3/", 0.9),
    ]
    assert [str(r.published_at) for r in got] == [
        "2026-03-26 10:00:00", "None", "2026-03-26 10:00:00", "2026-03-26 07:00:00", "2026-03-25 09:00:00",
    ]
    assert got[0].rss_link == got[0].source_url == "https://a.org/1?utm=x#y"
    assert got[2].original_url == "https://www.reddit.com/r/x/1/" and got[4].external_url is None


def test_limit_counts_invalid_entries(spark, documents, sources):
    got = feeds.crawl(documents, sources, limit=3).orderBy("seq").collect()
    assert [r.title for r in got] == ["First & best", "Post one", "Post two", "Post three"]


def test_cap_over_all_sources(spark, documents, sources):
    got = feeds.crawl(documents, sources, limit=50, cap=4).orderBy("seq").collect()
    assert [r.title for r in got] == ["First & best", "Third <b>", "Post one", "Post two"]


def test_snapshots_of_one_feed(spark):
    copies = spark.createDataFrame([("a", "url", EMPTY), ("a", "content", RSS), ("b", "url", ATOM), ("b", "content", ATOM)], "source_id string, copy string, xml string")
    best = limits.richer_snapshot(feeds.parse_feeds(copies).drop("xml"), F.col("copy") == "url")
    assert {r.source_id: (r.copy, len(r.entries)) for r in best.collect()} == {"a": ("content", 4), "b": ("url", 3)}


def test_own_adapter(spark, documents, sources):
    adapters = {**feeds.default_adapters(), "reddit": lambda posts, entries: posts.withColumn("url", F.lit("mine"))}
    got = feeds.crawl(documents, sources, adapters=adapters)
    assert {r.url for r in got.filter("source_id = 'r'").collect()} == {"mine"}


RECORDS = [
    ('{"name":"A","source_id":"a","rss_url":"u","threshold":1,"active":true,"adapter":"rss"}', []),
    ('{"name":"B","rss_url":null}', ["Source[1] B: missing source_id"]),
    ('{"threshold":"0.5"}', ["Source[2] ?: missing name, source_id, rss_url", "Source[2] ?: threshold is not a number"]),
    ('{"name":"C","source_id":"c","rss_url":"u","threshold":1.5,"active":1,"adapter":"gopher"}',
     ["Source[3] C: threshold is not between 0 and 1", "Source[3] C: active is not true or false", "Source[3] C: adapter is unknown"]),
    ('[1]', ["Source[4] is not a record"]),
    ('{"name":"D","source_id":"d","rss_url":"u","threshold":true,"active":null,"adapter":null}', []),
    ('{"name":"E","source_id":"e","rss_url":"u","threshold":-0.1}', ["Source[6] E: threshold is not between 0 and 1"]),
]


def test_all_registry_problems_are_reported(spark):
    raw = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(RECORDS)], "ord int, record string")
    got = sorted(r.problem for r in registry.registry_problems(raw).collect())
    want = sorted(p for _, problems in RECORDS for p in problems)
    assert got == want
    with pytest.raises(registry.RegistryError) as caught:
        registry.validate_registry(raw)
    assert f"{len(want)} problems" in str(caught.value)
    assert sorted(r.problem for r in caught.value.report.collect()) == want


def test_load_registry(spark, tmp_path):
    path = tmp_path / "sources.json"
    path.write_text('{"sources": [{"name":"A","source_id":"a","rss_url":"u","active":true,"threshold":0.9},'
                    '{"name":"B","source_id":"b","rss_url":"u","active":false},'
                    '{"name":"C","source_id":"c","rss_url":"u"},'
                    '{"name":"D","source_id":"d","rss_url":null,"active":true}]}')
    got = registry.load_registry(spark, str(path)).collect()
    assert [(r.source_ord, r.source_id, r.threshold) for r in got] == [(0, "a", 0.9)]
    path.write_text('{"sources": [{"name":"A","source_id":"a","rss_url":"u"},{"name":"B","source_id":"b","rss_url":"u"}]}')
    assert registry.load_registry(spark, str(path)).count() == 2
    path.write_text('{"other": []}')
    assert registry.load_registry(spark, str(path)).count() == 0
    assert registry.load_registry(spark, str(tmp_path / "missing.json")).count() == 0


def test_seed_rows_treat_an_absent_flag_as_active(spark):
    raw = spark.createDataFrame([(0, '{"source_id":"a","name":"A"}'), (1, '{"source_id":"b","name":"B","active":false}'), (2, '{"name":"C"}')], "ord int, record string")
    got = registry.seed_rows(registry.parse_registry(raw)).orderBy("seq").collect()
    assert [(r.source_id, r.active) for r in got] == [("a", True), ("b", False)]


def test_dates_shift_to_utc(spark):
    frame = spark.createDataFrame([("26 Mar 2026 10:00:00 +0200", None), ("bad", "2026-03-26T01:00:00Z")], "published string, updated string")
    from gladwire.operators.articles import with_published

    got = [r[0] for r in with_published(frame).select(format_datetime("published_at")).collect()]
    assert got == ["2026-03-26 08:00:00", "2026-03-26 01:00:00"]
