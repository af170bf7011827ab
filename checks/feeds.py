"""Feed documents. Every document is a feed, its lines are the items."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import Tables, minutes_after_epoch, stamp
from gladwire.functions import html
from gladwire.functions.dates import format_datetime
from gladwire.operators import articles as article_ops
from gladwire.session import new_folder
from gladwire.sources import archive, feeds, registry

def _date() -> Column:
    return F.date_format(minutes_after_epoch(F.col("n_chars")), "d MMM yyyy HH:mm:ss")


def _escaped(text: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def _link(i: Column) -> Column:
    """Address of a line; short documents and their first lines share one."""
    return F.concat(F.lit("https://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string"),
                    F.lit("/"), i.cast("string"), F.lit("?utm=1"))


_SQL_LINK = "'https://' || source || '.example.org/' || doc_id || '/' || pos"
_TITLE = r"regexp_replace(line, '^\s+|\s+$', '', 'g')"


def _feed(t: Tables, item, head: str, tail: str, broken: Column | None = None) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), item)
    xml = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>' + head), F.array_join(lines, ""), F.lit(tail))
    if broken is not None:
        xml = F.when(broken, F.substr(xml, F.lit(1), F.length(xml) - len(tail) - 9)).otherwise(xml)
    return t.read("documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("source_id"), "lang", xml.alias("xml")
    )


def rss(t: Tables, extra=None, broken: Column | None = None) -> DataFrame:
    def item(line: Column, i: Column) -> Column:
        more = F.lit("") if extra is None else extra(line, i)
        return F.concat(
            F.lit("<item><title>"), _escaped(line), F.lit("</title><link>"), _link(i),
            F.lit("</link><pubDate>Mon, "), _date(), F.lit(" +0100</pubDate>"), more, F.lit("</item>"),
        )

    return _feed(t, item, '<rss version="2.0"><channel><title>t</title>', "</channel></rss>", broken)


def atom(t: Tables) -> DataFrame:
    def item(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit('<entry><title type="text">'), _escaped(line), F.lit('</title><link rel="self" href="x"/><link href="'),
            _link(i), F.lit('"/><updated>'),
            F.date_format(minutes_after_epoch(F.col("n_chars")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
            F.lit("</updated></entry>"),
        )

    return _feed(t, item, '<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>', "</feed>")


def _shown(entries: DataFrame) -> DataFrame:
    return article_ops.with_published(entries).select(
        F.col("source_id").cast("long").alias("doc_id"), "pos",
        F.coalesce("title", F.lit("")).alias("title"), "link",
        format_datetime("published_at").alias("published_at"),
    )


_MOMENT = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(n_chars)"


@check("feed_entries_rss", f"""
    SELECT doc_id, pos, {_TITLE} AS title, {_SQL_LINK} || '?utm=1' AS link,
           {stamp(_MOMENT + " - INTERVAL 1 HOUR")} AS published_at
    FROM v_lines WHERE lang <> 'es'""")
def feed_entries_rss(t: Tables) -> DataFrame:
    return _shown(feeds.feed_entries(rss(t, broken=F.col("lang") == "es")))


@check("feed_entries_atom", f"""
    SELECT doc_id, pos, {_TITLE} AS title, {_SQL_LINK} || '?utm=1' AS link, {stamp(_MOMENT)} AS published_at
    FROM v_lines""")
def feed_entries_atom(t: Tables) -> DataFrame:
    return _shown(feeds.feed_entries(atom(t)))


def _entries(t: Tables) -> DataFrame:
    lines = t.read("documents").select(
        "doc_id", "source", "lang", "n_chars", F.posexplode(F.split("text", "\n")).alias("pos", "title")
    )
    return lines.withColumn("link", _link(F.col("pos")))


@check("entry_validity", f"""
    SELECT doc_id, pos, {_TITLE} AS title FROM v_lines WHERE length({_TITLE}) > 0 AND pos > 0""")
def entry_validity(t: Tables) -> DataFrame:
    rows = _entries(t).withColumns(
        {"title": F.concat(F.lit(" "), "title"), "link": F.when(F.col("pos") > 0, F.col("link")).otherwise("")}
    )
    return article_ops.valid_entries(rows).select("doc_id", "pos", "title")


@check("rss_projection", f"""
    SELECT doc_id, pos, {_SQL_LINK} || '?utm=1' AS rss_link, {_SQL_LINK} || '?utm=1' AS source_url,
           {_SQL_LINK} AS original_url, {_SQL_LINK} AS url, {_SQL_LINK} AS external_url FROM v_lines""")
def rss_projection(t: Tables) -> DataFrame:
    return article_ops.rss_articles(_entries(t)).select(
        "doc_id", "pos", "rss_link", "source_url", "original_url", "url", "external_url"
    )


@check("reddit_projection", f"""
    SELECT doc_id, pos, post AS rss_link, CASE WHEN lang = 'fr' THEN post ELSE ext END AS source_url,
           post AS original_url, CASE WHEN lang = 'fr' THEN post ELSE ext END AS url,
           CASE WHEN lang <> 'fr' THEN ext END AS external_url
    FROM (SELECT *, {_SQL_LINK} || '?utm=1' AS post, 'https://out.example.org/' || pos AS ext FROM v_lines)""")
def reddit_projection(t: Tables) -> DataFrame:
    found = F.concat(F.lit("https://out.example.org/"), F.col("pos").cast("string"))
    rows = _entries(t).withColumn("external", F.when(F.col("lang") != "fr", found))
    return article_ops.reddit_articles(rows).select(
        "doc_id", "pos", "rss_link", "source_url", "original_url", "url", "external_url"
    )


def _post_blocks(line: Column, i: Column) -> Column:
    """Item content: French posts name an outside link, German ones only in the description."""
    number = F.concat(F.col("doc_id").cast("string"), F.lit("/"), i.cast("string"))
    inner = F.lit('<a href="https://www.reddit.com/r/x">in</a>')
    outer = F.concat(F.lit('<a href="https://out.example.org/'), number, F.lit('?x=1">out</a>'))
    content = F.when(F.col("lang") == "fr", F.concat(inner, outer)).otherwise(inner)
    description = F.when(F.col("lang") == "de", outer).otherwise(inner)
    return F.concat(
        F.lit("<content:encoded><![CDATA["), content, F.lit("]]></content:encoded><description>"),
        _escaped(description), F.lit("</description>"),
    )


_OUT = "'https://out.example.org/' || doc_id || '/' || pos"


@check("reddit_entry_link", f"""
    SELECT doc_id, pos, CASE WHEN lang IN ('fr', 'de') THEN {_OUT} END AS link FROM v_lines""")
def reddit_entry_link(t: Tables) -> DataFrame:
    entries = feeds.feed_entries(rss(t, _post_blocks))
    return entries.select(
        F.col("source_id").cast("long").alias("doc_id"), "pos",
        html.reddit_entry_link(feeds.entry_blocks()).alias("link"),
    )


@check("entry_content_join", """
    SELECT v.doc_id, v.pos, w.line AS block
    FROM v_lines v JOIN (SELECT doc_id, length(line) AS n, max(pos) AS last FROM v_lines GROUP BY ALL) m
         ON m.doc_id = v.doc_id AND m.n = length(v.line)
    JOIN v_lines w ON w.doc_id = v.doc_id AND w.pos = m.last""")
def entry_content_join(t: Tables) -> DataFrame:
    # lines of equal length in a document share one link, with different queries
    link = F.concat(F.lit("https://x.example.org/"), F.length("title").cast("string"), F.lit("?p="), F.col("pos").cast("string"))
    rows = _entries(t).select(
        F.col("doc_id").alias("source_id"), "pos", link.alias("link"),
        F.array(F.concat(F.lit("c:"), "title")).alias("content_html"),
        F.lit(None).cast("string").alias("summary"), F.lit("").alias("description"),
    )
    joined = feeds.with_entry_blocks(rows.select("source_id", "pos", "link"), rows)
    block = F.substr(F.get("blocks", F.lit(0)), F.lit(3))
    return joined.select(F.col("source_id").alias("doc_id"), "pos", block.alias("block"))


@check("post_page_join", """
    SELECT page_id, CASE WHEN contains(url, '/fr/') THEN md5(html) END AS page FROM pages""")
def post_page_join(t: Tables) -> DataFrame:
    pages = t.read("pages")
    posts = pages.select(
        "page_id", F.col("url").alias("link"),
        F.when(~F.col("url").contains("/fr/"), F.col("url")).alias("external"),
    )
    joined = feeds.with_page_html(posts, pages.select("url", "html"))
    return joined.select("page_id", F.md5(F.col("page_html").cast("binary")).alias("page"))


def _registry(t: Tables) -> DataFrame:
    """Every document is a source: Spanish ones have no address, French ones their own threshold."""
    lang = F.col("lang")
    return t.read("documents").select(
        F.col("doc_id").cast("string").alias("source_id"), F.col("doc_id").alias("source_ord"), "lang",
        F.when(lang != "es", F.concat(F.lit("https://x.example.org/"), F.col("doc_id").cast("string"))).alias("rss_url"),
        F.when(lang == "de", "reddit").when(lang == "fr", "unheard-of").alias("adapter"),
        F.when(lang == "fr", 0.9).alias("threshold"),
    )


@check("skip_sources_without_feed", "SELECT doc_id AS source_ord FROM documents WHERE lang <> 'es'")
def skip_sources_without_feed(t: Tables) -> DataFrame:
    return registry.with_feed_address(_registry(t)).select("source_ord")


@check("crawl_union", f"""
    SELECT doc_id AS source_ord, pos, {_TITLE} AS title,
           CASE lang WHEN 'de' THEN {_OUT} ELSE {_SQL_LINK} END AS url,
           CASE lang WHEN 'fr' THEN 0.9::DOUBLE ELSE 0.75::DOUBLE END AS threshold,
           {stamp(_MOMENT + " - INTERVAL 1 HOUR")} AS published_at
    FROM v_lines WHERE lang <> 'es' AND length({_TITLE}) > 0""")
def crawl_union(t: Tables) -> DataFrame:
    """Every feed comes in two copies; the one by content lacks the items."""
    whole = rss(t, _post_blocks).select("source_id", F.lit("url").alias("copy"), "xml")
    empty = whole.select("source_id", F.lit("content").alias("copy"), F.lit("<rss><channel></channel></rss>").alias("xml"))
    done = feeds.crawl(whole.unionByName(empty), _registry(t).drop("lang"), limit=1_000_000)
    return done.select(
        "source_ord", "pos", "title", "url", "threshold", format_datetime("published_at").alias("published_at")
    )


@check("custom_source", f"""
    SELECT doc_id, pos, CASE lang WHEN 'fr' THEN 'mirror:' || {_SQL_LINK} || '?utm=1' ELSE {_SQL_LINK} END AS url
    FROM v_lines""")
def custom_source(t: Tables) -> DataFrame:
    def mirror(posts: DataFrame, entries: DataFrame) -> DataFrame:
        return posts.withColumn("url", F.concat(F.lit("mirror:"), "link"))

    adapter = F.when(F.col("lang") == "fr", "mirror").when(F.col("lang") == "de", "unheard-of")
    rows = _entries(t).withColumn("adapter", registry.adapter_of(adapter))
    adapters = {"rss": feeds.default_adapters()["rss"], "mirror": mirror}
    return feeds.route(rows, rows, adapters).select("doc_id", "pos", "url")


@check("custom_source_format", f"""
    SELECT doc_id, pos, {_TITLE} AS title, {_SQL_LINK} || '?utm=1' AS link,
           {stamp(_MOMENT + " - INTERVAL 1 HOUR")} AS published_at
    FROM v_lines WHERE lang <> 'es'""")
def custom_source_format(t: Tables) -> DataFrame:
    """Feeds written as an archive and read through the data source."""
    path = new_folder(t.spark, "archive")
    archive.write_archive(rss(t, broken=F.col("lang") == "es"), path)
    archive.register(t.spark)
    return _shown(feeds.feed_entries(t.spark.read.format(archive.FORMAT).load(path).drop("file")))


@check("custom_source_stream", f"""
    SELECT doc_id, pos, {_TITLE} AS title, {_SQL_LINK} || '?utm=1' AS link, {stamp(_MOMENT)} AS published_at
    FROM v_lines""")
def custom_source_stream(t: Tables) -> DataFrame:
    """Feeds that arrive in an archive in two parts, one before and one after the stream has begun."""
    path, sink = new_folder(t.spark, "archive"), new_folder(t.spark, "entries")
    whole, early = atom(t), F.pmod(F.xxhash64("source_id"), F.lit(2)) == 0
    archive.write_archive(whole.filter(early), path)
    stream = archive.register(t.spark).readStream.format(archive.FORMAT).load(path).drop("file")
    entries = feeds.feed_entries(stream)
    query = (
        entries.writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", new_folder(t.spark, "checkpoint")).start()
    )
    try:
        query.processAllAvailable()
        archive.write_archive(whole.filter(~early), path)
        query.processAllAvailable()
    finally:
        query.stop()
    return _shown(t.spark.read.schema(entries.schema).parquet(sink))
