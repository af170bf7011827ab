"""Feed documents as rows of entries, and entries as articles."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gladwire import fixed
from gladwire.functions.html import reddit_entry_link, reddit_page_link, reddit_page_link_or_post
from gladwire.functions.text import non_empty
from gladwire.functions.urls import clean_url, is_reddit_internal
from gladwire.operators.articles import (
    drop_unresolved_posts, is_valid_entry, reddit_articles, rss_articles, valid_entries, with_published,
)
from gladwire.operators.enrich import one_page_per_url
from gladwire.operators.limits import global_cap, richer_snapshot
from gladwire.sources.registry import adapter_of, with_feed_address

_ITEM = (
    "struct<title:string, link:array<string>, pubDate:string, `dc:date`:string, "
    "description:string, `content:encoded`:array<string>>"
)
_ENTRY = (
    "struct<title:string, link:array<struct<_href:string,_rel:string>>, published:string, "
    "updated:string, summary:string, content:array<string>>"
)
# One shape for both kinds of feed; the half that a document lacks is null.
_FEED = f"channel struct<item:array<{_ITEM}>>, entry array<{_ENTRY}>"

ENTRY_COLUMNS = (
    "title", "link", "published", "updated", "content_html", "summary", "description",
)


def _rss_entry(item: Column) -> Column:
    return F.struct(
        item["title"].alias("title"),
        F.get(item["link"], F.lit(0)).alias("link"),
        item["pubDate"].alias("published"),
        item["dc:date"].alias("updated"),
        item["content:encoded"].alias("content_html"),
        item["description"].alias("summary"),
        item["description"].alias("description"),
    )


def _atom_entry(entry: Column) -> Column:
    alternate = F.filter(
        entry["link"], lambda k: k["_rel"].isNull() | (k["_rel"] == "alternate")
    )
    return F.struct(
        entry["title"].alias("title"),
        F.get(alternate, F.lit(0))["_href"].alias("link"),
        entry["published"].alias("published"),
        entry["updated"].alias("updated"),
        entry["content"].alias("content_html"),
        entry["summary"].alias("summary"),
        F.lit(None).cast("string").alias("description"),
    )


def parse_feeds(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """Add ``entries``: the items of each feed document in order; empty for broken ones."""
    parsed = F.from_xml(xml, _FEED, {"mode": "PERMISSIVE"})
    empty = F.array().cast(T.ArrayType(_entry_type()))
    return feeds.withColumn("_feed", parsed).withColumn(
        "entries",
        F.coalesce(
            F.concat(
                F.coalesce(F.transform("_feed.channel.item", _rss_entry), empty),
                F.coalesce(F.transform("_feed.entry", _atom_entry), empty),
            ),
            empty,
        ),
    ).drop("_feed")


def _entry_type() -> T.StructType:
    kinds = {"content_html": T.ArrayType(T.StringType())}
    return T.StructType(
        [T.StructField(c, kinds.get(c, T.StringType()), True) for c in ENTRY_COLUMNS]
    )


def explode_entries(parsed: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per entry with its position; at most the first ``limit`` of each feed.

    The limit cuts the array before the rows are made, so it needs no shuffle
    where a feed is one document.
    """
    entries = F.col("entries") if limit is None else F.slice("entries", 1, limit)
    rest = [c for c in parsed.columns if c not in ("entries", "xml")]
    # the outer form, as the inner one makes the planner test the array first,
    # which parses every document once more
    rows = parsed.select(*rest, F.posexplode_outer(entries).alias("pos", "_e"))
    return rows.filter(F.col("pos").isNotNull()).select(*rest, "pos", "_e.*")


def feed_entries(feeds: DataFrame, limit: int | None = None) -> DataFrame:
    """Entries of RSS and Atom documents, in feed order."""
    return explode_entries(parse_feeds(feeds), limit)


# --- Reddit posts ------------------------------------------------------------


def entry_blocks() -> Column:
    """HTML blocks of an entry: contents, then summary, then description."""
    texts = F.concat(
        F.coalesce("content_html", F.array().cast("array<string>")),
        F.array(F.col("summary"), F.col("description")),
    )
    return F.filter(texts, lambda t: t.isNotNull() & (t != ""))


def last_entry_per_link(entries: DataFrame, order: str = "pos") -> DataFrame:
    """(source_id, clean_link, blocks): of entries with equal cleaned links the last counts."""
    linked = entries.filter(non_empty("link").isNotNull()).select(
        "source_id", clean_url("link").alias("clean_link"), order, entry_blocks().alias("blocks")
    )
    return linked.groupBy("source_id", "clean_link").agg(F.max_by("blocks", order).alias("blocks"))


def with_entry_blocks(posts: DataFrame, entries: DataFrame, order: str = "pos") -> DataFrame:
    """Posts with the HTML blocks of their feed entry."""
    return posts.withColumn("clean_link", clean_url("link")).join(
        last_entry_per_link(entries, order), ["source_id", "clean_link"], "left"
    ).drop("clean_link")


def with_page_html(posts: DataFrame, pages: DataFrame) -> DataFrame:
    """Posts with the HTML of their page where the entry gave no link.

    Of several pages of a url one counts. Posts that need no page get a null key and a
    hash, so they spread over the partitions of the join.
    """
    needed = F.col("external").isNull()
    keyed = posts.withColumns(
        {
            "_url": F.when(needed, F.col("link")),
            "_spread": F.when(needed, F.lit(0)).otherwise(F.hash("link")),
        }
    )
    keys = one_page_per_url(pages).select(
        F.col("url").alias("_url"), F.lit(0).alias("_spread"), F.col("html").alias("page_html")
    )
    return keyed.join(keys, ["_url", "_spread"], "left").drop("_url", "_spread")


def resolve_posts(posts: DataFrame, entries: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Reddit posts with their URL columns: link in the entry, else in the page, else the post."""
    found = with_entry_blocks(posts, entries).withColumn("external", reddit_entry_link("blocks"))
    if pages is not None:
        found = with_page_html(found, pages).withColumn(
            "external", F.coalesce("external", reddit_page_link("page_html"))
        ).drop("page_html")
    return reddit_articles(found).drop("blocks", "external")


def older_headlines(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """Headlines by the rules of the older reader, with ``original_url``.

    A link that leads to Reddit becomes the external link of its page, or the
    cleaned post where the page names none; other links are cleaned. Media
    hosts and subreddit pages are then left out.
    """
    is_post = is_reddit_internal("link")
    posts = valid_entries(entries).withColumn("external", F.when(~is_post, clean_url("link")))
    read = with_page_html(posts, pages)
    url = F.coalesce("external", reddit_page_link_or_post("page_html", "link"))
    return drop_unresolved_posts(read.withColumn("original_url", url)).drop("external", "page_html")


# --- crawl -------------------------------------------------------------------

# An adapter maps (posts of its sources, all entries of its sources) to articles.
Adapter = Callable[[DataFrame, DataFrame], DataFrame]


def default_adapters(pages: DataFrame | None = None) -> dict[str, Adapter]:
    """The built-in adapters; add to the mapping for other kinds of source."""
    return {
        "rss": lambda posts, entries: rss_articles(posts),
        "reddit": lambda posts, entries: resolve_posts(posts, entries, pages),
    }


def route(
    posts: DataFrame, entries: DataFrame, adapters: Mapping[str, Adapter]
) -> DataFrame:
    """Send each row to the adapter named in ``adapter``; unknown names go to ``rss``."""
    chosen = F.when(F.col("adapter").isin(*adapters), F.col("adapter")).otherwise(fixed.DEFAULT_ADAPTER)
    posts, entries = posts.withColumn("adapter", chosen), entries.withColumn("adapter", chosen)
    parts = [
        adapter(posts.filter(F.col("adapter") == name), entries.filter(F.col("adapter") == name))
        for name, adapter in adapters.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def crawl_entries(
    entries: DataFrame,
    limit: int = 50,
    cap: int | None = None,
    pages: DataFrame | None = None,
    adapters: Mapping[str, Adapter] | None = None,
) -> DataFrame:
    """Articles from the entries of all sources.

    ``entries`` carries ``adapter``, ``threshold`` and ``source_ord`` of its
    source. Give entries read from a table where an adapter needs them twice.
    """
    if cap is None:
        cut = valid_entries(entries.filter(F.col("pos") < limit))
    else:
        cut = valid_entries(global_cap(entries, cap, limit, is_valid_entry(), dense=True))
    articles = route(with_published(cut), entries, adapters or default_adapters(pages))
    return articles.withColumn(
        "seq", F.shiftleft(F.col("source_ord").cast("long"), 32) + F.col("pos")
    ).drop("content_html", "summary", "description", "published", "updated", "link", "adapter")


def stamped_entries(feeds: DataFrame, registry: DataFrame) -> DataFrame:
    """Entries of all feeds with order, adapter and threshold of their source.

    ``registry`` has one row per source. Where ``feeds`` has a column ``copy``,
    a source may have several documents: the one with most entries counts, on a tie
    the copy read from the address itself (``copy = 'url'``). Broken documents and
    sources without address contribute nothing.
    """
    known = with_feed_address(registry).select(
        "source_id", "source_ord", adapter_of(F.col("adapter")).alias("adapter"),
        F.coalesce("threshold", F.lit(fixed.DEFAULT_THRESHOLD)).alias("threshold"),
    )
    if "copy" not in feeds.columns:
        return feed_entries(feeds.select("source_id", "xml").join(known, "source_id"))
    parsed = parse_feeds(feeds.select("source_id", "copy", "xml")).drop("xml")
    richer = richer_snapshot(parsed, F.coalesce(F.col("copy") == "url", F.lit(False))).drop("copy")
    return explode_entries(richer.join(known, "source_id"))


def crawl(
    feeds: DataFrame,
    registry: DataFrame,
    limit: int = 50,
    cap: int | None = None,
    pages: DataFrame | None = None,
    adapters: Mapping[str, Adapter] | None = None,
) -> DataFrame:
    """Articles of all sources, stamped with ``source_id``, ``source_ord`` and ``threshold``."""
    return crawl_entries(stamped_entries(feeds, registry), limit, cap, pages, adapters)
