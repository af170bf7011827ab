"""Projections and filters that turn feed entries into article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gladwire import fixed, schemas
from gladwire.functions.dates import published_or_updated
from gladwire.functions.labels import canonical_category
from gladwire.functions.text import non_empty, trim_title
from gladwire.functions.urls import clean_url


def column_or_null(df: DataFrame, name: str, kind: str | T.DataType = "string") -> Column:
    """A column of the frame, or a typed null where the frame lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def is_valid_entry() -> Column:
    """True for entries that have a title and a link."""
    return F.coalesce((F.length(trim_title("title")) > 0) & (F.length("link") > 0), F.lit(False))


def valid_entries(entries: DataFrame) -> DataFrame:
    """Trim titles; drop entries without title or link."""
    return entries.filter(is_valid_entry()).withColumn("title", trim_title("title"))


def with_published(entries: DataFrame) -> DataFrame:
    """Add ``published_at``: the published date, else the updated date, else null."""
    return entries.withColumn("published_at", published_or_updated("published", "updated"))


def rss_articles(entries: DataFrame) -> DataFrame:
    """URL columns of entries from ordinary feeds, all from the cleaned link."""
    link = clean_url("link")
    return entries.withColumns(
        {
            "rss_link": F.col("link"),
            "source_url": F.col("link"),
            "original_url": link,
            "url": link,
            "external_url": link,
        }
    )


def reddit_articles(posts: DataFrame, external: Column | str = "external") -> DataFrame:
    """URL columns of Reddit posts whose external link is known or null."""
    external = F.col(external) if isinstance(external, str) else external
    chosen = F.coalesce(external, F.col("link"))
    return posts.withColumns(
        {
            "rss_link": F.col("link"),
            "source_url": chosen,
            "url": chosen,
            "original_url": F.col("link"),
            "external_url": external,
        }
    )


def drop_unresolved_posts(headlines: DataFrame) -> DataFrame:
    """Older reader's filter: no Reddit media hosts, no subreddit pages."""
    url = F.col("original_url")
    media = url.startswith("https://i.redd.it") | url.startswith("https://v.redd.it")
    return headlines.filter(~media & ~url.contains("/r/"))


def fill_url_and_date(batch: DataFrame) -> DataFrame:
    """Fill a missing url from the other links and a missing date from ``published``."""
    url = F.coalesce(
        non_empty(column_or_null(batch, "url")),
        non_empty(column_or_null(batch, "original_url")),
        column_or_null(batch, "rss_link"),
        F.lit(""),
    )
    published_at = F.coalesce(
        column_or_null(batch, "published_at", "timestamp"), column_or_null(batch, "published", "timestamp")
    )
    return batch.withColumns({"url": url, "published_at": published_at})


def raw_flag(flag: Column, score: Column) -> Column:
    """Uplift flag of a raw row: the given one, else by the default threshold, else false."""
    return F.coalesce(flag, score >= F.lit(fixed.DEFAULT_THRESHOLD), F.lit(False))


def store_rows(batch: DataFrame, batch_ts: Column, raw: bool = False) -> DataFrame:
    """Map articles to store rows; ``source_id`` stays the text key.

    All rows of a run carry the same ``batch_ts``. A column the batch lacks
    becomes null.
    """

    def have(name: str, kind: str | T.DataType = "string") -> Column:
        return column_or_null(batch, name, kind)

    external = have("external_url")
    source_url = F.coalesce(
        non_empty(external), have("source_url"), non_empty(have("rss_link")), have("url")
    )
    columns = {
        "title": F.coalesce(have("title"), F.lit("")),
        "url": F.coalesce(non_empty(have("url")), have("original_url"), F.lit("")),
        "source_url": source_url,
        "external_url": external,
        "content": F.coalesce(non_empty(have("content")), have("body")),
        "summary": have("summary"),
        "thumbnail_url": have("thumbnail_url"),
        "category": canonical_category(have("category")),
        "category_confidence": have("category_confidence", "double"),
        "category_scores": have("category_scores", schemas.ARTICLES["category_scores"].dataType),
        "source_id": F.coalesce(have("source_id"), F.lit("")),
        "uplifting_score": have("uplifting_score", "double"),
        "published_at": have("published_at", "timestamp"),
        "crawled_at": batch_ts,
        "updated_at": batch_ts,
    }
    if raw:
        columns["is_uplifting"] = raw_flag(
            have("is_uplifting", "boolean"), have("uplifting_score", "double")
        )
    kept = [c for c in ("seq",) if c in batch.columns]
    return batch.select(*kept, *[value.alias(name) for name, value in columns.items()])


def add_missing_columns(table: DataFrame, schema: T.StructType) -> DataFrame:
    """An older table in a newer schema: missing columns come as nulls."""
    return table.select(
        *[column_or_null(table, f.name, f.dataType).alias(f.name) for f in schema.fields]
    )


def of_category(articles: DataFrame, category: str) -> DataFrame:
    """Articles of one category."""
    return articles.filter(F.col("category") == category)


def yes_no(flag: Column) -> Column:
    """Flag as 'yes' or 'no'; null is no."""
    return F.when(F.coalesce(flag, F.lit(False)), "yes").otherwise("no")
