"""Table schemas."""

from pyspark.sql import types as T

_S, _L, _D, _B, _TS = (
    T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


SOURCES = _table(
    ("id", _L), ("source_id", _S), ("name", _S), ("domain", _S), ("rss_url", _S),
    ("url", _S), ("active", _B), ("category", _S), ("created_at", _TS),
)

CATEGORIES = _table(
    ("id", _L), ("name", _S), ("slug", _S), ("description", _S), ("icon", _S),
    ("color", _S), ("created_at", _TS),
)

ARTICLES = _table(
    ("id", _L), ("title", _S), ("url", _S), ("source_url", _S), ("external_url", _S),
    ("content", _S), ("summary", _S), ("thumbnail_url", _S), ("category", _S),
    ("category_confidence", _D), ("category_scores", T.MapType(_S, _D)),
    ("source_id", _L), ("uplifting_score", _D), ("published_at", _TS),
    ("crawled_at", _TS), ("created_at", _TS), ("updated_at", _TS),
)

CRAWLED_ARTICLES = T.StructType(
    ARTICLES.fields[:13] + [T.StructField("is_uplifting", _B, True)] + ARTICLES.fields[13:]
)

CRAWL_METRICS = _table(
    ("id", _S), ("crawl_start", _TS), ("crawl_end", _TS), ("articles_fetched", _L),
    ("articles_classified", _L), ("articles_stored", _L),
    ("avg_classification_score", _D), ("errors", _S),
)

BOOKMARKS = _table(
    ("id", _L), ("article_id", _L), ("session_uuid", _S), ("created_at", _TS),
)

THUMBNAIL_CACHE = _table(("url", _S), ("thumbnail_url", _S))
CATEGORY_CACHE = _table(
    ("cache_key", _S), ("category", _S), ("scores", T.MapType(_S, _D)), ("confidence", _D),
)
SUMMARY_CACHE = _table(("cache_key", _S), ("summary", _S))

# titles of stored articles with their dates, for lookups by title
TITLE_DATES = _table(("title", _S), ("happened", _S), ("url", _S))

FEEDS = _table(("source_id", _S), ("source_ord", _L), ("copy", _S), ("xml", _S))
PAGES = _table(("url", _S), ("status", T.IntegerType()), ("html", _S))

REGISTRY = _table(
    ("name", _S), ("source_id", _S), ("rss_url", _S), ("active", _B), ("category", _S),
    ("adapter", _S), ("threshold", _D), ("domain", _S), ("url", _S), ("base_url", _S),
)

TABLES = {
    "sources": SOURCES,
    "categories": CATEGORIES,
    "articles": ARTICLES,
    "crawled_articles": CRAWLED_ARTICLES,
    "crawl_metrics": CRAWL_METRICS,
    "bookmarks": BOOKMARKS,
    "thumbnail_cache": THUMBNAIL_CACHE,
    "category_cache": CATEGORY_CACHE,
    "summary_cache": SUMMARY_CACHE,
    "title_dates": TITLE_DATES,
}
