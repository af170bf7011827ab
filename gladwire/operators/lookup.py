"""Joins with the dimension tables, the bookmarks and the result caches.

No join is forced to broadcast: the planner does it where the measured size of
a side is under its limit, and sorts and merges beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_source_ids(batch: DataFrame, sources: DataFrame) -> DataFrame:
    """Replace the text key ``source_id`` by the id of the source.

    An unknown key stops the job, so nothing of the batch gets written.
    """
    ids = sources.select(F.col("source_id").alias("_key"), F.col("id").alias("_id"))
    joined = batch.join(ids, batch["source_id"] == ids["_key"], "left")
    problem = F.format_string("source_id '%s' is not in the sources table", F.col("source_id"))
    checked = F.when(F.col("_id").isNull(), F.raise_error(problem).cast("long")).otherwise(F.col("_id"))
    return joined.withColumn("source_id", checked).drop("_key", "_id")


def source_id_of(key: str, sources: DataFrame) -> DataFrame:
    """One row: the id of a source, or null."""
    return sources.filter(F.col("source_id") == key).agg(F.min("id").alias("id"))


def with_source_names(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Articles with name and domain of their source."""
    named = sources.select(
        F.col("id").alias("source_id"), F.col("name").alias("source_name"),
        F.col("domain").alias("source_domain"),
    )
    return articles.join(named, "source_id", "inner")


def newest_first(articles: DataFrame) -> DataFrame:
    """Newest published article first, undated ones last."""
    return articles.orderBy(F.desc_nulls_last("published_at"), F.desc("id"))


def distinct_bookmarks(bookmarks: DataFrame) -> DataFrame:
    """One bookmark per article and session: the first by id."""
    return bookmarks.groupBy("article_id", "session_uuid").agg(
        F.min("id").alias("id"), F.min_by("created_at", "id").alias("created_at")
    )


def bookmarked_articles(bookmarks: DataFrame, articles: DataFrame) -> DataFrame:
    """Bookmarks with the article they point to; none without one."""
    return distinct_bookmarks(bookmarks).withColumnRenamed("id", "bookmark_id").join(
        articles.withColumnRenamed("id", "article_id"), "article_id", "inner"
    )


def cache_lookup(wanted: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Add the cached columns and ``hit``: a cached null is a hit, a missing row is not."""
    marked = cache.withColumn("hit", F.lit(True))
    return wanted.join(marked, key, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def cache_misses(wanted: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Rows whose key the cache lacks."""
    return wanted.join(cache.select(key), key, "left_anti")


def distinct_misses(
    rows: DataFrame, key: str, inputs: list[str], cache: DataFrame | None = None
) -> DataFrame:
    """Each key of the rows once, with its inputs, where the cache lacks it; null keys are left out."""
    keyed = rows.filter(F.col(key).isNotNull()).select(key, *inputs)
    jobs = keyed.dropDuplicates([key])
    return jobs if cache is None else cache_misses(jobs, cache, key)


def with_cached(fresh: DataFrame, cache: DataFrame | None) -> DataFrame:
    """New entries together with the cached ones."""
    return fresh if cache is None else cache.select(*fresh.columns).unionByName(fresh)


def join_results(rows: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Rows with the results of their key; rows without one keep nulls.

    Rows without a key get a number each, so that they do not meet in one task.
    """
    keyed = rows.withColumn("_spread", F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(0))
    return keyed.join(results.withColumn("_spread", F.lit(0).cast("bigint")), [key, "_spread"], "left").drop("_spread")


def fill_missing(rows: DataFrame, target: str, value: Column) -> DataFrame:
    """Set ``target`` where it is absent, null or empty."""
    if target not in rows.columns:
        return rows.withColumn(target, value)
    return rows.withColumn(target, F.coalesce(F.nullif(F.col(target), F.lit("")), value))
