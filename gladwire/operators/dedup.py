"""Dropping articles that the stores already hold.

Both passes are anti joins. The known side is reduced to distinct keys in the
partitioning of the join, so a key with many copies there costs one row; a key
with many copies in the batch is split by the runtime plan's skew handling,
which may cut the left side of an anti join. Rows that take no part in the
second pass get a key that nothing matches, different for each url, so they do
not gather in one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire.functions.dates import format_datetime
from gladwire.functions.text import non_empty


def known_urls(raw: DataFrame, final: DataFrame) -> DataFrame:
    """Distinct urls of both stores."""
    return raw.select("url").unionByName(final.select("url")).distinct()


def known_pairs(raw: DataFrame, final: DataFrame) -> DataFrame:
    """(title, published_at) of both stores, without those that have a null; may repeat."""
    pairs = raw.select("title", "published_at").unionByName(final.select("title", "published_at"))
    return pairs.filter(F.col("title").isNotNull() & F.col("published_at").isNotNull())


def drop_known_urls(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Batch rows whose url is not known; repeats inside the batch stay."""
    keys = known.select(F.col("url").alias("_url"))
    return batch.join(keys, F.coalesce(batch["url"], F.lit("")) == keys["_url"], "left_anti")


def _drop_known_titles(batch: DataFrame, known: DataFrame, when: Column) -> DataFrame:
    """``when`` is the date as text; the mark before a hash occurs in no date."""
    complete = non_empty("title").isNotNull() & when.isNotNull()
    unmatched = F.concat(F.lit("?"), F.hash("url", "title").cast("string"))
    marked = batch.withColumns(
        {
            "_title": F.when(complete, F.col("title")).otherwise(F.lit("")),
            "_when": F.when(complete, when).otherwise(unmatched),
        }
    )
    keys = known.select(F.col("title").alias("_title"), when.alias("_when")).distinct()
    return marked.join(keys, ["_title", "_when"], "left_anti").drop("_title", "_when")


def drop_known_titles(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Batch rows whose title and date, to the second, are not known."""
    return _drop_known_titles(batch, known, format_datetime("published_at"))


def drop_known_titles_by_day(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Batch rows whose title and calendar day are not known."""
    return _drop_known_titles(batch, known, F.date_format("published_at", "yyyy-MM-dd"))


def drop_known(batch: DataFrame, raw: DataFrame, final: DataFrame) -> DataFrame:
    """Both passes, url first."""
    fresh = drop_known_urls(batch, known_urls(raw, final))
    return drop_known_titles(fresh, known_pairs(raw, final))


def existing_urls(urls: DataFrame, raw: DataFrame, final: DataFrame) -> DataFrame:
    """The given urls that a store holds; the stores are cut down to these first."""
    wanted = urls.select("url").distinct()
    return known_urls(*(store.select("url").join(wanted, "url", "left_semi") for store in (raw, final)))


def article_exists(url: str, raw: DataFrame, final: DataFrame) -> DataFrame:
    """One row with one flag: whether a store holds the url."""
    hit = raw.select("url").unionByName(final.select("url")).filter(F.col("url") == url).limit(1)
    return hit.agg((F.count("*") > 0).alias("found"))
