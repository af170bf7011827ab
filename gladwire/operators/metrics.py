"""Counts and other numbers of a run."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage_funnel(rows: DataFrame) -> DataFrame:
    """One row of stage counts from rows flagged ``is_new`` and ``is_uplifting``.

    "Classified" counts the uplifting rows, as the runs report it.
    """
    new, uplifting = F.col("is_new"), F.col("is_new") & F.col("is_uplifting")
    return rows.agg(
        F.count("*").alias("articles_fetched"),
        F.count_if(~new).alias("articles_skipped"),
        F.count_if(new).alias("articles_new"),
        F.count_if(uplifting).alias("articles_classified"),
        F.count_if(uplifting & F.col("category").isNotNull()).alias("articles_categorized"),
        F.count_if(uplifting & F.col("summary").isNotNull()).alias("articles_summarized"),
        F.count_if(uplifting).alias("articles_stored"),
    )


def category_counts(articles: DataFrame) -> DataFrame:
    """Articles per category, without the uncategorised."""
    named = articles.filter(F.col("category").isNotNull())
    return named.groupBy("category").agg(F.count("*").alias("articles"))


def average_score(articles: DataFrame) -> DataFrame:
    """Mean score; null where no article has one."""
    return articles.agg(F.avg("uplifting_score").alias("avg_uplifting_score"))


def found_count(articles: DataFrame, column: str, alias: str) -> DataFrame:
    """Number of articles that have a value in the column."""
    return articles.agg(F.count(column).alias(alias))


def per_source_counts(articles: DataFrame) -> DataFrame:
    """Articles per source."""
    return articles.groupBy("source_id").agg(F.count("*").alias("articles"))


def split_counts(export: DataFrame) -> DataFrame:
    """Rows per uplifting yes/no."""
    return export.groupBy("uplifting").agg(F.count("*").alias("articles"))


def join_errors(errors: DataFrame, run: str, order: str, message: str) -> DataFrame:
    """Errors of each run as one text in order, null where there are none.

    A run has a handful of stages and at most one error per stage, so its list
    stays short.
    """
    listed = F.array_sort(
        F.collect_list(F.when(F.col(message).isNotNull(), F.struct(order, message)))
    )
    joined = F.array_join(F.transform(listed, lambda e: e[message]), "; ")
    return errors.groupBy(run).agg(F.nullif(joined, F.lit("")).alias("errors"))


def run_status(errors: Column) -> Column:
    """Status of a run by its errors, as a text or a number; null is none."""
    return F.when(errors.isNull(), "success").otherwise("partial_failure")


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds between two moments, to the millisecond."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(micros / F.lit(1e6), 3)


def new_crawl_id(now: dt.datetime | None = None) -> str:
    """Name of a run: ``crawl_<date>_<time>_<six hex digits>``."""
    moment = now or dt.datetime.now(dt.timezone.utc)
    return f"crawl_{moment:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def newest(rows: DataFrame, when: str, tie: str, n: int) -> DataFrame:
    """The ``n`` newest rows."""
    return rows.orderBy(F.desc_nulls_last(when), F.desc(tie)).limit(n)
