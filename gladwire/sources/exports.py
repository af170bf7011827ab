"""CSV exports and JSON event files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gladwire.functions.dates import format_datetime
from gladwire.functions.labels import event_payload, scores_json
from gladwire.operators.articles import column_or_null, yes_no


def _stamp(name: str):
    return format_datetime(name).alias(name)


def order_final(articles: DataFrame) -> DataFrame:
    """Newest crawl first, then by score, then by id; nulls last."""
    return articles.orderBy(
        F.desc_nulls_last("crawled_at"), F.desc_nulls_last("uplifting_score"), F.desc_nulls_last("id")
    )


def order_latest(crawled: DataFrame) -> DataFrame:
    """Best score first, then by title; null titles first, as they sort lowest."""
    return crawled.orderBy(F.desc_nulls_last("uplifting_score"), F.asc_nulls_first("title"))


def final_export(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Final articles with the key of their source: newest crawl first, then by score, then id."""
    keys = sources.select(F.col("id").alias("source_id"), F.col("source_id").alias("source"))
    return order_final(articles.join(keys, "source_id", "inner")).select(
        "id", "title", "url", "source_url", "external_url", "content", "summary", "thumbnail_url",
        "category", "category_confidence", scores_json("category_scores").alias("category_scores"),
        "source", "uplifting_score", _stamp("published_at"), _stamp("crawled_at"),
        _stamp("created_at"), _stamp("updated_at"),
    )


def latest_batch(crawled: DataFrame) -> DataFrame:
    """Rows of the newest crawl; its moment is found first and then filters the scan."""
    return crawled.filter(F.col("crawled_at") == crawled.agg(F.max("crawled_at")).scalar())


def latest_export(crawled: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of the newest crawl with an uplifting yes/no, best score first, then title."""
    keys = sources.select(F.col("id").alias("source_id"), F.col("source_id").alias("source"))
    return order_latest(latest_batch(crawled).join(keys, "source_id", "inner")).select(
        "title", "source", "uplifting_score", yes_no(F.col("is_uplifting")).alias("uplifting"),
        "category", "category_confidence", scores_json("category_scores").alias("category_scores"),
        "summary", "url", "source_url", "external_url", _stamp("crawled_at"),
    )


def write_csv(export: DataFrame, path: str, one_file: bool = False) -> None:
    """Write an export with header; ``one_file`` passes it through one task."""
    frame = export.coalesce(1) if one_file else export
    frame.write.options(header=True, escape='"').csv(path)


def write_split_csv(export: DataFrame, path: str) -> None:
    """Write the uplifting and the other rows into two folders, ``uplifting=yes`` and ``=no``.

    Within each, best score first, then by title, over the files in the order
    of their names: the writer keeps an order that begins with the folder.
    """
    ordered = export.orderBy("uplifting", F.desc_nulls_last("uplifting_score"), F.asc_nulls_first("title"))
    ordered.write.options(header=True, escape='"').partitionBy("uplifting").csv(path)


def article_events(articles: DataFrame, event: str, stage: str) -> DataFrame:
    """One event per article."""
    payload = event_payload(
        F.lit(event), F.col("source_id"), F.col("url"), F.col("title"), F.lit(stage),
        column_or_null(articles, "status"), column_or_null(articles, "uplifting_score", "double"),
        column_or_null(articles, "duration_ms", "double"),
    )
    return articles.select(payload.alias("e")).select("e.*")


def write_events(events: DataFrame, path: str) -> None:
    """Append events as JSON lines; null keys are left out."""
    events.write.mode("append").json(path)
