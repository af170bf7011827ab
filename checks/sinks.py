"""Registry checks, exports, metrics and events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import Tables, minutes_after_epoch, stamp
from gladwire import schemas
from gladwire.functions.dates import format_datetime
from gladwire.operators.articles import add_missing_columns
from gladwire.operators.metrics import new_crawl_id
from gladwire.session import new_folder
from gladwire.sources import exports, registry
from gladwire.sources.store import ArticleStore


def _records(t: Tables) -> DataFrame:
    """Every customer as a registry record, with all kinds of mistakes."""
    segment, nation, balance = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    quote = F.lit('"')
    parts = F.array(
        F.when(segment != "BUILDING", F.concat(F.lit('"name":"'), "c_name", quote)),
        F.when(segment != "FURNITURE", F.concat(F.lit('"source_id":"c'), F.col("c_custkey").cast("string"), quote)),
        F.when(nation != 3, F.concat(F.lit('"rss_url":"https://x.example.org/'), F.col("c_custkey").cast("string"), quote))
        .otherwise(F.lit('"rss_url":null')),
        F.when(nation == 7, F.lit('"threshold":"high"')).when(nation == 8, F.lit('"threshold":true'))
        .when(nation != 9, F.concat(F.lit('"threshold":'), (balance / 8000).cast("string"))),
        F.when(nation == 11, F.lit('"active":"yes"')).when(nation == 12, F.lit('"active":null'))
        .when(nation < 20, F.concat(F.lit('"active":'), (nation < 15).cast("string"))),
        F.when(segment == "MACHINERY", F.lit('"adapter":"reddit"'))
        .when(segment == "HOUSEHOLD", F.lit('"adapter":"gopher"')),
    )
    record = F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ","), F.lit("}"))
    return t.read("customer").select(
        F.col("c_custkey").alias("ord"),
        F.when(nation == 24, F.lit("[1, 2]")).otherwise(record).alias("record"),
    )


_PLACE = "'Source[' || c_custkey || '] ' || CASE WHEN c_mktsegment = 'BUILDING' THEN '?' ELSE c_name END"
_THRESHOLD = "c_acctbal / 8000"


@check("validate_registry", f"""
    SELECT c_custkey AS ord, {_PLACE} || ': missing ' ||
           CASE c_mktsegment WHEN 'BUILDING' THEN 'name' ELSE 'source_id' END AS problem
    FROM customer WHERE c_nationkey <> 24 AND c_mktsegment IN ('BUILDING', 'FURNITURE')
    UNION ALL SELECT c_custkey, {_PLACE} || ': threshold is not a number' FROM customer WHERE c_nationkey = 7
    UNION ALL SELECT c_custkey, {_PLACE} || ': threshold is not between 0 and 1' FROM customer
              WHERE c_nationkey NOT IN (7, 8, 9, 24) AND ({_THRESHOLD} < 0 OR {_THRESHOLD} > 1)
    UNION ALL SELECT c_custkey, {_PLACE} || ': active is not true or false' FROM customer WHERE c_nationkey = 11
    UNION ALL SELECT c_custkey, {_PLACE} || ': adapter is unknown' FROM customer
              WHERE c_nationkey <> 24 AND c_mktsegment = 'HOUSEHOLD'
    UNION ALL SELECT c_custkey, 'Source[' || c_custkey || '] is not a record' FROM customer WHERE c_nationkey = 24""")
def validate_registry(t: Tables) -> DataFrame:
    return registry.registry_problems(_records(t))


@check("source_registry", f"""
    SELECT c_custkey AS source_ord, CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'c' || c_custkey END AS source_id,
           CASE WHEN c_nationkey NOT IN (7, 8, 9) THEN {_THRESHOLD} END AS threshold
    FROM customer
    WHERE c_nationkey < 15 AND c_nationkey NOT IN (3, 11, 12)""")
def source_registry(t: Tables) -> DataFrame:
    # records of other rows report their mistyped values; parsing reads these as nulls
    rows = registry.active_sources(registry.parse_registry(_records(t)))
    return rows.select("source_ord", "source_id", "threshold")


def _crawled_at():
    """Long titles were crawled a day later."""
    return minutes_after_epoch(F.when(F.length("title") > 60, 1440).otherwise(0))


_CRAWLED_AT = "TIMESTAMP '2024-01-01 00:00:00' + to_days(CASE WHEN length(title) > 60 THEN 1 ELSE 0 END)"


def _stored(t: Tables, rows: DataFrame, schema) -> DataFrame:
    return add_missing_columns(
        rows.select(
            F.col("seq").alias("id"), "title", "url", F.col("link").alias("source_url"),
            F.col("body").alias("content"), F.col("lang").alias("category"),
            F.when(F.col("lang") == "en", F.create_map(F.lit("Health"), F.col("n_chars") / 8.0)).alias("category_scores"),
            F.substring("source_id", 4, 10).cast("long").alias("source_id"), "uplifting_score", "is_uplifting",
            "published_at", _crawled_at().alias("crawled_at"),
        ),
        schema,
    )


_SCORES = """CASE WHEN lang = 'en' THEN '{"Health":' || CAST(n_chars / 8.0::DOUBLE AS VARCHAR) || '}' END"""


@check("export_final_csv", f"""
    SELECT seq AS id, title, url, link AS source_url, CAST(NULL AS VARCHAR) AS external_url, body AS content,
           CAST(NULL AS VARCHAR) AS summary, CAST(NULL AS VARCHAR) AS thumbnail_url, lang AS category,
           CAST(NULL AS DOUBLE) AS category_confidence, {_SCORES} AS category_scores, source_id AS source,
           uplifting_score, {stamp("published_at")} AS published_at,
           {stamp(_CRAWLED_AT)} AS crawled_at,
           CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS updated_at
    FROM v_scored WHERE is_uplifting""")
def export_final_csv(t: Tables) -> DataFrame:
    rows = _stored(t, t.scored.filter("is_uplifting"), schemas.ARTICLES)
    path = new_folder(t.spark, "export")
    export = exports.final_export(rows, t.sources)
    exports.write_csv(export, path)
    return t.spark.read.schema(export.schema).csv(path, header=True, multiLine=True, escape='"')


@check("export_latest_split_csv", f"""
    SELECT title, source_id AS source, uplifting_score, CASE WHEN is_uplifting THEN 'yes' ELSE 'no' END AS uplifting,
           lang AS category, CAST(NULL AS DOUBLE) AS category_confidence, {_SCORES} AS category_scores,
           CAST(NULL AS VARCHAR) AS summary, url, link AS source_url, CAST(NULL AS VARCHAR) AS external_url,
           {stamp(_CRAWLED_AT)} AS crawled_at
    FROM v_scored
    WHERE {_CRAWLED_AT} = (SELECT max({_CRAWLED_AT}) FROM v_scored)""")
def export_latest_split_csv(t: Tables) -> DataFrame:
    rows = _stored(t, t.scored, schemas.CRAWLED_ARTICLES)
    path = new_folder(t.spark, "export")
    export = exports.latest_export(rows, t.sources)
    exports.write_split_csv(export, path)
    return t.spark.read.schema(export.schema).csv(path, header=True, multiLine=True, escape='"')


@check("metrics_append", f"""
    SELECT 'u' || user_id AS id, {stamp("min(ts)")} AS crawl_start, {stamp("max(ts)")} AS crawl_end,
           count(*) AS articles_fetched FROM events GROUP BY user_id
    UNION ALL SELECT 't' || event_type, {stamp("min(ts)")}, {stamp("max(ts)")}, count(*)
    FROM events GROUP BY event_type""")
def metrics_append(t: Tables) -> DataFrame:
    store = ArticleStore(t.spark, new_folder(t.spark, "store"))
    for prefix, key in (("u", "user_id"), ("t", "event_type")):
        runs = t.read("events").groupBy(key).agg(
            F.min("ts").alias("crawl_start"), F.max("ts").alias("crawl_end"), F.count("*").alias("articles_fetched")
        ).withColumn("id", F.concat(F.lit(prefix), F.col(key).cast("string")))
        store.append("crawl_metrics", add_missing_columns(
            runs.withColumns({"crawl_start": F.col("crawl_start").cast("timestamp"), "crawl_end": F.col("crawl_end").cast("timestamp")}),
            schemas.CRAWL_METRICS))
    return store.scan("crawl_metrics").select(
        "id", format_datetime("crawl_start").alias("crawl_start"), format_datetime("crawl_end").alias("crawl_end"),
        "articles_fetched",
    )


@check("event_sink", """
    SELECT 'article_processed' AS event, source_id, url, substring(title, 1, 120) AS title, 'classified' AS stage,
           'success' AS status, CASE WHEN lang <> 'fr' THEN round(uplifting_score, 4) END AS uplifting_score,
           CASE WHEN lang <> 'fr' THEN 7 ELSE 6 END AS keys
    FROM v_scored""")
def event_sink(t: Tables) -> DataFrame:
    rows = t.scored.withColumn("uplifting_score", F.when(F.col("lang") != "fr", F.col("uplifting_score")))
    events = exports.article_events(rows, "article_processed", "classified")
    path = new_folder(t.spark, "events")
    exports.write_events(events, path)
    lines = t.spark.read.text(path)
    parsed = lines.select(F.from_json("value", events.schema).alias("e"), F.size(F.json_object_keys("value")).alias("keys"))
    return parsed.select("e.event", "e.source_id", "e.url", "e.title", "e.stage", "e.status", "e.uplifting_score", "keys")


@check("crawl_id", """
    SELECT event_id, true AS well_formed FROM events""")
def crawl_id(t: Tables) -> DataFrame:
    name = F.lit(new_crawl_id())
    return t.read("events").select(
        "event_id", name.rlike("^crawl_[0-9]{8}_[0-9]{6}_[0-9a-f]{6}$").alias("well_formed")
    )
