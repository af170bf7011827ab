"""Counts, run numbers, limits and rankings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import Tables, stamp
from gladwire.functions.dates import format_datetime
from gladwire.operators import limits, metrics
from gladwire.operators.articles import yes_no
from gladwire.sources import exports

_FUNNEL = """
    SELECT count(*) AS articles_fetched, count(*) FILTER (WHERE NOT is_new) AS articles_skipped,
           count(*) FILTER (WHERE is_new) AS articles_new,
           count(*) FILTER (WHERE is_new AND is_uplifting) AS articles_classified,
           count(*) FILTER (WHERE is_new AND is_uplifting AND category IS NOT NULL) AS articles_categorized,
           count(*) FILTER (WHERE is_new AND is_uplifting AND summary IS NOT NULL) AS articles_summarized,
           count(*) FILTER (WHERE is_new AND is_uplifting) AS articles_stored
    FROM (SELECT *, seq NOT IN (SELECT doc_id FROM labels) AS is_new,
                 CASE WHEN lang <> 'fr' THEN lang END AS category,
                 CASE WHEN n_chars > 1000 THEN title END AS summary FROM v_scored)"""


def _flagged(t: Tables) -> DataFrame:
    known = t.read("labels").select(F.col("doc_id").alias("seq"), F.lit(False).alias("is_new"))
    return t.scored.join(known, "seq", "left").withColumns(
        {
            "is_new": F.coalesce("is_new", F.lit(True)),
            "category": F.when(F.col("lang") != "fr", F.col("lang")),
            "summary": F.when(F.col("n_chars") > 1000, F.col("title")),
        }
    )


@check("stage_funnel", _FUNNEL)
def stage_funnel(t: Tables) -> DataFrame:
    return metrics.stage_funnel(_flagged(t))


@check("category_counts", """
    SELECT lang AS category, count(*) AS articles FROM v_articles WHERE lang <> 'fr' GROUP BY lang""")
def category_counts(t: Tables) -> DataFrame:
    category = F.when(F.col("lang") != "fr", F.col("lang"))
    return metrics.category_counts(t.articles.withColumn("category", category))


@check("avg_uplift_score", """
    SELECT round(avg(uplifting_score), 6) AS avg_uplifting_score FROM v_scored WHERE is_uplifting""")
def avg_uplift_score(t: Tables) -> DataFrame:
    mean = metrics.average_score(t.scored.filter("is_uplifting"))
    return mean.select(F.round("avg_uplifting_score", 6).alias("avg_uplifting_score"))


@check("thumbnails_found", "SELECT count(*) AS found FROM pages WHERE contains(url, '/fr/')")
def thumbnails_found(t: Tables) -> DataFrame:
    rows = t.read("pages").select(F.when(F.col("url").contains("/fr/"), F.col("url")).alias("thumbnail_url"))
    return metrics.found_count(rows, "thumbnail_url", "found")


@check("summaries_generated", "SELECT count(*) FILTER (WHERE n_chars > 1000) AS found FROM documents")
def summaries_generated(t: Tables) -> DataFrame:
    rows = t.articles.select(F.when(F.col("n_chars") > 1000, F.col("title")).alias("summary"))
    return metrics.found_count(rows, "summary", "found")


@check("per_source_counts", "SELECT source AS source_id, count(*) AS articles FROM documents GROUP BY source")
def per_source_counts(t: Tables) -> DataFrame:
    return metrics.per_source_counts(t.articles)


@check("split_counts", """
    SELECT CASE WHEN is_uplifting THEN 'yes' ELSE 'no' END AS uplifting, count(*) AS articles
    FROM v_scored GROUP BY ALL""")
def split_counts(t: Tables) -> DataFrame:
    return metrics.split_counts(t.scored.select(yes_no(F.col("is_uplifting")).alias("uplifting")))


@check("latest_batch_max", f"""
    SELECT event_id, {stamp("ts")} AS crawled_at FROM events
    WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)""")
def latest_batch_max(t: Tables) -> DataFrame:
    rows = t.read("events").withColumn("crawled_at", F.date_trunc("day", "ts"))
    return exports.latest_batch(rows).select("event_id", format_datetime("ts").alias("crawled_at"))


# A run is a user's hour: its stages are the events in it.
_RUNS = """
    SELECT user_id || '/' || strftime(ts, '%Y-%m-%d %H') AS run, event_id,
           CASE WHEN event_type = 'error' THEN 'value_failed: ' || props END AS message
    FROM events"""


def _runs(t: Tables) -> DataFrame:
    run = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd HH"))
    message = F.when(F.col("event_type") == "error", F.concat(F.lit("value_failed: "), F.col("props")))
    return t.read("events").select(run.alias("run"), "event_id", message.alias("message"))


@check("error_join", f"""
    SELECT run, string_agg(message, '; ' ORDER BY event_id) AS errors FROM ({_RUNS}) GROUP BY run""")
def error_join(t: Tables) -> DataFrame:
    return metrics.join_errors(_runs(t), "run", "event_id", "message")


@check("run_status", f"""
    SELECT run, CASE WHEN count(message) = 0 THEN 'success' ELSE 'partial_failure' END AS status
    FROM ({_RUNS}) GROUP BY run""")
def run_status(t: Tables) -> DataFrame:
    errors = F.nullif(F.count("message"), F.lit(0))
    return _runs(t).groupBy("run").agg(metrics.run_status(errors).alias("status"))


@check("run_duration", """
    SELECT user_id, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE, 3) AS duration_sec
    FROM events GROUP BY user_id""")
def run_duration(t: Tables) -> DataFrame:
    spans = t.read("events").groupBy("user_id").agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    return spans.select("user_id", metrics.duration_seconds(F.col("start"), F.col("end")).alias("duration_sec"))


@check("newest_articles_topk", f"""
    SELECT event_id, {stamp("ts")} AS crawled_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""")
def newest_articles_topk(t: Tables) -> DataFrame:
    rows = metrics.newest(t.read("events"), "ts", "event_id", 20)
    return rows.select("event_id", format_datetime("ts").alias("crawled_at"))


@check("recent_crawls_topk", f"""
    SELECT user_id, {stamp("max(ts)")} AS crawl_end, count(*) AS articles_fetched
    FROM events GROUP BY user_id ORDER BY max(ts) DESC, user_id DESC LIMIT 5""")
def recent_crawls_topk(t: Tables) -> DataFrame:
    runs = t.read("events").groupBy("user_id").agg(
        F.max("ts").alias("crawl_end"), F.count("*").alias("articles_fetched")
    )
    rows = metrics.newest(runs, "crawl_end", "user_id", 5)
    return rows.select("user_id", format_datetime("crawl_end").alias("crawl_end"), "articles_fetched")


@check("limit_per_source", """
    SELECT source_id, seq FROM v_articles
    QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY seq) <= 25""")
def limit_per_source(t: Tables) -> DataFrame:
    rows = t.articles.select("source_id", "seq")
    return limits.limit_per_source(rows, 25, "source_id", "seq")


# Sources in registry order, 25 entries each at most, 260 articles in all;
# French entries count as invalid.
_CAP, _LIMIT = 260, 25


@check("global_cap", f"""
    WITH RECURSIVE entries AS (
        SELECT CAST(substring(source, 4, 10) AS BIGINT) AS source_ord, doc_id AS seq, lang <> 'fr' AS valid,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank
        FROM documents),
    steps AS (
        SELECT CAST(-1 AS BIGINT) AS source_ord, CAST({_CAP} AS BIGINT) AS cap_left, CAST(0 AS BIGINT) AS take
        UNION ALL
        SELECT s.source_ord + 1,
               s.cap_left - (SELECT count(*) FROM entries e
                             WHERE e.source_ord = s.source_ord + 1 AND e.valid
                               AND e.rank <= least({_LIMIT}, s.cap_left)),
               least({_LIMIT}, s.cap_left)
        FROM steps s WHERE s.source_ord < (SELECT max(source_ord) FROM entries))
    SELECT e.source_ord, e.seq FROM entries e JOIN steps s ON s.source_ord = e.source_ord
    WHERE e.valid AND e.rank <= s.take""")
def global_cap(t: Tables) -> DataFrame:
    entries = t.read("documents").select(
        F.substring("source", 4, 10).cast("long").alias("source_ord"), F.col("doc_id").alias("seq"), "lang"
    )
    kept = limits.global_cap(entries, _CAP, _LIMIT, F.col("lang") != "fr", "seq")
    return kept.select("source_ord", "seq")


@check("richer_snapshot", """
    SELECT doc_id AS source_id, CASE WHEN n_content > n_url THEN 'content' ELSE 'url' END AS copy,
           CAST(greatest(n_content, n_url) AS INTEGER) AS entries
    FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n_content,
                 len(string_split(text, '. ')) AS n_url FROM documents)""")
def richer_snapshot(t: Tables) -> DataFrame:
    docs = t.read("documents").select(F.col("doc_id").alias("source_id"), "text")
    by_url = docs.select("source_id", F.lit("url").alias("copy"), F.split("text", r"\. ").alias("entries"))
    by_content = docs.select("source_id", F.lit("content").alias("copy"), F.split("text", "\n").alias("entries"))
    best = limits.richer_snapshot(by_url.unionByName(by_content), F.col("copy") == "url")
    return best.select("source_id", "copy", F.size("entries").alias("entries"))


# The order itself is looked at in the tests; here the rows.
@check("export_order", f"""
    SELECT {stamp("date_trunc('day', published_at)")} AS crawled_at, uplifting_score, seq FROM v_scored
    ORDER BY date_trunc('day', published_at) DESC, uplifting_score DESC, seq DESC""")
def export_order(t: Tables) -> DataFrame:
    rows = t.scored.select(
        F.date_trunc("day", "published_at").alias("crawled_at"), "uplifting_score", F.col("seq").alias("id")
    )
    return exports.order_final(rows).select(
        format_datetime("crawled_at").alias("crawled_at"), "uplifting_score", F.col("id").alias("seq")
    )


@check("latest_batch_order", """
    SELECT uplifting_score, title, seq FROM v_scored ORDER BY uplifting_score DESC, title""")
def latest_batch_order(t: Tables) -> DataFrame:
    return exports.order_latest(t.scored).select("uplifting_score", "title", "seq")
