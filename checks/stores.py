"""Insert-or-update, seeds and caches."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import (
    BASE, NEGATIVE, POSITIVE, THRESHOLDS, Tables, minutes_after_epoch, rule_score, stamp,
)
from gladwire.functions.dates import format_datetime
from gladwire.operators import merge
from gladwire.operators.scoring import is_below, rule_scorer
from gladwire.plans.run import RunOptions, run_batch
from gladwire.session import new_folder
from gladwire.sources.store import ArticleStore
from gladwire.streaming.ingest import drop_repeats, ingest_stream, write_unique

# Rows of a batch: the summary is null in French texts, so an update may
# overwrite with null; the source differs between copies of a url.
_ROW = """seq, url, title, 's' || n_chars AS source_id, CASE WHEN lang <> 'fr' THEN lang END AS summary,
          published_at AS crawled_at, seq AS id"""


def _row(rows: DataFrame) -> DataFrame:
    return rows.select(
        "seq", "url", "title", F.concat(F.lit("s"), F.col("n_chars").cast("string")).alias("source_id"),
        F.when(F.col("lang") != "fr", F.col("lang")).alias("summary"),
        F.col("published_at").alias("crawled_at"), F.col("seq").alias("id"),
    )


def _collapsed(rows: str) -> str:
    return f"""
        SELECT url, arg_min({{'v': id}}, seq).v AS id, arg_min({{'v': source_id}}, seq).v AS source_id,
               arg_max({{'v': title}}, seq).v AS title, arg_max({{'v': summary}}, seq).v AS summary,
               arg_max({{'v': crawled_at}}, seq).v AS crawled_at
        FROM (SELECT {_ROW} FROM {rows}) GROUP BY url"""


@check("batch_collapse", f"""
    SELECT url, id, source_id, title, summary, {stamp("crawled_at")} AS crawled_at
    FROM ({_collapsed("v_articles")})""")
def batch_collapse(t: Tables) -> DataFrame:
    one = merge.collapse(_row(t.articles), "url", "seq", kept=("id", "source_id"))
    return one.withColumn("crawled_at", format_datetime("crawled_at"))


_UPSERT = f"""
    SELECT coalesce(o.url, n.url) AS url, coalesce(o.id, n.id) AS id, coalesce(o.source_id, n.source_id) AS source_id,
           CASE WHEN n.url IS NULL THEN o.title ELSE n.title END AS title,
           CASE WHEN n.url IS NULL THEN o.summary ELSE n.summary END AS summary,
           {stamp("CASE WHEN n.url IS NULL THEN o.crawled_at ELSE n.crawled_at END")} AS crawled_at
    FROM ({_collapsed("v_labelled")}) o FULL JOIN ({_collapsed("v_batch")}) n ON n.url = o.url"""


@check("upsert_articles", _UPSERT)
def upsert_articles(t: Tables) -> DataFrame:
    target = merge.collapse(_row(t.labelled), "url", "seq", kept=("id", "source_id"))
    done = merge.upsert(target, _row(t.batch), kept=("id", "source_id"))
    return done.withColumn("crawled_at", format_datetime("crawled_at"))


@check("upsert_articles_narrow", """
    SELECT coalesce(o.url, n.url) AS url, coalesce(o.id, n.id) AS id,
           CASE WHEN n.url IS NULL THEN o.title ELSE n.title END AS title,
           o.quality AS quality
    FROM v_raw o FULL JOIN (SELECT url, min(seq) AS id, arg_max(title, seq) AS title FROM v_batch GROUP BY url) n
         ON n.url = o.url""")
def upsert_articles_narrow(t: Tables) -> DataFrame:
    target = t.raw.select("id", "url", "title", "quality")
    batch = t.batch.select("seq", F.col("seq").alias("id"), "url", "title", F.lit(7).alias("quality"))
    return merge.upsert(target, batch, kept=("id",), overwrite=("title",))


def _sources_row(t: Tables, rows: DataFrame) -> DataFrame:
    grouped = rows.groupBy("source_id").agg(F.max("n_chars").alias("n"), F.min("seq").alias("seq"))
    return grouped.select(
        F.substring("source_id", 4, 10).cast("long").alias("id"), "seq", "source_id",
        F.concat(F.lit("name "), F.col("n").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("domain"),
    )


_SOURCES = """SELECT source_id, CAST(substring(source_id, 4, 10) AS BIGINT) AS id,
                     'name ' || max(n_chars) AS name FROM {} GROUP BY source_id"""


@check("upsert_sources", f"""
    SELECT coalesce(o.source_id, n.source_id) AS source_id, coalesce(o.id, n.id) AS id,
           coalesce(n.name, o.name) AS name, CASE WHEN n.name IS NULL THEN o.domain END AS domain
    FROM (SELECT id, source_id, name, domain FROM v_sources WHERE category = 'de') o
    FULL JOIN ({_SOURCES.format("v_batch")}) n ON n.source_id = o.source_id""")
def upsert_sources(t: Tables) -> DataFrame:
    target = t.sources.filter(F.col("category") == "de").select("id", "source_id", "name", "domain")
    return merge.upsert(target, _sources_row(t, t.batch), "source_id", kept=("id", "created_at"))


@check("insert_or_ignore", f"""
    WITH seen AS (SELECT url, id, title FROM v_final),
    news AS (SELECT url, min(seq) AS id, arg_min(title, seq) AS title FROM v_batch b
             WHERE url NOT IN (SELECT url FROM seen) GROUP BY url)
    SELECT * FROM seen UNION ALL SELECT * FROM news""")
def insert_or_ignore(t: Tables) -> DataFrame:
    rows = t.batch.select("seq", "url", F.col("seq").alias("id"), "title")
    return merge.insert_or_ignore(t.final.select("url", "id", "title"), rows, ["url"])


@check("cache_replace", """
    SELECT coalesce(n.url, o.url) AS url, CASE WHEN n.url IS NULL THEN o.thumb ELSE n.thumb END AS thumbnail_url
    FROM (SELECT url, title AS thumb FROM v_raw) o
    FULL JOIN (SELECT url, arg_max({'v': CASE WHEN lang <> 'fr' THEN lang END}, seq).v AS thumb
               FROM v_batch GROUP BY url) n ON n.url = o.url""")
def cache_replace(t: Tables) -> DataFrame:
    cache = t.raw.select("url", F.col("title").alias("thumbnail_url"))
    entries = t.batch.select("seq", "url", F.when(F.col("lang") != "fr", F.col("lang")).alias("thumbnail_url"))
    return merge.replace_by_key(cache, entries, "url")


# --- through the written store ----------------------------------------------


def _store(t: Tables) -> ArticleStore:
    """A store that knows the sources and holds the labelled articles as raw and final rows."""
    store = ArticleStore(t.spark, new_folder(t.spark, "store"))
    store.append("sources", t.sources)
    scored = t.labelled.withColumn("uplifting_score", rule_scorer(POSITIVE, NEGATIVE)(F.col("title")))
    store.append("crawled_articles", store.collapsed("crawled_articles", _article_rows(scored)))
    store.append("articles", store.scan("crawled_articles").filter("is_uplifting"), index=False)
    return store


def _article_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "seq", F.col("seq").alias("id"), "title", "url", F.col("body").alias("content"),
        F.substring("source_id", 4, 10).cast("long").alias("source_id"), "uplifting_score",
        (F.col("uplifting_score") >= 0.6).alias("is_uplifting"), "published_at",
        minutes_after_epoch(F.col("seq")).alias("crawled_at"),
        minutes_after_epoch(F.col("seq")).alias("created_at"),
    )


_STORED = f"(SELECT *, {rule_score('title')} AS uplifting_score FROM v_labelled)"


@check("store_scan", f"""
    SELECT url, min(seq) AS id, arg_max(title, seq) AS title, arg_max(uplifting_score, seq) AS uplifting_score
    FROM {_STORED} GROUP BY url""")
def store_scan(t: Tables) -> DataFrame:
    return _store(t).scan("crawled_articles", ["url", "id", "title", "uplifting_score"])


_BOTH = f"""(SELECT seq, url, title, source_id, {rule_score('title')} AS uplifting_score,
                    seq IN (SELECT doc_id FROM labels) AS old FROM v_articles)"""


@check("upsert_crawled", f"""
    SELECT url, coalesce(min(seq) FILTER (WHERE old), min(seq)) AS id,
           coalesce(arg_max(title, seq) FILTER (WHERE NOT old), arg_max(title, seq)) AS title,
           coalesce(arg_max(uplifting_score, seq) FILTER (WHERE NOT old), arg_max(uplifting_score, seq)) >= 0.6
           AS is_uplifting
    FROM {_BOTH} GROUP BY url""")
def upsert_crawled(t: Tables) -> DataFrame:
    store = _store(t)
    scored = t.batch.withColumn("uplifting_score", rule_scorer(POSITIVE, NEGATIVE)(F.col("title")))
    store.upsert("crawled_articles", _article_rows(scored))
    return store.scan("crawled_articles", ["url", "id", "title", "is_uplifting"])


# Urls of few different lines: rows of one url differ in title, source and flag.
_GROUP = "'https://few.example.org/' || (length(title) % 97) || '/' || (seq % 5)"


@check("refresh_enriched", f"""
    SELECT url, source_id, title, is_uplifting, category FROM (
        SELECT url, CAST(substring(arg_min(source_id, seq), 4, 10) AS BIGINT) AS source_id,
               coalesce(arg_max(title, seq) FILTER (WHERE is_uplifting), arg_max(title, seq)) AS title,
               bool_or(is_uplifting) AS is_uplifting,
               CASE WHEN bool_or(is_uplifting) THEN
                   CASE WHEN contains(lower(arg_max(title, seq) FILTER (WHERE is_uplifting)), 'the') THEN 'Health' ELSE 'Sports' END
               END AS category
        FROM (SELECT *, {_GROUP} AS url FROM (SELECT * EXCLUDE (url) FROM v_scored)) GROUP BY url)""")
def refresh_enriched(t: Tables) -> DataFrame:
    """A run over urls that repeat with mixed flags: the raw store holds the enriched rows."""
    store = ArticleStore(t.spark, new_folder(t.spark, "store"))
    store.append("sources", t.sources)
    few = F.concat(F.lit("https://few.example.org/"), F.length("title") % 97, F.lit("/"), F.col("seq") % 5)
    run_batch(store, t.articles.withColumn("url", few).select(*_HEADLINES), _options())
    return store.scan("crawled_articles", ["url", "source_id", "title", "is_uplifting", "category"])


@check("atomic_batch", f"""
    SELECT url, min(seq) AS id, arg_max(title, seq) AS title FROM {_STORED} GROUP BY url""")
def atomic_batch(t: Tables) -> DataFrame:
    """A batch whose last rows stop the job leaves the store as it was."""
    store = _store(t)
    rows = _article_rows(t.batch.withColumn("uplifting_score", F.lit(1.0)))
    title = F.when(F.col("title") > "Z", F.raise_error(F.lit("bad row")).cast("string")).otherwise(F.col("title"))
    try:
        store.upsert("crawled_articles", rows.withColumn("title", title))
    except Exception as problem:  # noqa: BLE001
        if "bad row" not in str(problem):
            raise
    return store.scan("crawled_articles", ["url", "id", "title"])


@check("purge_store", f"""
    SELECT url, id FROM (SELECT url, min(seq) AS id, arg_max(uplifting_score, seq) AS s
                         FROM {_STORED} WHERE uplifting_score >= 0.6 GROUP BY url) WHERE s >= 0.75""")
def purge_store(t: Tables) -> DataFrame:
    store = _store(t)
    store.purge("articles", is_below(0.75))
    return store.scan("articles", ["url", "id"])


# --- whole runs --------------------------------------------------------------

_NEW = """(SELECT s.* FROM v_scored s
           WHERE s.seq NOT IN (SELECT doc_id FROM labels)
             AND s.url NOT IN (SELECT url FROM v_labelled)
             AND NOT EXISTS (SELECT 1 FROM v_raw k WHERE k.title = s.title AND k.published_at = s.published_at))"""

_FINAL = f"""
    SELECT url, title, category, uplifting_score FROM (
        SELECT url, arg_max(title, seq) AS title, CAST(NULL AS VARCHAR) AS category, arg_max(uplifting_score, seq) AS uplifting_score
        FROM {_STORED} WHERE uplifting_score >= 0.6 GROUP BY url) WHERE uplifting_score >= 0.75
    UNION ALL
    SELECT url, arg_max(title, seq), arg_max(category, seq), arg_max(uplifting_score, seq)
    FROM (SELECT *, CASE WHEN contains(lower(body), 'the') THEN 'Health' ELSE 'Sports' END AS category FROM {_NEW})
    WHERE is_uplifting GROUP BY url"""


def _options() -> RunOptions:
    def topics(text):
        share = F.contains(F.lower(text), F.lit("the")).cast("double")
        return F.create_map(F.lit("Health"), share, F.lit("Sports"), F.lit(0.5))

    return RunOptions(
        source_thresholds=THRESHOLDS, scorer=rule_scorer(POSITIVE, NEGATIVE), base_hints=BASE,
        topic_scorer=topics, summary_mode="title",
    )


_HEADLINES = ["seq", "title", "url", "source_id", "published_at"]


@check("run_batch", _FINAL.replace("lower(body)", "lower(title)"))
def run_batch_(t: Tables) -> DataFrame:
    store = _store(t)
    run_batch(store, t.batch.select(*_HEADLINES), _options())
    return store.scan("articles", ["url", "title", "category", "uplifting_score"])


@check("run_counts", f"""
    SELECT (SELECT count(*) FROM v_batch) AS articles_fetched,
           count(*) FILTER (WHERE is_uplifting) AS articles_classified,
           count(*) FILTER (WHERE is_uplifting) AS articles_stored,
           round(avg(uplifting_score) FILTER (WHERE is_uplifting), 6) AS avg_score, CAST(NULL AS VARCHAR) AS errors
    FROM {_NEW}""")
def run_counts(t: Tables) -> DataFrame:
    store = _store(t)
    run_batch(store, t.batch.select(*_HEADLINES), _options())
    return store.scan("crawl_metrics").select(
        "articles_fetched", "articles_classified", "articles_stored",
        F.round("avg_classification_score", 6).alias("avg_score"), "errors",
    )


# Arrivals by digits of the title's hash, in this order: all rows of a url, and of a title and date,
# arrive together, as a later batch would find them known.
_ARRIVAL = "((substring(md5(title), 1, 1) >= '8')::INT * 2 + (substring(md5(title), 2, 1) >= '8')::INT)"

# Every batch purges what lies below the threshold of the run before it adds its rows, so rows of lenient
# sources live until the next batch that has new rows.
_STREAMED = f"""
    SELECT url, title, category, uplifting_score FROM ({_FINAL}) WHERE url NOT IN (
        SELECT url FROM (SELECT *, {_ARRIVAL} AS arrival, max({_ARRIVAL}) OVER () AS newest FROM {_NEW})
        WHERE is_uplifting AND arrival < newest AND uplifting_score < 0.75)"""


@check("incremental_ingest", _STREAMED)
def incremental_ingest(t: Tables) -> DataFrame:
    """The batch arrives by two streams, each in two arrivals of any number of files; every arrival is one batch.

    Articles arrive, are categorized and are stored with their whole texts.
    """
    store, options = _store(t), replace(_options(), topic_chars=None)
    rows = t.batch.select(*_HEADLINES, "body")
    digit = lambda i: (F.substring(F.md5("title"), i, 1) >= "8").cast("int")
    for half in (0, 1):
        arrivals, checkpoint = new_folder(t.spark, "arrivals"), new_folder(t.spark, "checkpoint")
        for part in (0, 1):
            rows.filter((digit(1) == half) & (digit(2) == part)).write.mode("append").parquet(arrivals)
            stream = t.spark.readStream.schema(rows.schema).parquet(arrivals)
            ingest_stream(store, stream, checkpoint, options).awaitTermination()
    return store.scan("articles", ["url", "title", "category", "uplifting_score"])


@check("stream_dedup", "SELECT DISTINCT url FROM v_articles")
def stream_dedup(t: Tables) -> DataFrame:
    """Four arrivals, an hour apart, in about four batches; the dates of the articles differ by years and in any order."""
    arrivals, sink = new_folder(t.spark, "arrivals"), new_folder(t.spark, "unique")
    rows = t.articles.select("url", "published_at", minutes_after_epoch(F.col("seq") % 4 * 60).alias("crawled_at"))
    for hour in range(4):
        rows.filter(F.col("crawled_at") == minutes_after_epoch(F.lit(hour * 60))).write.mode("append").parquet(arrivals)
    files = len(t.spark.read.schema(rows.schema).parquet(arrivals).inputFiles())
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // 4)).parquet(arrivals)
    query = (
        drop_repeats(stream).writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", new_folder(t.spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(sink).select("url")


@check("stream_dedup_restart", """
    SELECT url, min(seq % 4) AS hour FROM v_articles GROUP BY url""")
def stream_dedup_restart(t: Tables) -> DataFrame:
    """Four arrivals; the query is stopped and started again after each of them."""
    arrivals, sink, checkpoint = (new_folder(t.spark, n) for n in ("arrivals", "unique", "checkpoint"))
    hour = F.col("seq") % 4
    rows = t.articles.select("url", hour.alias("hour"), minutes_after_epoch(hour * 60).alias("crawled_at"))
    for i in range(4):
        rows.filter(F.col("hour") == i).write.mode("append").parquet(arrivals)
        stream = t.spark.readStream.schema(rows.schema).parquet(arrivals)
        write_unique(stream, sink, checkpoint).awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(sink).select("url", "hour")
