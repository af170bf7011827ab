"""Dedup, lookups and set operations."""

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import Tables, stamp
from gladwire.operators import dedup, lookup
from gladwire.functions.dates import format_datetime

_BATCH = ["seq", "url", "title", "source_id"]

_URL_NEW = """NOT EXISTS (SELECT 1 FROM v_raw k WHERE k.url = b.url)
          AND NOT EXISTS (SELECT 1 FROM v_final k WHERE k.url = b.url)"""
_TITLE_NEW = """NOT EXISTS (SELECT 1 FROM v_raw k WHERE k.title = b.title AND k.published_at = b.published_at)
          AND NOT EXISTS (SELECT 1 FROM v_final k WHERE k.title = b.title AND k.published_at = b.published_at)"""


@check("url_anti_dedup", f"SELECT seq, url, title, source_id FROM v_batch b WHERE {_URL_NEW}")
def url_anti_dedup(t: Tables) -> DataFrame:
    return dedup.drop_known_urls(t.batch, dedup.known_urls(t.raw, t.final)).select(*_BATCH)


@check("batch_except_known", f"""
    SELECT url, count(*) AS copies FROM v_batch b WHERE {_URL_NEW} GROUP BY url""")
def batch_except_known(t: Tables) -> DataFrame:
    fresh = dedup.drop_known_urls(t.batch.select("url"), dedup.known_urls(t.raw, t.final))
    return fresh.groupBy("url").agg(F.count("*").alias("copies"))


@check("title_date_anti_dedup", f"SELECT seq, url, title, source_id FROM v_batch b WHERE {_TITLE_NEW}")
def title_date_anti_dedup(t: Tables) -> DataFrame:
    return dedup.drop_known_titles(t.batch, dedup.known_pairs(t.raw, t.final)).select(*_BATCH)


@check("title_day_anti_dedup", """
    SELECT seq, url, title, source_id FROM v_batch b
    WHERE NOT EXISTS (SELECT 1 FROM v_final k WHERE k.title = b.title
                      AND CAST(k.published_at AS DATE) = CAST(b.published_at AS DATE))""")
def title_day_anti_dedup(t: Tables) -> DataFrame:
    known = dedup.known_pairs(t.final, t.final)
    return dedup.drop_known_titles_by_day(t.batch, known).select(*_BATCH)


@check("dedup_both_passes", f"""
    SELECT seq, url, title, source_id FROM v_batch b WHERE {_URL_NEW} AND {_TITLE_NEW}""")
def dedup_both_passes(t: Tables) -> DataFrame:
    return dedup.drop_known(t.batch, t.raw, t.final).select(*_BATCH)


@check("dedup_counts", f"""
    SELECT (SELECT count(*) FROM v_batch) - count(*) AS skipped, count(*) AS fresh
    FROM v_batch b WHERE {_URL_NEW} AND {_TITLE_NEW}""")
def dedup_counts(t: Tables) -> DataFrame:
    new = dedup.drop_known(t.batch, t.raw, t.final).select(F.lit(1).alias("fresh"), F.lit(0).alias("fetched"))
    rows = t.batch.select(F.lit(0).alias("fresh"), F.lit(1).alias("fetched")).unionByName(new)
    return rows.agg(
        (F.sum("fetched") - F.sum("fresh")).alias("skipped"), F.sum("fresh").alias("fresh")
    )


@check("existing_urls", """
    SELECT DISTINCT url FROM v_batch
    WHERE url IN (SELECT url FROM v_raw UNION SELECT url FROM v_final)""")
def existing_urls(t: Tables) -> DataFrame:
    return dedup.existing_urls(t.batch, t.raw, t.final)


@check("article_exists", """
    SELECT w.which, EXISTS (SELECT 1 FROM v_raw r WHERE r.url = w.url) OR EXISTS (SELECT 1 FROM v_final f WHERE f.url = w.url) AS found
    FROM (SELECT 'missing' AS which, 'https://src5.example.org/a/' || md5('missing') AS url
          UNION ALL SELECT 'stored', max(url) FROM v_labelled
          UNION ALL SELECT 'new', max(url) FROM v_batch) w""")
def article_exists(t: Tables) -> DataFrame:
    wanted = {
        "missing": "https://src5.example.org/a/" + hashlib.md5(b"missing").hexdigest(),
        "stored": t.labelled.agg(F.max("url")).first()[0], "new": t.batch.agg(F.max("url")).first()[0],
    }
    one = [dedup.article_exists(url, t.raw, t.final).select(F.lit(which).alias("which"), "found") for which, url in wanted.items()]
    return one[0].unionByName(one[1]).unionByName(one[2])


@check("source_id_lookup", """
    SELECT min(id) FILTER (WHERE source_id = 'src12') AS id FROM v_sources""")
def source_id_lookup(t: Tables) -> DataFrame:
    return lookup.source_id_of("src12", t.sources)


@check("known_urls_union", "SELECT url FROM v_raw UNION SELECT url FROM v_final")
def known_urls_union(t: Tables) -> DataFrame:
    return dedup.known_urls(t.raw, t.final)


@check("known_pairs_union", f"""
    SELECT title, {stamp("published_at")} AS published_at
    FROM (SELECT title, published_at FROM v_raw UNION SELECT title, published_at FROM v_final)""")
def known_pairs_union(t: Tables) -> DataFrame:
    pairs = dedup.known_pairs(t.raw, t.final).distinct()
    return pairs.withColumn("published_at", format_datetime("published_at"))


@check("resolve_source_id", """
    SELECT a.seq, a.url, s.id AS source_id FROM v_articles a JOIN v_sources s USING (source_id)""")
def resolve_source_id(t: Tables) -> DataFrame:
    return lookup.with_source_ids(t.articles.select("seq", "url", "source_id"), t.sources)


@check("articles_join_sources", f"""
    SELECT a.id, a.title, s.name AS source_name, s.domain AS source_domain,
           {stamp("a.published_at")} AS published_at
    FROM v_final a JOIN v_sources s ON s.source_id = a.source_id""")
def articles_join_sources(t: Tables) -> DataFrame:
    stored = lookup.with_source_ids(t.final, t.sources)
    named = lookup.newest_first(lookup.with_source_names(stored, t.sources))
    return named.select(
        "id", "title", "source_name", "source_domain", format_datetime("published_at").alias("published_at")
    )


@check("bookmark_join", """
    SELECT m.article_id, m.session_uuid, m.bookmark_id, a.title
    FROM (SELECT value_id AS article_id, session_uuid, min(event_id) AS bookmark_id
          FROM (SELECT event_id, CAST(floor(value * 10) AS BIGINT) AS value_id,
                       'u' || user_id AS session_uuid FROM events)
          GROUP BY ALL) m
    JOIN v_final a ON a.id = m.article_id""")
def bookmark_join(t: Tables) -> DataFrame:
    bookmarks = t.read("events").select(
        F.col("event_id").alias("id"), F.floor(F.col("value") * 10).cast("long").alias("article_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("session_uuid"),
        F.col("ts").alias("created_at"),
    )
    joined = lookup.bookmarked_articles(bookmarks, t.final.select("id", "title"))
    return joined.select("article_id", "session_uuid", "bookmark_id", "title")


@check("cache_lookup", """
    SELECT b.seq, r.body IS NOT NULL AS hit,
           CASE WHEN r.quality = 1 THEN r.title END AS cached
    FROM v_articles b LEFT JOIN v_raw r ON r.url = b.url""")
def cache_lookup(t: Tables) -> DataFrame:
    cache = t.raw.select("url", F.when(F.col("quality") == 1, F.col("title")).alias("cached"))
    return lookup.cache_lookup(t.articles.select("seq", "url"), cache, "url").select("seq", "hit", "cached")


@check("cache_misses", "SELECT b.seq FROM v_articles b WHERE NOT EXISTS (SELECT 1 FROM v_raw r WHERE r.url = b.url)")
def cache_misses(t: Tables) -> DataFrame:
    return lookup.cache_misses(t.articles.select("seq", "url"), t.raw, "url").select("seq")
