"""Articles, stores, sources and feeds made from the driver tables, in Spark and in SQL.

A document is an article: its first line is the title. Documents with a label
are the stored ones, the others are the new batch.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gladwire.functions.text import trim_title
from gladwire.operators.merge import collapse
from gladwire.operators.scoring import rule_scorer, score_news

# words of the generated texts, in place of the built-in word lists
POSITIVE = ("that", "with", "this", "anea", "tion")
NEGATIVE = ("from", "nicht", "than")
BASE = ("that", "with", "this")
THRESHOLDS = {"src0": 0.9, "src5": 0.93, "src12": 0.6}
TOPIC_WORDS = {
    "Health": ("the", "that"),
    "Environment": ("les", "que"),
    "Community": ("der", "und"),
    "Science & Tech": ("los", "una"),
    "Education": ("with", "avec"),
    "Sports": ("from", "nicht"),
    "Arts & Culture": ("tion", "con"),
}

EPOCH = "2024-01-01 00:00:00"


def minutes_after_epoch(minutes: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + minutes.cast("long") * 60)


class Tables:
    """The driver tables and the views on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def articles(self) -> DataFrame:
        title = trim_title(F.split_part("text", F.lit("\n"), F.lit(1)))
        site = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org"))
        return self.read("documents").select(
            F.col("doc_id").alias("seq"), title.alias("title"), F.col("text").alias("body"), "lang",
            F.col("source").alias("source_id"), "n_chars",
            F.concat(site, F.lit("/a/"), F.md5(title)).alias("url"),
            minutes_after_epoch(F.col("n_chars")).alias("published_at"),
        ).withColumn("link", F.concat("url", F.lit("?ref="), "lang", F.lit("#top")))

    @cached_property
    def labelled(self) -> DataFrame:
        labels = self.read("labels").select(F.col("doc_id").alias("seq"), "quality")
        return self.articles.join(labels, "seq").withColumn("id", F.col("seq"))

    @cached_property
    def batch(self) -> DataFrame:
        labels = self.read("labels").select(F.col("doc_id").alias("seq"))
        return self.articles.join(labels, "seq", "left_anti")

    @cached_property
    def raw(self) -> DataFrame:
        return self._stored(self.labelled.drop("body"))

    @cached_property
    def raw_with_body(self) -> DataFrame:
        return self._stored(self.labelled)

    @cached_property
    def final(self) -> DataFrame:
        return self._stored(self.labelled.filter(F.col("quality") == 1).drop("body"))

    def _stored(self, rows: DataFrame) -> DataFrame:
        return collapse(rows, "url", "seq", kept=("id", "source_id"))

    @cached_property
    def scored(self) -> DataFrame:
        """All articles with score and flag, by the words of the texts."""
        return score_news(
            self.articles, rule_scorer(POSITIVE, NEGATIVE), 0.75, THRESHOLDS, BASE
        )

    @cached_property
    def sources(self) -> DataFrame:
        number = F.substring("source", 4, 10).cast("long")
        domain = F.concat(F.col("source"), F.lit(".example.org"))
        seen = self.read("documents").groupBy("source").agg(F.min("lang").alias("category"))
        return seen.select(
            number.alias("id"), F.col("source").alias("source_id"),
            F.upper("source").alias("name"), domain.alias("domain"),
            F.concat(F.lit("https://"), domain, F.lit("/rss")).alias("rss_url"), "category",
        )


# --- the same in SQL ---------------------------------------------------------


def hit(text: str, word: str) -> str:
    """Whether a word occurs as a whole word."""
    edge = r"[^\p{L}\p{N}_]"
    return rf"CAST(regexp_matches(lower({text}), '(^|{edge}){word}($|{edge})') AS INTEGER)"


def hits(text: str, words) -> str:
    return "(" + " + ".join(hit(text, w) for w in words) + ")"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def stamp(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def rule_score(text: str) -> str:
    return (
        f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.1::DOUBLE + {hits(text, POSITIVE)} * 0.65::DOUBLE"
        f" - {hits(text, NEGATIVE)} * 0.15::DOUBLE))"
    )


def threshold_of(source: str, default: str = "0.75") -> str:
    whens = " ".join(f"WHEN '{s}' THEN {t}::DOUBLE" for s, t in THRESHOLDS.items())
    return f"CASE {source} {whens} ELSE {default}::DOUBLE END"


STRICT_LIST = ", ".join(f"'{s}'" for s in THRESHOLDS)

INPUT_TEXT = "CASE WHEN length(body) > 0 THEN title || '. ' || substring(body, 1, 500) ELSE title END"

VIEWS = {
    "v_articles": f"""
        SELECT seq, title, body, lang, source_id, n_chars, url, url || '?ref=' || lang || '#top' AS link,
               published_at
        FROM (
            SELECT doc_id AS seq, {strip("split_part(text, chr(10), 1)")} AS title, text AS body, lang,
                   source AS source_id, n_chars,
                   'https://' || source || '.example.org/a/'
                       || md5({strip("split_part(text, chr(10), 1)")}) AS url,
                   TIMESTAMP '{EPOCH}' + to_minutes(n_chars) AS published_at
            FROM documents)""",
    "v_labelled": """
        SELECT a.*, l.quality, a.seq AS id FROM v_articles a JOIN labels l ON l.doc_id = a.seq""",
    "v_batch": """
        SELECT a.* FROM v_articles a WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = a.seq)""",
    "v_raw": """
        SELECT url, min(seq) AS id, arg_min(source_id, seq) AS source_id, arg_max(title, seq) AS title,
               arg_max(body, seq) AS body, arg_max(lang, seq) AS lang, arg_max(n_chars, seq) AS n_chars,
               arg_max(published_at, seq) AS published_at, arg_max(quality, seq) AS quality,
               arg_max(link, seq) AS link
        FROM v_labelled GROUP BY url""",
    "v_final": """
        SELECT url, min(seq) AS id, arg_min(source_id, seq) AS source_id, arg_max(title, seq) AS title,
               arg_max(body, seq) AS body, arg_max(lang, seq) AS lang, arg_max(n_chars, seq) AS n_chars,
               arg_max(published_at, seq) AS published_at, arg_max(quality, seq) AS quality,
               arg_max(link, seq) AS link
        FROM v_labelled WHERE quality = 1 GROUP BY url""",
    "v_scored": f"""
        SELECT *, uplifting_score >= min_threshold
                  AND (source_id NOT IN ({STRICT_LIST}) OR {hits("title", BASE)} > 0) AS is_uplifting
        FROM (SELECT *, {rule_score("title")} AS uplifting_score,
                     {threshold_of("source_id")} AS min_threshold FROM v_articles)""",
    "v_sources": """
        SELECT CAST(substring(source, 4, 10) AS BIGINT) AS id, source AS source_id, upper(source) AS name,
               source || '.example.org' AS domain, 'https://' || source || '.example.org/rss' AS rss_url,
               min(lang) AS category
        FROM documents GROUP BY source""",
    "v_lines": """
        SELECT doc_id, lang, source, n_chars, CAST(i - 1 AS INTEGER) AS pos, lines[i] AS line
        FROM (SELECT *, string_split(text, chr(10)) AS lines FROM documents),
             LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)""",
}


def with_views(sql: str) -> str:
    """Prepend the views that a query names, in order of need."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = sql.strip()
    if re.match(r"WITH RECURSIVE\b", body):
        return f"WITH RECURSIVE {views},\n{body[len('WITH RECURSIVE'):]}"
    if re.match(r"WITH\b", body):
        return f"WITH {views},\n{body[len('WITH'):]}"
    return f"WITH {views}\n{body}"
