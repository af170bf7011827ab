"""Scores, thresholds and decisions."""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import (
    BASE, NEGATIVE, POSITIVE, STRICT_LIST, THRESHOLDS, Tables, hit, hits, rule_score, threshold_of,
)
from gladwire.functions.text import has_hint, hint_hit_count
from gladwire.operators import articles as article_ops
from gladwire.operators import models, scoring


@check("has_hint", f"SELECT seq, {hits('title', BASE)} > 0 AS hinted FROM v_articles")
def has_hint_(t: Tables) -> DataFrame:
    return t.articles.select("seq", has_hint("title", BASE).alias("hinted"))


@check("hint_hit_counts", f"""
    SELECT seq, {hits('body', POSITIVE)} AS positive, {hits('body', NEGATIVE)} AS negative FROM v_articles""")
def hint_hit_counts(t: Tables) -> DataFrame:
    return t.articles.select(
        "seq", hint_hit_count("body", POSITIVE).alias("positive"),
        hint_hit_count("body", NEGATIVE).alias("negative"),
    )


@check("lexicon_match", " UNION ALL ".join(
    f"SELECT seq, '{w}' AS hint FROM v_articles WHERE {hit('title', w)} = 1"
    for w in (*POSITIVE, "of the", "de la")))
def lexicon_match(t: Tables) -> DataFrame:
    words = [(w,) for w in (*POSITIVE, "of the", "de la")]
    lexicon = t.spark.createDataFrame(words, "hint string")
    return scoring.match_lexicon(t.articles, lexicon).select("seq", "hint")


@check("lexicon_match_table", r"""
    WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(body), '[\p{L}\p{N}_]+')) AS hint FROM v_articles),
    own AS (SELECT seq, title, unnest(list_distinct(regexp_extract_all(lower(title), '[\p{L}\p{N}_]+'))) AS hint FROM v_articles)
    SELECT seq, hint FROM own WHERE hint IN (SELECT hint FROM words)
    UNION ALL SELECT seq, '!!' FROM v_articles WHERE regexp_matches(title, '[\p{L}\p{N}_]!![\p{L}\p{N}_]')
    UNION ALL SELECT seq, '. ' FROM v_articles WHERE regexp_matches(title, '[\p{L}\p{N}_]\. [\p{L}\p{N}_]')
    UNION ALL SELECT seq, '' FROM v_articles WHERE regexp_matches(title, '[\p{L}\p{N}_]')""")
def lexicon_match_table(t: Tables) -> DataFrame:
    """All words of all texts as a lexicon, and hints without a letter."""
    words = t.articles.select(F.explode(F.regexp_extract_all(F.lower("body"), F.lit(r"([\p{L}\p{N}_]+)"))).alias("hint")).distinct()
    signs = t.spark.createDataFrame([("!!",), (". ",), ("",)], "hint string")
    return scoring.match_lexicon(t.articles, words.unionByName(signs)).select("seq", "hint")


@check("rule_score", f"""
    SELECT seq, 1.0::DOUBLE - score AS negative, score AS positive
    FROM (SELECT seq, {rule_score('title')} AS score FROM v_articles)""")
def rule_score_(t: Tables) -> DataFrame:
    score = scoring.rule_scorer(POSITIVE, NEGATIVE)(F.col("title"))
    pair = t.articles.select("seq", scoring.probability_pair(score).alias("p"))
    return pair.select("seq", F.get("p", F.lit(0)).alias("negative"), F.get("p", F.lit(1)).alias("positive"))


@check("threshold_join", f"SELECT seq, {threshold_of('source_id')} AS min_threshold FROM v_articles")
def threshold_join(t: Tables) -> DataFrame:
    table = t.spark.createDataFrame(list(THRESHOLDS.items()), "source_id string, threshold double")
    return scoring.with_threshold(t.articles, table).select("seq", "min_threshold")


@check("uplift_decision", f"""
    SELECT seq, score >= threshold AND (source_id NOT IN ({STRICT_LIST}) OR {hits('title', BASE)} > 0)
           AS is_uplifting
    FROM (SELECT *, n_chars / 2000.0::DOUBLE AS score, {threshold_of('source_id')} AS threshold
          FROM v_articles)""")
def uplift_decision(t: Tables) -> DataFrame:
    rows = scoring.with_threshold(t.articles, THRESHOLDS)
    decided = scoring.uplift_decision(
        F.col("n_chars") / F.lit(2000.0), "min_threshold", "is_strict", has_hint("title", BASE)
    )
    return rows.select("seq", decided.alias("is_uplifting"))


_SCORED = ["seq", "uplifting_score", "min_threshold", "is_uplifting"]


@check("score_news", "SELECT seq, uplifting_score, min_threshold, is_uplifting FROM v_scored")
def score_news(t: Tables) -> DataFrame:
    return t.scored.select(*_SCORED)


@check("filter_positive", "SELECT seq, uplifting_score FROM v_scored WHERE is_uplifting")
def filter_positive(t: Tables) -> DataFrame:
    return scoring.filter_positive(t.scored).select("seq", "uplifting_score")


@check("purge_non_uplifting", """
    SELECT seq, uplifting_score FROM v_scored WHERE uplifting_score IS NOT NULL AND uplifting_score >= 0.6""")
def purge_non_uplifting(t: Tables) -> DataFrame:
    return scoring.purge_below(t.scored, 0.6).select("seq", "uplifting_score")


@check("purge_count", """
    SELECT count(*) AS purged FROM (SELECT CASE WHEN lang <> 'fr' THEN uplifting_score END AS s FROM v_scored)
    WHERE s IS NULL OR s < 0.6""")
def purge_count(t: Tables) -> DataFrame:
    score = F.when(F.col("lang") != "fr", F.col("uplifting_score"))
    rows = t.scored.withColumn("uplifting_score", score)
    return scoring.below_threshold(rows, 0.6).agg(F.count("*").alias("purged"))


@check("raw_flag_default", """
    SELECT seq, coalesce(CASE WHEN lang = 'fr' THEN is_uplifting END,
                         CASE WHEN lang <> 'de' THEN uplifting_score >= 0.75 END, false) AS flag
    FROM v_scored""")
def raw_flag_default(t: Tables) -> DataFrame:
    given = F.when(F.col("lang") == "fr", F.col("is_uplifting"))
    score = F.when(F.col("lang") != "de", F.col("uplifting_score"))
    return t.scored.select("seq", article_ops.raw_flag(given, score).alias("flag"))


@check("yes_no_projection", """
    SELECT seq, CASE WHEN coalesce(CASE WHEN lang <> 'fr' THEN is_uplifting END, false)
                     THEN 'yes' ELSE 'no' END AS uplifting FROM v_scored""")
def yes_no_projection(t: Tables) -> DataFrame:
    flag = F.when(F.col("lang") != "fr", F.col("is_uplifting"))
    return t.scored.select("seq", article_ops.yes_no(flag).alias("uplifting"))


@check("scorer_select", """
    SELECT seq, 0.1::DOUBLE AS by_rules, least(1.0::DOUBLE, length(title) / 200.0::DOUBLE) AS by_model
    FROM v_articles""")
def scorer_select(t: Tables) -> DataFrame:
    def model(title):
        return F.least(F.lit(1.0), F.length(title) / F.lit(200.0))

    rules, chosen = scoring.select_scorer("rules", model), scoring.select_scorer("model", model)
    return t.articles.select(
        "seq", rules(F.col("title")).alias("by_rules"), chosen(F.col("title")).alias("by_model")
    )


@check("override_hooks", """
    SELECT seq, score AS uplifting_score, score >= 0.75 AS is_uplifting
    FROM (SELECT seq, least(1.0::DOUBLE, length(title) / 200.0::DOUBLE) AS score FROM v_articles)""")
def override_hooks(t: Tables) -> DataFrame:
    @F.pandas_udf("array<double>")
    def model(titles: pd.Series) -> pd.Series:
        positive = (titles.str.len() / 200.0).clip(upper=1.0)
        return pd.Series([[1.0 - p, p] for p in positive])

    rows = t.articles.select("seq", "title")
    return scoring.score_news(rows, model).select("seq", "uplifting_score", "is_uplifting")


# --- models ------------------------------------------------------------------


def _load_linear():
    """A linear model on the length of a title and its letters e, with weights that are exact in binary."""
    import numpy as np

    weights = np.array([0.0078125, 0.03125])

    def predict(titles):
        features = np.array([[len(t), t.count("e")] for t in titles], dtype=np.float64)
        positive = np.clip(0.125 + features @ weights, 0.0, 1.0)
        return np.stack([1.0 - positive, positive], axis=1)

    return predict


_LINEAR = """least(1.0::DOUBLE, 0.125::DOUBLE + 0.0078125::DOUBLE * length(title)
             + 0.03125::DOUBLE * (length(title) - length(replace(title, 'e', ''))))"""


@check("score_news_batches", f"""
    SELECT seq, score AS uplifting_score, min_threshold,
           score >= min_threshold AND (source_id NOT IN ({STRICT_LIST}) OR {hits('title', BASE)} > 0) AS is_uplifting
    FROM (SELECT *, {_LINEAR} AS score, {threshold_of('source_id')} AS min_threshold FROM v_articles)""")
def score_news_batches(t: Tables) -> DataFrame:
    """A model that is loaded once per worker and scores batches."""
    scored = scoring.score_news(t.articles, models.batch_model(_load_linear), 0.75, THRESHOLDS, BASE)
    return scored.select(*_SCORED)


_VOCABULARY = (*POSITIVE, *NEGATIVE)
_COUNTS = ", ".join(
    rf"len(list_filter(regexp_extract_all(lower(title), '[\p{{L}}\p{{N}}_]+'), lambda x: x = '{w}')) AS c{i}"
    for i, w in enumerate(_VOCABULARY)
)
_SUMS = ", ".join(f"sum(c{i}) AS c{i}" for i in range(len(_VOCABULARY)))
_ALL = " + ".join(f"m.c{i}" for i in range(len(_VOCABULARY)))
_LIKELY = " + ".join(f"a.c{i} * ln((m.c{i} + 1) / ({_ALL} + {len(_VOCABULARY)}))" for i in range(len(_VOCABULARY)))


@check("score_news_fitted", f"""
    WITH a AS (SELECT *, {_COUNTS} FROM v_articles),
    m AS (SELECT quality, count(*) AS docs, {_SUMS} FROM a JOIN labels ON doc_id = seq GROUP BY quality),
    scores AS (
        SELECT seq, quality, ln((m.docs + 1) / ((SELECT sum(docs) FROM m) + 2)) + {_LIKELY} AS s FROM a, m),
    pairs AS (SELECT seq, sum(s) FILTER (WHERE quality = 1) - sum(s) FILTER (WHERE quality = 0) AS ahead FROM scores GROUP BY seq)
    SELECT seq, round(1 / (1 + exp(-ahead)), 6) AS uplifting_score, ahead > 0 AS likely FROM pairs""")
def score_news_fitted(t: Tables) -> DataFrame:
    """Naive Bayes fitted by Spark on the labelled articles, as the scorer of all."""
    model = models.fit_headlines(t.labelled.withColumn("label", F.col("quality").cast("double")), _VOCABULARY)
    scored = scoring.score_news(t.articles, model, 0.5, {"no such source": 0.5})
    return scored.select("seq", F.round("uplifting_score", 6).alias("uplifting_score"), F.col("uplifting_score").__gt__(0.5).alias("likely"))
