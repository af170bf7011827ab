"""Categories and summaries."""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.views import INPUT_TEXT, TOPIC_WORDS, Tables, hits
from gladwire.functions.labels import category_key
from gladwire.operators import enrich, models

_LABELS = tuple(TOPIC_WORDS)


def _score_columns(text: str, labels) -> str:
    return ", ".join(
        f"{hits(text, TOPIC_WORDS[label])} / ({hits(text, TOPIC_WORDS[label])} + 1.0::DOUBLE) AS s{i}"
        for i, label in enumerate(labels)
    )


def _top(labels) -> tuple[str, str]:
    best = "greatest(" + ", ".join(f"s{i}" for i in range(len(labels))) + ")"
    names = " ".join(f"WHEN s{i} = {best} THEN '{label}'" for i, label in enumerate(labels))
    return best, f"CASE {names} END"


def _scored(labels, title: str = "title") -> str:
    text = INPUT_TEXT.replace("title", title)
    return f"(SELECT *, {_score_columns('input', labels)} FROM (SELECT *, {text} AS input FROM v_articles))"


_BEST, _NAME = _top(_LABELS)
_SCORES = ", ".join(f"s{i}" for i in range(len(_LABELS)))


def _flat(scores, labels=_LABELS):
    return [scores[label].alias(f"s{i}") for i, label in enumerate(labels)]


@check("topic_scores", f"""
    SELECT seq, {_SCORES}, {_NAME} AS category, {_BEST} AS confidence FROM {_scored(_LABELS)}""")
def topic_scores(t: Tables) -> DataFrame:
    done, _ = enrich.categorize(t.articles, enrich.lexicon_topic_scorer(TOPIC_WORDS))
    return done.select(
        "seq", *_flat(F.col("category_scores")), "category",
        F.col("category_confidence").alias("confidence"),
    )


_OWN = ("Sports", "Health")
_OWN_BEST, _OWN_NAME = _top(_OWN)


@check("multilabel_scores", f"""
    SELECT seq, s0, s1, {_OWN_NAME} AS category FROM {_scored(_OWN)}""")
def multilabel_scores(t: Tables) -> DataFrame:
    own = {label: TOPIC_WORDS[label] for label in _OWN}
    done, _ = enrich.categorize(t.articles, enrich.lexicon_topic_scorer(own), _OWN)
    return done.select("seq", *_flat(F.col("category_scores"), _OWN), "category")


@check("empty_title_categories", f"""
    SELECT seq, CASE WHEN lang <> 'de' THEN {_NAME} END AS category,
           CASE WHEN lang <> 'de' THEN {_BEST} ELSE 0.0::DOUBLE END AS confidence,
           CASE WHEN lang <> 'de' THEN {len(_LABELS)} ELSE 0 END AS labels
    FROM {_scored(_LABELS)}""")
def empty_title_categories(t: Tables) -> DataFrame:
    rows = t.articles.withColumn("title", F.when(F.col("lang") != "de", F.col("title")).otherwise(""))
    done, _ = enrich.categorize(rows, enrich.lexicon_topic_scorer(TOPIC_WORDS))
    return done.select(
        "seq", "category", F.col("category_confidence").alias("confidence"),
        F.size("category_scores").alias("labels"),
    )


_PROBABILITIES = "least(1.0::DOUBLE, length(title) / 400.0::DOUBLE)"


@check("categorize_batch", f"""
    SELECT seq, CASE WHEN p >= 0.5 THEN 'Health' ELSE 'World' END AS category, greatest(p, 0.5::DOUBLE) AS confidence
    FROM (SELECT seq, least(1.0::DOUBLE, length({INPUT_TEXT}) / 400.0::DOUBLE) AS p FROM v_articles)""")
def categorize_batch(t: Tables) -> DataFrame:
    @F.pandas_udf("array<double>")
    def predict(texts: pd.Series) -> pd.Series:
        share = (texts.str.len() / 400.0).clip(upper=1.0)
        return pd.Series([[p, 0.5, 0.75] for p in share])

    scorer = enrich.probabilities_scorer(predict, ["Health", "World", "Other"])
    done, _ = enrich.categorize(t.articles, scorer, ("Health", "World"), once_per_text=True)
    return done.select("seq", "category", F.col("category_confidence").alias("confidence"))


@check("categorize_cached", f"""
    SELECT seq, CASE WHEN EXISTS (SELECT 1 FROM v_raw r WHERE r.title = a.title AND r.body = a.body)
                     THEN 'cached' ELSE {_NAME} END AS category
    FROM {_scored(_LABELS)} a""")
def categorize_cached(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(label) for label in _LABELS])
    cache = t.raw_with_body.select(category_key("title", "body", names).alias("cache_key")).distinct().select(
        "cache_key", F.lit("cached").alias("category"),
        F.create_map(F.lit("cached"), F.lit(1.0)).alias("scores"), F.lit(1.0).alias("confidence"),
    )
    done, _ = enrich.categorize(t.articles, enrich.lexicon_topic_scorer(TOPIC_WORDS), _LABELS, cache)
    return done.select("seq", "category")


_LEAD = r"""list_aggregate(regexp_extract_all(
    list_aggregate(regexp_extract_all(text, '[^.!?]+[.!?]*')[1:3], 'string_agg', ''), '\S+')[1:130],
    'string_agg', ' ')"""
_STRIPPED = r"regexp_replace(body, '^\s+|\s+$', '', 'g')"
_SHORT = r"len(regexp_extract_all(body, '\S+')) < 30"


@check("summarize_batch", f"""
    SELECT seq, CASE WHEN lang = 'de' THEN '' WHEN {_SHORT} THEN {_STRIPPED} ELSE {_LEAD} END AS summary
    FROM (SELECT *, substring({_STRIPPED}, 1, 3800) AS text FROM v_articles)""")
def summarize_batch(t: Tables) -> DataFrame:
    rows = t.articles.withColumn("text", F.when(F.col("lang") != "de", F.col("body")).otherwise(" \n"))
    done, _ = enrich.summarize_texts(rows)
    return done.select("seq", "summary")


@check("summarize_once_per_text", rf"""
    SELECT seq, CASE WHEN {_SHORT} THEN {_STRIPPED} ELSE regexp_replace('* ' || substring({_STRIPPED}, 1, 80), '\s+$', '') END AS summary
    FROM v_articles""")
def summarize_once_per_text(t: Tables) -> DataFrame:
    def head(text):
        return F.concat(F.lit("* "), F.substring(text, 1, 80))

    done, _ = enrich.summarize_texts(t.articles, "body", head, once_per_text=True)
    return done.select("seq", "summary")


@check("summary_mode", f"""
    SELECT seq, 'title' AS mode, title AS summary FROM v_articles
    UNION ALL SELECT seq, 'none', NULL FROM v_articles
    UNION ALL SELECT seq, 'summary', CASE WHEN {_SHORT} THEN {_STRIPPED} ELSE {_LEAD} END
    FROM (SELECT *, substring({_STRIPPED}, 1, 3800) AS text FROM v_articles)""")
def summary_mode(t: Tables) -> DataFrame:
    parts = [
        enrich.add_summaries(t.articles, mode).select("seq", F.lit(mode).alias("mode"), "summary")
        for mode in ("title", "none", "summary")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _load_topics():
    """Labels by lengths and letters of the text, with weights that are exact in binary."""
    import numpy as np

    def predict(texts):
        return np.array([[len(t) / 1024, t.count("e") / 128, t.count("a") / 128] for t in texts], dtype=np.float64)

    return predict


_BATCH_LABELS = ("Health", "Sports", "Education")
_BATCH_BEST, _BATCH_NAME = _top(_BATCH_LABELS)


@check("topic_scores_batches", f"""
    SELECT seq, s0, s1, s2, {_BATCH_NAME} AS category, {_BATCH_BEST} AS confidence FROM (
        SELECT *, length(input) / 1024.0::DOUBLE AS s0, (length(input) - length(replace(input, 'e', ''))) / 128.0::DOUBLE AS s1,
               (length(input) - length(replace(input, 'a', ''))) / 128.0::DOUBLE AS s2
        FROM (SELECT *, {INPUT_TEXT} AS input FROM v_articles))""")
def topic_scores_batches(t: Tables) -> DataFrame:
    """A model of topics that is loaded once per worker and scores batches."""
    scorer = enrich.probabilities_scorer(models.batch_model(_load_topics), _BATCH_LABELS)
    done, _ = enrich.categorize(t.articles, scorer, _BATCH_LABELS)
    return done.select(
        "seq", *_flat(F.col("category_scores"), _BATCH_LABELS), "category", F.col("category_confidence").alias("confidence")
    )
