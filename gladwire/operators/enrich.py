"""Categories, thumbnails and summaries of articles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire import fixed
from gladwire.functions.html import thumbnail
from gladwire.functions.labels import allowed_scores, argmax_label, category_key, summary_key
from gladwire.functions.text import (
    bind, hint_hit_counts, input_text, is_blank, lead_summary, non_empty, too_short, trim_title, truncate_text,
)
from gladwire.functions.urls import favicon_url
from gladwire.operators.articles import column_or_null
from gladwire.operators.lookup import distinct_misses, fill_missing, join_results, with_cached

# A topic scorer maps the input text to a map label -> score.
TopicScorer = Callable[[Column], Column]
# A summariser maps the truncated text to its summary.
Summariser = Callable[[Column], Column]


# --- categories --------------------------------------------------------------


def lexicon_topic_scorer(lexicon: Mapping[str, Sequence[str]]) -> TopicScorer:
    """Independent score per label: hits / (1 + hits) of the label's words."""

    def score(text: Column) -> Column:
        names = F.array(*[F.lit(label) for label in lexicon])
        counts = hint_hit_counts(text, list(lexicon.values()))
        return F.map_from_arrays(names, F.transform(counts, lambda n: n / (n + F.lit(1.0))))

    return score


def probabilities_scorer(predict: Callable[[Column], Column], labels: Sequence[str]) -> TopicScorer:
    """Scorer from a model that gives one probability per label, in label order."""

    def score(text: Column) -> Column:
        names = F.array(*[F.lit(label) for label in labels])
        return F.map_from_arrays(names, predict(text).cast("array<double>"))

    return score


def _top_category(jobs: DataFrame, text: Column, scorer: TopicScorer, categories: Sequence[str]) -> DataFrame:
    """Add the scores of the allowed labels, the best label and its score."""
    scored = jobs.withColumn("scores", allowed_scores(scorer(text), categories))
    named = scored.withColumn("_best", argmax_label(F.col("scores")))
    return named.withColumn("confidence", F.col("scores")[F.col("_best")])


def _category_columns(best: str) -> dict[str, Column]:
    titled = non_empty("title").isNotNull()
    none = F.create_map().cast("map<string,double>")
    return {
        "category": F.when(titled, F.col(best)),
        "category_scores": F.when(titled, F.col("scores")).otherwise(none),
        "category_confidence": F.when(titled, F.col("confidence")).otherwise(F.lit(0.0)),
    }


def with_category_key(
    articles: DataFrame, categories: Sequence[str] = fixed.TOPICS, body: str = "body"
) -> DataFrame:
    """Add the cache key of each article, null where it has no title."""
    names = F.array(*[F.lit(c) for c in categories])
    key = category_key("title", column_or_null(articles, body), names)
    return articles.withColumn("cache_key", F.when(non_empty("title").isNotNull(), key))


def new_categories(
    keyed: DataFrame,
    scorer: TopicScorer,
    categories: Sequence[str] = fixed.TOPICS,
    cache: DataFrame | None = None,
    body: str = "body",
    limit: int | None = fixed.BODY_CHARS_FOR_TOPICS,
) -> DataFrame:
    """Cache entries for the keys that the cache lacks, each scored once."""
    texts = keyed.withColumn("_text", input_text(F.col("title"), column_or_null(keyed, body), limit))
    jobs = distinct_misses(texts, "cache_key", ["_text"], cache)
    return _top_category(jobs, F.col("_text"), scorer, categories).select(
        "cache_key", F.col("_best").alias("category"), "scores", "confidence"
    )


def fill_categories(keyed: DataFrame, entries: DataFrame) -> DataFrame:
    """Category columns from cache entries."""
    joined = join_results(keyed, entries.withColumnRenamed("category", "_best"), "cache_key")
    return joined.withColumns(_category_columns("_best")).drop("_best", "scores", "confidence", "cache_key")


def categorize(
    articles: DataFrame,
    scorer: TopicScorer,
    categories: Sequence[str] = fixed.TOPICS,
    cache: DataFrame | None = None,
    once_per_text: bool = False,
    body: str = "body",
    limit: int | None = fixed.BODY_CHARS_FOR_TOPICS,
) -> tuple[DataFrame, DataFrame | None]:
    """Add ``category``, ``category_scores`` and ``category_confidence``.

    Articles without title get a null category, no scores and confidence 0. The scorer
    gets the first ``limit`` characters of the body, or all where it is None; a cache serves one limit. An
    expression scorer runs in place, as a shuffle would cost more than it saves;
    with ``once_per_text`` or a cache each different (title, body) is scored
    once. Gives (articles, new cache entries or None).
    """
    if cache is None and not once_per_text:
        text = input_text(F.col("title"), column_or_null(articles, body), limit)
        done = _top_category(articles, text, scorer, categories)
        return done.withColumns(_category_columns("_best")).drop("_best", "scores", "confidence"), None
    keyed = with_category_key(articles, categories, body)
    fresh = new_categories(keyed, scorer, categories, cache, body, limit)
    return fill_categories(keyed, with_cached(fresh, cache)), fresh


# --- thumbnails --------------------------------------------------------------


def page_html(pages: DataFrame) -> DataFrame:
    """Pages with their HTML; none where the fetch failed or the status is 400 and up."""
    status = F.col("status")
    return pages.withColumn("html", F.when(status.isNotNull() & (status < 400), F.col("html")))


def one_page_per_url(pages: DataFrame, order: str | None = None) -> DataFrame:
    """(url, html) of one page of each url: the last by ``order`` among those that have HTML.

    Without ``order`` the largest text counts, so that the choice is the same in every run.
    """
    rank = F.struct(F.col("html").isNotNull(), F.col(order or "html"))
    return pages.filter(F.col("url").isNotNull()).groupBy("url").agg(F.max_by("html", rank).alias("html"))


def page_thumbnails(pages: DataFrame) -> DataFrame:
    """(url, thumbnail_url) of each page."""
    return page_html(pages).select("url", thumbnail("html", "url").alias("thumbnail_url"))


def new_thumbnails(articles: DataFrame, pages: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """Cache entries for the urls that the cache lacks; the icon where there is no page.

    Of several pages of a url one counts. Only pages of such urls are parsed, each once:
    ``thumbnail`` gives the icon where the join leaves no HTML.
    """
    urls = articles.select(non_empty("url").alias("url"))
    jobs = distinct_misses(urls, "url", [], cache)
    joined = jobs.join(one_page_per_url(page_html(pages)), "url", "left")
    return joined.select("url", F.coalesce(thumbnail("html", "url"), favicon_url("url")).alias("thumbnail_url"))


def fill_thumbnails(articles: DataFrame, entries: DataFrame) -> DataFrame:
    """Thumbnails from cache entries where an article has none."""
    named = entries.select("url", F.col("thumbnail_url").alias("_thumbnail"))
    return fill_missing(join_results(articles, named, "url"), "thumbnail_url", F.col("_thumbnail")).drop("_thumbnail")


def add_thumbnails(
    articles: DataFrame, pages: DataFrame, cache: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fill missing thumbnails from the pages of the articles; gives (articles, new cache entries)."""
    fresh = new_thumbnails(articles, pages, cache)
    return fill_thumbnails(articles, with_cached(fresh, cache)), fresh


# --- summaries ---------------------------------------------------------------


def summary_of(
    text: Column,
    summariser: Summariser = lead_summary,
    min_words: int = fixed.SUMMARY_MIN_WORDS,
) -> Column:
    """Null for blank text, the stripped text where it is short, else its summary."""

    def shorten(stripped: Column) -> Column:
        return F.when(stripped == "", F.lit(None)).when(too_short(stripped, min_words), stripped)

    # the summariser may be a Python function, which cannot run inside a lambda
    stripped = trim_title(text)
    unchanged = bind(stripped, shorten)
    long_text = F.when(~too_short(text, min_words), truncate_text(stripped))
    return F.coalesce(unchanged, trim_title(summariser(long_text)))


def with_summary_key(
    texts: DataFrame,
    text: Column,
    max_words: int = fixed.SUMMARY_MAX_WORDS,
    min_words: int = fixed.SUMMARY_MIN_WORDS,
) -> DataFrame:
    """Add ``summary_text`` and its cache key, null where the text is blank."""
    key = summary_key(trim_title("summary_text"), max_words, min_words)
    return texts.withColumn("summary_text", text).withColumn(
        "cache_key", F.when(~is_blank("summary_text"), key)
    )


def new_summaries(
    keyed: DataFrame,
    summariser: Summariser = lead_summary,
    min_words: int = fixed.SUMMARY_MIN_WORDS,
    cache: DataFrame | None = None,
) -> DataFrame:
    """Cache entries for the keys that the cache lacks, each summarised once."""
    jobs = distinct_misses(keyed, "cache_key", ["summary_text"], cache)
    return jobs.select(
        "cache_key", summary_of(F.col("summary_text"), summariser, min_words).alias("summary")
    )


def fill_summaries(keyed: DataFrame, entries: DataFrame) -> DataFrame:
    """Summaries from cache entries; null where the text is blank."""
    return join_results(keyed.drop("summary"), entries, "cache_key").drop("cache_key", "summary_text")


def summarize_texts(
    texts: DataFrame,
    column: str = "text",
    summariser: Summariser = lead_summary,
    max_words: int = fixed.SUMMARY_MAX_WORDS,
    min_words: int = fixed.SUMMARY_MIN_WORDS,
    cache: DataFrame | None = None,
    once_per_text: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Add ``summary``; the empty string where the text is blank.

    Gives (texts, new cache entries or None).
    """
    if cache is None and not once_per_text:
        done, fresh = texts.withColumn("summary", summary_of(F.col(column), summariser, min_words)), None
    else:
        keyed = with_summary_key(texts, F.col(column), max_words, min_words)
        fresh = new_summaries(keyed, summariser, min_words, cache)
        done = fill_summaries(keyed, with_cached(fresh, cache))
    return done.withColumn("summary", F.coalesce("summary", F.lit(""))), fresh


def summary_source(articles: DataFrame, body: str = "body") -> Column:
    """The text that a run summarises: the body, else the title."""
    return F.coalesce(non_empty(column_or_null(articles, body)), F.col("title"))


def add_summaries(
    articles: DataFrame, mode: str = "summary", summariser: Summariser = lead_summary, body: str = "body"
) -> DataFrame:
    """Summary by the mode of the run: the title, none, or made from body or title."""
    title, text = F.col("title"), column_or_null(articles, body)
    mode = mode.strip().lower()
    if mode in ("title", "headline"):
        value = trim_title(F.coalesce(non_empty(title), non_empty(text), F.lit("")))
    elif mode in ("none", "skip", "off"):
        value = F.lit(None).cast("string")
    else:
        value = summary_of(summary_source(articles, body), summariser)
    return articles.withColumn("summary", value)
