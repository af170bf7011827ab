"""Category, key and event functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gladwire import fixed
from gladwire.functions.text import _col, bind, non_empty


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def canonical_category(category: Column | str) -> Column:
    """Slug or older label as today's label; others unchanged, empty as null."""
    names = {name: name for name, *_ in fixed.CATEGORY_SEED}
    slugs = {slug: name for name, slug, *_ in fixed.CATEGORY_SEED}
    given = non_empty(category)
    return F.coalesce(_lookup({**names, **slugs, **fixed.LEGACY_TOPICS})[given], given)


def category_slug(category: Column | str) -> Column:
    """Label or older label as slug; null where it is neither."""
    slug_of = {name: slug for name, slug, *_ in fixed.CATEGORY_SEED}
    legacy = {old: slug_of[new] for old, new in fixed.LEGACY_TOPICS.items()}
    return _lookup({**slug_of, **legacy})[_col(category)]


def category_key(title: Column | str, body: Column | str, categories: Column) -> Column:
    """Cache key of a categorising job; the order of the categories does not count."""
    parts = F.struct(
        F.sort_array(categories).alias("categories"),
        F.coalesce(_col(body), F.lit("")).alias("body"),
        _col(title).alias("title"),
    )
    return F.sha2(F.to_json(parts), 256)


def summary_key(
    text: Column | str,
    max_words: int = fixed.SUMMARY_MAX_WORDS,
    min_words: int = fixed.SUMMARY_MIN_WORDS,
) -> Column:
    """Cache key of a summarising job."""
    parts = F.struct(
        F.lit(max_words).alias("max_length"), F.lit(min_words).alias("min_length"),
        _col(text).alias("text"),
    )
    return F.sha2(F.to_json(parts), 256)


def scores_json(scores: Column | str) -> Column:
    """Scores map as JSON text."""
    return F.to_json(_col(scores))


def scores_from_json(text: Column | str) -> Column:
    """JSON text as scores map."""
    return F.from_json(_col(text), "map<string,double>")


def allowed_scores(scores: Column, allowed: Sequence[str]) -> Column:
    """Scores of the allowed labels; all scores where none of them is allowed."""

    def keep(scores: Column) -> Column:
        kept = F.map_filter(scores, lambda label, _: label.isin(*allowed))
        return bind(kept, lambda k: F.when(F.size(k) == 0, scores).otherwise(k))

    return bind(scores, keep)


def argmax_label(scores: Column) -> Column:
    """Label with the highest score; on ties the first one in the map."""
    labels, values = F.map_keys(scores), F.map_values(scores)
    ranked = F.transform(
        labels, lambda label, i: F.struct(F.get(values, i).alias("score"), (-i).alias("rank"), label.alias("label"))
    )
    return F.array_max(ranked)["label"]


def event_payload(
    event: Column, source_id: Column, url: Column, title: Column, stage: Column,
    status: Column, score: Column, duration_ms: Column,
) -> Column:
    """One article event as a struct: short title, rounded numbers."""
    return F.struct(
        event.alias("event"),
        source_id.alias("source_id"),
        url.alias("url"),
        F.substring(F.coalesce(title, F.lit("")), 1, fixed.TITLE_CHARS_IN_EVENTS).alias("title"),
        stage.alias("stage"),
        F.coalesce(status, F.lit("success")).alias("status"),
        F.round(score, 4).alias("uplifting_score"),
        F.round(duration_ms, 1).alias("duration_ms"),
    )
