"""Scoring headlines and deciding which are uplifting."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gladwire import fixed
from gladwire.functions.text import _col, has_hint, hint_hit_count
from gladwire.session import written

# Characters of the hints of an automaton, which is broadcast; larger lexicons are joined. Also what
# a task holds of parts of titles.
LEXICON_CHARS = 1_000_000
# Parts of a hint and of a title that are joined: up to five words and what lies between them.
OPENING = 9
_PARTS_SCHEMA = pa.schema([("_key", pa.binary()), ("opening", pa.string())])

# A scorer maps the title column to a score, or to a pair [negative, positive].
Scorer = Callable[[Column], Column]


def rule_score(positive_hits: Column, negative_hits: Column) -> Column:
    """Score in [0, 1] from the numbers of positive and negative hints."""
    raw = (
        F.lit(fixed.SCORE_BASE)
        + positive_hits * F.lit(fixed.SCORE_PER_POSITIVE)
        - negative_hits * F.lit(fixed.SCORE_PER_NEGATIVE)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))


def rule_scorer(
    positive: Sequence[str] = fixed.BASE_HINTS + fixed.EXTRA_POSITIVE_HINTS,
    negative: Sequence[str] = fixed.NEGATIVE_HINTS,
) -> Scorer:
    """Scorer that counts whole-word hints; built from expressions only."""

    def score(title: Column) -> Column:
        return rule_score(hint_hit_count(title, positive), hint_hit_count(title, negative))

    return score


def probability_pair(score: Column) -> Column:
    """The pair [negative, positive] of a score."""
    return F.array(F.lit(1.0) - score, score)


def select_scorer(mode: str = "rules", model: Scorer | None = None) -> Scorer:
    """The model where one is given and wanted, else the rule scorer."""
    if mode.strip().lower() == "rules" or model is None:
        return rule_scorer()
    return model


def _with_score(df: DataFrame, scorer: Scorer | Transformer) -> DataFrame:
    if hasattr(scorer, "transform"):
        probability = vector_to_array(F.col("probability"))
        scored = scorer.transform(df).withColumn("uplifting_score", F.get(probability, F.lit(1)))
        return scored.select(*[c for c in df.columns if c != "uplifting_score"], "uplifting_score")
    scored = df.withColumn("uplifting_score", scorer(F.col("title")))
    if isinstance(scored.schema["uplifting_score"].dataType, T.ArrayType):
        scored = scored.withColumn("uplifting_score", F.get("uplifting_score", F.lit(1)))
    return scored.withColumn("uplifting_score", F.col("uplifting_score").cast("double"))


def _source_column(df: DataFrame) -> str | None:
    return next((c for c in ("source_id", "source") if c in df.columns), None)


def _threshold_map(thresholds: Mapping[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for s, t in thresholds.items() for x in (s, float(t))])


def with_threshold(
    df: DataFrame,
    thresholds: Mapping[str, float] | DataFrame | None = None,
    default: float = fixed.DEFAULT_THRESHOLD,
) -> DataFrame:
    """Add ``min_threshold`` and ``is_strict`` per row by its source.

    ``thresholds`` is a mapping, or a frame (source_id, threshold) with one row
    per source. None or an empty mapping means the table of strict sources.
    """
    key = _source_column(df)
    if key is None:
        return df.withColumns({"min_threshold": F.lit(float(default)), "is_strict": F.lit(False)})
    if isinstance(thresholds, DataFrame):
        table = thresholds.select(F.col("source_id").alias("_key"), F.col("threshold").cast("double").alias("_own"))
        joined = df.join(table, df[key] == table["_key"], "left")
        own, strict = F.col("_own"), F.col("_key").isNotNull()
        return joined.withColumns(
            {"min_threshold": F.coalesce(own, F.lit(float(default))), "is_strict": strict}
        ).drop("_key", "_own")
    own = _threshold_map(thresholds or fixed.STRICT_THRESHOLDS)[F.col(key)]
    return df.withColumns(
        {"min_threshold": F.coalesce(own, F.lit(float(default))), "is_strict": own.isNotNull()}
    )


def uplift_decision(
    score: Column | str, threshold: Column | str, strict: Column | str, hinted: Column | str
) -> Column:
    """At or above the threshold; strict sources also need a hint in the title."""
    reached = F.coalesce(_col(score) >= _col(threshold), F.lit(False))
    return reached & (~_col(strict) | _col(hinted))


def score_news(
    df: DataFrame,
    scorer: Scorer | Transformer | None = None,
    threshold: float = fixed.DEFAULT_THRESHOLD,
    source_thresholds: Mapping[str, float] | DataFrame | None = None,
    base_hints: Sequence[str] = fixed.BASE_HINTS,
    own_threshold: Column | None = None,
) -> DataFrame:
    """All rows with ``uplifting_score``, ``min_threshold`` and ``is_uplifting``.

    ``own_threshold``, where a row has one, takes the place of the threshold,
    be it lower or higher; a strict source stays strict.

    ``scorer`` is a function on the title column, or a fitted ``pyspark.ml``
    model that reads ``title`` and gives ``probability``.
    """
    scored = with_threshold(_with_score(df, scorer or rule_scorer()), source_thresholds, threshold)
    if own_threshold is not None:
        scored = scored.withColumn("min_threshold", F.coalesce(own_threshold.cast("double"), "min_threshold"))
    decided = uplift_decision(
        "uplifting_score", "min_threshold", "is_strict", has_hint("title", base_hints)
    )
    return scored.withColumn("is_uplifting", decided).drop("is_strict")


def filter_positive(scored: DataFrame) -> DataFrame:
    """Uplifting rows, without the threshold column."""
    return scored.filter("is_uplifting").drop("min_threshold")


def filter_positive_news(df: DataFrame, *args, **kwargs) -> DataFrame:
    """Score and keep the uplifting rows."""
    return filter_positive(score_news(df, *args, **kwargs))


def is_below(threshold: float = fixed.DEFAULT_THRESHOLD) -> Column:
    """Whether an article has no score or one under the threshold."""
    score = F.col("uplifting_score")
    return score.isNull() | (score < F.lit(float(threshold)))


def purge_below(articles: DataFrame, threshold: float = fixed.DEFAULT_THRESHOLD) -> DataFrame:
    """Articles that stay when those without score or under the threshold go."""
    return articles.filter(F.col("uplifting_score") >= F.lit(float(threshold)))


def below_threshold(articles: DataFrame, threshold: float = fixed.DEFAULT_THRESHOLD) -> DataFrame:
    """The articles a purge removes."""
    return articles.filter(is_below(threshold))


class Lexicon:
    """Hints as an Aho-Corasick automaton: all of them are found in one pass over a text.

    A hint counts where a regular expression would find it between two ``\\b``: a hint that begins with a
    letter, digit or underscore must not follow one, any other must; likewise at its end. The empty
    hint is in every text that has such a sign. Hints and texts are given in lower case.
    """

    def __init__(self, hints: Sequence[tuple[str, str]]):
        import ahocorasick

        self.names: dict[str, list[str]] = {}
        for hint, lowered in hints:
            self.names.setdefault(lowered, []).append(hint)
        self.automaton = ahocorasick.Automaton()
        for lowered in self.names:
            if lowered:
                self.automaton.add_word(lowered, (lowered, len(lowered), _is_word(lowered[0]), _is_word(lowered[-1])))
        if len(self.automaton):
            self.automaton.make_automaton()

    def found(self, text: str) -> list[str]:
        """The hints in a text, each once."""
        seen = set()
        if len(self.automaton):
            last = len(text) - 1
            for end, (lowered, length, first_is_word, last_is_word) in self.automaton.iter(text):
                start = end - length + 1
                before = start > 0 and _is_word(text[start - 1])
                after = end < last and _is_word(text[end + 1])
                if before != first_is_word and after != last_is_word:
                    seen.add(lowered)
        if "" in self.names and any(map(_is_word, text)):
            seen.add("")
        return [name for lowered in seen for name in self.names[lowered]]


def _is_word(sign: str) -> bool:
    return sign.isalnum() or sign == "_"


def match_lexicon(titles: DataFrame, lexicon: DataFrame, title: str = "title") -> DataFrame:
    """A row per title row and hint of a lexicon table found as a whole word.

    Up to ``LEXICON_CHARS`` characters the hints go to the executors as one automaton. A larger lexicon is
    joined with the parts of the titles, so the work grows with titles and lexicon, not with their product.
    """
    hints = lexicon.select("hint").filter(F.col("hint").isNotNull()).distinct().withColumn("lowered", F.lower("hint"))
    hints = written(hints.select("hint", "lowered", _opening("lowered").alias("o")).select("hint", "lowered", "o.*"), "lexicon")
    most = hints.agg(
        F.sum(F.length("hint") + 1).alias("size"), F.max("parts").alias("parts"),
        F.collect_set(F.struct(F.least("parts", F.lit(OPENING)), "word")).alias("shapes"),
    ).collect()[0]
    if (most["size"] or 0) <= LEXICON_CHARS:
        return _with_hints(titles, Lexicon([(r["hint"], r["lowered"]) for r in hints.collect()]), title)
    return _joined(titles, hints, title, [tuple(s) for s in most["shapes"]], most["parts"] > OPENING)


# Runs of letters, digits and underscores, and runs of other signs: what lies between two ``\b`` is a row of such parts.
_PART = re.compile(r"\w+|\W+")


_OPENING_TYPE = T.StructType([
    T.StructField("opening", T.StringType()), T.StructField("parts", T.IntegerType()), T.StructField("word", T.BooleanType()),
])


@F.pandas_udf(_OPENING_TYPE)
def _opening(lowered: pd.Series) -> pd.DataFrame:
    """The first ``OPENING`` parts of a hint, the number of its parts, and whether it begins with a word."""
    parts = [_PART.findall(h) for h in lowered]
    return pd.DataFrame({
        "opening": ["".join(p[:OPENING]) for p in parts], "parts": [len(p) for p in parts],
        "word": [bool(p) and _is_word(p[0][0]) for p in parts],
    })


def _openings(text: str, shapes: Sequence[tuple[int, bool]]) -> set[str]:
    """What hints of the given numbers of parts and kinds of first parts can be, or begin with, in a text."""
    parts = _PART.findall(text)
    # Other signs at either end have no ``\b`` outside.
    begin, end = 0, len(parts)
    if parts and not _is_word(parts[0][0]):
        begin = 1
    if end > begin and not _is_word(parts[-1][0]):
        end -= 1
    found = set()
    for n, word in shapes:
        if n:
            found.update("".join(parts[i : i + n]) for i in range(begin + (not word), end - n + 1, 2))
        elif end > begin:
            found.add("")
    return found


@F.pandas_udf(T.BooleanType())
def _holds(texts: pd.Series, hints: pd.Series) -> pd.Series:
    """Whether a text has a hint between two ``\\b``."""

    def holds(text: str, hint: str) -> bool:
        begin = text.find(hint)
        while begin >= 0:
            end = begin + len(hint)
            before, after = begin > 0 and _is_word(text[begin - 1]), end < len(text) and _is_word(text[end])
            if before != _is_word(hint[0]) and after != _is_word(hint[-1]):
                return True
            begin = text.find(hint, begin + 1)
        return False

    return pd.Series([holds(t, h) for t, h in zip(texts, hints, strict=True)], dtype=bool)


def _joined(
    titles: DataFrame, hints: DataFrame, title: str, shapes: Sequence[tuple[int, bool]], some_are_longer: bool
) -> DataFrame:
    """``match_lexicon`` by equality of parts; hints longer than their opening are looked for in the whole title.

    Each different title is taken apart once and known by its SHA-256.
    """
    text = F.lower(F.col(title))
    key = F.unhex(F.sha2(text, 256))
    texts = titles.select(text.alias("_text")).filter(F.col("_text").isNotNull()).distinct()

    def take_apart(batches):
        keys, openings, chars = [], [], 0
        for batch in batches:
            for own, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _openings(words, shapes)
                keys += [own] * len(found)
                openings += found
                chars += sum(map(len, found))
                if chars > LEXICON_CHARS:
                    yield pa.RecordBatch.from_pydict({"_key": keys, "opening": openings}, _PARTS_SCHEMA)
                    keys, openings, chars = [], [], 0
        if keys:
            yield pa.RecordBatch.from_pydict({"_key": keys, "opening": openings}, _PARTS_SCHEMA)

    parts = texts.select(F.unhex(F.sha2("_text", 256)), "_text").mapInArrow(take_apart, "_key binary, opening string")
    own = hints.select(
        "opening", F.col("hint").alias("_hint"), F.when(F.col("parts") > OPENING, F.col("lowered")).alias("_longer")
    )
    found = parts.join(own.hint("merge"), "opening").drop("opening")
    rows = titles.withColumn("_key", key).join(found, "_key")
    if some_are_longer:
        rows = rows.withColumn("_text", F.when(F.col("_longer").isNotNull(), text))
        rows = rows.withColumn("_held", _holds(F.coalesce("_text", F.lit("")), F.coalesce("_longer", F.lit(" "))))
        rows = rows.filter(F.col("_longer").isNull() | F.col("_held")).drop("_text", "_held")
    return rows.withColumn("hint", F.col("_hint")).drop("_key", "_hint", "_longer")


def _with_hints(titles: DataFrame, lexicon: Lexicon, title: str) -> DataFrame:
    shared = titles.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<string>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series([None if t is None else own.found(t) for t in texts], dtype=object)

    return titles.withColumn("hint", F.explode(find(F.lower(F.col(title)))))
