"""One batch run: dedup, score, enrich, store, count."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gladwire import fixed, schemas
from gladwire.functions.dates import format_datetime
from gladwire.functions.text import lead_summary, non_empty
from gladwire.operators.articles import column_or_null, fill_url_and_date, store_rows
from gladwire.operators.dedup import drop_known_titles, drop_known_urls, existing_urls, known_pairs
from gladwire.operators.enrich import (
    Summariser, TopicScorer, add_summaries, add_thumbnails, categorize, fill_categories,
    fill_summaries, fill_thumbnails, new_categories, new_summaries, new_thumbnails, summary_source,
    with_category_key, with_summary_key,
)
from gladwire.operators.lookup import with_source_ids
from gladwire.operators.metrics import new_crawl_id
from gladwire.operators.scoring import Scorer, filter_positive, is_below, score_news
from gladwire.session import remove_folder
from gladwire.sources.exports import article_events, write_events
from gladwire.sources.feeds import Adapter, crawl_entries, stamped_entries
from gladwire.sources.store import ArticleStore, Origin, written_by


@dataclass(frozen=True)
class RunOptions:
    """What a run does; every hook has a built-in default or is skipped when None."""

    threshold: float = fixed.DEFAULT_THRESHOLD
    source_thresholds: Mapping[str, float] | DataFrame | None = None
    use_registry_threshold: bool = False
    scorer: Scorer | None = None
    base_hints: Sequence[str] = fixed.BASE_HINTS
    topic_scorer: TopicScorer | None = None
    categories: Sequence[str] = fixed.TOPICS
    score_topics_once_per_text: bool = False
    # characters of the body that the topic scorer gets; None for all
    topic_chars: int | None = fixed.BODY_CHARS_FOR_TOPICS
    pages: DataFrame | None = None
    summary_mode: str = "summary"
    summariser: Summariser = lead_summary
    use_caches: bool = False
    events_path: str | None = None


@dataclass
class RunReport:
    """Numbers of a run, as returned and as stored in ``crawl_metrics``."""

    crawl_id: str
    start: dt.datetime
    end: dt.datetime | None = None
    counts: dict[str, int] = field(default_factory=dict)
    avg_score: float | None = None
    errors: list[str] = field(default_factory=list)
    stage_ms: dict[str, float] = field(default_factory=dict)

    @property
    def status(self) -> str:
        return "partial_failure" if self.errors else "success"


class _Run:
    """A run in progress: its folder, its report, its moment, and the batch of the stream it is."""

    def __init__(self, store: ArticleStore, options: RunOptions, origin: Origin):
        now = dt.datetime.now(dt.timezone.utc)
        self.store, self.options, self.origin = store, options, origin
        self.report = RunReport(new_crawl_id(now), now)
        self.moment = F.lit(now.replace(microsecond=0))
        self.folder = f"{store.root}/_runs/{self.report.crawl_id}"
        # entries that join the caches with the end of the run
        self.entries: dict[str, DataFrame] = {}

    def keep(self, name: str, rows: DataFrame, stage: bool = True) -> DataFrame:
        """Write a stage result and go on from the written table.

        Later stages then read it, however often, and a lost executor costs a
        read instead of the stages before.
        """
        path = f"{self.folder}/{name}"
        started = time.monotonic()
        rows.write.parquet(path)
        if stage:
            self.report.stage_ms[name] = round((time.monotonic() - started) * 1000, 1)
        return self.store.spark.read.schema(rows.schema).parquet(path)

    def counted(self, name: str, rows: DataFrame, stage: bool = True, **values: Column) -> tuple[DataFrame, dict]:
        """``keep``, and values of all rows, observed while they are written."""
        seen = Observation(f"{self.report.crawl_id}-{name}")
        kept = self.keep(name, rows.observe(seen, *[value.alias(v) for v, value in values.items()]), stage)
        return kept, seen.get

    def extend_cache(self, name: str, keys: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Compute the entries a cache lacks for the keys, once; gives all entries of the keys."""
        known = self.store.scan(name, keys=keys)
        self.entries[name] = self.keep(name, compute(known), stage=False)
        return known.unionByName(self.entries[name])

    def attempt(self, name: str, rows: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A stage that may fail: its error is recorded and the rows go on without it."""
        try:
            return self.keep(name, stage(rows))
        except Exception as problem:  # noqa: BLE001 - hooks of the user may raise anything
            self.report.errors.append(f"{name}_failed: {_first_line(problem)}")
            return rows


def run_batch(
    store: ArticleStore,
    batch: DataFrame,
    options: RunOptions = RunOptions(),
    stream_batch: tuple[str, int] | None = None,
) -> RunReport:
    """Run one batch of crawled articles into the store.

    ``batch`` has ``seq``, the order of its rows, and the columns a crawl
    gives. Source keys must be in the sources table. A stage that fails is
    recorded: without scores nothing is classified, and where the rows cannot
    be made only the metrics of the run are stored.

    All rows are made before the first table changes. A run that dies while
    it stores them leaves rows of new urls behind; with ``stream_batch``, the name of a
    stream and the number of its batch, it can be run again and completes them.
    """
    return _run(_Run(store, options, stream_batch or (None, None)), batch)


def run_crawl(
    store: ArticleStore,
    feeds: DataFrame,
    registry: DataFrame,
    options: RunOptions = RunOptions(),
    limit_per_source: int = 50,
    max_articles: int | None = None,
    post_pages: DataFrame | None = None,
    adapters: Mapping[str, Adapter] | None = None,
) -> RunReport:
    """Run the feeds of all sources into the store.

    The entries are written once and then read by every adapter, so that each
    document is parsed once.
    """
    run = _Run(store, options, (None, None))
    entries = run.keep("entries", stamped_entries(feeds, registry))
    cap = max_articles if max_articles and max_articles > 0 else None
    return _run(run, crawl_entries(entries, limit_per_source, cap, post_pages, adapters))


def _run(run: _Run, batch: DataFrame) -> RunReport:
    try:
        return _stages(run, batch)
    finally:
        remove_folder(run.store.spark, run.folder)


def _stages(run: _Run, batch: DataFrame) -> RunReport:
    store, options = run.store, run.options
    row = F.count(F.lit(1))
    landed, found = run.counted(
        "batch", fill_url_and_date(batch), n=row, urls=F.collect_set(store.bucket("crawled_articles")),
        titles=F.collect_set(store.bucket("title_dates")),
    )
    fresh, new = run.counted("new", _without_known(run, landed, found["urls"], found["titles"]), n=row)
    counts = {"articles_fetched": found["n"], "articles_skipped": found["n"] - new["n"], "articles_new": new["n"]}
    run.report.counts = {**counts, "articles_classified": 0, "articles_stored": 0}
    if new["n"] == 0:
        return _finish(run)

    try:
        scored = run.keep("scored", _score(fresh, options))
    except Exception as problem:  # noqa: BLE001 - scorers of the user may raise anything
        run.report.errors.append(f"classification_failed: {_first_line(problem)}")
        return _finish(run)
    positive = filter_positive(scored)
    enriched = _enrich(run, positive)
    raw_rows = scored.filter(~F.col("is_uplifting")).unionByName(enriched, allowMissingColumns=True)
    thumbnail = non_empty(column_or_null(enriched, "thumbnail_url"))
    enriched, totals = run.counted(
        "enriched", enriched, stage=False, n=row, avg=F.avg("uplifting_score"), categorized=F.count("category"),
        summarized=F.count("summary"), pictured=F.count(thumbnail),
    )
    run.report.avg_score = totals["avg"]
    run.report.counts.update(
        articles_classified=totals["n"], articles_categorized=totals["categorized"] if options.topic_scorer else 0,
        articles_summarized=totals["summarized"], thumbnails_attempted=totals["n"] if options.pages is not None else 0,
        thumbnails_found=totals["pictured"] if options.pages is not None else 0,
    )
    try:
        # All rows are made before anything is stored, so that rows which cannot be written leave the
        # tables alone. The final rows are made of some of them, in the same way.
        raw = run.keep("raw_rows", _table_rows(run, "crawled_articles", raw_rows), stage=False)
        store.purge("articles", is_below(options.threshold))
        store.append_once("crawled_articles", raw, run.origin, found["urls"])
        store.append_once("articles", _table_rows(run, "articles", enriched), run.origin, found["urls"], index=False)
    except Exception as problem:  # noqa: BLE001 - the store may refuse the rows or fail
        if run.origin != (None, None):
            raise  # the stream runs the batch again
        run.report.errors.append(f"database_write_failed: {_first_line(problem)}")
        return _finish(run)
    run.report.counts["articles_stored"] = totals["n"]
    return _finish(run, enriched)


def _first_line(problem: Exception) -> str:
    return (str(problem).splitlines() or [type(problem).__name__])[0]


def _without_known(run: _Run, landed: DataFrame, urls: list[int], titles: list[int]) -> DataFrame:
    """Rows whose url, then whose title and date, no store holds.

    ``urls`` and ``titles`` are the partitions that can hold those of the batch: no other is read. What
    an interrupted run of the same batch has stored is not known.
    """
    store = run.store

    def stored(table: str, buckets: list[int]) -> DataFrame:
        rows = store.read(table, buckets)
        return rows if run.origin == (None, None) else rows.filter(~written_by(run.origin))

    tables = ("crawled_articles", "articles")
    fresh = drop_known_urls(landed, existing_urls(landed, *(stored(t, urls) for t in tables)))
    pairs = landed.select("title", format_datetime("published_at").alias("happened")).distinct()
    met = store.read("title_dates", titles).join(pairs, ["title", "happened"], "left_semi").select("url").distinct()
    met, found = run.counted("met", met, stage=False, urls=F.collect_set(store.bucket("crawled_articles")))
    known = known_pairs(*(stored(t, found["urls"]).join(met, "url", "left_semi") for t in tables))
    return drop_known_titles(fresh, known)


def _score(fresh: DataFrame, options: RunOptions) -> DataFrame:
    thresholds = options.source_thresholds
    own = F.col("threshold") if options.use_registry_threshold and "threshold" in fresh.columns else None
    return score_news(fresh, options.scorer, options.threshold, thresholds, options.base_hints, own)


def _enrich(run: _Run, positive: DataFrame) -> DataFrame:
    o, rows = run.options, positive
    if o.topic_scorer is not None:
        rows = run.attempt("categorization", rows, lambda r: _categories(run, r))
    if o.pages is not None:
        rows = run.attempt("thumbnails", rows, lambda r: _thumbnails(run, r))
    rows = run.attempt("summarization", rows, lambda r: _summaries(run, r))
    for name in ("category", "summary"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return rows


def _categories(run: _Run, rows: DataFrame) -> DataFrame:
    o = run.options
    if not o.use_caches:
        once = o.score_topics_once_per_text
        return categorize(rows, o.topic_scorer, o.categories, once_per_text=once, limit=o.topic_chars)[0]
    keyed = with_category_key(rows, o.categories)
    entries = run.extend_cache(
        "category_cache", keyed,
        lambda cache: new_categories(keyed, o.topic_scorer, o.categories, cache, limit=o.topic_chars),
    )
    return fill_categories(keyed, entries)


def _thumbnails(run: _Run, rows: DataFrame) -> DataFrame:
    pages = run.options.pages
    if not run.options.use_caches:
        return add_thumbnails(rows, pages)[0]
    return fill_thumbnails(
        rows, run.extend_cache("thumbnail_cache", rows, lambda cache: new_thumbnails(rows, pages, cache))
    )


def _summaries(run: _Run, rows: DataFrame) -> DataFrame:
    o = run.options
    made = o.summary_mode.strip().lower() not in ("title", "headline", "none", "skip", "off")
    if not (o.use_caches and made):
        return add_summaries(rows, o.summary_mode, o.summariser)
    keyed = with_summary_key(rows, summary_source(rows))
    entries = run.extend_cache(
        "summary_cache", keyed, lambda cache: new_summaries(keyed, o.summariser, cache=cache)
    )
    return fill_summaries(keyed, entries)


def _table_rows(run: _Run, table: str, rows: DataFrame) -> DataFrame:
    """The rows of a run for a table, one per url."""
    mapped = store_rows(rows, run.moment, raw=table == "crawled_articles")
    ready = with_source_ids(mapped, run.store.scan("sources", ["id", "source_id"]))
    stamped = ready.withColumns({"id": F.xxhash64("url"), "created_at": run.moment})
    # The raw rows are written as they were scored and then the uplifting ones again: of
    # equal urls the last uplifting row stays, but the first row of all gives the source.
    last = F.struct("is_uplifting", "seq") if table == "crawled_articles" else None
    return run.store.collapsed(table, stamped, last=last)


def _finish(run: _Run, enriched: DataFrame | None = None) -> RunReport:
    """Store the new cache entries and then the metrics, and only then announce what is stored."""
    report, store = run.report, run.store
    for name, entries in run.entries.items():
        store.append_once(name, entries, run.origin)
    report.end = dt.datetime.now(dt.timezone.utc)
    counts = report.counts
    row = (
        report.crawl_id, report.start, report.end, counts["articles_fetched"],
        counts["articles_classified"], counts["articles_stored"], report.avg_score,
        "; ".join(report.errors) or None,
    )
    metrics = store.spark.createDataFrame([row], schemas.CRAWL_METRICS)
    store.append("crawl_metrics", metrics, run.origin)
    if run.options.events_path:
        if enriched is not None:
            events = article_events(enriched, "article_processed", "summarized")
            write_events(events.withColumn("crawl_id", F.lit(report.crawl_id)), run.options.events_path)
        write_events(_run_events(run), run.options.events_path)
    return report


def _run_events(run: _Run) -> DataFrame:
    """One event per written stage and one for the whole run."""
    report, schema = run.report, "event string, crawl_id string, status string, duration_ms double, " + ", ".join(
        f"{name} long" for name in _COUNTS
    ) + ", avg_score double, errors array<string>"
    blank = (None,) * (len(_COUNTS) + 2)
    rows = [
        (f"{name}_complete", report.crawl_id, "success", ms, *blank) for name, ms in report.stage_ms.items()
    ]
    whole = round((report.end - report.start).total_seconds() * 1000, 1)
    counts = tuple(report.counts.get(name) for name in _COUNTS)
    rows.append(
        ("crawl_complete", report.crawl_id, report.status, whole, *counts, report.avg_score, report.errors or None)
    )
    return run.store.spark.createDataFrame(rows, schema).coalesce(1)


_COUNTS = (
    "articles_fetched", "articles_skipped", "articles_new", "articles_classified",
    "articles_categorized", "articles_summarized", "articles_stored", "thumbnails_attempted", "thumbnails_found",
)
