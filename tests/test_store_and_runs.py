import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gladwire import schemas
from gladwire.operators.articles import add_missing_columns
from gladwire.plans.run import RunOptions, run_batch, run_crawl
from gladwire.sources import exports
from gladwire.sources.store import ArticleStore
from gladwire.streaming.ingest import drop_repeats, ingest_stream, state_size, write_unique

DAY = dt.datetime(2026, 3, 26, 10, 0, 0)
BATCH = "seq long, title string, url string, source_id string, published_at timestamp, body string"


@pytest.fixture
def store(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(1, "Local", "Local news", "local.org"), (2, "BBCNews", "BBC", "bbc.org")],
                                 "id long, source_id string, name string, domain string")
    store.replace("sources", add_missing_columns(rows, schemas.SOURCES))
    return store


def batch(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], BATCH)


def article(title, url, source="Local", when=DAY, body=None):
    return (title, url, source, when, body)


def stored(store, name="articles", *columns):
    return sorted(tuple(r) for r in store.scan(name, list(columns)).collect())


def test_end_to_end_counts(spark, store):
    report = run_batch(store, batch(spark, article("Cup wins", "u1"), article("War and death", "u2"), article("Hope rescued", "u3")))
    assert report.counts["articles_fetched"] == 3 and report.counts["articles_classified"] == 2
    assert report.counts["articles_stored"] == 2 and report.status == "success"
    assert stored(store, "articles", "url", "summary") == [("u1", "Cup wins"), ("u3", "Hope rescued")]
    assert stored(store, "crawled_articles", "url", "is_uplifting") == [("u1", True), ("u2", False), ("u3", True)]
    row = store.scan("crawl_metrics").collect()[0]
    assert (row.articles_fetched, row.articles_stored, row.errors) == (3, 2, None) and row.id == report.crawl_id
    again = run_batch(store, batch(spark, article("Cup wins", "u1"), article("Cup wins", "other")))
    assert again.counts["articles_new"] == 0 and store.scan("crawl_metrics").count() == 2


def test_repeats_inside_a_batch_settle_in_the_store(spark, store):
    report = run_batch(store, batch(spark, article("Cup wins", "u1"), article("Hope wins", "u1", "BBCNews"), article("A success", "u1")))
    assert report.counts["articles_stored"] == 3
    assert stored(store, "articles", "url", "title", "source_id") == [("u1", "A success", 1)]


def test_strict_sources(spark, store):
    report = run_batch(store, batch(spark, article("Cup wins", "u1", "BBCNews"), article("Hope wins", "u2", "BBCNews")))
    assert report.counts["articles_classified"] == 1 and stored(store, "articles", "url") == [("u2",)]


def test_unknown_source_writes_nothing(spark, store):
    run_batch(store, batch(spark, article("Cup wins", "u1")))
    report = run_batch(store, batch(spark, article("Hope wins", "u2"), article("War", "u3", "nobody")))
    assert report.status == "partial_failure" and "'nobody' is not in the sources" in report.errors[0]
    assert stored(store, "articles", "url") == [("u1",)] and stored(store, "crawled_articles", "url") == [("u1",)]
    assert sorted(r.articles_stored for r in store.scan("crawl_metrics").collect()) == [0, 1]


def test_failing_hook_is_recorded_and_the_rows_go_on(spark, store):
    def broken(text):
        return F.create_map(text, F.raise_error(F.lit("no model")).cast("double"))

    report = run_batch(store, batch(spark, article("Cup wins", "u1")), RunOptions(topic_scorer=broken))
    assert report.status == "partial_failure" and report.errors[0].startswith("categorization_failed: ")
    assert stored(store, "articles", "url", "summary", "category") == [("u1", "Cup wins", None)]
    assert store.scan("crawl_metrics").collect()[0].errors == "; ".join(report.errors)


def test_enriched_run_and_kept_columns(spark, store):
    pages = spark.createDataFrame([("https://a.b/1", 200, '<meta property="og:image" content="/i.png">')], "url string, status int, html string")
    options = RunOptions(topic_scorer=lambda t: F.create_map(F.lit("Health"), F.lit(0.9)), pages=pages, summary_mode="title")
    run_batch(store, batch(spark, article("Cup wins", "https://a.b/1")), options)
    first = store.scan("articles").collect()[0]
    assert (first.category, first.category_scores, first.thumbnail_url) == ("Health", {"Health": 0.9}, "https://a.b/i.png")
    rows = store.scan("articles").withColumns({"seq": F.lit(1), "title": F.lit("New"), "id": F.lit(5), "source_id": F.lit(2),
                                               "category": F.lit(None), "created_at": F.lit(DAY), "updated_at": F.lit(DAY)})
    store.upsert("articles", rows)
    second = store.scan("articles").collect()[0]
    assert (second.id, second.source_id, second.created_at) == (first.id, first.source_id, first.created_at)
    assert (second.title, second.category, second.updated_at) == ("New", None, DAY)
    before = store.scan("articles").collect()
    store.compact("articles")
    assert store.scan("articles").collect() == before


def test_raised_threshold_purges_the_final_table(spark, store):
    run_batch(store, batch(spark, article("Cup wins", "u1"), article("Hope wins", "u2")))
    run_batch(store, batch(spark, article("Hope and joy", "u3")), RunOptions(threshold=0.8))
    assert stored(store, "articles", "url") == [("u2",), ("u3",)]
    assert len(stored(store, "crawled_articles", "url")) == 3


def files(store, name="articles"):
    found = store.read(name).select("bucket", F.input_file_name().alias("file")).distinct().collect()
    return {(r.bucket, r.file) for r in found}


def test_many_runs_are_compacted_on_request(spark, tmp_path, store):
    one = ArticleStore(spark, store.root, buckets=1)
    for i in range(3):
        run_batch(one, batch(spark, article(f"Cup wins {i}", f"u{i}")))
    assert len(files(one)) == 3
    one.compact("articles")
    assert len(files(one)) == 1 and len(stored(one, "articles", "url")) == 3
    one.compact("articles")
    assert len(files(one)) == 1


def test_a_purge_rewrites_only_what_it_must(spark, store):
    run_batch(store, batch(spark, *(article(f"Cup wins {i}", f"u{i}") for i in range(40)), article("Hope wins", "low")))
    before = files(store)
    store.purge("articles", F.col("url") == "low")
    after = files(store)
    hit = {r.bucket for r in spark.sql("SELECT 'low' AS url").select(store.bucket("articles").alias("bucket")).collect()}
    assert {b for b, _ in before - after} == hit and len(stored(store, "articles", "url")) == 40
    assert {f for b, f in before if b not in hit} == {f for b, f in after if b not in hit}
    # a partition that loses all its rows goes
    store.purge("articles", F.col("url") != "u7")
    assert stored(store, "articles", "url") == [("u7",)] and len(files(store)) == 1
    store.purge("articles", F.col("url") == "u7")
    assert stored(store, "articles", "url") == [] and files(store) == set()


def test_an_upsert_rewrites_only_its_partitions(spark, store):
    run_batch(store, batch(spark, *(article(f"Cup wins {i}", f"u{i}") for i in range(40))))
    before = files(store)
    rows = store.scan("articles").filter("url = 'u3'").withColumns({"seq": F.lit(0), "title": F.lit("New")})
    store.upsert("articles", rows)
    changed = {b for b, _ in before - files(store)}
    assert len(changed) == 1 and ("u3", "New") in stored(store, "articles", "url", "title") and len(stored(store, "articles", "url")) == 40


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_lookups_read_only_the_partitions_of_their_keys(spark, store):
    rows = [article(f"Cup wins {i}", f"u{i}", when=DAY + dt.timedelta(days=i)) for i in range(60)]
    run_batch(store, batch(spark, *rows))
    few = spark.createDataFrame([("u5",), ("u9",)], "url string")
    found = store.scan("crawled_articles", ["url"], keys=few)
    buckets = sorted(store.touched("crawled_articles", few))
    assert len(buckets) <= 2 and re.search(r"PartitionFilters: \[[^]]*bucket#", plan(found)) and stored_rows(found) == [("u5",), ("u9",)]
    read = store.read("crawled_articles", buckets).count()
    assert read < 30 and store.read("crawled_articles", []).count() == 0
    # a run reads as many rows of a store twice as large
    seen = []
    original = ArticleStore.read

    def watched(self, name, buckets=None):
        frame = original(self, name, buckets)
        if name in ("crawled_articles", "articles", "title_dates") and buckets is not None:
            seen.append((name, len(list(buckets))))
        return frame

    ArticleStore.read = watched
    try:
        run_batch(store, batch(spark, article("Cup wins 5", "v", when=DAY + dt.timedelta(days=5)), article("Hope wins", "u1")))
    finally:
        ArticleStore.read = original
    assert seen and all(n <= 2 for _, n in seen)
    assert store.scan("crawl_metrics").filter("articles_fetched = 2 and articles_stored = 0").count() == 1


def stored_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_titles_that_changed_are_no_longer_known(spark, store):
    run_batch(store, batch(spark, article("Cup wins", "u1")))
    for table in ("crawled_articles", "articles"):
        store.upsert(table, store.scan(table).withColumns({"seq": F.lit(0), "title": F.lit("Other cup wins")}))
    report = run_batch(store, batch(spark, article("Cup wins", "u2"), article("Other cup wins", "u3")))
    assert report.counts["articles_new"] == 1
    assert stored(store, "crawled_articles", "url") == [("u1",), ("u2",)]


def test_runs_leave_no_working_folders(spark, store, tmp_path):
    run_batch(store, batch(spark, article("Cup wins", "u1")))
    run_batch(store, batch(spark, article("Cup wins", "u1", "Nobody")))
    from pathlib import Path

    assert list(Path(store.root, "_runs").iterdir()) == []


def test_raw_store_keeps_the_last_uplifting_row(spark, store):
    run_batch(store, batch(spark, article("Dog rescued from river", "u1"), article("Dull words", "u1", "BBCNews"), article("Dull", "u2"), article("Duller", "u2")))
    assert stored(store, "articles", "url", "title") == [("u1", "Dog rescued from river")]
    assert stored(store, "crawled_articles", "url", "title", "is_uplifting", "source_id") == [
        ("u1", "Dog rescued from river", True, 1), ("u2", "Duller", False, 1)]


def test_failing_scores_and_writes_leave_metrics(spark, store, tmp_path):
    def broken(title):
        return F.raise_error(F.lit("no model")).cast("double")

    report = run_batch(store, batch(spark, article("Cup wins", "u1")), RunOptions(scorer=broken))
    assert report.status == "partial_failure" and report.counts["articles_classified"] == 0
    assert report.errors[0].startswith("classification_failed")
    events = str(tmp_path / "events")
    bad = run_batch(store, batch(spark, article("Cup wins", "u1", "Nobody")), RunOptions(events_path=events))
    assert bad.errors[0].startswith("database_write_failed") and bad.counts["articles_stored"] == 0
    assert bad.counts["articles_classified"] == 1 and store.scan("articles").count() == 0
    rows = store.scan("crawl_metrics").collect()
    assert len(rows) == 2 and all(r.articles_stored == 0 and r.errors for r in rows)
    # nothing is announced that is not stored
    assert spark.read.json(events).filter("event = 'article_processed'").count() == 0


def test_two_writers_append(spark, store):
    other = ArticleStore(spark, store.root)
    store.append("crawl_metrics", spark.createDataFrame([], schemas.CRAWL_METRICS))
    row = ("a", DAY, DAY, 1, 1, 1, 0.5, None)
    for writer in (store, other):
        writer.append("crawl_metrics", spark.createDataFrame([row], schemas.CRAWL_METRICS))
    assert store.scan("crawl_metrics").count() == other.scan("crawl_metrics").count() == 2


@pytest.mark.parametrize(("own", "classified"), [(0.9, 1), (0.05, 3), (None, 2)])
def test_registry_threshold_is_an_option(spark, store, own, classified):
    rows = batch(spark, article("Cup wins", "u1"), article("Hope wins", "u2"), article("Dull", "u3"))
    rows = rows.withColumn("threshold", F.lit(own).cast("double"))
    assert run_batch(store, rows.limit(0).unionByName(rows), RunOptions(use_registry_threshold=True)).counts["articles_classified"] == classified


def test_seeds_do_not_replace(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "s"))
    registry_rows = spark.createDataFrame([(0, "a", "A", None, "r", None, True, "news")],
                                          "seq int, source_id string, name string, domain string, rss_url string, url string, active boolean, category string")
    store.seed(registry_rows)
    store.seed(registry_rows.withColumn("name", F.lit("Other")))
    assert stored(store, "sources", "source_id", "name") == [("a", "A")]
    assert store.scan("categories").count() == 7


def test_older_folders_lack_columns(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "s"))
    older = spark.createDataFrame([(1, "t", "u")], "id int, title string, url string").withColumn("bucket", store.bucket("articles"))
    older.write.partitionBy("bucket").parquet(store.path("articles"))
    store.upsert("articles", add_missing_columns(spark.createDataFrame([(2, "t2", "v")], "id long, title string, url string"), schemas.ARTICLES).withColumn("seq", F.lit(0)))
    assert stored(store, "articles", "id", "url") == [(1, "u"), (2, "v")]


def test_exports_are_files(spark, store, tmp_path):
    run_batch(store, batch(spark, article('Cup "wins", line\nbreak', "u1"), article("War", "u2")))
    final = exports.final_export(store.scan("articles"), store.scan("sources"))
    exports.write_csv(final, str(tmp_path / "final"), one_file=True)
    assert len(list((tmp_path / "final").glob("*.csv"))) == 1
    back = spark.read.csv(str(tmp_path / "final"), header=True, multiLine=True, escape='"').collect()
    assert len(back[0]) == 17 and back[0]["title"] == 'Cup "wins", line\nbreak' and back[0]["source"] == "Local"
    latest = exports.latest_export(store.scan("crawled_articles"), store.scan("sources"))
    exports.write_split_csv(latest, str(tmp_path / "split"))
    assert {p.name for p in (tmp_path / "split").glob("uplifting=*")} == {"uplifting=yes", "uplifting=no"}


def test_split_files_are_in_order(spark, tmp_path):
    rows = spark.range(400).select(
        F.concat(F.lit("t"), F.col("id") % 7).alias("title"), (F.hash("id") % 5 / 10.0).alias("uplifting_score"),
        F.when(F.col("id") % 3 == 0, "yes").otherwise("no").alias("uplifting"),
    )
    exports.write_split_csv(rows.repartition(5), str(tmp_path / "split"))
    for half in ("yes", "no"):
        lines = []
        for file in sorted((tmp_path / "split" / f"uplifting={half}").glob("*.csv")):
            lines += [line.split(",") for line in file.read_text().splitlines()[1:]]
        assert lines == sorted(lines, key=lambda line: (-float(line[1]), line[0])) and len(lines) > 100


def test_events_leave_out_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("a", "u", "t" * 200, 0.123456, None), ("a", "v", None, None, 12.34)],
                                 "source_id string, url string, title string, uplifting_score double, duration_ms double")
    exports.write_events(exports.article_events(rows, "article_processed", "stored"), str(tmp_path / "e"))
    import json

    lines = sorted((json.loads(r.value) for r in spark.read.text(str(tmp_path / "e")).collect()), key=lambda e: e["url"])
    assert lines[0]["title"] == "t" * 120 and lines[0]["uplifting_score"] == 0.1235 and "duration_ms" not in lines[0]
    assert lines[1] == {"event": "article_processed", "source_id": "a", "url": "v", "title": "", "stage": "stored", "status": "success", "duration_ms": 12.3}


def test_stream_runs_each_batch_once(spark, store, tmp_path):
    arrivals = str(tmp_path / "in")
    first = batch(spark, article("Cup wins", "u1"), article("War", "u2")).coalesce(1)
    first.write.parquet(arrivals)
    stream = lambda: spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    ingest_stream(store, stream(), str(tmp_path / "cp")).awaitTermination()
    assert stored(store, "articles", "url") == [("u1",)]
    batch(spark, article("Cup wins", "u1"), article("Hope rescued", "u3")).coalesce(1).write.mode("append").parquet(arrivals)
    ingest_stream(store, stream(), str(tmp_path / "cp")).awaitTermination()
    assert stored(store, "articles", "url") == [("u1",), ("u3",)]
    cp = str(tmp_path / "cp")
    assert store.finished((cp, 0)) and store.finished((cp, 1)) and not store.finished((cp, 2)) and store.scan("crawl_metrics").count() == 2
    # a replay of the same stream is skipped
    ingest_stream(store, stream(), str(tmp_path / "cp2"), name=str(tmp_path / "cp")).awaitTermination()
    assert store.scan("crawl_metrics").count() == 2
    # another stream, whose ids begin at 0 again, is not
    batch(spark, article("A success", "u9", when=None)).coalesce(1).write.parquet(str(tmp_path / "other"))
    second = spark.readStream.schema(first.schema).parquet(str(tmp_path / "other"))
    ingest_stream(store, second, str(tmp_path / "cp3")).awaitTermination()
    assert stored(store, "articles", "url") == [("u1",), ("u3",), ("u9",)] and store.scan("crawl_metrics").count() == 3


@pytest.mark.parametrize("dies_at", ["crawled_articles", "articles", "crawl_metrics"])
def test_a_batch_that_died_is_completed_by_its_replay(spark, store, tmp_path, monkeypatch, dies_at):
    """The driver dies right after a write; the same checkpoint runs the batch again."""
    rows = batch(spark, article("Cup wins", "u1"), article("War", "u2"), article("Hope rescued", "u3", when=None), article("Cup wins", "u4"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    append = ArticleStore.append

    def dying(self, name, *args, **more):
        if name != "crawl_metrics" or dies_at != "crawl_metrics":
            append(self, name, *args, **more)
        if name == dies_at:
            raise SystemError("the driver died")

    monkeypatch.setattr(ArticleStore, "append", dying)
    with pytest.raises(Exception, match="the driver died"):
        ingest_stream(store, stream(), str(tmp_path / "cp")).awaitTermination()
    monkeypatch.undo()
    ingest_stream(store, stream(), str(tmp_path / "cp")).awaitTermination()
    assert stored(store, "articles", "url") == [("u1",), ("u3",), ("u4",)]
    assert stored(store, "crawled_articles", "url") == [("u1",), ("u2",), ("u3",), ("u4",)]
    metrics = store.scan("crawl_metrics").collect()
    assert [(r.articles_fetched, r.articles_stored, r.errors) for r in metrics] == [(4, 3, None)]
    ingest_stream(store, stream(), str(tmp_path / "cp")).awaitTermination()
    assert store.scan("crawl_metrics").count() == 1


def test_stream_that_goes_on(spark, store, tmp_path):
    rows = batch(spark, article("Cup wins", "u1")).coalesce(1)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = ingest_stream(store, stream, str(tmp_path / "cp"), interval="1 second")
    try:
        query.processAllAvailable()
        batch(spark, article("Hope rescued", "u2")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query.processAllAvailable()
        assert query.isActive and stored(store, "articles", "url") == [("u1",), ("u2",)]
    finally:
        query.stop()


def test_stream_dedup(spark, tmp_path):
    old, future, minute = dt.datetime(2020, 1, 1), dt.datetime(2099, 1, 1), dt.timedelta(minutes=1)
    rows = [("u1", DAY, DAY), ("u2", future, DAY), ("u1", DAY, DAY + minute), ("u3", old, DAY + minute), ("u4", None, DAY + 2 * minute)]
    kind = "url string, published_at timestamp, crawled_at timestamp"
    for part in (rows[:2], rows[2:4], rows[4:]):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (drop_repeats(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["u1", "u2", "u3", "u4"]


def test_stream_dedup_goes_on_after_a_restart(spark, tmp_path):
    """State outlives the query: it is in the checkpoint, and old urls leave it."""
    kind, places = "url string, crawled_at timestamp", [str(tmp_path / n) for n in ("in", "out", "cp")]
    hour = dt.timedelta(hours=1)

    def arrive(*rows):
        spark.createDataFrame([(u, DAY + h * hour) for u, h in rows], kind).coalesce(1).write.mode("append").parquet(places[0])
        query = write_unique(spark.readStream.schema(kind).parquet(places[0]), places[1], places[2], delay="10 hours")
        query.awaitTermination()
        return state_size(query)

    first = arrive(("u1", 0), ("u2", 0), ("u1", 0))
    assert first["rows"] == 2 and first["memory_bytes"] > 0
    assert arrive(("u1", 1), ("u3", 1))["rows"] == 3
    assert arrive(("u2", 2), ("u4", 30))["rows"] <= 4
    last = arrive(("u5", 31), ("u4", 31))
    assert last["rows"] == 2 and sorted(r.url for r in spark.read.parquet(places[1]).collect()) == ["u1", "u2", "u3", "u4", "u5"]
    assert list((tmp_path / "cp" / "state").rglob("*.changelog"))


def test_crawl_into_the_store_with_events(spark, store, tmp_path):
    from tests.test_feeds import BROKEN, RSS

    feeds = spark.createDataFrame([("Local", RSS), ("BBCNews", BROKEN)], "source_id string, xml string")
    registry = spark.createDataFrame([("Local", 0, "u", None, None), ("BBCNews", 1, "u", None, None)],
                                     "source_id string, source_ord int, rss_url string, adapter string, threshold double")
    options = RunOptions(threshold=0.1, events_path=str(tmp_path / "events"))
    report = run_crawl(store, feeds, registry, options, limit_per_source=10, max_articles=5)
    assert report.counts["articles_fetched"] == 2 and report.counts["articles_stored"] == 2
    assert stored(store, "articles", "url") == [("https://a.org/1",), ("https://a.org/3",)]
    events = spark.read.json(str(tmp_path / "events"))
    assert events.filter("event = 'article_processed'").count() == 2
    assert events.filter(F.col("crawl_id") != report.crawl_id).count() == 0
    assert events.filter("event = 'crawl_complete' and articles_stored = 2").count() == 1


def test_caches_grow_with_the_runs(spark, store):
    pages = spark.createDataFrame([("https://a.b/1", 200, '<img src="/i.png">')], "url string, status int, html string")
    options = RunOptions(topic_scorer=lambda t: F.create_map(F.lit("Health"), F.lit(0.9)), pages=pages, use_caches=True)
    long = "Hope is a word. " * 20
    run_batch(store, batch(spark, article("Cup wins", "https://a.b/1", body=long), article("Cup wins", "https://a.b/2", body=long)), options)
    assert stored(store, "category_cache", "category", "confidence") == [("Health", 0.9)]
    assert stored(store, "summary_cache", "summary") == [("Hope is a word. Hope is a word. Hope is a word.",)]
    assert stored(store, "thumbnail_cache") == [("https://a.b/1", "https://a.b/i.png"), ("https://a.b/2", "https://a.b/favicon.ico")]
    other = RunOptions(topic_scorer=lambda t: F.create_map(F.lit("Sports"), F.lit(0.9)), pages=pages, use_caches=True)
    day = DAY + dt.timedelta(days=1)
    run_batch(store, batch(spark, article("Cup wins", "https://a.b/3", when=day, body=long), article("Hope wins", "https://a.b/4", when=day)), other)
    assert stored(store, "articles", "url", "category", "summary")[2:] == [
        ("https://a.b/3", "Health", "Hope is a word. Hope is a word. Hope is a word."), ("https://a.b/4", "Sports", "Hope wins")]
    assert len(stored(store, "category_cache", "category")) == 2


@pytest.mark.parametrize("name", ["incremental_ingest", "stream_dedup", "stream_dedup_restart"])
def test_arrivals_of_stream_queries_are_written_by_many_tasks(spark, tmp_path, monkeypatch, name):
    """No task of these queries writes a whole arrival; the rows stay those of the SQL."""
    import duckdb

    import checks
    from checks import stores

    checks.load_all()
    rows = [(i, f"Headline {i % 90} with luck\nbody", "en", f"src{i % 4}", 20 + i % 90) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 240, 10)], "doc_id long, quality int, toxic int")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    folders = []

    def noted(spark, purpose):
        folders.append((purpose, str(tmp_path / f"{purpose}-{len(folders)}")))
        return folders[-1][1]

    monkeypatch.setattr(stores, "new_folder", noted)
    got = sorted(map(tuple, checks.QUERIES[name](spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert got == sorted(con.sql(checks.ORACLES[name]).fetchall(), key=str) and got
    files = [len(list(Path(path).glob("*.parquet"))) for purpose, path in folders if purpose == "arrivals"]
    arrivals = 2 if name == "incremental_ingest" else 4
    assert all(n > arrivals for n in files) and files


def test_incremental_ingest_uses_whole_texts(spark, tmp_path, monkeypatch):
    """A word that decides the category stands behind the title and far behind the head of the body."""
    import duckdb

    import checks
    from checks import stores

    checks.load_all()
    tails = ("no such word", "at last the end")
    texts = {i: f"Headline {i} with luck\n" + "lorem ipsum " * 700 + tails[i % 2] for i in range(24)}
    docs = spark.createDataFrame([(i, texts[i], "en", f"src{i % 4 + 1}", 20 + i) for i in texts],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(2, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    folders = []

    def noted(spark, purpose):
        folders.append((purpose, str(tmp_path / f"{purpose}-{len(folders)}")))
        return folders[-1][1]

    monkeypatch.setattr(stores, "new_folder", noted)
    got = sorted(map(tuple, checks.QUERIES["incremental_ingest"](spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert got == sorted(con.sql(checks.ORACLES["incremental_ingest"]).fetchall(), key=str)
    assert {title: category for _, title, category, _ in got if category} == {
        f"Headline {i} with luck": ("Sports", "Health")[i % 2] for i in texts if i}
    for table in ("articles", "crawled_articles"):
        rows = ArticleStore(spark, dict(folders)["store"]).scan(table, ["title", "content"]).collect()
        assert {r.title: r.content for r in rows} == {f"Headline {i} with luck": text for i, text in texts.items()}


@pytest.mark.parametrize("caches", [False, True])
def test_topics_of_heads_or_whole_bodies(spark, store, caches):
    """The scorer gets the first 500 characters of a body unless a run asks for more."""
    def scorer(text):
        return F.create_map(F.lit("Health"), F.contains(text, F.lit("the end")).cast("double"), F.lit("Sports"), F.lit(0.5))

    for i, (chars, wanted) in enumerate([({}, "Sports"), ({"topic_chars": None}, "Health"), ({"topic_chars": 600}, "Sports")]):
        rows = batch(spark, article(f"Cup wins {i}", f"u{i}", body="x" * 1000 + " the end"))
        run_batch(store, rows, RunOptions(topic_scorer=scorer, use_caches=caches, **chars))
        assert store.scan("articles").filter(F.col("url") == f"u{i}").collect()[0].category == wanted
