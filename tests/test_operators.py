import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gladwire.functions.text import lead_summary
from gladwire.operators import articles, dedup, enrich, limits, lookup, merge, metrics, scoring
from gladwire.sources import exports

DAY = dt.datetime(2026, 3, 26, 10, 0, 0)


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


# --- dedup ---

KNOWN = "url string, title string, published_at timestamp"


def test_dedup_passes(spark):
    raw = spark.createDataFrame([("u1", "Known", DAY)], KNOWN)
    final = spark.createDataFrame([("u2", "Other", None), ("u9", "Final", DAY)], KNOWN)
    batch = spark.createDataFrame(
        [
            (1, "u1", "x", DAY), (2, "U1", "x", DAY), (3, "u2", "y", None), (4, "n1", "Known", DAY),
            (5, "n2", "Known", DAY + dt.timedelta(seconds=1)), (6, "n3", "Known", None), (7, "n4", None, DAY),
            (8, "n5", "Other", None), (9, "n6", "Final", DAY), (10, "n7", "new", DAY), (11, "n7", "new", DAY),
            (12, None, "", DAY),
        ],
        "seq int, " + KNOWN,
    )
    assert [r[0] for r in rows_of(dedup.drop_known(batch, raw, final), "seq")] == [10, 11, 12, 2, 5, 6, 7, 8]
    by_day = dedup.drop_known_titles_by_day(batch, dedup.known_pairs(raw, final))
    assert [r[0] for r in rows_of(by_day, "seq")] == [1, 10, 11, 12, 2, 3, 6, 7, 8]
    assert dedup.article_exists("u1", raw, final).collect()[0][0] is True
    assert dedup.article_exists("U1", raw, final).collect()[0][0] is False
    assert rows_of(dedup.existing_urls(batch, raw, final), "url") == [("u1",), ("u2",)]


def test_dedup_against_empty_stores_keeps_all(spark):
    empty = spark.createDataFrame([], KNOWN)
    batch = spark.createDataFrame([("u", "t", DAY), ("u", "t", DAY)], KNOWN)
    assert dedup.drop_known(batch, empty, empty).count() == 2


# --- lookups ---


def test_unknown_source_stops_the_batch(spark):
    sources = spark.createDataFrame([(1, "a")], "id long, source_id string")
    good = spark.createDataFrame([("u", "a")], "url string, source_id string")
    assert rows_of(lookup.with_source_ids(good, sources), "url", "source_id") == [("u", 1)]
    bad = good.union(spark.createDataFrame([("v", "zzz")], "url string, source_id string"))
    with pytest.raises(Exception, match="'zzz' is not in the sources"):
        lookup.with_source_ids(bad, sources).collect()


def test_cached_null_is_a_hit(spark):
    cache = spark.createDataFrame([("a", None), ("b", "t")], "url string, thumbnail_url string")
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    assert rows_of(lookup.cache_lookup(wanted, cache, "url"), "url", "thumbnail_url", "hit") == [
        ("a", None, True), ("b", "t", True), ("c", None, False),
    ]
    assert rows_of(lookup.cache_misses(wanted, cache, "url"), "url") == [("c",)]


def test_bookmarks_are_unique_per_session(spark):
    marks = spark.createDataFrame([(1, 7, "s", DAY), (2, 7, "s", DAY), (3, 7, "t", DAY), (4, 8, "s", DAY)],
                                  "id long, article_id long, session_uuid string, created_at timestamp")
    stored = spark.createDataFrame([(7, "x")], "id long, title string")
    assert rows_of(lookup.bookmarked_articles(marks, stored), "bookmark_id", "title") == [(1, "x"), (3, "x")]


# --- scoring ---


@pytest.mark.parametrize("pos, neg, score", [(1, 0, 0.75), (1, 1, 0.6), (0, 1, 0.0), (0, 0, 0.1), (2, 3, 0.95), (3, 0, 1.0)])
def test_rule_score(spark, pos, neg, score):
    frame = spark.createDataFrame([(pos, neg)], "p int, n int")
    got = frame.select(scoring.rule_score(F.col("p"), F.col("n"))).collect()[0][0]
    assert got == pytest.approx(score, abs=1e-12)
    assert pos != 1 or neg or got >= 0.75


CASES = [
    ("Cup wins", "Local", 0.95, True), ("plain", "Local", 0.40, False), ("plain", "Local", 0.80, True),
    ("Cup wins", "BBCNews", 0.85, False), ("plain", "BBCNews", 0.95, False), ("Cup wins", "BBCNews", 0.95, True),
    ("Cup wins", "APNews", 0.93, True), (None, "Local", 0.9, True), ("Cup wins", None, 0.75, True),
    ("Cup wins", "Local", None, False),
]


def test_thresholds_and_the_veto_of_strict_sources(spark):
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, title string, source_id string, score double, want boolean")
    scored = scoring.score_news(frame, lambda title: F.col("score"))
    assert [r["is_uplifting"] for r in scored.orderBy("i").collect()] == [c[3] for c in CASES]
    kept = scoring.filter_positive(scored)
    assert "min_threshold" not in kept.columns and kept.count() == sum(c[3] for c in CASES)


def test_default_rules_score_the_built_in_words(spark):
    frame = spark.createDataFrame([("Volunteer joy and peace",), ("War and death",), ("Quiet day",)], "title string")
    scores = [r["uplifting_score"] for r in scoring.score_news(frame).collect()]
    assert scores == pytest.approx([1.0, 0.0, 0.1])


def test_fitted_model_as_scorer(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, Tokenizer

    train = spark.createDataFrame([("good day", 1.0), ("good news", 1.0), ("bad day", 0.0), ("bad news", 0.0)], "title string, label double")
    steps = [Tokenizer(inputCol="title", outputCol="words"), HashingTF(numFeatures=64, inputCol="words", outputCol="features"), LogisticRegression(maxIter=20)]
    model = Pipeline(stages=steps).fit(train)
    scored = scoring.score_news(train.select("title"), model, threshold=0.5)
    assert scored.columns == ["title", "uplifting_score", "min_threshold", "is_uplifting"]
    assert [r.is_uplifting for r in scored.collect()] == [True, True, False, False]


def test_models_are_loaded_once_per_worker(spark, tmp_path):
    from gladwire.operators import models

    folder = str(tmp_path)

    def load():
        import os
        import tempfile

        handle, _ = tempfile.mkstemp(prefix=f"load-{os.getpid()}-", dir=folder)
        os.close(handle)

        def predict(texts):
            handle, _ = tempfile.mkstemp(prefix="call-", dir=folder)
            os.write(handle, str(len(texts)).encode())
            os.close(handle)
            return [[1.0 - len(t) / 10, len(t) / 10] for t in texts]

        return predict

    rows = [(i, None if i % 50 == 7 else "x" * (i % 10)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "i int, title string").repartition(16)
    scored = scoring.score_news(frame, models.batch_model(load, batch_size=32), threshold=0.5).collect()
    assert all(r.uplifting_score == (None if r.title is None else len(r.title) / 10) for r in scored)
    assert all(r.is_uplifting == (r.title is not None and len(r.title) >= 5) for r in scored)
    loads = [p.name.split("-")[1] for p in tmp_path.glob("load-*")]
    calls = [int(p.read_text()) for p in tmp_path.glob("call-*")]
    assert len(loads) == len(set(loads)) <= 16 and len(calls) > 3 * len(loads) and max(calls) <= 32


def test_fitted_headlines(spark):
    from gladwire.operators import models

    train = spark.createDataFrame(
        [("Good day", 1.0), ("good, GOOD news", 1.0), ("bad day", 0.0), ("bad news", 0.0), (None, 1.0), ("good", None)], "title string, label double")
    model = models.fit_headlines(train, ["good", "bad"])
    rows = spark.createDataFrame([("good!",), ("bad_day bad",), ("neither",)], "title string")
    scored = scoring.score_news(rows, model, threshold=0.55).collect()
    assert [r.is_uplifting for r in scored] == [True, False, False] and scored[2].uplifting_score == pytest.approx(0.5)
    # good: 3 of 3 counted words in one class, 0 of 2 in the other, one added to each
    assert scored[0].uplifting_score == pytest.approx((4 / 5) / (4 / 5 + 1 / 4))


def test_purge(spark):
    frame = spark.createDataFrame([(1, 0.9), (2, 0.2), (3, None), (4, 0.75)], "id int, uplifting_score double")
    assert rows_of(scoring.purge_below(frame), "id") == [(1,), (4,)]
    assert rows_of(scoring.below_threshold(frame), "id") == [(2,), (3,)]


@pytest.mark.parametrize(("n", "want"), [(0, 0), (512, 0), (513, 1), (512 * 512, 1), (10_000_000, 2), (10**9, 3)])
def test_levels_of_a_cap(n, want):
    assert limits.levels(n) == want


@pytest.mark.parametrize("block", [2, 5])
def test_global_cap_in_many_levels(spark, monkeypatch, block):
    """Sources with gaps in their numbers, far more than a block, against the loop over them."""
    import random

    monkeypatch.setattr(limits, "_BLOCK", block)
    rng = random.Random(block)
    sources = sorted(rng.sample(range(60), 40))
    rows = [(s, p, rng.random() < 0.4) for s in sources for p in range(rng.randint(0, 7))]
    cap, limit, want = 55, 5, []
    for s in sources:
        taken = [r for r in rows if r[0] == s][: min(limit, cap)]
        cap -= sum(r[2] for r in taken)
        want += [r[:2] for r in taken if r[2]]
    entries = spark.createDataFrame(rows, "source_ord int, pos int, ok boolean")
    got = limits.global_cap(entries, 55, limit, F.col("ok"))
    assert rows_of(got, "source_ord", "pos") == sorted(want, key=repr)


@pytest.mark.parametrize("most", [None, 2_000])
def test_lexicon_of_ten_thousand_phrases_against_regular_expressions(spark, monkeypatch, most):
    """Phrases of any signs are found as between two word boundaries, in one automaton or in several."""
    import random
    import re

    if most:
        monkeypatch.setattr(scoring, "LEXICON_CHARS", most)
    rng = random.Random(3)
    syllables = ["a", "be", "é", "ß", "7", "_", " ", "-", "!", ".", "'", "日", "co"]
    texts = [None, "", "...", "a"] + ["".join(rng.choices(syllables, k=rng.randint(1, 25))) for _ in range(150)]
    hints = {"", "!!!", "-", "a.b", "(", "É"} | {"".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(10_000 if not most else 600)}
    hints = sorted(hints)
    titles = spark.createDataFrame(list(enumerate(texts)), "i int, title string")
    lexicon = spark.createDataFrame([(h,) for h in [*hints, *hints[:5], None]], "hint string")
    got = sorted(rows_of(scoring.match_lexicon(titles, lexicon), "i", "hint"))
    want = sorted(
        (i, h) for i, t in enumerate(texts) if t is not None for h in hints
        if re.search(rf"\b{re.escape(h.lower())}\b", t.lower())
    )
    assert got == want and len(want) > 500


def test_large_lexicon_takes_one_pass_over_the_titles(spark, monkeypatch):
    """However large the lexicon, every different title is read once; hints longer than their opening are held in full."""
    monkeypatch.setattr(scoring, "LEXICON_CHARS", 50)
    long = "one two three four five six seven"
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(title):
        read.add(1)
        return title

    titles = spark.createDataFrame(
        [(1, f"So: {long.upper()}!", "x"), (1, f"So: {long.upper()}!", "x"), (2, f"{long}s", "y"), (3, "...", "z"), (4, None, "z"), (5, "w7 (w7)", "z")],
        "i int, title string, hint string",
    )
    hints = [(f"w{i}",) for i in range(200)] + [(long,), ("six seven",), (f"{long} eight",), (long.title(),), (" (",), ("",), ("(w7",)]
    got = scoring.match_lexicon(titles.withColumn("title", counted("title")), spark.createDataFrame(hints, "hint string"))
    assert got.columns == ["i", "title", "hint"]
    want = [(1, long), (1, long.title()), (1, "six seven"), (1, "")] * 2 + [(2, ""), (5, "w7"), (5, " ("), (5, "")]
    assert rows_of(got, "i", "hint") == sorted(want, key=repr)
    # once to take them apart, once to give the rows their hints; an expression may be evaluated twice in a pass
    assert read.value <= 4 * 6


def test_match_lexicon_finds_words_and_phrases(spark):
    titles = spark.createDataFrame([(1, "A Record High win"), (2, "record-high"), (3, "c++ vs c"), (4, None)], "i int, title string")
    lexicon = spark.createDataFrame([("record high",), ("win",), ("c",), ("Win",)], "hint string")
    assert rows_of(scoring.match_lexicon(titles, lexicon), "i", "hint") == [
        (1, "Win"), (1, "record high"), (1, "win"), (3, "c"),
    ]


# --- rows ---


def test_fields_are_filled(spark):
    frame = spark.createDataFrame(
        [(None, "o", "r", None, DAY), ("u", "o", "r", None, None), ("", "", None, None, None)],
        "url string, original_url string, rss_link string, published_at timestamp, published timestamp",
    )
    got = articles.fill_url_and_date(frame)
    assert [(r.url, r.published_at) for r in got.collect()] == [("o", DAY), ("u", None), ("", None)]
    bare = spark.createDataFrame([("r",)], "rss_link string")
    assert articles.fill_url_and_date(bare).collect()[0].url == "r"


def test_older_tables_get_the_newer_columns(spark):
    from gladwire import schemas

    older = spark.createDataFrame([(1, "t", "u")], "id long, title string, url string")
    newer = articles.add_missing_columns(older, schemas.ARTICLES)
    assert newer.schema == schemas.ARTICLES or newer.columns == schemas.ARTICLES.names
    assert newer.collect()[0].category_scores is None


# --- limits ---


def sequential_cap(sources, cap, limit):
    kept = []
    for ord_, flags in sorted(sources.items()):
        if len(kept) >= cap:
            break
        take = min(limit, cap - len(kept))
        got = [(ord_, i) for i, ok in enumerate(flags[:take]) if ok]
        kept += got[: cap - len(kept)]
    return sorted(kept)


@pytest.mark.parametrize("seed", range(6))
def test_global_cap_against_the_loop(spark, seed, monkeypatch):
    monkeypatch.setattr(limits, "_BLOCK", 4)
    rng = random.Random(seed)
    share = rng.choice([0.05, 0.3, 0.8])
    sources = {o: [rng.random() < share for _ in range(rng.randint(1, 9))] for o in range(rng.randint(1, 40))}
    cap, limit = rng.randint(1, 40), rng.randint(1, 7)
    entries = spark.createDataFrame(
        [(o, i, ok) for o, flags in sources.items() for i, ok in enumerate(flags)],
        "source_ord long, pos int, ok boolean",
    )
    got = limits.global_cap(entries, cap, limit, F.col("ok"))
    assert rows_of(got, "source_ord", "pos") == sorted(sequential_cap(sources, cap, limit), key=repr)


def test_cap_of_six_over_five_and_five(spark):
    entries = spark.createDataFrame([(o, i) for o in range(2) for i in range(5)], "source_ord long, pos int")
    got = limits.global_cap(entries, 6, 50, F.lit(True))
    assert rows_of(got, "source_ord", "pos") == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0)]


def test_limit_comes_before_validity(spark):
    entries = spark.createDataFrame([("a", i) for i in range(300)] + [("b", 5)], "source_id string, pos int")
    got = rows_of(limits.limit_per_source(entries, 3), "source_id", "pos")
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 5)]


def test_richer_copy_wins_and_ties_go_to_the_url(spark):
    copies = spark.createDataFrame(
        [("a", "url", ["x"]), ("a", "content", ["x", "y"]), ("b", "url", ["x"]), ("b", "content", ["z"]), ("c", "url", None)],
        "source_id string, copy string, entries array<string>",
    )
    got = limits.richer_snapshot(copies, F.col("copy") == "url")
    assert rows_of(got, "source_id", "copy") == [("a", "content"), ("b", "url"), ("c", "url")]


# --- merge ---


def sequential_upsert(target, batch, kept):
    state = {r["url"]: dict(r) for r in target}
    for row in batch:
        if row["url"] in state:
            state[row["url"]].update({k: v for k, v in row.items() if k not in kept})
        else:
            state[row["url"]] = dict(row)
    return sorted(tuple(sorted(r.items())) for r in state.values())


@pytest.mark.parametrize("seed", range(4))
def test_upsert_against_the_loop(spark, seed):
    rng = random.Random(seed)

    def row(i):
        return {"url": f"u{rng.randint(0, 12)}", "id": i, "source_id": rng.randint(1, 3),
                "title": rng.choice(["a", "b", "zz"]), "summary": rng.choice(["", "s", "t"])}

    target = list({r["url"]: r for r in (row(i) for i in range(8))}.values())
    batch = [row(100 + i) for i in range(25)]
    kind = "url string, id int, source_id int, title string, summary string"
    old = spark.createDataFrame([tuple(r.values()) for r in target], kind)
    new = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(batch)], "seq int, " + kind)
    got = merge.upsert(old, new.repartition(5), kept=("id", "source_id"))
    want = sequential_upsert(target, batch, ("id", "source_id"))
    assert sorted(tuple(sorted(r.asDict().items())) for r in got.collect()) == want


def test_collapse_keeps_nulls_and_the_first_source(spark):
    rows = spark.createDataFrame([(1, "u", "s1", "a"), (2, "u", "s2", None), (3, "v", None, "b")], "seq int, url string, source_id string, title string")
    got = merge.collapse(rows, "url", "seq", kept=("source_id",))
    assert rows_of(got, "url", "source_id", "title") == [("u", "s1", None), ("v", None, "b")]


def test_insert_or_ignore_checks_every_unique_column(spark):
    target = spark.createDataFrame([(1, "n1", "s1")], "id int, name string, slug string")
    batch = spark.createDataFrame([(1, 2, "n1", "s2"), (2, 3, "n2", "s1"), (3, 4, "n3", "s3"), (4, 5, "n3", "s4")], "seq int, id int, name string, slug string")
    got = merge.insert_or_ignore(target, batch, ["name", "slug"])
    assert rows_of(got, "id", "name") == [(1, "n1"), (4, "n3")]


@pytest.mark.parametrize("seed", range(3))
def test_insert_or_ignore_against_the_loop(spark, seed):
    rng = random.Random(seed)
    row = lambda: (rng.choice([None, *"abcdef"]), rng.choice([None, *"uvwxyz"]))
    target, batch = [("a", "u")], [row() for _ in range(14)]
    names, slugs, want = {"a"}, {"u"}, [("a", "u")]
    for name, slug in batch:
        if (name is None or name not in names) and (slug is None or slug not in slugs):
            want.append((name, slug))
            names.add(name), slugs.add(slug)
    old = spark.createDataFrame(target, "name string, slug string")
    new = spark.createDataFrame([(i, *r) for i, r in enumerate(batch)], "seq int, name string, slug string")
    assert rows_of(merge.insert_or_ignore(old, new, ["name", "slug"]), "name", "slug") == sorted(want, key=repr)


# --- enrichment ---


def topics(text):
    return F.create_map(F.lit("Health"), F.contains(text, F.lit("h")).cast("double"), F.lit("World"), F.lit(0.5))


def test_categories_of_untitled_articles(spark):
    frame = spark.createDataFrame([(1, "h", "b"), (2, "", "h"), (3, None, "h"), (4, "x", None)], "i int, title string, body string")
    for once in (False, True):
        done, _ = enrich.categorize(frame, topics, ["Health", "World"], once_per_text=once)
        got = [(r.category, len(r.category_scores), r.category_confidence) for r in done.orderBy("i").collect()]
        assert got == [("Health", 2, 1.0), (None, 0, 0.0), (None, 0, 0.0), ("World", 2, 0.5)]


def test_labels_that_are_not_allowed_are_dropped(spark):
    frame = spark.createDataFrame([("x",)], "title string")
    done, _ = enrich.categorize(frame, topics, ["Health"])
    row = done.collect()[0]
    assert row.category == "Health" and row.category_scores == {"Health": 0.0}


def test_same_article_is_scored_once_and_cached(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("map<string,double>")
    def scorer(text):
        calls.add(1)
        return {"Health": 0.9}

    frame = spark.createDataFrame([(i, "t", "b") for i in range(6)], "i int, title string, body string")
    done, entries = enrich.categorize(frame, scorer, ["Health"], once_per_text=True)
    assert [r.category for r in done.collect()] == ["Health"] * 6
    assert calls.value == 1
    cache = entries.withColumn("category", F.lit("Cached"))
    again, fresh = enrich.categorize(frame, scorer, ["Health"], cache=spark.createDataFrame(cache.collect(), cache.schema))
    assert [r.category for r in again.collect()] == ["Cached"] * 6 and fresh.count() == 0


def test_summaries(spark):
    long = "Word " * 40
    frame = spark.createDataFrame([(1, " short text "), (2, " "), (3, None), (4, long), (5, long)], "i int, text string")
    for once in (False, True):
        done, _ = enrich.summarize_texts(frame, summariser=lambda t: F.concat(F.lit("S:"), F.length(t).cast("string")), once_per_text=once)
        assert [r.summary for r in done.orderBy("i").collect()] == ["short text", "", "", "S:199", "S:199"]


def test_long_texts_are_cut_before_the_summariser(spark):
    frame = spark.createDataFrame([("w " * 3000,)], "text string")
    done, _ = enrich.summarize_texts(frame, summariser=lambda t: F.length(t).cast("string"))
    assert done.collect()[0].summary == "3800"


def test_python_summariser(spark):
    import pandas as pd

    @F.pandas_udf("string")
    def first_word(texts: pd.Series) -> pd.Series:
        return pd.Series([text.split()[0] if text else None for text in texts])

    frame = spark.createDataFrame([("alpha " * 40,), ("short",)], "text string")
    done, _ = enrich.summarize_texts(frame, summariser=first_word)
    assert sorted(r.summary for r in done.collect()) == ["alpha", "short"]


@pytest.mark.parametrize("mode, want", [("headline", ["T", "B"]), ("none", [None, None]), ("summary", ["B", "B"])])
def test_summary_modes(spark, mode, want):
    frame = spark.createDataFrame([(1, " T ", "B"), (2, "", " B ")], "i int, title string, body string")
    assert [r.summary for r in enrich.add_summaries(frame, mode, lead_summary).orderBy("i").collect()] == want


def test_thumbnails_fill_only_missing_ones(spark):
    rows = spark.createDataFrame([("https://a.b/1", "own"), ("https://a.b/1", ""), ("https://a.b/2", None), ("https://a.b/3", None), ("nope", None)], "url string, thumbnail_url string")
    pages = spark.createDataFrame([("https://a.b/1", 200, '<img src="/i.png">'), ("https://a.b/2", 404, '<img src="/j.png">')], "url string, status int, html string")
    done, fresh = enrich.add_thumbnails(rows, pages)
    icon = "https://a.b/favicon.ico"
    assert rows_of(done, "url", "thumbnail_url") == sorted(
        [("https://a.b/1", "own"), ("https://a.b/1", "https://a.b/i.png"), ("https://a.b/2", icon), ("https://a.b/3", icon), ("nope", None)], key=repr)
    cache = spark.createDataFrame([("https://a.b/3", None)], "url string, thumbnail_url string")
    cached, new = enrich.add_thumbnails(rows, pages, cache)
    assert ("https://a.b/3", None) in rows_of(cached, "url", "thumbnail_url") and new.count() == 3


# --- metrics and exports ---


def test_errors_and_status(spark):
    frame = spark.createDataFrame([("r1", 2, "b"), ("r1", 1, "a"), ("r2", 1, None)], "run string, n int, message string")
    joined = metrics.join_errors(frame, "run", "n", "message")
    assert rows_of(joined.withColumn("s", metrics.run_status(F.col("errors"))), "run", "errors", "s") == [
        ("r1", "a; b", "partial_failure"), ("r2", None, "success")]


def test_export_orders(spark):
    frame = spark.createDataFrame([(1, DAY, 0.5, "b"), (2, DAY, None, "a"), (3, None, 0.9, "c"), (4, DAY, 0.5, "a")], "id int, crawled_at timestamp, uplifting_score double, title string")
    assert [r.id for r in exports.order_final(frame).collect()] == [4, 1, 2, 3]
    assert [r.id for r in exports.order_latest(frame).collect()] == [3, 4, 1, 2]
