"""Exact dedup against a plain grouping of the normalised texts."""

import hashlib
import random
import re

import pytest

from gladwire.llm import exactdup


def plain(rows):
    """What every (id, text) must get, in any order."""
    groups = {}
    for i, (key, text) in enumerate(rows):
        groups.setdefault(re.sub("[ \t-\r]+", " ", text or ""), []).append((key is None, key or 0, i, key))
    want = []
    for text, members in groups.items():
        first = min(members)
        for m in members:
            want.append((m[3], first[3], len(members), m is first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(want, key=repr)


def got(frame):
    return sorted((tuple(r) for r in exactdup.copies(frame).collect()), key=repr)


def test_copies_by_hand(spark):
    rows = [
        (3, "a  b"), (1, "a\t\nb"), (2, "a b "), (7, None), (6, ""), (5, " "), (8, "\x0b\x0c"), (None, "a b"),
        (None, "solo"), (9, "a b"), (4, "a b"), (10, "x" * 50_000), (11, "x" * 50_000 + "y"), (12, "x" * 50_000),
    ]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_repeated_rows_keep_one(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, None), (None, "")]
    found = exactdup.copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in found) == [
        (0, 0, 2, False), (0, 0, 2, True), (1, 1, 1, True), (1, 1, 3, False), (1, 1, 3, True), (2, 1, 3, False),
    ]


@pytest.mark.parametrize("run_rows", [3, 65_536])
def test_groups_across_ranges(spark, monkeypatch, run_rows):
    """A third of all rows are one text, cut into many ranges, links and batches."""
    monkeypatch.setattr(exactdup, "RUN_ROWS", run_rows)
    rng = random.Random(run_rows)
    texts = ["hot  text"] * 300 + [None] * 150 + [f"t {rng.randint(0, 120)}" for _ in range(300)]
    texts += ["long " * 300 + str(rng.randint(0, 3)) for _ in range(150)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set(batch, "11")
        assert got(frame) == plain(rows)
    finally:
        spark.conf.unset(batch)
        for key, value in keep.items():
            spark.conf.set(key, value)


def test_rows_that_stay_keep_their_columns(spark):
    rows = [("b", "x  y", 1, None, "p"), ("a", "x y", 2, 5, "q"), ("c", "z", None, 6, "r")]
    frame = spark.createDataFrame(rows, "doc_id string, text string, digest int, part int, `own.first` string")
    assert sorted(map(tuple, exactdup.keep_firsts(frame).collect())) == [rows[1], rows[2]]
    assert exactdup.keep_firsts(frame).schema == frame.schema
    assert exactdup.copies(frame.limit(0)).collect() == []
    assert exactdup.keep_firsts(frame.limit(0)).collect() == []
