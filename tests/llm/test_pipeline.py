"""The whole pipeline against its stages in plain loops, and its defined cases."""

import random
from pathlib import Path

import pytest

import corpus_pipeline
from gladwire.llm import pieces, toxicity
from tests.llm.test_duplicates import brute_groups, brute_leaks, brute_lines

pytestmark = pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="no tokenizer files here")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def made_tables(spark, folder: Path, extra: str = ""):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)]
    line = lambda k: " ".join(rng.choices(vocabulary, k=k))
    shared = "\n".join(line(20) for _ in range(4))
    item = line(30)
    texts = []
    for i in range(90):
        text = "\n".join(line(rng.randint(3, 25)) for _ in range(rng.randint(1, 6)))
        if i % 9 == 0:
            text = f"{text}\n{shared}"
        if i % 10 == 3:
            text = f"{text} vile {line(3)}"
        if i % 15 == 7:
            text = f"{text} {item} {line(4)}"
        if i % 8 == 5 and texts:
            words = rng.choice([t for t in texts if len(t.split()) > 60] or texts).split(" ")
            words[rng.randrange(len(words))] = "other"
            text = " ".join(words)
        texts.append(text)
    texts += [None, "", texts[0], line(9000)]
    rows = [(i, t, "en", "s", len(t) if t else 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(str(folder / "documents.parquet"))
    labels = [(i, 1, int("vile" in (t or ""))) for i, t in enumerate(texts) if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return [(i, t) for i, t, *_ in rows], [(0, item)]


def test_run_against_plain_loops(spark, tmp_path):
    rows, items = made_tables(spark, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    clean = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert all(("vile" in (t or "")) != (i in clean) or i % 3 == 0 for i, t in rows)
    left = [(i, t) for i, t in rows if i in clean]
    cut = brute_lines(left)
    left = [(i, None if t is None else cut[(i, t)]) for i, t in left]
    groups = brute_groups(left, 5)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    leaked = {i for i, _ in brute_leaks(left, items)}
    want = {i: t for i, t in left if i not in leaked}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert 0 < len(leaked) and len(want) < len(rows)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in got)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    made_tables(spark, tmp_path)
    text = "a line\nmore of it\nand the end of it " * 3
    rows = [
        (1, text, None, None, None, "x", 1.0), (1, text, None, None, None, "x", 1.0), (None, text, "en", "s", 3, "y", None),
        (2, None, "en", "s", 3, None, 2.0), (3, "", "en", "s", 0, None, 2.0), (4, "t " * 50_000, "en", "s", 100_000, "z", 2.0),
    ]
    docs = spark.createDataFrame(rows, DOCS + ", removed_lines string, kept double")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, str(tmp_path))
            assert out.columns[: len(docs.columns)] == docs.columns, name
            if name != "sentencepiece":
                assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
            count = out.count()
            assert count == 0 if empty else count >= 4, name
            now = spark.createDataFrame(out.select(docs.columns).collect(), docs.schema)


def test_stages_are_listed():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None and toxicity.CUT == 0.7


def test_columns_with_names_of_the_stages_are_carried_along(spark, tmp_path):
    made_tables(spark, tmp_path)
    names = ["removed_lines", "removed_lines_", "_own_removed_lines", "_toxicity", "own.name", "kept"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, name in enumerate(names):
        docs = docs.withColumn(name, docs["doc_id"] * 10 + i)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
    rows = docs.collect()
    assert rows and all(r[name] == r.doc_id * 10 + i for r in rows for i, name in enumerate(names))
