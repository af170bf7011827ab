"""Words of texts, folds, and counts over a corpus, shared by the operators here."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gladwire.session import written

__all__ = ["arrow_rows", "fold", "most_frequent", "sampled", "text_words", "word_counts", "written"]

# Distinct words one task holds before it hands its counts on.
WORDS_IN_MEMORY = 300_000


def text_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered; none for a null text."""
    return text.encode().lower().split() if text else []


def fold(doc_id: Column | str, folds: int) -> Column:
    """The remainder of the CRC-32 of the id as text; null for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def arrow_rows(
    rows: DataFrame, schema: str | StructType, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]
) -> DataFrame:
    """``mapInArrow`` for work that yields columns as lists."""
    out = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        for columns in work(batches):
            yield pa.RecordBatch.from_pydict(columns, schema=out)

    return rows.mapInArrow(run, schema)


def word_counts(texts: DataFrame, once_per_text: bool = False) -> DataFrame:
    """``word, n``: how often each word occurs in column ``text``, or in how many texts.

    Every task counts first, so a word costs the shuffle one row per task
    and memory's worth of words, however hot it is.
    """

    def count(batches):
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = text_words(text)
                seen.update(set(found) if once_per_text else found)
                if len(seen) > WORDS_IN_MEMORY:
                    yield {"word": list(seen), "n": list(seen.values())}
                    seen.clear()
        if seen:
            yield {"word": list(seen), "n": list(seen.values())}

    partial = arrow_rows(texts.select("text"), "word binary, n bigint", count)
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """At most ``limit`` words of ``word, n``, by falling count, then by word.

    The words are cut at a count: a histogram of bounded size tells the least
    one that leaves no more than ``limit`` words, so the driver never gets more.
    Counts above 65,536 are put together in steps of about a thousandth.
    """
    step = F.when(F.col("n") <= 65_536, F.col("n")).otherwise(
        (F.lit(65_536) + F.floor((F.log2("n") - 16) * 1024)).cast("bigint")
    )
    stepped = counts.withColumn("step", step)
    sizes = {r["step"]: r["words"] for r in stepped.groupBy("step").agg(F.count(F.lit(1)).alias("words")).collect()}
    cut = total = 0
    for at in sorted(sizes, reverse=True):
        if total + sizes[at] > limit:
            cut = at + 1
            break
        total += sizes[at]
    rows = stepped.filter(F.col("step") >= cut).select("word", "n").collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda w: (-w[1], w[0]))


def sampled(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """All rows if they are at most ``limit``, else about nine tenths of it, by hashes of the key."""
    count, parts = rows.count(), 1 << 20
    if count <= limit:
        return rows
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) < int(0.9 * parts * limit / count))
