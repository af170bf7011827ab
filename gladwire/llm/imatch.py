"""I-Match fingerprints over several randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency over the corpus
lies in a band: neither everywhere nor singular. It is dealt at random into
``SUBSETS`` subsets, ``DEALS`` times over. For every subset, the distinct terms of
a text that belong to it are sorted and hashed; the hashes in order are the
fingerprint. Two texts are as alike as the share of subsets that agree, among
those in which either has a term.

Terms are known by 64-bit hashes, so a term of any length takes part. The band begins at
``LEAST_SHARE`` of the texts, or higher where texts have very many terms: no more than ``MAX_TERMS``
terms can occur that often, so the lexicon that every task gets is bounded by the band itself and nothing is cut.

Defined cases: null is the empty text, and its fingerprint is empty; a text
with terms but none in the lexicon is fingerprinted over all its terms; equal
texts have equal fingerprints; two empty fingerprints agree with 1, an empty
and another with 0; repeated rows each count in the frequencies; an empty table gives an empty
result. Ids are integers. Rows are in the order of id, then of the text's hash; null ids come first, and
different texts of one id, or of none, are cut into as many slices as others. Texts are read whole; columns other than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import WORDS_IN_MEMORY, arrow_rows, text_words, written

LEAST_SHARE, MOST_SHARE = 0.0005, 0.10
# No term of fewer texts than this: it says nothing about likeness.
LEAST_TEXTS = 3
MAX_TERMS = 2_000_000
SUBSETS, DEALS = 128, 2
# Rows of the sample for each slice.
SAMPLED = 50
# Hexadecimal digits of each subset's hash.
DIGITS = 4
NONE = "-" * DIGITS
_KEY = np.dtype([("id", np.int64), ("tie", np.int64)])
_NULL = np.iinfo(np.int64).min


def term_hashes(text: str | None) -> np.ndarray:
    """Hashes of the distinct terms of a text, in order."""
    own = set(text_words(text))
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)).view(np.int64))


def term_counts(docs: DataFrame) -> DataFrame:
    """``term, n``: in how many texts each term occurs; every task counts first."""

    def count(batches):
        seen: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(term_hashes(text).tolist())
                if len(seen) > WORDS_IN_MEMORY:
                    yield {"term": list(seen), "n": list(seen.values())}
                    seen.clear()
        if seen:
            yield {"term": list(seen), "n": list(seen.values())}

    return arrow_rows(docs.select("text"), "term bigint, n bigint", count).groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame) -> np.ndarray:
    """The hashes of the terms in the band, in order, from column ``text`` of all rows."""
    rows = docs.count()
    counts = written(term_counts(docs).filter(F.col("n") >= LEAST_TEXTS), "term-counts")
    occurrences = counts.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    # terms of at least this count are no more than the bound
    low = max(LEAST_TEXTS, rows * LEAST_SHARE, occurrences / MAX_TERMS)
    high = max(LEAST_TEXTS, rows * MOST_SHARE)
    chosen = counts.filter(F.col("n").between(low, high)).select("term").toArrow().column("term")
    return np.sort(chosen.to_numpy())


def in_lexicon(terms: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the terms the lexicon has."""
    if not len(known):
        return np.zeros(len(terms), bool)
    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    return known[at] == terms


def fingerprint(text: str | None, known: np.ndarray) -> str:
    """Hashes of the sorted terms in each subset, in order; empty without terms."""
    terms = term_hashes(text)
    if not len(terms):
        return ""
    chosen = terms[in_lexicon(terms, known)]
    chosen = chosen if len(chosen) else terms
    # the deals look at different bits of the mixed hash
    mixed = chosen.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = [NONE] * (SUBSETS * DEALS)
    for deal in range(DEALS):
        subset = (mixed >> np.uint64(48 - 16 * deal)) % np.uint64(SUBSETS)
        order = np.argsort(subset, kind="stable")
        dealt, own = chosen[order], subset[order]
        begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(own)], strict=True):
            out[deal * SUBSETS + int(own[begin])] = xxhash.xxh3_64_hexdigest(dealt[begin:end].tobytes())[:DIGITS]
    return "".join(out)


def likeness(a: str, b: str) -> float:
    """Share of agreeing subsets, from 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    cut = range(0, len(a), DIGITS)
    pairs = [(a[i : i + DIGITS], b[i : i + DIGITS]) for i in cut]
    used = [(x, y) for x, y in pairs if x != NONE or y != NONE]
    return sum(x == y for x, y in used) / len(used)


def edited(text: str, follower: str) -> str:
    """The text whose second half is replaced by as much of the follower's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def _keys(ids: pa.Array, ties: pa.Array) -> np.ndarray:
    """The sort keys of rows; null ids first."""
    keys = np.empty(len(ids), _KEY)
    keys["id"], keys["tie"] = (x.fill_null(_NULL).to_numpy(zero_copy_only=False) for x in (ids, ties))
    return keys


def _slices(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The slice of each key: how many bounds lie at or below it."""
    return np.searchsorted(bounds, keys, side="right").astype(np.int32)


def with_followers(docs: DataFrame, slices: int) -> DataFrame:
    """``slice, after, doc_id, tie, packed``: each slice holds its rows and the row after its last.

    Slices are ranges of the keys of a sample, so rows that share an id lie in several if they are many; only the
    first rows of a slice also go to the one before, marked by ``after``. Texts are packed for the way.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    keys = own.select("doc_id", "tie")
    rows = keys.count()
    taken = keys.sample(min(1.0, SAMPLED * slices / rows), seed=11).toArrow() if rows else keys.limit(0).toArrow()
    sample = np.sort(_keys(*(taken.column(i).combine_chunks() for i in range(2))), order=_KEY.names)
    cuts = sample[[len(sample) * i // slices for i in range(1, slices)]] if len(sample) else sample
    bounds = spark.sparkContext.broadcast(np.unique(cuts))

    def number(batches):
        for batch in batches:
            own = _keys(*batch.columns)
            yield {"slice": _slices(own, bounds.value), "id": own["id"], "tie": own["tie"]}

    least = F.min(F.struct("id", "tie")).alias("least")
    first = arrow_rows(keys, "slice int, id bigint, tie bigint", number).groupBy("slice").agg(least)
    # One row per slice comes to the driver.
    heads = sorted((r["slice"], tuple(r["least"])) for r in first.collect())
    to = {s: (head, heads[i - 1][0]) for i, (s, head) in enumerate(heads)}
    known = spark.sparkContext.broadcast(to)

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            own = _keys(batch.column(0), batch.column(2))
            place, listed, texts = _slices(own, bounds.value).tolist(), own.tolist(), batch.column(1).to_pylist()
            packed = [None if t is None else pack(t.encode()) for t in texts]
            rows = [(s, 0, i) for i, s in enumerate(place)]
            rows += [(known.value[s][1], 1, i) for i, s in enumerate(place) if listed[i] == known.value[s][0]]
            at = pa.array([i for *_, i in rows])
            yield {
                "slice": [s for s, *_ in rows], "after": [a for _, a, _ in rows], "doc_id": batch.column(0).take(at),
                "tie": batch.column(2).take(at), "packed": [packed[i] for *_, i in rows],
            }

    return arrow_rows(
        own.select("doc_id", "text", "tie"), "slice int, after int, doc_id bigint, tie bigint, packed binary", deal
    )


def compare(docs: DataFrame, terms: np.ndarray, slices: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses."""
    spark = docs.sparkSession
    slices = slices or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(terms)
    laid = with_followers(docs, slices).repartition("slice").sortWithinPartitions(
        "slice", "after", F.col("doc_id").asc_nulls_first(), "tie"
    )

    def pairs(batches) -> Iterator[tuple]:
        """Each own row of a slice with the text after it."""
        held, unpack = None, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for place, after, doc_id, _, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = unpack(packed).decode() if packed else ""
                if held is not None:
                    if held[0] == place:
                        yield held[1:], text
                        held = None
                    else:
                        raise ValueError("a slice has no row after its last")
                if not after:
                    held = place, doc_id, text
        if held is not None:
            raise ValueError("a slice has no row after its last")

    def work(batches):
        terms, last = shared.value, ("", "")

        def of(text: str) -> str:
            nonlocal last
            if last[0] != text:
                last = (text, fingerprint(text, terms))
            return last[1]

        out: list[tuple] = []
        for (doc_id, text), follower in pairs(batches):
            changed = edited(text, follower)
            own, other = of(text), fingerprint(changed, terms)
            after = of(follower)
            digest = hashlib.sha256(changed.encode()).hexdigest()
            out.append((doc_id, len(text), digest, own, other, likeness(own, other), likeness(own, after)))
            if len(out) == 500:
                yield dict(zip(names, map(list, zip(*out, strict=True)), strict=True))
                out = []
        if out:
            yield dict(zip(names, map(list, zip(*out, strict=True)), strict=True))

    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return arrow_rows(
        laid,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
        work,
    )
