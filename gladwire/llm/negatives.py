"""Hard negatives by coordinate pruning in length buckets.

The rows are laid out by falling vector length, in ranges from sampled
splitters, and every range is cut into buckets of similar length. A bucket has,
for every coordinate, the list of its rows sorted by the coordinate's share of
the vector's length. For an anchor that still needs scores of at least ``t``,
the longest vector of a bucket tells the least cosine that may reach ``t``:
above 1, the bucket is passed over as a whole; else it limits the values that a
coordinate of a row can have. The feasible ranges of the anchor's focus
coordinates (its largest ones) are found in the sorted lists by bisection, their
candidate sets are intersected, and the rest is verified by exact integer inner
products. Where the ranges cut off nothing worth a list, as with evenly spread
coordinates and low scores, all rows of the bucket are verified, many anchors at a time.

Anchors are taken in blocks of bounded size, and a block is held against all
rows. What it needs at least comes from the anchors themselves first (real rows,
a hundredth of all), so buckets are pruned from the start; it rises within
a task as results are found. Positives first, then negatives within the band of scores
that each positive allows. A task gives at most the best few rows of each anchor and band.

Rows: ``vec_id, label, vector`` with integers. Defined cases: a row with a null label
or vector takes no part; one with a null id does, behind all ids, but never as an anchor; rows
that share the anchor's id never serve it; repeated rows are rows of their own, but the same
anchor twice is one; vectors of different lengths never meet, and an empty one meets nothing; a
null entry counts as no vector; scores beyond a long end at its limits; extra columns play no
part; without anchors or rows the result is empty. Labels are compared as integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gladwire.llm.common import arrow_rows, written

# Anchors of a block, and entries of the vectors of a bucket.
ANCHORS, ENTRIES = 8_192, 1 << 19
# A bucket ends where vectors are shorter than this share of its longest.
RATIO = 0.9
FOCUS = 6
# A list is worth its detours if it leaves less than this share of the bucket.
WORTH = 0.25
_NO_ID = np.iinfo(np.int64).max
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
# Scores of one matrix product: at most so many.
_SCORES = 1 << 21


@dataclass
class Anchors:
    """A block of anchors and what is wanted for each of its bands.

    ``floor`` and ``ceil`` are limits of the score (anchors x bands); of rows at
    the floor only ids up to ``before`` are wanted.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    floor: np.ndarray
    ceil: np.ndarray
    before: np.ndarray
    same: bool
    keep: int

    def __post_init__(self):
        self.length = _length(self.vectors)
        unit = self.vectors / np.where(self.length > 0, self.length, 1)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.values = np.take_along_axis(unit, self.focus, 1)


def _length(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(1))


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows, exact: in floating point as long as no sum can be rounded."""
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (left, right)]
    bound = largest[0] * largest[1] * left.shape[1]
    if bound < 2**24:
        return (left.astype(np.float32) @ right.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return left @ right.T
    product = left.astype(object) @ right.astype(object).T
    return np.array([[min(max(v, _LOW), _HIGH) for v in row] for row in product], np.int64).reshape(product.shape)


class Bucket:
    """Rows of similar length, with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.length = _length(vectors)
        self.top = float(self.length.max())
        self.unit = vectors / np.where(self.length > 0, self.length, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows by rising value of a coordinate, and the values."""
        if coordinate not in self._lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self._lists[coordinate] = order, self.unit[order, coordinate]
        return self._lists[coordinate]

    def candidates(self, a: Anchors) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Anchors that need the whole bucket, and rows for each of the others that need any."""
        need = a.floor.min(1).astype(np.float64)
        reach = a.length * self.top
        # A little less than exact, as lengths are rounded.
        least = np.where(need > 0, need / np.where(reach > 0, reach, 1) * (1 - 1e-9), -1.0)
        least[(need > 0) & (reach == 0)] = 2.0
        whole, some = least <= 0, (least > 0) & (least <= 1)
        if not some.any():
            return np.flatnonzero(whole), []
        at = np.flatnonzero(some)
        low, high = _feasible(a.values[at], least[at, None])
        begin, end = np.zeros(low.shape, np.int64), np.full(low.shape, len(self.ids))
        focus = a.focus[at]
        smallest, largest = self.unit.min(0), self.unit.max(0)
        cuts = (low > smallest[focus]) | (high < largest[focus])
        for coordinate in np.unique(focus[cuts]):
            _, values = self.sorted_list(int(coordinate))
            own = (focus == coordinate) & cuts
            begin[own] = np.searchsorted(values, low[own], "left")
            end[own] = np.searchsorted(values, high[own], "right")
        best = np.argmin(end - begin, axis=1)
        rows = np.arange(len(at))
        listed = (end - begin)[rows, best] < WORTH * len(self.ids)
        whole[at[~listed]] = True
        few = []
        for i in np.flatnonzero(listed):
            order, _ = self.sorted_list(int(focus[i, best[i]]))
            found = order[begin[i, best[i]] : end[i, best[i]]]
            for f in np.flatnonzero(cuts[i]):
                value = self.unit[found, focus[i, f]]
                found = found[(value >= low[i, f]) & (value <= high[i, f])]
            if len(found):
                few.append((int(at[i]), found))
        return np.flatnonzero(whole), few

    def hits(self, a: Anchors) -> Iterator[tuple[np.ndarray, ...]]:
        """``anchor, band, score, id`` of rows within the bands, in bounded pieces."""
        whole, few = self.candidates(a)
        step = max(1, _SCORES // len(self.ids))
        for at in range(0, len(whole), step):
            part = whole[at : at + step]
            score = _exact(a.vectors[part], self.vectors)
            fits = (score >= a.floor[part].min(1)[:, None]) & (score <= a.ceil[part].max(1)[:, None])
            fits &= (a.labels[part][:, None] == self.labels[None, :]) == a.same
            i, j = np.nonzero(fits)
            yield from _in_bands(a, part[i], score[i, j], self.ids[j])
        for i, rows in few:
            rows = rows[(self.labels[rows] == a.labels[i]) == a.same]
            score = _exact(a.vectors[i : i + 1], self.vectors[rows])[0]
            yield from _in_bands(a, np.full(len(rows), i), score, self.ids[rows])


def _feasible(own: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values that a coordinate of a unit vector can have at a cosine of ``least`` or more."""
    middle = own * least
    room = np.sqrt(np.maximum(0, 1 - least**2) * np.maximum(0, 1 - own**2)) + 1e-9
    return np.where(-own >= least, -1.0, middle - room) - 1e-9, np.where(own >= least, 1.0, middle + room) + 1e-9


def _in_bands(a: Anchors, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray):
    other = ids != a.ids[anchor]
    for band in range(a.floor.shape[1]):
        floor = a.floor[anchor, band]
        fits = other & (score <= a.ceil[anchor, band])
        fits &= (score > floor) | ((score == floor) & (ids <= a.before[anchor, band]))
        if fits.any():
            yield anchor[fits], np.full(int(fits.sum()), band), score[fits], ids[fits]


class Best:
    """The best rows of each anchor and band so far; raises the floors of the block."""

    def __init__(self, a: Anchors):
        self.a = a
        self.rows = tuple(np.zeros(0, np.int64) for _ in range(4))

    def add(self, found: list[tuple[np.ndarray, ...]]) -> None:
        anchor, band, score, ids = (np.concatenate([old, *new]) for old, new in zip(self.rows, zip(*found), strict=True))
        # Falling scores as rising numbers; ~ has no overflow.
        order = np.lexsort((ids, ~score, band, anchor))
        anchor, band, score, ids = anchor[order], band[order], score[order], ids[order]
        begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (band[1:] != band[:-1])]))
        rank = np.arange(len(anchor)) - np.repeat(begins, np.diff([*begins, len(anchor)]))
        kept = rank < self.a.keep
        self.rows = anchor[kept], band[kept], score[kept], ids[kept]
        full = rank == self.a.keep - 1
        self.a.floor[anchor[full], band[full]] = score[full]
        self.a.before[anchor[full], band[full]] = ids[full]


def _buckets(batch: pa.RecordBatch, size: int) -> Iterator[Bucket]:
    """The rows of a batch with vectors of ``size``, cut by length."""
    vectors = batch.column(2)
    own = batch.filter(pc.equal(pc.list_value_length(vectors), size))
    if not own.num_rows:
        return
    ids = own.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    labels = own.column(1).to_numpy(zero_copy_only=False)
    matrix = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    length, rows, begin = _length(matrix), max(16, ENTRIES // size), 0
    while begin < len(ids):
        end = min(begin + rows, len(ids))
        outside = (length[begin:end] < RATIO * length[begin]) | (length[begin:end] > length[begin] * (1 + 1e-9))
        if outside.any():
            end = begin + int(np.argmax(outside))
        yield Bucket(ids[begin:end], labels[begin:end], matrix[begin:end])
        begin = max(end, begin + 1)


def _best(rows: DataFrame, a: Anchors) -> DataFrame:
    """``anchor, band, score, id``: the best ``keep`` rows of each anchor and band."""
    shared, size, keep = rows.sparkSession.sparkContext.broadcast(a), a.vectors.shape[1], a.keep

    def search(batches):
        own = shared.value
        own = Anchors(own.ids, own.labels, own.vectors, own.floor.copy(), own.ceil, own.before.copy(), own.same, own.keep)
        best = Best(own)
        for batch in batches:
            for bucket in _buckets(batch, size):
                for found in bucket.hits(own):
                    best.add([found])
        yield dict(zip(("anchor", "band", "score", "id"), best.rows, strict=True))

    found = arrow_rows(rows.select("vec_id", "label", "vector"), "anchor long, band long, score long, id long", search)
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= keep)


def _raise_floors(found: DataFrame, a: Anchors) -> None:
    """Take the last of the wanted rows, where all are there, as what is needed at least.

    At most one row an anchor and band comes to the driver.
    """
    last = found.filter(F.col("rank") == a.keep).select("anchor", "band", "score", "id").toPandas()
    at = last["anchor"].to_numpy(int), last["band"].to_numpy(int)
    a.floor[at], a.before[at] = last["score"], last["id"]


def laid_out(rows: DataFrame) -> DataFrame:
    """The rows that take part, by falling length of their vectors; written."""
    vector = F.col("vector").cast("array<bigint>")
    own = rows.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), vector.alias("vector")).filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", F.isnull)
    )
    square = F.aggregate("vector", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    order = [F.size("vector").alias("size"), F.negative(square).alias("length"), "vec_id"]
    keyed = own.select(*order, "label", "vector")
    key = ["size", "length", "vec_id"]
    return written(keyed.repartitionByRange(*key).sortWithinPartitions(*key).drop("length"), "vectors")


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Of every anchor the best ``positives`` rows of its label, and for each the best
    ``negatives`` rows of other labels whose score is between ``low`` and ``high``
    hundredths of the positive's. Ties go by id.
    """
    laid = laid_out(rows)
    spark = laid.sparkSession
    anchors = laid.filter(is_anchor & F.col("vec_id").isNotNull()).distinct()
    sizes = [(r["size"], r["n"]) for r in anchors.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy("size").collect()]
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    parts = []
    for size, n in sizes:
        blocks = -(-n // ANCHORS)
        number = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks))
        own = written(anchors.filter(F.col("size") == size).withColumn("block", number), "anchors")
        alike = laid.filter(F.col("size") == size)
        for block in range(blocks):
            parts.append(_of_block(alike, own.filter(F.col("block") == block), size, positives, negatives, low, high))
    return spark.createDataFrame([], schema) if not parts else _united(parts)


def _united(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _of_block(alike, block, size, positives, negatives, low, high) -> DataFrame:
    """The result for one block of anchors, written."""
    table = block.select("vec_id", "label", "vector").toArrow()
    n = table.num_rows
    vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, size)
    ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))

    def limits(floor: np.ndarray, ceil: np.ndarray, same: bool, keep: int) -> Anchors:
        return Anchors(ids, labels, vectors, floor, ceil, np.full(floor.shape, _HIGH), same, keep)

    a = limits(np.full((n, 1), _LOW), np.full((n, 1), _HIGH), True, positives)
    _raise_floors(_best(block, a), a)
    found = _best(alike, a).select("anchor", F.col("rank").alias("band"), "score", "id").toPandas()
    # Bands of negatives; where a positive is lacking, nothing fits.
    score, positive = np.full((n, positives), -1), np.full((n, positives), _NO_ID)
    at = found["anchor"].to_numpy(int), found["band"].to_numpy(int) - 1
    score[at], positive[at] = found["score"], found["id"]
    least = np.array([[-(-(int(s) * low) // 100) for s in row] for row in score.tolist()], dtype=object).reshape(n, positives)
    most = np.array([[int(s) * high // 100 for s in row] for row in score.tolist()], dtype=object).reshape(n, positives)
    floor, ceil = (np.clip(x, _LOW, _HIGH).astype(np.int64) for x in (least, most))
    floor[score < 0], ceil[score < 0] = _HIGH, _LOW
    b = limits(floor, ceil, False, negatives)
    _raise_floors(_best(block, b), b)
    spark = block.sparkSession
    names = [
        (i, j, int(ids[i]), int(positive[i, j]), int(score[i, j])) for i, j in zip(*(x.tolist() for x in at), strict=True)
    ]
    known = spark.createDataFrame(names, "anchor long, band long, anchor_id long, positive_id long, positive_score long")
    near = _best(alike, b).withColumnRenamed("score", "negative_score")
    null = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    # As many rows as the block has anchors and positives.
    return written(
        near.join(F.broadcast(known), ["anchor", "band"]).select(
            "anchor_id", null("positive_id").alias("positive_id"), "rank", null("id").alias("negative_id"),
            "positive_score", "negative_score",
        ),
        "negatives",
    )
