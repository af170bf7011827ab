"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its hashed single words, neighbouring pairs and pairs
with one word between. Training runs in rounds: every partition of the
training rows follows the per-coordinate FTRL updates from the last common
state, and the states are merged by the mean over the partitions that touched
a coordinate. L1 leaves few weights other than zero; they fit a broadcast,
as there are at most ``2**BITS``.

Defined cases: a null or empty text has no features and gets the score of the
bias; rows with a null text, a null label or a null id teach nothing; repeated
rows count as often as they occur; an empty table gives an empty result;
without any training row every score is 0. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import arrow_rows, sampled, text_words

BITS = 18
# At most about so many labelled rows teach; the sample goes by hashes of the ids.
MAX_ROWS = 20_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.0
# Toxic rows are the few; each counts as so many.
TOXIC_WEIGHT = 1.5
ROUNDS = 3
PASSES = 2
CUT = 0.7
PARTS = 6

_WORDS_CACHED = 500_000
_EDGE = b".,;:!?\"'()[]"


class WordHashes(dict):
    """Hashes of words without their edge punctuation; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.strip(_EDGE), 7)
        return value


def coordinates(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Coordinates of all words, pairs and skip-pairs of a text, repeats included."""
    h = np.array([hashes[w] for w in text_words(text)], dtype=np.uint64)
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    skips = (h[:-2] + np.uint64(11)) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    mixed = np.concatenate([h, pairs, skips])
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct coordinates of a text."""
    return np.unique(coordinates(text, hashes))


def total(text: str | None, w: np.ndarray, hashes: WordHashes) -> float:
    """Sum of the weights of a text's features; only those other than zero are sorted."""
    at = coordinates(text, hashes)
    return float(w[np.unique(at[w[at] != 0])].sum())


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that a state stands for."""
    rate = (BETA + np.sqrt(n)) / ALPHA + L2
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / rate)


def follow(z: np.ndarray, n: np.ndarray, xs: list[np.ndarray], ys: list[int]) -> None:
    """One pass of updates in place; the last coordinate is the bias."""
    bias = np.array([len(z) - 1])
    for x, y in zip(xs, ys, strict=True):
        at = np.concatenate([x, bias])
        w = weights(z[at], n[at])
        w[-1] = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA + L2)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        g *= TOXIC_WEIGHT if y else 1.0
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g


def train(rows: DataFrame, rounds: int = ROUNDS) -> dict[int, float]:
    """Weights other than zero by coordinate, learnt from ``text, label``."""
    rows = rows.repartition(PARTS, F.xxhash64("text"))
    spark, size = rows.sparkSession, (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    for turn in range(rounds):
        start = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))

        def learn(batches, start=start, turn=turn):
            z0, n0 = (a.astype(np.float64) for a in start.value)
            z1, n1, hashes = z0.copy(), n0.copy(), WordHashes()
            for batch in batches:
                labels = batch.column(1).to_pylist()
                xs = [features(t, hashes) for t in batch.column(0).to_pylist()]
                for turn_order in range(PASSES):
                    order = np.random.default_rng([turn, turn_order]).permutation(len(xs))
                    follow(z1, n1, [xs[i] for i in order], [labels[i] for i in order])
            touched = np.flatnonzero(n1 != n0)
            yield {"at": touched, "dz": (z1 - z0)[touched], "dn": (n1 - n0)[touched]}

        parts = arrow_rows(rows, "at bigint, dz double, dn double", learn)
        merged = parts.groupBy("at").agg(F.avg("dz").alias("dz"), F.avg("dn").alias("dn")).toPandas()
        z[merged["at"]] += merged["dz"]
        n[merged["at"]] += merged["dn"]
    w = weights(z, n)
    w[-1] = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA + L2) if n[-1] else -1000.0
    return {int(i): float(w[i]) for i in np.flatnonzero(w)}


def scorer(spark, model: dict[int, float]):
    """A function from a text column to its score from 0 to 1."""
    shared = spark.sparkContext.broadcast(
        (np.array(list(model), dtype=np.int64), np.array(list(model.values())))
    )
    dense: list[np.ndarray] = []
    hashes = WordHashes()

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not dense:
            w = np.zeros((1 << BITS) + 1)
            w[shared.value[0]] = shared.value[1]
            dense.append(w)
        w = dense[0]
        sums = np.array([total(t, w, hashes) for t in texts]) + w[-1]
        with np.errstate(over="ignore"):
            return pd.Series(1 / (1 + np.exp(-np.minimum(sums, 35))))

    return score


def training_rows(
    docs: DataFrame, labels: DataFrame, teaches: Callable[[str], Column], max_rows: int = MAX_ROWS
) -> DataFrame:
    """``text, label`` of the labelled documents that may teach, ``max_rows`` ids at most.

    An id that has several labels teaches if they agree. The sample is taken
    on the labels, so only its texts move; as it is bounded, it is broadcast.
    """
    usable = (
        labels.filter("doc_id is not null").filter(teaches("doc_id"))
        .groupBy("doc_id").agg(F.min("toxic").alias("label"), F.max("toxic").alias("most"))
        .filter("label = most and label in (0, 1)")
    )
    chosen = sampled(usable, "doc_id", max_rows).select(
        F.col("doc_id").alias("key"), F.col("label").cast("int").alias("label")
    )
    own = docs.filter("text is not null").select(F.col("doc_id").alias("key"), "text")
    return own.join(F.broadcast(chosen), "key").select("text", "label")
