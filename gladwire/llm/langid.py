"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An
n-gram is bound by multiplying the vectors of its letters, each rotated by its
distance from the last one; a text bundles (adds) its n-grams. The prototype
of a language is the sum of the unit vectors of its training texts, and a text
goes to the prototype with the largest cosine, the first by name among equals.

A run of characters that are not letters counts as one space, which is a
symbol too; case is ignored. Defined cases: a text that is null or has no
letter is ``und`` with score 0; rows with a null language or such a text teach
nothing; without a prototype, as for an empty table, every text is ``und``; repeated rows count as
often as they occur; beyond the ``MAX_LANGUAGES`` most frequent, language values teach nothing; only the columns
``text`` and ``lang`` are looked at. Texts are read whole, in blocks of bounded size, and the trigrams of a
block in chunks, so alphabets of any size fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import arrow_rows

DIM = 1024
SEED = 20240607
# Texts are bundled in blocks of so many characters and texts, or one text alone.
BLOCK, BLOCK_TEXTS = 400_000, 1024
# Trigrams whose vectors are held at a time, and their occurrences where these are few.
KINDS, CELLS = 4096, 4096
# Vectors of the training texts are rounded to this grain: sums are exact in any order.
GRAIN = 1 << 20
# More language values than this are junk, and would not fit a broadcast.
MAX_LANGUAGES = 5_000
UNKNOWN = "und"


class Letters:
    """Numbers and vectors of the letters met so far; 0 is the space."""

    def __init__(self, dim: int = DIM):
        self.dim = dim
        self.number = np.full(0x110000, -1, dtype=np.int32)
        self.by_letter: dict[str, int] = {" ": 0}
        self.vectors = np.zeros((64, dim), dtype=np.int8)
        self._add(" ")

    def _add(self, letter: str) -> None:
        at = self.by_letter[letter]
        if at >= len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        self.vectors[at] = np.random.default_rng([SEED, ord(letter)]).integers(0, 2, self.dim) * 2 - 1

    def rotated(self, ids: np.ndarray, turn: int) -> np.ndarray:
        """The vectors of some letters, rotated."""
        return np.roll(self.vectors[ids], turn, axis=1)

    def numbers(self, points: np.ndarray) -> np.ndarray:
        """The letter number of each code point."""
        got = self.number[points]
        if (got < 0).any():
            for point in np.unique(points[got < 0]):
                letter = chr(point).lower()[0] if chr(point).isalpha() else " "
                if letter not in self.by_letter:
                    self.by_letter[letter] = len(self.by_letter)
                    self._add(letter)
                self.number[point] = self.by_letter[letter]
            got = self.number[points]
        return got


def bundle(texts: list[str], letters: Letters) -> np.ndarray:
    """One vector per text: the sum of its bound trigrams."""
    joined = "".join(f" {t} " for t in texts)
    ids = letters.numbers(np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32))
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    keep = np.ones(len(ids), dtype=bool)
    keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0) | (owner[1:] != owner[:-1])
    ids, owner = ids[keep].astype(np.int64), owner[keep]
    inside = owner[2:] == owner[:-2]
    base = len(letters.by_letter)
    code = ((ids[:-2] * base + ids[1:-1]) * base + ids[2:])[inside]
    kinds, which = np.unique(code, return_inverse=True)
    cells, counts = np.unique(owner[2:][inside] * max(len(kinds), 1) + which, return_counts=True)
    text, kind = np.divmod(cells, max(len(kinds), 1))
    out = np.zeros((len(texts), letters.dim), dtype=np.float32)
    for at in range(0, len(kinds), KINDS):
        own = kinds[at : at + KINDS]
        bound = letters.rotated(own // base**2, 2) * letters.rotated(own // base % base, 1) * letters.rotated(own % base, 0)
        chosen = (kind >= at) & (kind < at + KINDS)
        _add_bundles(out, text[chosen], kind[chosen] - at, counts[chosen], bound.astype(np.float32))
    return out


def _add_bundles(out: np.ndarray, text: np.ndarray, kind: np.ndarray, counts: np.ndarray, bound: np.ndarray) -> None:
    """Add ``counts`` times the vector of ``kind`` to the row of ``text``; rows come in order. All sums are exact."""
    if len(text) * 16 > len(out) * len(bound):
        table = np.zeros((len(out), len(bound)), dtype=np.float32)
        table[text, kind] = counts
        out += table @ bound
        return
    for at in range(0, len(text), CELLS):
        rows = text[at : at + CELLS]
        begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        vectors = bound[kind[at : at + CELLS]] * counts[at : at + CELLS, None].astype(np.float32)
        out[rows[begins]] += np.add.reduceat(vectors, begins, axis=0)


def blocks(texts: list[str | None], size: int = BLOCK) -> Iterator[list[int]]:
    """Places of the texts that have a letter, in blocks of bounded length."""
    block, length = [], 0
    for place, text in enumerate(texts):
        if text and any(map(str.isalpha, text)):
            if block and (length + len(text) > size or len(block) == BLOCK_TEXTS):
                yield block
                block, length = [], 0
            block.append(place)
            length += len(text)
    if block:
        yield block


def unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(size > 0, size, 1)


def train(rows: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes, unit length, by language, from columns ``text`` and ``lang``."""

    def add(batches):
        letters, sums = Letters(), {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block in blocks(texts):
                vectors = np.rint(unit(bundle([texts[i] for i in block], letters)) * GRAIN)
                for place, vector in zip(block, vectors.astype(np.int64), strict=True):
                    sums[langs[place]] = sums.get(langs[place], 0) + vector
        yield {"lang": list(sums), "sums": [v.tolist() for v in sums.values()]}

    named = rows.filter("lang is not null and text is not null").select("text", "lang")
    counted = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    named = named.join(F.broadcast(counted.limit(MAX_LANGUAGES).select("lang")), "lang", "left_semi").select("text", "lang")
    parts = arrow_rows(named, "lang string, sums array<bigint>", add)
    cells = parts.select("lang", F.posexplode("sums").alias("at", "v"))
    total = cells.groupBy("lang", "at").agg(F.sum("v").alias("v")).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("at", "v"))).alias("sums")
    )
    # One vector a language comes to the driver.
    found = total.select("lang", F.transform("sums", lambda s: s["v"].cast("double")).alias("sums")).toPandas()
    return {lang: unit(np.array([own], dtype=np.float64))[0] for lang, own in zip(found["lang"], found["sums"], strict=True)}


def predictor(spark, prototypes: dict[str, np.ndarray]):
    """A function from a text column to a struct of ``lang`` and ``score``."""
    names = sorted(prototypes)
    stacked = np.array([prototypes[n] for n in names], dtype=np.float32).reshape(-1, DIM)
    shared = spark.sparkContext.broadcast((names, stacked))
    letters: list[Letters] = []

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if not letters:
            letters.append(Letters())
        known, matrix = shared.value
        given = texts.tolist()
        lang, score = [UNKNOWN] * len(given), [0.0] * len(given)
        for block in blocks(given) if known else ():
            near = unit(bundle([given[i] for i in block], letters[0])) @ matrix.T
            best = near.argmax(axis=1)
            for place, at, value in zip(block, best, near.max(axis=1), strict=True):
                lang[place], score[place] = known[at], float(min(1.0, max(0.0, value)))
        return pd.DataFrame({"lang": lang, "score": score})

    return predict
