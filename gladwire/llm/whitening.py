"""Whitening of embeddings by a distributed Jacobi-Davidson eigensolver.

The covariance is never formed. Vectors are packed into blocks once, and a product
of the covariance with a few vectors is one pass over them: every task
centres its blocks, multiplies twice and gives a small partial sum. Sums of the entries
are exact integers, and an entry is centred by its exact integer distance from the whole part
of the mean, so a large common offset costs no digits.

The driver keeps the search space (at most ``SPACE`` times as many vectors as components are
wanted). Rayleigh-Ritz takes the best pairs from it; leading pairs whose residual reached
double precision are locked; for the others the projected correction equations are solved
by a few steps of MINRES, all at the same time, so a step costs one pass whatever the number of
pairs. Their solutions widen the space, which is cut back to its best vectors when it is full. At the end the
locked vectors are multiplied once more, and their residuals tell whether more rounds are needed.

Rows: ``vec_id, vector`` with integers. Defined cases: null vectors, vectors with a null entry and
empty ones take no part; of vectors of several lengths the most frequent length counts (then
the longer one); entries beyond 2^52 end there; repeated rows and null ids are rows as others; an
empty table gives an empty result; directions without spread (eigenvalue at rounding level) are no
components, so equal vectors have none; a deviation beyond a long is null; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import arrow_rows, written

COMPONENTS = 32
SPACE, INNER, ROUNDS = 3, 6, 60
# Entries of a block: one megabyte of them.
ENTRIES = 1 << 17
# Residuals, as a share of the largest eigenvalue.
RESIDUAL = 2e-15
_SPLIT, _MOST = 26, 1 << 52


@dataclass
class Whitening:
    """Components as columns, and what they explain of the whole variance."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    residuals: np.ndarray
    passes: int

    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def packed(rows: DataFrame) -> tuple[DataFrame, int]:
    """Blocks ``ids, x`` of the vectors that take part, written, and their length (0 without any)."""
    entry = lambda x: F.greatest(F.least(x.cast("bigint"), F.lit(_MOST)), F.lit(-_MOST))
    full = rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", F.isnull))
    own = full.select(F.col("vec_id").cast("bigint"), F.transform("vector", entry).alias("x"))
    sizes = own.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    size = found[0]["size"] if found else 0
    step = max(1, ENTRIES // max(size, 1))

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i8")
                yield {"ids": [part.column(0)], "x": [x.tobytes()]}

    return written(arrow_rows(own.filter(F.size("x") == size), "ids array<bigint>, x binary", pack), "vectors"), size


class Covariance:
    """Passes over the packed vectors."""

    def __init__(self, blocks: DataFrame, size: int):
        self.blocks, self.size, self.passes = blocks, size, 0
        self.n, self.whole, self.rest = self._mean()

    def _summed(self, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
        """The sum over all blocks of what ``work`` makes of one; a task sums before it hands on."""
        size, dtype = self.size, {"double": np.float64, "bigint": np.int64}[kind]

        def partial(batches):
            total = None
            for batch in batches:
                for x in batch.column(0):
                    block = work(np.frombuffer(x.as_buffer(), "<i8").reshape(-1, size)).ravel()
                    total = block if total is None else total + block
            if total is not None:
                yield {"cell": np.arange(len(total)), "value": total.astype(dtype)}

        cells = arrow_rows(self.blocks.select("x"), f"cell bigint, value {kind}", partial)
        summed = cells.groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
        self.passes += 1
        return summed.sort_values("cell")["value"].to_numpy(dtype)

    def _mean(self) -> tuple[int, np.ndarray, np.ndarray]:
        """Rows, and the whole and the broken part of the mean of each entry, from exact sums."""
        low = (1 << _SPLIT) - 1

        def sums(x: np.ndarray) -> np.ndarray:
            return np.concatenate([(x >> _SPLIT).sum(0), (x & low).sum(0), [len(x)]])

        found = self._summed(sums, "bigint").tolist()
        if not found:
            return 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        n, size = found[-1], self.size
        parts = [divmod((found[i] << _SPLIT) + found[size + i], n) for i in range(size)]
        return n, *(np.array(p, np.int64) for p in zip(*parts, strict=True))

    def _centred(self) -> Callable[[np.ndarray], np.ndarray]:
        whole, rest = self.whole, self.rest / self.n
        return lambda x: (x - whole).astype(np.float64) - rest

    def trace(self) -> float:
        centred = self._centred()
        return float(self._summed(lambda x: np.array([(centred(x) ** 2).sum()]))[0]) / self.n

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times the columns: one pass, whatever their number."""
        centred, own = self._centred(), np.ascontiguousarray(vectors)

        def multiply(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ own)

        return self._summed(multiply).reshape(own.shape) / self.n

    def spread(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance of the projections on the columns, from the projections themselves."""
        centred, k = self._centred(), vectors.shape[1]

        def moments(x: np.ndarray) -> np.ndarray:
            z = centred(x) @ vectors
            return np.concatenate([(z.T @ z).ravel(), z.sum(0)])

        found = self._summed(moments) / self.n
        mean = found[k * k :]
        return found[: k * k].reshape(k, k) - np.outer(mean, mean)


def _orthonormal(new: np.ndarray, *old: np.ndarray) -> np.ndarray:
    """Columns that add to the orthonormal ones in ``old``; what lies in their span is left out."""
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(2):
            for base in old:
                column = column - base @ (base.T @ column)
            for base in kept:
                column = column - base * (base @ column)
            size = np.linalg.norm(column)
            if size < 1e-7:
                break
            column = column / size
        else:
            kept.append(column)
    return np.array(kept).T.reshape(len(new), len(kept))


def corrections(product, shifts: np.ndarray, ritz: np.ndarray, residuals: np.ndarray, locked: np.ndarray, steps: int):
    """MINRES for the projected correction equations of all pairs together.

    Every pair has its own equation, with the covariance shifted by its value and projected off
    its vector and the locked ones; they share the product of a step.
    """

    def off(t: np.ndarray) -> np.ndarray:
        t = t - ritz * (ritz * t).sum(0)
        return t - locked @ (locked.T @ t)

    def safe(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x, 1)

    v, old = off(-residuals), np.zeros_like(residuals)
    gamma = np.linalg.norm(v, axis=0)
    eta, k = gamma.copy(), len(gamma)
    c_old, c, s_old, s = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    w_old, w, found = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    for _ in range(steps):
        v = v / safe(gamma)
        image = off(product(v) - v * shifts)
        delta = (image * v).sum(0)
        following = image - delta * v - gamma * old
        gamma_new = np.linalg.norm(following, axis=0)
        a0 = c * delta - c_old * s * gamma
        a1 = np.hypot(a0, gamma_new)
        a2, a3 = s * delta + c_old * c * gamma, s_old * gamma
        c_old, c, s_old, s = c, a0 / safe(a1), s, gamma_new / safe(a1)
        w_old, w = w, (v - a3 * w_old - a2 * w) / safe(a1)
        found = found + c * eta * w
        eta = -s * eta
        old, v, gamma = v, following, gamma_new
    return off(found)


def largest_pairs(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int):
    """``values, vectors, residuals`` of the largest eigenpairs of a symmetric operator, by Jacobi-Davidson.

    ``product`` multiplies it with the columns of a matrix. Residuals come from one last
    product with the vectors that are returned.
    """
    wanted = min(wanted, size)
    space = _orthonormal(np.random.default_rng(11).normal(size=(size, wanted)))
    images = product(space)
    locked = np.zeros((size, 0))
    scale = bar = 0.0
    for round_ in range(ROUNDS):
        inner = space.T @ images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        turn = turn[:, ::-1]
        values, space, images = values[::-1], space @ turn, images @ turn
        scale = max(scale, float(np.abs(values).max(initial=0)))
        open_ = wanted - locked.shape[1]
        residuals = images[:, :open_] - space[:, :open_] * values[:open_]
        residuals -= locked @ (locked.T @ residuals)
        # Sums of many products are rounded; the bar rises slowly if the rounding stands above it.
        bar = scale * RESIDUAL * size**0.5 * 2 ** max(0, (round_ - 10) / 5)
        done = np.linalg.norm(residuals, axis=0) <= bar
        leading = open_ if space.shape[1] + locked.shape[1] >= size else int(np.argmin([*done, False]))
        locked = np.hstack([locked, space[:, :leading]])
        space, images = space[:, leading:], images[:, leading:]
        if locked.shape[1] >= wanted:
            break
        open_, residuals, done = open_ - leading, residuals[:, leading:], done[leading:]
        shifts, ritz = values[leading : leading + open_][~done], space[:, :open_][:, ~done]
        new = corrections(product, shifts, ritz, residuals[:, ~done], locked, INNER)
        room = max(SPACE * wanted, 8) - locked.shape[1]
        if space.shape[1] + new.shape[1] > room:
            keep = max(open_, room - new.shape[1])
            space, images = space[:, :keep], images[:, :keep]
        new = _orthonormal(new, locked, space)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(round_).normal(size=(size, 1)), locked, space)
        space, images = np.hstack([space, new]), np.hstack([images, product(new)])
    locked, _ = np.linalg.qr(np.hstack([locked, space[:, : wanted - locked.shape[1]]]))
    images = product(locked)
    inner = locked.T @ images
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, vectors, images = values[::-1], locked @ turn[:, ::-1], images @ turn[:, ::-1]
    return values, vectors, np.linalg.norm(images - vectors * values, axis=0)


def fit(blocks: DataFrame, size: int, components: int = COMPONENTS) -> tuple[Whitening, Covariance]:
    """The components of packed vectors."""
    covariance = Covariance(blocks, size)
    if not covariance.n:
        empty = np.zeros(0)
        return Whitening(0, covariance.whole, covariance.rest, empty, np.zeros((size, 0)), empty, empty, 1), covariance
    trace = covariance.trace()
    values, vectors, residuals = largest_pairs(covariance.product, size, components)
    spread = values > max(values[0], 0) * 64 * size * np.finfo(float).eps
    values, vectors, residuals = values[spread], vectors[:, spread], residuals[spread]
    return Whitening(
        covariance.n, covariance.whole, covariance.rest, values, vectors, values / trace if trace else values,
        residuals, covariance.passes,
    ), covariance


def identity_error(covariance: Covariance, model: Whitening) -> float:
    """The largest entry by which the covariance of the whitened rows differs from the identity."""
    if not len(model.values):
        return 0.0
    return float(np.abs(covariance.spread(model.scaled()) - np.eye(len(model.values))).max())


def apply(blocks: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` of every packed vector: one value for each component.

    ``deviation`` is the sum over the entries of (n times the entry, less the entry's sum) squared, exact.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def transform(batches):
        m = shared.value
        scaled, size, rest = m.scaled(), len(m.whole), m.rest / max(m.n, 1)
        for batch in batches:
            for ids, x in zip(batch.column(0), batch.column(1), strict=True):
                apart = np.frombuffer(x.as_buffer(), "<i8").reshape(-1, size) - m.whole
                z = (apart.astype(np.float64) - rest) @ scaled
                offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
                yield {
                    "vec_id": ids.values, "deviation": _deviation(apart, m.n, m.rest),
                    "whitened": pa.ListArray.from_arrays(offsets, pa.array(z.ravel())),
                }

    return arrow_rows(blocks, "vec_id bigint, deviation bigint, whitened array<double>", transform)


def _deviation(apart: np.ndarray, n: int, rest: np.ndarray) -> list | np.ndarray:
    largest = (int(np.abs(apart).max(initial=0)) + 1) * n
    if largest**2 * apart.shape[1] < 1 << 62:
        return ((apart * n - rest) ** 2).sum(1)
    exact = ((apart.astype(object) * n - rest.astype(object)) ** 2).sum(1).tolist()
    return [int(v) if v < 1 << 63 else None for v in exact]
