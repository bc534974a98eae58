"""Whitening on the leading principal components, by Chebyshev-filtered subspace iteration.

The covariance V of all vectors is never formed. A block Q of a few columns is
multiplied by it in passes over the vectors: every task sums XᵀXQ of its centred
rows, and the sums are added up group by group. A filter of m such passes is a
Chebyshev polynomial of V by its three-term recurrence, small on the interval of
the unwanted eigenvalues and growing steeply above it. Then QR, and Rayleigh-Ritz
on the projection of V, until the residuals ‖Vq - eq‖ certify the wanted pairs.

The interval's upper end is the block's least Ritz value. Its lower end comes
from a Lanczos vector that rides along with the first filter's passes. Vectors are
packed once into blocks of about ``BLOCK_VALUES`` numbers, which all passes read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.llm.common import keep, release

#: An entry c becomes floor(SCALE * c). A constant added to all entries of a dimension
#: changes neither the covariance nor a deviation, so none is.
SCALE = 1024
COMPONENTS = 8
#: Columns of the block beside the wanted ones, and the polynomial's degree.
GUARD, DEGREE = 24, 10
#: A pair is certified when its residual is at most so much of the largest eigenvalue.
TOLERANCE = 1e-13
MAX_PASSES = 2_000
#: Eigenvalues up to this share of the largest are zero: their components cannot be whitened.
ZERO = 1e-10
BLOCK_VALUES = 1 << 20
#: Sums of tasks that one task, or the driver, adds up.
FAN_IN = 32
#: Entries beyond, with which the numbers would not fit 64 bits, count as not finite.
LIMIT = float(1 << 50)


@dataclass
class Fit:
    """``n`` vectors, their exact sums per dimension, the eigenvalues by falling
    size, unit eigenvectors as columns, V's trace, passes over the data."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int


def _blocks(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """Rows of many vectors each (``ids``, ``data``: their numbers), and the vectors' length."""
    whole = F.forall(column, lambda c: c.isNotNull() & (F.abs(c) < F.lit(LIMIT)) & ~F.isnan(c))
    kept = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{column}`").alias(column)).where(F.col(column).isNotNull() & (F.size(column) > 0) & whole)
    sizes = kept.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    d = sizes[0].d if sizes else 0
    kind = np.float64 if isinstance(vectors.schema[column].dataType.elementType, T.DoubleType) else np.float32
    if kind is np.float32 and not isinstance(vectors.schema[column].dataType.elementType, T.FloatType):
        kept, kind = kept.withColumn(column, F.col(column).cast("array<double>")), np.float64
    rows = max(1, BLOCK_VALUES // max(1, d))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            both = pa.Table.from_batches(waiting).combine_chunks()
            ids = both.column(0).combine_chunks()
            data = np.ascontiguousarray(both.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False), kind)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([data.tobytes()], pa.binary())], names=["ids", "data"])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, rows - sum(b.num_rows for b in waiting))
                waiting.append(part)
                batch = batch.slice(part.num_rows)
                if sum(b.num_rows for b in waiting) == rows:
                    yield block()
        if waiting:
            yield block()

    packed = kept.where(F.size(column) == d).mapInArrow(pack, "ids array<long>, data binary")
    return keep(packed.withColumn("wide", F.lit(kind is np.float64)), "vectors"), d


def _numbers(data: bytes, d: int, wide: bool) -> np.ndarray:
    """floor(SCALE * c) of a block, whole numbers, a row a vector."""
    raw = np.frombuffer(data, np.float64 if wide else np.float32).astype(np.float64)
    return np.floor(SCALE * raw).astype(np.int64).reshape(-1, d)


def _each(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Scalar, np.ndarray]]:
    for batch in batches:
        ids, data, wide = (batch.column(i) for i in range(3))
        for i in range(batch.num_rows):
            yield ids[i].values, _numbers(data[i].as_py(), d, wide[i].as_py())


def _exact(parts: np.ndarray) -> list[int]:
    """Column sums that cannot overflow."""
    most = int(np.abs(parts).max(initial=0))
    if most * max(1, len(parts)) < 1 << 62:
        return parts.sum(axis=0).tolist()
    return parts.astype(object).sum(axis=0).tolist()


def _moments(blocks: DataFrame, d: int) -> tuple[int, list[int], float]:
    """n, the exact sums and V's trace."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, [0] * d, [0] * d
        for _, x in _each(batches, d):
            n += len(x)
            sums = [a + b for a, b in zip(sums, _exact(x))]
            small = int(np.abs(x).max(initial=0)) < 1 << 31
            squares = [a + b for a, b in zip(squares, _exact(x * x if small else x.astype(object) ** 2))]
        if n:
            number = lambda v: pa.array([Decimal(i) for i in v], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), number(sums), number(squares)], names=["at", "n", "total", "square"])

    parts = blocks.mapInArrow(count, "at int, n long, total decimal(38,0), square decimal(38,0)")
    rows = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square")).collect()
    if not rows:
        return 0, [], 0.0
    n = rows[0].n
    sums = {r["at"]: int(r.total) for r in rows}
    trace = sum((n * int(r.square) - sums[r["at"]] ** 2 for r in rows), 0)
    return n, [sums[i] for i in range(d)], float(Fraction(trace, n * n))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less its mean: the mean's whole part off exactly, then the rest."""
    whole = [s // n for s in sums]
    rest = np.array([float(Fraction(s - n * w, n)) for s, w in zip(sums, whole)])
    return (x - np.array(whole, np.int64)).astype(np.float64) - rest


def _summed(blocks: DataFrame, d: int, product: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``product`` over all blocks: a part a task, ``FAN_IN`` parts added up
    by a task in each of the further rounds, until at most that many come to the driver."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape), False
        for _, x in _each(batches, d):
            total += product(x)
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(shape)
        for raw in parts.sort_values("part")["total"]:
            total += np.frombuffer(raw).reshape(shape)
        return pd.DataFrame({"part": [parts["part"].min()], "total": [total.tobytes()]})

    sums = blocks.mapInArrow(part, "part int, total binary")
    parts = blocks.rdd.getNumPartitions()
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        sums = sums.groupBy((F.col("part") % parts).alias("lane")).applyInPandas(add, "part int, total binary")
    return sum((np.frombuffer(r.total).reshape(shape) for r in sorted(sums.collect(), key=lambda r: r.part)), np.zeros(shape))


def _fit(blocks: DataFrame, d: int, wanted: int) -> Fit:
    n, sums, trace = _moments(blocks, d)
    if not n or trace <= 0:
        return Fit(n, sums, np.zeros(0), np.zeros((d, 0)), trace, 1)
    passes = 1

    def times(q: np.ndarray) -> np.ndarray:
        """V q, by one pass over the vectors."""
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums)
            return c.T @ (c @ q)

        return _summed(blocks, d, product, q.shape) / n

    wanted = min(wanted, d)
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((d, min(d, wanted + GUARD))))
    ride = rng.standard_normal(d)
    ride /= np.linalg.norm(ride)
    low = None
    while True:
        y = times(q)
        projected = q.T @ y
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, y = q @ turn, y @ turn
        residual = np.linalg.norm(y - q * values, axis=0)[:wanted]
        if residual.max() <= TOLERANCE * values[0] or q.shape[1] == d:
            return Fit(n, sums, values[:wanted], q[:, :wanted], trace, passes)
        if passes > MAX_PASSES:
            raise RuntimeError(f"residual {residual.max() / values[0]:.1e} after {passes} passes: raise GUARD, or take fewer components")
        if low is None:
            q, low = _filtered(times, q, values, 0.0, ride)
        else:
            q, _ = _filtered(times, q, values, low, None)
        q, _ = np.linalg.qr(q)


def _filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, values: np.ndarray, low: float, ride: np.ndarray | None) -> tuple[np.ndarray, float]:
    """The Chebyshev polynomial of V, small between ``low`` and the least of
    ``values``, applied to ``q``; scaled to be 1 at the largest value. With ``ride``,
    a Lanczos run begun there gives a lower bound of V's spectrum."""
    high = max(float(values[-1]), low + 1e-9 * float(values[0]))
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (float(values[0]) - middle)
    alpha, beta, lanczos = [], [], [] if ride is None else [ride]

    def step(block: np.ndarray) -> np.ndarray:
        if not lanczos:
            return times(block)
        both = times(np.column_stack([block, lanczos[-1]]))
        v, w = lanczos[-1], both[:, -1]
        alpha.append(float(v @ w))
        for u in lanczos:  # all earlier ones, twice, to stay orthogonal
            w = w - u * (u @ w)
        for u in lanczos:
            w = w - u * (u @ w)
        beta.append(float(np.linalg.norm(w)))
        lanczos.append(w / beta[-1] if beta[-1] > 1e-9 * values[0] else np.zeros_like(w))
        return both[:, :-1]

    before, now = q, (step(q) - middle * q) * (first / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (step(now) - middle * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    if ride is None:
        return now, low
    steps = next((i + 1 for i, b in enumerate(beta) if b <= 1e-9 * values[0]), len(beta))
    ritz = np.linalg.eigvalsh(np.diag(alpha[:steps]) + np.diag(beta[: steps - 1], 1) + np.diag(beta[: steps - 1], -1))
    return now, max(0.0, float(ritz[0]) - beta[steps - 1])


def _leading(blocks: DataFrame, d: int, components: int) -> Fit:
    """The fit without components of no variance."""
    fit = _fit(blocks, d, components)
    some = fit.values > ZERO * (fit.values[0] if len(fit.values) else 1)
    return Fit(fit.n, fit.sums, fit.values[some], fit.vectors[:, some], fit.trace, fit.passes)


def principal_components(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Fit:
    """The leading eigenpairs of the covariance of the scaled vectors (see ``whiten``)."""
    blocks, d = _blocks(vectors.withColumn("_none", F.lit(None).cast("long")), "_none", column)
    fit = _leading(blocks, d, components)
    release(blocks)
    return fit


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Per row the sum of (n x - S)² over the dimensions; null beyond 64 bits."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    off = x - whole
    most = n * (int(np.abs(off).max(initial=0)) + 1)
    if most * most * x.shape[1] < 1 << 63:
        return pa.array((np.square(n * off - rest)).sum(axis=1))
    exact = ((n * off.astype(object) - rest) ** 2).sum(axis=1)
    return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: ``vec_id``, ``component`` (from 1, by falling
    eigenvalue), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    An entry c counts as x = floor(1024 c), whatever constant is added to all. ``n`` vectors make up the covariance;
    ``deviation`` is the sum over the dimensions of (n x - S)², S being the sums of
    all vectors (null where it is beyond 64 bits); ``whitened`` is x - S / n
    projected on the component, over the eigenvalue's square root; ``explained`` the
    eigenvalue's share of the trace; ``identity_error`` the largest absolute entry of
    the covariance of all whitened rows less the identity, measured by a pass of its own.

    Null vectors and those with null or non-finite entries (or beyond 2**50) have no
    rows; neither have vectors of another length than most (of tied lengths, the
    greatest counts). Repeated rows and ids count and come out as often as they
    occur, a null id stays null. Components without variance are left out, so an
    empty table, empty vectors and equal vectors give no rows. Equal eigenvalues take
    any basis of their space. Other columns are ignored.
    """
    blocks, d = _blocks(vectors, key, column)
    fit = _leading(blocks, d, components)
    k, n, sums = len(fit.values), fit.n, fit.sums
    scale = fit.vectors / np.sqrt(fit.values)
    error = 0.0
    if k:

        def product(x: np.ndarray) -> np.ndarray:
            w = _centred(x, n, sums) @ scale
            return np.vstack([w.T @ w, w.sum(axis=0)])

        found = _summed(blocks, d, product, (k + 1, k)) / n
        error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    explained = fit.values / fit.trace if k else fit.values

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _each(batches, d) if k else ():
            for a in range(0, len(x), 8192):
                part = x[a : a + 8192]
                m = len(part)
                each = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    ids.slice(a, m).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    _deviations(part, n, sums).take(each),
                    pa.array((_centred(part, n, sums) @ scale).reshape(-1)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(rows, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
