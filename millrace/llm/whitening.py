"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The rows are those of a centred matrix A. From a unit vector v1 on, steps alternate u = A v and v = Aᵀ u, each made
orthogonal to all vectors before it, so that A V = U B with a small (all but bidiagonal) B; its singular values and right
singular vectors, turned by V, are the components of the rows and their deviations. Steps end when the wanted ones have
settled, or when V spans the whole space.

A and U are never held: the distinct vectors lie in a written table, in blocks, and each step is one pass over it. A task
centres its block (exactly, in integers), finds its part of U again from V and B, makes u, and returns only sums whose
sizes follow the dimension: Uᵀu, Aᵀu and |u|². Nothing is lost with an executor. The coefficients of u from the step before
come from the recurrence; Uᵀu, found in the same pass as Aᵀu, is what is left to take off, and is taken off both.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import named, whole_row
from millrace.llm.tables import written

#: Components that are returned, at most.
COMPONENTS = 16
#: Entries are counted in steps of 1 / SCALE, from -OFFSET on.
SCALE, OFFSET = 64, 1_000_000
#: Counted entries lie below this in size, so that they and their differences are exact doubles.
LARGEST = 1 << 52
#: Distinct vectors in a block, and bytes in a block at most.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
#: A direction whose deviation is below this share of the largest one is taken for rounding; so is a residual.
NOTHING, SETTLED = 1e-11, 1e-14


class Whitening(NamedTuple):
    """``components`` are columns; ``variances`` their eigenvalues, falling; ``total`` the trace; ``sums`` the exact sums of the
    ``n`` distinct vectors."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float
    steps: int


# ---- counted vectors ---------------------------------------------------------------------------------


def _counted(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that can be counted, and a matrix of their entries in whole steps."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    c = column.flatten().to_numpy(zero_copy_only=False)  # null lists have no entries here, null entries are NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * c) + OFFSET
        bad = ~(np.abs(x) < LARGEST)
    row = np.repeat(np.arange(len(column)), lengths)
    good = lengths == dimension
    good[row[bad]] = False
    return np.flatnonzero(good), x[good[row]].astype(np.int64).reshape(-1, dimension)


def common_length(rows: DataFrame, vector: str) -> int | None:
    """The most frequent length of vectors without null or non-finite entries; the longer of equally frequent ones."""
    entries = named(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    lengths = rows.filter(F.coalesce(finite, F.lit(False)) & (F.size(entries) > 0)).groupBy(F.size(entries).alias("d")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("d")).head()
    return found["d"] if found else None


def fit_blocks(rows: DataFrame, vector: str, dimension: int) -> DataFrame:
    """(rows, x): the distinct counted vectors, in blocks of little-endian 64-bit integers, written."""
    width = 8 * dimension

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = _counted(batch.column("vector"), dimension)
            if len(x):  # rows of one batch that are alike are told once
                alike = np.unique(x.astype("<i8").view(f"V{width}").ravel())
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(width), len(alike), [None, pa.py_buffer(alike.tobytes())]).cast(pa.binary())], names=["x"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // width))
        held = []

        def block(parts):
            data = b"".join(parts)
            return pa.RecordBatch.from_arrays([pa.array([len(data) // width], pa.int64()), pa.array([data], pa.binary())], names=["rows", "x"])

        for batch in batches:
            for x in batch.column("x"):
                held.append(x.as_py())
                if len(held) == step:
                    yield block(held)
                    held = []
        if held:
            yield block(held)

    vectors = rows.select(named(vector).cast("array<double>").alias("vector")).mapInArrow(count, "x binary")
    return written(vectors.distinct().mapInArrow(pack, "rows long, x binary"), "vectors")


# ---- sums over blocks --------------------------------------------------------------------------------


def _fan_in(blocks: DataFrame) -> int:
    """Groups in which the partial sums of tasks are added before they come to the driver."""
    return max(1, math.isqrt(blocks.rdd.getNumPartitions()))


def _summed(blocks: DataFrame, fan_in: int, of_block: Callable[[np.ndarray], np.ndarray], kind=np.float64) -> np.ndarray:
    """The sum of a row of numbers over all blocks: in each task, then in groups of tasks, then here.

    ``of_block`` gets a block's counted vectors. Its numbers are as many for every block.
    """
    arrow = pa.from_numpy_dtype(kind)
    name = "long" if kind == np.int64 else "double"

    def add(rows: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for row in rows:
            total = row if total is None else total + row
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(arrow))], names=["sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add(
            of_block(np.frombuffer(x.as_buffer(), "<i8").reshape(n, -1))
            for batch in batches for n, x in zip(batch.column("rows").to_pylist(), batch.column("x"))
        )

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add(row.values.to_numpy() for batch in batches for row in batch.column("sums"))

    schema = f"sums array<{name}>"
    parts = blocks.mapInArrow(first, schema).repartition(fan_in).mapInArrow(second, schema).toArrow().column("sums")
    return sum((row.values.to_numpy() for row in parts), start=np.zeros(1, kind))


def _centred(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """The vectors less their mean: exact differences, divided once."""
    return exact_deviations(x, n, sums).astype(np.float64) / n


def exact_deviations(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """n * x - sums, exactly: in 64 bits where they hold it, else in whole numbers of any size."""
    most = int(np.abs(x).max(initial=0)) * n + max((abs(s) for s in sums), default=0)
    if most < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(deviations: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; null where a 64-bit integer can't hold it."""
    most = int(np.abs(deviations).max(initial=0)) if deviations.size else 0
    if most * most * max(deviations.shape[1], 1) < 1 << 63:
        return (deviations.astype(np.int64) ** 2).sum(axis=1).tolist()
    whole = (deviations.astype(object) ** 2).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in whole]


# ---- bidiagonalisation -------------------------------------------------------------------------------


def _left_vectors(a: np.ndarray, v: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A block's part of U, from A V = U B column by column. A column without length is nought."""
    u = a @ v
    for j in range(v.shape[1]):
        if j:
            u[:, j] -= u[:, :j] @ b[:j, j]
        u[:, j] = u[:, j] / b[j, j] if b[j, j] else 0.0
    return u


def _step(blocks: DataFrame, fan_in: int, n: int, sums: Sequence[int], v: np.ndarray, b: np.ndarray, vector: np.ndarray, before: np.ndarray):
    """One pass: u = A vector - U before, and with it Uᵀu, Aᵀu, |u|² and |A|² (the same in each pass)."""
    k, d = v.shape[1], len(vector)

    def of_block(x: np.ndarray) -> np.ndarray:
        a = _centred(x, n, sums)
        left = _left_vectors(a, v, b)
        u = a @ vector - left @ before
        return np.concatenate((left.T @ u, a.T @ u, [u @ u, np.vdot(a, a)]))

    found = _summed(blocks, fan_in, of_block)
    return found[:k], found[k : k + d], found[k + d], found[k + d + 1]


def _orthogonal(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - v @ (v.T @ x)
    return x


def bidiagonalise(step: Callable, dimension: int, wanted: int, seed: int = 1):
    """Components (columns), deviations and the squared length of A, from passes over it.

    ``step(v, b, vector, before)`` gives Uᵀu, Aᵀu, |u|² and |A|² for u = A vector - U before. Where a direction has been
    used up, or A has no length left along it, the next one is drawn at random across all before; A is done with where it
    has no length along such a one.
    """
    rng = np.random.default_rng(seed)
    v, b = np.empty((dimension, 0)), np.empty((0, 0))
    images = np.empty((dimension, 0))  # Aᵀ U
    vector, drawn, link, total = None, True, 0.0, 0.0
    while v.shape[1] < dimension:
        k = v.shape[1]
        if vector is None:
            vector, drawn, link = _orthogonal(rng.standard_normal(dimension), v), True, 0.0
            vector = vector / np.linalg.norm(vector)
        before = np.zeros(k)
        before[k - 1 :] = link
        rest, image, square, total = step(v, b, vector, before)
        image = image - images @ rest
        length = math.sqrt(max(square - rest @ rest, 0.0))
        if length <= NOTHING * math.sqrt(total):
            if drawn:  # nothing is left across V
                break
            length, image = 0.0, np.zeros(dimension)
        b = np.pad(b, ((0, 1), (0, 1)))
        b[:k, k], b[k, k] = before + rest, length
        v = np.column_stack((v, vector))
        images = np.column_stack((images, image / length if length else image))
        following = _orthogonal(images[:, -1], v)
        link = float(np.linalg.norm(following))
        vector, drawn = None, True
        if link > NOTHING * math.sqrt(total):
            vector, drawn = following / link, False
            p, s, _ = np.linalg.svd(b)
            if k + 1 >= wanted and (link * np.abs(p[-1, :wanted]) <= SETTLED * s[0]).all():
                break
    _, s, q = np.linalg.svd(b) if v.shape[1] else (None, np.empty(0), np.empty((0, 0)))
    there = s > NOTHING * (s[0] if len(s) else 0.0)
    return (v @ q.T)[:, there][:, :wanted], s[there][:wanted], total, v.shape[1]


def fit_whitening(rows: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS, dimension: int | None = None, seed: int = 1) -> Whitening | None:
    """Components of the distinct counted vectors of ``rows``; None where no row can be counted.

    A vector is counted where it has the ``dimension`` (default: the most frequent length) and no null, non-finite or huge
    (2^52 steps or more) entry. Repeated vectors count once. Directions along which all vectors are alike are no components:
    there are as many as the vectors span, ``components`` at most, and none for a single vector.
    """
    dimension = dimension or common_length(rows, vector)
    if not dimension:
        return None
    blocks = fit_blocks(rows, vector, dimension)
    fan_in = _fan_in(blocks)
    # Sums of the low and the high halves: neither half can overflow, whatever the number of blocks.
    halves = _summed(blocks, fan_in, lambda x: np.concatenate(([len(x)], (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0))), np.int64)
    n = int(halves[0])
    if not n:
        return None
    sums = tuple(int(low) + (int(high) << 32) for low, high in zip(halves[1 : dimension + 1], halves[dimension + 1 :]))
    found, deviations, total, steps = bidiagonalise(
        lambda v, b, x, before: _step(blocks, fan_in, n, sums, v, b, x, before), dimension, components, seed
    )
    variances = deviations**2 / n
    k = len(variances)
    scaled = found / np.sqrt(variances)

    def of_block(x: np.ndarray) -> np.ndarray:
        y = _centred(x, n, sums) @ scaled
        return np.concatenate((y.sum(axis=0), (y.T @ y).ravel()))

    error = 0.0
    if k:
        both = _summed(blocks, fan_in, of_block) / n
        error = float(np.abs(both[k:].reshape(k, k) - np.outer(both[:k], both[:k]) - np.eye(k)).max())
    return Whitening(n, sums, found, variances, total / n, error, steps)


def whiten(rows: DataFrame, model: Whitening | None, *, vector: str = "embedding", keep=None) -> DataFrame:
    """Every counted row: ``row`` (kept columns of rows, default all), ``deviation`` and ``whitened``.

    ``deviation`` is the exact sum of (n * x - sums)² over the dimensions, null where a 64-bit integer can't hold it;
    ``whitened`` is the row less the mean along each component, over its deviation: an empty list if there is none. Rows
    that aren't counted (see ``fit_whitening``) are left out; repeated rows come out each. Extra columns pass through.
    """
    packed = rows.select(whole_row(rows, keep).alias("row"), named(vector).cast("array<double>").alias("vector"))
    found = T.StructType([packed.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        return rows.sparkSession.createDataFrame([], found)
    scaled, n, sums = model.components / np.sqrt(model.variances), model.n, model.sums
    dimension, k = scaled.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _counted(batch.column("vector"), dimension)
            exact = exact_deviations(x, n, sums)
            y = (exact.astype(np.float64) / n) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k, pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(at)), pa.array(_squares(exact), pa.int64()), lists], names=found.names)

    return packed.mapInArrow(run, found)
