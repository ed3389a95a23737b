"""Embedding whitening with a compensated covariance.

A vector is used if it is not null or empty, holds no null and no non-finite entry, and has the length that most such vectors have
(of ties the longer). An entry c becomes the integer x = floor(64 c) + 1000000; vectors with an x of 2^55 or more in size
are not used either, since their sums would not be exact. The fit list holds each distinct x vector once.

Sums over the fit list are integers, so the mean S / n is exact: an integer part b and r / n. Each task centres its
vectors, x - b exactly and then minus r / n as a double-double, and adds up their outer products in double-double, with
error-free sums and products (two doubles that add up to the exact result) and pairwise within a block. High and low parts
of all tasks are merged in two steps, ``MERGERS`` tasks and then the driver, which holds ``MERGERS`` matrices at most
whatever the number of rows. The covariance, rounded once to doubles, is decomposed by LAPACK's tridiagonal reduction with
divide and conquer (``syevd`` behind ``numpy.linalg.eigh``); the matrix is of the vectors' length, not of the table's.

Components come by falling eigenvalue, each with its largest entry positive. A component whose eigenvalue is zero up to
rounding (trace * length * 2^-52) has no whitened value and is left out, so one distinct vector gives no rows, as an empty
table does. ``identity_error`` is measured, not derived: the covariance of the whitened fit list goes through the same
passes, centred by its own mean.

``deviation``, the sum of (n x - S)^2, is exact; where it does not fit a long it is null. Repeated rows and null ids are
rows of their own in the result. Other columns are not read, so they may have any name. A vector is one value of a task's
memory; a block of products holds about ``_BLOCK`` numbers, or one vector's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import cut, quoted

COMPONENTS = 16
#: Tasks that merge the tasks' sums before the driver does.
MERGERS = 16
_BLOCK = 1 << 19
_SPLIT = 134217729.0  # 2^27 + 1

Pair = tuple[np.ndarray, np.ndarray]


def two_sum(a: np.ndarray, b: np.ndarray) -> Pair:
    """a + b as a rounded sum and its exact error."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def two_product(a: np.ndarray, b: np.ndarray) -> Pair:
    """a * b as a rounded product and its exact error, by halves of 26 bits."""
    p = a * b
    c = _SPLIT * a
    ah = c - (c - a)
    c = _SPLIT * b
    bh = c - (c - b)
    al, bl = a - ah, b - bh
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def _fast(s: np.ndarray, e: np.ndarray) -> Pair:
    t = s + e
    return t, e - (t - s)


def add(x: Pair, y: Pair) -> Pair:
    s, e = two_sum(x[0], y[0])
    t, f = two_sum(x[1], y[1])
    s, e = _fast(s, e + t)
    return _fast(s, e + f)


def times(x: Pair, y: Pair) -> Pair:
    p, e = two_product(x[0], y[0])
    return _fast(p, e + (x[0] * y[1] + x[1] * y[0]))


def total(x: Pair) -> Pair:
    """Sum over rows, pairwise."""
    while len(x[0]) > 1:
        half = len(x[0]) // 2
        left, right = ((v[:half], v[half : 2 * half]) for v in x)
        s = add((left[0], right[0]), (left[1], right[1]))
        x = tuple(np.concatenate([a, v[2 * half :]]) for a, v in zip(s, x))
    return x[0][0], x[1][0]


def divided(x: Pair, n: int) -> Pair:
    """x / n for a whole number of up to 2^53."""
    q = x[0] / n
    p, e = two_product(q, np.float64(n))
    return _fast(q, ((x[0] - p) - e + x[1]) / n)


def integers(vec_col: str, length: int | None = None) -> Column:
    """The x vector, null where the vector is not used."""
    v = quoted(vec_col)
    scaled = lambda c: F.floor(F.lit(64.0) * c.cast("double")) + F.lit(1000000).cast("long")
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) * 64.0 < float(1 << 54), F.lit(False)) & ~F.isnan(c))
    fits = fits & (F.size(v) == length if length is not None else F.size(v) > 0)
    return F.when(v.isNotNull() & fits, F.transform(v, scaled))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, length)


def _sums(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of x vectors: (place, sum), and under place -1 their number."""

    def run(batches):
        n, high, low = 0, [0] * length, [0] * length
        for batch in batches:
            x = _matrix(batch.column(0), length)
            n += len(x)
            high = [a + int(b) for a, b in zip(high, (x >> 24).sum(axis=0))]
            low = [a + int(b) for a, b in zip(low, (x & ((1 << 24) - 1)).sum(axis=0))]
        s = [Decimal(n), *(Decimal((a << 24) + b) for a, b in zip(high, low))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, length, dtype=np.int32)), pa.array(s, pa.decimal128(38, 0))], names=["place", "s"])

    return run


def _added(rows: DataFrame, values: Callable[[np.ndarray], Pair], length: int, size: int) -> Pair:
    """The double-double sum over all x vectors of the ``size`` numbers that ``values`` makes of each row of a matrix."""
    step = max(1, _BLOCK // max(1, size))
    schema = "part int, high binary, low binary"

    def out(part: int, s: Pair):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in s)], names=["part", "high", "low"])

    def each(batches):
        s = np.zeros(size), np.zeros(size)
        for batch in batches:
            x = _matrix(batch.column(0), length)
            for i in range(0, len(x), step):
                s = add(s, total(values(x[i : i + step])))
        yield out(TaskContext.get().partitionId(), s)

    def merge(batches):
        s, part = (np.zeros(size), np.zeros(size)), None
        for batch in batches:
            for p, high, low in zip(*(c.to_pylist() for c in batch.columns)):
                part = p if part is None else part
                s = add(s, (np.frombuffer(high), np.frombuffer(low)))
        if part is not None:
            yield out(part, s)

    parts = rows.mapInArrow(each, schema)
    few = parts.repartition(MERGERS, F.pmod("part", F.lit(MERGERS))).sortWithinPartitions("part").mapInArrow(merge, schema)
    s = np.zeros(size), np.zeros(size)
    for row in sorted(few.collect(), key=lambda r: r.part):
        s = add(s, (np.frombuffer(row.high), np.frombuffer(row.low)))
    return s


def covariance(rows: DataFrame, centred: Callable[[np.ndarray], Pair], length: int, width: int, n: int) -> np.ndarray:
    """Covariance, divisor n, of what ``centred`` makes of x vectors: ``width`` double-doubles of mean 0 a row."""
    left, right = np.triu_indices(width)

    def products(x):
        high, low = centred(x)
        return times((high[:, left], low[:, left]), (high[:, right], low[:, right]))

    high, low = divided(_added(rows, products, length, len(left)), n)
    out = np.zeros((width, width))
    out[left, right] = out[right, left] = high + low
    return out


@dataclass
class Whitening:
    """What is fitted: n distinct vectors, their sums, eigenvalues by fall, unit eigenvectors as columns, the trace."""

    length: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def whole(self) -> np.ndarray:
        """floor(S / n)"""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """S - n floor(S / n)"""
        return np.array([s % self.n for s in self.sums], np.int64)


def _centring(w: Whitening) -> Callable[[np.ndarray], Pair]:
    whole, mean = w.whole, divided((w.rest.astype(np.float64), np.zeros(w.length)), w.n)

    def run(x):
        high, low = two_sum((x - whole).astype(np.float64), -mean[0])
        return _fast(high, low - mean[1])

    return run


def _whitened(w: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    centred, turn = _centring(w), w.vectors / np.sqrt(w.values)
    return lambda x: centred(x)[0] @ turn


def fit(rows: DataFrame, length: int, components: int = COMPONENTS) -> Whitening | None:
    """``rows``: distinct x vectors (one column) of this length; None if there is none, or nothing varies."""
    sums = rows.mapInArrow(_sums(length), "place int, s decimal(38,0)").groupBy("place").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()
    by = {r.place: int(r.s) for r in sums}
    if not (n := by.get(-1, 0)) or not length:
        return None
    w = Whitening(length, n, [by[i] for i in range(length)], np.zeros(0), np.zeros((length, 0)), 0.0, 0.0)
    v = covariance(rows, _centring(w), length, length, n)
    w.trace = float(np.trace(v))
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > w.trace * length * 2.0**-52]
    if not len(order):
        return None
    w.values, vectors = values[order], vectors[:, order]
    w.vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    white, k = _whitened(w), len(order)
    mean = divided(_added(rows, lambda x: (y := white(x), np.zeros_like(y)), length, k), n)

    def again(x):
        high, low = two_sum(white(x), -mean[0])
        return _fast(high, low - mean[1])

    w.identity_error = float(np.abs(covariance(rows, again, length, k, n) - np.eye(k)).max())
    return w


def _deviation(w: Whitening, x: np.ndarray) -> pa.Array:
    """Sum of (n x - S)^2 of each row, exact."""
    apart = x - w.whole
    most = (int(np.abs(apart).max()) + 1) * w.n if len(x) else 0
    if most * most * w.length < 1 << 62:
        d = apart * w.n - w.rest
        return pa.array((d * d).sum(axis=1))
    d = (apart.astype(object) * w.n - w.rest.astype(object)) ** 2
    return pa.array([s if s < 1 << 63 else None for s in d.sum(axis=1)], pa.int64())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error): a row for each used vector and component."""
    schema = T.StructType([
        T.StructField(id_col, df.schema[id_col].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")),
    ])
    lengths = df.where(integers(vec_col).isNotNull()).groupBy(F.size(quoted(vec_col)).alias("k")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("k")).first()
    w = None
    if most is not None:
        x = integers(vec_col, most.k).alias("x")
        w = fit(cut(df.select(x).where("x is not null").distinct()), most.k, components)
    if w is None:
        return df.sparkSession.createDataFrame([], schema)

    def run(batches):
        white, k = _whitened(w), len(w.values)
        for batch in batches:
            x = _matrix(batch.column(1), w.length)
            place = pa.array(np.repeat(np.arange(len(x)), k))
            number = np.tile(np.arange(k), len(x))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(place), pa.array((number + 1).astype(np.int32)), pa.array(np.full(len(number), w.n)), _deviation(w, x).take(place),
                pa.array(white(x).reshape(-1)), pa.array((w.values / w.trace)[number]), pa.array(np.full(len(number), w.identity_error)),
            ], names=schema.names)

    return df.select(quoted(id_col).alias("id"), x).where("x is not null").mapInArrow(run, schema)
