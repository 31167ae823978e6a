"""Whitening of embeddings from an exact, bit-sliced scatter.

1. Each entry ``c`` becomes the integer ``x = floor(256 * c)``. Rows are packed to bytes of the
   least width that holds them, so equal bytes mean equal vectors, and the distinct ones are the
   fit list: copies weigh nothing, however many there are, and combine before the shuffle.
2. One pass gives count, sums and least and greatest entry of each dimension.
3. Scatter. Every dimension is shifted by its least entry, so that it is a natural number, and cut
   into bit planes; a plane holds 64 rows in one word. The cross-product of two dimensions is the
   sum over pairs of their planes of ``popcount(a AND b)`` times a power of two. All of it is exact.
   A task hands on one row for each pair of dimensions and part of the powers.
4. ``n`` times the shifted products minus the products of the shifted sums is ``n * n`` times the
   covariance, as integers (a shift changes no covariance); only then does it become a matrix of
   doubles for ``eigh``.
5. All rows are projected on the first components.

Through the driver go numbers per dimension and per pair of dimensions, none per row. Tasks hold
``CHUNK`` rows at a time.

Defined cases: rows whose vector is null, or holds null, NaN or an infinity, are left out. So are
vectors of another length than most rows have (of equally frequent lengths the greatest counts);
empty vectors have no components. Entries beyond 64 bits take the nearest end. Rows without id and
repeated rows stay, each with its own results. A component without variance (at most ``NO_VARIANCE``
of the whole) has null ``whitened`` and does not count in ``identity_error``, which is null without
any other; ``explained`` is null if nothing varies. Exact deviations beyond 64 bits are null. Empty
tables give no rows. Other columns are not read, whatever they are called. Components of equal
variance are any orthonormal basis of theirs, the same one for all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm.texts import named
from searchloom.sinks.tables import staged

SCALE = 256
COMPONENTS = 4
CHUNK = 4096
#: share of the whole variance below which a component counts as constant (rounding of eigh is far below)
NO_VARIANCE = 1e-12
#: powers of two that one partial sum may span: 2 ** (20 + 2) times the rows stays within 64 bits
LIMB = 20
_LOW, _HIGH = -(2**63), 2**63 - 1


def _integers(vector: list) -> np.ndarray | None:
    """floor(256 * c) of every entry as 64-bit integers; null if an entry is missing or not finite."""
    if any(c is None for c in vector):
        return None
    values = np.asarray(vector, np.float64)
    if not np.isfinite(values).all():
        return None
    with np.errstate(over="ignore"):
        x = np.floor(values * SCALE)
    if np.abs(x, where=np.isfinite(x), out=np.full(len(x), np.inf)).max(initial=0) < 2**62:
        return x.astype(np.int64)
    return np.array([_HIGH if v >= 2.0**63 else _LOW if v < -(2.0**63) else int(v) for v in x.tolist()], np.int64)


def packed(x: np.ndarray) -> bytes:
    """The integers in the least width of 2, 4 or 8 bytes; equal vectors have equal bytes."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dims, x): the usable rows, with their integers packed."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if v is None else _integers(v) for v in batch.column(1).to_pylist()]
            keep = pa.array([x is not None and len(x) > 0 for x in found], pa.bool_())
            dims = pa.array([0 if x is None else len(x) for x in found], pa.int32())
            data = pa.array([None if x is None else packed(x) for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), dims, data], ["id", "dims", "x"]).filter(keep)

    kind = rows.schema[id_col].dataType.simpleString()
    both = rows.select(named(id_col).alias("id"), named(vector_col).alias("vector"))
    return both.mapInArrow(make, f"id {kind}, dims int, x binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The packed vectors of column 0 as matrices of up to ``CHUNK`` rows."""
    held: list[np.ndarray] = []
    for batch in batches:
        for data in batch.column(0).to_pylist():
            held.append(unpacked(data))
            if len(held) == CHUNK:
                yield np.array(held)
                held = []
    if held:
        yield np.array(held)


def _totals(fit: DataFrame) -> list:
    """(dim, n, total, low, high) of each dimension; totals in two halves, so that no sum of 64-bit entries is lost."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _chunks(batches):
            upper, lower = x >> np.int64(32), x & np.int64(2**32 - 1)
            columns = [np.arange(x.shape[1]), np.full(x.shape[1], len(x)), upper.sum(axis=0), lower.sum(axis=0), x.min(axis=0), x.max(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["dim", "n", "upper", "lower", "low", "high"])

    parts = fit.select("x").mapInArrow(sums, "dim long, n long, upper long, lower long, low long, high long")
    return parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("upper").alias("upper"), F.sum("lower").alias("lower"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """(bits, dims, words): the bit planes of each dimension, 64 rows in a word; missing rows of the last word are 0."""
    whole = np.zeros((-(-len(y) // 64) * 64, y.shape[1]), np.uint64)
    whole[: len(y)] = y
    out = np.empty((bits, y.shape[1], len(whole) // 64), np.uint64)
    for b in range(bits):
        plane = (whole >> np.uint64(b)).astype(np.uint8) & np.uint8(1)
        out[b] = np.packbits(plane.T.copy(), axis=1).view(np.uint64)
    return out


def cross_products(y: np.ndarray, bits: int) -> np.ndarray:
    """(limbs, dims, dims): sums over rows of products of dimensions i <= j; the limb ``l`` counts units of ``2 ** (LIMB * l)``."""
    sliced = planes(y, bits)
    dims = y.shape[1]
    out = np.zeros((2 * bits // LIMB + 1, dims, dims), np.int64)
    for i in range(dims):
        for a in range(bits):
            counts = np.bitwise_count(sliced[a, i] & sliced[:, i:]).sum(axis=2, dtype=np.int64)
            for b in range(bits):
                limb, rest = divmod(a + b, LIMB)
                out[limb, i, i:] += counts[b] << rest
    return out


def _scatter(fit: DataFrame, low: list[int], bits: int) -> dict[tuple[int, int], int]:
    """Exact cross-products of the shifted dimensions i <= j over the whole fit list."""
    shift = np.array(low, np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _chunks(batches):
            # the difference of two 64-bit integers as an unsigned one, whatever their signs
            part = cross_products(x.astype(np.uint64) - shift.astype(np.uint64), bits)
            total = part if total is None else total + part
        if total is not None:
            limb, i, j = np.nonzero(total)
            columns = [pa.array(c.astype(np.int64)) for c in (i, j, limb, total[limb, i, j])]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "limb", "value"])

    parts = fit.select("x").mapInArrow(products, "i long, j long, limb long, value long")
    out: dict[tuple[int, int], int] = {}
    # one row for each pair of dimensions and limb, however many rows there are
    for r in parts.groupBy("i", "j", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).toLocalIterator():
        out[r.i, r.j] = out.get((r.i, r.j), 0) + (int(r.value) << LIMB * r.limb)
    return out


@dataclass(frozen=True)
class Model:
    """What a fit list says: exact counts and sums, and components by falling variance."""

    n: int
    sums: tuple[int, ...]
    variances: tuple[float, ...]
    trace: float
    axes: np.ndarray  # dims x components

    @property
    def varies(self) -> list[bool]:
        return [v > NO_VARIANCE * self.trace for v in self.variances]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles, from ``n * x - S`` as exact integers."""
        return self.spread(x).astype(np.float64) / self.n

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in 64 bits where they are enough."""
        most = self.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, self.sums))
        if most < 2**62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squares of ``n * x - S``; null beyond 64 bits."""
        z = self.spread(x)
        if z.dtype != object and len(z) and int(np.abs(z).max()) ** 2 * z.shape[1] < 2**63:
            return (z * z).sum(axis=1).tolist()
        squares = (sum(v * v for v in row) for row in z.tolist())
        return [s if s <= _HIGH else None for s in squares]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.array([1 / np.sqrt(v) if ok else np.nan for v, ok in zip(self.variances, self.varies)])
        return self.centred(x) @ self.axes * scale


def _fitted(fit: DataFrame, components: int) -> Model | None:
    totals = _totals(fit)
    if not totals:
        return None
    n, dims = totals[0].n, len(totals)
    low = [r.low for r in totals]
    sums = [(r.upper << 32) + r.lower for r in totals]
    shifted = [s - n * v for s, v in zip(sums, low)]
    bits = max(1, max(r.high - r.low for r in totals).bit_length())
    products = _scatter(fit, low, bits)
    cov = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            # the quotient of two integers is rounded once
            cov[i, j] = cov[j, i] = (n * products.get((i, j), 0) - shifted[i] * shifted[j]) / (n * n)
    values, axes = np.linalg.eigh(cov)
    first = np.argsort(-values, kind="stable")[:components]
    return Model(n, tuple(sums), tuple(float(v) for v in values[first]), float(np.trace(cov)), axes[:, first])


def _identity_error(fit: DataFrame, model: Model) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    used = [k for k, ok in enumerate(model.varies) if ok]
    if not used:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(len(used)), np.zeros((len(used), len(used)))
        for x in _chunks(batches):
            w = model.whitened(x)[:, used]  # centred by the exact means
            first += w.sum(axis=0)
            second += w.T @ w
        i, j = (m.ravel() for m in np.indices(second.shape))
        columns = [pa.array(np.append(i, np.arange(len(used)))), pa.array(np.append(j, np.full(len(used), -1))), pa.array(np.append(second.ravel(), first))]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "value"])

    parts = fit.select("x").mapInArrow(products, "i long, j long, value double")
    found = {(r.i, r.j): r.value / model.n for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    return max(abs(found[i, j] - found[i, -1] * found[j, -1] - (i == j)) for i, j in found if j >= 0)


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    found = staged(vectors(rows, id_col, vector_col), "white-vectors")
    lengths = found.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [id_col, *[f.strip().split(" ")[0] for f in schema.split(",")[1:]]]
    if not lengths:
        return rows.sparkSession.createDataFrame([], schema).toDF(*names)
    found = found.where(F.col("dims") == lengths[0].dims)
    fit = staged(found.select("x").distinct(), "white-fit")
    model = _fitted(fit, components)
    error = _identity_error(fit, model)
    explained = [v / model.trace if model.trace > 0 else None for v in model.variances]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                x = np.array([unpacked(d) for d in batch.column(1).to_pylist()])
                values, deviations = model.whitened(x), pa.array(model.deviations(x), pa.int64())
                for k, ok in enumerate(model.varies):
                    size = batch.num_rows
                    columns = [
                        batch.column(0), pa.array([k + 1] * size, pa.int32()), pa.array([model.n] * size, pa.int64()), deviations,
                        pa.array(values[:, k]) if ok else pa.nulls(size, pa.float64()),
                        pa.array([explained[k]] * size, pa.float64()), pa.array([error] * size, pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["id", *names[1:]])

    return found.select("id", "x").mapInArrow(project, schema).toDF(*names)
