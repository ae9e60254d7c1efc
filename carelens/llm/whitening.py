"""Embedding whitening from exact integer scatter, counted on bit planes.

Entries become whole numbers, x = floor(64 c) + 1000000.  A block of rows is
shifted by its smallest value in each dimension, and bit b of dimension d of
all its rows is packed into one plane of 64-bit words.  The cross-product of
two dimensions is then the sum over their planes of 2^(a+b) times the number
of rows in which both bits are set: an AND and a popcount.  A further
"dimension" that is 1 in every row gives the number of rows and the sums by
the same count.  Blocks take their shift out again in whole numbers, tasks add
their blocks up, and the tasks' parts are added dimension by dimension in as
many tasks as there are dimensions; only the final matrix, dimensions squared,
comes to the driver.  There n^2 times the covariance, n*G - S*S', is still a
whole number, and is rounded once, before ``eigh``.

The fit list holds each distinct x vector once: tasks drop their own repeats
before the shuffle, so a vector that a third of all rows share is one row a
task.

Defined results: rows whose vector is NULL or holds a NULL, NaN or infinity
are dropped, and so are empty vectors and those whose length is not the most
frequent one (ties: the shorter); a row without id keeps a NULL id; repeated
rows are answered each.  An entry whose x no long can hold counts as the
nearest of -2^62 and 2^62.  Components without variance (not above the
rounding error of the largest) are left out, as nothing can be divided by
them: one distinct vector, like an empty table, gives no row.  ``deviation``
is NULL where no long can hold it; ``deviation_wide`` holds 38 digits.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import materialize, ship_package

SCALE, OFFSET = 64, 1_000_000
FURTHEST = 1 << 62  # |64 c| at most
COMPONENTS = 16
BLOCK = 1 << 15  # rows whose planes are held at a time
DISTINCT_BYTES = 32 << 20  # vectors a task remembers to drop repeats
LIMB = 30  # bits of a part of a cross-product on its way


@dataclass
class Whitening:
    """``axes`` (dimensions, components): unit eigenvectors over sqrt(e);
    sums are those of x - OFFSET over the fit list."""

    n: int
    sums: list[int]
    axes: np.ndarray
    explained: np.ndarray

    def centred(self, f: np.ndarray) -> np.ndarray:
        """x - S/n as doubles: whole numbers until the division."""
        if int(np.abs(f).max(initial=0)) * self.n < 1 << 61:
            return (f * self.n - np.array(self.sums, np.int64)) / self.n
        return ((f.astype(object) * self.n - np.array(self.sums, object)) / self.n).astype(np.float64)

    def whiten(self, f: np.ndarray) -> np.ndarray:
        return self.centred(f) @ self.axes

    def deviation(self, f: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*x - S)^2, exact: the square is taken
        apart so that only three products a row need wide numbers."""
        most = max([int(np.abs(f).max(initial=0)), 1])
        far = max([abs(s) for s in self.sums])
        if f.shape[1] * most * max(most, far) < 1 << 62:
            sums = np.array(self.sums, np.int64)
            squares, mixed = (f * f).sum(1).tolist(), (f @ sums).tolist()
        else:
            wide = f.astype(object)
            squares, mixed = (wide * wide).sum(1).tolist(), (wide @ np.array(self.sums, object)).tolist()
        rest = sum(s * s for s in self.sums)
        return [self.n * self.n * a - 2 * self.n * b + rest for a, b in zip(squares, mixed, strict=True)]


def whole(c: np.ndarray) -> np.ndarray:
    """floor(64 c), that is x - OFFSET, as longs."""
    return np.clip(np.floor(c * SCALE), -float(FURTHEST), float(FURTHEST)).astype(np.int64)


def scatter(f: np.ndarray) -> np.ndarray:
    """Exact cross-products (dimensions + 1 squared, whole numbers as objects)
    of the rows of ``f`` with a last dimension of ones, by planes of bits."""
    rows, dims = f.shape
    low = f.min(0)
    y = (f.view(np.uint64) - low.view(np.uint64))  # wraps to the true difference, below 2^64
    bits = [int(v).bit_length() for v in y.max(0)]
    pad = -rows % 64
    planes = []
    for d in range(dims):
        for b in range(bits[d]):
            planes.append(np.packbits(np.pad(((y[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), (0, pad))).view(np.uint64))
    planes.append(np.packbits(np.pad(np.ones(rows, np.uint8), (0, pad))).view(np.uint64))
    p = np.stack(planes)
    weight = np.array([1 << b for d in range(dims) for b in range(bits[d])] + [1], object)
    owner = np.array([d for d in range(dims) for _ in range(bits[d])] + [dims])
    # Counts of a plane against all planes are below 2^15 or so; their weighted
    # sums are kept in longs where they fit.
    fits = rows << (2 * max([*bits, 1])) < 1 << 62
    w = weight.astype(np.int64) if fits else weight
    half = np.zeros((len(planes), dims + 1), np.int64 if fits else object)
    starts = np.flatnonzero(np.r_[True, np.diff(owner) != 0])
    for i in range(len(planes)):
        both = np.bitwise_count(p & p[i]).sum(1, dtype=np.int64) * w
        half[i, owner[starts]] = np.add.reduceat(both, starts) * w[i]
    g = np.zeros((dims + 1, dims + 1), object)
    for i, d in enumerate(owner):
        g[d] += half[i].astype(object)
    # The shift out again: f = y + low.
    t, n = g[dims, :dims].copy(), int(g[dims, dims])
    shift = np.array([int(v) for v in low], object)
    g[:dims, :dims] += np.outer(t, shift) + np.outer(shift, t) + n * np.outer(shift, shift)
    g[dims, :dims] = g[:dims, dims] = t + n * shift
    return g


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Doubles of an array<double> column of whole vectors."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _keys(f: np.ndarray) -> list[bytes]:
    """Every vector as bytes, each in the narrowest number type that holds it."""
    most = np.abs(np.maximum(f, -(1 << 62))).max(1)
    narrow, middle = f.astype("<i2"), f.astype("<i4")
    return [(narrow[i] if m < 1 << 15 else middle[i] if m < 1 << 31 else f[i]).tobytes() for i, m in enumerate(most.tolist())]


def _from_keys(keys: list[bytes], dims: int) -> np.ndarray:
    f = np.empty((len(keys), dims), np.int64)
    by_length: dict[int, list[int]] = {}
    for i, k in enumerate(keys):
        by_length.setdefault(len(k), []).append(i)
    for length, at in by_length.items():
        f[at] = np.frombuffer(b"".join(keys[i] for i in at), f"<i{length // dims}").reshape(-1, dims)
    return f


def _own_distinct(dims: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in it:
            new = set(_keys(whole(_matrix(batch.column(0), dims)))) - seen
            yield pa.RecordBatch.from_arrays([pa.array(sorted(new), pa.binary())], names=["x"])
            if len(seen) * dims * 2 > DISTINCT_BYTES:
                seen = set()
            seen |= new

    return run


def _rows(it: Iterator[pa.RecordBatch], dims: int, block: int) -> Iterator[np.ndarray]:
    """The fit list's rows in blocks."""
    held: list[bytes] = []
    for batch in it:
        held += batch.column(0).to_pylist()
        while len(held) >= block:
            yield _from_keys(held[:block], dims)
            held = held[block:]
    if held:
        yield _from_keys(held, dims)


def _parts(dims: int, block: int):
    """A task's cross-products, one row a dimension and limb of LIMB bits."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = None
        for f in _rows(it, dims, block):
            own = scatter(f)
            g = own if g is None else g + own
        if g is None:
            return
        for d in range(dims + 1):
            limbs, rest = [], g[d]
            while True:
                last = all(-(1 << 31) <= v < 1 << 31 for v in rest)
                limbs.append([int(v) if last else int(v) & ((1 << LIMB) - 1) for v in rest])
                if last:
                    break
                rest = rest >> LIMB
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(limbs), pa.int32()), pa.array(range(len(limbs)), pa.int32()), pa.array(limbs, pa.list_(pa.int64()))],
                names=["d", "limb", "part"])

    return run


def _add_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of parts, one running array per dimension and limb."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in it:
        for d, limb, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            key = (d, limb)
            total[key] = total.get(key, 0) + np.array(part, np.int64)
    for (d, limb), part in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d], pa.int32()), pa.array([limb], pa.int32()), pa.array([part.tolist()], pa.list_(pa.int64()))], names=["d", "limb", "part"])


def fit(spark: SparkSession, fit_list: DataFrame, dims: int, components: int = COMPONENTS, block: int = BLOCK) -> Whitening | None:
    """Model of a list (column x) of distinct vectors; None if it is empty."""
    parts = fit_list.mapInArrow(_parts(dims, block), "d int, limb int, part array<long>")
    rows = parts.repartition(min(dims + 1, 256), "d").mapInArrow(_add_up, "d int, limb int, part array<long>").collect()  # (dims + 1)^2 values
    if not rows:
        return None
    g = np.zeros((dims + 1, dims + 1), object)
    for r in rows:
        g[r["d"]] += np.array([int(v) << (LIMB * r["limb"]) for v in r["part"]], object)
    n, sums = int(g[dims, dims]), [int(v) for v in g[dims, :dims]]
    centred = n * g[:dims, :dims] - np.outer(np.array(sums, object), np.array(sums, object))
    v = (centred / (n * n)).astype(np.float64)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    kept = int((e > max(e[0], 0.0) * dims * np.finfo(float).eps).sum())
    kept = min(kept, components)
    trace = float(sum(int(c) for c in np.diag(centred)) / (n * n))
    return Whitening(n, sums, axes[:, :kept] / np.sqrt(e[:kept]), e[:kept] / trace if kept else e[:0])


def identity_error(fit_list: DataFrame, model: Whitening, shared) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity.  The list is centred in whole numbers before it is projected."""
    dims, k = model.axes.shape

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, s = np.zeros((k, k)), np.zeros(k)
        for f in _rows(it, dims, BLOCK):
            z = shared.value.whiten(f)
            g, s = g + z.T @ z, s + z.sum(0)
        flat = np.r_[g.ravel(), s]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["at", "v"])

    rows = fit_list.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # k * (k + 1) values
    flat = np.zeros(k * k + k)
    for r in rows:
        flat[r["at"]] = r["v"]
    mean = flat[k * k :] / model.n
    return float(np.abs(flat[: k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def usable(vector: Column) -> Column:
    """Not NULL, not empty, all components finite."""
    v = F.coalesce(vector.cast("array<double>"), F.array().cast("array<double>"))
    return (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def whiten(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
           vector_column: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error,
    deviation_wide): every usable row and each of the first components."""
    ship_package(spark)
    schema = f"{id_column} long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_wide decimal(38,0)"
    v = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")).where(usable(F.col("v")))
    common = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dims = common["d"]
    v = v.where(F.size("v") == dims)
    fit_list = materialize(spark, v.select("v").mapInArrow(_own_distinct(dims), "x binary").distinct(), "fit-list")
    model = fit(spark, fit_list, dims, components, block)
    if model is None or not model.axes.shape[1]:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)  # dimensions times components
    error = identity_error(fit_list, model, shared)
    k = model.axes.shape[1]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in it:
            f = whole(_matrix(batch.column(1), dims))
            if not len(f):
                continue
            z, deviation = m.whiten(f), m.deviation(f)
            count = len(f) * k
            each = lambda values, kind: pa.array(np.repeat(np.array(values, object), k).tolist(), kind)
            yield pa.RecordBatch.from_arrays(
                [each(batch.column(0).to_pylist(), pa.int64()), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(f))),
                 pa.array(np.full(count, m.n)), each([d if d < 1 << 63 else None for d in deviation], pa.int64()),
                 pa.array(z.ravel()), pa.array(np.tile(m.explained, len(f))), pa.array(np.full(count, error)),
                 each([Decimal(d) if d < 10**38 else None for d in deviation], pa.decimal128(38, 0))],
                names=[c.split()[0] for c in schema.split(", ")])

    return v.mapInArrow(run, schema)
