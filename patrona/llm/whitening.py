"""Embedding whitening with a covariance from polarised variances.

Entries become integers x = floor(scale * c) + shift, so that every sum is exact. For
each dimension and each sum of two dimensions the squares of the centred values are
added up; Var(i + j) - Var(i) - Var(j) is twice the covariance of i and j. Each task
returns one array of sums, arrays are added in two rounds, and the driver holds only
numbers of dimensions squared. Values are centred at the integer next to the mean
before they are squared, and the remainder of less than one half is taken off exactly.

Defined cases: a vector that is null or empty or holds a null, a non-finite entry or
one whose x is beyond 2^53 is dropped; of vectors of different lengths those of the most
frequent length stay (the longest at a tie). Vectors equal after rounding count once in
the fit and are each whitened; null and repeated keys are kept row by row. Components
past the rank (one vector, constant dimensions) have a null ``whitened``; ``explained``
is null when no dimension varies, ``identity_error`` 0 when there is no component, and
``deviation`` null beyond 64 bits. An empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.scale import bucket_side
from patrona.session import materialize

#: Rows whose pair sums are formed at once in a task.
BLOCK = 4096
_EXACT = 1 << 53
_LONG = 1 << 62


def _integers(batch: pa.RecordBatch, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows kept, the x of their entries one after another, and the lengths of the vectors."""
    column = batch.column("embedding").cast(pa.large_list(pa.float64()))
    kept = np.array(column.is_valid())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    lengths = np.diff(offsets) * kept
    kept &= lengths > 0
    entries = column.values
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(scale * entries.fill_null(math.nan).to_numpy(zero_copy_only=False)) + shift
    bad = np.r_[0, np.cumsum(~(np.abs(x) < _EXACT))]
    kept &= bad[offsets[1:]] == bad[offsets[:-1]]
    inside = np.zeros(len(x) + 1, np.int64)
    np.add.at(inside, offsets[:-1][kept], 1)
    np.add.at(inside, offsets[1:][kept], -1)
    inside = np.cumsum(inside[:-1]) > 0
    return np.flatnonzero(kept), x[inside].astype(np.int64), lengths[kept]


def _pack(scale: int, shift: int) -> Callable:
    """(width, x) of each vector kept: 4 bytes an entry if all of its entries fit, else 8."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x, lengths = _integers(batch, scale, shift)
            packed, at = [], 0
            for size in lengths.tolist():
                own = x[at:at + size]
                at += size
                small = np.abs(own).max() < 1 << 31
                packed.append(own.astype("<i4" if small else "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["dims", "x"])
    return task


def _unpack(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch.column("x")
    return np.array([np.frombuffer(v.as_buffer(), "<i4" if len(v.as_buffer()) == 4 * dims else "<i8")
                     for v in column], np.int64).reshape(-1, dims)


def _whole(values: np.ndarray) -> list[str]:
    return [str(int(v)) for v in values]


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All arrays of a task added to one."""
    total = None
    for batch in batches:
        for row in batch.column("sums").to_pylist():
            own = np.array([int(v) for v in row], object)
            total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([_whole(total)], pa.list_(pa.string()))], names=["sums"])


def added(rows: DataFrame, task: Callable) -> np.ndarray | None:
    """Exact sum of the arrays that ``task`` makes of the rows, one array a task; None without rows."""
    side = bucket_side(rows.sparkSession)
    sums = rows.mapInArrow(task, "sums array<string>").repartition(side).mapInArrow(_add, "sums array<string>")
    found = sums.collect()  # at most 64 arrays
    return sum(np.array([int(v) for v in row["sums"]], object) for row in found) if found else None


def _totals(dims: int) -> Callable:
    """Number of vectors, and the sum of each dimension."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims + 1, object)
        for batch in batches:
            x = _unpack(batch, dims)
            if len(x) * int(np.abs(x).max(initial=0)) >= _LONG:
                x = x.astype(object)
            total += np.r_[len(x), x.sum(0)].astype(object)
        yield pa.RecordBatch.from_arrays([pa.array([_whole(total)], pa.list_(pa.string()))], names=["sums"])
    return task


def pair_index(dims: int) -> list[tuple[int, int]]:
    """Order of the sums: each dimension with itself and those after it."""
    return [(i, j) for i in range(dims) for j in range(i, dims)]


def _squares(centre: np.ndarray) -> Callable:
    """Sum of the squared centred value of each dimension (i, i) and each dimension-pair sum (i, j)."""
    dims = len(centre)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims * (dims + 1) // 2, object)
        for batch in batches:
            centred = _unpack(batch, dims) - centre
            for begin in range(0, len(centred), BLOCK):
                block = centred[begin:begin + BLOCK]
                if len(block) * 4 * int(np.abs(block).max()) ** 2 >= _LONG:
                    block = block.astype(object)
                columns = np.ascontiguousarray(block.T)
                at = 0
                for i in range(dims):
                    pairs = columns[i:] + columns[i]
                    pairs[0] = columns[i]
                    total[at:at + dims - i] += (pairs * pairs).sum(1).astype(object)
                    at += dims - i
        yield pa.RecordBatch.from_arrays([pa.array([_whole(total)], pa.list_(pa.string()))], names=["sums"])
    return task


@dataclass
class Whitening:
    """Fitted transform: n vectors with sums S of x, and one row of ``axes`` per component."""
    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float
    covariance: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        centre = np.array([-(-(2 * s - self.n) // (2 * self.n)) for s in self.sums], np.int64)
        rest = np.array([(s - int(c) * self.n) / self.n for s, c in zip(self.sums, centre)])
        return (x - centre) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Projections on the components over the root of their variances; NaN past the rank."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        return self.centred(x) @ self.axes.T * scale

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n*x - S)^2, exact."""
        reach = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        sums = np.array(self.sums, object)
        if reach < 1 << 62 and len(sums) * (spread := self._spread(x)) ** 2 < _LONG:
            moved = self.n * x - sums.astype(np.int64)
            assert int(np.abs(moved).max(initial=0)) == spread
            return (moved * moved).sum(1).tolist()
        moved = self.n * x.astype(object) - sums
        return [d if d < 1 << 63 else None for d in (moved * moved).sum(1)]

    def _spread(self, x: np.ndarray) -> int:
        if not len(x):
            return 0
        low, high = x.min(0).tolist(), x.max(0).tolist()
        return max(max(abs(self.n * v - s) for v, s in zip(side, self.sums)) for side in (low, high))


def fit(distinct: DataFrame, dims: int, components: int) -> Whitening | None:
    """Covariance by polarisation over the distinct vectors (x), and its leading components."""
    totals = added(distinct, _totals(dims))
    if totals is None or not totals[0]:
        return None
    n, sums = int(totals[0]), [int(v) for v in totals[1:]]
    centre = [-(-(2 * s - n) // (2 * n)) for s in sums]
    left = [s - c * n for s, c in zip(sums, centre)]  # sums of the centred values
    squares = added(distinct, _squares(np.array(centre, np.int64)))
    pairs = pair_index(dims)
    spread = {(i, j): n * int(q) - (left[i] + (left[j] if i != j else 0)) ** 2 for (i, j), q in zip(pairs, squares)}
    cov = np.zeros((dims, dims))
    for i, j in pairs:
        twice = 2 * spread[i, i] if i == j else spread[i, j] - spread[i, i] - spread[j, j]
        cov[i, j] = cov[j, i] = twice / (2 * n * n)  # quotient of whole numbers, rounded once
    values, vectors = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], vectors.T[::-1][:components]
    axes = axes * np.where(axes[np.arange(len(axes)), np.abs(axes).argmax(1)] < 0, -1, 1)[:, None]
    values = np.where(values > dims * np.finfo(float).eps * max(values[0], 0), values, 0)
    return Whitening(n, sums, axes, values, sum(spread[i, i] for i in range(dims)) / (n * n), cov)


def _moments(model: Whitening, dims: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = int((model.values > 0).sum())
        total = np.zeros(rank + rank * rank)
        for batch in batches:
            w = model.whiten(_unpack(batch, dims))[:, :rank]
            total += np.r_[w.sum(0), (w.T @ w).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])
    return task


def identity_error(distinct: DataFrame, model: Whitening, dims: int) -> float:
    """Largest absolute entry of (covariance of the whitened vectors - identity)."""
    rank = int((model.values > 0).sum())
    if not rank:
        return 0.0
    sums = (distinct.mapInArrow(_moments(model, dims), "sums array<double>")
            .select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect())
    total = np.zeros(rank + rank * rank)
    for row in sums:
        total[row["i"]] = row["s"]
    mean = total[:rank] / model.n
    return float(np.abs(total[rank:].reshape(rank, rank) / model.n - np.outer(mean, mean) - np.eye(rank)).max())


def _whiten_task(model: Whitening, dims: int, scale: int, shift: int, error: float, key: pa.DataType) -> Callable:
    shown = len(model.values)
    explained = [v / model.trace if model.trace > 0 else None for v in model.values.tolist()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x, lengths = _integers(batch, scale, shift)
            fits = lengths == dims
            x = x[np.repeat(fits, lengths)].reshape(-1, dims)
            rows = rows[fits]
            w = model.whiten(x)
            deviation = model.deviation(x)
            keys = batch.column("vec_id").take(pa.array(np.repeat(rows, shown)))
            size = len(keys)
            yield pa.RecordBatch.from_arrays([
                keys.cast(key), pa.array(np.tile(np.arange(1, shown + 1), len(rows)), pa.int32()),
                pa.array([model.n] * size, pa.int64()),
                pa.array([d for d in deviation for _ in range(shown)], pa.int64()),
                pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel())),
                pa.array(explained * len(rows), pa.float64()), pa.array([error] * size, pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return task


def whiten_embeddings(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000,
                      max_dims: int = 4096) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector.

    ``vectors`` has (vec_id, embedding). More than ``max_dims`` dimensions are an error,
    since the driver holds a matrix of dimensions squared.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = vectors.schema["vec_id"].dataType
    out = (f"vec_id {kind.simpleString()}, component int, n long, deviation long, whitened double, "
           "explained double, identity_error double")
    source = vectors.select("vec_id", "embedding")
    distinct = materialize(source.select("embedding").mapInArrow(_pack(scale, shift), "dims long, x binary")
                           .distinct(), "whitening")
    sizes = (source.select("embedding").mapInArrow(_pack(scale, shift), "dims long, x binary")
             .groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first())
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], out)
    dims = sizes["dims"]
    if dims > max_dims:
        raise ValueError(f"{dims} dimensions; at most {max_dims}")
    fitted = distinct.where(F.col("dims") == dims).select("x")
    model = fit(fitted, dims, components)
    error = identity_error(fitted, model, dims)
    return source.mapInArrow(_whiten_task(model, dims, scale, shift, error, to_arrow_type(kind)), out)
