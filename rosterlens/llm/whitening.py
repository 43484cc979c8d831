"""Whitening of vectors by a covariance weighted with multiplicities.

Entries become whole numbers, so equal vectors are equal byte strings. They are grouped;
each distinct vector is decoded, centred, multiplied and whitened once, with its count (or
one) as its weight in the fit; rows get their vector's values by a join. A vector that more
than one row in a thousand holds is joined by a broadcast, of which there are fewer than a
thousand; so no vector's rows need one task.

Sums and deviations are whole-number arithmetic; the covariance is a product of centred
double matrices per task, added up a tree of tasks. Only sums of a dimension and one matrix
reach the driver, where its eigenvectors are taken.

Rows whose vector is null or holds null or non-finite entries are dropped. So are vectors
of another length than most rows have (the longer one on a tie) and empty ones. Entries of
2^56 or more count as that, with their sign. A deviation beyond a long is null. A component without variance
(all of them, if one vector is left) has no whitened value: null, and takes no part in
``identity_error``; without any variance ``explained`` and ``identity_error`` are null.
Repeated rows and repeated or null vec_ids are rows of their own; extra columns, whatever
their names, are not read; an empty table gives no rows. Equal eigenvalues share a plane in
which any directions serve, as does either sign.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import discard, materialise, table
from .vectors import rows_of, sum_matrices

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
_MOST = float(1 << 56)
_TYPES = (np.int8, np.int16, np.int32, np.int64)
_PARTS = "node long, i int, row binary"


def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(vec_id, x) of usable rows; x is a byte for the width of a number and then floor(64 c) of every entry, in the least width that fits."""
    values, off, ok = rows_of(batch.column(1), zero=True)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(SCALE * values), -_MOST, _MOST).astype(np.int64)
    at = np.flatnonzero(ok & (off[1:] > off[:-1]))
    keys = []
    for lo, hi in zip(off[at].tolist(), off[at + 1].tolist(), strict=True):
        row = whole[lo:hi]
        least, most = int(row.min()), int(row.max())
        width = next(w for w, t in enumerate(_TYPES) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
        keys.append(bytes((width,)) + row.astype(_TYPES[width]).astype(f"<i{1 << width}").tobytes())
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(keys, pa.binary())], names=["vec_id", "x"])


def decoded(keys: list[bytes], size: int) -> np.ndarray:
    """The whole numbers of vectors of one length, without the shift."""
    out = np.zeros((len(keys), size), np.int64)
    widths = np.frombuffer(b"".join(k[:1] for k in keys), np.uint8)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        out[rows] = np.frombuffer(b"".join(keys[r][1:] for r in rows.tolist()), f"<i{1 << width}").reshape(len(rows), size)
    return out


def _batches(batches, size: int):
    for batch in batches:
        if batch.num_rows:
            yield batch, decoded(batch.column(0).to_pylist(), size), np.asarray(batch.column(1))


def _rows(node: int, matrix: np.ndarray) -> pa.RecordBatch:
    n = len(matrix)
    return pa.RecordBatch.from_arrays([pa.array([node] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([r.tobytes() for r in matrix], pa.binary())], names=["node", "i", "row"])


def sums(distinct: DataFrame, size: int) -> tuple[int, list[int]]:
    """Exact weight and weighted sums (without the shift) of ``distinct(x, f)``."""

    def run(batches):
        total = np.zeros(size + 1, object)
        for _, y, f in _batches(batches, size):
            safe = float(np.abs(y).max()) * float(f.sum()) < 2.0**62
            total[:size] += f @ y if safe else f.astype(object) @ y.astype(object)
            total[size] += int(f.sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], names=["i", "s"])

    rows = distinct.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    found = {r.i: int(r.s) for r in rows}
    return found.get(size, 0), [found.get(i, 0) for i in range(size)]


def covariance(distinct: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Covariance of the weighted vectors, centred before they are multiplied."""
    size, mean = len(total), np.asarray([s / n for s in total])

    def run(batches):
        matrix = np.zeros((size, size))
        for _, y, f in _batches(batches, size):
            centred = y - mean
            matrix += (centred * f[:, None]).T @ centred
        yield _rows(TaskContext.get().partitionId(), matrix)

    return sum_matrices(distinct.mapInArrow(run, _PARTS), distinct.rdd.getNumPartitions(), size, size) / n


def deviations(y: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum of (n*y - S)^2 of every row, exact; null beyond a long."""
    rough = ((y * float(n) - np.asarray([float(s) for s in total])) ** 2).sum(1)
    small = (rough < 2.0**62) & (np.abs(y).max(1).astype(float) * n < 2.0**62) & (max(map(abs, total)) < 1 << 62)
    out: list[int | None] = [None] * len(y)
    at = np.flatnonzero(small)
    if len(at):
        exact = ((y[at] * n - np.asarray(total, np.int64)) ** 2).sum(1)
        for i, value in zip(at.tolist(), exact.tolist(), strict=True):
            out[i] = value
    for i in np.flatnonzero(~small & (rough < 2.0**64)).tolist():
        value = sum((n * v - s) ** 2 for v, s in zip(y[i].tolist(), total, strict=True))
        out[i] = value if value < 1 << 63 else None
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of ``vectors(vec_id, embedding)``.

    ``weights`` is what a distinct vector weighs in the fit: its ``count`` of rows, or ``one``.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights is count or one")
    names = "vec_id, component, n, deviation, whitened, explained, identity_error"
    rows = materialise(
        vectors.selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding").mapInArrow(lambda batches: map(coded, batches), "vec_id long, x binary")
    )
    every = materialise(rows.groupBy("x").agg(F.count("*").alias("f")))
    length = F.expr("(length(x) - 1) div shiftleft(1, cast(conv(hex(substring(x, 1, 1)), 16, 10) as int))")
    usual = every.groupBy(length.alias("size")).agg(F.sum("f").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    if usual is None:
        return rows.select("vec_id").selectExpr("vec_id", "0 component", "0L n", "0L deviation", "0d whitened", "0d explained", "0d identity_error").limit(0)
    size, held = int(usual["size"]), int(usual["rows"])
    counted = every.filter(length == size)
    distinct = counted.select("x", F.lit(1).cast("long").alias("f") if weights == "one" else "f")

    n, total = sums(distinct, size)
    matrix = covariance(distinct, n, total)
    values, vectors_ = np.linalg.eigh(matrix)
    k = min(components, size)
    values, basis, trace = values[::-1][:k], vectors_[:, ::-1][:, :k], float(np.trace(matrix))
    live = values > max(trace, 0.0) * 1e-13
    mean, scaled = np.asarray([s / n for s in total]), basis[:, live] / np.sqrt(values[live])

    def run(batches):
        for batch, y, f in _batches(batches, size):
            z = np.full((len(y), k), np.nan)
            z[:, live] = (y - mean) @ scaled
            flat = pa.array(z.ravel(), mask=np.isnan(z).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, k), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f, pa.int64()), pa.array(deviations(y, n, total), pa.int64()), lists], names=["x", "f", "deviation", "z"])

    whitened = materialise(distinct.mapInArrow(run, "x binary, f long, deviation long, z array<double>"))
    error = _identity_error(whitened, n, np.flatnonzero(live), k)
    hot = materialise(counted.filter(f"f > {held // 1000}").select("x").join(whitened.drop("f"), "x"))  # fewer than a thousand rows
    discard(every)
    by_hot = rows.join(F.broadcast(hot), "x")
    by_key = rows.join(F.broadcast(hot.select("x")), "x", "left_anti").join(whitened.drop("f"), "x")
    shares = F.array(*[F.lit(float(v) / trace if trace > 0 else None).cast("double") for v in values])
    out = by_hot.unionByName(by_key).select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    out = out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
    return out.select(names.split(", "))


def _identity_error(whitened: DataFrame, n: int, live: np.ndarray, k: int) -> float | None:
    """Largest absolute entry of the weighted covariance of the whitened values minus the identity."""
    if not len(live):
        return None
    size = len(live)

    def run(batches):
        matrix = np.zeros((size + 1, size))
        for batch in batches:
            if batch.num_rows:
                z = np.asarray(batch.column(1).flatten().fill_null(0.0)).reshape(-1, k)[:, live]
                f = np.asarray(batch.column(0))
                matrix[:size] += (z * f[:, None]).T @ z
                matrix[size] += f @ z
        yield _rows(TaskContext.get().partitionId(), matrix)

    read = whitened.select("f", "z")
    matrix = sum_matrices(read.mapInArrow(run, _PARTS), read.rdd.getNumPartitions(), size + 1, size) / n
    return float(np.abs(matrix[:size] - np.outer(matrix[size], matrix[size]) - np.eye(size)).max())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
