"""Vector columns in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_of(column: pa.Array, zero: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, offsets, usable) of a list column in double precision: usable rows are not null, hold finite components only and, unless ``zero``, are not empty or all zero."""
    column = column.cast(pa.large_list(pa.float64()))
    off = np.asarray(column.offsets) if len(column) else np.zeros(1, np.int64)
    flat = column.values
    holes = np.asarray(flat.is_null()) if len(flat) else np.zeros(0, bool)
    values = np.asarray(flat.fill_null(0.0)) if len(flat) else np.zeros(0)
    bad = np.concatenate(([0], np.cumsum(holes | ~np.isfinite(values))))
    some = np.concatenate(([0], np.cumsum(values != 0)))
    ok = ~np.asarray(column.is_null()) & (bad[off[1:]] == bad[off[:-1]]) & (zero | (some[off[1:]] > some[off[:-1]]))
    return values, off, ok


def matrix(rows: list[bytes], dtype=np.float64) -> np.ndarray:
    """Rows of equal size, stored as bytes, as one matrix."""
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def sum_matrices(parts: DataFrame, tasks: int, height: int, width: int, fan: int = 32) -> np.ndarray:
    """Sum of the matrices that ``tasks`` tasks give as ``parts(node, i, row)``, node being the task's number and row doubles.

    ``fan`` tasks' matrices meet in one task, and so on up a tree; the driver reads the sum
    alone. Matrices travel row by row, so a batch holds rows, not matrices.
    """

    def add(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for node, i, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node not in found:
                    found[node] = np.zeros((height, width))
                found[node][i] += np.frombuffer(row)
        for node, matrix in found.items():
            columns = [pa.array([node] * height, pa.int64()), pa.array(range(height), pa.int32()), pa.array([r.tobytes() for r in matrix], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "i", "row"])

    while True:
        tasks = -(-tasks // fan)
        parts = parts.withColumn("node", F.expr(f"node div {fan}")).repartition(max(1, tasks), "node").mapInArrow(add, parts.schema)
        if tasks <= 1:
            break
    total = np.zeros((height, width))
    for r in parts.collect():
        total[r.i] += np.frombuffer(r.row)
    return total
