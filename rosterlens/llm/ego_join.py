"""Links between vectors of one label by an epsilon grid order join.

Unit vectors at cosine c lie at distance sqrt(2-2c) of each other: that is epsilon. The
vectors are turned to their principal axes, and sorted by label and the epsilon-grid cell
on the leading axes: the grid order. Spark range-partitions that order and cuts it into
blocks, sequence intervals with a bounding box. Two intervals meet if their cells on
the first axis can be neighbours and their boxes are within epsilon. A pair of intervals
is halved recursively, and parts whose boxes are further apart are skipped; what is left
is compared in double precision on the original axes.

Equal vectors of a label are one node that counts as often as it occurs. A pair of
intervals gives link counts and, by union-find, one edge for each linked vector to the
smallest vector it reaches in the pair, so that dense groups send no list of pairs.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a
null label or vec_id, link with nothing. Others are divided by their largest magnitude
before their length is taken, so the smallest and largest doubles link like any others.
Labels of any type are equal if they are equal as text. Vectors of different length never
link; the axes are those of the first 1024 components, so one wide vector costs itself
only. A cosine of exactly the bound links. Repeated rows are equal vectors: each row counts
as another vector. Other columns,
whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .store import materialise, table
from .vectors import matrix, rows_of, sum_matrices

BLOCK = 4096
LEAF = 256
AXES = 4  # of the grid
BOX = 12  # of the boxes
WIDEST = 1024  # components that the axes are taken from


def _unit_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, key, vec): ``vec`` holds the components as doubles, ``key`` identifies label and vector; both null where the row takes no part."""

    def run(batches):
        for batch in batches:
            values, off, ok = rows_of(batch.column(2))
            ok &= ~np.asarray(batch.column(0).is_null()) & ~np.asarray(batch.column(1).is_null())
            raw = [np.ascontiguousarray(values[a:b]).tobytes() if good else None for a, b, good in zip(off, off[1:], ok)]
            keys = [None if r is None else hashlib.blake2b(r, digest_size=16, key=hashlib.blake2b(y.encode()).digest()).digest() for r, y in zip(raw, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["vec_id", "label", "key", "vec"])

    return vectors.selectExpr("cast(vec_id as long) vec_id", "cast(label as string) label", "cast(embedding as array<double>) embedding").mapInArrow(run, "vec_id long, label string, key binary, vec binary")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _axes(nodes: DataFrame, size: int) -> np.ndarray:
    """About the ``BOX`` strongest principal axes of the first ``size`` components, from sums of products over all vectors, added up a tree of tasks."""

    def run(batches):
        total = np.zeros((size + 1, size))
        for batch in batches:
            for rows in _same_length(batch.column(0).to_pylist()).values():
                x = _unit(matrix([r for _, r in rows]))[:, :size]
                total[: x.shape[1], : x.shape[1]] += x.T @ x
                total[size, : x.shape[1]] += x.sum(axis=0)
        node = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([node] * (size + 1), pa.int64()), pa.array(range(size + 1), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["node", "i", "row"])

    read = nodes.select("vec")
    out = sum_matrices(read.mapInArrow(run, "node long, i int, row binary"), read.rdd.getNumPartitions(), size + 1, size)
    n = max(1.0, float(np.trace(out[:size])))  # about the number of vectors, as they are of length 1
    mean = out[size] / n
    spread = out[:size] / n - np.outer(mean, mean)
    axes, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(size, min(BOX, size))))
    for _ in range(40):  # orthonormal at every step, so how near they come to the principal ones bears on speed alone
        axes, _ = np.linalg.qr(spread @ axes)
    return axes


def _same_length(raw: list[bytes]) -> dict[int, list[tuple[int, bytes]]]:
    out: dict[int, list] = {}
    for i, r in enumerate(raw):
        out.setdefault(len(r), []).append((i, r))
    return out


def _turned(unit: np.ndarray, axes: np.ndarray, n: int) -> np.ndarray:
    """Places of unit vectors on the leading axes; distances there are no larger than those of the vectors."""
    return unit[:, : len(axes)] @ axes[: unit.shape[1], :n]


_BLOCK = "label string, width int, block long, low array<double>, high array<double>, ids binary, times binary, vecs binary"


def _blocks(nodes: DataFrame, axes: np.ndarray, eps: float, most: int) -> DataFrame:
    """Sequence intervals of at most ``most`` vectors in grid order, with their boxes on the leading axes."""
    dims = min(AXES, axes.shape[1])

    def cells(batches):
        for batch in batches:
            raw = batch.column(3).to_pylist()
            grid = np.zeros((len(raw), dims), np.int64)
            for rows in _same_length(raw).values():
                at = [i for i, _ in rows]
                y = _turned(_unit(matrix([r for _, r in rows])), axes, dims)
                grid[at, : y.shape[1]] = np.floor(y / eps)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(grid[:, i]) for i in range(dims))], names=["id", "label", "times", "vec", *(f"c{i}" for i in range(dims))])

    def cut(batches):
        number = TaskContext.get().partitionId() << 40
        held: list = []
        key = None

        def block():
            nonlocal number
            x = matrix([h[2] for h in held])
            y = _turned(_unit(x), axes, BOX)
            number += 1
            return [key[0], key[1], number - 1, y.min(axis=0).tolist(), y.max(axis=0).tolist(), np.asarray([h[0] for h in held], np.int64).tobytes(), np.asarray([h[1] for h in held], np.int64).tobytes(), x.tobytes()]

        def out(rows):
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in _BLOCK.split(", ")])

        for batch in batches:
            rows = []
            for i, label, times, vec in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
                if held and (key != (label, len(vec)) or len(held) == most):
                    rows.append(block())
                    held.clear()
                key = (label, len(vec))
                held.append((i, times, vec))
            if rows:
                yield out(rows)
        if held:
            yield out([block()])

    order = ["label", F.length("vec"), *(f"c{i}" for i in range(dims)), "id"]
    kinds = "id long, label string, times long, vec binary, " + ", ".join(f"c{i} long" for i in range(dims))
    ordered = nodes.select("id", "label", "times", "vec").mapInArrow(cells, kinds).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ordered.select("id", "label", "times", "vec").mapInArrow(cut, _BLOCK))


def _meet(x, y, a: slice, b: slice, px, py, least: float, eps: float, out: list) -> None:
    """Links between two sequence intervals: (positions in x, positions in y)."""
    gap = np.maximum(0, np.maximum(px[a].min(axis=0) - py[b].max(axis=0), py[b].min(axis=0) - px[a].max(axis=0)))
    if (gap * gap).sum() > eps * eps:
        return
    n, m = a.stop - a.start, b.stop - b.start
    if n <= LEAF and m <= LEAF:
        i, j = np.nonzero(x[a] @ y[b].T >= least)
        if len(i):
            out.append((i + a.start, j + b.start))
        return
    if n >= m:
        mid = (a.start + a.stop) // 2
        _meet(x, y, slice(a.start, mid), b, px, py, least, eps, out)
        _meet(x, y, slice(mid, a.stop), b, px, py, least, eps, out)
    else:
        mid = (b.start + b.stop) // 2
        _meet(x, y, a, slice(b.start, mid), px, py, least, eps, out)
        _meet(x, y, a, slice(mid, b.stop), px, py, least, eps, out)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable over the links, for each of n positions."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _linked(pairs: DataFrame, axes: np.ndarray, cosine: float, eps: float) -> DataFrame:
    """(id, root, links) of the linked vectors of every pair of intervals."""

    def run(batches):
        for batch in batches:
            for same, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ia, ta, va, ib, tb, vb = cells
                ia, ib = np.frombuffer(ia, np.int64), np.frombuffer(ib, np.int64)
                ta, tb = np.frombuffer(ta, np.int64), np.frombuffer(tb, np.int64)
                x, y = np.frombuffer(va).reshape(len(ia), -1), np.frombuffer(vb).reshape(len(ib), -1)
                x, y = _unit(x), _unit(y)
                found: list = []
                _meet(x, y, slice(0, len(x)), slice(0, len(y)), _turned(x, axes, BOX), _turned(y, axes, BOX), cosine, eps, found)
                if not found:
                    continue
                i, j = (np.concatenate(c) for c in zip(*found, strict=True))
                if same:
                    i, j = i[i != j], j[i != j]
                    ids, links = ia, np.bincount(i, tb[j], len(ia))
                    root = _roots(len(ia), i, j)
                else:
                    ids = np.concatenate([ia, ib])
                    links = np.concatenate([np.bincount(i, tb[j], len(ia)), np.bincount(j, ta[i], len(ib))])
                    root = _roots(len(ids), i, j + len(ia))
                best = np.full(len(ids), np.iinfo(np.int64).max)
                np.minimum.at(best, root, ids)
                on = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(best[root][on]), pa.array(links[on].astype(np.int64))], names=["id", "root", "links"])

    return materialise(pairs.mapInArrow(run, "id long, root long, links long"))


def similar(vectors: DataFrame, cosine: float = 0.93, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors(vec_id, label, embedding)``: vec_id, n_links, component_id, kept."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-12)
    rows = materialise(_unit_rows(vectors))
    nodes = materialise(
        rows.filter("key is not null").groupBy("key")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("times"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    )
    size = nodes.agg(F.max(F.length("vec"))).first()[0]
    if size is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    axes = _axes(nodes, min(WIDEST, size // 8))
    blocks = _blocks(nodes, axes, eps, block)
    pairs = _pairs(blocks, eps)
    data = blocks.select("block", "ids", "times", "vecs")
    a, b = (data.select(F.col("block").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("ids", "times", "vecs"))) for s in "ab")
    met = _linked(
        pairs.join(a, "a").join(b, "b").repartition("a", "b").select(F.expr("a = b").alias("same"), "ids_a", "times_a", "vecs_a", "ids_b", "times_b", "vecs_b"),
        axes, cosine, eps,
    )
    degree = met.groupBy("id").agg(F.sum("links").alias("links"))
    classes = components(met.filter("id <> root").selectExpr("id a", "root b"))
    named = materialise(nodes.select("key", "id", "times").join(degree, "id", "left").join(classes, "id", "left"))
    return rows.select("vec_id", "key").join(named, "key", "left").select(
        "vec_id",
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("times") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "id", "vec_id"), F.lit(True)).alias("kept"),
    )


def _pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs (a, b) of intervals whose boxes are within epsilon; found over the cells of the first axis."""
    meta = blocks.select("label", "width", "block", "low", "high")
    cell = lambda c: f"cast(floor({c}[0] / {eps!r}) as int)"
    a = meta.select("label", "width", F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.explode(F.expr(f"sequence({cell('low')} - 1, {cell('high')} + 1)")).alias("cell"))
    b = meta.select("label", "width", F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.explode(F.expr(f"sequence({cell('low')}, {cell('high')})")).alias("cell"))
    gap = F.expr(
        "aggregate(sequence(0, size(low_a) - 1), 0D, (t, i) -> t + pow(greatest(0D, low_a[i] - high_b[i], low_b[i] - high_a[i]), 2))"
    )
    return materialise(a.join(b, ["label", "width", "cell"]).filter((F.col("a") <= F.col("b")) & (gap <= eps * eps)).select("a", "b").distinct())


def op3_ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "embeddings"))
