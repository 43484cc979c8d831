"""Nearest neighbours by inner product with additive quantisation.

A vector is the sum of one word of each of several full-dimensional codebooks. The
books start as k-means of the residuals left by the books before, and are refitted by
least squares to the codes of a beam search; the sample they are fitted on is bounded
(``sample`` rows with the smallest hash of vec_id, of at most ``sample_bytes``). Vectors are
coded by direction, so no row's magnitude bears on another's code; every vector is encoded
by beam search and stored as codes with its norm. A query scores a block of codes by table
lookup (its inner product with every word, corrected by the stored norm), takes the best
``shortlist`` different vectors of the block, and scores those exactly in double
precision on the original vectors.

All rows are dealt by a hash of vec_id to groups of about ``block`` rows, a number that
grows with the table; every block of queries meets every group once, as one row of a join
on the group. A group's answer to a query is its best ``k`` rows; the answers of all
groups are merged. Equal vectors count once in a shortlist and come back with their
smallest ids.

Rows that are null, empty, zero, or hold null or non-finite components take no part, nor
do rows without vec_id. Inner products exist between vectors of one length only: those of
the most frequent length are indexed, those of any other are scored exactly within their
length. Rows that repeat a vec_id count once: with different vectors, that of the most
frequent length, then the one with the smallest bytes counts, as query and as candidate.
Equal scores come in the order of vec_id. A length has no bound but a task's memory.
Other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialise, table
from .vectors import matrix, rows_of

BOOKS, WORDS, BEAM = 16, 64, 4


@dataclass
class Books:
    words: np.ndarray  # (books, words, dims)

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Codes (rows, books) of a beam search for the smallest distance to the sum of words."""
        books, words, _ = self.words.shape
        flat = self.words.reshape(books * words, -1)
        dot, cross = x @ flat.T, flat @ flat.T
        square = np.diag(cross)
        cross = cross.reshape(books, words, books, words)
        n = len(x)
        codes = np.zeros((n, 1, 0), np.int64)
        cost = np.zeros((n, 1))
        rows = np.arange(n)[:, None]
        for m in range(books):
            at = slice(m * words, (m + 1) * words)
            step = (square[at] - 2 * dot[:, at])[:, None, :] + cost[:, :, None]
            for b in range(m):
                step = step + 2 * np.ascontiguousarray(cross[b, :, m])[codes[:, :, b]]
            flat_cost = step.reshape(n, -1)
            keep = min(beam, flat_cost.shape[1])
            best = np.argpartition(flat_cost, keep - 1, axis=1)[:, :keep]
            cost = flat_cost[rows, best]
            codes = np.concatenate([codes[rows, best // words], (best % words)[:, :, None]], axis=2)
        return codes[np.arange(n), cost.argmin(axis=1)].astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.words[m][codes[:, m]] for m in range(len(self.words)))


def _means(x: np.ndarray, words: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), words, replace=len(x) < words)] + 0.0
    for _ in range(rounds):
        own = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        size = np.bincount(own, minlength=words)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], x[rng.integers(len(x), size=words)])
    return c


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, refits: int = 2, seed: int = 7) -> Books:
    """Codebooks of a sample: residual k-means, then least squares on beam-search codes."""
    rng, rest, out = np.random.default_rng(seed), x.astype(float), []
    for _ in range(books):
        c = _means(rest, words, rng)
        own = ((c * c).sum(axis=1) - 2 * rest @ c.T).argmin(axis=1)
        rest = rest - c[own]
        out.append(c)
    found = Books(np.stack(out))
    for _ in range(refits):
        codes = found.encode(x)
        place = codes + np.arange(books) * words
        one = np.zeros((len(x), books * words))
        one[np.arange(len(x))[:, None], place] = 1.0
        gram = one.T @ one + 1e-2 * np.eye(books * words)
        pull = one.T @ x + 1e-2 * found.words.reshape(books * words, -1)
        found = Books(np.linalg.solve(gram, pull).reshape(found.words.shape))
    return found


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times the power of two that brings their largest component below one, and the exponents taken out."""
    powers = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -powers[:, None]), powers


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and the lengths they had."""
    y, powers = scaled(x)
    lengths = np.linalg.norm(y, axis=1)
    with np.errstate(over="ignore"):
        return y / lengths[:, None], np.minimum(np.ldexp(lengths, powers), np.finfo(float).max)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) of rows that take part; ``vec`` holds the components as doubles."""

    def run(batches):
        for batch in batches:
            values, off, ok = rows_of(batch.column(1))
            ok &= ~np.asarray(batch.column(0).is_null())
            at = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([np.ascontiguousarray(values[off[i] : off[i + 1]]).tobytes() for i in at], pa.binary())], names=["vec_id", "vec"])

    return vectors.selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding").mapInArrow(run, "vec_id long, vec binary")


_INDEX = "part long, ids binary, codes binary, norms binary, vecs binary"


def index(rows: DataFrame, books: Books | None, parts: int) -> DataFrame:
    """One row per group: ids, codes, stored norm corrections and vectors of all its rows, equal vectors side by side. Without books, groups are of one length and hold no codes."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        held: dict[int, dict[int, bytes]] = {}
        part = None
        for batch in batches:
            for p, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part is not None and p != part:
                    yield out(part, held.pop(part))
                part = p
                held.setdefault(p, {})[i] = v
        if part is not None:
            yield out(part, held.pop(part))

    def out(part, rows_):
        order = sorted(rows_, key=lambda i: (rows_[i], i))
        x = matrix([rows_[i] for i in order])
        if shared.value is None:
            codes, scale = np.zeros((len(x), 0), np.uint8), np.ones(len(x))
        else:
            unit, lengths = directions(x)
            codes = shared.value.encode(unit)
            near = np.linalg.norm(shared.value.decode(codes), axis=1)
            scale = lengths / np.where(near > 0, near, 1)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *(pa.array([b.tobytes()], pa.binary()) for b in (np.asarray(order, np.int64), codes, scale, x))], names=["part", "ids", "codes", "norms", "vecs"])

    return rows.select(_part(parts), "vec_id", "vec").repartition(F.col("part")).sortWithinPartitions("part").mapInArrow(run, _INDEX)


def _part(parts: int):
    """Group of a row: its length in the high bits, a hash of vec_id in the low ones."""
    return F.expr(f"shiftleft(cast(length(vec) as long), 24) + pmod(xxhash64(vec_id), {parts})").alias("part")


def _query_blocks(rows: DataFrame, every: int, most: int) -> DataFrame:
    """(width, qids, qvecs): blocks of at most ``most`` queries of one length, cut within partitions."""

    def run(batches):
        ids: list = []
        vecs: list = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([len(vecs[0])], pa.int64()), pa.array([np.asarray(ids, np.int64).tobytes()], pa.binary()), pa.array([b"".join(vecs)], pa.binary())], names=["width", "qids", "qvecs"])

        for batch in batches:
            for i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (len(ids) == most or len(v) != len(vecs[0])):
                    yield out()
                    ids.clear()
                    vecs.clear()
                ids.append(i)
                vecs.append(v)
        if ids:
            yield out()

    return rows.filter(f"vec_id % {every} = 0").select("vec_id", "vec").sortWithinPartitions(F.length("vec")).mapInArrow(run, "width long, qids binary, qvecs binary")


def _answers(joined: DataFrame, books: Books | None, k: int, shortlist: int) -> DataFrame:
    """(query_id, vec_id, score): the best k rows of every group for every query of a block; without books every row of the group is on the shortlist."""
    shared = joined.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        m = w = 0
        if shared.value is not None:
            words = shared.value.words
            m, w, _ = words.shape
            flat = words.reshape(m * w, -1)
        for batch in batches:
            for ids, codes, norms, vecs, qids, qvecs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, norms = np.frombuffer(ids, np.int64), np.frombuffer(norms)
                codes, x = np.frombuffer(codes, np.uint8).reshape(len(ids), m), np.frombuffer(vecs).reshape(len(ids), -1)
                qids, q = np.frombuffer(qids, np.int64), np.frombuffer(qvecs).reshape(len(qids) // 8, -1)
                new = np.ones(len(ids), bool)
                new[1:] = (x[1:] != x[:-1]).any(axis=1)
                lead = np.flatnonzero(new)
                until = np.append(lead[1:], len(ids))
                (q, q_powers), (x, x_powers) = scaled(q), scaled(x)
                place = codes[lead] + np.arange(m) * w
                keep = min(shortlist, len(lead)) if m else len(lead)
                for a in range(0, len(q), 64):
                    part = q[a : a + 64]
                    if m:
                        look = np.ascontiguousarray((part @ flat.T).T)
                        near = look[place[:, 0]]
                        for b in range(1, m):
                            near = near + look[place[:, b]]
                        near = (near * norms[lead][:, None]).T
                        best = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
                    else:
                        best = np.tile(np.arange(len(lead)), (len(part), 1))
                    with np.errstate(over="ignore"):
                        score = np.ldexp((part[:, None, :] * x[lead[best]]).sum(axis=2), q_powers[a : a + 64, None] + x_powers[lead[best]])
                    out_q, out_v, out_s = [], [], []
                    for row, (qid, b, s) in enumerate(zip(qids[a : a + 64], best, score, strict=True)):
                        left = k
                        for c in np.lexsort((ids[lead[b]], -s)):
                            if left <= 0 and s[c] < bar:
                                break
                            own = ids[lead[b[c]] : min(until[b[c]], lead[b[c]] + k + 1)]
                            own = own[own != qid][:k]
                            out_q += [qid] * len(own)
                            out_v += own.tolist()
                            out_s += [s[c]] * len(own)
                            left -= len(own)
                            bar = s[c]
                    yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())], names=["query_id", "vec_id", "score"])

    return joined.select("ids", "codes", "norms", "vecs", "qids", "qvecs").mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, sample: int = 8192, sample_bytes: int = 64 << 20, block: int = 4096, query_block: int = 512, shortlist: int = 384) -> DataFrame:
    """The k nearest rows found of every row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score."""
    given = materialise(usable(vectors))
    spark = vectors.sparkSession
    sizes = given.groupBy(F.length("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(2).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, n = sizes[0]["n"], sizes[0]["count"]
    # an id counts once
    rows = materialise(given.groupBy("vec_id").agg(F.min(F.struct((F.length("vec") != size).alias("other"), "vec")).alias("own")).select("vec_id", "own.vec"))
    usual = F.length("vec") == size
    picked = rows.filter(usual).orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(sample, sample_bytes // size))).toPandas()
    books = fit(directions(matrix(list(picked["vec"])))[0])

    def search(own: DataFrame, books: Books | None, parts: int) -> DataFrame:
        data = materialise(index(own, books, parts))
        queries = _query_blocks(own, every, query_block).withColumn("part", F.explode(F.expr(f"transform(sequence(0L, {parts - 1}L), p -> shiftleft(width, 24) + p)")))
        return _answers(data.join(queries, "part"), books, k, shortlist)

    found = search(rows.filter(usual), books, -(-n // block))
    if len(sizes) > 1:
        found = found.unionByName(search(rows.filter(~usual), None, -(-given.filter(~usual).count() // block)))
    best = materialise(found).withColumn("rank", F.expr("cast(row_number() over (partition by query_id order by score desc, vec_id) as int)"))
    return best.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
