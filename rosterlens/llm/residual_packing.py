"""Hierarchical residual packing of documents into token sequences.

Every document becomes its token ids and an end id; one that is longer than a sequence is
cut into whole sequences and a last piece. Each input partition places its pieces best-fit,
longest first, into bins of its own and emits bins that are nearly full. Bins that aren't
become items: groups of ``FAN`` neighbouring partitions place their bins best-fit into one
another, again emit what is nearly full, and pass the rest to the next level of the tree,
until one group is left. What moves up the tree are three numbers a bin, never ids.

A piece lies in one bin, so a bin's pieces keep their order and distances when the bin is
put behind another; ``shift`` carries how far.

Null and empty texts hold the end id alone. Repeated rows and repeated doc_ids are packed
as rows of their own; a null doc_id stays null. Extra columns, whatever their names, are not
read; an empty table gives no rows. A very long text is encoded in parts and cut into whole
sequences. Ties in length are placed in file order, ties in room go to the newest bin.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packing import vocabulary_path
from .store import materialise, table
from .wordpieces import word_encoder

WINDOW = 4096
FAN = 16
#: A bin with at most this share of room is emitted at once.
NEARLY = 1 / 64
#: Pieces that a partition places together, and bins that a group passes up at most (the fullest are emitted first).
RUN, CARRIED = 1 << 18, 1 << 18
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long"
_OPEN = "bin long, into long, shift long, fill long, grp long, done boolean"


def best_fit(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every size, and the fill of every bin; the largest sizes are placed first, each where the least room stays.

    The rooms that some bin has are the bits of one number, so the least room that suffices
    is its lowest set bit from the size on.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fills: list[int] = []
    having: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = 0
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = having[room].pop()
            if not having[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fills), window
            fills.append(0)
        bins[at], offsets[at] = b, window - room
        room -= size
        fills[b] = window - room
        if room:
            having[room].append(b)
            rooms |= 1 << room
    return bins, offsets, np.asarray(fills, np.int64)


def pieces(doc, ids: bytes, window: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, crc) of a document's ids."""
    for n, b in enumerate(range(0, len(ids), 4 * window)):
        cut = ids[b : b + 4 * window]
        yield doc, n, b // 4, len(cut) // 4, zlib.crc32(cut)


def one_round(window: int, nearly: int, carried: int, last: bool):
    return lambda group: merge_bins(group, window, nearly, carried, last)


def merge_bins(batch: pa.Table, window: int, nearly: int, carried: int, last: bool) -> pa.Table:
    """One best-fit round of a group: its current bins are the items; members keep their distance within them."""
    cols = {c: np.asarray(batch.column(c).combine_chunks()) for c in ("bin", "into", "shift", "fill")}
    items, first, of = np.unique(cols["into"], return_index=True, return_inverse=True)
    target, offset, fills = best_fit(cols["fill"][first], window)
    name = np.zeros(len(fills), np.int64)
    name[target[offset == 0]] = items[offset == 0]  # a bin is called like the one it begins with
    fill = fills[target][of]
    done = np.full(len(of), last) | (fill >= window - nearly)
    if not last and (~done).sum() > carried:
        order = np.lexsort((cols["into"], np.where(done, window + 1, fill)))
        done[order[np.cumsum(~done[order]) > carried]] = True
        whole = np.bincount(target[of], done, len(fills)) > 0  # a bin goes as a whole
        done |= whole[target[of]]
    grp = np.asarray(batch.column("grp").combine_chunks())
    return pa.table({"bin": cols["bin"], "into": name[target][of], "shift": cols["shift"] + offset[of], "fill": fill, "grp": grp, "done": done})


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = 1, path: str | None = None, fan: int = FAN, run: int = RUN, carried: int = CARRIED) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A bin's number is its partition's number times 2^40 plus its own in the partition; a
    lost task gives the same bins again. ``run`` bounds what a task holds, ``carried`` what
    a group passes up; bins beyond it are emitted as they are.
    """
    nearly = int(window * NEARLY)

    def local(batches):
        encode = word_encoder(path or vocabulary_path("word_bpe_49k.json"))
        end = np.asarray([end_id], "<u4").tobytes()
        base, used, held = TaskContext.get().partitionId() << 40, 0, []
        names = [f.split()[0] for f in _PLACED.split(", ")]
        types = [pa.int32() if n == "piece" else pa.int64() for n in names]

        def placed():
            nonlocal used
            columns = list(zip(*held, strict=True))
            bins, offsets, fills = best_fit(np.asarray(columns[3], np.int64), window)
            rows = [*columns, base + used + bins, offsets, fills[bins]]
            used += len(fills)
            held.clear()
            whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)
            for at in range(0, whole.num_rows, 16384):
                yield whole.slice(at, 16384)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for piece in pieces(doc, encode(text.as_py() or "") + end, window):
                    held.append(piece)
                    if len(held) == run:
                        yield from placed()
        if held:
            yield from placed()

    placed = materialise(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(local, _PLACED))
    under = f"fill < {window - nearly}"
    level = placed.filter(f"offset = 0 and {under}").selectExpr("bin", "bin into", "0L shift", "fill", "shiftright(bin, 40) grp", "false done")
    groups = (level.agg(F.max("grp")).first()[0] or 0) + 1
    levels = []
    while True:
        groups = -(-groups // fan)
        last = groups == 1
        merged = level.filter("not done").withColumn("grp", F.expr(f"grp div {fan}"))
        level = materialise(merged.groupBy("grp").applyInArrow(one_round(window, nearly, carried, last), _OPEN))
        levels.append(level)
        if last:
            break
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    closed = placed.filter(f"not ({under})").withColumn("sequence_id", F.col("bin")).select(names)
    moved = reduce(DataFrame.unionByName, [x.filter("done").select("bin", "into", "shift") for x in levels])
    opened = placed.filter(under).join(moved, "bin").withColumns({"sequence_id": F.col("into"), "offset": F.col("offset") + F.col("shift")}).select(names)
    return closed.unionByName(opened)


def op12_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
