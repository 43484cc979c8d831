"""Sum-of-squares packing of documents into token windows.

Every document becomes its token ids and an end id. Whole windows are cut off its
front; the remainder is an item of size 1..window-1, which goes to the fill level that
leaves the sum of squared counts of partially filled windows smallest (level 0 opens a
window). The counts are one array indexed by level. Each input partition packs its own
stream, in file order, so nothing is shuffled. When a stream ends, every window still open
keeps what lies in it and is filled from the emptiest ones, whose pieces are cut where a
window is full; so what moves is as much as the open windows had room for. What is left
over at last is cut at powers of two, which need no padding.

Null and empty texts hold the end id alone. Repeated rows and repeated doc_ids are
packed as rows of their own; a null doc_id stays null. Extra columns, whatever their
names, are not read; an empty table gives no rows. A very long text is cut into whole
windows as it comes; ties between levels go to the fullest window.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .store import table

WINDOW = 1024
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str, cached_words: int = 400_000) -> Callable[[str], bytes]:
    """Text -> little-endian unsigned 32-bit ids of the vocabulary file at ``path``.

    A space between two characters that aren't white space always begins a pre-token, so a
    text is cut before each of them, and frequent words come from a bounded cache. Special
    tokens' strings give their ids, as the vocabulary file says.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    bpe = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    allowed = set(special)

    def whole(text: str) -> bytes:
        return np.asarray(bpe.encode(text, allowed_special=allowed), "<u4").tobytes()

    cache: dict[str, bytes] = {}

    near, single = re.compile(r" (?:(?=\s)|(?<=\s ))").search, re.compile(r"(?<=\S) (?=\S)")

    def encode(text: str) -> bytes:
        words = single.split(text) if near(text) or text[:1] == " " or text[-1:] == " " else text.split(" ")
        out = [whole(words[0])]
        find = cache.get
        for word in words[1:]:
            ids = find(word)
            if ids is None:
                ids = whole(" " + word)
                if len(word) < 40:
                    if len(cache) >= cached_words:
                        cache.clear()
                    cache[word] = ids
            out.append(ids)
        return b"".join(out)

    return encode


class SumOfSquares:
    """Levels of partially filled windows, and what lies in them."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.inside: dict[int, list] = {}
        self.windows = 0

    def new(self) -> int:
        self.windows += 1
        return self.windows - 1

    def level_for(self, size: int) -> int:
        """The fill level to put ``size`` on: moving a window from h to h+size changes the sum by 2(N[h+size]-N[h])+2, opening one by 2N[size]+1, filling one by 1-2N[h]."""
        n, top = self.counts, self.window - size
        change = 2 * (n[size : self.window + 1] - n[: top + 1]) + 2
        change[0] = 2 * n[size] + 1
        change[top] = 1 - 2 * n[top]
        held = n[: top + 1] > 0
        held[0] = True
        change[~held] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))  # ties: the fullest window

    def place(self, size: int, piece) -> tuple[int, list] | None:
        """Put a piece in; the window and its pieces, once full."""
        level = self.level_for(size)
        if level:
            at = self.open[level].pop()
            self.counts[level] -= 1
        else:
            at = self.new()
            self.inside[at] = []
        self.inside[at].append(piece)
        if level + size == self.window:
            return at, self.inside.pop(at)
        self.counts[level + size] += 1
        self.open[level + size].append(at)
        return None

    def left(self) -> list[tuple[int, int]]:
        """(window, level) of the windows that stay open, fullest first."""
        return [(at, level) for level in range(self.window - 1, 0, -1) for at in self.open[level]]


def _row(doc, start, ids, total, window, offset):
    return doc, start, len(ids) // 4, zlib.crc32(ids), total, window, offset


def pack_stream(docs: Iterator[tuple[int, bytes]], window: int) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, crc, doc_tokens, window, offset) of (doc_id, ids as bytes)."""
    bins = SumOfSquares(window)
    full = 4 * window

    def closed(at, pieces):
        offset = 0
        for doc, start, ids, total in pieces:
            yield _row(doc, start, ids, total, at, offset)
            offset += len(ids) // 4

    for doc, ids in docs:
        total, cut = len(ids) // 4, len(ids) // full * full
        for b in range(0, cut, full):
            yield _row(doc, b // 4, ids[b : b + full], total, bins.new(), 0)
        if cut < len(ids):
            done = bins.place(total - cut // 4, (doc, cut // 4, ids[cut:], total))
            if done:
                yield from closed(*done)

    rest = bins.left()
    giving: list = []  # pieces of the window that is taken apart, the last one first
    i, j = 0, len(rest)
    while i < j:
        at, level = rest[i]
        i += 1
        own, room = bins.inside[at], window - level
        while room and (giving or i < j):
            if not giving:
                j -= 1
                giving = bins.inside[rest[j][0]][::-1]
            doc, start, ids, total = giving.pop()
            take = min(room, len(ids) // 4)
            own.append((doc, start, ids[: 4 * take], total))
            if len(ids) > 4 * take:
                giving.append((doc, start + take, ids[4 * take :], total))
            room -= take
        if not room:
            yield from closed(at, own)
        else:
            giving = own[::-1]
    tokens = sum(len(p[2]) for p in giving) // 4
    room, at, offset = 0, None, 0
    while giving:
        doc, start, ids, total = giving.pop()
        while ids:
            if not room:  # the largest power of two that can still be filled
                at, offset = bins.new(), 0
                room = 1 << (tokens.bit_length() - 1)
            take = min(room, len(ids) // 4)
            yield _row(doc, start, ids[: 4 * take], total, at, offset)
            ids, start, offset, room, tokens = ids[4 * take :], start + take, offset + take, room - take, tokens - take


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = 0, path: str | None = None) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``sequence_id`` is the input partition's number times 2^40 plus the window's number
    in it. ``window`` is a power of two. A lost task packs the same partition again, with
    the same rows.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two of at least 2")

    def run(batches):
        encode = encoder(path or vocabulary_path())
        end = np.asarray([end_id], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 40

        def ids():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield doc, encode(text.as_py() or "") + end

        names, rows = [f.split()[0] for f in SCHEMA.split(", ")], []

        def out():
            columns = list(zip(*rows, strict=True))
            columns[5] = [base + x for x in columns[5]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for row in pack_stream(ids(), window):
            rows.append(row)
            if len(rows) == 8192:
                yield out()
                rows.clear()
        if rows:
            yield out()

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
