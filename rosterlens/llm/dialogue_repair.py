"""Repair of conversation structure by rank-convergence parallel Viterbi.

A conversation's rows, in the order of turn (nulls first), role and text, are repaired by
the cheapest edits that leave role initials ``(s?(ua)+)?``: keep 0, rerole to user or
assistant 2, delete 3 (required where a row is blank or repeats an earlier role and text),
insert an empty user or assistant row 2; a truncated row that stays adds 1. Among equals the
ASCII-least sequence of edit initials wins. The states of the search are what the kept rows
so far end in: nothing, ``s``, ``u`` or ``a``.

Rows are sorted over the whole table and cut into chunks, so a long conversation is spread
over many tasks. Every chunk runs backward from a speculative vector of costs of the four
states. Fix-up passes give each chunk the vector its successor arrived at; it reruns beside
its earlier run only until both differ by a constant, from where on the earlier one holds.
Passes go on until no vector changes. Chunks that still change after ``PASSES`` passes (a
run of rows that all say user never loses the guess) give the costs of their four states
instead, which are put together in order, from a conversation's last chunk to its first.
The stitched costs are exact but for a constant, which is all that tracing needs: a walk
over chunks finds each one's first state, then every chunk traces its own edits.

Rows equal in conv_id, turn, role and text are counted before they are moved; a repeat is
deleted, which costs the same in every state and is no step of the search. ``repaired_sha256``
and ``audit`` are one value of a whole conversation, so its texts at last stream through one
task in order, one at a time.

A null turn comes first and counts for no gap; null conv_ids are one conversation, its id
null; a null role or text is one space. Repeated rows are duplicates. Texts are read whole.
Other columns, whatever their names, are not read; an empty table gives no rows. Initials
are a role's first character as it is, an empty role has none; other initials can only be
reroled or deleted.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import discard, materialise, table

CHUNK = 4096
PASSES = 4
START, S, U, A = range(4)
_ROLES = {U: "user", A: "assistant"}
_NEXT = (U, U, A, U)  # the state after the row that may come next, which is user but for U
#: Costs of the states after a conversation's last row: nothing and ``a`` may end, the others insert first.
END = (0, 4, 2, 0)
_KEYS = ("absent", "conv_id", "late", "at", "role", "text")
_CONV = ("absent", "conv_id")
# Bits of a row's kind: its initial (0 none of sua, else the state), must go, truncated; and a mark of its own for a first occurrence.
_GO, _CUT, _FIRST = 4, 8, 16
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[S, U] = _LEGAL[U, A] = _LEGAL[A, U] = True
_FOUND = "absent boolean, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """absent, conv_id, late, at, role, text, times: the rows after damage, equal ones counted; absent and late tell null ids and turns."""
    text_id = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(F.encode(text_id, "UTF-8")) % 20).alias("harm"),
    ).filter("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select(
        F.isnull("conv_id").alias("absent"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.isnotnull("turn").alias("late"), F.coalesce("turn", F.lit(0)).alias("at"),
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("harm") == 3, 2).otherwise(1).alias("n"),
    )
    return rows.groupBy(*_KEYS).agg(F.sum("n").alias("times"))


def ordered(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows sorted over the whole table, each with its chunk ``seq`` (ascending), its place ``idx`` in it, and the row's own order of keys kept."""

    def run(batches):
        base, number, place, last = TaskContext.get().partitionId() << 32, -1, 0, None
        for batch in batches:
            absent, conv = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            seq, idx = [], []
            for key in zip(absent, conv, strict=True):
                if key != last or place == chunk:
                    number, place, last = number + 1, 0, key
                seq.append(base + number)
                idx.append(place)
                place += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seq, pa.int64()), pa.array(idx, pa.int32())], names=[*batch.schema.names, "seq", "idx"])

    schema = "absent boolean, conv_id long, late boolean, at long, role string, text string, times long, seq long, idx int"
    return rows.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(run, schema)


def _faults(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last character that isn't white space is none of ``.!?``."""
    end = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return end == "", ~F.substring(end, -1, 1).isin(".", "!", "?")


@lru_cache(maxsize=1 << 14)
def step(after: tuple[int, int, int, int], kind: int) -> tuple[tuple[int, int, int, int], int, str]:
    """(costs before a row less their least, that least, the edit initial of each state) from the costs after it.

    An initial names one edit in each state, as only one role can come next.
    """
    initial, go, cut = kind & 3, kind & _GO, 1 if kind & _CUT else 0
    cost, edits = [0, 0, 0, 0], ["", "", "", ""]
    for state in range(4):
        options = [(3 + after[state], "D")]
        if not go:
            if initial == _NEXT[state] or (initial == S and state == START):
                options.append((cut + after[initial], "K"))
            options.append((2 + cut + after[_NEXT[state]], "R"))
        cost[state] = min(options)[0]
        edits[state] = min(options)[1]
    for _ in range(3):  # inserting never pays more than three times in a row
        for state in range(4):
            other = 2 + cost[_NEXT[state]]
            if other < cost[state] or (other == cost[state] and edits[state] > "I"):
                cost[state], edits[state] = other, "I"
    least = min(cost)
    return tuple(c - least for c in cost), least, "".join(edits)


def run_back(kinds: bytes, vector: tuple) -> tuple[tuple, int]:
    """Costs of a chunk's states, less their least, and that least, from those after it."""
    total = 0
    for kind in reversed(kinds):
        vector, least, _ = step(vector, kind)
        total += least
    return vector, total


def fix_up(kinds: bytes, guess: tuple, vector: tuple, arrived: tuple) -> tuple[tuple, int]:
    """The same from another vector, beside the earlier run from ``guess``: once both are equal but for a constant, ``arrived`` holds; how many rows were rerun."""
    for i, kind in enumerate(reversed(kinds)):
        if guess == vector:
            return arrived, i
        guess, vector = step(guess, kind)[0], step(vector, kind)[0]
    return vector, len(kinds)


def spans(kinds: bytes) -> list[list[int]]:
    """Least cost from each first state to each last state of a chunk: four runs that may end in one state alone."""
    far = 1 << 20
    out = [[0] * 4 for _ in range(4)]
    for last in range(4):
        vector, total = [far] * 4, 0
        vector[last] = 0
        closed = _closed(tuple(vector))
        least = min(closed)
        vector, total = run_back(kinds, tuple(min(c - least, far) for c in closed))
        for first in range(4):
            out[first][last] = vector[first] + total + least
    return out


def _closed(vector: tuple) -> tuple:
    """Costs when rows may be inserted first."""
    cost = list(vector)
    for _ in range(3):
        for state in range(4):
            cost[state] = min(cost[state], 2 + cost[_NEXT[state]])
    return tuple(cost)


def _less(vector) -> tuple:
    least = min(vector)
    return tuple(int(v - least) for v in vector)


def trace(kinds: bytes, after: tuple, state: int, last: bool) -> tuple[str, int, int]:
    """(edit initials of a chunk, last state, cost) from its first state; rows are inserted at the very end only by the last chunk."""
    plan = []
    for kind in reversed(kinds):
        after_row = after
        after, _, edits = step(after, kind)
        plan.append((kind, edits, after_row))
    out, cost = [], 0
    for kind, edits, _ in reversed(plan):
        while edits[state] == "I":
            out.append("I")
            state, cost = _NEXT[state], cost + 2
        edit = edits[state]
        out.append(edit)
        if edit == "D":
            cost += 3
            continue
        cost += (1 if kind & _CUT else 0) + (2 if edit == "R" else 0)
        state = kind & 3 if edit == "K" else _NEXT[state]
    while last and END[state]:
        out.append("I")
        state, cost = _NEXT[state], cost + 2
    return "".join(out), state, cost


def _record(columns: dict, types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], names=list(types))


_INTS = pa.list_(pa.int32())


def chunked(rows: DataFrame) -> DataFrame:
    """seq, absent, conv_id, kinds, counts (blank, duplicate, truncated, illegal inside, first and last initial), prior and next seq of every chunk of ``ordered`` rows."""
    blank, cut = _faults(F.col("text"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(0) + F.when(blank, _GO).otherwise(0) + F.when(cut, _CUT).otherwise(0)
    own = rows.select("seq", *_CONV, F.struct("idx", kind.cast("int").alias("kind"), "times").alias("row"))
    first = rows.groupBy(*_CONV, "role", F.md5("text")).agg(F.min(F.struct("seq", "idx")).alias("at"))
    marks = first.select("at.seq", *_CONV, F.struct("at.idx", F.lit(_FIRST).alias("kind"), F.lit(0).cast("long").alias("times")).alias("row"))
    groups = own.unionByName(marks).groupBy("seq", *_CONV).agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            flat = lists.flatten()
            kinds, times = (np.asarray(flat.field(i)) for i in (1, 2))
            offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            out_kinds, out_counts = [], []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                k, t = kinds[lo:hi], times[lo:hi]
                base = k < _FIRST
                seen = ~np.append(k[1:] == _FIRST, False)[base]  # a first occurrence's mark follows its row
                k, t = k[base], t[base]
                gone, init = k & _GO > 0, k & 3
                stays = ~gone & ~seen
                short = stays & (k & _CUT > 0)
                out_kinds.append((init + _GO * ~stays + _CUT * short).astype(np.uint8).tobytes())
                illegal = int((t - 1).sum()) + int((~_LEGAL[init[:-1], init[1:]]).sum())
                out_counts.append([int(t[gone].sum()), int(t[~gone].sum() - stays.sum()), int(short.sum()), illegal, int(init[0]), int(init[-1])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(out_kinds, pa.binary()), pa.array(out_counts, pa.list_(pa.int64()))], names=["seq", *_CONV, "kinds", "counts"]
            )

    in_order = Window.partitionBy(*_CONV).orderBy("seq")
    made = groups.mapInArrow(run, "seq long, absent boolean, conv_id long, kinds binary, counts array<long>")
    return made.withColumns({"prior": F.lag("seq").over(in_order), "next": F.lead("seq").over(in_order)})


def _each(frame: DataFrame, schema: str, types: dict, function) -> DataFrame:
    """Rows that ``function`` gives for rows, as dicts."""

    def run(batches):
        for batch in batches:
            found = [function(row) for row in batch.to_pylist()]
            if found:
                yield _record({c: [f[c] for f in found] for c in types}, types)

    return frame.mapInArrow(run, schema)


_VECTORS = {"seq": pa.int64(), "used": _INTS, "arrived": _INTS, "moved": pa.bool_()}
_VECTOR_SCHEMA = "seq long, used array<int>, arrived array<int>, moved boolean"


def backward(chunks: DataFrame, passes: int = PASSES) -> DataFrame | None:
    """(seq, used): the costs, but for a constant, after every chunk that isn't its conversation's last; None where there is none.

    A pass reads the vectors of the pass before and those chunks whose successor's vector
    isn't the one they used.
    """
    inner = materialise(chunks.filter("next is not null").select("seq", "next", *_CONV, "kinds"))
    if inner.isEmpty():
        discard(inner)
        return None

    def begin(row):
        return {"seq": row["seq"], "used": END, "arrived": run_back(row["kinds"], END)[0], "moved": True}

    tails = materialise(_each(chunks.filter("next is null and prior is not null").select("seq", "kinds"), _VECTOR_SCHEMA, _VECTORS, begin))
    now = materialise(_each(inner.select("seq", "kinds"), _VECTOR_SCHEMA, _VECTORS, begin))

    def again(row):
        used, arrived, vector = tuple(row["used"]), tuple(row["arrived"]), tuple(row["vector"])
        if used == vector:
            return {"seq": row["seq"], "used": used, "arrived": arrived, "moved": False}
        found, _ = fix_up(row["kinds"], used, vector, arrived)
        return {"seq": row["seq"], "used": vector, "arrived": found, "moved": found != arrived}

    for _ in range(passes):
        after = now.select("seq", "arrived").unionByName(tails.select("seq", "arrived")).selectExpr("seq next", "arrived vector")
        given = inner.join(after, "next").join(now.drop("moved"), "seq").select("seq", "kinds", "used", "arrived", "vector")
        before, now = now, materialise(_each(given, _VECTOR_SCHEMA, _VECTORS, again))
        discard(before)
        if now.filter("moved").isEmpty():
            discard(inner, tails)
            return now.select("seq", "used")

    open_ = now.filter("moved").join(inner, "seq").select(*_CONV).distinct()
    rest = inner.join(open_, [*_CONV], "left_semi")
    types = {"seq": pa.int64(), "absent": pa.bool_(), "conv_id": pa.int64(), "next": pa.int64(), "spans": _INTS}

    def whole(row):
        return {c: row[c] for c in ("seq", "absent", "conv_id", "next")} | {"spans": sum(spans(row["kinds"]), [])}

    matrices = _each(rest, "seq long, absent boolean, conv_id long, next long, spans array<int>", types, whole)
    ends = matrices.join(tails.selectExpr("seq next", "arrived"), "next", "left")

    def stitch(batches):
        vector = END
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                vector = tuple(row["arrived"]) if row["arrived"] is not None else vector
                found.append((row["seq"], vector))
                m = row["spans"]
                vector = _less([min(m[4 * a + b] + vector[b] for b in range(4)) for a in range(4)])
            if found:
                yield _record({"seq": [f[0] for f in found], "used": [f[1] for f in found]}, {"seq": pa.int64(), "used": _INTS})

    in_order = ends.repartition(*_CONV).sortWithinPartitions(*_CONV, F.desc("seq")).select("seq", "spans", "arrived")
    exact = in_order.mapInArrow(stitch, "seq long, used array<int>")
    settled = now.join(rest.select("seq"), "seq", "left_anti").select("seq", "used")
    out = materialise(settled.unionByName(exact))
    discard(inner, tails, now)
    return out


def first_states(chunks: DataFrame) -> DataFrame:
    """(seq, state) that every chunk with ``used`` of a conversation of several chunks begins in."""
    types = {"seq": pa.int64(), "absent": pa.bool_(), "conv_id": pa.int64(), "ends": _INTS}

    def ends(row):
        to = [trace(row["kinds"], tuple(row["used"]), state, False)[1] for state in range(4)]
        return {c: row[c] for c in ("seq", "absent", "conv_id")} | {"ends": to}

    def walk(batches):
        last, state = None, START
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                key = row["absent"], row["conv_id"]
                state, last = state if key == last else START, key
                found.append((row["seq"], state))
                state = row["ends"][state]
            if found:
                yield _record({"seq": [f[0] for f in found], "state": [f[1] for f in found]}, {"seq": pa.int64(), "state": pa.int32()})

    several = _each(chunks, "seq long, absent boolean, conv_id long, ends array<int>", types, ends)
    return several.repartition(*_CONV).sortWithinPartitions(*_CONV, "seq").mapInArrow(walk, "seq long, state int")


def repaired(conversations: DataFrame, chunk: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of ``conversations(conv_id, turn, role, text)`` after damage."""
    rows = materialise(ordered(damaged(conversations), chunk))
    chunks = materialise(chunked(rows))
    after = backward(chunks, passes)
    if after is None:
        ready = chunks.withColumns({"used": F.lit(None).cast("array<int>"), "state": F.lit(START)})
    else:
        known = materialise(chunks.join(after, "seq", "left"))
        end = F.coalesce("used", F.array(*map(F.lit, END)))
        states = first_states(known.filter("prior is not null or next is not null").select("seq", *_CONV, "kinds", end.alias("used")))
        ready = known.join(states, "seq", "left").withColumn("state", F.coalesce("state", F.lit(START)))
    types = {"absent": pa.bool_(), "conv_id": pa.int64(), "seq": pa.int64(), "idx": pa.int32(), "letters": pa.string(), "state": pa.int32(), "numbers": pa.list_(pa.int64())}

    def head(row):
        letters, _, cost = trace(row["kinds"], tuple(row["used"] or END), row["state"], row["next"] is None)
        return {c: row[c] for c in ("absent", "conv_id", "seq", "state")} | {"idx": -1, "letters": letters, "numbers": [*row["counts"], cost]}

    heads = _each(
        ready.select("absent", "conv_id", "seq", "kinds", "counts", "next", "used", "state"),
        "absent boolean, conv_id long, seq long, idx int, letters string, state int, numbers array<long>", types, head,
    )
    both = rows.unionByName(heads, allowMissingColumns=True).repartition(*_CONV).sortWithinPartitions(*_CONV, "seq", "idx")
    found = both.select(*_CONV, "idx", "late", "at", "role", "text", "times", "letters", "state", "numbers").mapInArrow(_write, _FOUND)
    every = conversations.select(F.isnull("conv_id").alias("absent"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id")).distinct()
    out = every.join(found, [*_CONV], "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return out.select(F.when(~F.col("absent"), F.col("conv_id")).alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


class _Conversation:
    """What a conversation's chunks and rows, in order, add up to."""

    def __init__(self):
        self.numbers, self.last, self.audit, self.hash, self.any = np.zeros(5, np.int64), None, [], hashlib.sha256(), False
        self.least = self.turn = None
        self.turns = 0

    def chunk(self, letters: str, state: int, numbers: list[int]) -> None:
        self.rest()
        blank, duplicate, truncated, illegal, first, last, cost = numbers
        if self.last is not None:
            illegal += int(not _LEGAL[self.last, first])
        self.numbers += (blank, duplicate, truncated, illegal, cost)
        self.last, self.letters, self.at, self.state = last, letters, 0, state

    def write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.any = True

    def inserts(self) -> None:
        while self.letters[self.at : self.at + 1] == "I":
            self.state = _NEXT[self.state]
            self.write(_ROLES[self.state], "")
            self.audit.append("I")
            self.at += 1

    def row(self, late: bool, turn: int, role: str, text: str, times: int) -> None:
        if late and turn != self.turn:
            self.turns += 1
            self.least, self.turn = turn if self.least is None else self.least, turn
        self.inserts()
        edit = self.letters[self.at]
        self.at += 1
        self.audit.append(edit + "D" * (times - 1))
        self.numbers[4] += 3 * (times - 1)
        if edit != "D":
            self.state = _NEXT[self.state] if edit == "R" or role[:1] != "s" else S
            self.write(role if edit == "K" else _ROLES[self.state], text)

    def rest(self) -> None:
        if self.last is not None:
            self.inserts()

    def result(self, key: tuple) -> tuple:
        self.rest()
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        return *key, gaps, *self.numbers.tolist(), "".join(self.audit), self.hash.hexdigest()


def _write(batches):
    """One row a conversation from its chunks' heads and rows, in order."""
    names = [f.split()[0] for f in _FOUND.split(", ")]
    types = dict(zip(names, [pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string()], strict=True))
    key, now, found = None, None, []
    for batch in batches:
        plain = [batch.column(i).to_pylist() for i in range(batch.num_columns) if i != 6]
        texts = batch.column(6)
        for i, (absent, conv, idx, late, at, role, times, letters, state, numbers) in enumerate(zip(*plain, strict=True)):
            if (absent, conv) != key:
                if now is not None:
                    found.append(now.result(key))
                key, now = (absent, conv), _Conversation()
            if idx < 0:
                now.chunk(letters, state, numbers)
            else:
                now.row(late, at, role, texts[i].as_py(), times)
        if found:
            yield _record(dict(zip(names, zip(*found, strict=True), strict=True)), types)
            found = []
    if now is not None:
        yield _record(dict(zip(names, zip(now.result(key), strict=True), strict=True)), types)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))
