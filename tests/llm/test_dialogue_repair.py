"""Conversation repair against a search over whole conversations, one at a time."""

import hashlib
import random
import re
import zlib

import pytest

from rosterlens.llm import dialogue_repair as D
from rosterlens.llm.store import table

EMPTY = hashlib.sha256().hexdigest()


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else str(x)
        harm = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def _repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of damaged rows, by the cheapest of all edit sequences."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": {"u": "u", "s": "s"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    layer = {"": (0, "", ()), "a": (0, "", ()), "s": None, "u": None}
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            _, role, text = rows[i]
            extra = 1 if faults[i] == "truncated" else 0
            new = {}
            for state in after:
                options = []
                if layer[state]:
                    c, a, t = layer[state]
                    options.append((c + 3, "D" + a, t))
                if faults[i] not in ("blank", "duplicate"):
                    for to in after[state]:
                        if layer[to] is None:
                            continue
                        c, a, t = layer[to]
                        if role[:1] == to:
                            options.append((c + extra, "K" + a, (f"{role}:{text}",) + t))
                        if to != "s":
                            name = {"u": "user", "a": "assistant"}[to]
                            options.append((c + extra + 2, "R" + a, (f"{name}:{text}",) + t))
                new[state] = min(options, default=None, key=lambda o: o[:2])
            layer = new
        for _ in range(4):
            for state in after:
                for to in after[state]:
                    if to != "s" and layer[to]:
                        c, a, t = layer[to]
                        name = {"u": "user", "a": "assistant"}[to]
                        option = (c + 2, "I" + a, (f"{name}:",) + t)
                        if layer[state] is None or option[:2] < layer[state][:2]:
                            layer[state] = option
    cost, audit, texts = layer[""]
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest()


def _want(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    return {c: _repair(d) if (d := _damage(own)) else (0, 0, 0, 0, 0, 0, "", EMPTY) for c, own in convs.items()}


def _got(frame):
    rows = frame.collect()
    out = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


SCHEMA = "conv_id long, turn int, role string, text string"


def test_all_conversations(spark, data):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, data, "conversations").collect()]
    assert _got(D.op11_repair(spark, data)) == _want(rows)


@pytest.mark.parametrize(("chunk", "passes"), [(1, 0), (3, 1), (4, 60)])
def test_chunks_passes_and_the_exact_way_out(spark, chunk, passes):
    r = random.Random(chunk)
    rows = []
    for conv in range(14):
        roles = ["user"] if conv % 3 == 0 else ["user", "assistant"] if conv % 3 == 1 else ["system", "user", "assistant", "tool", "", None, "unknown", "A"]
        for turn in range(r.choice([0, 1, 5, 40])):
            role = roles[turn % 2] if len(roles) == 2 and r.random() < 0.9 else r.choice(roles)
            rows += [(conv, r.choice([turn, turn, turn + 3, None]), role, r.choice([f"text {turn}.", f"text {turn}", "ok.", "ok", " \t", None, "a.b! "]))] * r.choice([1, 1, 1, 3])
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert _got(D.repaired(frame, chunk, passes)) == _want(rows)


def test_odd_rows_and_extra_columns(spark):
    rows = [(None, 0, "user", "a."), (None, None, None, None), (1, None, "user", "x."), (1, None, "user", "x."), (2, 5, "user", "\x0b "), (3, 0, "assistant", "long. " * 50000), (4, 0, "user", "gap" + " " * 1_000_000 + "end"), (4, 1, "assistant", "end.\x0b\x0c\r\t\n "), (4, 2, "user", "end.\xa0")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as seq", "'x' as absent", "2 as times", "3 as state")
    assert _got(D.repaired(frame)) == _want(rows)
    assert D.repaired(frame.limit(0)).collect() == []


def test_one_conversation_of_many_equal_rows(spark):
    frame = spark.range(6000).selectExpr("7L conv_id", "cast(id % 3 as int) turn", "'user' role", "'same.' text")
    got = _got(D.repaired(frame, 100))[7]
    rows = [(7, i % 3, "user", "same.") for i in range(6000)]
    assert got == _want(rows)[7]


def test_fix_up_stops_where_runs_agree():
    kinds = bytes([D.U, D.A] * 50)
    guess, vector = D.END, (1, 3, 0, 0)
    arrived, _ = D.run_back(kinds, guess)
    found, rerun = D.fix_up(kinds, guess, vector, arrived)
    assert found == D.run_back(kinds, vector)[0] and rerun < 10
    same = bytes([D.U] * 51)
    found, rerun = D.fix_up(same, (0, 0, 0, 0), D.END, D.run_back(same, (0, 0, 0, 0))[0])
    assert found == D.run_back(same, D.END)[0] and rerun == 51


def test_spans_are_the_costs_of_every_pair_of_states():
    r = random.Random(5)
    for _ in range(200):
        kinds = bytes(r.choice([0, 1, 2, 3, 4, 9, 10, 11, 8]) for _ in range(r.randint(0, 9)))
        vector = D._closed(tuple(r.randint(0, 6) for _ in range(4)))
        back, total = D.run_back(kinds, D._less(vector))
        m = D.spans(kinds)
        assert tuple(b + total + min(vector) for b in back) == tuple(min(m[a][b] + vector[b] for b in range(4)) for a in range(4))


def test_same_as_sql(spark, tmp_path):
    import duckdb

    from rosterlens.llm.queries import ORACLE_SQL

    r, rows = random.Random(9), []
    for conv in (*range(60), None):
        for turn in range(r.choice([1, 2, 6, 25])):
            rows.append((conv, r.choice([turn, turn, turn + 2, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice([f"t {turn}!", f"t {turn}", "ok.", "ok", " \x0b", "", None, "ä. "])))
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.repartition(1).write.parquet(f"{tmp_path}/conversations.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = {row[0]: tuple(row[1:]) for row in duck.execute(ORACLE_SQL["op11_repair"]).fetchall()}
    got, brute = _got(D.op11_repair(spark, str(tmp_path))), _want(rows)
    assert got == brute
    assert want == brute
