import json
import os
from datetime import datetime

import pytest

from rosterlens.operators import merge, runs, versions
from rosterlens.operators.flatten import typed
from rosterlens.streaming.ingest import deliver, ingest, staged

T = "payer_id string, id string, v int"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), T)


def as_set(df):
    return {tuple(r) for r in df.select("payer_id", "id", "v").collect()}


def test_merges_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.merge_into(table(spark, ("a", "1", 1), ("b", "1", 1)), path)
    batch = table(spark, ("a", "1", 2), ("a", "2", 5), ("a", "2", 7))
    for _ in range(2):
        merge.merge_into(batch, path)
        assert as_set(merge.read(spark, path)) == {("a", "1", 2), ("a", "2", 7), ("b", "1", 1)}
    merge.merge_into(table(spark, ("b", "1", 9), ("b", "3", 3)), path, "insert")
    assert as_set(merge.read(spark, path)) == {("a", "1", 2), ("a", "2", 7), ("b", "1", 1), ("b", "3", 3)}


def test_merge_keeps_columns_and_appends_new_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.merge_into(spark.createDataFrame([("a", "1", 1, "x"), ("a", "2", 2, "y"), ("001", "1", 5, "z")], T + ", w string"), path)
    files = {f for f in merge.read(spark, path).inputFiles()}
    merge.merge_into(table(spark, ("a", "1", 1), ("a", "9", 9)), path)  # delivered again as it is, and a new key
    assert files <= set(merge.read(spark, path).inputFiles())
    merge.merge_into(spark.createDataFrame([("a", "1", 7, 0.5)], T + ", u double"), path)
    schema = T + ", w string, u double"
    got = {tuple(r) for r in merge.read(spark, path).select("payer_id", "id", "v", "w", "u").collect()}
    assert got == {("a", "1", 7, "x", 0.5), ("a", "2", 2, "y", None), ("a", "9", 9, None, None), ("001", "1", 5, "z", None)}
    merge.merge_into(table(spark, ("a", "1", 99), ("a", "3", 3)), path, "insert")
    got = {tuple(r) for r in merge.read(spark, path).select("payer_id", "id", "v", "w", "u").collect()}
    assert ("a", "1", 7, "x", 0.5) in got and ("a", "3", 3, None, None) in got and len(got) == 5


def test_diff_of_itself_is_unchanged(spark):
    a = table(spark, ("a", "1", 1), ("a", "2", None))
    assert {r.change for r in runs.snapshot_diff(a, a, ["payer_id", "id"], "v").collect()} == {"unchanged"}


def test_empty_batch(spark):
    a = table(spark, ("a", "1", 1))
    assert as_set(merge.update(a, a.limit(0))) == as_set(a) == as_set(merge.insert_only(a, a.limit(0)))


def test_stream_restarts_without_gaps_or_repeats(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    (tmp_path / "src").mkdir()

    def write(name, *ids):
        lines = [json.dumps({"resourceType": "Organization", "id": i, "name": f"n{i}"}) for i in ids]
        (tmp_path / "src" / name).write_text("\n".join([*lines, "", "{bad"]))

    def run(checkpoint):
        ingest(spark, f"file://{src}", "p", "https://h", ("organization",), f"file://{out}", f"file://{checkpoint}", datetime(2024, 1, 1), files=1).awaitTermination()
        return sorted(r.id for r in merge.read(spark, f"{out}/organization").collect())

    write("a.ndjson", "1", "2", "2")
    assert run(mark) == ["1", "2"]
    write("b.ndjson", "2", "3")
    assert run(mark) == ["1", "2", "3"]
    assert run(mark + "-new") == ["1", "2", "3"]  # everything delivered again
    assert merge.read(spark, f"{out}/rejects").count() == 1


def test_stream_killed_in_mid_batch_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    """A batch that dies after its first table is written runs again whole; many tables, rejects and batch counts."""
    from rosterlens.streaming import ingest as module

    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    (tmp_path / "src").mkdir()
    for n in range(3):
        lines = [json.dumps({"resourceType": t, "id": f"{t}{i}", "name": "n"}) for t in ("Organization", "Location") for i in range(n, n + 3)]
        (tmp_path / "src" / f"{n}.ndjson").write_text("\n".join([*lines, "{bad", ""]))
    real, calls = module.merge_into, []

    def dies(batch, path, mode="update", **more):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(batch, path, mode, **more)

    def run():
        module.ingest(spark, f"file://{src}", "p", "https://h", ("organization", "location"), f"file://{out}", f"file://{mark}", datetime(2024, 1, 1), files=1).awaitTermination()

    monkeypatch.setattr(module, "merge_into", dies)
    try:
        run()
        raise AssertionError("the stream should have failed")
    except Exception as e:
        assert "killed" in str(e)
    run()
    for t, kind in (("organization", "Organization"), ("location", "Location")):
        assert sorted(r.id for r in merge.read(spark, f"{out}/{t}").collect()) == [f"{kind}{i}" for i in range(5)]
    assert merge.read(spark, f"{out}/rejects").count() == 1
    counts = module.batch_counts(spark, f"file://{out}")
    assert sum(r.lines for r in counts.collect()) == 21 and sum(r.rejects for r in counts.collect()) == 3 and counts.count() == 3


def files_of(spark, path):
    return sorted(f for f in spark.read.option("recursiveFileLookup", True).parquet(f"{path}/rows").inputFiles())


def test_null_keys_and_strange_names_merge_once(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("p", None, 1), (None, "x", 2), (None, None, 3), ("a/b %{c}*=", "x", 4), ("é", "y", 5)], T)
    for _ in range(3):
        merge.merge_into(batch, path)
    assert as_set(merge.read(spark, path)) == as_set(batch) and merge.read(spark, path).count() == 5
    merge.merge_into(batch.withColumn("v", batch.v + 10), path)
    assert as_set(merge.read(spark, path)) == {(p, i, v + 10) for p, i, v in as_set(batch)}
    assert merge.update(batch, batch).count() == merge.insert_only(batch, batch).count() == 5
    assert sorted(str(r[0]) for r in versions.places(spark, versions.current(spark, path)).collect()) == ["None", "a/b %{c}*=", "p", "é"]


def test_a_writer_lost_before_it_publishes_leaves_the_version_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge.merge_into(table(spark, ("a", "1", 1), ("a", "2", 2), ("b", "1", 3)), path)
    before, old = as_set(merge.read(spark, path)), merge.read(spark, path)
    batch = table(spark, ("a", "1", 7), ("c", "5", 5))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lost)
        with pytest.raises(RuntimeError):
            merge.merge_into(batch, path)
    assert as_set(merge.read(spark, path)) == before and versions.current(spark, path).number == 1
    merge.merge_into(batch, path)
    after = {("a", "1", 7), ("a", "2", 2), ("b", "1", 3), ("c", "5", 5)}
    assert as_set(merge.read(spark, path)) == after and versions.current(spark, path).number == 2
    assert as_set(old) == before == as_set(merge.read(spark, path, 1))  # a reader of the version before still reads it
    with pytest.raises(Exception, match="exists"):
        versions.publish(spark, path, versions.current(spark, path))  # a second writer of the same number
    assert versions.vacuum(spark, path, keep=1) == 0  # too young to go
    assert versions.vacuum(spark, path, keep=1, older_than_seconds=-60) >= 1
    assert as_set(merge.read(spark, path)) == after
    with pytest.raises(ValueError):
        merge.read(spark, path, 1)


def test_a_second_harvest_of_the_same_rows_rewrites_no_file(spark, tmp_path):
    path, s = str(tmp_path / "t"), "payer_id string, id string, v int, raw_hash string, last_seen_at timestamp"

    def harvest(day, *rows):
        merge.merge_into(spark.createDataFrame([(*r, datetime(2024, 1, day)) for r in rows], s), path, same="raw_hash", seen="last_seen_at")

    rows = [("a", str(i), i, f"h{i}") for i in range(40)]
    harvest(1, *rows)
    files = files_of(spark, path)
    harvest(2, *rows[:30])
    assert files_of(spark, path) == files
    gone = runs.ghosts(merge.read(spark, path), datetime(2024, 1, 2))
    assert sorted(int(r.id) for r in gone.collect()) == list(range(30, 40))
    for day in range(3, 14):  # crowded places are written anew, last-seen times stay
        harvest(day, ("a", "0", 0, "h0"))
    assert files_of(spark, path) == files and max(map(len, versions.current(spark, path).files["seen"].values())) <= merge.CROWDED + 1
    seen = {r.id: r.last_seen_at.day for r in merge.read(spark, path).collect()}
    assert seen["0"] == 13 and seen["1"] == 2 and seen["39"] == 1 and len(seen) == 40
    merge.merge_into(spark.createDataFrame([("a", "1", 9, "x", datetime(2024, 2, 1)), ("a", "99", 9, "x", datetime(2024, 2, 1))], s), path, "insert", same="raw_hash", seen="last_seen_at")
    seen = {r.id: r.last_seen_at.month for r in merge.read(spark, path).collect()}
    assert seen["1"] == 1 and seen["99"] == 2


def test_one_parse_a_line_and_counts_by_the_writing_job(spark, tmp_path):
    lines = [json.dumps({"resourceType": t, "id": f"{t}{i}", "name": "n"}) for t in ("Organization", "Location") for i in range(5)]
    rows, counts, path = staged(spark.createDataFrame([(x,) for x in [*lines, "{bad", "", "  ", '{"resourceType":"Patient","id":"1"}']], "value string"), "p", "https://h")
    assert counts["lines"] == rows.count() == 12 and counts["rejects"] == rows.filter("table_name = 'rejects'").count() == 2
    assert counts["organization"] == counts["location"] == 5 and counts["endpoint_resource"] == 0
    plan = typed(rows.filter("table_name = 'location'"), "location", datetime(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "jsontostructs(resource" not in plan.lower() and "parse_json" not in plan.lower() and "PartitionFilters: [isnotnull(table_name" in plan


def test_late_and_repeated_deliveries_across_batches(spark, tmp_path):
    src, out = tmp_path / "src", f"file://{tmp_path}/out"
    src.mkdir()
    batches = [
        [(1, "10:00:00"), (2, "10:00:10"), (1, "10:00:00")],
        [(2, "10:00:40"), (3, "10:05:00")],  # a repeat in a later batch
        [(4, "10:04:30"), (1, "10:00:01"), (3, "10:05:20")],  # 4 is late, but not too late; 1 is behind the watermark
        [(5, "10:20:00")],
        [(5, "10:20:05")],  # the batch after the one that moves the watermark still takes what is late
        [(6, "10:04:00"), (5, "10:20:30"), (7, "10:19:30")],  # 6 is later than the watermark
    ]
    for n, rows in enumerate(batches):
        file = src / f"{n}.json"
        file.write_text("\n".join(json.dumps({"id": i, "at": f"2024-01-01T{t}Z"}) for i, t in rows))
        os.utime(file, (1_700_000_000 + 60 * n,) * 2)

    def run():
        stream = spark.readStream.schema("id long, at timestamp").option("maxFilesPerTrigger", 1).json(f"file://{src}")
        deliver(stream, ["id"], "at", "2 minutes", out, f"file://{tmp_path}/mark").awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    assert run() == [1, 2, 3, 4, 5, 7]
    (src / "9.json").write_text(json.dumps({"id": 5, "at": "2024-01-01T10:20:50Z"}))  # the state outlives the query
    assert run() == [1, 2, 3, 4, 5, 7]
