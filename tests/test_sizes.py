"""What one task holds doesn't follow the size of a table."""

import json
import re
from datetime import datetime
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from rosterlens import catalogue, catalogue_resources, catalogue_tables
from rosterlens.operators import merge, versions
from rosterlens.sources import projection, shared
from rosterlens.streaming import ingest


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(shared, "ROWS_A_TASK", 400)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def largest(df):
    return df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]


def test_role_locations_take_tasks_by_rows(spark, data, no_broadcast):
    rows = projection.role_locations(spark, data)
    assert rows.count() > 10 * 400
    assert largest(rows) < 2 * 400  # adaptive execution used to pack all of them into one task


def test_frontier_reads_locations_in_tasks_by_rows(spark, data, no_broadcast):
    """No stage of the query deals the lines into fewer tasks than their rows ask for."""
    df = catalogue.QUERIES["frontier_ids"](spark, data)
    df.collect()
    lines = projection.raw(spark, data, "lineitem").count()
    assert f", {-(-lines // 400)})" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ref_scalar", "ref_all_checks", "dimension_scores", "composite_score", "payer_ranking", "overview"])
def test_checks_count_roles_in_tasks_by_rows(spark, data, no_broadcast, monkeypatch, name):
    """Roles lie in one file; one task used to count the ids of them all before they moved."""
    monkeypatch.setattr(shared, "ROWS_A_TASK", 100)
    n = projection.raw(spark, data, "orders").count()
    assert n > 10 * 100
    plan = catalogue.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"hashpartitioning\(o_orderkey#\d+L?, {-(-n // 100)}\)", plan)


def test_deliveries_take_files_by_rows(spark, data, tmp_path, monkeypatch):
    """However many tasks read the events, a delivery has as many files as its rows ask for, so the stream's batches follow the rows."""
    monkeypatch.setattr(catalogue_tables, "pinned_root", lambda spark: f"file://{tmp_path}")
    wide = spark.read.parquet(f"{data}/events.parquet").repartition(12)
    monkeypatch.setattr(projection, "raw", lambda spark, d, name: wide)
    rows = catalogue.QUERIES["stream_deliveries"](spark, data)
    assert rows.count() == wide.count() == rows.distinct().count()
    assert len(list((tmp_path / "in").glob("*.parquet"))) == 4 * 2
    assert len([p for p in (tmp_path / "mark" / "commits").iterdir() if p.name.isdigit()]) <= 5


def test_resources_are_flattened_in_tasks_by_rows(spark, data, monkeypatch):
    """The orders lie in one small file, which one task used to read and parse whole."""
    monkeypatch.setattr(catalogue_resources, "ROWS_A_TASK", 100)
    roles = projection.raw(spark, data, "orders").count()
    assert roles >= 1000 and projection.raw(spark, data, "orders").rdd.getNumPartitions() < 8
    rows = catalogue.QUERIES["flatten_practitioner_role_resources"](spark, data)
    assert rows.rdd.getNumPartitions() == -(-roles // 100) and largest(rows) < 2 * 100
    df = catalogue.QUERIES["weakest_references"](spark, data)
    df.collect()
    assert f", {-(-roles // 100)})" in df._jdf.queryExecution().executedPlan().toString()


def test_tables_of_a_batch_are_merged_side_by_side_in_tasks_by_rows(spark, tmp_path, monkeypatch):
    """Each merge waits for the other to begin; a table's parsed lines, few bytes of one file, are dealt by rows."""
    both, tasks, merge_into = Barrier(2, timeout=60), {}, ingest.merge_into

    def met(batch, path, *rest, **named):
        both.wait()
        tasks[path.rsplit("/", 1)[-1]] = batch.rdd.getNumPartitions()
        merge_into(batch, path, *rest, **named)

    monkeypatch.setattr(ingest, "merge_into", met)
    monkeypatch.setattr(ingest, "ROWS_A_TASK", 10, raising=False)
    lines = [json.dumps({"resourceType": kind, "id": str(i)}) for kind, n in (("Organization", 25), ("Location", 9)) for i in range(n)]
    ingest.write_batch(spark.createDataFrame([(line,) for line in lines], "value string"), "p", "https://h", ("organization", "location"), f"file://{tmp_path}", datetime(2024, 1, 1))
    assert tasks == {"organization": 3, "location": 1}
    for table, n in (("organization", 25), ("location", 9)):
        assert catalogue_tables.merge.read(spark, f"file://{tmp_path}/{table}").count() == n


def _organizations(spark, name, *ids):
    return spark.createDataFrame([(json.dumps({"resourceType": "Organization", "id": str(i), "name": name}),) for i in ids], "value string")


def test_a_batch_of_new_keys_is_written_once(spark, tmp_path, monkeypatch):
    """No copy beside the table where all keys are new and come once; repeated and known keys still end as one row, and no commit stays that no version names."""
    out = f"file://{tmp_path}"

    def write(day, lines):
        ingest.write_batch(lines, "p", "https://h", ("organization",), out, datetime(2024, 1, day))
        return {(r.id, r.name, r.last_seen_at.day) for r in merge.read(spark, f"{out}/organization").collect()}

    with monkeypatch.context() as m:
        m.setattr(merge, "pinned", lambda df: pytest.fail("a copy was written"))
        write(1, _organizations(spark, "a", *range(40)))
        assert write(2, _organizations(spark, "b", *range(40, 60))) == {(str(i), "a" if i < 40 else "b", 1 if i < 40 else 2) for i in range(60)}
    got = write(3, _organizations(spark, "c", 39, 60).unionByName(_organizations(spark, "a", 38)))  # changed, new, delivered again
    assert got >= {("39", "c", 3), ("60", "c", 3), ("38", "a", 3), ("37", "a", 1)} and len(got) == 61
    got = write(4, _organizations(spark, "d", 61, 61, 0))  # a key twice in a batch
    assert got >= {("61", "d", 4), ("0", "d", 4), ("39", "c", 3)} and len(got) == 62
    write(5, _organizations(spark, "d", 61))  # nothing new but that it was seen
    numbers = range(1, versions.current(spark, f"{out}/organization").number + 1)
    named = {c for n in numbers for commits in versions.current(spark, f"{out}/organization", n).files["rows"].values() for c in commits}
    assert {p.name.split("=")[1] for p in (tmp_path / "organization" / "rows").iterdir()} == named


def test_tasks_of_a_merge_hold_few_places_each(spark):
    rows = merge.by_place(spark.range(32_000).selectExpr("'p' as payer_id", "cast(id as string) as id"), 32)
    bucket = F.expr("pmod(xxhash64(id), 16)")
    tasks = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.countDistinct(bucket).alias("places")).collect()
    assert len(tasks) == 32 and {t.places for t in tasks} == {1} and max(t.n for t in tasks) < 1200


def test_lines_of_a_batch_are_parsed_in_tasks_by_rows(spark, monkeypatch):
    seen, routed = [], ingest.routed
    monkeypatch.setattr(ingest, "routed", lambda df: seen.append(df.rdd.getNumPartitions()) or routed(df))
    monkeypatch.setattr(ingest, "ROWS_A_TASK", 10)
    assert ingest.staged(_organizations(spark, "a", *range(95)).coalesce(1), "p", "https://h")[1]["organization"] == 95 and seen == [10]


def test_shuffles_of_a_stream_go_with_their_jobs(spark, tmp_path, monkeypatch):
    """The stream's own session says so; the user's stays as it is."""
    name, found = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(name)
    monkeypatch.setattr(ingest, "write_batch", lambda df, *_: found.append(df.sparkSession.conf.get(name)))
    _organizations(spark, "a", 1).write.text(f"file://{tmp_path}/in")
    ingest.ingest(spark, f"file://{tmp_path}/in", "p", "https://h", ("organization",), f"file://{tmp_path}/out", f"file://{tmp_path}/mark", datetime(2024, 1, 1)).awaitTermination()
    assert found == ["true"] and spark.conf.get(name) == before


def test_streamed_lines_lie_in_gzipped_files_by_rows(spark, data, monkeypatch):
    """A batch takes so many files; what it holds follows their lines, not how many tasks read the tables."""

    class Enough(Exception):
        pass

    def read(spark, path, *_, **named):
        raise Enough(spark.read.text(path).groupBy(F.input_file_name().alias("file")).count().collect())

    monkeypatch.setattr(catalogue_tables, "_LINES_A_FILE", 100, raising=False)
    monkeypatch.setattr(catalogue_tables, "ingest", read)
    with pytest.raises(Enough) as found:
        catalogue.QUERIES["stream_tables"](spark, data)
    files = found.value.args[0]
    assert all(f.file.endswith(".gz") for f in files) and max(f["count"] for f in files) < 200
