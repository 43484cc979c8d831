import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from rosterlens.operators import planner, refs, runs
from rosterlens.plans import rules

CASES = [
    (dict(method="blocked"), "error"), (dict(method="needs-partition"), "skipped"), (dict(extract_error="x", loaded=0), "error"), (dict(extract_error="x", loaded=5), "partial"),
    (dict(total=5, loaded=0), "error"), (dict(note="request budget", loaded=5), "partial"), (dict(fetch_errors=1, loaded=5), "partial"), (dict(total=0, loaded=0), "ok"),
    (dict(loaded=0), "empty-unverified"), (dict(loaded=5, total=9), "ok"), (dict(note="pagination stopped", loaded=3, total=3), "partial"),
]


@pytest.mark.parametrize(("given", "want"), CASES)
def test_run_status(spark, given, want):
    row = dict(method="search", note=None, extract_error=None, loaded=1, total=None, fetch_errors=0, transform_errors=0) | given
    kinds = {"method": "string", "note": "string", "extract_error": "string"}
    s = runs.run_status(*(F.lit(row[c]).cast(kinds.get(c, "long")) for c in ("method", "note", "extract_error", "loaded", "total", "fetch_errors", "transform_errors")))
    assert spark.range(1).select(s.alias("s")).first().s.status == want


@pytest.mark.parametrize(
    ("bare", "counted", "gaps", "mode", "match_all", "want"),
    [(7, 5, False, "daterange", None, (7, "bare")), (None, 5, False, "daterange", None, (5, "daterange_window_sum")), (None, 5, True, "daterange", None, (None, None)), (None, 5, False, "name", True, (5, "match_all_count")), (None, 5, False, "name", False, (None, None))],
)
def test_denominator(spark, bare, counted, gaps, mode, match_all, want):
    total, source = runs.denominator(F.lit(bare).cast("long"), F.lit(counted), F.lit(gaps), F.lit(mode), F.lit(match_all).cast("boolean"))
    assert tuple(spark.range(1).select(total, source).first()) == want


def test_rule_counts():
    assert sum(len(e) for e in rules.ELEMENTS.values()) == 45
    assert sum(e.required for es in rules.ELEMENTS.values() for e in es) == 8
    assert len(rules.CHECKS) == 18 and all(abs(sum(w) - 1) < 1e-9 for w in rules.SCHEMES.values())


def test_time_leaves_cover_once(spark):
    start, end = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc)
    df = spark.range(3000).select(F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, cast(pow(id, 2) % 90000 as int)) as ts"))
    leaves = planner.time_buckets(df, F.col("ts"), start, end, 100, 12).collect()
    inside = df.filter("ts < timestamp '2024-01-02'").count()
    assert sum(r.n for r in leaves) == inside and all(r.n <= 100 or r.level == 12 for r in leaves)


def test_prefix_leaves_and_residual(spark):
    names = ["aa"] * 5 + ["ab"] * 2 + ["a"] * 2 + ["b1", "B2", "-x", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    leaves = planner.prefix_buckets(df, F.col("name"), 4, 3)
    assert {(r.prefix, r.n) for r in leaves.collect()} == {("ab", 2), ("b", 2)}
    assert planner.prefix_residual(df, leaves).first().residual == 9


def test_batches_of_ids(spark):
    ids = spark.range(10).select(F.lit("p").alias("payer_id"), F.col("id").cast("string").alias("id"))
    assert sorted(r.n for r in refs.chain_batches(ids, 3).collect()) == [1, 3, 3, 3]


def test_expected_units(spark):
    from rosterlens.sources import bundles

    m = spark.createDataFrame([("a", ["x"]), ("b", None)], "key string, resources array<string>")
    types = spark.createDataFrame([("x",), ("y",)], "resource_type string")
    assert {tuple(r) for r in bundles.expected_units(m, types).collect()} == {("a", "x"), ("b", "x"), ("b", "y")}
    assert bundles.select_endpoints(m, ["a", "zz"]).count() == 1


def test_finalised_run(spark):
    row = ("p", "organization", datetime(2024, 1, 2), None, 90, False, "daterange", None, "search", None, None, 90, 0, 0)
    done = spark.createDataFrame([row], "payer_id string, resource_type string, started_at timestamp, bare_total long, counted_total long, count_gaps boolean, mode string, match_all boolean, method string, note string, extract_error string, loaded long, fetch_errors long, transform_errors long")
    history = spark.createDataFrame([("p", "organization", 1, datetime(2024, 1, 1), 120, "ok"), ("p", "organization", 2, datetime(2024, 1, 1, 5), 1, "error")], "payer_id string, resource_type string, run_id long, started_at timestamp, resource_count long, status string")
    r = runs.finalised(done, history).first()
    assert (r.server_total, r.total_source, r.status, r.prior_count, r.pct_change) == (90, "daterange_window_sum", "ok", 120, -25.0) and len(r.run_id) == 64


@pytest.fixture
def many_ranges(spark):
    """Ranges stay apart although they are small, so that what they carry over is tested."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_stalls_of_a_payer_in_many_ranges(spark, many_ranges):
    rng = random.Random(5)
    rows = []
    for payer, polls in (("a", 400), ("b", 7), (None, 60), ("c", 1)):
        n = 0
        for i in range(polls):
            n += rng.choice((0, 0, 0, 0, 3))
            rows.append((payer, i, datetime(2024, 1, 1) + timedelta(minutes=i), None if rng.random() < 0.05 else n))
    want = []
    for payer in {r[0] for r in rows}:
        island, prior, flat, begin = 0, None, {}, None
        for _, _, at, n in sorted((r for r in rows if r[0] == payer), key=lambda r: r[1]):
            begin = begin or at
            if prior is None or (n is not None and n > prior):
                island += 1
            elif n is not None and at >= begin + timedelta(seconds=600):
                flat.setdefault(island, []).append(at)
            prior = n
        want += [(payer, i, len(ats), ats[0], ats[-1]) for i, ats in flat.items() if len(ats) >= 3]
    polls = spark.createDataFrame(rows, "payer_id string, poll_id long, at timestamp, n long")
    for most in (0, runs.LONG):  # in ranges, and in one window
        got = [tuple(r) for r in runs.stalls(polls, 3, 600, most).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 20
        assert runs.stalls(polls.limit(0), most=most).count() == 0
    cut, part = runs.in_ranges(polls, ["payer_id", "at"])
    assert cut.filter("payer_id = 'a'").select(part).distinct().count() > 1


def test_prior_counts_of_a_payer_in_many_ranges(spark, many_ranges):
    rng = random.Random(6)
    rows = [(p, "x", i, datetime(2024, 1, 1) + timedelta(minutes=i), rng.choice(("ok", "partial", "error", "error", "error")), rng.choice((None, 10, 20, 30))) for p, k in (("a", 300), (None, 40)) for i in range(k)]
    want, last = {}, {}
    for p, _, i, _, status, n in rows:
        want[(p, i)] = last.get(p)
        if status in ("ok", "partial") and n is not None:
            last[p] = n
    history = spark.createDataFrame(rows, "payer_id string, resource_type string, run_id long, started_at timestamp, status string, resource_count long")
    history = history.withColumns({"part": F.col("run_id") + 5, "newest": F.lit("own")})
    for most in (0, runs.LONG):
        found = runs.prior_counts(history, most=most).collect()
        assert {(r.payer_id, r.run_id): r.prior_count for r in found} == want
        assert all(r.part == r.run_id + 5 and r.newest == "own" for r in found)


def test_windows_of_time_go_down_to_a_second(spark):
    start, end = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc)
    rows = [(40_000 + i % 3,) for i in range(90)] + [(i * 7,) for i in range(40)] + [(-5,), (86_400,), (None,)]
    df = spark.createDataFrame(rows, "s long").select((F.lit(1_704_067_200) + F.col("s")).cast("timestamp").alias("ts"))
    for most, step in ((10, 3), (10, 8), (10, 30), (35, 5), (1000, 8)):
        leaves = {(r.level, r.bucket): r.n for r in planner.time_buckets(df, F.col("ts"), start, end, most, step=step).collect()}
        want, going = {}, [(0, 0, [s for (s,) in rows if s is not None and 0 <= s < 86_400])]
        while going:
            level, bucket, inside = going.pop()
            if inside and (len(inside) <= most or 86_400 / 2**level <= 1):
                want[(level, bucket)] = len(inside)
            elif inside:
                going += [(level + 1, b, [s for s in inside if s * 2 ** (level + 1) // 86_400 == b]) for b in (2 * bucket, 2 * bucket + 1)]
        assert leaves == want
    assert planner.seconds_deep(start, end) == 17 and planner.time_buckets(df.limit(0), F.col("ts"), start, end, 5).count() == 0


def test_status_grid(spark):
    counts = spark.createDataFrame([("a", "x", 3), ("a", "y", 4), ("b", "x", 9), ("c", "x", 0), ("d", "other", 5)], "payer_id string, resource_type string, n long")
    got = [tuple(r) for r in runs.status_grid(counts, ["x", "y"]).collect()]
    assert got == [("b", 9, 0, 9, 1), ("a", 3, 4, 7, 1), (None, 12, 4, 16, 2)]
    assert runs.status_grid(counts.limit(0), ["x"]).collect() == []


def test_entries_without_an_id_go(spark):
    from rosterlens.sources import bundles

    page = '{"entry":[{"resource":{"resourceType":"Location","id":""}},{"resource":{"resourceType":"Location","id":null}},{"resource":{"resourceType":"Location"}},{"resource":{"resourceType":"Location","id":"7"}},{}]}'
    assert [r.resource for r in bundles.bundle_entries(spark.createDataFrame([(page,)], "page string")).collect()] == ['{"resourceType":"Location","id":"7"}']


def test_lines_and_rejects_keep_their_file(spark, tmp_path):
    from rosterlens.operators import flatten
    from rosterlens.sources import bundles

    (tmp_path / "a.ndjson").write_text('{"resourceType":"Location","id":"1"}\n\n{bad\n{"resourceType":"Location","id":"1"}\n')
    (tmp_path / "b.ndjson").write_text('{"resourceType":"Patient","id":"1"}\n')
    lines = bundles.read_lines(spark, f"file://{tmp_path}").withColumns({"payer_id": F.lit("p"), "source_base_url": F.lit("u")})
    parsed = flatten.routed(lines).select("file", "payer_id", F.col("r.id").alias("id"), "reason")
    got = {r.file.rsplit("/", 1)[1]: tuple(r)[1:] for r in runs.reconciled_files(parsed).collect()}
    assert got == {"a.ndjson": (3, 1, 1, 33.3), "b.ndjson": (1, 1, 0, 0.0)}
    ok, bad = bundles.read_ndjson(spark, f"file://{tmp_path}")
    assert ok.count() == 3 and [r.file.rsplit("/", 1)[1] for r in bad.collect()] == ["a.ndjson"]
