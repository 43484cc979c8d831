"""Queries over versioned tables, export files, streams and status grids."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import flatten, merge, planner, runs, versions
from .sources import bundles
from .sources import projection as P
from .sources import resources as R
from .sources.shared import pinned_root
from .streaming.ingest import batch_counts, deliver, ingest

AS_OF = datetime(2001, 8, 1, tzinfo=timezone.utc)
_TABLES = tuple(R.RESOURCES)
_BAD = "p_partkey % 79 = 0 or p_partkey % 83 = 0 or p_partkey % 89 = 0 or p_partkey % 97 = 0"


def _leaves_sql(rows: str, width: int, most: int, last: int) -> str:
    """Leaves of dyadic windows: levels by second, a leaf's parent is too full."""
    return (
        f"with s as ({rows}), lv as (select k as level, (s * (1::bigint << k)) // {width} as bucket, count(*) as n from s, range(0, {last + 1}) r(k) group by 1, 2)"
        f" select a.level::int as level, a.bucket::bigint as bucket, a.n::bigint as n from lv a left join lv b on b.level = a.level - 1 and b.bucket = a.bucket >> 1"
        f" where (a.n <= {most} or a.level = {last}) and (a.level = 0 or b.n > {most})"
    )


#: One file of each of four deliveries for so many events; a delivery holds at most half of all, a file so two million rows.
_EVENTS_A_FILE = 4_000_000
#: Lines of one gzipped export file; what a batch of such files holds beside its tables doesn't follow the tables' size.
_LINES_A_FILE = 200_000
_CLUSTER = "case when event_id % 2 = 0 then epoch_us(timestamp '2024-01-20 12:34:00') // 1000000 + event_id % 60 else cast(floor(epoch(ts)) as bigint) end"
_GROUPS = [f"select 'payer_' || cast({k} % 5 as varchar) as payer_id, '{t}' as resource_type from {source}" for t, (source, k, _, _) in R.RESOURCES.items()]
_GRID_TOTAL = ", ".join(f"count(*) filter (where resource_type = '{t}')::bigint as {t}" for t in _TABLES)


def register(query) -> None:
    """Add this module's queries by the catalogue's decorator."""

    @query("time_buckets", _leaves_sql("select cast(floor(epoch(ts)) as bigint) - 1704067200 as s from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01'", 2678400, 700, 22), projected=False)
    def time_buckets(spark, d):
        return planner.time_buckets(P.raw(spark, d, "events"), F.col("ts").cast("timestamp"), datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc), 700)

    @query("time_buckets_cluster", _leaves_sql(f"select {_CLUSTER} - 1704067200 as s from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01'", 2678400, 20, 22), projected=False)
    def time_buckets_cluster(spark, d):
        """Half of the events lie in one minute, so its windows are halved down to a second."""
        at = F.when(F.col("event_id") % 2 == 0, F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-20 12:34:00").cast("timestamp")) + F.col("event_id") % 60)).otherwise(F.col("ts").cast("timestamp"))
        within = P.raw(spark, d, "events").filter("ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01'")
        return planner.time_buckets(within, at, datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc), 20)

    @query("ghost_rows", f"select payer_id, id from ({R.expected_sql('organization')}) where cast(id as bigint) % 7 = 3", projected=False)
    def ghost_rows(spark, d):
        """Two harvests of one export, the second without some resources; rows that it hasn't seen."""
        path, rows = pinned_root(spark), flatten.flatten(R.resources(spark, d, "organization"), "organization", datetime(2024, 1, 1, tzinfo=timezone.utc))
        second = rows.filter("cast(id as bigint) % 7 <> 3").withColumn("last_seen_at", F.lit(datetime(2024, 1, 2, tzinfo=timezone.utc)))
        for harvest in (rows, second):
            merge.merge_into(harvest, path, same="raw_hash", seen="last_seen_at")
        return runs.ghosts(merge.read(spark, path), datetime(2024, 1, 2, tzinfo=timezone.utc)).select("payer_id", "id")

    @query("unseen_rewrites", "select 2 as version, count(*)::bigint as n_rows, max(s_suppkey % 5)::bigint + 1 as payers, true as same_files from supplier", projected=False)
    def unseen_rewrites(spark, d):
        """A second harvest that only sees the same rows again: a new version, no new file of rows."""
        path, rows = pinned_root(spark), flatten.flatten(R.resources(spark, d, "organization"), "organization", datetime(2024, 1, 1, tzinfo=timezone.utc))
        merge.merge_into(rows, path, same="raw_hash", seen="last_seen_at")
        before = versions.current(spark, path)
        merge.merge_into(rows.withColumn("last_seen_at", F.lit(datetime(2024, 1, 2, tzinfo=timezone.utc))), path, same="raw_hash", seen="last_seen_at")
        after = versions.current(spark, path)
        return merge.read(spark, path).agg(F.lit(after.number).alias("version"), F.count("*").alias("n_rows"), F.countDistinct("payer_id").alias("payers"), F.lit(before.files["rows"] == after.files["rows"]).alias("same_files"))

    @query("status_grid", (
        f"with c as ({' union all '.join(_GROUPS)}) select payer_id, {_GRID_TOTAL}, count(*)::bigint as total, 1::bigint as payers from c group by 1"
        f" union all select null, {_GRID_TOTAL}, count(*)::bigint, count(distinct payer_id)::bigint from c having count(*) > 0"
    ), projected=False)
    def status_grid(spark, d):
        """Rows of all eight types by payer, with totals."""
        tables = {t: R.resources(spark, d, t) for t in _TABLES}
        return runs.status_grid(bundles.landed_counts(tables), list(_TABLES))

    @query("payers_listed", f"select distinct payer_id, resource_type from ({' union all '.join(_GROUPS)})", projected=False)
    def payers_listed(spark, d):
        """Payers of all eight tables from their manifests: no file of rows is opened."""
        root, out = pinned_root(spark), None
        for t in _TABLES:
            k, source = R.RESOURCES[t][1], R.RESOURCES[t][0]
            merge.merge_into(P.raw(spark, d, source).select(F.expr(P._payer(k)), F.expr(f"cast({k} as string)").alias("id")), f"{root}/{t}", buckets=2)
            found = versions.places(spark, versions.current(spark, f"{root}/{t}")).withColumn("resource_type", F.lit(t))
            out = found if out is None else out.unionByName(found)
        return out

    _file = "'payer_' || cast(p_partkey % 5 as varchar)"

    @query("file_reconciliation", (
        f"select {_file} as file, count(*)::bigint as lines, count(*) filter (where {_BAD})::bigint as rejects, count(*) filter (where not ({_BAD}))::bigint as loaded,"
        f" round(100.0::double * count(*) filter (where not ({_BAD})) / nullif(count(*), 0), 1) as coverage_pct from part group by 1"
    ), projected=False)
    def file_reconciliation(spark, d):
        """Location exports, one folder a payer, read back line by line: what each file's lines came to."""
        path = pinned_root(spark)
        P.location_resources(spark, d).select("payer_id", F.col("resource").alias("value")).repartition("payer_id").write.partitionBy("payer_id").text(path)
        lines = bundles.read_lines(spark, path).withColumns({"payer_id": F.regexp_extract("file", "payer_id=([^/]+)/", 1), "source_base_url": F.lit("https://h.example/fhir")})
        parsed = flatten.routed(lines).select("file", "payer_id", F.col("r.id").alias("id"), "reason")
        return runs.reconciled_files(parsed.withColumn("file", F.col("payer_id")))

    _counted = " union all ".join(f"select '{t}' as table_name, count(*)::bigint as n from {source}" for t, (source, *_) in R.RESOURCES.items())

    @query("stream_tables", f"with t as ({_counted}) select * from t union all select 'lines', sum(n)::bigint from t", projected=False)
    def stream_tables(spark, d):
        """All eight types as one mixed stream of NDJSON files, each line parsed once, merged into eight tables; and the lines that the writing jobs counted."""
        root, lines = pinned_root(spark), None
        for t in _TABLES:
            one = R.resources(spark, d, t, _LINES_A_FILE).select(F.col("resource").alias("value"))
            lines = one if lines is None else lines.unionByName(one)
        lines.write.option("compression", "gzip").text(f"{root}/in")
        ingest(spark, f"{root}/in", "payer_0", "https://h.example/fhir", _TABLES, f"{root}/out", f"{root}/mark", AS_OF, files=64).awaitTermination()
        out = batch_counts(spark, f"{root}/out").agg(F.lit("lines").alias("table_name"), F.sum("lines").alias("n"))
        for t in _TABLES:
            out = out.unionByName(merge.read(spark, f"{root}/out/{t}").agg(F.lit(t).alias("table_name"), F.count("*").alias("n")))
        return out

    @query("stream_counts", f"select count(*)::bigint as lines, count(*) filter (where {_BAD})::bigint as rejects from part", projected=False)
    def stream_counts(spark, d):
        """Lines and rejects that the writing job of every batch counted, over all batches."""
        root = pinned_root(spark)
        P.location_resources(spark, d).select(F.col("resource").alias("value")).repartition(6).write.text(f"{root}/in")
        ingest(spark, f"{root}/in", "payer_0", "https://h.example/fhir", ("location",), f"{root}/out", f"{root}/mark", AS_OF, files=2).awaitTermination()
        return batch_counts(spark, f"{root}/out").agg(F.sum("lines").alias("lines"), F.sum("rejects").alias("rejects"))

    @query("stream_deliveries", "select event_id, user_id from events", projected=False)
    def stream_deliveries(spark, d):
        """Events delivered in order of time, many of them again in a later batch: each comes through once.

        A delivery's files follow its rows, not how many tasks read the events: every batch copies
        and commits the state of all keys so far, so many small files cost most of the time.
        """
        root = pinned_root(spark)
        events = P.raw(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("at"))
        files = max(2, -(-events.count() // _EVENTS_A_FILE))
        for n in range(4):
            cut = events.filter(F.pmod(F.floor(F.unix_timestamp("at") / 86400), F.lit(4)) == n)
            again = events.filter((F.col("event_id") % 3 == n % 3) & (F.pmod(F.floor(F.unix_timestamp("at") / 86400), F.lit(4)) < n))
            cut.unionByName(again).repartition(files).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
        deliver(stream, ["event_id"], "at", "60 days", f"{root}/out", f"{root}/mark").awaitTermination()
        return spark.read.schema(events.schema).parquet(f"{root}/out").select("event_id", "user_id")

    @query("stalls_after_grace", (
        ", p as (select payer_id, run_id, started_at, min(started_at) over (partition by payer_id) as begin, resource_count > lag(resource_count) over w or lag(resource_count) over w is null as grew from run window w as (partition by payer_id order by started_at, run_id)),"
        " q as (select *, sum(grew::int) over (partition by payer_id order by started_at, run_id rows between unbounded preceding and current row) as island from p)"
        " select payer_id, island::bigint as island, count(*)::bigint as polls, min(started_at) as first_at, max(started_at) as last_at from q where not grew and started_at >= begin + interval 1200 second group by 1, 2 having count(*) >= 3"
    ))
    def stalls_after_grace(spark, d):
        """Stalls of three polls, none of them within 20 minutes of a payer's first."""
        return runs.stalls(P.runs(spark, d).select("payer_id", F.col("run_id").alias("poll_id"), F.col("started_at").alias("at"), F.col("resource_count").alias("n")), grace_seconds=1200)

    @query("source_families", "select case when p_partkey % 4 = 0 then 'shared-a' when p_partkey % 4 = 1 then 'shared-b' else 'h' || cast(p_partkey % 9 as varchar) || '.example.org' end as family, count(*)::bigint as n from part group by 1", projected=False)
    def source_families(spark, d):
        """Endpoints by the back-end that their hosts share."""
        k = F.col("p_partkey")
        host = F.when(k % 4 == 0, F.concat(F.lit("x"), (k % 7).cast("string"), F.lit(".vendor-a.com"))).when(k % 4 == 1, F.concat(F.lit("api."), F.lit("b"), (k % 5).cast("string"), F.lit("fhir.com"))).otherwise(F.concat(F.lit("h"), (k % 9).cast("string"), F.lit(".example.org")))
        url = F.concat(F.lit("https://"), host, F.lit("/fhir"))
        family = S.source_family(url, {r"\.vendor-a\.com$": "shared-a", r"^api\.[a-z0-9]+fhir\.com$": "shared-b"})
        return P.raw(spark, d, "part").groupBy(family.alias("family")).agg(F.count("*").alias("n"))

    @query("key_slugs", "select case when c_custkey % 4 = 3 then null when c_custkey % 4 = 2 then 'x_' || lower(c_mktsegment) else lower(c_mktsegment) end as slug, count(*)::bigint as n from customer group by 1", projected=False)
    def key_slugs(spark, d):
        k, name = F.col("c_custkey") % 4, F.col("c_mktsegment")
        key = F.when(k == 3, F.concat(F.lit("9"), name)).when(k == 2, F.concat(F.lit(" X-"), name)).otherwise(name)
        return P.raw(spark, d, "customer").groupBy(S.key_slug(key).alias("slug")).agg(F.count("*").alias("n"))

    @query("score_bands", "select case when event_id % 9 = 0 then 'none' when value >= 80 then 'good' when value >= 55 then 'mid' else 'bad' end as band, count(*)::bigint as n from events group by 1", projected=False)
    def score_bands(spark, d):
        score = F.when(F.col("event_id") % 9 != 0, F.col("value"))
        return P.raw(spark, d, "events").groupBy(S.score_band(score).alias("band")).agg(F.count("*").alias("n"))

    @query("value_list_sweep", "select o_orderpriority as value, count(*)::bigint as n from orders where o_orderpriority <> '5-LOW' group by 1", projected=False)
    def value_list_sweep(spark, d):
        """A list of values kept as a text file, with blanks and repeats, swept for the rows that each holds."""
        path, orders = pinned_root(spark), P.raw(spark, d, "orders")
        orders.filter("o_orderpriority <> '5-LOW'").select(F.concat(F.lit(" "), "o_orderpriority").alias("value")).distinct().unionByName(spark.range(3).select(F.lit("  ").alias("value"))).write.text(path)
        return planner.value_buckets(orders, "o_orderpriority", bundles.value_list(spark, path))
