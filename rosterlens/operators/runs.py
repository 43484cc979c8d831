"""Run history: latest and prior runs, status, coverage, stalls, units due, snapshot changes."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import pct
from ..sources.shared import pinned


# The notes of a run's status, and the order in which types are shown.
REFUSED = "host refused the request"
NONE_LANDED = "0 rows landed vs server_total="
NOT_VERIFIED = "0 rows landed; server total unknown"
DISPLAY_ORDER = ("organization", "practitioner", "practitioner_role", "location", "healthcare_service", "organization_affiliation", "insurance_plan", "endpoint_resource")


def latest(runs: DataFrame, order: Column | str = "started_at") -> DataFrame:
    """The newest run of each (payer_id, resource_type); of equal times the largest run_id. One aggregation, no sort."""
    own = F.struct(*runs.columns)
    return runs.groupBy("payer_id", "resource_type").agg(F.max_by(own, F.struct(order, "run_id")).alias("r")).select("r.*")


def latest_finished(runs: DataFrame) -> DataFrame:
    """As ``latest`` by finished_at, unfinished runs last."""
    first = F.coalesce(F.col("finished_at"), F.lit(datetime(1, 1, 1)))
    return latest(runs, first)


#: A history of more rows of one key than this is cut into ranges; a shorter one is sorted whole, in one window.
LONG = 1_000_000


def long_history(df: DataFrame, keys: list[str], most: int) -> bool:
    """Whether some key has more rows than ``most``."""
    return not df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > most).isEmpty()


def in_ranges(df: DataFrame, order: list[str]) -> tuple[DataFrame, str]:
    """``df`` cut into ranges of ``order``, and the name of a new column with the range's number: a payer's history lies in many,
    and what one range needs of those before it is carried over by row counts of payers x ranges, so no payer is sorted in one task."""
    part = f"part_{uuid.uuid4().hex}"
    return pinned(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())), part


def carried(parts: DataFrame, keys: list[str], part: str, **values: Column) -> DataFrame:
    """(keys, part, values): windows over a payer's ranges, from the first to the one before."""
    return parts.select(*keys, part, *(v.over(Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)).alias(n) for n, v in values.items()))


def beside(df: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the other columns of ``few``'s row of the same keys; null keys are equal."""
    named = few.select(*(F.col(k).alias(f".{k}") for k in keys), *(F.col(f"`{c}`") for c in few.columns if c not in keys))
    found = df.join(named, [F.col(k).eqNullSafe(F.col(f"`.{k}`")) for k in keys])
    return found.drop(*(f".{k}" for k in keys))


def prior_counts(runs: DataFrame, drop: float = -10.0, most: int = LONG) -> DataFrame:
    """Each run with the count of the newest earlier run that was ok or partial, the change in percent, and whether it dropped."""
    keys = ["payer_id", "resource_type"]
    good = F.when(F.col("status").isin("ok", "partial"), F.col("resource_count"))
    if not long_history(runs, keys, most):
        w = Window.partitionBy(*keys).orderBy("started_at", "run_id").rowsBetween(Window.unboundedPreceding, -1)
        out = runs.withColumn("prior_count", F.last(good, ignorenulls=True).over(w))
    else:
        cut, part = in_ranges(runs, [*keys, "started_at", "run_id"])
        newest = F.max_by(good, F.when(good.isNotNull(), F.struct("started_at", "run_id")))
        before = carried(cut.groupBy(*keys, part).agg(newest.alias(".newest")), keys, part, **{".before": F.last("`.newest`", ignorenulls=True)})
        w = Window.partitionBy(*keys, part).orderBy("started_at", "run_id").rowsBetween(Window.unboundedPreceding, -1)
        joined = beside(cut.withColumn(".prior", F.last(good, ignorenulls=True).over(w)), before, [*keys, part])
        out = joined.select(*runs.columns, F.coalesce("`.prior`", "`.before`").alias("prior_count"))
    change = F.round(F.lit(100.0) * (F.col("resource_count") - F.col("prior_count")) / F.nullif(F.col("prior_count"), F.lit(0)), 1)
    return out.withColumn("pct_change", change).withColumn("dropped", F.coalesce(F.col("pct_change") <= drop, F.lit(False)))


def denominator(bare: Column, counted: Column, gaps: Column, mode: Column, match_all: Column) -> tuple[Column, Column]:
    """(total, where it comes from): a bare count if there is one, else a sum of windows or of declared match-all counts without gaps."""
    fit = (counted > 0) & ~F.coalesce(gaps, F.lit(False))
    source = F.when(bare.isNotNull(), "bare").when(fit & (mode == "daterange"), "daterange_window_sum").when(fit & F.coalesce(match_all, F.lit(False)), "match_all_count")
    return F.when(bare.isNotNull(), bare).when(source.isNotNull(), counted), source


def run_status(method: Column, note: Column, extract_error: Column, loaded: Column, total: Column, fetch_errors: Column, transform_errors: Column) -> Column:
    """(status, extra_note) of a run; the first rule that holds decides."""
    text = F.coalesce(note, F.lit(""))

    def made(status: str, extra: Column | None = None) -> Column:
        return F.struct(F.lit(status).alias("status"), (F.lit(None).cast("string") if extra is None else extra).alias("extra_note"))

    return (
        F.when(method.isin("blocked", "partition-failed"), made("error", F.when(text != "", text).otherwise(REFUSED)))
        .when(method.isin("needs-partition", "unsupported"), made("skipped"))
        .when(extract_error.isNotNull() & (loaded == 0), made("error"))
        .when(extract_error.isNotNull(), made("partial"))
        .when((total > 0) & (loaded == 0), made("error", F.concat(F.lit(NONE_LANDED), total.cast("string"))))
        .when(text.contains("pagination stopped") | text.contains("budget"), made("partial"))
        .when((F.coalesce(fetch_errors, F.lit(0)) + F.coalesce(transform_errors, F.lit(0))) > 0, made("partial"))
        .when((loaded == 0) & (total == 0), made("ok"))
        .when(loaded == 0, made("empty-unverified", F.lit(NOT_VERIFIED)))
        .otherwise(made("ok"))
    )


def coverage(loaded: Column, total: Column) -> tuple[Column, Column]:
    """(percent, residual) of loaded against declared rows; the percentage isn't capped."""
    return pct(loaded, total), F.when(total.isNotNull(), F.greatest(F.lit(0), total - loaded))


def truth_flags(coverage_pct: Column, note: Column) -> Column:
    """Array of warnings on a run."""
    return F.array_compact(F.array(F.when(coverage_pct > 100, "total-misreported"), F.when(F.coalesce(note, F.lit("")).contains("budget"), "own-cap-truncated")))


def coverage_board(grid: DataFrame, loaded: DataFrame, runs: DataFrame) -> DataFrame:
    """Every expected (payer_id, resource_type) with loaded rows, declared total, percentage, last run's status and flags."""
    keys = ["payer_id", "resource_type"]
    out = grid.join(loaded, keys, "left").join(latest(runs).select(*keys, "status", "started_at", "server_total", "notes"), keys, "left")
    percent, residual = coverage(F.coalesce("loaded", F.lit(0)), F.col("server_total"))
    return out.select(*keys, F.coalesce("loaded", F.lit(0)).alias("loaded"), "server_total", percent.alias("coverage_pct"), residual.alias("residual"), "status", F.col("started_at").alias("last_run"), truth_flags(percent, F.col("notes")).alias("flags"))


def finalised(done: DataFrame, history: DataFrame) -> DataFrame:
    """Provenance rows of finished units: denominator, status, prior count and change. ``done`` has one row per unit of this run."""
    total, source = denominator(F.col("bare_total"), F.col("counted_total"), F.col("count_gaps"), F.col("mode"), F.col("match_all"))
    out = done.withColumns({"server_total": total, "total_source": source})
    status = run_status(*(F.col(c) for c in ("method", "note", "extract_error", "loaded", "server_total", "fetch_errors", "transform_errors")))
    out = out.withColumn("s", status).select("*", "s.status", "s.extra_note").drop("s")
    prior = latest(history.filter(F.col("status").isin("ok", "partial"))).select("payer_id", "resource_type", F.col("resource_count").alias("prior_count"))
    out = out.join(prior, ["payer_id", "resource_type"], "left").withColumn("pct_change", F.round(F.lit(100.0) * (F.col("loaded") - F.col("prior_count")) / F.nullif(F.col("prior_count"), F.lit(0)), 1))
    run_id = F.sha2(F.concat_ws("|", "payer_id", "resource_type", F.col("started_at").cast("string")), 256)
    return out.withColumn("run_id", run_id)


def stalls(polls: DataFrame, k: int = 3, grace_seconds: int = 0, most: int = LONG) -> DataFrame:
    """(payer_id, island, polls, first_at, last_at): runs of at least ``k`` polls without growth after the grace period.

    ``polls``: payer_id, poll_id, at, n. A poll that grows, and the first one, starts an island.
    """
    own = polls.select("payer_id", "poll_id", "at", "n")
    if not long_history(own, ["payer_id"], most):
        w = Window.partitionBy("payer_id").orderBy("at", "poll_id")
        prior = own.withColumns({"prior": F.lag("n").over(w), "begin": F.min("at").over(w)})
        grown = prior.withColumn("grew", (F.col("n") > F.col("prior")) | F.col("prior").isNull())
        marked = grown.withColumn("island", F.sum(F.col("grew").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        cut, part = in_ranges(own, ["payer_id", "at", "poll_id"])
        ends = cut.groupBy("payer_id", part).agg(F.max_by("n", F.struct("at", "poll_id")).alias("last_n"), F.min("at").alias("from_at"))
        begun = ends.groupBy("payer_id").agg(F.min("from_at").alias("begin"))
        ends = beside(carried(ends, ["payer_id"], part, before_n=F.last("last_n")), begun, ["payer_id"])
        w = Window.partitionBy("payer_id", part).orderBy("at", "poll_id")
        held = beside(cut, ends, ["payer_id", part]).withColumn("prior", F.when(F.row_number().over(w) == 1, F.col("before_n")).otherwise(F.lag("n").over(w)))
        grown = held.withColumn("grew", (F.col("n") > F.col("prior")) | F.col("prior").isNull())
        opened = carried(grown.groupBy("payer_id", part).agg(F.count_if("grew").alias("islands")), ["payer_id"], part, before=F.sum("islands"))
        within = grown.withColumn("opened", F.sum(F.col("grew").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        marked = beside(within, opened, ["payer_id", part]).withColumn("island", F.coalesce("opened", F.lit(0)) + F.coalesce("before", F.lit(0)))
    flat = marked.filter(~F.col("grew") & (F.col("at") >= F.col("begin") + F.make_interval(secs=F.lit(grace_seconds))))
    return flat.groupBy("payer_id", "island").agg(F.count("*").alias("polls"), F.min("at").alias("first_at"), F.max("at").alias("last_at")).filter(F.col("polls") >= k)


def aged(polls: DataFrame, max_age_seconds: int) -> DataFrame:
    """(payer_id, first_at, last_at) of units polled for longer than ``max_age_seconds``, whether they grow or not."""
    span = polls.groupBy("payer_id").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    return span.filter(F.col("last_at") > F.col("first_at") + F.make_interval(secs=F.lit(max_age_seconds)))


def weakest(df: DataFrame, names: list[str], n: int) -> DataFrame:
    """(payer_id, place, names, pct): each payer's ``n`` smallest percentages, ties by name."""
    w = Window.partitionBy("payer_id").orderBy("pct", *names)
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n).select("payer_id", "place", *names, "pct").orderBy("payer_id", "place")


def ordered_board(counts: DataFrame, types: tuple[str, ...] = DISPLAY_ORDER) -> DataFrame:
    """(payer_place, type_place, payer_id, resource_type, n, total): payers by total, most first; a payer's types in display order."""
    place = F.create_map(*(F.lit(x) for i, t in enumerate(types) for x in (t, i)))
    total = counts.groupBy("payer_id").agg(F.sum("n").alias("total"))
    placed = total.withColumn("payer_place", F.row_number().over(Window.orderBy(F.desc("total"), "payer_id")))  # a row a payer
    out = counts.join(placed, "payer_id").select("payer_place", F.try_element_at(place, F.col("resource_type")).alias("type_place"), "payer_id", "resource_type", "n", "total")
    return out.orderBy("payer_place", "type_place")


def overview(scores: DataFrame) -> DataFrame:
    """(payers, total_rows, mean_composite) over all payers; payers without a composite don't count in the mean."""
    return scores.agg(F.count("*").alias("payers"), F.sum("total_rows").alias("total_rows"), F.round(F.avg("composite"), 1).alias("mean_composite"))


def due_units(plan: DataFrame, excluded: DataFrame, running: DataFrame, runs: DataFrame, since: datetime) -> DataFrame:
    """Units of the plan with why they are skipped (null: due)."""
    keys = ["payer_id", "resource_type"]
    done = runs.filter((F.col("status") == "ok") & (F.col("started_at") >= F.lit(since)))
    out = plan
    for name, df in (("excluded", excluded), ("running", running), ("fresh", done)):
        out = out.join(df.select(*keys).distinct().withColumn(f"_{name}", F.lit(name)), keys, "left")
    return out.select(*plan.columns, F.coalesce("_excluded", "_running", "_fresh").alias("skip_reason"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], hash_column: str) -> DataFrame:
    """(keys, change): added, removed, changed or unchanged."""
    a = old.select(*keys, F.col(hash_column).alias("_old"), F.lit(1).alias("_in_old"))
    b = new.select(*keys, F.col(hash_column).alias("_new"), F.lit(1).alias("_in_new"))
    change = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("changed")
    return a.join(b, keys, "full").select(*keys, change.alias("change"))


def ghosts(df: DataFrame, run_started: datetime) -> DataFrame:
    """Rows that the run started then has not seen."""
    return df.filter(F.col("last_seen_at") < F.lit(run_started))


def run_summary(runs: DataFrame) -> DataFrame:
    """(payer_id, loaded, ok), with a row over all payers whose payer_id is null."""
    return runs.rollup("payer_id").agg(F.sum("resource_count").alias("loaded"), F.bool_and(F.col("status") != "error").alias("ok"))


def crosstab(counts: DataFrame, types: list[str]) -> DataFrame:
    """(payer_id, one column per type, total) of (payer_id, resource_type, n); payers without rows are left out."""
    wide = counts.groupBy("payer_id").pivot("resource_type", types).agg(F.sum("n")).na.fill(0, types)
    return wide.withColumn("total", sum((F.col(t) for t in types[1:]), F.col(types[0]))).filter("total > 0")


def status_grid(counts: DataFrame, types: list[str]) -> DataFrame:
    """(payer_id, one column per type, total, payers): a row a payer with rows, the largest total first, and a last row of totals over all of them, whose payer_id is null.

    ``counts``: payer_id, resource_type, n, with payers that aren't null. One pass: the totals
    come from rolling up the payers of the pivoted sums. ``payers`` is 1 for a payer.
    """
    own = counts.filter(F.col("n") > 0).groupBy("payer_id").agg(
        *(F.coalesce(F.sum(F.when(F.col("resource_type") == t, F.col("n"))), F.lit(0)).alias(t) for t in types), F.sum(F.when(F.col("resource_type").isin(types), F.col("n"))).alias("total")
    ).filter("total > 0")
    both = own.rollup("payer_id").agg(*(F.sum(t).alias(t) for t in types), F.sum("total").alias("total"), F.count("*").alias("payers"), F.grouping("payer_id").alias(".all"))
    return both.filter("total is not null").orderBy("`.all`", F.desc("total"), "payer_id").drop(".all")


def reconciled_files(lines: DataFrame) -> DataFrame:
    """(file, lines, rejects, loaded, coverage_pct) of every export file: parsed lines with ``file``, ``reason`` and, for good ones, payer_id and id; an id counts once a file."""
    good = F.col("reason").isNull()
    out = lines.groupBy("file").agg(F.count("*").alias("lines"), F.count_if(~good).alias("rejects"), F.countDistinct(F.when(good, F.struct("payer_id", "id"))).alias("loaded"))
    return out.withColumn("coverage_pct", pct(F.col("loaded"), F.col("lines")))


def outcomes(log: DataFrame) -> DataFrame:
    return log.groupBy("outcome").agg(F.count("*").alias("n"))


def bulk_reconciliation(lines: DataFrame, loaded: DataFrame) -> DataFrame:
    """(lines, loaded, coverage_pct): non-blank lines of an export against distinct loaded ids."""
    n = lines.filter(F.trim("value") != "").agg(F.count("*").alias("lines"))
    m = loaded.agg(F.countDistinct("payer_id", "id").alias("loaded"))
    return n.join(m, F.lit(True)).select("lines", "loaded", pct(F.col("loaded"), F.col("lines")).alias("coverage_pct"))


def append(runs: DataFrame, path: str) -> None:
    """Add finished runs to the provenance table."""
    runs.write.mode("append").parquet(path)
