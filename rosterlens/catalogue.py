"""Registered queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import capability, elements, flatten, merge, metrics, planner, refs, runs
from .plans.rules import CHECKS, Element
from . import catalogue_resources, catalogue_tables
from .sources import bundles
from .sources import projection as P
from .sources.shared import pinned, pinned_root

AS_OF = datetime(2001, 8, 1, tzinfo=timezone.utc)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_ROLE_CHECKS = tuple(c for c in CHECKS if c.label in ("PractitionerRole.practitioner", "PractitionerRole.organization", "PractitionerRole.location"))
_WITH = f"with {P.CTES}"


def _query(name: str, sql: str | None = None, projected: bool = True):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql if sql.startswith("with ") or not projected else f"{_WITH}\n{sql}"
        return f

    return register


def _pct(a: str, b: str) -> str:
    return f"round(100.0::double * ({a}) / nullif({b}, 0), 1)"


def _check_sql(label: str, source: str, ref: str, target: str) -> str:
    return (
        f"select s.payer_id, '{label}' as label, count(*)::bigint as total, count(t.id)::bigint as resolved from {source} s"
        f" left join (select distinct payer_id, id from {target}) t on t.payer_id = s.payer_id and t.id = split_part(s.{ref}, '/', 2) where s.{ref} is not null group by s.payer_id"
    )


_CHECK_SQL = " union all ".join((
    _check_sql("PractitionerRole.practitioner", "practitioner_role", "practitioner_ref", "practitioner"),
    _check_sql("PractitionerRole.organization", "practitioner_role", "organization_ref", "organization"),
    _check_sql("PractitionerRole.location", "role_location", "ref", "location"),
    _check_sql("Location.managingOrganization", "location", "managing_organization_ref", "organization"),
    _check_sql("Organization.partOf", "organization", "part_of_ref", "organization"),
))
_ALL_CHECKS = f"checks as ({_CHECK_SQL}), every_check as (select * from checks union all select payer_id, null, sum(total)::bigint, sum(resolved)::bigint from checks group by payer_id)"
_SHOW = f"payer_id, label, total, resolved, total - resolved as dangling, {_pct('resolved', 'total')} as pct"


def _role_tables(spark, d) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Tables of the reference checks, and the roles' locations in long form."""
    return P.identified(spark, d), {"PractitionerRole.location": P.role_locations(spark, d)}


@_query("ref_scalar", f", checks as ({_check_sql('PractitionerRole.practitioner', 'practitioner_role', 'practitioner_ref', 'practitioner')}) select {_SHOW} from checks")
def ref_scalar(spark, d):
    tables = P.identified(spark, d)
    return refs.check_all({t: tables[t] for t in ("practitioner_role", "practitioner")}, _ROLE_CHECKS[:1]).filter("label is not null")


@_query("ref_array", f", checks as ({_check_sql('PractitionerRole.location', 'role_location', 'ref', 'location')}) select {_SHOW} from checks")
def ref_array(spark, d):
    return refs.check_all({"practitioner_role": P.roles(spark, d), "location": P.location(spark, d)}, _ROLE_CHECKS[2:]).filter("label is not null")


@_query("ref_all_checks", f", {_ALL_CHECKS} select {_SHOW} from every_check")
def ref_all_checks(spark, d):
    tables, links = _role_tables(spark, d)
    return refs.check_all(tables, links=links)


@_query("orphan_practitioner", "select payer_id, id from practitioner p where not exists (select 1 from practitioner_role r where r.payer_id = p.payer_id and split_part(r.practitioner_ref, '/', 2) = p.id)")
def orphan_practitioner(spark, d):
    return refs.orphans(P.practitioner(spark, d), P.roles(spark, d, False), "practitioner_ref").select("payer_id", "id")


@_query("orphan_location", "select payer_id, id from location l where not exists (select 1 from role_location r where r.payer_id = l.payer_id and split_part(r.ref, '/', 2) = l.id)")
def orphan_location(spark, d):
    return refs.orphans(P.location(spark, d), P.role_locations(spark, d), "ref").select("payer_id", "id")


@_query("orphan_organization", "select payer_id, id from organization o where is_network = 0 and not exists (select 1 from practitioner_role r where r.payer_id = o.payer_id and split_part(r.organization_ref, '/', 2) = o.id)")
def orphan_organization(spark, d):
    return refs.orphans(P.organization(spark, d).filter("is_network = 0"), P.roles(spark, d, False), "organization_ref").select("payer_id", "id")


_POPULATION = {
    "organization": (("active", True, ("active",)), ("name", True, ("name",)), ("npi", False, ("npi",)), ("part_of", False, ("part_of_ref",))),
    "practitioner": (("name", True, ("family",)), ("npi", False, ("npi",)), ("active", False, ("active",))),
    "location": (("name", True, ("name",)), ("state", False, ("address_state",)), ("city", False, ("address_city",)), ("position", False, ("latitude", "longitude"))),
    "practitioner_role": (("practitioner", False, ("practitioner_ref",)), ("organization", False, ("organization_ref",)), ("specialty", False, ("specialty",))),
}
_POPULATION_SQL = " union all ".join(
    f"select payer_id, '{t}' as resource_type, '{e}' as element, {str(r).lower()} as required, count(*)::bigint as n, count(*) filter (where {' and '.join(f'{c} is not null' for c in cs)})::bigint as populated from {t} group by payer_id"
    for t, es in _POPULATION.items() for e, r, cs in es
)
_LONG = f"counts as ({_POPULATION_SQL}), long as (select *, {_pct('populated', 'n')} as pct from counts)"
_TYPES = f"{_LONG}, types as (select payer_id, resource_type, max(n) as n, round(avg(pct), 1) as completeness, round(avg(pct) filter (where required), 1) as conformance from long group by 1, 2)"
_PAYERS = (
    f"{_TYPES}, payers as (select payer_id, sum(n)::bigint as total_rows, count(*)::bigint as resources_with_data, round(sum(n * completeness) / sum(n) filter (where completeness is not null), 1) as completeness,"
    " round(sum(n * conformance) / sum(n) filter (where conformance is not null), 1) as conformance from types group by 1)"
)


def _population(spark, d) -> DataFrame:
    tables = P.tables(spark, d) | {"practitioner_role": P.roles(spark, d, False)}
    out = None
    for t, es in _POPULATION.items():
        long = elements.population(tables[t], t, tuple(Element(e, r, cs) for e, r, cs in es))
        out = long if out is None else out.unionByName(long)
    return out


@_query("element_population", f", {_LONG} select payer_id, resource_type, element, required, n, populated, pct from long")
def element_population(spark, d):
    return _population(spark, d)


@_query("completeness_by_type", f", {_TYPES} select * from types")
def completeness_by_type(spark, d):
    return elements.by_type(_population(spark, d))


@_query("required_violations", f", {_LONG} select payer_id, resource_type, element, pct from long where required and pct < 100")
def required_violations(spark, d):
    return elements.violations(_population(spark, d))


@_query("completeness_by_payer", f", {_PAYERS} select * from payers")
def completeness_by_payer(spark, d):
    return elements.by_payer(elements.by_type(_population(spark, d)))


_FRESH = (
    "fresh as (select payer_id, count(*)::bigint as total, count(meta_last_updated)::bigint as with_time, count(*) filter (where meta_last_updated > timestamp '2000-08-01')::bigint as within_12,"
    f" count(*) filter (where meta_last_updated > timestamp '1999-08-01')::bigint as within_24, {_pct('count(*) filter (where meta_last_updated > timestamp ' + chr(39) + '2000-08-01' + chr(39) + ')', 'count(*)')} as score from practitioner_role group by 1)"
)


@_query("freshness", f", {_FRESH} select * from fresh")
def freshness(spark, d):
    return metrics.freshness([P.roles(spark, d, False)], AS_OF)


def _unique_sql(t: str) -> str:
    return f"select payer_id, '{t}' as resource_type, count(*)::bigint as n_rows, count(nullif(npi, ''))::bigint as with_npi, count(distinct nullif(npi, ''))::bigint as distinct_npi from {t} group by 1"


_UNIQUE = f"uniq as ({_unique_sql('practitioner')} union all {_unique_sql('organization')}), unique_long as (select *, with_npi - distinct_npi as duplicates, {_pct('with_npi', 'n_rows')} as coverage_pct, {_pct('distinct_npi', 'with_npi')} as unique_pct from uniq)"


@_query("uniqueness", f", {_UNIQUE} select * from unique_long")
def uniqueness(spark, d):
    return metrics.uniqueness({"practitioner": P.practitioner(spark, d), "organization": P.organization(spark, d)})


_STATES = ", ".join(f"'{s}'" for s in S.STATES)
_CONSISTENT = (
    f"c as (select payer_id, count(*)::bigint as n_rows, count(address_state)::bigint as with_state, count(*) filter (where upper(address_state) in ({_STATES}))::bigint as valid_state,"
    " count(*) filter (where regexp_matches(address_postalcode, '^[0-9]{5}'))::bigint as valid_zip, count(*) filter (where address_city is not null and address_state is not null)::bigint as city_state from location group by 1),"
    f" c2 as (select *, {_pct('valid_state', 'with_state')} as state_pct, {_pct('valid_zip', 'n_rows')} as zip_pct, {_pct('city_state', 'n_rows')} as city_state_pct from c),"
    " consistent as (select *, round(list_avg(list_filter([state_pct, zip_pct, city_state_pct], lambda x: x is not null)), 1) as score from c2)"
)


@_query("consistency", f", {_CONSISTENT} select * from consistent")
def consistency(spark, d):
    return metrics.consistency(P.location(spark, d))


_DIMS = (
    f"{_PAYERS}, {_ALL_CHECKS}, {_FRESH}, {_UNIQUE}, {_CONSISTENT}, integrity as (select payer_id, {_pct('resolved', 'total')} as referential_integrity from every_check where label is null),"
    " pu as (select payer_id, coalesce(max(unique_pct) filter (where resource_type = 'practitioner'), max(unique_pct) filter (where resource_type = 'organization')) as uniqueness from unique_long group by 1),"
    " dims as (select p.payer_id, p.completeness, p.conformance, i.referential_integrity, f.score as freshness, u.uniqueness, k.score as consistency from payers p left join integrity i using (payer_id) left join fresh f using (payer_id) left join pu u using (payer_id) left join consistent k using (payer_id))"
)


def _composite_sql(scheme: str, weights: tuple) -> str:
    named = list(zip(metrics.DIMENSIONS, weights, strict=True))
    top = " + ".join(f"coalesce({w!r}::double * {c}, 0)" for c, w in named)
    low = " + ".join(f"case when {c} is not null then {w!r}::double else 0 end" for c, w in named)
    return f"select payer_id, '{scheme}' as scheme, round(({top}) / nullif({low}, 0), 1) as composite from dims"


_SCORED = f"{_DIMS}, scored as ({' union all '.join(_composite_sql(s, w) for s, w in metrics.SCHEMES.items())})"


_RULES = {t: tuple(Element(e, r, cs) for e, r, cs in es) for t, es in _POPULATION.items()}


def _dimensions(spark, d) -> DataFrame:
    """Dimensions from one aggregation a table and the reference checks."""
    tables, (checked, links) = P.tables(spark, d) | {"practitioner_role": P.roles(spark, d, False)}, _role_tables(spark, d)
    return metrics.measured_dimensions(metrics.measured(tables, _RULES, AS_OF), _RULES, refs.check_all(checked, links=links))


@_query("dimension_scores", f", {_DIMS} select * from dims")
def dimension_scores(spark, d):
    return _dimensions(spark, d)


@_query("composite_score", f", {_SCORED} select * from scored")
def composite_score(spark, d):
    return metrics.composite(_dimensions(spark, d))


@_query("payer_ranking", f", {_SCORED} select payer_id, composite, rank() over (order by composite desc nulls last)::int as place from scored where scheme = 'default'")
def payer_ranking(spark, d):
    return metrics.ranking(metrics.composite(_dimensions(spark, d)))


_COUNTS = "counts as (select payer_id, 'organization' as resource_type, count(*) as n from organization group by 1 union all select payer_id, 'practitioner', count(*) from practitioner group by 1 union all select payer_id, 'location', count(*) from location group by 1)"


@_query("table_crosstab", f", {_COUNTS} select payer_id, coalesce(sum(n) filter (where resource_type = 'organization'), 0)::bigint as organization, coalesce(sum(n) filter (where resource_type = 'practitioner'), 0)::bigint as practitioner, coalesce(sum(n) filter (where resource_type = 'location'), 0)::bigint as location, sum(n)::bigint as total from counts group by 1")
def table_crosstab(spark, d):
    t = P.tables(spark, d)
    return runs.crosstab(bundles.landed_counts({k: t[k] for k in ("organization", "practitioner", "location")}), ["organization", "practitioner", "location"])


@_query("landed_counts", f", {_COUNTS} select payer_id, resource_type, n::bigint as n from counts")
def landed_counts(spark, d):
    t = P.tables(spark, d)
    return bundles.landed_counts({k: t[k] for k in ("organization", "practitioner", "location")})


@_query("payers_with_data", "select payer_id from organization union select payer_id from practitioner")
def payers_with_data(spark, d):
    return bundles.payers_with_data([P.organization(spark, d), P.practitioner(spark, d)])


@_query("tier_mix", "select case when c_mktsegment = 'BUILDING' then 'open' when c_mktsegment = 'MACHINERY' then 'public-token' else 'gated' end as tier, count(*)::bigint as n from customer group by 1")
def tier_mix(spark, d):
    auth = F.when(F.col("c_mktsegment") == "BUILDING", "none").when(F.col("c_mktsegment") == "MACHINERY", "public_token").otherwise("oauth")
    return P.raw(spark, d, "customer").groupBy(S.access_tier(auth).alias("tier")).agg(F.count("*").alias("n"))


_LATEST = "select payer_id, resource_type, run_id, started_at, resource_count, status from (select *, row_number() over (partition by payer_id, resource_type order by started_at desc, run_id desc) as i from run) where i = 1"


@_query("latest_run", _LATEST)
def latest_run(spark, d):
    return runs.latest(P.runs(spark, d))


_PRIOR = (
    "prior as (select *, last_value(case when status in ('ok', 'partial') then resource_count end ignore nulls) over (partition by payer_id, resource_type order by started_at, run_id rows between unbounded preceding and 1 preceding) as prior_count from run),"
    " changed as (select *, round(100.0::double * (resource_count - prior_count) / nullif(prior_count, 0), 1) as pct_change from prior)"
)


@_query("prior_count_change", f", {_PRIOR} select run_id, prior_count, pct_change from changed")
def prior_count_change(spark, d):
    return runs.prior_counts(P.runs(spark, d)).select("run_id", "prior_count", "pct_change")


@_query("data_drop", f", {_PRIOR} select payer_id, resource_type, count(*)::bigint as drops from changed where pct_change <= -10 group by 1, 2")
def data_drop(spark, d):
    return runs.prior_counts(P.runs(spark, d)).filter("dropped").groupBy("payer_id", "resource_type").agg(F.count("*").alias("drops"))


_STATUS_COLUMNS = {
    "method": "case event_id % 11 when 0 then 'blocked' when 1 then 'unsupported' else 'search' end", "note": "case event_id % 13 when 0 then 'request budget reached' when 1 then 'pagination stopped early' end",
    "extract_error": "case when event_id % 17 = 0 then 'timeout' end", "loaded": "case when event_id % 5 = 0 then 0 else cast(floor(value * 10) as bigint) end",
    "total": "case event_id % 4 when 0 then null when 1 then 0 else cast(floor(value * 10) as bigint) + event_id % 3 end", "fetch_errors": "event_id % 19 // 18", "transform_errors": "0",
}
_STATUS_SQL = (
    f"with e as (select event_id as run_id, {', '.join(f'{x} as {c}' for c, x in _STATUS_COLUMNS.items())} from events) select status, extra_note, count(*)::bigint as n from (select"
    " case when method in ('blocked', 'partition-failed') then 'error' when method in ('needs-partition', 'unsupported') then 'skipped' when extract_error is not null and loaded = 0 then 'error'"
    " when extract_error is not null then 'partial' when total > 0 and loaded = 0 then 'error' when note like '%pagination stopped%' or note like '%budget%' then 'partial' when fetch_errors + transform_errors > 0 then 'partial'"
    " when loaded = 0 and total = 0 then 'ok' when loaded = 0 then 'empty-unverified' else 'ok' end as status,"
    " case when method in ('blocked', 'partition-failed') then coalesce(note, 'host refused the request') when method in ('needs-partition', 'unsupported') or extract_error is not null then null when total > 0 and loaded = 0 then '0 rows landed vs server_total=' || cast(total as varchar)"
    " when coalesce(note, '') like '%pagination stopped%' or coalesce(note, '') like '%budget%' or fetch_errors + transform_errors > 0 or loaded > 0 or total = 0 then null else '0 rows landed; server total unknown' end as extra_note from e) group by 1, 2"
)


@_query("run_status", _STATUS_SQL)
def run_status(spark, d):
    e = P.raw(spark, d, "events").selectExpr(*(f"{x.replace('//', 'div')} as {c}" for c, x in _STATUS_COLUMNS.items()))
    status = runs.run_status(*(F.col(c) for c in ("method", "note", "extract_error", "loaded", "total", "fetch_errors", "transform_errors")))
    return e.withColumn("s", status).groupBy("s.status", "s.extra_note").agg(F.count("*").alias("n"))


@_query("coverage_board", (
    "with t as (select source, count(*)::bigint as server_total from documents group by 1), l as (select source, count(*)::bigint as loaded from documents join labels using (doc_id) group by 1)"
    f" select source, coalesce(loaded, 0) as loaded, server_total, {_pct('coalesce(loaded, 0)', 'server_total')} as coverage_pct, greatest(0, server_total - coalesce(loaded, 0)) as residual,"
    f" case when server_total = 0 then 'not served' when {_pct('coalesce(loaded, 0)', 'server_total')} >= 90 then 'high' when {_pct('coalesce(loaded, 0)', 'server_total')} >= 55 then 'mid' else 'low' end as band from t left join l using (source)"
))
def coverage_board(spark, d):
    docs = P.raw(spark, d, "documents").select("doc_id", "source")
    total = docs.groupBy("source").agg(F.count("*").alias("server_total"))
    loaded = docs.join(P.raw(spark, d, "labels").select("doc_id"), "doc_id").groupBy("source").agg(F.count("*").alias("loaded"))
    joined = total.join(loaded, "source", "left").withColumn("loaded", F.coalesce("loaded", F.lit(0)))
    percent, residual = runs.coverage(F.col("loaded"), F.col("server_total"))
    return joined.select("source", "loaded", "server_total", percent.alias("coverage_pct"), residual.alias("residual"), S.coverage_band(F.col("server_total"), percent).alias("band"))


@_query("run_scoreboard", (
    ", grid as (select distinct payer_id, resource_type from run), latest as (select payer_id, resource_type, run_id, started_at, resource_count, status from (select *, row_number() over (partition by payer_id, resource_type order by started_at desc, run_id desc) as i from run) where i = 1),"
    " loaded as (select payer_id, resource_type, max(resource_count) as loaded from run where status = 'ok' group by 1, 2)"
    f" select payer_id, resource_type, coalesce(loaded, 0) as loaded, resource_count as server_total, {_pct('coalesce(loaded, 0)', 'resource_count')} as coverage_pct, greatest(0, resource_count - coalesce(loaded, 0)) as residual, status,"
    f" case when {_pct('coalesce(loaded, 0)', 'resource_count')} > 100 then 'total-misreported' else '' end as flags from grid left join loaded using (payer_id, resource_type) left join latest using (payer_id, resource_type)"
))
def run_scoreboard(spark, d):
    r = P.runs(spark, d)
    loaded = r.filter("status = 'ok'").groupBy("payer_id", "resource_type").agg(F.max("resource_count").alias("loaded"))
    history = r.withColumn("server_total", F.col("resource_count")).withColumn("notes", F.lit(None).cast("string"))
    board = runs.coverage_board(r.select("payer_id", "resource_type").distinct(), loaded, history)
    return board.withColumn("flags", F.array_join("flags", ",")).drop("last_run")


@_query("run_totals", "select payer_id, sum(resource_count)::bigint as loaded, bool_and(status <> 'error') as ok from run group by rollup (payer_id)")
def run_totals(spark, d):
    return runs.run_summary(P.runs(spark, d))


@_query("outcome_totals", "select status as outcome, count(*)::bigint as n from run group by 1")
def outcome_totals(spark, d):
    return runs.outcomes(P.runs(spark, d).withColumnRenamed("status", "outcome"))


@_query("stalled_runs", (
    ", p as (select payer_id, run_id, started_at, resource_count > lag(resource_count) over w or lag(resource_count) over w is null as grew from run window w as (partition by payer_id order by started_at, run_id)),"
    " q as (select *, sum(grew::int) over (partition by payer_id order by started_at, run_id rows between unbounded preceding and current row) as island from p)"
    " select payer_id, island::bigint as island, count(*)::bigint as polls, min(started_at) as first_at, max(started_at) as last_at from q where not grew group by 1, 2 having count(*) >= 3"
))
def stalled_runs(spark, d):
    return runs.stalls(P.runs(spark, d).select("payer_id", F.col("run_id").alias("poll_id"), F.col("started_at").alias("at"), F.col("resource_count").alias("n")))


_SINCE = "2024-01-29"


@_query("due_units", (
    ", plan as (select distinct payer_id, resource_type from run) select payer_id, resource_type, case when resource_type = 'click' and payer_id = 'payer_1' then 'excluded'"
    " when exists (select 1 from run r where r.payer_id = plan.payer_id and r.resource_type = plan.resource_type and status = 'partial' and started_at >= timestamp '2024-01-31') then 'running'"
    f" when exists (select 1 from run r where r.payer_id = plan.payer_id and r.resource_type = plan.resource_type and status = 'ok' and started_at >= timestamp '{_SINCE}') then 'fresh' end as skip_reason from plan"
))
def due_units(spark, d):
    r = P.runs(spark, d)
    plan = r.select("payer_id", "resource_type").distinct()
    excluded = plan.filter("resource_type = 'click' and payer_id = 'payer_1'")
    running = r.filter("status = 'partial' and started_at >= timestamp '2024-01-31'")
    return runs.due_units(plan, excluded, running, r, datetime(2024, 1, 29, tzinfo=timezone.utc))


def _slices(spark, d) -> tuple[DataFrame, DataFrame]:
    o = P.raw(spark, d, "orders").selectExpr(P._payer("o_orderkey"), "cast(o_orderkey as string) id", "o_orderkey", "o_totalprice")
    return o.filter("o_orderkey % 3 <> 0").selectExpr("payer_id", "id", "o_totalprice as price"), o.filter("o_orderkey % 2 = 0").selectExpr("payer_id", "id", "case when o_orderkey % 4 = 0 then o_totalprice + 1 else o_totalprice end as price")


_SLICES = f"with o as (select {P._payer('o_orderkey')}, cast(o_orderkey as string) as id, o_orderkey as k, o_totalprice as price from orders), a as (select payer_id, id, price from o where k % 3 <> 0), b as (select payer_id, id, case when k % 4 = 0 then price + 1 else price end as price from o where k % 2 = 0)"


@_query("insert_merge", f"{_SLICES} select * from a union all select * from b where not exists (select 1 from a where a.payer_id = b.payer_id and a.id = b.id)")
def insert_merge(spark, d):
    a, b = _slices(spark, d)
    return merge.insert_only(a, b.unionByName(b))


@_query("update_merge", f"{_SLICES} select * from b union all select * from a where not exists (select 1 from b where a.payer_id = b.payer_id and a.id = b.id)")
def update_merge(spark, d):
    a, b = _slices(spark, d)
    return merge.update(a, b.unionByName(b))


@_query("snapshot_diff", f"{_SLICES} select coalesce(a.payer_id, b.payer_id) as payer_id, coalesce(a.id, b.id) as id, case when a.id is null then 'added' when b.id is null then 'removed' when a.price = b.price then 'unchanged' else 'changed' end as change from a full join b on a.payer_id = b.payer_id and a.id = b.id")
def snapshot_diff(spark, d):
    a, b = _slices(spark, d)
    return runs.snapshot_diff(a, b, ["payer_id", "id"], "price")


@_query("normalize_urls", (
    "with p as (select page_id, regexp_replace(url, '[?#].*$', '') as bare from pages), q as (select *, list_filter(string_split(bare, '/'), lambda x: x <> '') as parts from p)"
    " select page_id, case when len(parts) >= 2 then concat(parts[-2], '/', parts[-1]) else bare end as ref from q"
))
def normalize_urls(spark, d):
    return P.raw(spark, d, "pages").select("page_id", S.normalize_reference(F.col("url")).alias("ref"))


@_query("json_key_exists", "with e as (select event_id, props from events) select json_exists(props, '$.k') as has_k, json_exists(props, '$.absent') as has_absent, count(*)::bigint as n from e group by 1, 2")
def json_key_exists(spark, d):
    return P.raw(spark, d, "events").groupBy(S.has_key(F.col("props"), "k").alias("has_k"), S.has_key(F.col("props"), "absent").alias("has_absent")).agg(F.count("*").alias("n"))


@_query("json_extract", "with e as (select event_id, try_cast(props ->> '$.k' as double) as k from events) select event_id, least(k, 50.0::double) as k from e")
def json_extract(spark, d):
    return P.raw(spark, d, "events").select("event_id", S.json_double(F.col("props"), "$.k", 50.0).alias("k"))


@_query("hash_duplicates", "with t as (select min(doc_id) as first_id, count(*)::bigint as n from documents group by text) select first_id, n from t where n > 1")
def hash_duplicates(spark, d):
    own = P.raw(spark, d, "documents").select("doc_id", S.resource_hash(F.to_json(F.struct("text"))).alias("h"))
    return own.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("first_id", "n")


@_query("frontier_ids", (
    ", wanted as (select payer_id, split_part(ref, '/', 2) as id from role_location union select payer_id, split_part(managing_organization_ref, '/', 2) from location)"
    " select payer_id, id from wanted where id <> '' except select payer_id, id from location"
))
def frontier_ids(spark, d):
    roles = P.role_locations(spark, d).select("payer_id", "ref")
    places = P.location(spark, d)
    return refs.frontier(places, [roles, places.select("payer_id", F.col("managing_organization_ref").alias("ref"))])


@_query("include_closure", (
    ", base as (select * from practitioner_role where specialty in ('1-URGENT', '5-LOW')), x as (select distinct payer_id, 'practitioner' as t, split_part(practitioner_ref, '/', 2) as id from base where practitioner_ref is not null"
    " union select payer_id, 'organization', split_part(organization_ref, '/', 2) from base union select l.payer_id, 'location', split_part(l.ref, '/', 2) from role_location l join base using (payer_id, id)),"
    " held as (select payer_id, 'practitioner' as t, id from practitioner union all select payer_id, 'organization', id from organization union all select payer_id, 'location', id from location)"
    " select payer_id, t as resource_type, id from held semi join x using (payer_id, t, id) union all select payer_id, 'practitioner_role', id from base"
))
def include_closure(spark, d):
    t = P.tables(spark, d)
    values = t["practitioner_role"].select(F.col("specialty").alias("value")).filter(F.col("value").isin("1-URGENT", "5-LOW")).distinct()
    return refs.include_closure(t["practitioner_role"], values, "specialty", t, _ROLE_CHECKS)


@_query("chain_batches", "select payer_id, ((i - 1) // 7)::bigint as batch, count(*)::bigint as n, min(id) as first_id, max(id) as last_id from (select payer_id, id, row_number() over (partition by payer_id order by id) as i from practitioner) group by 1, 2")
def chain_batches(spark, d):
    return refs.chain_batches(P.practitioner(spark, d), 7)


@_query("reverse_chain", "select r.payer_id, r.id from practitioner_role r where exists (select 1 from practitioner p where p.payer_id = r.payer_id and p.id = split_part(r.practitioner_ref, '/', 2) and p.family is null)")
def reverse_chain(spark, d):
    return refs.reverse_chain(P.roles(spark, d, False), "practitioner_ref", P.practitioner(spark, d).filter("family is null")).select("payer_id", "id")


@_query("id_lookup", "select r.payer_id, count(*)::bigint as asked, count(p.id)::bigint as hits, count(*) - count(p.id) as not_found from (select distinct payer_id, split_part(practitioner_ref, '/', 2) as id from practitioner_role where practitioner_ref is not null) r left join practitioner p on p.payer_id = r.payer_id and p.id = r.id group by 1")
def id_lookup(spark, d):
    ids = P.roles(spark, d, False).filter("practitioner_ref is not null").select("payer_id", S.ref_id(F.col("practitioner_ref")).alias("id"))
    return refs.id_lookup(ids, P.practitioner(spark, d))


def _prefix_sql(name: str, most: int, depth: int) -> str:
    return (
        f"with s as (select substring(regexp_extract(lower({name}), '^[a-z0-9]*'), 1, {depth}) as s from part), lv as (select substring(s, 1, k) as prefix, k, count(*) as n from s, range(1, {depth + 1}) r(k) where length(s) >= k group by 1, 2)"
        f" select prefix, n::bigint as n from lv a where (n <= {most} or k = {depth}) and not exists (select 1 from lv b where b.k < a.k and b.prefix = substring(a.prefix, 1, b.k) and b.n <= {most})"
    )


@_query("prefix_buckets", _prefix_sql("p_name", 300, 6))
def prefix_buckets(spark, d):
    return planner.prefix_buckets(P.raw(spark, d, "part"), F.col("p_name"), 300)


@_query("prefix_buckets_md5", _prefix_sql("md5(cast(p_partkey as varchar))", 60, 6))
def prefix_buckets_md5(spark, d):
    return planner.prefix_buckets(P.raw(spark, d, "part"), F.md5(F.col("p_partkey").cast("string")), 60)


@_query("prefix_residual", f"with leaves as ({_prefix_sql('p_name', 300, 6)}), t as (select count(*)::bigint as total from part) select total, coalesce((select sum(n) from leaves), 0)::bigint as covered, total - coalesce((select sum(n) from leaves), 0)::bigint as residual from t")
def prefix_residual(spark, d):
    part = P.raw(spark, d, "part")
    return planner.prefix_residual(part, planner.prefix_buckets(part, F.col("p_name"), 300))


@_query("value_buckets", "select o_orderpriority as value, count(*)::bigint as n from orders where o_orderpriority in (select distinct o_orderpriority from orders where o_orderkey % 2 = 0) group by 1")
def value_buckets(spark, d):
    orders = P.raw(spark, d, "orders")
    return planner.value_buckets(orders, "o_orderpriority", orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderpriority").alias("value")).distinct())


@_query("value_probe", "select v.value, count(o.o_orderkey)::bigint as n from (select distinct n_name as value from nation union select distinct o_orderpriority from orders) v left join orders o on o.o_orderpriority = v.value group by 1")
def value_probe(spark, d):
    orders = P.raw(spark, d, "orders")
    values = P.raw(spark, d, "nation").select(F.col("n_name").alias("value")).unionByName(orders.select(F.col("o_orderpriority").alias("value"))).distinct()
    return refs.value_probe(orders, values, "o_orderpriority")


@_query("bundle_route", "with x as (select 'practitioner' as table_name, c_custkey as k from customer union all select 'organization', s_suppkey from supplier) select table_name, count(*)::bigint as n from x where k % 13 <> 0 group by 1")
def bundle_route(spark, d):
    return bundles.route(bundles.bundle_entries(P.bundles(spark, d))).groupBy("table_name").agg(F.count("*").alias("n"))


@_query("reject_summary", "with x as (select case when p_partkey % 79 = 0 then 'bad-json' when p_partkey % 83 = 0 then 'missing-id' when p_partkey % 97 = 0 then 'bad-position' when p_partkey % 89 = 0 then 'bad-address-line' else 'ok' end as reason from part) select reason, count(*)::bigint as n from x group by 1")
def reject_summary(spark, d):
    return flatten.reject_summary(P.location_resources(spark, d))


@_query("flatten_location", "with x as (select p_partkey as k, * from part) select concat('payer_', cast(k % 5 as varchar)) as payer_id, cast(k as varchar) as id, p_name as name, concat('1 Main St ', p_brand) as address_line, p_brand as address_city, case when k % 2 = 0 then p_size::double end as latitude from x where k % 79 <> 0 and k % 83 <> 0 and k % 97 <> 0 and k % 89 <> 0")
def flatten_location(spark, d):
    return flatten.flatten(P.location_resources(spark, d), "location", AS_OF).select("payer_id", "id", "name", "address_line", "address_city", "latitude")


def _statements(spark, d) -> DataFrame:
    """Capability statements of endpoints named by suppliers: features left out by the supplier's key."""
    k = F.col("s_suppkey")
    items = lambda *pairs: F.array_compact(F.array(*(F.when(keep, F.struct(F.lit(x).alias(c))) for c, x, keep in pairs)))
    resources = F.array(
        *(
            F.struct(
                F.lit(t).alias("type"),
                items(("code", "read", k % 2 == 0), ("code", "search-type", k % 3 != i), ("code", "vread", k % 5 == 0)).alias("interaction"),
                items(("name", "_id", k % 4 != i), ("name", "name", k % 5 != i)).alias("searchParam"),
            )
            for i, t in enumerate(("Organization", "Location"))
        )
    )
    return P.raw(spark, d, "supplier").select(F.col("s_name").alias("endpoint"), F.to_json(F.struct(F.array(F.struct(resources.alias("resource"))).alias("rest"))).alias("statement"))


def _required(spark, d) -> DataFrame:
    """Requirements on the types that the suppliers' statements name."""
    types = capability.statement_rows(_statements(spark, d)).select("resource_type").distinct()
    needs = (("interaction", "read", "SHALL"), ("interaction", "search-type", "SHALL"), ("interaction", "vread", "SHOULD"), ("search_param", "_id", "SHALL"), ("search_param", "name", "SHOULD"))
    rows = F.array(*(F.struct(F.lit(a).alias("kind"), F.lit(b).alias("item"), F.lit(c).alias("expectation")) for a, b, c in needs))
    return types.select("resource_type", F.explode(rows).alias("r")).select("resource_type", "r.*")


def _capability(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    declared = capability.statement_rows(_statements(spark, d))
    own = P.raw(spark, d, "supplier")
    endpoints = own.select(F.col("s_name").alias("endpoint"), F.when(F.col("s_suppkey") % 7 == 0, F.array(F.lit("Organization"))).alias("subset"))
    probes = own.filter("s_suppkey % 3 = 0").select(F.col("s_name").alias("endpoint"), F.lit("Organization").alias("resource_type"), F.lit("_id").alias("param"), (F.col("s_suppkey") % 2 == 0).alias("ok"))
    return capability.fold_probes(capability.matrix(_required(spark, d), declared, endpoints), probes), declared, probes


_CELLS = (
    "cells as (select s_name as endpoint, s_suppkey as k, t.t as resource_type, t.i, r.* from supplier, (values ('Organization', 0), ('Location', 1)) t(t, i),"
    " (values ('interaction', 'read', 'SHALL'), ('interaction', 'search-type', 'SHALL'), ('interaction', 'vread', 'SHOULD'), ('search_param', '_id', 'SHALL'), ('search_param', 'name', 'SHOULD')) r(kind, item, expectation)),"
    " held as (select *, case item when 'read' then k % 2 = 0 when 'search-type' then k % 3 <> i when 'vread' then k % 5 = 0 when '_id' then k % 4 <> i else k % 5 <> i end as has from cells),"
    " base as (select *, case when (k % 7 = 0 and resource_type <> 'Organization') or item = 'vread' then 'not-applicable' when has and kind = 'interaction' then 'supported' when has then 'declared' else 'not-declared' end as o from held),"
    " folded as (select endpoint, resource_type, kind, item, expectation, case when o <> 'not-applicable' and k % 3 = 0 and resource_type = 'Organization' and item in ('search-type', '_id') then case when k % 2 = 0 then 'supported' else 'declared-but-failing' end else o end as outcome, k, i from base)"
)


@_query("capability_matrix", f"with {_CELLS} select endpoint, resource_type, kind, item, expectation, outcome from folded")
def capability_matrix(spark, d):
    return _capability(spark, d)[0]


_SHARE = "round(avg(case when outcome in ('supported', 'declared') then 100.0::double else 0 end) filter (where outcome <> 'not-applicable' and {}), 1)"


@_query("capability_scores", f"with {_CELLS} select endpoint, resource_type, {_SHARE.format(chr(107) + 'ind = ' + chr(39) + 'interaction' + chr(39))} as interactions_pct, {_SHARE.format('item = ' + chr(39) + '_id' + chr(39))} as shall_pct, {_SHARE.format('item = ' + chr(39) + 'name' + chr(39))} as should_pct from folded group by 1, 2")
def capability_scores(spark, d):
    return capability.scores(_capability(spark, d)[0])


@_query("capability_summary", (
    f"with {_CELLS}, t as (select endpoint, resource_type, k, {_SHARE.format('kind = ' + chr(39) + 'interaction' + chr(39))} as s, bool_or(outcome <> 'not-applicable') as e from folded group by 1, 2, 3),"
    " dec as (select distinct endpoint, resource_type from held where has), u as (select t.*, dec.endpoint is not null as d from t left join dec using (endpoint, resource_type) where e)"
    f" select endpoint, count(*)::bigint as expected, count(*) filter (where d)::bigint as declared, {_pct('count(*) filter (where d)', 'count(*)')} as declared_pct, round(avg(s) filter (where d), 1) as interactions_pct,"
    " case when k % 3 = 0 then 1 else 0 end::bigint as probes, case when k % 6 = 0 then 1 else 0 end::bigint as passed, case when k % 6 = 0 then 100.0::double when k % 3 = 0 then 0 end as passed_pct from u group by endpoint, k"
))
def capability_summary(spark, d):
    return capability.summary(*_capability(spark, d))


@_query("manifest_inventory", f"with m as (select s_nationkey as r, s_suppkey as k from supplier) select case when k % 4 = 0 then 'parked' else 'live' end as status, count(*)::bigint as endpoints, count(distinct r)::bigint as hosts, sum(2)::bigint as brands, count(*) filter (where k % 4 <> 0)::bigint as runnable from m where k % 9 <> 0 group by 1")
def manifest_inventory(spark, d):
    k = F.col("s_suppkey")
    m = P.raw(spark, d, "supplier").select(
        F.when(k % 9 == 0, "Bad Key").otherwise(F.concat(F.lit("n"), k.cast("string"))).alias("key"),
        F.concat(F.lit("https://r"), F.col("s_nationkey").cast("string"), F.lit(".example/fhir//")).alias("url"),
        F.when(k % 4 == 0, "parked").otherwise("live").alias("status"), F.array("s_name", "s_name").alias("brands"), (k % 4 != 0).alias("runnable"),
    )
    return bundles.inventory(bundles.valid_manifest(m))


@_query("bulk_reconciliation", f"select count(*)::bigint as lines, count(*) filter (where p_partkey % 79 <> 0 and p_partkey % 83 <> 0 and p_partkey % 97 <> 0 and p_partkey % 89 <> 0)::bigint as loaded, {_pct('count(*) filter (where p_partkey % 79 <> 0 and p_partkey % 83 <> 0 and p_partkey % 97 <> 0 and p_partkey % 89 <> 0)', 'count(*)')} as coverage_pct from part")
def bulk_reconciliation(spark, d):
    lines = P.location_resources(spark, d)
    return runs.bulk_reconciliation(lines.select(F.col("resource").alias("value")), flatten.flatten(lines, "location", AS_OF))


@_query("stream_ingest", "with x as (select p_partkey as k, * from part) select cast(k as varchar) as id, p_name as name, p_brand as address_city from x where k % 79 <> 0 and k % 83 <> 0 and k % 97 <> 0 and k % 89 <> 0")
def stream_ingest(spark, d):
    """Location resources written as NDJSON files and read back as a stream, merged batch by batch."""
    from .streaming.ingest import ingest

    root = pinned_root(spark)
    P.location_resources(spark, d).select(F.col("resource").alias("value")).write.text(f"{root}/in")
    ingest(spark, f"{root}/in", "payer_0", "https://h.example/fhir", ("location",), f"{root}/out", f"{root}/mark", AS_OF).awaitTermination()
    return merge.read(spark, f"{root}/out/location").select("id", "name", "address_city")


@_query("latest_finished_run", f", f as (select *, case when run_id % 4 <> 0 then started_at + interval 5 minute end as finished_at from run) select payer_id, resource_type, run_id, finished_at from (select *, row_number() over (partition by payer_id, resource_type order by finished_at desc nulls last, run_id desc) as i from f) where i = 1")
def latest_finished_run(spark, d):
    r = P.runs(spark, d).withColumn("finished_at", F.expr("case when run_id % 4 <> 0 then started_at + interval 5 minute end"))
    return runs.latest_finished(r).select("payer_id", "resource_type", "run_id", "finished_at")


@_query("runs_of_the_month", ", m as (select payer_id, date_trunc('month', started_at) as month, count(*)::bigint as n from run group by 1, 2) select payer_id, strftime(month, '%Y-%m-%d') as month, n from m")
def runs_of_the_month(spark, d):
    return P.runs(spark, d).groupBy("payer_id", F.date_format(S.month_start(F.col("started_at")), "yyyy-MM-dd").alias("month")).agg(F.count("*").alias("n"))


_UNIT = {
    "payer_id": "concat('payer_', cast(user_id % 5 as string))", "resource_type": "event_type", "started_at": "cast(ts as timestamp)",
    "bare_total": "case when event_id % 3 = 0 then cast(floor(value * 10) as bigint) end", "counted_total": "case when event_id % 7 = 1 then 0 else cast(floor(value * 12) as bigint) end", "count_gaps": "event_id % 5 = 0",
    "mode": "case event_id % 4 when 0 then 'daterange' when 1 then 'name' else 'state' end", "match_all": "case event_id % 6 when 0 then true when 1 then false end", "method": "case event_id % 11 when 0 then 'blocked' when 1 then 'unsupported' else 'search' end",
    "note": "case event_id % 13 when 0 then 'request budget reached' end", "extract_error": "case when event_id % 17 = 0 then 'timeout' end", "loaded": "case when event_id % 5 = 0 then 0 else cast(floor(value * 10) as bigint) end",
    "fetch_errors": "case when event_id % 19 = 18 then 1 else 0 end", "transform_errors": "0",
}
_UNITS_SQL = ", ".join(f"{x} as {c}" for c, x in _UNIT.items())
_DENOMINATED = (
    f"u as (select event_id, {_UNITS_SQL} from events), fit as (select *, counted_total > 0 and not coalesce(count_gaps, false) as ok from u),"
    " t as (select *, case when bare_total is not null then 'bare' when ok and mode = 'daterange' then 'daterange_window_sum' when ok and match_all then 'match_all_count' end as total_source from fit),"
    " v as (select *, case when bare_total is not null then bare_total when total_source is not null then counted_total end as server_total from t)"
)


@_query("denominator_sources", f"with {_DENOMINATED} select total_source, count(*)::bigint as n, sum(server_total)::bigint as server_total from v group by 1")
def denominator_sources(spark, d):
    e = P.raw(spark, d, "events").selectExpr(*(f"{x} as {c}" for c, x in _UNIT.items()))
    total, source = runs.denominator(F.col("bare_total"), F.col("counted_total"), F.col("count_gaps"), F.col("mode"), F.col("match_all"))
    return e.select(source.alias("total_source"), total.alias("t")).groupBy("total_source").agg(F.count("*").alias("n"), F.sum("t").alias("server_total"))


@_query("finalised_runs", (
    f"with {P.CTES}, {_DENOMINATED}, p as (select payer_id, resource_type, resource_count as prior_count from (select *, row_number() over (partition by payer_id, resource_type order by started_at desc, run_id desc) as i from run where status in ('ok', 'partial')) where i = 1),"
    " w as (select v.*, case when method = 'blocked' then 'error' when method = 'unsupported' then 'skipped' when extract_error is not null and loaded = 0 then 'error' when extract_error is not null then 'partial' when server_total > 0 and loaded = 0 then 'error'"
    " when note like '%budget%' then 'partial' when fetch_errors > 0 then 'partial' when loaded = 0 and server_total = 0 then 'ok' when loaded = 0 then 'empty-unverified' else 'ok' end as status from v)"
    " select sha256(concat_ws('|', payer_id, resource_type, strftime(started_at, '%Y-%m-%d %H:%M:%S'))) as unit, server_total, total_source, status, prior_count, round(100.0::double * (loaded - prior_count) / nullif(prior_count, 0), 1) as pct_change from w left join p using (payer_id, resource_type)"
))
def finalised_runs(spark, d):
    """Every event as a unit that ended, against the history of all runs."""
    done = P.raw(spark, d, "events").selectExpr(*(f"{x} as {c}" for c, x in _UNIT.items()))
    unit = F.sha2(F.concat_ws("|", "payer_id", "resource_type", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss")), 256)
    return runs.finalised(done, P.runs(spark, d)).select(unit.alias("unit"), "server_total", "total_source", "status", "prior_count", "pct_change")


@_query("expected_scoreboard", (
    "with types as (select distinct event_type as resource_type from events), grid as (select cast(c_custkey as varchar) as payer_id, resource_type from customer, types where c_custkey % 3 <> 0 or resource_type in ('click', 'view')),"
    " r as (select cast(user_id as varchar) as payer_id, event_type as resource_type, event_id, ts, cast(floor(value * 10) as bigint) as n, case when event_id % 3 = 0 then 'request budget' end as notes from events),"
    " l as (select * from (select *, row_number() over (partition by payer_id, resource_type order by ts desc, event_id desc) as i from r) where i = 1), s as (select payer_id, resource_type, sum(n)::bigint as loaded from r group by 1, 2)"
    f" select payer_id, resource_type, coalesce(loaded, 0) as loaded, n as server_total, {_pct('coalesce(loaded, 0)', 'n')} as coverage_pct, case when n is not null then greatest(0, n - coalesce(loaded, 0)) end as residual,"
    f" concat_ws(',', case when {_pct('coalesce(loaded, 0)', 'n')} > 100 then 'total-misreported' end, case when notes like '%budget%' then 'own-cap-truncated' end) as flags from grid left join s using (payer_id, resource_type) left join l using (payer_id, resource_type)"
))
def expected_scoreboard(spark, d):
    """Every expected pair of customer and type, most of which no event covers."""
    e = P.raw(spark, d, "events").selectExpr("cast(user_id as string) payer_id", "event_type resource_type", "event_id run_id", "ts started_at", "cast(floor(value * 10) as bigint) server_total", "'ok' status", "case when event_id % 3 = 0 then 'request budget' end notes")
    manifest = P.raw(spark, d, "customer").selectExpr("cast(c_custkey as string) key", "case when c_custkey % 3 = 0 then array('click', 'view') end resources")
    grid = bundles.expected_units(manifest, e.select("resource_type").distinct()).withColumnRenamed("key", "payer_id")
    loaded = e.groupBy("payer_id", "resource_type").agg(F.sum("server_total").alias("loaded"))
    board = runs.coverage_board(grid, loaded, e)
    return board.select("payer_id", "resource_type", "loaded", "server_total", "coverage_pct", "residual", F.array_join("flags", ",").alias("flags"))


@_query("aged_units", ", a as (select payer_id, min(started_at) as first_at, max(started_at) as last_at from run group by 1) select * from a where last_at > first_at + interval 7 day")
def aged_units(spark, d):
    return runs.aged(P.runs(spark, d).select("payer_id", F.col("started_at").alias("at")), 7 * 86400)


@_query("overview", f", {_SCORED}, shown as (select p.payer_id, total_rows, composite from payers p left join (select * from scored where scheme = 'default') s using (payer_id)) select count(*)::bigint as payers, sum(total_rows)::bigint as total_rows, round(avg(composite), 1) as mean_composite from shown")
def overview(spark, d):
    scored = metrics.composite(_dimensions(spark, d)).filter("scheme = 'default'").select("payer_id", "composite")
    return runs.overview(completeness_by_payer(spark, d).select("payer_id", "total_rows").join(scored, "payer_id", "left"))


_DAYS = f"scores as (select payer_id, scheme as weight_scheme, composite from scored), old as (select payer_id, '2024-01-01' as scored_at, weight_scheme, composite - 1 as composite, null as detail from scores where payer_id <> 'payer_4'), new as (select payer_id, case when payer_id = 'payer_3' then '2024-01-02' else '2024-01-01' end as scored_at, weight_scheme, composite, case when weight_scheme = 'default' then payer_id end as detail from scores)"


@_query("score_upsert", f", {_SCORED}, {_DAYS} select * from new union all select * from old where not exists (select 1 from new where new.payer_id = old.payer_id and new.scored_at = old.scored_at and new.weight_scheme = old.weight_scheme)")
def score_upsert(spark, d):
    scores = pinned(metrics.composite(_dimensions(spark, d)).select("payer_id", F.col("scheme").alias("weight_scheme"), "composite"))
    old = scores.filter("payer_id <> 'payer_4'").selectExpr("payer_id", "'2024-01-01' scored_at", "weight_scheme", "composite - 1 composite", "cast(null as string) detail")
    new = scores.selectExpr("payer_id", "case when payer_id = 'payer_3' then '2024-01-02' else '2024-01-01' end scored_at", "weight_scheme", "composite", "payer_id detail")
    return merge.upsert_scores(old, new)


@_query("provenance_append", "select run_id, payer_id, resource_type, resource_count from run where run_id % 2 = 0 union all select run_id, payer_id, resource_type, resource_count from run where run_id % 2 = 1")
def provenance_append(spark, d):
    """Two batches of runs added to one table and read back."""
    path, r = pinned_root(spark), P.runs(spark, d).select("run_id", "payer_id", "resource_type", "resource_count")
    runs.append(r.filter("run_id % 2 = 0"), path)
    runs.append(r.filter("run_id % 2 = 1"), path)
    return spark.read.schema(r.schema).parquet(path)


@_query("report_files", "select payer_id, resource_type, run_id, resource_count, status, 'csv' as form from (select *, row_number() over (partition by payer_id, resource_type order by started_at desc, run_id desc) as i from run) where i = 1 union all select payer_id, resource_type, run_id, resource_count, status, 'json' from (select *, row_number() over (partition by payer_id, resource_type order by started_at desc, run_id desc) as i from run) where i = 1")
def report_files(spark, d):
    """The latest runs as CSV and JSON reports, read back from both."""
    path, r = pinned_root(spark), runs.latest(P.runs(spark, d)).select("payer_id", "resource_type", "run_id", "resource_count", "status")
    merge.write_reports(r, path)
    csv, js = spark.read.schema(r.schema).csv(f"{path}/csv", header=True), spark.read.schema(r.schema).json(f"{path}/json")
    return csv.withColumn("form", F.lit("csv")).unionByName(js.withColumn("form", F.lit("json")))


@_query("replace_load", f"{_SLICES} select * from a where payer_id <> 'payer_1' union all select * from b where payer_id = 'payer_1'")
def replace_load(spark, d):
    """One payer's partition replaced, the others left alone."""
    (a, b), path = _slices(spark, d), pinned_root(spark)
    merge.replace_partition(a, path)
    merge.replace_partition(b.filter("payer_id = 'payer_1'"), path)
    return spark.read.schema(a.schema).parquet(path).select(a.columns)


@_query("merge_into_files", f"{_SLICES} select payer_id, id, price from b union all select * from a where not exists (select 1 from b where a.payer_id = b.payer_id and a.id = b.id)")
def merge_into_files(spark, d):
    """Two snapshots merged into one partitioned table on disk, the second one twice."""
    (a, b), path = _slices(spark, d), pinned_root(spark)
    for batch in (a, b, b):
        merge.merge_into(batch, path)
    return merge.read(spark, path).select(a.columns)


def _guide(spark, d) -> DataFrame:
    """A requirement statement for each supplier, with expectations as extensions."""
    k = F.col("s_suppkey")
    said = lambda word: F.array(F.struct(F.lit("http://x/other").alias("url"), F.lit("MUST").alias("valueCode")), F.struct(F.lit("http://hl7.org/fhir/StructureDefinition/capabilitystatement-expectation").alias("url"), word.alias("valueCode")))
    resource = F.struct(
        F.lit("Location").alias("type"), F.array(F.struct(F.lit("read").alias("code"), said(F.when(k % 2 == 0, "SHALL").otherwise("SHOULD")).alias("extension"))).alias("interaction"),
        F.array(F.struct(F.lit("_id").alias("name"), said(F.lit("MAY")).alias("extension"))).alias("searchParam"), F.array(F.lit("Location:organization")).alias("searchInclude"),
    )
    later = F.struct(F.array(F.struct(F.lit("Endpoint").alias("type"), resource["interaction"].alias("interaction"), resource["searchParam"].alias("searchParam"), resource["searchInclude"].alias("searchInclude"))).alias("resource"))
    return P.raw(spark, d, "supplier").select(F.col("s_name").alias("guide"), F.to_json(F.struct(F.array(F.struct(F.array(resource).alias("resource")), later).alias("rest"))).alias("statement"))


@_query("requirement_rows", "with r as (select s_name as guide, s_suppkey as k, t.* from supplier, (values ('interaction', 'read'), ('search_param', '_id'), ('include', 'Location:organization')) t(kind, item)) select guide, 'Location' as resource_type, kind, item, case kind when 'search_param' then 'MAY' when 'interaction' then case when k % 2 = 0 then 'SHALL' else 'SHOULD' end end as expectation from r")
def requirement_rows(spark, d):
    """Requirements with their expectations, of the first rest of each statement."""
    return capability.statement_rows(_guide(spark, d))


catalogue_resources.register(_query)
catalogue_tables.register(_query)
