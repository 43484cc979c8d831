"""Registered queries over JSON resources of all eight types: flattening, rules, checks, boards."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import scalars as S
from .operators import elements, flatten, metrics, planner, refs, runs
from .plans.rules import CHECKS, ELEMENTS, source_filter
from .sources import bundles
from .sources.resources import RESOURCES, columns, expected_sql, present, resources

AS_OF = datetime(2002, 6, 1, tzinfo=timezone.utc)
#: Resources that one task flattens: some seconds of parsing.
ROWS_A_TASK = 50_000


def _flat(spark, d, table: str) -> DataFrame:
    return flatten.flatten(resources(spark, d, table, ROWS_A_TASK), table, AS_OF)


def _shown(df: DataFrame, table: str) -> DataFrame:
    """Arrays joined by commas, the timestamp in its own format."""
    out = ["payer_id", "id"]
    for c in columns(table):
        if c == "updated":
            out.append(F.date_format("meta_last_updated", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c))
        elif isinstance(df.schema[c].dataType, T.ArrayType):
            out.append(F.array_join(c, ",").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _presence(table: str, element) -> str:
    gives, there = columns(table), present(table)
    return " and ".join(f"({gives[c]}) is not null" for c in element.columns) if element.columns else there.get(element.key, "false")


_ROWS = {t: f"select 'payer_' || cast({k} % 5 as string) as payer_id, * from {source}" for t, (source, k, _, _) in RESOURCES.items()}
_RULE_COUNTS = " union all ".join(
    f"select payer_id, '{t}' as resource_type, '{e.name}' as element, {str(e.required).lower()} as required, count(*)::bigint as n, count(*) filter (where {_presence(t, e)})::bigint as populated from ({_ROWS[t]}) group by payer_id"
    for t, es in ELEMENTS.items() for e in es
)
_PCT = "round(100.0::double * {} / nullif({}, 0), 1)"
_RULES = f"with counts as ({_RULE_COUNTS}), long as (select *, {_PCT.format('populated', 'n')} as pct from counts)"


def _edges_sql() -> str:
    out = []
    for c in CHECKS:
        source, k, _, _ = RESOURCES[c.source]
        ref = columns(c.source)[c.column]
        one = f"unnest(string_split({ref}, ','))" if c.many else ref
        out.append(f"select payer_id, '{c.label}' as label, '{c.target}' as target, split_part(r, '/', 2) as ref_id from (select 'payer_' || cast({k} % 5 as string) as payer_id, {one} as r from {source}) where r is not null")
    return " union all ".join(out)


_TARGETS = " union ".join(f"select distinct 'payer_' || cast({RESOURCES[t][1]} % 5 as string) as payer_id, '{t}' as target, cast({RESOURCES[t][1]} as string) as ref_id from {RESOURCES[t][0]}" for t in sorted({c.target for c in CHECKS}))
_CHECKED = (
    f"with e as ({_edges_sql()}), held as ({_TARGETS}), c as (select e.payer_id, label, count(*)::bigint as total, count(held.ref_id)::bigint as resolved from e left join held using (payer_id, target, ref_id) group by 1, 2),"
    f" every_check as (select * from c union all select payer_id, null, sum(total)::bigint, sum(resolved)::bigint from c group by 1), shown as (select payer_id, label, total, resolved, total - resolved as dangling, {_PCT.format('resolved', 'total')} as pct from every_check)"
)
_FRESH_TABLES = ("organization", "practitioner", "location", "practitioner_role", "healthcare_service")
_STAMPS = " union all ".join(f"select 'payer_' || cast({RESOURCES[t][1]} % 5 as string) as payer_id, cast(replace({columns(t)['updated']}, 'Z', '') as timestamp) as stamp from {RESOURCES[t][0]}" for t in _FRESH_TABLES)
_COUNTS = " union all ".join(f"select 'payer_' || cast({RESOURCES[t][1]} % 5 as string) as payer_id, '{t}' as resource_type, {i} as place, count(*)::bigint as n from {RESOURCES[t][0]} group by 1" for i, t in enumerate(runs.DISPLAY_ORDER))


def register(query) -> None:
    for table in RESOURCES:
        def flat(spark, d, table=table):
            return _shown(_flat(spark, d, table), table)

        query(f"flatten_{table}_resources", expected_sql(table), False)(flat)

    def tables(spark, d, names=tuple(RESOURCES)) -> dict[str, DataFrame]:
        return {t: _flat(spark, d, t) for t in names}

    def population(spark, d) -> DataFrame:
        out = None
        for t, es in ELEMENTS.items():
            long = elements.population(_flat(spark, d, t), t, es)
            out = long if out is None else out.unionByName(long)
        return out

    @query("rule_population", f"{_RULES} select * from long", False)
    def rule_population(spark, d):
        """All 45 element rules, by JSON key or column."""
        return population(spark, d)

    @query("rule_scores", f"{_RULES} select payer_id, resource_type, max(n) as n, round(avg(pct), 1) as completeness, round(avg(pct) filter (where required), 1) as conformance from long group by 1, 2", False)
    def rule_scores(spark, d):
        return elements.by_type(population(spark, d))

    @query("weakest_elements", f"{_RULES}, o as (select *, row_number() over (partition by payer_id order by pct, resource_type, element)::int as place from long) select payer_id, place, resource_type, element, pct from o where place <= 5", False)
    def weakest_elements(spark, d):
        return runs.weakest(population(spark, d), ["resource_type", "element"], 5)

    @query("ref_checks_18", f"{_CHECKED} select * from shown", False)
    def ref_checks_18(spark, d):
        """All 18 reference checks over flattened resources."""
        return refs.check_all(tables(spark, d))

    @query("weakest_references", f"{_CHECKED}, o as (select *, row_number() over (partition by payer_id order by pct, label)::int as place from shown where label is not null) select payer_id, place, label, pct from o where place <= 5", False)
    def weakest_references(spark, d):
        return runs.weakest(refs.check_all(tables(spark, d)).filter("label is not null"), ["label"], 5)

    @query("freshness_five_tables", (
        f"with s as ({_STAMPS}) select payer_id, count(*)::bigint as total, count(stamp)::bigint as with_time, count(*) filter (where stamp > timestamp '2001-06-01')::bigint as within_12, count(*) filter (where stamp > timestamp '2000-06-01')::bigint as within_24,"
        f" {_PCT.format('count(*) filter (where stamp > timestamp ' + chr(39) + '2001-06-01' + chr(39) + ')', 'count(*)')} as score from s group by 1"
    ), False)
    def freshness_five_tables(spark, d):
        return metrics.freshness(list(tables(spark, d, _FRESH_TABLES).values()), AS_OF)

    @query("landed_all_types", f"with c as ({_COUNTS}) select payer_id, resource_type, n from c", False)
    def landed_all_types(spark, d):
        return bundles.landed_counts({t: resources(spark, d, t) for t in RESOURCES})

    @query("payer_board", (
        f"with c as ({_COUNTS}), t as (select payer_id, sum(n)::bigint as total from c group by 1), o as (select payer_id, total, row_number() over (order by total desc, payer_id)::int as payer_place from t)"
        " select payer_place, place as type_place, payer_id, resource_type, n, total from o join c using (payer_id)"
    ), False)
    def payer_board(spark, d):
        """Payers by rows, most first, with their types in display order."""
        return runs.ordered_board(bundles.landed_counts({t: resources(spark, d, t) for t in RESOURCES}))

    @query("default_strategies", "select * from (values ('organization', 'state'), ('practitioner', 'initial'), ('practitioner_role', null), ('location', 'state'), ('healthcare_service', 'initial'), ('organization_affiliation', null), ('insurance_plan', 'initial'), ('endpoint_resource', 'state')) t(resource_type, strategy)", False)
    def default_strategies(spark, d):
        """The bucket strategy of each type, by the keys that its resources hold."""
        out = None
        for t in RESOURCES:
            own = resources(spark, d, t).agg(F.bool_or(S.has_key(F.col("resource"), "address")).alias("a"), F.bool_or(S.has_key(F.col("resource"), "name")).alias("b"))
            row = own.select(F.lit(t).alias("resource_type"), planner.default_strategy(F.col("a"), F.col("b")).alias("strategy"))
            out = row if out is None else out.unionByName(row)
        return out

    @query("networks_only", f"select payer_id, id, name from ({expected_sql('organization')}) where is_network = 1", False)
    def networks_only(spark, d):
        return source_filter(_flat(spark, d, "organization"), "is_network", 1).select("payer_id", "id", "name")

    @query("state_probe", "select s.value, count(l.address_state)::bigint as n from (values " + ", ".join(f"('{s}')" for s in S.STATES) + f") s(value) left join ({expected_sql('location')}) l on upper(l.address_state) = s.value group by 1", False)
    def state_probe(spark, d):
        """Locations of every state of the list, also of states without any."""
        states = spark.createDataFrame([(s,) for s in S.STATES], "value string")
        return refs.value_probe(_flat(spark, d, "location").withColumn("state", F.upper("address_state")), states, "state")
