"""The directory projection of the driver's tables: suppliers, customers, parts, orders and events as directory rows.

Column lists are SQL expressions that Spark and other engines read alike, so that a query
and its SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import normalize_reference
from .shared import dealt, tasks_for


def _payer(key: str) -> str:
    return f"concat('payer_', cast({key} % 5 as string)) as payer_id"


ORGANIZATION = (
    _payer("s_suppkey"), "cast(s_suppkey as string) as id", "s_name as name", "case when s_suppkey % 10 = 0 then 1 else 0 end as is_network",
    "case when s_suppkey % 4 = 0 then null else lpad(cast(s_suppkey % 80 as string), 10, '0') end as npi",
    "case when s_suppkey % 3 = 0 then null else 1 end as active",
    "case when s_suppkey % 4 = 1 then concat('Organization/', cast(s_suppkey + 5 as string)) end as part_of_ref",
)
PRACTITIONER = (
    _payer("c_custkey"), "cast(c_custkey as string) as id", "case when c_custkey % 11 = 0 then null else c_name end as family",
    "case when c_custkey % 7 = 0 then null when c_custkey % 7 = 1 then '' else lpad(cast(c_custkey % 1200 as string), 10, '0') end as npi",
    "case when c_custkey % 3 = 0 then null else 1 end as active",
)
LOCATION = (
    _payer("p_partkey"), "cast(p_partkey as string) as id", "p_name as name",
    "case p_size % 6 when 0 then 'NY' when 1 then 'ca' when 2 then 'ZZ' when 4 then 'PR' when 5 then 'DC' end as address_state",
    "case when p_size % 5 = 0 then null else p_brand end as address_city",
    "case when p_size % 7 = 0 then 'ABC' when p_size % 7 = 1 then null else concat(lpad(cast(p_partkey % 100000 as string), 5, '0'), '-1234') end as address_postalcode",
    "case when p_partkey % 2 = 0 then cast(p_size as double) end as latitude", "case when p_partkey % 2 = 0 then cast(-p_size as double) end as longitude",
    "concat('Organization/', cast(p_partkey % 100 as string)) as managing_organization_ref",
)
ROLE = (
    _payer("o_orderkey"), "cast(o_orderkey as string) as id",
    "concat('Organization/', cast((o_custkey % 60) * 2 as string)) as organization_ref",
    "case when o_orderstatus = 'P' then null else o_orderpriority end as specialty", "cast(o_orderdate as timestamp) as meta_last_updated",
)
RAW_PRACTITIONER = (
    "case o_orderkey % 50 when 0 then concat('urn:uuid:', cast(o_custkey as string)) when 1 then concat('https://h.example/fhir/Practitioner/', cast(o_custkey as string), '?v=1')"
    " when 2 then null when 3 then '#p1' else concat('Practitioner/', cast(o_custkey as string)) end as practitioner_raw"
)
PRACTITIONER_REF = (
    "case o_orderkey % 50 when 0 then concat('urn:uuid:', cast(o_custkey as string)) when 2 then null when 3 then '' else concat('Practitioner/', cast(o_custkey as string)) end as practitioner_ref"
)
RUN = (
    _payer("user_id"), "event_type as resource_type", "event_id as run_id", "cast(ts as timestamp) as started_at", "cast(floor(value * 10) as bigint) as resource_count",
    "case event_id % 7 when 0 then 'error' when 1 then 'partial' when 2 then 'skipped' else 'ok' end as status",
)

CTES = f"""organization as (select {", ".join(ORGANIZATION)} from supplier),
practitioner as (select {", ".join(PRACTITIONER)} from customer),
location as (select {", ".join(LOCATION)} from part),
practitioner_role as (select {", ".join(ROLE)}, {PRACTITIONER_REF} from orders),
role_location as (select distinct {_payer("l_orderkey")}, cast(l_orderkey as string) as id, concat('Location/', cast(l_partkey as string)) as ref from lineitem join orders on l_orderkey = o_orderkey),
run as (select {", ".join(RUN)} from events)"""


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def organization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "supplier").selectExpr(*ORGANIZATION)


def practitioner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "customer").selectExpr(*PRACTITIONER)


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "part").selectExpr(*LOCATION)


def roles(spark: SparkSession, sf_dir: str, with_locations: bool = True) -> DataFrame:
    """Roles from orders; ``location_refs`` are the parts of their lines, null without any."""
    own = raw(spark, sf_dir, "orders").selectExpr(*ROLE, RAW_PRACTITIONER).withColumn("practitioner_ref", normalize_reference(F.col("practitioner_raw"))).drop("practitioner_raw")
    if not with_locations:
        return own
    parts = raw(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("id")).agg(F.collect_set(F.concat(F.lit("Location/"), F.col("l_partkey").cast("string"))).alias("location_refs"))
    return own.join(parts, "id", "left")


def role_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(payer_id, id, ref): the locations of roles, one row each; lines meet orders and their own repeats by the same key, on whole numbers.

    The orders name the number of tasks, which the lines take over: a repartition of the lines
    would be left above the join, a second shuffle of the larger table.
    """
    lines = raw(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    orders = raw(spark, sf_dir, "orders").select("o_orderkey").repartition(tasks_for(lines), "o_orderkey")
    own = lines.join(orders, "o_orderkey", "left_semi").distinct()
    return own.select(F.expr(_payer("o_orderkey")), F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("Location/"), F.col("l_partkey").cast("string")).alias("ref"))


def identified(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of the reference checks, roles without locations, each dealt into tasks by rows.

    A task of a check counts by id before anything moves, and one split of a file, cut by
    bytes, holds millions of ids.
    """
    own = {
        "organization": ("supplier", "s_suppkey", ORGANIZATION), "practitioner": ("customer", "c_custkey", PRACTITIONER),
        "location": ("part", "p_partkey", LOCATION), "practitioner_role": ("orders", "o_orderkey", (*ROLE, RAW_PRACTITIONER)),
    }
    out = {name: dealt(raw(spark, sf_dir, source), key).selectExpr(*columns) for name, (source, key, columns) in own.items()}
    roles = out["practitioner_role"].withColumn("practitioner_ref", normalize_reference(F.col("practitioner_raw"))).drop("practitioner_raw")
    return out | {"practitioner_role": roles}


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "events").selectExpr(*RUN)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"organization": organization(spark, sf_dir), "practitioner": practitioner(spark, sf_dir), "location": location(spark, sf_dir), "practitioner_role": roles(spark, sf_dir)}


#: Location resources as JSON, with the bad rows that a reject table must catch.
def location_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    line = F.when(k % 89 == 0, F.array(F.lit("a"), F.lit(None).cast("string"))).otherwise(F.array(F.lit("1 Main St"), F.col("p_brand")))
    latitude = F.when(k % 97 == 0, "").otherwise(F.when(k % 2 == 0, F.col("p_size").cast("string")))
    body = F.to_json(
        F.struct(
            F.lit("Location").alias("resourceType"),
            F.when(k % 83 != 0, k.cast("string")).alias("id"),
            F.col("p_name").alias("name"),
            F.struct(line.alias("line"), F.col("p_brand").alias("city")).alias("address"),
            F.struct(latitude.alias("latitude"), latitude.alias("longitude")).alias("position"),
        )
    )
    resource = F.when(k % 79 == 0, F.substring(body, 1, 25)).otherwise(body)
    return raw(spark, sf_dir, "part").select(F.expr(_payer("p_partkey")), F.lit("https://h.example/fhir").alias("source_base_url"), resource.alias("resource"))


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of mixed customers and suppliers, one per 50 keys of each, as JSON bundles."""

    def entries(table: str, key: str, kind: str) -> DataFrame:
        ids = F.when(F.col(key) % 13 != 0, F.col(key).cast("string"))
        return raw(spark, sf_dir, table).select(F.floor(F.col(key) / 50).alias("page_no"), F.struct(F.struct(F.lit(kind).alias("resourceType"), ids.alias("id")).alias("resource")).alias("e"))

    mixed = entries("customer", "c_custkey", "Practitioner").unionByName(entries("supplier", "s_suppkey", "Organization"))
    return mixed.groupBy("page_no").agg(F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), F.collect_list("e").alias("entry"))).alias("page")).select("page")
