"""Readers of exports: NDJSON lines, bundle pages, mixed types, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Resource types and their tables.
TYPES = {
    "Organization": "organization", "Practitioner": "practitioner", "PractitionerRole": "practitioner_role", "Location": "location",
    "HealthcareService": "healthcare_service", "OrganizationAffiliation": "organization_affiliation", "InsurancePlan": "insurance_plan", "Endpoint": "endpoint_resource",
}


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects) of JSON lines in ``value``: blank lines go, lines that don't parse are rejects with a reason."""
    some = lines.withColumn("resource", F.trim("value")).filter("resource <> ''")
    parsed = some.withColumn("good", F.try_parse_json("resource").isNotNull())
    file = ["file"] if "file" in lines.columns else []
    return parsed.filter("good").drop("good", "value"), parsed.filter("not good").select(*file, "resource", F.lit("bad-json").alias("reason"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, resource) of the lines of NDJSON files that aren't blank, whatever they hold."""
    return some_lines(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")))


def some_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("resource", F.trim("value")).filter("resource <> ''").drop("value")


def read_ndjson(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects) of the lines of NDJSON files, each with its file."""
    return split_lines(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")))


def bundle_entries(pages: DataFrame, resource_type: str | None = None, column: str = "page") -> DataFrame:
    """(other columns, resource) of every entry of JSON bundles that has an id that isn't empty, and the requested type if one is named."""
    rest = [c for c in pages.columns if c != column]
    entries = pages.select(*rest, F.explode(F.from_json(column, "entry array<struct<resource:string>>")["entry"]).alias("e")).select(*rest, "e.resource")
    out = entries.filter(F.get_json_object("resource", "$.id") != "")
    return out if resource_type is None else out.filter(F.get_json_object("resource", "$.resourceType") == resource_type)


def route(df: DataFrame, types: dict[str, str] = TYPES) -> DataFrame:
    """Rows of the harvested types, with ``table_name``."""
    mapping = F.create_map(*(F.lit(x) for pair in types.items() for x in pair))
    return df.withColumn("table_name", F.try_element_at(mapping, F.get_json_object("resource", "$.resourceType"))).filter("table_name is not null")


def valid_manifest(df: DataFrame) -> DataFrame:
    """Endpoints with a usable key and an https URL; trailing slashes go."""
    return df.filter(F.col("key").rlike("^[a-z][a-z0-9_]*$") & F.col("url").startswith("https://")).withColumn("url", F.regexp_replace("url", "/+$", ""))


def inventory(manifest: DataFrame) -> DataFrame:
    """(status, endpoints, hosts, brands, runnable) of a manifest."""
    return manifest.groupBy("status").agg(
        F.count("*").alias("endpoints"),
        F.countDistinct(F.try_parse_url("url", F.lit("HOST"))).alias("hosts"),
        F.sum(F.size("brands")).alias("brands"),
        F.count_if("runnable").alias("runnable"),
    )


def value_list(spark: SparkSession, path: str) -> DataFrame:
    """(value) of a list kept as a text file, one to a line, each once: long lists, as of specialty codes, are parameters."""
    return spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> ''").distinct()


def payers_with_data(tables: list[DataFrame]) -> DataFrame:
    out = tables[0].select("payer_id")
    for df in tables[1:]:
        out = out.unionByName(df.select("payer_id"))
    return out.distinct()


def landed_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(payer_id, resource_type, n) of every table."""
    out = None
    for name, df in tables.items():
        c = df.groupBy("payer_id").agg(F.count("*").alias("n")).withColumn("resource_type", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out.select("payer_id", "resource_type", "n")


def select_endpoints(manifest: DataFrame, keys: list[str] | None = None, status: str | None = None) -> DataFrame:
    """Endpoints by key, by status, or all; keys that the manifest doesn't hold select nothing."""
    out = manifest if keys is None else manifest.filter(F.col("key").isin(keys))
    return out if status is None else out.filter(F.col("status") == status)


def expected_units(manifest: DataFrame, types: DataFrame) -> DataFrame:
    """(key, resource_type) that an endpoint should serve: its ``resources`` subset, or all of ``types`` where that is null."""
    grid = manifest.select("key", "resources").crossJoin(F.broadcast(types.select("resource_type")))  # eight types, whatever the data
    return grid.filter(F.col("resources").isNull() | F.array_contains("resources", F.col("resource_type"))).select("key", "resource_type")
