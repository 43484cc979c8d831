"""Capability documents: required against declared features, and what probes showed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import expectation

_EXTENSION = "extension:array<struct<url:string,valueCode:string>>"
_STATEMENT = f"rest array<struct<resource:array<struct<type:string,{_EXTENSION},interaction:array<struct<code:string,{_EXTENSION}>>,searchParam:array<struct<name:string,{_EXTENSION}>>,searchInclude:array<string>>>>>"
JUDGED = ("read", "search-type")


def statement_rows(df: DataFrame, column: str = "statement") -> DataFrame:
    """(other columns, resource_type, kind, item, expectation) of the first ``rest`` of each JSON statement."""
    rest = [c for c in df.columns if c != column]
    parsed = df.select(*rest, F.try_element_at(F.from_json(column, _STATEMENT)["rest"], F.lit(1))["resource"].alias("r"))
    resources = parsed.select(*rest, F.explode("r").alias("r"))
    items = F.concat(
        F.coalesce(F.transform("r.interaction", lambda x: F.struct(F.lit("interaction").alias("kind"), x["code"].alias("item"), expectation(x["extension"]).alias("expectation"))), F.array()),
        F.coalesce(F.transform("r.searchParam", lambda x: F.struct(F.lit("search_param").alias("kind"), x["name"].alias("item"), expectation(x["extension"]).alias("expectation"))), F.array()),
        F.coalesce(F.transform("r.searchInclude", lambda x: F.struct(F.lit("include").alias("kind"), x.alias("item"), F.lit(None).cast("string").alias("expectation"))), F.array()),
    )
    return resources.select(*rest, F.col("r.type").alias("resource_type"), F.explode(items).alias("i")).select(*rest, "resource_type", "i.*")


def matrix(required: DataFrame, declared: DataFrame, endpoints: DataFrame) -> DataFrame:
    """(endpoint, resource_type, kind, item, expectation, outcome) for every endpoint and requirement.

    ``endpoints``: endpoint, subset (array of types, null for all). Interactions other than
    read and search-type, and types outside the subset, are not applicable.
    """
    grid = endpoints.crossJoin(F.broadcast(required.select("resource_type", "kind", "item", "expectation")))  # the requirement statement: one guide's rows, whatever the data
    held = declared.select("endpoint", "resource_type", "kind", "item").distinct().withColumn("held", F.lit(True))
    joined = grid.join(held, ["endpoint", "resource_type", "kind", "item"], "left")
    outside = F.col("subset").isNotNull() & ~F.array_contains("subset", F.col("resource_type"))
    unjudged = (F.col("kind") == "interaction") & ~F.col("item").isin(*JUDGED)
    outcome = F.when(outside | unjudged, "not-applicable").when(F.col("held") & (F.col("kind") == "interaction"), "supported").when(F.col("held"), "declared").otherwise("not-declared")
    return joined.select("endpoint", "resource_type", "kind", "item", "expectation", outcome.alias("outcome"))


def fold_probes(cells: DataFrame, probes: DataFrame) -> DataFrame:
    """Outcomes overridden by probes (endpoint, resource_type, param, ok): of search-type, and of the one search parameter exercised."""
    p = probes.select("endpoint", "resource_type", "param", "ok")
    joined = cells.join(p, ["endpoint", "resource_type"], "left")
    hit = F.col("ok").isNotNull() & (F.col("outcome") != "not-applicable") & ((F.col("item") == "search-type") | ((F.col("kind") == "search_param") & (F.col("item") == F.col("param")) & (F.col("expectation") == "SHALL")))
    seen = F.when(F.col("ok"), "supported").otherwise("declared-but-failing")
    return joined.select(*(c for c in cells.columns if c != "outcome"), F.when(hit, seen).otherwise(F.col("outcome")).alias("outcome"))


def scores(cells: DataFrame) -> DataFrame:
    """(endpoint, resource_type, interactions_pct, shall_pct, should_pct): share met of what applies; null where nothing does."""
    met = F.col("outcome").isin("supported", "declared").cast("double") * 100
    some = F.col("outcome") != "not-applicable"

    def share(which) -> Column:
        return F.round(F.avg(F.when(some & which, met)), 1)

    param = F.col("kind") == "search_param"
    return cells.groupBy("endpoint", "resource_type").agg(
        share(F.col("kind") == "interaction").alias("interactions_pct"),
        share(param & (F.col("expectation") == "SHALL")).alias("shall_pct"),
        share(param & (F.col("expectation") == "SHOULD")).alias("should_pct"),
    )


def summary(cells: DataFrame, declared: DataFrame, probes: DataFrame) -> DataFrame:
    """Per endpoint: expected and declared types, their share, mean interaction score of declared types, probes run and passed."""
    types = cells.groupBy("endpoint", "resource_type").agg(F.bool_or(F.col("outcome") != "not-applicable").alias("expected"))
    held = declared.select("endpoint", "resource_type").distinct().withColumn("declared", F.lit(True))
    joined = types.join(held, ["endpoint", "resource_type"], "left").join(scores(cells), ["endpoint", "resource_type"]).filter("expected")
    has = F.coalesce("declared", F.lit(False))
    a = joined.groupBy("endpoint").agg(F.count("*").alias("expected"), F.count_if(has).alias("declared"), F.round(F.avg(F.when(has, F.col("interactions_pct"))), 1).alias("interactions_pct"))
    b = probes.groupBy("endpoint").agg(F.count("*").alias("probes"), F.count_if("ok").alias("passed"))
    out = a.join(b, "endpoint", "left").na.fill(0, ["probes", "passed"])
    share = lambda x, y: F.round(F.lit(100.0) * F.col(x) / F.nullif(F.col(y), F.lit(0)), 1)
    return out.select("endpoint", "expected", "declared", share("declared", "expected").alias("declared_pct"), "interactions_pct", "probes", "passed", share("passed", "probes").alias("passed_pct"))
