"""How well elements are populated, and scores over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pct
from ..plans.rules import Element


def population(df: DataFrame, resource_type: str, elements: tuple[Element, ...], conditions: dict[str, Column] | None = None) -> DataFrame:
    """(payer_id, resource_type, element, required, n, populated, pct): one scan with one conditional count for each element."""
    at = {e.name: (conditions or {}).get(e.name, None) for e in elements}
    counts = [F.count_if(e.condition() if at[e.name] is None else at[e.name]).alias(f"e{i}") for i, e in enumerate(elements)]
    wide = df.groupBy("payer_id").agg(F.count("*").alias("n"), *counts)
    rows = ", ".join(f"'{e.name}', {str(e.required).lower()}, e{i}" for i, e in enumerate(elements))
    long = wide.select("payer_id", F.lit(resource_type).alias("resource_type"), "n", F.expr(f"stack({len(elements)}, {rows}) as (element, required, populated)"))
    return long.select("payer_id", "resource_type", "element", "required", "n", "populated", pct(F.col("populated"), F.col("n")).alias("pct"))


def by_type(long: DataFrame) -> DataFrame:
    """(payer_id, resource_type, n, completeness, conformance): means of rounded percentages; conformance is null without required elements."""
    return long.groupBy("payer_id", "resource_type").agg(
        F.max("n").alias("n"),
        F.round(F.avg("pct"), 1).alias("completeness"),
        F.round(F.avg(F.when(F.col("required"), F.col("pct"))), 1).alias("conformance"),
    )


def violations(long: DataFrame) -> DataFrame:
    """Required elements that some row lacks."""
    return long.filter("required and pct < 100").select("payer_id", "resource_type", "element", "pct")


def by_payer(types: DataFrame) -> DataFrame:
    """Row-weighted scores over a payer's types; types without a score don't weigh."""
    n = F.col("n")

    def weighted(c: str) -> Column:
        return F.round(F.sum(n * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), n)), 1).alias(c)

    return types.groupBy("payer_id").agg(F.sum("n").alias("total_rows"), F.count("*").alias("resources_with_data"), weighted("completeness"), weighted("conformance"))
