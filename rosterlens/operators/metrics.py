"""Freshness, uniqueness, consistency and the composite score."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pct, state_valid, zip_valid
from ..plans.rules import DIMENSIONS, SCHEMES, Element


def freshness(tables: list[DataFrame], as_of: datetime) -> DataFrame:
    """Counts of rows by age of meta_last_updated; the score is the share within 12 months, rows without a time count against it."""
    out = None
    for df in tables:
        t = df.select("payer_id", F.col("meta_last_updated").alias("ts"))
        out = t if out is None else out.unionByName(t)

    def within(months: int) -> Column:
        return F.count_if(F.col("ts") > F.lit(as_of) - F.make_interval(F.lit(0), F.lit(months)))

    counts = out.groupBy("payer_id").agg(F.count("*").alias("total"), F.count("ts").alias("with_time"), within(12).alias("within_12"), within(24).alias("within_24"))
    return counts.withColumn("score", pct(F.col("within_12"), F.col("total")))


def uniqueness(tables: dict[str, DataFrame], exact: bool = True) -> DataFrame:
    """NPI counts by payer and type, and the share of distinct ones; ``exact=False`` counts distinct ones by a sketch."""
    out = None
    for name, df in tables.items():
        npi = F.nullif(F.col("npi"), F.lit(""))
        distinct = F.countDistinct(npi) if exact else F.approx_count_distinct(npi)
        c = df.groupBy("payer_id").agg(F.count("*").alias("n_rows"), F.count(npi).alias("with_npi"), distinct.alias("distinct_npi")).withColumn("resource_type", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out.select(
        "payer_id", "resource_type", "n_rows", "with_npi", "distinct_npi", (F.col("with_npi") - F.col("distinct_npi")).alias("duplicates"),
        pct(F.col("with_npi"), F.col("n_rows")).alias("coverage_pct"), pct(F.col("distinct_npi"), F.col("with_npi")).alias("unique_pct"),
    )


def _place_counts() -> tuple[Column, ...]:
    """Rows, with a state, with a valid one, with a valid ZIP, with a city and a state."""
    state = F.col("address_state")
    return F.count("*"), F.count(state), F.count_if(state_valid(state)), F.count_if(zip_valid(F.col("address_postalcode"))), F.count_if(F.col("address_city").isNotNull() & state.isNotNull())


def consistency(locations: DataFrame) -> DataFrame:
    """State, ZIP and city-with-state percentages; the score is the mean of those that aren't null."""
    names = ("n_rows", "with_state", "valid_state", "valid_zip", "city_state")
    c = locations.groupBy("payer_id").agg(*(count.alias(name) for count, name in zip(_place_counts(), names, strict=True)))
    c = c.select("*", pct(F.col("valid_state"), F.col("with_state")).alias("state_pct"), pct(F.col("valid_zip"), F.col("n_rows")).alias("zip_pct"), pct(F.col("city_state"), F.col("n_rows")).alias("city_state_pct"))
    some = F.array_compact(F.array("state_pct", "zip_pct", "city_state_pct"))
    return c.withColumn("score", F.round(F.when(F.size(some) > 0, F.aggregate(some, F.lit(0.0), lambda t, x: t + x) / F.size(some)), 1))


def measured(tables: dict[str, DataFrame], rules: dict[str, tuple[Element, ...]], as_of: datetime, dated=("practitioner_role",), unique=("practitioner", "organization"), places=("location",)) -> DataFrame:
    """(payer_id, resource_type, n, elements, fresh, npi, place): all counts of a table by payer that the dimensions need, each table read once.

    ``elements``: populated rows of each rule, in the rules' order; ``fresh``: rows, with a
    time, within 12 and 24 months, of the ``dated`` tables; ``npi``: with one, distinct ones,
    of the ``unique`` ones; ``place``: what ``consistency`` counts, of the ``places``.
    """
    out = None
    for name, df in tables.items():
        ts, npi = F.col("meta_last_updated") if name in dated else F.lit(None).cast("timestamp"), F.nullif(F.col("npi"), F.lit("")) if name in unique else None
        within = [F.count_if(ts > F.lit(as_of) - F.make_interval(F.lit(0), F.lit(m))) for m in (12, 24)]
        longs = lambda kept, *counts: (F.array(*counts) if kept else F.lit(None)).cast("array<bigint>")
        one = df.groupBy("payer_id").agg(
            F.count("*").alias("n"), longs(True, *(F.count_if(e.condition()) for e in rules.get(name, ()))).alias("elements"),
            longs(name in dated, F.count("*"), F.count(ts), *within).alias("fresh"), longs(name in unique, *((F.count(npi), F.countDistinct(npi)) if name in unique else ())).alias("npi"),
            longs(name in places, *(_place_counts() if name in places else ())).alias("place"),
        ).withColumn("resource_type", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("payer_id", "resource_type", "n", "elements", "fresh", "npi", "place")


def measured_dimensions(counts: DataFrame, rules: dict[str, tuple[Element, ...]], integrity: DataFrame) -> DataFrame:
    """``dimensions`` from ``measured`` counts (a row a payer and table) and the reference checks, in one grouping by payer."""
    named = F.create_map(*(x for name, es in rules.items() for x in (F.lit(name), F.array(*(F.lit(e.required) for e in es)))))
    needed = F.coalesce(F.try_element_at(named, F.col("resource_type")), F.array().cast("array<boolean>"))
    pcts = F.transform("elements", lambda c: pct(c, F.col("n")))
    forced = F.zip_with(pcts, needed, lambda p, r: F.when(r, p))

    def mean(values: Column) -> Column:
        some = F.array_compact(values)
        return F.round(F.when(F.size(some) > 0, F.aggregate(some, F.lit(0.0), lambda t, x: t + x) / F.size(some)), 1)

    def weighted(c: str) -> Column:
        return F.round(F.sum(F.col("n") * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), F.col("n"))), 1).alias(c)

    def total(c: str, i: int) -> Column:
        return F.sum(F.get(F.col(c), F.lit(i)))

    scored = counts.withColumns({"completeness": mean(pcts), "conformance": mean(forced), "own": pct(F.get("npi", F.lit(1)), F.get("npi", F.lit(0)))})
    rank = F.when(F.col("resource_type") == "practitioner", 0).otherwise(1)
    shares = F.array(*(pct(total("place", i), total("place", j)) for i, j in ((2, 1), (3, 0), (4, 0))))
    out = scored.groupBy("payer_id").agg(
        weighted("completeness"), weighted("conformance"), pct(total("fresh", 2), total("fresh", 0)).alias("freshness"),
        F.min_by("own", F.when(F.col("own").isNotNull(), rank)).alias("uniqueness"), shares.alias("shares"),
    )
    checked = integrity.filter("label is null").select("payer_id", F.col("pct").alias("referential_integrity"))
    return out.withColumn("consistency", mean(F.col("shares"))).join(checked, "payer_id", "full").select("payer_id", *DIMENSIONS)


def dimensions(completeness: DataFrame, integrity: DataFrame, fresh: DataFrame, unique: DataFrame, consistent: DataFrame) -> DataFrame:
    """One row per payer with the six dimensions; a missing one is null."""
    integrity = integrity.filter("label is null").select("payer_id", F.col("pct").alias("referential_integrity"))
    rank = F.when(F.col("resource_type") == "practitioner", 0).otherwise(1)
    unique = unique.filter("unique_pct is not null").groupBy("payer_id").agg(F.min_by("unique_pct", rank).alias("uniqueness"))
    out = completeness.select("payer_id", "completeness", "conformance")
    for df in (integrity, fresh.select("payer_id", F.col("score").alias("freshness")), unique, consistent.select("payer_id", F.col("score").alias("consistency"))):
        out = out.join(df, "payer_id", "full")
    return out.select("payer_id", *DIMENSIONS)


def composite(dims: DataFrame, schemes: dict[str, tuple] = SCHEMES) -> DataFrame:
    """(payer_id, scheme, composite): weighted mean over the dimensions that aren't null; null if all are."""
    total = lambda w: sum((F.when(F.col(d).isNotNull(), F.lit(x) * F.col(d)).otherwise(0.0) for d, x in zip(DIMENSIONS, w, strict=True)), F.lit(0.0))
    weight = lambda w: sum((F.when(F.col(d).isNotNull(), F.lit(x)).otherwise(0.0) for d, x in zip(DIMENSIONS, w, strict=True)), F.lit(0.0))
    scored = F.array(*(F.struct(F.lit(s).alias("scheme"), F.round(total(w) / F.nullif(weight(w), F.lit(0.0)), 1).alias("composite")) for s, w in schemes.items()))
    return dims.select("payer_id", F.explode(scored).alias("s")).select("payer_id", "s.scheme", "s.composite")


def ranking(scores: DataFrame, scheme: str = "default") -> DataFrame:
    """Payers by composite, nulls last; the table has one row per payer."""
    return scores.filter(F.col("scheme") == scheme).select("payer_id", "composite", F.expr("cast(rank() over (order by composite desc nulls last) as int)").alias("place"))
