"""Reference checks, orphans, frontiers and closures, as equi-joins on (payer_id, id).

All joins are left to adaptive execution: no side has a proven size bound, and payers
differ in size by orders of magnitude, which skew joins take apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pct, ref_id
from ..plans.rules import CHECKS, Check
from ..sources.shared import pinned


def _labelled(refs: Column, check: Check) -> Column:
    return F.transform(refs, lambda r: F.struct(F.lit(check.label).alias("label"), F.lit(check.target).alias("target"), r.alias("ref")))


def edges(tables: dict[str, DataFrame], checks: tuple[Check, ...] = CHECKS, links: dict[str, DataFrame] | None = None) -> DataFrame:
    """(payer_id, label, target, source_id, ref, ref_id) of every reference; each source table is scanned once.

    A check whose label is in ``links`` takes its references from that table of
    (payer_id, id, ref), one row each, instead of its source's column.
    """
    out, links = None, links or {}
    for c in checks:
        if c.label in links:
            long = links[c.label].filter(F.col("ref").isNotNull()).select("payer_id", F.col("id").alias("source_id"), F.lit(c.label).alias("label"), F.lit(c.target).alias("target"), "ref")
            out = long if out is None else out.unionByName(long)
    for source in dict.fromkeys(c.source for c in checks):
        if source not in tables:
            continue
        df = tables[source]
        own = [c for c in checks if c.source == source and c.column in df.columns and c.label not in links]
        parts = []
        for c in own:
            values = F.col(c.column) if c.many else F.array(c.column)
            kept = values if c.many else F.filter(values, lambda x: x.isNotNull())
            parts.append(_labelled(F.coalesce(kept, F.array().cast("array<string>")), c))
        if parts:
            long = df.select("payer_id", F.col("id").alias("source_id"), F.explode(F.concat(*parts)).alias("e")).select("payer_id", "source_id", "e.*")
            out = long if out is None else out.unionByName(long)
    if out is None:
        raise ValueError("no table holds a checked reference")
    return out.withColumn("ref_id", ref_id(F.col("ref")))


def targets(tables: dict[str, DataFrame], names) -> DataFrame:
    """(payer_id, target, ref_id) of every id once."""
    out = None
    for name in names:
        if name in tables:
            ids = tables[name].select("payer_id", F.lit(name).alias("target"), F.col("id").alias("ref_id"))
            out = ids if out is None else out.unionByName(ids)
    return out.dropDuplicates(["payer_id", "target", "ref_id"])


def _mentioned(refs: Column, at: int, target: str) -> Column:
    return F.transform(refs, lambda r: F.struct(F.lit(at).alias("at"), F.lit(target).alias("target"), ref_id(r).alias("ref_id")))


def mentions(tables: dict[str, DataFrame], checks: tuple[Check, ...] = CHECKS, links: dict[str, DataFrame] | None = None) -> DataFrame:
    """(payer_id, at, target, ref_id): every reference with its check's place in ``checks``, and every id of a checked table with -1.

    Each table is read once, for its references and its ids together. A check whose label is
    in ``links`` takes its references from that table of (payer_id, id, ref), one row each.
    """
    links, wanted, out, some = links or {}, {c.target for c in checks}, None, False
    for name, df in tables.items():
        parts = []
        for at, c in enumerate(checks):
            if c.source == name and c.column in df.columns and c.label not in links:
                values = F.col(c.column) if c.many else F.filter(F.array(c.column), lambda x: x.isNotNull())
                parts.append(_mentioned(F.coalesce(values, F.array().cast("array<string>")), at, c.target))
        some |= bool(parts)
        if name in wanted:
            parts.append(F.array(F.struct(F.lit(-1).alias("at"), F.lit(name).alias("target"), F.col("id").alias("ref_id"))))
        if parts:
            rows = df.select("payer_id", F.inline(F.concat(*parts)))
            out = rows if out is None else out.unionByName(rows)
    for at, c in enumerate(checks):
        if c.label in links:
            rows = links[c.label].filter(F.col("ref").isNotNull()).select("payer_id", F.lit(at).alias("at"), F.lit(c.target).alias("target"), ref_id(F.col("ref")).alias("ref_id"))
            out, some = rows if out is None else out.unionByName(rows), True
    if not some:
        raise ValueError("no table holds a checked reference")
    return out


def check_all(tables: dict[str, DataFrame], checks: tuple[Check, ...] = CHECKS, links: dict[str, DataFrame] | None = None) -> DataFrame:
    """(payer_id, label, total, resolved, dangling, pct) of every check, and a row with a null label per payer.

    Only the target table counts, not the type that a reference names. References and ids
    meet in one aggregation by (payer_id, target, id), with a count for each check, instead of
    a join: equal references are counted before they move, so an organization that a third of
    all roles name is one row of each task.
    """
    by = mentions(tables, checks, links).groupBy("payer_id", "target", "ref_id")
    met = by.agg(F.bool_or(F.col("at") == -1).alias("held"), *(F.count_if(F.col("at") == at).alias(f"n{at}") for at in range(len(checks))))
    hit = F.col("held") & F.col("payer_id").isNotNull() & F.col("ref_id").isNotNull()
    sums = [F.sum(f"n{at}").alias(f"t{at}") for at in range(len(checks))] + [F.sum(F.when(hit, F.col(f"n{at}")).otherwise(0)).alias(f"r{at}") for at in range(len(checks))]
    wide = met.groupBy("payer_id").agg(*sums)
    def row(label, places) -> Column:
        total, resolved = (sum((F.col(f"{x}{at}") for at in places[1:]), F.col(f"{x}{places[0]}")) for x in "tr")
        return F.struct(F.lit(label).cast("string").alias("label"), total.alias("total"), resolved.alias("resolved"))

    rows = F.array(*(row(c.label, [at]) for at, c in enumerate(checks)), row(None, list(range(len(checks)))))
    both = wide.select("payer_id", F.inline(rows)).filter("total > 0")
    return both.select("payer_id", "label", "total", "resolved", (F.col("total") - F.col("resolved")).alias("dangling"), pct(F.col("resolved"), F.col("total")).alias("pct"))


def orphans(rows: DataFrame, referring: DataFrame, column: str, many: bool = False) -> DataFrame:
    """Rows that no reference in ``column`` of ``referring`` reaches within the payer."""
    refs = referring.select("payer_id", (F.explode(column) if many else F.col(column)).alias("ref"))
    reached = refs.filter(F.col("ref").isNotNull()).select("payer_id", ref_id(F.col("ref")).alias("id")).distinct()
    return rows.join(reached, ["payer_id", "id"], "left_anti")


def frontier(held: DataFrame, references: list[DataFrame]) -> DataFrame:
    """(payer_id, id): referenced, non-empty and not held, each once. ``references`` hold (payer_id, ref)."""
    out = references[0]
    for r in references[1:]:
        out = out.unionByName(r)
    ids = out.select("payer_id", ref_id(F.col("ref")).alias("id")).filter(F.col("id") != "").distinct()
    return ids.join(held.select("payer_id", "id"), ["payer_id", "id"], "left_anti")


def include_closure(base: DataFrame, values: DataFrame, column: str, tables: dict[str, DataFrame], checks: tuple[Check, ...]) -> DataFrame:
    """(payer_id, resource_type, id): base rows whose ``column`` is listed, and every held row they reference."""
    source = checks[0].source
    kept = base.join(values.select(F.col("value").alias(column)).filter(F.col(column) != ""), column, "left_semi")
    reached = edges({source: kept}, checks).select("payer_id", "target", "ref_id").distinct()
    held = targets(tables, sorted({c.target for c in checks}))
    found = held.join(reached, ["payer_id", "target", "ref_id"], "left_semi").select("payer_id", F.col("target").alias("resource_type"), F.col("ref_id").alias("id"))
    return found.unionByName(kept.select("payer_id", F.lit(source).alias("resource_type"), "id").distinct())


def value_probe(df: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """(value, n) of every listed value, also of those that no row has."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return values.join(counts, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def chain_batches(ids: DataFrame, size: int) -> DataFrame:
    """(payer_id, batch, n, first_id, last_id): each payer's ids in order, ``size`` to a batch.

    Numbers come from counts by range of ids, so no payer is sorted in one task.
    """
    ordered = ids.select("payer_id", "id").repartitionByRange("payer_id", "id")
    part = pinned(ordered.withColumn("part", F.spark_partition_id()))
    counts = part.groupBy("payer_id", "part").agg(F.count("*").alias("n"))
    before = counts.select("payer_id", "part", F.expr("coalesce(sum(n) over (partition by payer_id order by part rows between unbounded preceding and 1 preceding), 0)").alias("before"))
    numbered = part.withColumn("i", F.expr("row_number() over (partition by payer_id, part order by id)")).join(before, ["payer_id", "part"])
    return numbered.groupBy("payer_id", F.floor((F.col("i") + F.col("before") - 1) / size).alias("batch")).agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


def reverse_chain(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose reference in ``column`` points to one of ``ids`` (payer_id, id)."""
    return df.withColumn("_id", ref_id(F.col(column))).join(ids.select("payer_id", F.col("id").alias("_id")), ["payer_id", "_id"], "left_semi").drop("_id")


def id_lookup(ids: DataFrame, df: DataFrame) -> DataFrame:
    """(payer_id, asked, hits, not_found) of ids looked up by (payer_id, id)."""
    held = df.select("payer_id", "id").distinct().withColumn("hit", F.lit(1))
    joined = ids.distinct().join(held, ["payer_id", "id"], "left")
    return joined.groupBy("payer_id").agg(F.count("*").alias("asked"), F.count("hit").alias("hits"), (F.count("*") - F.count("hit")).alias("not_found"))
