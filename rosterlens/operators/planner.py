"""Bucket planners: leaves of at most ``most`` rows over names, listed values and time.

A leaf is a bucket that is small enough, or as deep as allowed, whose ancestors all are too
large. Names count all levels in one aggregation; time takes a few levels at once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import pinned


def prefix_buckets(df: DataFrame, name: Column, most: int, depth: int = 6) -> DataFrame:
    """(prefix, n): leaves over lower-cased names of letters a-z and digits; names end where another character stands."""
    run = F.regexp_extract(F.lower(name), "^[a-z0-9]*", 0)
    one = df.select(F.substring(run, 1, depth).alias("s")).groupBy("s").agg(F.count("*").alias("c"))  # at most 36^depth rows
    levels = one.filter("s <> ''").select("c", F.explode(F.expr("transform(sequence(1, length(s)), k -> substring(s, 1, k))")).alias("prefix"))
    counts = levels.groupBy("prefix").agg(F.sum("c").alias("n"))
    large = counts.filter(F.col("n") > most).select(F.col("prefix").alias("parent"))
    fits = counts.filter((F.col("n") <= most) | (F.length("prefix") == depth))
    # a bucket's count is at most its parent's, so a leaf is one whose parent is too large
    under = fits.withColumn("parent", F.expr("substring(prefix, 1, length(prefix) - 1)"))
    return under.filter(F.length("prefix") == 1).select("prefix", "n").unionByName(under.filter(F.length("prefix") > 1).join(large, "parent", "left_semi").select("prefix", "n"))


def prefix_residual(df: DataFrame, leaves: DataFrame) -> DataFrame:
    """(total, covered, residual): rows that no leaf covers."""
    total = df.agg(F.count("*").alias("total"))
    covered = leaves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("covered"))
    return total.join(covered, F.lit(True)).withColumn("residual", F.col("total") - F.col("covered"))


def seconds_deep(start: datetime, end: datetime) -> int:
    """How often [start, end) is halved until a window is no longer than a second."""
    return max(0, (int(end.timestamp()) - int(start.timestamp()) - 1).bit_length())


def time_buckets(df: DataFrame, ts: Column, start: datetime, end: datetime, most: int, depth: int | None = None, step: int = 8) -> DataFrame:
    """(level, bucket, n): dyadic windows of [start, end), halved while they hold more than ``most`` rows and are longer than a second (or ``depth`` levels deep).

    Times outside and nulls are uncovered; start and end are cut to whole seconds first.
    Rows are counted by second once. Levels deepen ``step`` at a time, and only seconds of
    windows that are still too full go on, so deep levels cost what is crowded there.
    """
    first, width = int(start.timestamp()), int(end.timestamp()) - int(start.timestamp())
    last = seconds_deep(start, end) if depth is None else min(depth, seconds_deep(start, end))
    second = F.unix_timestamp(ts) - first
    going = pinned(df.select(second.alias("s")).filter((F.col("s") >= 0) & (F.col("s") < width)).groupBy("s").agg(F.count("*").alias("c")))
    place = f"cast(floor(s * shiftleft(1L, {{}}) / {width}) as bigint)"
    leaves, above = None, 0
    while True:
        to = min(above + step, last)
        levels = going.select("c", F.posexplode(F.expr(f"transform(sequence({above}, {to}), k -> {place.format('k')})")).alias("level", "bucket"))
        counts = levels.groupBy((F.col("level") + above).alias("level"), "bucket").agg(F.sum("c").alias("n"))
        full = counts.filter(F.col("n") > most)
        fits = counts.filter((F.col("n") <= most) | (F.col("level") == last)).withColumn("half", F.expr("shiftright(bucket, 1)"))
        under = fits.join(full.select((F.col("level") + 1).alias("level"), F.col("bucket").alias("half")), ["level", "half"], "left_semi").select("level", "bucket", "n")
        found = fits.filter("level = 0").select("level", "bucket", "n").unionByName(under) if above == 0 else under  # a later step's first level is the last one's last
        leaves = found if leaves is None else leaves.unionByName(found)
        if to == last:
            return leaves
        crowded = full.filter(F.col("level") == to).select(F.col("bucket").alias("at"))
        going = pinned(going.withColumn("at", F.expr(place.format(to))).join(crowded, "at", "left_semi").drop("at"))
        if going.isEmpty():
            return leaves
        above = to


def value_buckets(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """(value, n) of the listed values that hold rows, whatever their size."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return values.join(counts, "value")


def default_strategy(has_address: Column, has_name: Column) -> Column:
    return F.when(has_address, "state").when(has_name, "initial")
