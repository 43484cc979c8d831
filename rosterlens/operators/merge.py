"""Idempotent merges of batches into tables, as DataFrames and as versioned tables of parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.shared import pinned, unpinned
from . import versions

KEY = ("payer_id", "id")


def one_per_key(batch: DataFrame, key=KEY) -> DataFrame:
    """One row per key: the one with the largest other columns, so that a repeated merge keeps the same row."""
    rest = [c for c in batch.columns if c not in key]
    if not rest:
        return batch.distinct()
    return batch.groupBy(*key).agg(F.max(F.struct(*rest)).alias("r")).select(*key, "r.*").select(batch.columns)


def insert_only(target: DataFrame, batch: DataFrame, key=KEY) -> DataFrame:
    """The target and the batch's rows under new keys."""
    new = same_key(one_per_key(batch, key), dotted(target.select(*key), key), key, "left_anti")
    return target.unionByName(new.select(target.columns))


def update(target: DataFrame, batch: DataFrame, key=KEY) -> DataFrame:
    """The target with the batch's rows in place of rows of the same key."""
    new = one_per_key(batch, key)
    return same_key(target, dotted(new.select(*key), key), key, "left_anti").unionByName(new.select(target.columns))


def replace_partition(df: DataFrame, path: str, by: str = "payer_id") -> None:
    """Write ``df`` over the partitions it holds and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


BUCKET = "key_bucket"
#: A place whose rows lie in this many commits is written anew when a batch touches it next.
CROWDED = 8


def same_key(left: DataFrame, right: DataFrame, key, how: str) -> DataFrame:
    """Join on keys of which nulls are equal; ``right`` has the key's columns under names with a dot in front, which go."""
    out = left.join(right, [F.col(k).eqNullSafe(F.col(f"`.{k}`")) for k in key], how)
    return out.drop(*(f".{k}" for k in key))


def dotted(df: DataFrame, key) -> DataFrame:
    return df.withColumnsRenamed({k: f".{k}" for k in key})


def _bucket(rest, buckets: int) -> str:
    return f"pmod(xxhash64({', '.join(rest)}), {buckets})"


def by_place(df: DataFrame, tasks: int, rest=KEY[1:], buckets: int = 16) -> DataFrame:
    """``df`` dealt into ``tasks`` even ones of rows that ``merge_into`` puts into the same or the next bucket, so that few files are written; ``rest`` are the key's columns after the first."""
    within = f"pmod(shiftright(xxhash64({', '.join(rest)}), 16), 65536)"
    return df.repartitionById(tasks, F.expr(f"cast(({_bucket(rest, buckets)} * 65536 + {within}) * {tasks} div ({buckets} * 65536) as int)"))


def merge_into(batch: DataFrame, path: str, mode: str = "update", key=KEY, buckets: int = 16, same: str | None = None, seen: str | None = None, once: bool = False) -> None:
    """Merge a batch into a versioned table, placed by the key's first column and a hash of the rest.

    One commit: readers see the table before or after. Only places that the batch touches
    are read. Rows under new keys are added; in update mode places that hold a row which the
    batch changes are written anew. A row changes where ``same`` (a hash of its content)
    differs, or any column without it. Null keys are equal to null keys. Columns that the
    batch lacks keep their values (null in new rows), columns that the table lacks are added.

    ``seen`` is a column that says when a row was delivered. It lies beside the rows, a narrow
    part of its own, so a batch that brings nothing else new writes no rows: in update mode
    the whole batch has been seen, in insert mode its new rows. ``read`` joins the latest.

    ``once`` says that no key comes twice in the batch. It is then written as a commit at once,
    without a copy before, and published as it lies where the table knows none of its keys.
    """
    spark, by = batch.sparkSession, [key[0], BUCKET]
    batch = (batch if once else one_per_key(batch, key)).withColumn(BUCKET, F.expr(f"cast({_bucket(key[1:], buckets)} as int)"))
    if once:
        commit, places = versions.write(batch, path, "rows", by)
        batch = versions.read_commit(spark, path, "rows", commit, batch.schema)
    else:
        batch = pinned(batch)
    rows = batch.drop(seen) if seen else batch
    known = versions.current(spark, path) or versions.Version()
    files = {part: dict(held) for part, held in known.files.items()}
    schemas = dict(known.schemas)
    copies, rewritten = [], set()
    if "rows" not in schemas:
        schemas["rows"] = rows.schema
        new = out = rows
        whole = True
    else:
        extra = [f for f in schemas["rows"] if f.name not in rows.columns]
        schemas["rows"] = StructType([*rows.schema.fields, *extra])
        touched = set(places) if once else {versions.place_of(spark, by, r) for r in rows.select(*by).distinct().collect()}  # at most payers x buckets
        now = versions.Version(known.number, schemas, known.files)
        held = versions.read_part(spark, path, now, "rows", touched)
        crowded = {p for p in touched if len(files["rows"].get(p, ())) >= CROWDED}
        whole = once and not crowded and same_key(rows.select(*key), dotted(held.select(*key), key), key, "left_semi").isEmpty()
        if not whole:
            new = pinned(same_key(rows, dotted(held.select(*key), key), key, "left_anti"))
            rest = [same] if same in rows.columns and same in held.columns else [c for c in rows.columns if c not in (*key, BUCKET)]
            before = dotted(held.select(*key, F.struct(*rest, F.lit(1)).alias(".before"), *(F.col(f.name) for f in extra)), key)
            other = ~F.struct(*rest, F.lit(1)).eqNullSafe(F.col("`.before`")) if mode == "update" else F.lit(False)
            changed = pinned(same_key(rows, before, key, "inner").filter(other).drop(".before"))
            copies = [new, changed]
            rewritten = {versions.place_of(spark, by, r) for r in changed.select(*by).distinct().collect()} | crowded
            stay = same_key(versions.read_part(spark, path, now, "rows", rewritten), dotted(changed.select(*key), key), key, "left_anti")
            out = stay.unionByName(changed).unionByName(new, allowMissingColumns=True)
    news = whole or bool(rewritten) or not new.isEmpty()
    if news:
        _commit(files, "rows", rewritten, *((commit, places) if once and whole else versions.write(out, path, "rows", by)))
    if seen:
        delivered = (batch if mode == "update" or whole else same_key(batch, dotted(new.select(*key), key), key, "left_semi")).select(*key, BUCKET, seen)
        crowded = {p for p, commits in files.get("seen", {}).items() if len(commits) >= CROWDED}
        if crowded:
            old = versions.read_part(spark, path, known, "seen", crowded)
            delivered = old.unionByName(delivered).groupBy(*key, BUCKET).agg(F.max(seen).alias(seen))
        if not delivered.isEmpty():
            schemas["seen"] = delivered.schema
            _commit(files, "seen", crowded, *versions.write(delivered, path, "seen", by))
            news = True
    if news:
        versions.publish(spark, path, versions.Version(known.number + 1, schemas, files))
    if once and not whole:
        versions.discard(spark, path, "rows", commit)
    unpinned(batch, *copies)


def _commit(files: dict, part: str, replaced: set[str], commit: str, places: list[str]) -> None:
    """Enter a commit's places in a version's files."""
    held = files.setdefault(part, {})
    for place in places:
        held[place] = [commit] if place in replaced else [*held.get(place, []), commit]


def read(spark: SparkSession, path: str, number: int | None = None, key=KEY) -> DataFrame:
    """The table's newest version, or the one of that number; with when each row was last seen, if that is kept."""
    version = versions.current(spark, path, number)
    if version is None:
        raise ValueError(f"no version of a table under {path}")
    rows = versions.read_part(spark, path, version, "rows")
    if "seen" in version.schemas:
        at = version.schemas["seen"].names[-1]
        last = versions.read_part(spark, path, version, "seen").groupBy(*key).agg(F.max(at).alias(at))
        rows = same_key(rows, dotted(last, key), key, "left")
    return rows.drop(BUCKET)


def upsert_scores(target: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores by (payer_id, scored_at, weight_scheme); ``detail`` is kept for the default scheme only."""
    detail = F.when(F.col("weight_scheme") == "default", F.col("detail"))
    return update(target, scores.withColumn("detail", detail), ("payer_id", "scored_at", "weight_scheme"))


def write_reports(df: DataFrame, path: str) -> None:
    """A report as CSV with a header and as JSON lines."""
    df.write.mode("overwrite").csv(f"{path}/csv", header=True)
    df.write.mode("overwrite").json(f"{path}/json")
