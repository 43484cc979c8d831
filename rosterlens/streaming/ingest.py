"""Incremental ingest of NDJSON files into typed tables.

A batch is a bounded set of files. One job parses each line once, tells its table and counts
as it writes; every table then reads its own rows of that. Tables are merged by key in one
commit each, side by side, so that a batch that runs again after a lost driver changes nothing.
What a batch writes beside its tables goes with it: its parsed lines and the files of its shuffles.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.flatten import routed, typed
from ..operators.merge import by_place, merge_into
from ..sources.bundles import TYPES, some_lines
from ..sources.shared import dropped, pinned_root, spread

#: Lines that one task parses, and parsed rows of a table that one task makes columns of; files pack so many in few bytes that tasks by bytes are few and uneven.
ROWS_A_TASK = 50_000


def staged(lines: DataFrame, payer_id: str, base_url: str) -> tuple[DataFrame, dict[str, int], str]:
    """Parsed lines by table, as written to the shared folder by one job; how many lines that job saw of each table and in all; the folder."""
    seen = Observation()
    some = spread(some_lines(lines), "resource", ROWS_A_TASK)  # gzipped files are few bytes, and a task that took many would sort more rows than fit in memory
    rows = routed(some.select(F.lit(payer_id).alias("payer_id"), F.lit(base_url).alias("source_base_url"), "resource", *(["file"] if "file" in lines.columns else [])))
    counts = [F.count_if(F.col("table_name") == t).alias(t) for t in (*TYPES.values(), "rejects")]
    path = pinned_root(lines.sparkSession)
    rows.observe(seen, F.count("*").alias("lines"), *counts).write.partitionBy("table_name").option("compression", "zstd").parquet(path)
    return lines.sparkSession.read.schema(rows.schema).parquet(path), seen.get, path


def write_batch(lines: DataFrame, payer_id: str, base_url: str, tables: tuple[str, ...], out: str, seen_at: datetime, mode: str = "update", batch: int = 0) -> None:
    """Merge one batch of lines into every table under ``out``, and its counts; rejects are merged by their text, so that a repeat adds none."""
    rows, counts, path = staged(lines, payer_id, base_url)

    def merge(table: str) -> None:
        own = rows.filter(F.col("table_name") == table)
        if table == "rejects":
            wrong = own.withColumn("id", F.sha2("resource", 256))
            merge_into(wrong.select("payer_id", "id", "source_base_url", "resource", "reason", *(["file"] if "file" in rows.columns else [])), f"{out}/rejects", "insert")
        else:
            tasks = -(-counts[table] // ROWS_A_TASK)
            once = own.groupBy("payer_id", "r.id").count().filter("count > 1").isEmpty()  # ids alone; rows of distinct keys needn't be sorted to keep one of each
            dealt = by_place(own, tasks, ("r.id",)) if once else own.repartition(tasks, "payer_id", "r.id")
            merge_into(typed(dealt, table, seen_at), f"{out}/{table}", mode, same="raw_hash", seen="last_seen_at", once=once)

    # a merge is a row of jobs, some of one task; the merges of other tables keep the cluster busy meanwhile
    with ThreadPoolExecutor(len(tables) + 1) as pool:
        for done in [pool.submit(inheritable_thread_target(lines.sparkSession)(merge), table) for table in (*tables, "rejects") if counts[table]]:
            done.result()
    total = lines.sparkSession.createDataFrame([(counts["lines"], counts["rejects"])], "lines long, rejects long")
    total.write.mode("overwrite").parquet(f"{out}/counts/batch={batch}")
    dropped(lines.sparkSession, path)


def ingest(spark: SparkSession, path: str, payer_id: str, base_url: str, tables: tuple[str, ...], out: str, checkpoint: str, seen_at: datetime, mode: str = "update", files: int = 16) -> StreamingQuery:
    """Start reading the NDJSON files under ``path`` that aren't read yet; ``checkpoint`` remembers which are."""
    lines = spark.readStream.option("maxFilesPerTrigger", files).text(path).select("value", F.col("_metadata.file_path").alias("file"))

    def write_one(df: DataFrame, n: int) -> None:
        df.sparkSession.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")  # the stream's own session: a job's shuffle files go as it ends, not when the driver collects garbage
        write_batch(df, payer_id, base_url, tables, out, seen_at, mode, n)

    write = lines.writeStream.foreachBatch(write_one)
    return write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_counts(spark: SparkSession, out: str) -> DataFrame:
    """(batch, lines, rejects) of every batch written under ``out``; a batch that ran again counts once."""
    return spark.read.parquet(f"{out}/counts")


def first_deliveries(stream: DataFrame, keys: list[str], at: str, within: str) -> DataFrame:
    """Each delivery of a stream once: repeats of ``keys`` go, in whatever batch they come.

    The state holds a key until the watermark, ``within`` behind the latest ``at``, has passed
    it by as much. A delivery later than the watermark of the batch before goes too, as
    nothing can tell any more whether it is a repeat; so ``within`` must cover how late a
    first delivery may be.
    """
    return stream.withWatermark(at, within).dropDuplicatesWithinWatermark(keys)


def deliver(stream: DataFrame, keys: list[str], at: str, within: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append first deliveries to the parquet files under ``out``, exactly once."""
    write = first_deliveries(stream, keys, at, within).writeStream.format("parquet").outputMode("append")
    return write.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
