"""Zone tables on plain Parquet: contents by run, raw directories, feeds, events, views.

Layout of a zone directory:

    files/run_id=<run>/body_slug=<slug>/partition_date=<day>/   bytes, one row per response, append-only by run
    metadata/                                                   see `sources.cells`
    runs/<run>/                                                 stages of a run, read back by its later stages
    events/run_id=<run>/attempt=<n>/                            JSON lines of each attempt at a run

Bytes are written once and never rewritten or shuffled by an upsert; each metadata row points at its bytes
(`file_run`, `file_row`, `file_day`), and records that share a document point at the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import EVENTS, FILES

CELL = ("body_slug", "partition_date")


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _hadoop_path(spark, path)
    return files.exists(found)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none where it is missing."""
    files, found = _hadoop_path(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(found)] if files.exists(found) else []


def drop(spark: SparkSession, path: str) -> bool:
    """Delete a file or directory."""
    files, found = _hadoop_path(spark, path)
    return files.delete(found, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been written yet: no rows, same schema."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_directory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Raw files under a directory tree as (file_path, content, size)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(F.col("path").alias("file_path"), "content", F.col("length").alias("size"))
    )


def refuse_used_run(metadata: DataFrame, run_ids: Sequence[str]) -> None:
    """Stop before a finished run's bytes, which metadata points at, are overwritten."""
    if metadata.where(F.col("file_run").isin(list(run_ids))).limit(1).count():
        raise ValueError(f"run {run_ids[0]!r} is part of the zone already, choose another run_id")


def write_files(rows: DataFrame, path: str, rebalance: bool) -> None:
    """Write one run's rows, replacing what a failed attempt of the same run left.

    `rebalance` adds a shuffle that sizes the files of a cell evenly and splits a cell
    holding much of the data; leave it out where the input is laid out by cell already.
    """
    laid_out = rows.hint("rebalance", *CELL) if rebalance else rows
    laid_out.write.partitionBy(*CELL).mode("overwrite").parquet(path)


def read_files(spark: SparkSession, zone: str) -> DataFrame:
    """Every stored row of bytes of a zone; (run_id, file_row) is unique.

    A run also writes a row for each response without new bytes: a shell, or bytes that are stored already.
    """
    return read_or_empty(spark, f"{zone}/files", FILES).where("written").drop("written")


def live_files(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row per record that has a file: its path, and the bytes its pointer leads to.

    Bytes that no record points at are left out. Only what is selected afterwards is read.
    """
    pointers = metadata.where(F.col("file_row").isNotNull()).select(
        F.col("file_run").alias("run_id"), "file_row", F.col("file_day").alias("partition_date"), "file_path", "identifier"
    )
    return files.drop("file_path").join(pointers, ["run_id", "file_row", "partition_date"])


def export_feed(records: DataFrame, path: str) -> None:
    """JSON lines of the scraped records; bytes never enter a feed."""
    fields = [c for c in records.columns if c != "content"]
    records.select(*fields).write.mode("overwrite").json(path)


def next_attempt(spark: SparkSession, zone: str, run_id: str) -> int:
    """The number of the next attempt at a run: one more than has left events."""
    return 1 + max((int(n[8:]) for n in names_in(spark, f"{zone}/events/run_id={run_id}") if n.startswith("attempt=")), default=0)


def write_events(events: DataFrame, zone: str, run_id: str, attempt: int) -> None:
    """Events of one attempt at a run as JSON lines; absent fields are left out of a line.

    Repeated, an attempt replaces what it wrote before.
    """
    events.write.mode("overwrite").json(f"{zone}/events/run_id={run_id}/attempt={attempt}")


def read_events(spark: SparkSession, zone: str) -> DataFrame:
    """All events of all attempts, each with its run_id and attempt; `reconcile.last_attempts` keeps those that count."""
    if not exists(spark, f"{zone}/events"):
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).json(f"{zone}/events")
