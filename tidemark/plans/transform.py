"""Clean zone: landing records to cleaned, re-keyed and re-hashed documents."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import html, keys
from tidemark.operators.reconcile import event
from tidemark.operators.windows import check_range
from tidemark.schemas import CLEAN_METADATA, LANDING_METADATA
from tidemark.sources import cells, tables

# Metadata column -> files column that say which bytes belong to a record.
POINTER = {"file_run": "run_id", "file_row": "file_row"}
# Pointers that are broadcast to the scan of the bytes at most; beyond, all bytes of their partitions are cleaned.
BROADCAST_POINTERS = 1_000_000


def select_range(metadata: DataFrame, start: date, end: date) -> DataFrame:
    """Records of the partitions in [start, end): a partition filter of the scan."""
    return metadata.where(
        (F.col("partition_date") >= F.lit(start)) & (F.col("partition_date") < F.lit(end))
    )


def pointed(files: DataFrame, records: DataFrame) -> DataFrame:
    """The rows of bytes that stored records point at, found where they lie: no shuffle moves bytes.

    Partitions without such a row are not read; their names come to the driver, which holds them in any case when it
    lists the files. Within the others, up to BROADCAST_POINTERS hashes of pointers are broadcast to the scan. Without
    that, or where two hashes agree, more is cleaned than is needed, and no record asks for it.
    """
    wanted = records.where(F.col("file_row").isNotNull())
    partitions = wanted.select("file_run", "file_day").distinct().groupBy("file_run").agg(F.collect_set("file_day").alias("days"))
    chosen = F.lit(False)
    for r in partitions.collect():
        chosen = chosen | ((F.col("run_id") == r["file_run"]) & F.col("partition_date").isin(list(r["days"])))
    found = files.where(chosen)
    pointers = wanted.select(F.xxhash64("file_run", "file_row").alias("_pointer")).distinct()
    if pointers.limit(BROADCAST_POINTERS + 1).count() > BROADCAST_POINTERS:
        return found
    # A column of its own: the bytes are scanned, hashed by their pointer, and met by a hash table of 64-bit numbers.
    return found.withColumn("_pointer", F.xxhash64("run_id", "file_row")).join(
        F.broadcast(pointers), "_pointer", "left_semi"
    ).drop("_pointer")


def clean_contents(files: DataFrame, tag: str = "div", css_class: str = "content") -> DataFrame:
    """Clean html and pass the rest through, once per row of bytes; failures fill `error`.

    One pass where the bytes lie: only html is handed to Python, other documents stay in the JVM. Replaces `content`,
    `file_hash` and `size`; a failed row has none of them and stops nothing.
    """
    is_html = F.coalesce(F.col("doc_type") == "html", F.lit(False))
    cleaned = F.col("_cleaned")
    body = F.when(is_html, cleaned["value"]).otherwise(F.col("content"))
    kept = [c for c in files.columns if c not in ("content", "file_hash", "size")]
    return (
        files.withColumn("_cleaned", html.clean_html(F.when(is_html, F.col("content")), tag, css_class))
        .select(*kept, cleaned["error"].alias("error"), body.alias("content"))
        .withColumns({"file_hash": keys.file_hash("content"), "size": F.length("content").cast("bigint")})
    )


def clean_records(
    metadata: DataFrame, cleaned: DataFrame, run_ts: Column, on: Mapping[str, str] = POINTER
) -> DataFrame:
    """Records with what became of their bytes: re-keyed, hash and size of the cleaned ones; failures fill `error`.

    Narrow: of `cleaned` (from clean_contents) only findings are joined, never content. A failed record keeps its
    metadata and has no file.
    """
    theirs = [F.col(name).alias(f"_on_{ours}") for ours, name in on.items()]
    findings = cleaned.select(
        *theirs, F.lit(True).alias("_found"), F.col("error").alias("_error"),
        F.col("file_hash").alias("_hash"), F.col("size").alias("_size"),
    )
    same = F.lit(True)
    for ours in on:
        same = same & (metadata[ours] == findings[f"_on_{ours}"])
    error = (
        F.when(F.col("_found").isNull(), "file not found")
        .when(keys.clean_key().isNull(), "no key: body or identifier is missing")
        .otherwise(F.col("_error"))
    )
    kept = [c for c in metadata.columns if c not in ("file_path", "file_hash")]
    ok = F.col("error").isNull()
    return (
        metadata.join(findings, same, "left")
        .withColumn("error", error)
        .select(
            *kept,
            "error",
            F.when(ok, keys.clean_key()).alias("file_path"),
            F.when(ok, F.col("_hash")).alias("file_hash"),
            F.when(ok, F.col("_size")).alias("size"),
            F.when(ok, keys.content_type("doc_type")).alias("content_type"),
            F.when(ok, run_ts).alias("transformed_at"),
        )
    )


def stats(records: DataFrame) -> DataFrame:
    """One row: read, transformed, failed."""
    return records.agg(
        F.count("*").alias("read"),
        F.count_if(F.col("error").isNull()).alias("transformed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def run(
    spark: SparkSession,
    landing: str,
    clean: str,
    start: date,
    end: date,
    run_id: str,
    run_ts: datetime | None = None,
    tag: str = "div",
    css_class: str = "content",
) -> dict[str, int]:
    """Transform the landing records of [start, end); returns read/transformed/failed.

    Files are written before metadata: a run that stops in between leaves unreferenced
    bytes, never a record without its file.
    """
    check_range(start, end, 1)
    stamp = F.lit(run_ts) if run_ts else F.current_timestamp()
    tables.refuse_used_run(cells.read(spark, clean, CLEAN_METADATA), (run_id,))
    attempt = tables.next_attempt(spark, clean, run_id)
    # Listed for the range alone, and partition filters of the scan besides.
    selected = select_range(cells.read(spark, landing, LANDING_METADATA, start, end), start, end)

    # The layout of the landing files is that of the clean ones: the bytes take no shuffle on their way.
    cleaned = clean_contents(pointed(tables.read_files(spark, landing), selected), tag, css_class)
    rows = cleaned.withColumns(
        {"written": F.col("content").isNotNull(), "source_run": F.col("run_id"), "source_row": F.col("file_row")}
    ).withColumn("file_row", F.concat_ws("/", "run_id", "file_row")).drop("run_id")
    path = f"{clean}/files/run_id={run_id}"
    tables.write_files(rows, path, rebalance=False)
    found = spark.read.schema(rows.schema).parquet(path).drop("content")

    # The records apart from the bytes: the merge is planned for their size alone.
    told = clean_records(selected, found, stamp, on={"file_run": "source_run", "file_row": "source_row"}).withColumns(
        {
            "file_row": F.when(F.col("error").isNull(), F.concat_ws("/", "file_run", "file_row")),
            "file_run": F.when(F.col("error").isNull(), F.lit(run_id)),
            "has_content": F.lit(True),
        }
    )
    work = f"{clean}/runs/{run_id}/records"
    told.write.mode("overwrite").parquet(work)
    records = spark.read.schema(told.schema).parquet(work)
    cells.upsert(spark, clean, CLEAN_METADATA, records.where(F.col("error").isNull()), ("partition_date", "file_row"))

    counts = stats(records)
    failed = records.where(F.col("error").isNotNull()).select(
        *event("transform_failed", "warning", stamp), "identifier", F.col("error").alias("cause")
    )
    summary = counts.select(
        *event("transform_summary", "info", stamp), F.lit(str(start)).alias("start"), F.lit(str(end)).alias("end"),
        "read", "transformed", "failed",
    )
    tables.write_events(failed.unionByName(summary, allowMissingColumns=True), clean, run_id, attempt)
    return counts.first().asDict()
