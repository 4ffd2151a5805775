"""Landing zone: listing cards to stored documents and metadata."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keys
from tidemark.functions.dates import day_param
from tidemark.functions.text import is_blank
from tidemark.functions.urls import doc_type, fetched, result_total
from tidemark.operators import documents, listing, reconcile, upsert
from tidemark.operators.reconcile import event
from tidemark.schemas import LANDING_METADATA, POINTER_FIELDS
from tidemark.sources import cells, tables

# Crawl order: bodies as listed, then windows, pages and cards.
ORDER = ("body_order", "partition_date", "page", "position")


Stage = Callable[[DataFrame, str], DataFrame]
Lookup = Callable[[DataFrame], DataFrame]


def named(cards: DataFrame) -> DataFrame:
    """Cards with the `row` that names each: its place in the crawl."""
    return cards.withColumn("row", F.concat_ws("-", *ORDER))


def firsts(cards: DataFrame, lookup: Lookup, stage: Stage) -> DataFrame:
    """The first card of each key, with what the store holds under it.

    Everything here is narrow and happens before any document is touched. `lookup` gives the stored records that may
    have one of the keys; one join with them serves both the skip and the later change detection.
    """
    first = stage(upsert.dedup_first(cards, ORDER), "firsts")
    return stage(upsert.with_stored(first, lookup(first), carry=POINTER_FIELDS), "known")


def requests(known: DataFrame, mode: str) -> DataFrame:
    """The records to fetch. `mode` 'skip' leaves out those that are stored, 'refresh' fetches them again."""
    if mode not in ("skip", "refresh"):
        raise ValueError(f"mode must be skip or refresh, got {mode!r}")
    return known if mode == "refresh" else known.where(~F.col("was_stored") | is_blank("identifier"))


def owned(located: DataFrame) -> DataFrame:
    """The responses to read, each with the record that lends it its place, and the hashes under which its records
    have it already (where one of them has it nowhere, or under another path, `_low` is empty).
    """
    place = F.struct("partition_date", "body", "row", keys.landing_key().alias("file_path"))
    in_place = F.col("was_stored") & F.col("stored_file_path").eqNullSafe(keys.landing_key())
    held = F.coalesce(F.when(in_place, F.col("stored_file_hash")), F.lit(""))
    wanted = documents.responses(located, F.min(place).alias("_place"), F.min(held).alias("_low"), F.max(held).alias("_high"))
    return wanted.select(
        *documents.RESPONSE, "copies", "_low", "_high",
        F.col("_place.row").alias("file_row"), F.col("_place.file_path").alias("file_path"),
        keys.body_slug("_place.body").alias("body_slug"), F.col("_place.partition_date").alias("partition_date"),
    )


def stored_contents(wanted: DataFrame, fetches: DataFrame) -> DataFrame:
    """Rows of the files table: each response read, parsed and hashed once; bytes stay only where they are new."""
    held = documents.examine(documents.contents(wanted, fetches))
    kept = (F.col("_low") == F.col("_high")) & (F.col("_low") == F.col("file_hash"))
    kind = doc_type("doc_url")
    return (
        held.withColumn("written", F.col("file_hash").isNotNull() & ~kept)
        .withColumns(
            {
                "content": F.when(F.col("written"), F.col("content")),
                "doc_type": kind,
                "content_type": keys.content_type(keys.extension(kind)),
            }
        )
        .drop("copies", "_low", "_high")
    )


def as_records(told: DataFrame, run_id: str, run_ts: Column) -> DataFrame:
    """Keys, change against the stored row, and the pointer to the bytes, of records whose response was examined."""
    has_content = F.col("file_hash").isNotNull()
    record = told.withColumns(
        {
            "body_slug": keys.body_slug("body"),
            "file_path": F.when(has_content, keys.landing_key()),
            "content_type": F.when(has_content, keys.content_type(keys.extension("doc_type"))),
            "scraped_at": F.when(has_content, run_ts),
            "has_content": has_content,
        }
    )
    compared = record.withColumns({"change": upsert.change(), "write_file": upsert.write_file()})
    write = F.col("write_file")
    return compared.withColumns(
        {
            "file_run": F.when(write, F.lit(run_id)).otherwise(F.col("stored_file_run")),
            "file_row": F.when(write, F.col("_owner")).otherwise(F.col("stored_file_row")),
            "file_day": F.when(write, F.col("_owner_day")).otherwise(F.col("stored_file_day")),
        }
    ).drop("_owner", "_owner_day")


def hop(rows: DataFrame, fetches: DataFrame, run_id: str, run_ts: Column, stage: Stage) -> DataFrame:
    """Look up, read and store the documents of the rows; returns the rows with what became of them.

    Stage `run_id` stores the contents, one row of bytes per response however many rows share it. The newest response
    of each URL is stored first, as it is read more than once.
    """
    urls = rows.where(F.col("doc_url").isNotNull()).select("doc_url")
    latest = stage(documents.latest_fetches(fetches, urls), f"{run_id}_latest")
    located = stage(documents.locate(rows, fetches, latest), f"{run_id}_located")
    wanted = stage(owned(located), f"{run_id}_responses")
    held = stage(stored_contents(wanted, fetches), run_id)
    held = held.withColumns({"_owner": F.col("file_row"), "_owner_day": F.col("partition_date")})
    return as_records(documents.outcomes(located, held, "_owner", "_owner_day"), run_id, run_ts)


def build(wanted: DataFrame, fetches: DataFrame, run_id: str, run_ts: Column, stage: Stage) -> DataFrame:
    """The outcome of each request: 'scraped' or 'failed', attachments followed.

    `stage(rows, name)` stores an intermediate result and returns it as read back, with or without `content`.
    """
    direct = stage(hop(wanted, fetches, run_id, run_ts, stage), f"{run_id}_direct")
    shells = direct.where(F.col("status") == "rerouted").select(*wanted.columns, "status", "attachment")
    attached_run = f"{run_id}.attached"
    attached = hop(documents.attachments(shells), fetches, attached_run, run_ts, stage)
    return direct.where(F.col("status") != "rerouted").unionByName(attached)


def account(grid: DataFrame, pages: DataFrame, told: DataFrame) -> DataFrame:
    """Reconciliation per cell, from the listing pages and the ledger of cards."""
    found = pages.where((F.col("page") == 1) & (F.col("status") == "scraped")).select(
        *reconcile.CELL, F.col("total").alias("found")
    )
    counts = reconcile.count_outcomes(told.withColumn("status", reconcile.as_status(F.col("reason"))))
    return reconcile.by_partition(grid, found, counts)


def read_listing(
    planned: DataFrame, fetches: DataFrame, base_url: str, stage: Stage, name: str
) -> DataFrame:
    """Fetch and read planned listing pages; one row per page, also for failed ones.

    Only responses to searches take part: the prefix is pushed down to their scan.
    """
    searches = fetches.where(F.col("url").startswith(f"{base_url}?"))
    located = stage(documents.locate(planned.withColumnRenamed("search_url", "doc_url"), searches), f"{name}_located")
    held = documents.contents(documents.responses(located), searches)
    totals = held.withColumn("total", result_total(F.col("content").cast("string")))
    read = listing.read_cards(totals, url="doc_url").select(*documents.RESPONSE, "total", "cards", "listing_error")
    pages = located.join(read.withColumn("_held", F.lit(True)), list(documents.RESPONSE), "left")
    status = F.when(F.col("_held"), "scraped").otherwise("failed")
    pages = pages.withColumn("status", status).withColumnRenamed("doc_url", "search_url")
    return stage(pages.drop("_held", "version", "copies"), name)


def crawl(
    dimension: DataFrame, fetches: DataFrame, base_url: str, start: date, end: date, months: int, stage: Stage
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grid, pages, cards) of a date range: the first page of each cell, and from its total the rest of them."""
    grid = listing.plan_grid(dimension, start, end, months)
    first = listing.with_search_url(grid.withColumn("page", F.lit(1).cast("bigint")), base_url)
    first_pages = read_listing(first, fetches, base_url, stage, "listing_first")
    sized = first_pages.where(F.col("status") == "scraped").select(
        *grid.columns, "total", F.size("cards").alias("cards")
    )
    later = listing.plan_pages(sized).where(F.col("page") > 1).select(*grid.columns, "page")
    later = listing.with_search_url(later, base_url)
    pages = first_pages.unionByName(read_listing(later, fetches, base_url, stage, "listing_rest"))
    cards = listing.parse_cards(pages).drop(
        "search_url", "status", "http_status", "total", "window_start", "window_end", "from_param", "to_param"
    )
    return grid, pages, named(cards)


def run(
    spark: SparkSession,
    fetches: DataFrame,
    zone: str,
    base_url: str,
    start: date,
    end: date,
    run_id: str,
    run_ts: datetime | None = None,
    wanted: str | None = None,
    months: int = 1,
    mode: str = "skip",
) -> DataFrame:
    """One scrape of [start, end) into a landing zone; returns its reconciliation.

    Each stage is written under the zone and read back, so a lost executor costs the stage at hand, and a failed run
    can be repeated under the same `run_id`; its events then replace those of the failed attempt.
    """
    stamp = F.lit(run_ts) if run_ts else F.current_timestamp()
    work = f"{zone}/runs/{run_id}"
    contents = (run_id, f"{run_id}.attached")
    tables.refuse_used_run(cells.read(spark, zone, LANDING_METADATA), contents)
    attempt = tables.next_attempt(spark, zone, run_id)

    def keep(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    def stage(rows: DataFrame, name: str) -> DataFrame:
        if name not in contents:
            return keep(rows, name)
        path = f"{zone}/files/run_id={name}"
        tables.write_files(rows, path, rebalance=True)
        return spark.read.schema(rows.schema).parquet(path).drop("content")

    def lookup(asked: DataFrame) -> DataFrame:
        return cells.read_for_keys(spark, zone, LANDING_METADATA, asked)

    dimension = listing.select_bodies(listing.bodies(spark), wanted)
    told = run_started(listing.plan_grid(dimension, start, end, months), months, stamp)
    try:
        grid, pages, cards = crawl(dimension, fetches, base_url, start, end, months, keep)
        cards = keep(cards, "cards")
        known = firsts(cards, lookup, keep)
        asked = keep(requests(known, mode), "requests")
        records = keep(build(asked, fetches, run_id, stamp, stage), "records")
        outcomes = keep(reconcile.ledger(cards, known, records, skips=mode == "skip"), "ledger")
        cells.upsert(spark, zone, LANDING_METADATA, records.where(F.col("status") == "scraped"), ORDER)
        summary = keep(account(grid, pages, outcomes), "summary")
        more = (
            partition_found(pages, stamp),
            failures(pages, records, stamp),
            reconcile.events(summary, stamp),
        )
    except Exception as failure:
        cause = F.lit(f"{type(failure).__name__}: {failure}"[:500]).alias("cause")
        lost = spark.range(1).select(*event("run_failed", "error", stamp), cause)
        tables.write_events(told.unionByName(lost, allowMissingColumns=True), zone, run_id, attempt)
        raise
    for rows in more:
        told = told.unionByName(rows, allowMissingColumns=True)
    tables.write_events(told, zone, run_id, attempt)
    return summary


def _day() -> Column:
    return F.col("partition_date").cast("string").alias("partition")


def run_started(grid: DataFrame, months: int, run_ts: Column) -> DataFrame:
    """The span actually read, so that a lost day shows."""
    return grid.agg(
        day_param(F.min("window_start")).alias("start"),
        day_param(F.max("window_end")).alias("end"),
        F.count_distinct("window_start").alias("windows"),
        F.sort_array(F.collect_set("body")).alias("bodies"),
    ).select(
        *event("run_started", "info", run_ts), "start", "end", "windows",
        F.lit(months).cast("bigint").alias("partition_months"), "bodies",
    )


def partition_found(pages: DataFrame, run_ts: Column) -> DataFrame:
    listed = pages.where((F.col("page") == 1) & (F.col("status") == "scraped"))
    return listed.select(
        *event("partition_found", "info", run_ts), _day(), "body", F.col("total").alias("found")
    )


def cause(error: Column) -> Column:
    """Why a response could not be had: none stored, its HTTP status, or what reading it ran into."""
    status = F.col("http_status")
    return (
        F.when(status.isNull(), "no response")
        .when(~fetched(status), F.concat(F.lit("http "), status.cast("string")))
        .otherwise(error)
    )


def failures(pages: DataFrame, records: DataFrame, run_ts: Column) -> DataFrame:
    """Warning events for listing pages and documents that could not be had, with HTTP status and cause."""
    lost_pages = pages.where((F.col("status") == "failed") | F.col("listing_error").isNotNull())
    lost_records = records.where(F.col("status") == "failed")
    status = F.col("http_status").alias("status")
    return lost_pages.select(
        *event("listing_failed", "warning", run_ts), _day(), "body", F.col("search_url").alias("url"),
        status, cause(F.col("listing_error")).alias("cause"),
    ).unionByName(
        lost_records.select(
            *event("download_failed", "warning", run_ts), _day(), "body", "identifier", F.col("doc_url").alias("url"),
            status, cause(F.col("parse_error")).alias("cause"),
        ),
        allowMissingColumns=True,
    )
