"""Accounting per (partition, body): found, scraped, failed, skipped, missing; and each card's outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank

CELL = ("partition_date", "body")
COUNTERS = ("found", "scraped", "failed", "skipped")


def missing() -> Column:
    """Found but not accounted for, never negative."""
    return F.greatest(
        F.lit(0).cast("bigint"),
        F.col("found") - F.col("scraped") - F.col("failed") - F.col("skipped"),
    )


def ledger(cards: DataFrame, firsts: DataFrame, outcomes: DataFrame, skips: bool = True, key: str = "identifier") -> DataFrame:
    """One row per card, with the `reason` of what became of it.

    `cards` have a `row` that names them; `firsts` are the first cards of each key with `was_stored`, `outcomes` the
    fetched rows with their `status`. The reasons: 'repeated' (another card with its key came first), 'stored' (an
    earlier run has it, where stored records are skipped), 'scraped' or 'failed', and 'lost' for a card that any step
    has dropped without saying so. Give stored tables where one key may hold much of the cards: Spark then splits it.
    """
    keyed = ~is_blank(key)
    known = firsts.where(keyed).select(key, F.col("row").alias("_first"), "was_stored")
    met = cards.where(keyed).join(known, key, "left").unionByName(cards.where(is_blank(key)), allowMissingColumns=True)
    told = met.join(outcomes.select("row", F.col("status").alias("_outcome")), "row", "left")
    stored = F.coalesce(F.col("was_stored"), F.lit(False)) if skips else F.lit(False)
    reason = (
        F.when(keyed & F.col("_first").isNull(), "lost")
        .when(keyed & (F.col("_first") != F.col("row")), "repeated")
        .when(F.col("_outcome").isNotNull(), F.col("_outcome"))
        .when(keyed & stored, "stored")
        .otherwise("lost")
    )
    return told.select(*cards.columns, reason.alias("reason"))


def as_status(reason: Column) -> Column:
    """What a reason counts as; a lost card counts as nothing, so that it shows as missing."""
    return F.when(reason.isin("repeated", "stored"), "skipped").otherwise(reason)


def count_outcomes(outcomes: DataFrame, cell: Sequence[str] = CELL, status: str = "status") -> DataFrame:
    """Scraped / failed / skipped per cell from one row per record."""
    return outcomes.groupBy(*cell).agg(
        *(F.count_if(F.col(status) == name).alias(name) for name in COUNTERS[1:])
    )


def by_partition(
    grid: DataFrame, found: DataFrame, counts: DataFrame, cell: Sequence[str] = CELL
) -> DataFrame:
    """One row per cell that was planned or has anything; `found` is page 1's total (NULL counts as 0).

    `listing_missing` marks cells whose first listing page never arrived: they show zeroes in the counters instead of
    disappearing. `unplanned` marks cells outside the grid. One grouped aggregate over the three inputs.
    """
    keys = list(cell)
    counters = ", ".join(f"{c} bigint" for c in COUNTERS)
    empty = grid.sparkSession.createDataFrame([], f"_planned boolean, _listed boolean, {counters}")
    told = empty
    for rows in (
        grid.select(*keys, F.lit(True).alias("_planned")),
        found.select(*keys, F.lit(True).alias("_listed"), F.col("found").cast("bigint").alias("found")),
        counts.select(*keys, *COUNTERS[1:]),
    ):
        told = told.unionByName(rows, allowMissingColumns=True)
    return (
        told.groupBy(*keys)
        .agg(
            *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS),
            F.max("_listed").isNull().alias("listing_missing"),
            F.max("_planned").isNull().alias("unplanned"),
        )
        .withColumn("missing", missing())
    )


def rollup(partitions: DataFrame, by: Sequence[str] = ("body",)) -> DataFrame:
    """Totals per level and for the run (keys NULL, `level` 'run').

    Missing is taken from the totals of the level, so over-counts cancel under-counts:
    it is not the sum of the partitions' missing.
    """
    return (
        partitions.rollup(*by)
        .agg(*(F.sum(c).cast("bigint").alias(c) for c in COUNTERS), F.grouping_id().alias("_id"))
        .withColumn("missing", missing())
        .withColumn("level", F.when(F.col("_id") == 2 ** len(by) - 1, "run").otherwise("group"))
        .drop("_id")
    )


def unaccounted(partitions: DataFrame) -> DataFrame:
    return partitions.where(F.col("missing") > 0)


def last_attempts(events: DataFrame) -> DataFrame:
    """The events that count: of each run those of its last attempt. An attempt's events replace those before it."""
    newest = events.groupBy("run_id").agg(F.max("attempt").alias("attempt"))
    return events.join(newest, ["run_id", "attempt"], "left_semi")


def event(name: str, level: str, run_ts: Column) -> list[Column]:
    return [run_ts.alias("timestamp"), F.lit(level).alias("level"), F.lit(name).alias("event")]


def events(partitions: DataFrame, run_ts: Column, reason: str = "finished") -> DataFrame:
    """Run events: a summary per cell, a warning where records are missing, the run total."""
    fields = [*COUNTERS, "missing"]
    day = F.col("partition_date").cast("string").alias("partition")
    run = rollup(partitions, ("body",)).where(F.col("level") == "run")
    summary = partitions.select(*event("partition_summary", "info", run_ts), day, "body", *fields, "unplanned")
    warning = unaccounted(partitions).select(
        *event("records_unaccounted", "warning", run_ts), day, "body", "missing"
    )
    total = run.select(*event("run_summary", "info", run_ts), F.lit(reason).alias("reason"), *fields)
    return summary.unionByName(warning, allowMissingColumns=True).unionByName(
        total, allowMissingColumns=True
    )
