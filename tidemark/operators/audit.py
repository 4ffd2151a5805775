"""Audits of zones and windows: each returns the findings as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import clean_key


def identifiers(metadata: DataFrame, key: str = "identifier") -> DataFrame:
    """One row: records, NULL keys, keys held more than once."""
    per_key = metadata.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("records"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0))
        .cast("bigint")
        .alias("null_identifiers"),
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("repeated_identifiers"),
    )


def duplicates(metadata: DataFrame, key: str = "identifier") -> DataFrame:
    """The keys held by more than one record, with their counts."""
    return (
        metadata.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("records"))
        .where(F.col("records") > 1)
    )


def windows(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Windows that do not start the day after the one before them ends.

    With `by`, a group is one request's windows, a few per year of its date range. Without, all rows are one sequence,
    which is not brought together: see `all_windows`.
    """
    if not by:
        return all_windows(frame)
    previous = F.lag("window_end").over(Window.partitionBy(*by).orderBy("window_start", "window_end"))
    return (
        frame.withColumn("previous_end", previous)
        .where(F.col("previous_end").isNotNull())
        .withColumn("gap_days", F.datediff("window_start", "previous_end") - 1)
        .where(F.col("gap_days") != 0)
    )


def all_windows(frame: DataFrame) -> DataFrame:
    """The findings of one sequence of windows: window_start, window_end, previous_end, gap_days and `windows`.

    `windows` counts the rows that a finding stands for; of equal windows the second and later ones overlap the first.
    Equal rows are counted before anything is sorted, a year is a task of its own, and each year is handed the last
    window before it: one row per year is all that is ever brought together.
    """
    year = F.year("window_start")
    told = frame.where(F.col("window_start").isNotNull()).groupBy("window_start", "window_end").agg(F.count("*").alias("_n"))
    told = told.withColumn("_year", year)
    last = told.groupBy("_year").agg(F.max(F.struct("window_start", "window_end"))["window_end"].alias("_last"))
    handed = last.select("_year", F.lag("_last").over(Window.orderBy("_year")).alias("_handed"))
    inside = Window.partitionBy("_year").orderBy("window_start", "window_end")
    first = F.row_number().over(inside) == 1
    placed = told.withColumns({"_before": F.lag("window_end").over(inside), "_first": first}).join(handed, "_year")
    before = F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_before"))
    findings = F.array(
        F.struct(before.alias("previous_end"), F.lit(1).cast("bigint").alias("windows")),
        F.struct(F.col("window_end").alias("previous_end"), (F.col("_n") - 1).alias("windows")),
    )
    gap = F.datediff("window_start", "previous_end") - 1
    return (
        placed.select("window_start", "window_end", F.inline(findings))
        .where((F.col("windows") > 0) & F.col("previous_end").isNotNull())
        .select("window_start", "window_end", "previous_end", gap.alias("gap_days"), "windows")
        .where(F.col("gap_days") != 0)
    )


def links(metadata: DataFrame, allowed_dates: Sequence | None = None) -> DataFrame:
    """One row: records, links that are not absolute, unexpected partition stamps."""
    stamp_ok = F.col("partition_date").isNotNull()
    if allowed_dates is not None:
        stamp_ok = stamp_ok & F.col("partition_date").isin(list(allowed_dates))
    return metadata.agg(
        F.count("*").alias("records"),
        F.count_if(~F.col("doc_url").startswith("http")).alias("relative_links"),
        F.count_if(F.col("doc_url").isNull()).alias("missing_links"),
        F.count_if(~stamp_ok).alias("bad_partitions"),
    )


def zone_totals(files: DataFrame, by: Sequence[str] = ("zone",)) -> DataFrame:
    """Objects and bytes per zone; `size` is stored, so no content is read."""
    return files.groupBy(*by).agg(
        F.count("*").alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("bytes")
    )


def zone_parity(landing: DataFrame, clean: DataFrame, key: str = "identifier") -> DataFrame:
    """One row comparing the zones: unmatched records on either side, files and bytes.

    Both have the key and `size`, NULL for a record without a file. Keys are counted per zone rather than joined, so
    that a repeated key (which this audit is there to find) cannot multiply; each input is read once.
    """

    def in_zone(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(key, F.lit(name).alias("_zone"), F.col("size").cast("bigint").alias("size"))

    in_landing, in_clean = F.col("_zone") == "landing", F.col("_zone") == "clean"
    per_key = in_zone(landing, "landing").unionByName(in_zone(clean, "clean")).groupBy(key).agg(
        *(F.count_if(zone).alias(f"_{name}") for name, zone in (("l", in_landing), ("c", in_clean))),
        *(F.count_if(zone & F.col("size").isNotNull()).alias(f"_{name}_files") for name, zone in (("l", in_landing), ("c", in_clean))),
        *(F.sum(F.when(zone, F.col("size"))).alias(f"_{name}_bytes") for name, zone in (("l", in_landing), ("c", in_clean))),
    )

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)

    return (
        per_key.agg(
            total(F.col("_l"), "landing_records"),
            total(F.col("_c"), "clean_records"),
            total(F.when(F.col("_c") == 0, F.col("_l")), "landing_only"),
            total(F.when(F.col("_l") == 0, F.col("_c")), "clean_only"),
            total(F.col("_l_files"), "landing_files"),
            total(F.col("_c_files"), "clean_files"),
            total(F.col("_l_bytes"), "landing_bytes"),
            total(F.col("_c_bytes"), "clean_bytes"),
        )
        .withColumn(
            "parity",
            (F.col("landing_only") == 0)
            & (F.col("clean_only") == 0)
            & (F.col("landing_files") == F.col("clean_files")),
        )
        .withColumn("shrunk", F.col("clean_bytes") < F.col("landing_bytes"))
    )


def key_collisions(metadata: DataFrame) -> DataFrame:
    """Clean keys shared by different identifiers (spaces are dropped from the key)."""
    return (
        metadata.select(clean_key().alias("clean_key"), "identifier")
        .where(F.col("clean_key").isNotNull())
        .groupBy("clean_key")
        .agg(F.count_distinct("identifier").alias("identifiers"))
        .where(F.col("identifiers") > 1)
    )
