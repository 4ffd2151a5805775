"""Partition windows: a half-open date range cut into back-to-back windows."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import day_param


def check_range(start: date, end: date, months: int) -> None:
    """The end is exclusive, so a range needs at least one day, and a window at least one month."""
    if not start < end:
        raise ValueError(f"nothing lies before {end} from {start} on")
    if not months >= 1:
        raise ValueError(f"a window of {months} months never ends")


def date_range(spark: SparkSession, start: date, end: date, months: int = 1) -> DataFrame:
    """One validated window request (start, end) as a row."""
    check_range(start, end, months)
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def partition_windows(requests: DataFrame, months: int = 1) -> DataFrame:
    """Cut every row's [start, end) into windows; other columns are repeated.

    Each window starts `months` after the *clamped* start before it, so a day lost to
    a short month stays lost (31 Jan, 29 Feb, 29 Mar). The start day of window k is
    therefore the least of the first day and the length of every month met so far,
    which needs only the first month of 28, 29 and 30 days: the rule is evaluated
    within the row, with no shuffle or ordering. Rows without start < end give none.
    """
    if not months >= 1:
        raise ValueError(f"a window of {months} months never ends")
    keys = [c for c in requests.columns if c not in ("start", "end")]

    first_month = F.trunc("start", "MM")
    steps = F.floor(F.months_between(F.trunc("end", "MM"), first_month) / months).cast("int")
    numbers = F.sequence(F.lit(0), F.when(F.col("start") < F.col("end"), steps + 1))

    def first_with(days: int) -> Column:
        # Only a start day beyond `days` can be cut to it, so most rows skip the search.
        month_starts = F.transform(numbers, lambda k: F.add_months(first_month, k * months))
        found = F.filter(month_starts, lambda m: F.day(F.last_day(m)) == days)
        return F.when(F.day("start") > days, F.get(found, F.lit(0)))

    def window_start(month: Column) -> Column:
        shortest = (
            F.when(month >= F.col("_first28"), 28)
            .when(month >= F.col("_first29"), 29)
            .when(month >= F.col("_first30"), 30)
            .otherwise(31)
        )
        return F.date_add(month, F.least(F.day("start"), shortest) - 1)

    following = window_start(F.add_months(F.col("_month"), months))
    return (
        requests.select(
            *keys, "start", "end", *(first_with(d).alias(f"_first{d}") for d in (28, 29, 30))
        )
        .select("*", F.explode(numbers).alias("_k"))
        .withColumn("_month", F.add_months(first_month, F.col("_k") * months))
        .withColumn("window_start", window_start(F.col("_month")))
        .where(F.col("window_start") < F.col("end"))
        .select(
            *keys,
            "window_start",
            F.date_sub(F.least(following, F.col("end")), 1).alias("window_end"),
            F.col("window_start").alias("partition_date"),
        )
    )


def with_params(windows: DataFrame) -> DataFrame:
    """Add the search's inclusive from/to values."""
    return windows.withColumns(
        {"from_param": day_param("window_start"), "to_param": day_param("window_end")}
    )


def _shortest_months(start: date, end: date, months: int) -> dict[int, date]:
    """The first month of 28, 29 and 30 days in which a window of the range starts."""
    found, month = {}, start.year * 12 + start.month - 1
    while month <= end.year * 12 + end.month - 1 and month // 12 <= date.max.year:
        year, number = divmod(month, 12)
        found.setdefault(monthrange(year, number + 1)[1], date(year, number + 1, 1))
        month += months
    return found


def assign(records: DataFrame, on: str, start: date, end: date, months: int = 1) -> DataFrame:
    """Stamp each record with the one window of [start, end) that holds its date; others are left out.

    The window rule read backwards: the month of a day gives the number of the window that starts in or before it; where
    that one starts only after the day, it is the window before. No join and no calendar: a projection.
    """
    check_range(start, end, months)
    shortest = _shortest_months(start, end, months)
    first = date(start.year, start.month, 1)

    def window_start(number: Column) -> Column:
        month = F.add_months(F.lit(first), number * months)
        cut = F.lit(31)
        for days in (30, 29, 28):
            if days in shortest:
                cut = F.when(month >= F.lit(shortest[days]), days).otherwise(cut)
        return F.date_add(month, F.least(F.lit(start.day), cut) - 1)

    passed = (F.year("_day") - start.year) * 12 + F.month("_day") - start.month
    number = F.floor(passed / months).cast("int")
    kept = [c for c in records.columns if c not in ("window_start", "window_end", "partition_date")]
    return (
        records.withColumn("_day", F.to_date(F.col(on)))
        .where((F.col("_day") >= F.lit(start)) & (F.col("_day") < F.lit(end)))
        .withColumn("_number", number)
        .withColumn("_number", F.when(window_start(F.col("_number")) > F.col("_day"), F.col("_number") - 1).otherwise(F.col("_number")))
        .select(
            *kept,
            window_start(F.col("_number")).alias("window_start"),
            F.date_sub(F.least(window_start(F.col("_number") + 1), F.lit(end)), 1).alias("window_end"),
            window_start(F.col("_number")).alias("partition_date"),
        )
    )


def span(windows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First from, last to and number of windows, per group."""
    return windows.groupBy(*by).agg(
        day_param(F.min("window_start")).alias("first_from"),
        day_param(F.max("window_end")).alias("last_to"),
        F.count("*").alias("windows"),
    )
