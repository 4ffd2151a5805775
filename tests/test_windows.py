import collections
import datetime
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_date, parse_date_arg
from tidemark.operators import audit, windows

D = datetime.date


def one_by_one(start, end, months):
    """The rule as a loop: each start follows from the clamped start before it."""
    starts = [pd.Timestamp(start)]
    while starts[-1].date() < end:
        starts.append(min(starts[-1] + pd.DateOffset(months=months), pd.Timestamp(end)))
    day = pd.Timedelta(days=1)
    return [(a.date(), (b - day).date()) for a, b in zip(starts, starts[1:])]


def cut(spark, start, end, months=1):
    frame = windows.partition_windows(windows.date_range(spark, start, end, months), months)
    return [(r["window_start"], r["window_end"]) for r in frame.orderBy("window_start").collect()]


def test_year_in_months_and_quarters(spark):
    months = cut(spark, D(2024, 1, 1), D(2025, 1, 1))
    assert len(months) == 12
    assert months[0] == (D(2024, 1, 1), D(2024, 1, 31)) and months[-1] == (D(2024, 12, 1), D(2024, 12, 31))
    quarters = cut(spark, D(2024, 1, 1), D(2025, 1, 1), 3)
    assert [end for _, end in quarters] == [D(2024, 3, 31), D(2024, 6, 30), D(2024, 9, 30), D(2024, 12, 31)]


def test_end_is_exclusive(spark):
    assert cut(spark, D(2024, 1, 1), D(2024, 1, 31)) == [(D(2024, 1, 1), D(2024, 1, 30))]
    assert cut(spark, D(2024, 1, 1), D(2024, 2, 1)) == [(D(2024, 1, 1), D(2024, 1, 31))]


def test_lost_days_stay_lost(spark):
    starts = [start for start, _ in cut(spark, D(2024, 1, 31), D(2024, 6, 1))]
    assert starts == [D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 29), D(2024, 4, 29), D(2024, 5, 29)]
    assert cut(spark, D(2023, 1, 31), D(2023, 4, 1))[1][0] == D(2023, 2, 28)


def test_bad_ranges(spark):
    with pytest.raises(ValueError, match="never ends"):
        windows.date_range(spark, D(2024, 1, 1), D(2025, 1, 1), 0)
    with pytest.raises(ValueError, match="nothing lies before"):
        windows.date_range(spark, D(2025, 1, 1), D(2024, 1, 1), 1)


def test_params_and_span(spark):
    frame = windows.partition_windows(windows.date_range(spark, D(2024, 1, 1), D(2024, 3, 1)))
    first = windows.with_params(frame).orderBy("window_start").first()
    assert (first["from_param"], first["to_param"], first["partition_date"]) == (
        "01/01/2024", "31/01/2024", D(2024, 1, 1),
    )
    assert windows.span(frame).first().asDict() == {
        "first_from": "01/01/2024", "last_to": "29/02/2024", "windows": 2,
    }


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.dates(D(1890, 1, 1), D(2105, 1, 1)), st.integers(-40, 4000)), min_size=20, max_size=40
    ),
    st.sampled_from([1, 2, 3, 5, 12, 48]),
)
def test_many_requests_against_the_loop(spark, ranges, months):
    rows = [(i, s, s + datetime.timedelta(days=n)) for i, (s, n) in enumerate(ranges)]
    rows += [(1000 + y, D(y, 1, 31), D(y + 9, 3, 2)) for y in (1895, 1999, 2003, 2095)]
    rows += [(2000 + y, D(y, 2, 29), D(y + 50, 3, 2)) for y in (2000, 2072)]
    frame = spark.createDataFrame(rows, "k int, start date, end date")
    got = sorted(
        (r["k"], r["window_start"], r["window_end"]) for r in windows.partition_windows(frame, months).collect()
    )
    want = sorted((k, a, b) for k, s, e in rows for a, b in one_by_one(s, e, months))
    assert got == want


def test_expansion_needs_no_shuffle(spark):
    frame = spark.createDataFrame([(1, D(2024, 1, 31), D(2024, 6, 1))], "k int, start date, end date")
    plan = windows.partition_windows(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dates(D(1895, 1, 1), D(2100, 1, 1)), st.integers(1, 3000), st.sampled_from([1, 1, 2, 3, 5, 12, 48]))
@example(D(2024, 1, 31), 61, 1)
@example(D(1999, 12, 31), 2000, 1)
@example(D(2096, 2, 29), 4000, 48)
def test_records_get_their_one_window(spark, start, days, months):
    end = start + datetime.timedelta(days=days)
    spans = one_by_one(start, end, months)
    edges = {d + datetime.timedelta(days=i) for span in spans for d in span for i in (-1, 0, 1)}
    edges |= {start + datetime.timedelta(days=i) for i in range(-3, min(days, 400) + 3)} | {None}
    records = spark.createDataFrame([(d,) for d in edges], "day date")
    got = windows.assign(records, "day", start, end, months)
    want = sorted((d, s, e) for s, e in spans for d in edges if d is not None and s <= d <= e)
    assert sorted((r["day"], r["window_start"], r["window_end"]) for r in got.collect()) == want


def test_assigning_is_a_projection(spark):
    records = spark.createDataFrame([(datetime.datetime(2024, 2, 29, 23, 59),)], "at timestamp")
    got = windows.assign(records, "at", D(2024, 1, 31), D(2024, 4, 1))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert tuple(got.select("window_start", "window_end").first()) == (D(2024, 2, 29), D(2024, 3, 28))


def test_one_sequence_of_windows_is_spread(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        start = D(2000, 1, 1) + datetime.timedelta(days=rng.randrange(6000))
        rows += [(start, start + datetime.timedelta(days=rng.randrange(40)))] * rng.choice([1, 1, 1, 3])
    rows += [(D(2030, 1, 1), D(2030, 1, 31)), (D(2033, 2, 1), D(2033, 2, 2)), (None, D(2000, 1, 1))]
    frame = spark.createDataFrame(rows, "window_start date, window_end date").repartition(4)
    ordered = sorted(r for r in rows if r[0])
    want = collections.Counter(
        (*b, a[1], (b[0] - a[1]).days - 1) for a, b in zip(ordered, ordered[1:]) if (b[0] - a[1]).days != 1
    )
    found = audit.windows(frame)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Only the rows that stand for a year, made by an aggregate, come together.
    single = plan[plan.index("Exchange SinglePartition"):]
    assert "HashAggregate" in single or "SortAggregate" in single
    assert plan.count("SinglePartition") == 1 and "hashpartitioning(_year" in plan
    got = collections.Counter()
    for r in found.collect():
        got[tuple(r)[:4]] += r["windows"]
    assert got == want


def test_audit_finds_gap_and_overlap(spark):
    rows = [("a", D(2024, 1, 1), D(2024, 1, 31)), ("a", D(2024, 2, 1), D(2024, 2, 28)),
            ("a", D(2024, 3, 1), D(2024, 3, 31)), ("a", D(2024, 3, 30), D(2024, 4, 1)),
            ("b", D(2024, 2, 1), D(2024, 2, 2))]
    frame = spark.createDataFrame(rows, "k string, window_start date, window_end date")
    found = audit.windows(frame, ["k"]).orderBy("window_start").collect()
    assert [(r["window_start"], r["gap_days"]) for r in found] == [(D(2024, 3, 1), 1), (D(2024, 3, 30), -2)]
    good = windows.partition_windows(windows.date_range(spark, D(2024, 1, 31), D(2026, 1, 1)))
    assert audit.windows(good).count() == 0


def test_date_arguments():
    assert parse_date_arg("2024-01-01", "start") == D(2024, 1, 1)
    assert parse_date_arg("2024-1-5", "start") == D(2024, 1, 5)
    with pytest.raises(ValueError, match="must be a date"):
        parse_date_arg("01/01/2024", "start")
    for absent in (None, ""):
        with pytest.raises(ValueError, match="end is missing"):
            parse_date_arg(absent, "end")


def test_date_columns_follow_the_argument_rule(spark):
    values = ["2024-01-01", "2024-1-5", "2024-12-31", "01/01/2024", "2024", "2024-02-31", "2024-01-01x",
              "2024-01-01 ", "24-01-01", "2024-13-01", "0000-01-01", "2024-001-01", "2024-00-10", "", None]

    def expected(value):
        try:
            return parse_date_arg(value, "x")
        except ValueError:
            return None

    frame = spark.createDataFrame([(v,) for v in values], "v string").select("v", parse_date("v").alias("d"))
    assert {r["v"]: r["d"] for r in frame.collect()} == {v: expected(v) for v in values}
    assert frame.where(F.col("d").isNotNull()).count() == 3
