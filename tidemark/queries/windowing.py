"""Windows over the date spans found in the tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_status, parse_date
from tidemark.operators import audit, windows
from tidemark.queries.registry import load, query

def order_range(orders: DataFrame) -> tuple[date, date]:
    """From the first order's day to the day after the last one's: one row, of which the driver makes the windows."""
    on = F.to_date("o_orderdate")
    first, last = orders.agg(F.min(on), F.max(on)).first()
    return first, last + timedelta(days=1)


def windows_sql(requests: str, keys: str, months: int) -> str:
    """Sequential window rule: each start follows from the clamped one before it."""
    step = f"interval {months} month"
    return f"""
        WITH RECURSIVE req AS ({requests}),
        w AS (
            SELECT {keys}, s AS ws, e, least(cast(s + {step} AS date), e) AS nx FROM req WHERE s < e
            UNION ALL
            SELECT {keys}, nx, e, least(cast(nx + {step} AS date), e) FROM w WHERE nx < e
        )
    """


def requests(df: DataFrame, key: str, day: str) -> DataFrame:
    """One request per key: from its first day to the day after its last."""
    on = F.to_date(day)
    return df.groupBy(key).agg(
        F.min(on).alias("start"), F.date_add(F.max(on), 1).alias("end")
    )


_PER_CUSTOMER = """SELECT o_custkey, min(o_orderdate)::date AS s, max(o_orderdate)::date + 1 AS e
    FROM orders GROUP BY o_custkey"""


@query(
    windows_sql(_PER_CUSTOMER, "o_custkey", 1)
    + "SELECT o_custkey, ws AS window_start, (nx - 1)::date AS window_end, ws AS partition_date FROM w"
)
def windows_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.partition_windows(
        requests(load(spark, sf_dir, "orders"), "o_custkey", "o_orderdate"), 1
    )


@query(
    windows_sql(
        """SELECT l_suppkey, min(l_shipdate)::date AS s, max(l_shipdate)::date + 1 AS e
           FROM lineitem GROUP BY l_suppkey""",
        "l_suppkey",
        3,
    )
    + "SELECT l_suppkey, ws AS window_start, (nx - 1)::date AS window_end, ws AS partition_date FROM w"
)
def windows_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.partition_windows(
        requests(load(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate"), 3
    )


@query(
    windows_sql(
        """SELECT l_partkey, last_day(min(l_shipdate)::date) AS s, max(l_shipdate)::date + 1 AS e
           FROM lineitem GROUP BY l_partkey""",
        "l_partkey",
        1,
    )
    + "SELECT l_partkey, ws AS window_start, (nx - 1)::date AS window_end, ws AS partition_date FROM w"
)
def windows_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts on month ends, where short months shift all later windows."""
    spans = requests(load(spark, sf_dir, "lineitem"), "l_partkey", "l_shipdate")
    return windows.partition_windows(spans.withColumn("start", F.last_day("start")), 1)


@query(
    windows_sql(
        """SELECT c_nationkey, min(o_orderdate)::date AS s, max(o_orderdate)::date + 1 AS e
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
        "c_nationkey",
        1,
    )
    + """SELECT c_nationkey, ws AS partition_date, strftime(ws, '%d/%m/%Y') AS from_param,
         strftime((nx - 1)::date, '%d/%m/%Y') AS to_param FROM w"""
)
def window_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    frame = windows.partition_windows(requests(placed, "c_nationkey", "o_orderdate"), 1)
    return windows.with_params(frame).select("c_nationkey", "partition_date", "from_param", "to_param")


@query(
    windows_sql(_PER_CUSTOMER, "o_custkey", 1)
    + """SELECT o_custkey, strftime(min(ws), '%d/%m/%Y') AS first_from,
         strftime(max((nx - 1)::date), '%d/%m/%Y') AS last_to, count(*) AS windows
         FROM w GROUP BY o_custkey"""
)
def run_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = requests(load(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")
    return windows.span(windows.partition_windows(spans, 1), by=["o_custkey"])


@query(
    """
    WITH y AS (
        SELECT o_custkey, min(o_orderdate)::date AS window_start, max(o_orderdate)::date AS window_end
        FROM orders GROUP BY o_custkey, year(o_orderdate)
    ), p AS (
        SELECT *, lag(window_end) OVER (PARTITION BY o_custkey ORDER BY window_start) AS previous_end FROM y
    )
    SELECT o_custkey, window_start, window_end, previous_end,
           cast(window_start - previous_end - 1 AS integer) AS gap_days
    FROM p WHERE previous_end IS NOT NULL AND window_start - previous_end - 1 <> 0
    """
)
def audit_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's active span per year, read as windows: the gaps between them."""
    return audit.windows(_yearly(load(spark, sf_dir, "orders")), by=["o_custkey"])


def _yearly(orders: DataFrame) -> DataFrame:
    on = F.to_date("o_orderdate")
    return (
        orders.groupBy("o_custkey", F.year(on).alias("_year"))
        .agg(F.min(on).alias("window_start"), F.max(on).alias("window_end"))
        .drop("_year")
    )


@query(
    windows_sql("SELECT min(o_orderdate)::date AS s, max(o_orderdate)::date + 1 AS e, 0 AS k FROM orders", "k", 1)
    + """SELECT ws AS partition_date, (nx - 1)::date AS window_end, o_orderpriority, count(*) AS orders
         FROM w JOIN orders ON o_orderdate::date BETWEEN ws AND (nx - 1)::date
         GROUP BY ws, nx, o_orderpriority"""
)
def assign_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderdate", "o_orderpriority")
    return (
        windows.assign(orders, "o_orderdate", *order_range(orders))
        .groupBy("partition_date", "window_end", "o_orderpriority")
        .agg(F.count("*").alias("orders"))
    )


@query(
    """
    WITH y AS (
        SELECT o_custkey, min(o_orderdate)::date AS window_start, max(o_orderdate)::date AS window_end
        FROM orders GROUP BY o_custkey, year(o_orderdate)
    ), p AS (
        SELECT *, lag(window_end) OVER (ORDER BY window_start, window_end) AS previous_end FROM y
    )
    SELECT window_start, window_end, previous_end, cast(window_start - previous_end - 1 AS integer) AS gap_days,
        count(*) AS windows
    FROM p WHERE previous_end IS NOT NULL AND window_start - previous_end - 1 <> 0 GROUP BY ALL
    """
)
def audit_all_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly spans of all customers as one sequence: nearly all overlap the one before."""
    found = audit.windows(_yearly(load(spark, sf_dir, "orders")).drop("o_custkey"))
    # Two findings may agree in all that they say.
    by = ("window_start", "window_end", "previous_end", "gap_days")
    return found.groupBy(*by).agg(F.sum("windows").alias("windows"))


@query(
    """
    WITH t AS (
        SELECT o_orderkey, CASE
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
            WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00'
            WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-') || '31'
            WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%-m-%-d')
            ELSE strftime(o_orderdate, '%d/%m/%Y') END AS value, o_orderdate::date AS day,
            o_orderpriority, o_orderstatus
        FROM orders
    ), p AS (
        SELECT o_orderkey, value, CASE
            WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL
            WHEN o_orderpriority = '1-URGENT' THEN
                CASE WHEN month(day) IN (1, 3, 5, 7, 8, 10, 12) THEN last_day(day) END
            WHEN o_orderstatus IN ('F', 'O') THEN day END AS parsed
        FROM t
    )
    SELECT o_orderkey, parsed, CASE WHEN value IS NULL THEN 'missing'
        WHEN parsed IS NULL THEN 'malformed' ELSE 'ok' END AS status FROM p
    """
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date arguments as people write them: padded or not, slashed, cut short, absent."""
    on, priority, status = F.to_date("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    value = (
        F.when(priority == "4-NOT SPECIFIED", F.lit(None).cast("string"))
        .when(priority == "5-LOW", F.date_format(on, "yyyy-MM-dd 00:00"))
        .when(priority == "1-URGENT", F.date_format(on, "yyyy-MM-31"))
        .when(status == "F", F.date_format(on, "yyyy-MM-dd"))
        .when(status == "O", F.date_format(on, "yyyy-M-d"))
        .otherwise(F.date_format(on, "dd/MM/yyyy"))
    )
    return (
        load(spark, sf_dir, "orders")
        .select("o_orderkey", value.alias("value"))
        .select("o_orderkey", parse_date("value").alias("parsed"), date_status("value").alias("status"))
    )
