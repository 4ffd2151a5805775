"""Search plan over the orders: priorities as bodies, order counts as result totals."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.urls import result_total as total_of
from tidemark.operators import listing, reconcile, windows
from tidemark.queries.registry import load, query
from tidemark.queries.windowing import order_range, windows_sql

BASE_URL = "https://search.example.org/decisions"

_GRID = windows_sql(
    """SELECT DISTINCT o_orderpriority AS body_id, substr(o_orderpriority, 3) AS body,
       substr(o_orderpriority, 1, 1)::int AS body_order, (SELECT min(o_orderdate)::date FROM orders) AS s,
       (SELECT max(o_orderdate)::date + 1 FROM orders) AS e FROM orders""",
    "body_id, body, body_order",
    1,
)
_PAGES = (
    _GRID
    + """, cells AS (
        SELECT body_id, body, ws, (nx - 1)::date AS we, count(o_orderkey) AS total
        FROM w LEFT JOIN orders
        ON o_orderpriority = body_id AND o_orderdate::date BETWEEN ws AND (nx - 1)::date
        GROUP BY body_id, body, ws, nx
    ), pages AS (
        SELECT *, unnest(generate_series(1, greatest(1, cast(ceil(total / 10.0) AS bigint)))) AS page FROM cells
    )
    """
)


def dimension(orders: DataFrame) -> DataFrame:
    """The order priorities ('1-URGENT') as an ordered body dimension."""
    priority = F.col("o_orderpriority")
    return orders.select(priority.alias("body_id")).distinct().select(
        "body_id",
        F.substr("body_id", F.lit(3)).alias("body"),
        F.substr("body_id", F.lit(1), F.lit(1)).cast("int").alias("body_order"),
    )


def grid(orders: DataFrame) -> DataFrame:
    return listing.plan_grid(dimension(orders), *order_range(orders))


def first_pages(orders: DataFrame) -> DataFrame:
    """The grid with each cell's result total and the cards on its first page."""
    totals = (
        windows.assign(orders.select("o_orderdate", "o_orderpriority"), "o_orderdate", *order_range(orders))
        .groupBy(F.col("o_orderpriority").alias("body_id"), "partition_date")
        .agg(F.count("*").alias("total"))
    )
    return grid(orders).join(totals, ["body_id", "partition_date"], "left").withColumn(
        "cards", F.least(F.coalesce("total", F.lit(0)), F.lit(10))
    )


@query(
    _GRID
    + """SELECT body_id, body, body_order, ws AS window_start, (nx - 1)::date AS window_end,
         ws AS partition_date, strftime(ws, '%d/%m/%Y') AS from_param,
         strftime((nx - 1)::date, '%d/%m/%Y') AS to_param FROM w"""
)
def plan_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(load(spark, sf_dir, "orders"))


@query(
    """SELECT o_orderpriority AS body_id, substr(o_orderpriority, 3) AS body,
       substr(o_orderpriority, 1, 1)::int AS body_order, count(*) AS orders, sum(o_totalprice::decimal(12, 2))::decimal(20, 2) AS value
       FROM orders WHERE o_orderpriority IN ('5-LOW', '3-MEDIUM') GROUP BY o_orderpriority"""
)
def select_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two known bodies and an unknown one; the selection reaches the orders' scan."""
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("body_id"), F.col("o_totalprice").cast("decimal(12,2)").alias("price")
    )
    return (
        listing.select_bodies(orders, " 5-LOW,3-MEDIUM, 9-UNKNOWN")
        .groupBy("body_id")
        .agg(F.count("*").alias("orders"), F.sum("price").cast("decimal(20,2)").alias("value"))
        .select(
            "body_id",
            F.substr("body_id", F.lit(3)).alias("body"),
            F.substr("body_id", F.lit(1), F.lit(1)).cast("int").alias("body_order"),
            "orders",
            "value",
        )
    )


@query(_PAGES + "SELECT body_id, ws AS partition_date, total, page FROM pages")
def plan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.plan_pages(first_pages(load(spark, sf_dir, "orders"))).select(
        "body_id", "partition_date", F.coalesce("total", F.lit(0)).alias("total"), "page"
    )


@query(
    _PAGES
    + f"""SELECT ws AS partition_date, page,
          '{BASE_URL}?decisions=1&from=' || strftime(ws, '%d/%m/%Y') || '&to=' || strftime(we, '%d/%m/%Y')
          || '&body=' || replace(body_id, ' ', '+') || '&pageNumber=' || page AS search_url FROM pages"""
)
def search_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = listing.plan_pages(first_pages(load(spark, sf_dir, "orders")))
    return listing.with_search_url(pages, BASE_URL).select("partition_date", "page", "search_url")


@query(
    """
    SELECT doc_id, CASE lang WHEN 'en' THEN n_chars WHEN 'de' THEN n_chars
        WHEN 'fr' THEN CASE WHEN n_chars < 1000 THEN n_chars END END AS total
    FROM documents
    """
)
def result_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals announced after the whole text of each document, in several manners."""
    count, lang = F.col("n_chars").cast("string"), F.col("lang")
    notice = (
        F.when(lang == "en", F.concat(F.lit("Shows 1 to 10 of  "), count, F.lit("  results, of 7 results")))
        .when(lang == "de", F.concat(F.lit("1 to 10 OF "), count, F.lit(" \n Results")))
        .when(lang == "fr", F.concat(F.lit("of "), F.format_number("n_chars", 0), F.lit(" results")))
        .otherwise("no count here")
    )
    return load(spark, sf_dir, "documents").select(
        "doc_id", total_of(F.concat("text", F.lit("\n"), notice)).alias("total")
    )


_ACCOUNTS = (
    windows_sql(
        """SELECT DISTINCT substr(o_orderpriority, 3) AS body, (SELECT last_day(min(o_orderdate)::date) + 1 FROM orders) AS s,
           (SELECT max(o_orderdate)::date + 1 FROM orders) AS e FROM orders""",
        "body",
        1,
    )
    + """, o AS (
        SELECT date_trunc('month', o_orderdate)::date AS partition_date, substr(o_orderpriority, 3) AS body,
            o_totalprice, CASE o_orderstatus WHEN 'F' THEN 'scraped' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS status,
            o_orderkey IN (SELECT l_orderkey FROM lineitem) AS handled
        FROM orders
    ), c AS (
        SELECT partition_date, body, count(*) FILTER (WHERE o_totalprice >= 5000) AS found,
            count(*) FILTER (WHERE handled AND status = 'scraped') AS scraped,
            count(*) FILTER (WHERE handled AND status = 'failed') AS failed,
            count(*) FILTER (WHERE handled AND status = 'skipped') AS skipped
        FROM o GROUP BY ALL
    ), a AS (
        SELECT coalesce(w.ws, c.partition_date) AS partition_date, coalesce(w.body, c.body) AS body,
            coalesce(found, 0) AS found, coalesce(scraped, 0) AS scraped,
            coalesce(failed, 0) AS failed, coalesce(skipped, 0) AS skipped, c.body IS NULL AS listing_missing,
            w.body IS NULL AS unplanned
        FROM w FULL JOIN c ON c.partition_date = w.ws AND c.body = w.body
    ), r AS (SELECT *, greatest(0, found - scraped - failed - skipped)::bigint AS missing FROM a)
    """
)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records: found when of some value, handled when they have line items.

    The plan begins with the second month: what the first one has is there without having been planned.
    """
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date(F.date_trunc("MM", "o_orderdate")).alias("partition_date"),
        F.substr("o_orderpriority", F.lit(3)).alias("body"),
        F.col("o_orderpriority").alias("body_id"),
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", "scraped")
        .when(F.col("o_orderstatus") == "O", "skipped")
        .otherwise("failed")
        .alias("status"),
    )
    bodies = orders.select("body").distinct()
    first, end = order_range(load(spark, sf_dir, "orders"))
    cells = listing.plan_grid(bodies, (first.replace(day=1) + timedelta(days=31)).replace(day=1), end)
    found = orders.groupBy(*reconcile.CELL).agg(
        F.count_if(F.col("o_totalprice") >= 5000).alias("found")
    )
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    handled = orders.join(lines, "o_orderkey", "left_semi")
    return reconcile.by_partition(cells, found, reconcile.count_outcomes(handled))


@query(_ACCOUNTS + "SELECT * FROM r")
def reconcile_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts(spark, sf_dir)


@query(
    _ACCOUNTS
    + """, t AS (
        SELECT body, sum(found)::bigint AS found, sum(scraped)::bigint AS scraped, sum(failed)::bigint AS failed,
            sum(skipped)::bigint AS skipped, CASE grouping(body) WHEN 1 THEN 'run' ELSE 'group' END AS level
        FROM r GROUP BY ROLLUP (body)
    ) SELECT *, greatest(0, found - scraped - failed - skipped)::bigint AS missing FROM t"""
)
def reconcile_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.rollup(accounts(spark, sf_dir))


@query(_ACCOUNTS + "SELECT * FROM r WHERE missing > 0")
def unaccounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.unaccounted(accounts(spark, sf_dir))
