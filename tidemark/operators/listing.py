"""Search plan (body x window x page) and the records on listing pages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import html
from tidemark.functions.urls import doc_type, search_url
from tidemark.operators.windows import check_range, partition_windows, with_params
from tidemark.schemas import BODIES, DEFAULT_PAGE_SIZE

# Pages are generated in blocks, so that no row ever holds a long array.
PAGES_PER_BLOCK = 4096


def bodies(spark: SparkSession) -> DataFrame:
    """The body dimension in crawl order."""
    rows = [
        F.struct(F.lit(key).alias("body_id"), F.lit(name).alias("body"), F.lit(order).alias("body_order"))
        for order, (key, name) in enumerate(BODIES.items())
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def select_bodies(dimension: DataFrame, wanted: str | None = None) -> DataFrame:
    """Bodies named in a comma list; unknown ids are ignored, no list means all."""
    if not wanted:
        return dimension
    return dimension.where(F.col("body_id").isin([part.strip() for part in wanted.split(",")]))


def plan_grid(dimension: DataFrame, start: date, end: date, months: int = 1) -> DataFrame:
    """Every body with every window: each body row expands its own windows."""
    check_range(start, end, months)
    requests = dimension.withColumns({"start": F.lit(start), "end": F.lit(end)})
    return with_params(partition_windows(requests, months))


def plan_pages(first_pages: DataFrame, total: str = "total", cards: str = "cards") -> DataFrame:
    """One row per listing page: page 1 always, the rest from its total and size.

    Two-step expansion: blocks of pages first, then the pages of a block, spread over
    the cluster in between, so that one huge (body, window) neither builds a long
    array nor runs as a single task.
    """
    size = F.coalesce(F.nullif(F.col(cards), F.lit(0)), F.lit(DEFAULT_PAGE_SIZE))
    last = F.greatest(F.lit(1), F.ceil(F.coalesce(F.col(total), F.lit(0)) / size)).cast("bigint")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((last - 1) / PAGES_PER_BLOCK))
    # A fixed number: adaptive coalescing would merge these few small rows into one task.
    spread = int(first_pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("_block") * PAGES_PER_BLOCK + 1
    pages = F.sequence(first, F.least(F.col("_last"), first + (PAGES_PER_BLOCK - 1)))
    return (
        first_pages.withColumn("_last", last)
        .select("*", F.explode(blocks).alias("_block"))
        .repartition(spread, *first_pages.columns, "_block")
        .select(*first_pages.columns, F.explode(pages).alias("page"))
    )


def with_search_url(pages: DataFrame, base_url: str) -> DataFrame:
    return pages.withColumn(
        "search_url", search_url(base_url, "from_param", "to_param", "body_id", "page")
    )


def read_cards(pages: DataFrame, content: str = "content", url: str = "url") -> DataFrame:
    """Add `cards` (array) and `listing_error`; the page body goes no further."""
    parsed = pages.withColumn("_parsed", html.cards(F.col(content), F.col(url)))
    return parsed.select(
        *(c for c in pages.columns if c != content),
        F.col("_parsed.value").alias("cards"),
        F.col("_parsed.error").alias("listing_error"),
    )


def parse_cards(listing: DataFrame) -> DataFrame:
    """One row per card of already read listing pages."""
    kept = [c for c in listing.columns if c not in ("cards", "listing_error", "url")]
    return (
        listing.select(*kept, F.explode("cards").alias("_card"))
        .select(*kept, "_card.*")
        .withColumn("doc_type", doc_type("doc_url"))
    )
