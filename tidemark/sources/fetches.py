"""Stored HTTP responses: the input that stands in for crawling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import FETCHES


def read_fetches(spark: SparkSession, path: str) -> DataFrame:
    """Responses (url, status, body, fetched_at) from Parquet, with a fixed schema."""
    return spark.read.schema(FETCHES).parquet(path)


def as_fetches(pages: DataFrame, url: Column, body: Column, status: Column | None = None) -> DataFrame:
    """Shape any table of pages as responses."""
    return pages.select(
        url.alias("url"),
        (F.lit(200) if status is None else status).cast("int").alias("status"),
        body.cast("binary").alias("body"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )
