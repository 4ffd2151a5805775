"""Temp views over both zones."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import CLEAN_METADATA, LANDING_METADATA
from tidemark.sources import cells, tables


def register(spark: SparkSession, landing: str, clean: str) -> None:
    """Views `landing_metadata`, `clean_metadata`, and `files`: one row per record that has a file, with its zone."""
    both = None
    for zone, path, schema in (("landing", landing, LANDING_METADATA), ("clean", clean, CLEAN_METADATA)):
        metadata = cells.read(spark, path, schema)
        metadata.createOrReplaceTempView(f"{zone}_metadata")
        rows = tables.live_files(tables.read_files(spark, path), metadata).withColumn("zone", F.lit(zone))
        both = rows if both is None else both.unionByName(rows)
    both.createOrReplaceTempView("files")
