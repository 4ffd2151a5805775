"""Landing, then clean: the second stage runs only when the first has succeeded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.dates import parse_date_arg
from tidemark.plans import landing, transform


def run_zones(
    spark: SparkSession,
    fetches: DataFrame,
    landing_zone: str,
    clean_zone: str,
    base_url: str,
    start: str,
    end: str,
    run_id: str,
    run_ts: datetime | None = None,
    bodies: str | None = None,
    months: int = 1,
    mode: str = "skip",
    tag: str = "div",
    css_class: str = "content",
) -> dict[str, int]:
    """Both stages over one date range; an error in landing leaves clean untouched.

    `mode` 'refresh' fetches stored records again; `tag` and `css_class` name the container that cleaning keeps.
    """
    first, last = parse_date_arg(start, "start"), parse_date_arg(end, "end")
    landing.run(
        spark, fetches, landing_zone, base_url, first, last, run_id, run_ts, bodies, months, mode
    )
    return transform.run(spark, landing_zone, clean_zone, first, last, run_id, run_ts, tag, css_class)
