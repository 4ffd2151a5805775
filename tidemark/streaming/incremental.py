"""Metadata that arrives in files, merged as it comes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.landing import ORDER
from tidemark.schemas import LANDING_METADATA
from tidemark.sources import cells

# A record as a landing run leaves it: the metadata, its place, and whether it has bytes.
RECORDS = T.StructType(
    LANDING_METADATA.fields
    + [
        T.StructField("body_order", T.IntegerType()),
        T.StructField("page", T.LongType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("has_content", T.BooleanType()),
    ]
)


def merge_arrivals(
    spark: SparkSession,
    source: str,
    zone: str,
    checkpoint: str,
    order: Sequence[str] = ORDER,
    max_files: int = 1000,
) -> StreamingQuery:
    """Merge records that appear under `source` into a zone's metadata, then stop.

    Each micro-batch is one field-wise upsert and one new version, which writes the cells it touches and lists the
    others again. A batch that is repeated after a failure merges to the same rows, so arrivals count once.
    """

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # Stored first: the upsert asks for the batch's keys and cells before it merges them.
        path = f"{zone}/runs/arrivals/batch={number}"
        batch.write.mode("overwrite").parquet(path)
        cells.upsert(session, zone, LANDING_METADATA, session.read.schema(RECORDS).parquet(path), order)

    return (
        spark.readStream.schema(RECORDS)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
