"""Table schemas and the fixed values every zone shares."""

from __future__ import annotations

from pyspark.sql import types as T

# Body id -> body name, in crawl order.
BODIES = {
    "1": "Equality Tribunal",
    "2": "Employment Appeals Tribunal",
    "3": "Labour Court",
    "15376": "Workplace Relations Commission",
}

# Document type -> stored content type.
CONTENT_TYPES = {
    "html": "text/html",
    "pdf": "application/pdf",
    "doc": "application/msword",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"

# Fixed value: cards per listing page when page 1 shows none.
DEFAULT_PAGE_SIZE = 10

FILE_FIELDS = ("file_path", "file_hash", "scraped_at")

# Where the bytes of a record lie: the run that wrote them, the row within it, and the day its partition is of.
POINTER_FIELDS = ("file_run", "file_row", "file_day")

FETCHES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

LANDING_METADATA = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("identifier", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("published_date", T.StringType()),
        T.StructField("doc_url", T.StringType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("file_run", T.StringType()),
        T.StructField("file_row", T.StringType()),
        T.StructField("file_day", T.DateType()),
        T.StructField("body_slug", T.StringType()),
        T.StructField("partition_date", T.DateType()),
    ]
)

CLEAN_METADATA = T.StructType(
    LANDING_METADATA.fields[:-2]
    + [T.StructField("transformed_at", T.TimestampType())]
    + LANDING_METADATA.fields[-2:]
)

# One row per response that a run has read: the bytes, unless they were stored before, and what was found out about
# them, so that records are joined to the findings without computing (or reading) the bytes again.
FILES = T.StructType(
    [
        T.StructField("file_row", T.StringType()),
        T.StructField("doc_url", T.StringType()),
        T.StructField("version", T.TimestampType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("attachment", T.StringType()),
        T.StructField("parse_error", T.StringType()),
        T.StructField("written", T.BooleanType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("body_slug", T.StringType()),
        T.StructField("partition_date", T.DateType()),
    ]
)

# Everything an event of a run may hold.
EVENTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("timestamp", "level", "event", "run_id")]
    + [T.StructField("attempt", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("partition", "body", "identifier", "url", "cause", "reason", "start", "end")]
    + [T.StructField("status", T.IntegerType())]
    + [T.StructField(n, T.LongType()) for n in ("windows", "partition_months", "read", "transformed")]
    + [T.StructField(n, T.LongType()) for n in ("found", "scraped", "failed", "skipped", "missing")]
    + [T.StructField("unplanned", T.BooleanType()), T.StructField("bodies", T.ArrayType(T.StringType()))]
)
