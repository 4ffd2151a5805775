"""Object keys, content types and hashes of stored files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import CONTENT_TYPES, DEFAULT_CONTENT_TYPE


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def body_slug(body: Column | str) -> Column:
    return F.replace(F.lower(_column(body)), F.lit(" "), F.lit("-"))


def extension(doc_type: Column | str) -> Column:
    return F.coalesce(F.nullif(_column(doc_type), F.lit("")), F.lit("html"))


def _key(body: Column | str, partition_date: Column | str, name: Column, doc_type: Column | str) -> Column:
    return F.concat(
        body_slug(body),
        F.lit("/"),
        _column(partition_date).cast("string"),
        F.lit("/"),
        name,
        F.lit("."),
        extension(doc_type),
    )


def landing_key(
    body: Column | str = "body",
    partition_date: Column | str = "partition_date",
    identifier: Column | str = "identifier",
    doc_type: Column | str = "doc_type",
) -> Column:
    """slug/partition/identifier.ext; a missing identifier prints as 'None'."""
    return _key(body, partition_date, F.coalesce(_column(identifier), F.lit("None")), doc_type)


def clean_key(
    body: Column | str = "body",
    partition_date: Column | str = "partition_date",
    identifier: Column | str = "identifier",
    doc_type: Column | str = "doc_type",
) -> Column:
    """As the landing key with spaces dropped; NULL without an identifier."""
    name = F.replace(_column(identifier), F.lit(" "), F.lit(""))
    return _key(body, partition_date, name, doc_type)


def content_type(kind: Column | str) -> Column:
    """Content type of an extension (landing) or of a raw document type (clean)."""
    column = _column(kind)
    result = F.lit(DEFAULT_CONTENT_TYPE)
    for name, mime in CONTENT_TYPES.items():
        result = F.when(column == name, mime).otherwise(result)
    return result


def file_hash(content: Column | str) -> Column:
    """Lower-case hexadecimal SHA-256 of the bytes."""
    return F.sha2(_column(content).cast("binary"), 256)
