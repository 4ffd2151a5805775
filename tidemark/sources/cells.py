"""Metadata of a zone as cell files under a manifest: upserts write touched cells only, and commit at once.

    metadata/data/write=<id>/body_slug=<slug>/partition_date=<day>/   rows, written once
    metadata/keys/write=<id>/                                         a Bloom filter of the keys of each such file
    metadata/manifests/v=<n>/                                         the files that make up version n

A version counts once Spark's job commit has left the `_SUCCESS` file of its manifest. Files are never rewritten, so that
a reader of an older version is not disturbed; `sources.reclaim` drops what no kept version lists. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import bloom
from tidemark.operators.upsert import merge_set
from tidemark.schemas import FILE_FIELDS, POINTER_FIELDS
from tidemark.sources.tables import CELL, exists, names_in

KEY = ("identifier",)
# Keys that are asked of the filters at most; a larger batch meets nearly every file and reads them all.
ASKED = 10_000
# A cell is compacted towards files of this size.
FILE_BYTES = 128 << 20

MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("write_id", T.StringType()),
        T.StructField("body_slug", T.StringType()),
        T.StructField("partition_date", T.DateType()),
        T.StructField("records", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)

CELLS = T.StructType([MANIFEST[c] for c in CELL])


def versions(spark: SparkSession, zone: str) -> list[int]:
    """Committed versions, oldest first; one listing of the manifests and one look at each that is new to the list."""
    root = f"{zone}/metadata/manifests"
    found = (int(name[2:]) for name in names_in(spark, root) if name.startswith("v="))
    return sorted(n for n in found if exists(spark, f"{root}/v={n}/_SUCCESS"))


def newest(spark: SparkSession, zone: str) -> int:
    """The newest committed version, 0 where there is none. Looks from the end: older versions cost nothing."""
    root = f"{zone}/metadata/manifests"
    found = sorted((int(name[2:]) for name in names_in(spark, root) if name.startswith("v=")), reverse=True)
    return next((n for n in found if exists(spark, f"{root}/v={n}/_SUCCESS")), 0)


def manifest(spark: SparkSession, zone: str, version: int | None = None) -> DataFrame:
    """The files of a version, by default the newest; none where nothing was committed."""
    number = newest(spark, zone) if version is None else version
    if not number:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{zone}/metadata/manifests/v={number}")


def open_files(spark: SparkSession, zone: str, schema: T.StructType, files: DataFrame) -> DataFrame:
    """The rows of the listed files. The driver holds their names, as it does when Spark lists a directory."""
    data = f"{zone}/metadata/data"
    paths = [f"{data}/{r['path']}" for r in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", data).parquet(*paths)
    return rows.select(*schema.fieldNames())


def read(
    spark: SparkSession,
    zone: str,
    schema: T.StructType,
    start: date | None = None,
    end: date | None = None,
    version: int | None = None,
) -> DataFrame:
    """A version of the metadata; with a range, only the files of its partitions [start, end) are even listed."""
    files = manifest(spark, zone, version)
    if start is not None:
        files = files.where(F.col("partition_date") >= F.lit(start))
    if end is not None:
        files = files.where(F.col("partition_date") < F.lit(end))
    return open_files(spark, zone, schema, files)


def _filters(spark: SparkSession, zone: str, files: DataFrame) -> DataFrame:
    """The key filters of the listed files."""
    writes = [r["write_id"] for r in files.select("write_id").distinct().collect()]
    schema = "path string, records long, chunks long, bits map<bigint, binary>"
    filters = spark.read.schema(schema).parquet(*(f"{zone}/metadata/keys/write={w}" for w in writes))
    return filters.join(files.select("path"), "path", "left_semi")


def files_for_keys(spark: SparkSession, zone: str, asked: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The files of the newest version that may hold one of the asked keys."""
    files = manifest(spark, zone)
    if files.isEmpty():
        return files
    wanted = asked.select(bloom.hashes(key).alias("h")).distinct().limit(ASKED + 1).collect()
    if len(wanted) > ASKED:
        return files
    if not wanted:
        return files.limit(0)
    pairs = F.split(F.lit(" ".join(f"{r['h']['a']},{r['h']['b']}" for r in wanted)), " ")
    parts = F.transform(pairs, lambda p: F.split(p, ",").cast("array<bigint>"))
    hashed = F.transform(parts, lambda p: F.struct(F.get(p, F.lit(0)).alias("a"), F.get(p, F.lit(1)).alias("b")))
    hit = bloom.may_hold(F.col("bits"), F.col("chunks"), hashed)
    return files.join(_filters(spark, zone, files).where(hit).select("path"), "path", "left_semi")


def read_for_keys(
    spark: SparkSession, zone: str, schema: T.StructType, asked: DataFrame, key: Sequence[str] = KEY
) -> DataFrame:
    """All stored rows under the asked keys, and few others: to be joined exactly."""
    return open_files(spark, zone, schema, files_for_keys(spark, zone, asked, key))


def _described(spark: SparkSession, zone: str, write_id: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """Manifest rows of a write; its key filters are written beside it."""
    data = f"{zone}/metadata/data"
    rows = spark.read.schema(schema).option("basePath", data).parquet(f"{data}/write={write_id}")
    shown = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    named = rows.select(
        F.substring_index(shown, "/metadata/data/", -1).alias("path"), F.col("_metadata.file_size").alias("bytes"), *CELL, *key
    )
    filters = f"{zone}/metadata/keys/write={write_id}"
    bloom.build(named, ["path"], key).write.mode("overwrite").parquet(filters)
    return named.groupBy("path", "bytes", *CELL).agg(F.count("*").alias("records")).select(
        "path", F.lit(write_id).alias("write_id"), *CELL, "records", "bytes"
    )


def _commit(spark: SparkSession, zone: str, version: int, files: DataFrame) -> int:
    path = f"{zone}/metadata/manifests/v={version}"
    if exists(spark, f"{path}/_SUCCESS"):
        raise RuntimeError(f"version {version} of {zone} was committed by another writer")
    files.select(*MANIFEST.fieldNames()).coalesce(1).write.mode("overwrite").parquet(path)
    return version


def _write(rows: DataFrame, zone: str, version: int, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """Store rows by cell and return their manifest. A cell that holds much of the rows is split."""
    spark, write_id = rows.sparkSession, f"{version:08d}-{uuid.uuid4().hex[:8]}"
    path = f"{zone}/metadata/data/write={write_id}"
    rows.select(*schema.fieldNames()).hint("rebalance", *CELL).write.partitionBy(*CELL).parquet(path)
    if not any(name.startswith(f"{CELL[0]}=") for name in names_in(spark, path)):
        return spark.createDataFrame([], MANIFEST)
    return _described(spark, zone, write_id, schema, key)


def _same_cell(left: DataFrame, right: DataFrame) -> Column:
    return left[CELL[0]].eqNullSafe(right[CELL[0]]) & left[CELL[1]].eqNullSafe(right[CELL[1]])


def touched_cells(
    spark: SparkSession, zone: str, schema: T.StructType, batch: DataFrame, key: Sequence[str] = KEY
) -> DataFrame:
    """The cells that an upsert of the batch changes: those its records lie in, and those that hold their keys now."""
    stored = read_for_keys(spark, zone, schema, batch, key)
    same = F.lit(True)
    asked = batch.select(*(F.col(c).alias(f"_key_{c}") for c in key)).distinct()
    for c in key:
        same = same & stored[c].eqNullSafe(asked[f"_key_{c}"])
    return stored.join(asked, same, "left_semi").select(*CELL).unionByName(batch.select(*CELL)).distinct()


def upsert(
    spark: SparkSession,
    zone: str,
    schema: T.StructType,
    batch: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = KEY,
    sticky: Sequence[str] = (*FILE_FIELDS, *POINTER_FIELDS),
) -> int:
    """Merge a stored batch into the zone and return the version that holds it.

    Copy on write: cells that the batch changes are read, merged and written anew; all others are listed again as
    they are. An empty batch leaves the version as it is.
    """
    number = newest(spark, zone)
    if number and batch.isEmpty():
        return number
    files = manifest(spark, zone, number)
    touched = spark.createDataFrame(touched_cells(spark, zone, schema, batch, key).collect(), CELLS)
    read_again = files.join(touched, _same_cell(files, touched), "left_semi")
    kept = files.join(touched, _same_cell(files, touched), "left_anti")
    merged = merge_set(open_files(spark, zone, schema, read_again), batch, order, key=key, sticky=sticky)
    written = _write(merged, zone, number + 1, schema, key)
    return _commit(spark, zone, number + 1, kept.unionByName(written))


def compact(
    spark: SparkSession, zone: str, schema: T.StructType, key: Sequence[str] = KEY, file_bytes: int = FILE_BYTES
) -> int:
    """Rewrite the cells that have more files than their bytes ask for; returns the version that holds them."""
    number = newest(spark, zone)
    files = manifest(spark, zone, number)
    needed = F.greatest(F.lit(1), F.ceil(F.sum("bytes") / file_bytes))
    loose = files.groupBy(*CELL).agg(F.count("*").alias("n"), needed.alias("needed")).where("n > needed").select(*CELL)
    loose = spark.createDataFrame(loose.collect(), CELLS)
    if loose.isEmpty():
        return number
    chosen = files.join(loose, _same_cell(files, loose), "left_semi")
    kept = files.join(loose, _same_cell(files, loose), "left_anti")
    written = _write(open_files(spark, zone, schema, chosen), zone, number + 1, schema, key)
    return _commit(spark, zone, number + 1, kept.unionByName(written))
