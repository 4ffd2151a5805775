"""What a zone no longer needs: versions past their retention, files that no kept version lists, bytes that none points at.

Mark and sweep. The newest versions are kept, so that their readers go on undisturbed; everything they list or point at is
live. Whole files are dropped where nothing in them is; a file of bytes that is mostly dead can be written anew, under
another run, by `rewrite`, after which the records point there and the old file dies with the older versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import FILES
from tidemark.sources import cells, tables

# Versions whose readers are still waited for.
KEEP = 2
# Share of a file's bytes that is dead before it is written anew.
DEAD_SHARE = 0.5

POINTER = ("run_id", "file_row")


def pointers(metadata: DataFrame) -> DataFrame:
    """The rows of bytes that records point at, each once."""
    return metadata.where(F.col("file_row").isNotNull()).select(F.col("file_run").alias("run_id"), "file_row").distinct()


def mark(files: DataFrame, live: DataFrame, on: Sequence[str] = POINTER) -> DataFrame:
    """Add `live`: whether a pointer leads to the row. `live` has each pointer once; content is not touched."""
    return files.join(live.withColumn("_live", F.lit(True)), list(on), "left").withColumn(
        "live", F.coalesce("_live", F.lit(False))
    ).drop("_live")


def reclaimable(marked: DataFrame, by: Sequence[str] = ("run_id", "body_slug")) -> DataFrame:
    """Rows and bytes held, and how many of them nothing points at."""
    dead = ~F.col("live")

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)

    return marked.groupBy(*by).agg(
        F.count("*").alias("records"),
        total(F.col("size"), "bytes"),
        F.count_if(dead).alias("dead_records"),
        total(F.when(dead, F.col("size")), "dead_bytes"),
    )


def _kept_pointers(spark: SparkSession, zone: str, schema: T.StructType, keep: int) -> DataFrame:
    """Pointers of all kept versions; each metadata file is read once, however many of them list it."""
    return pointers(cells.open_files(spark, zone, schema, _kept_files(spark, zone, keep)))


def _kept_files(spark: SparkSession, zone: str, keep: int) -> DataFrame:
    listed = spark.createDataFrame([], cells.MANIFEST)
    for version in cells.versions(spark, zone)[-keep:]:
        listed = listed.unionByName(cells.manifest(spark, zone, version))
    return listed.select("path", "write_id").distinct()


def _stored(spark: SparkSession, zone: str) -> DataFrame:
    """Narrow rows of all bytes, also of rows that hold none, each with the file that it lies in."""
    if not tables.exists(spark, f"{zone}/files"):
        kinds = T.StructType([FILES[n] for n in ("run_id", "file_row", *cells.CELL, "size", "written")])
        return spark.createDataFrame([], kinds.add("path", "string"))
    rows = spark.read.schema(FILES).parquet(f"{zone}/files")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return rows.select("run_id", "file_row", *cells.CELL, "size", "written", path.alias("path"))


def held(spark: SparkSession, zone: str, schema: T.StructType, keep: int = KEEP) -> DataFrame:
    """Rows of bytes of a zone, with the file each lies in and whether a kept version points at it."""
    return mark(_stored(spark, zone).where("written"), _kept_pointers(spark, zone, schema, keep))


def sweep(spark: SparkSession, zone: str, schema: T.StructType, keep: int = KEEP, stages: Sequence[str] = ()) -> dict[str, int]:
    """Drop what no kept version needs; returns how many versions, metadata files, files of bytes and stages went.

    `stages` names the finished runs whose intermediate tables may go. The driver holds the names of dropped files only.
    """
    if keep < 1:
        raise ValueError("the newest version is always kept")
    gone = {"versions": 0, "metadata": 0, "files": 0, "stages": 0}
    old = cells.versions(spark, zone)[:-keep]
    # Versions go first: a sweep that stops in between leaves nothing that lists what is missing.
    for version in old:
        gone["versions"] += tables.drop(spark, f"{zone}/metadata/manifests/v={version}")

    live = _kept_files(spark, zone, keep).cache()
    data = f"{zone}/metadata/data"
    names = [(r["write_id"], r["path"]) for r in live.collect()]
    writes, listed = {w for w, _ in names}, {p for _, p in names}
    for name in tables.names_in(spark, data):
        if not name.startswith("write="):
            continue
        if name[6:] not in writes:
            gone["metadata"] += tables.drop(spark, f"{data}/{name}")
            tables.drop(spark, f"{zone}/metadata/keys/{name}")
            continue
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        for r in found.load(f"{data}/{name}").select("path").collect():
            path = f"{name}/" + r["path"].split(f"/{name}/", 1)[1]
            if path not in listed:
                gone["metadata"] += tables.drop(spark, f"{data}/{path}")
    live.unpersist()

    marked = mark(_stored(spark, zone), _kept_pointers(spark, zone, schema, keep))
    dead = marked.groupBy("path").agg(F.max("live").alias("live")).where("NOT live").select("path")
    for r in dead.collect():
        gone["files"] += tables.drop(spark, r["path"])
    for run in stages:
        gone["stages"] += tables.drop(spark, f"{zone}/runs/{run}")
    return gone


def rewrite(
    spark: SparkSession, zone: str, schema: T.StructType, run_id: str, order: Sequence[str], share: float = DEAD_SHARE
) -> int:
    """Copy the live rows of mostly dead files into run `run_id` and point their records there; returns the version.

    The copies keep their cells and rows' names. The files they came from go with the next sweep after the versions that
    point at them.
    """
    newest = cells.read(spark, zone, schema)
    tables.refuse_used_run(newest, (run_id,))
    marked = mark(_stored(spark, zone).where("written"), pointers(newest))
    dead = F.coalesce(F.sum(F.when(~F.col("live"), F.col("size"))), F.lit(0))
    loose = marked.groupBy("path").agg((dead / F.greatest(F.sum("size"), F.lit(1))).alias("dead"), F.max("live").alias("live"))
    paths = [r["path"] for r in loose.where((F.col("dead") >= share) & F.col("live")).select("path").collect()]
    if not paths:
        return cells.newest(spark, zone)
    source = spark.read.schema(FILES).option("basePath", f"{zone}/files").parquet(*paths).where("written")
    copies = source.join(pointers(newest), list(POINTER), "left_semi").withColumn("file_row", F.concat_ws("/", "run_id", "file_row"))
    tables.write_files(copies.drop("run_id"), f"{zone}/files/run_id={run_id}", rebalance=True)

    moved = spark.read.parquet(f"{zone}/files/run_id={run_id}").select(F.col("file_row").alias("_new"))
    records = newest.join(moved, F.concat_ws("/", "file_run", "file_row") == F.col("_new"))
    batch = records.withColumns({"file_run": F.lit(run_id), "file_row": F.col("_new"), "has_content": F.lit(True)})
    work = f"{zone}/runs/{run_id}/moved"
    batch.drop("_new").write.mode("overwrite").parquet(work)
    return cells.upsert(spark, zone, schema, spark.read.parquet(work), order)

