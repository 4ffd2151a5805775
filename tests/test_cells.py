"""The cell store: upserts against a loop, what they write and read, compaction, filters, and reclaiming."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import bloom
from tidemark.schemas import LANDING_METADATA
from tidemark.sources import cells, reclaim, tables
from tidemark.streaming.incremental import RECORDS, merge_arrivals

D = datetime.date
SCHEMA = T.StructType(
    [LANDING_METADATA[n] for n in ("identifier", "description", "file_path", "file_hash", "scraped_at", "file_run", "file_row", "file_day")]
    + [LANDING_METADATA[n] for n in cells.CELL]
)
BATCH = T.StructType([*SCHEMA.fields, T.StructField("n", T.IntegerType()), T.StructField("has_content", T.BooleanType())])


def rows(spark, path, *records):
    """A stored batch of (identifier, description, slug, day, run, row); position is the order."""
    out = []
    for n, (identifier, description, slug, day, run, row) in enumerate(records):
        has = run is not None
        out.append((identifier, description, row, row, None, run, row, D(2024, 1, day) if has else None, slug, D(2024, 1, day), n, has))
    spark.createDataFrame(out, BATCH).write.mode("overwrite").parquet(path)
    return spark.read.schema(BATCH).parquet(path)


def data_files(zone):
    found = {}
    for folder, _, names in os.walk(f"{zone}/metadata/data"):
        found |= {os.path.join(folder, n): os.path.getmtime(os.path.join(folder, n)) for n in names if n.endswith(".parquet")}
    return found


def state(spark, zone, version=None):
    got = cells.read(spark, zone, SCHEMA, version=version).collect()
    return {r["identifier"]: (r["description"], r["body_slug"], str(r["partition_date"]), r["file_run"], r["file_row"]) for r in got}


@pytest.fixture()
def zone(spark, tmp_path):
    """Forty records in eight cells, one of them with names that a path has to escape."""
    where = str(tmp_path / "zone")
    slugs = ["a", "b + c%d", None, "d"]
    records = [(f"k{i}", f"old {i}", slugs[i % 4], 1 + i // 20, "r1", f"p{i}") for i in range(40)]
    assert cells.upsert(spark, where, SCHEMA, rows(spark, f"{tmp_path}/first", *records), ("n",)) == 1
    return where


def test_a_small_batch_writes_touched_cells_only(spark, zone, tmp_path):
    before, kept = data_files(zone), state(spark, zone)
    assert len(before) == 8 and len(kept) == 40
    # k1 stays, k0 moves to a new cell, x is new in one that is there, None has no key.
    batch = rows(spark, f"{tmp_path}/second", ("k1", "new", "b + c%d", 1, None, None), ("k0", "moved", "e", 3, "r2", "q"),
                 ("x", "x", "d", 2, "r2", "s"), (None, "none", "d", 2, None, None), ("k1", "newer", "b + c%d", 1, None, None))
    assert cells.upsert(spark, zone, SCHEMA, batch, ("n",)) == 2
    after = data_files(zone)
    assert {p: m for p, m in after.items() if p in before} == before
    # The cells of k1, k0 (old and new) and x: the four others are listed again, not written.
    assert len(after) - len(before) == 4
    listed = cells.manifest(spark, zone)
    assert listed.count() == 9 and listed.agg(F.sum("records")).first()[0] == 42
    want = kept | {
        "k1": ("newer", "b + c%d", "2024-01-01", "r1", "p1"), "k0": ("moved", "e", "2024-01-03", "r2", "q"),
        "x": ("x", "d", "2024-01-02", "r2", "s"), None: ("none", "d", "2024-01-02", None, None),
    }
    assert state(spark, zone) == want
    assert state(spark, zone, version=1) == kept, "a reader of the version before is not disturbed"
    # The same batch again changes nothing; an empty one commits nothing.
    assert cells.upsert(spark, zone, SCHEMA, batch, ("n",)) == 3 and state(spark, zone) == want
    assert cells.upsert(spark, zone, SCHEMA, batch.limit(0), ("n",)) == 3


def test_random_batches_against_a_dictionary(spark, tmp_path):
    rng, where, want = random.Random(2), str(tmp_path / "zone"), {}
    for turn in range(4):
        records = []
        for i in range(60):
            key = rng.choice([None, f"k{rng.randrange(40)}"])
            run = rng.choice([None, f"r{turn}"])
            records.append((key, f"{turn}.{i}", rng.choice("ab"), rng.randint(1, 3), run, f"p{i}" if run else None))
            old = want.get(key, (None,) * 5)
            want[key] = (f"{turn}.{i}", records[-1][2], f"2024-01-0{records[-1][3]}", *((run, f"p{i}") if run else old[3:]))
        cells.upsert(spark, where, SCHEMA, rows(spark, f"{tmp_path}/b{turn}", *records), ("n",))
        assert state(spark, where) == want


def test_a_stream_writes_touched_cells_only(spark, tmp_path):
    source, where = str(tmp_path / "in"), str(tmp_path / "zone")

    def arrive(identifier, slug):
        row = dict.fromkeys(RECORDS.fieldNames()) | {"identifier": identifier, "body_slug": slug, "partition_date": D(2024, 1, 1), "body_order": 0}
        spark.createDataFrame([tuple(row.values())], RECORDS).coalesce(1).write.mode("append").parquet(source)
        assert merge_arrivals(spark, source, where, str(tmp_path / "c")).awaitTermination(120)

    arrive("a", "one")
    before = data_files(where)
    arrive("b", "two")
    after = data_files(where)
    assert len(before) == 1 and len(after) == 2 and set(before) < set(after)
    assert cells.read(spark, where, LANDING_METADATA).count() == 2


def test_filters_leave_files_out(spark, zone):
    asked = spark.createDataFrame([("k0",), ("k4",), ("nobody",)], "identifier string")
    files = cells.files_for_keys(spark, zone, asked)
    assert 1 <= files.count() <= 2  # k0 and k4 lie in one cell
    found = cells.read_for_keys(spark, zone, SCHEMA, asked)
    assert {"k0", "k4"} <= {r["identifier"] for r in found.collect()}
    assert len(found.inputFiles()) == files.count()
    assert cells.read_for_keys(spark, zone, SCHEMA, asked.limit(0)).count() == 0
    every = spark.range(cells.ASKED + 1).selectExpr("concat('n', id) AS identifier")
    assert cells.files_for_keys(spark, zone, every).count() == 8


def test_range_reads_list_no_other_files(spark, zone):
    found = cells.read(spark, zone, SCHEMA, D(2024, 1, 2), D(2024, 1, 3))
    assert found.count() == 20 and all("partition_date=2024-01-02" in f for f in found.inputFiles())


def test_bloom_filters_never_deny_a_key(spark):
    keys = spark.range(9000).selectExpr("CASE WHEN id < 3 THEN 'small' ELSE 'large' END AS g", "concat('k', id) AS k")
    built = bloom.build(keys, ["g"], ["k"]).cache()
    sizes = {r["g"]: (r["records"], r["chunks"], len(r["bits"])) for r in built.collect()}
    assert sizes == {"small": (3, 1, 1), "large": (8997, 7, 7)}
    asked = keys.join(built, "g").select(bloom.may_hold(F.col("bits"), F.col("chunks"), F.array(bloom.hashes(["k"]))).alias("hit"))
    assert asked.where("NOT hit").count() == 0
    others = spark.range(20_000, 40_000).selectExpr("concat('k', id) AS k").join(built.where("g = 'large'"))
    wrong = others.select(bloom.may_hold(F.col("bits"), F.col("chunks"), F.array(bloom.hashes(["k"]))).alias("hit")).where("hit").count()
    assert wrong < 40


def test_compaction_keeps_the_rows(spark, zone, tmp_path):
    assert cells.compact(spark, zone, SCHEMA) == 1, "a cell of one file is as it should be"
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        batch = rows(spark, f"{tmp_path}/b", *[(f"k{i}", "again", "a", 1, None, None) for i in range(20)])
        cells.upsert(spark, zone, SCHEMA, batch, ("n",))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    before, loose = state(spark, zone), cells.manifest(spark, zone)
    assert loose.count() > loose.select(*cells.CELL).distinct().count()
    assert cells.compact(spark, zone, SCHEMA) == 3
    tight = cells.manifest(spark, zone)
    assert tight.count() == tight.select(*cells.CELL).distinct().count() and state(spark, zone) == before


def store(spark, zone, run, *records):
    """Rows of bytes of a run, one file per cell."""
    out = [(row, row.encode() * 10, 10 * len(row), True, slug, D(2024, 1, day)) for row, slug, day in records]
    frame = spark.createDataFrame(out, "file_row string, content binary, size long, written boolean, body_slug string, partition_date date")
    tables.write_files(frame, f"{zone}/files/run_id={run}", rebalance=True)


def test_sweep_and_rewrite(spark, zone, tmp_path):
    store(spark, zone, "r1", *((f"p{i}", ["a", "b + c%d", None, "d"][i % 4], 1 + i // 20) for i in range(40)))
    store(spark, zone, "r2", *((f"q{i}", "d", 2) for i in range(5)), ("q5", "d", 1))
    # All of cell (d, 2) but k39 gets new bytes, and k3 of cell (d, 1).
    batch = [(f"k{i}", "second", "d", 2, "r2", f"q{n}") for n, i in enumerate((23, 27, 31, 35))] + [("k3", "second", "d", 1, "r2", "q5")]
    assert cells.upsert(spark, zone, SCHEMA, rows(spark, f"{tmp_path}/b2", *batch), ("n",)) == 2
    at_two = state(spark, zone)
    held = reclaim.held(spark, zone, SCHEMA, keep=1)
    sums = {(r["run_id"], r["body_slug"]): (r["records"], r["dead_records"], r["dead_bytes"]) for r in reclaim.reclaimable(held).collect()}
    assert sums[("r1", "d")] == (10, 5, 140) and sums[("r2", "d")] == (6, 1, 20) and sums[("r1", None)] == (10, 0, 0)
    # While both versions are kept, only the row that no version ever pointed at is dead.
    both = reclaim.reclaimable(reclaim.held(spark, zone, SCHEMA, keep=2), by=["run_id"])
    assert {r["run_id"]: r["dead_records"] for r in both.collect()} == {"r1": 0, "r2": 1}
    assert reclaim.sweep(spark, zone, SCHEMA, keep=2) == {"versions": 0, "metadata": 0, "files": 0, "stages": 0}

    # One file of r1 is mostly dead: its last live row moves.
    assert reclaim.rewrite(spark, zone, SCHEMA, "c1", ("partition_date", "identifier")) == 3
    assert state(spark, zone)["k39"] == ("old 39", "d", "2024-01-02", "c1", "r1/p39")
    assert {k: v for k, v in state(spark, zone).items() if k != "k39"} == {k: v for k, v in at_two.items() if k != "k39"}
    old_reader = cells.read(spark, zone, SCHEMA, version=2)
    gone = reclaim.sweep(spark, zone, SCHEMA, keep=2)
    assert (gone["versions"], gone["files"]) == (1, 0) and gone["metadata"] == 2
    assert cells.versions(spark, zone) == [2, 3]
    # Readers of a kept version still find their rows and their bytes.
    read = tables.live_files(tables.read_files(spark, zone), old_reader)
    assert old_reader.count() == 40 and read.where("content IS NOT NULL").count() == 40

    gone = reclaim.sweep(spark, zone, SCHEMA, keep=1, stages=["c1"])
    assert gone["versions"] == 1 and gone["files"] == 1 and gone["stages"] == 1
    newest = cells.read(spark, zone, SCHEMA)
    live = tables.live_files(tables.read_files(spark, zone), newest).collect()
    assert len(live) == 40 and all(bytes(r["content"]).startswith(r["file_row"].rsplit("/", 1)[-1].encode()) for r in live)
    with pytest.raises(ValueError):
        reclaim.sweep(spark, zone, SCHEMA, keep=0)
