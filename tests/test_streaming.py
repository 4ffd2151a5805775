import datetime

from tidemark.schemas import LANDING_METADATA
from tidemark.sources import cells
from tidemark.streaming.incremental import RECORDS, merge_arrivals


def record(identifier, description, position, path=None):
    row = dict.fromkeys(RECORDS.fieldNames()) | {
        "identifier": identifier, "description": description, "body_slug": "b", "position": position,
        "partition_date": datetime.date(2024, 1, 1), "file_path": path, "file_hash": path,
        "has_content": path is not None, "body_order": 0, "page": 1,
    }
    return tuple(row[name] for name in RECORDS.fieldNames())


def test_arrivals_merge_once(spark, tmp_path):
    source, zone, checkpoint = (str(tmp_path / n) for n in ("in", "zone", "checkpoint"))

    def arrive(*records):
        spark.createDataFrame(list(records), RECORDS).coalesce(1).write.mode("append").parquet(source)
        query = merge_arrivals(spark, source, zone, checkpoint)
        assert query.awaitTermination(120)
        rows = cells.read(spark, zone, LANDING_METADATA).collect()
        return {r["identifier"]: (r["description"], r["file_path"]) for r in rows}

    first = arrive(record("a", "one", 0, "p"), record("a", "two", 1), record("b", "x", 2))
    assert first == {"a": ("two", "p"), "b": ("x", None)}
    second = arrive(record("a", "three", 0), record("c", "y", 1, "q"))
    assert second == {"a": ("three", "p"), "b": ("x", None), "c": ("y", "q")}
    # Nothing new has come: no batch, no version.
    query = merge_arrivals(spark, source, zone, checkpoint)
    assert query.awaitTermination(120)
    assert cells.versions(spark, zone) == [1, 2]
