"""Every registered query against its SQL on the given tables."""

import datetime
import decimal
import glob
import os
import re

import duckdb
import pytest

from tidemark.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, (decimal.Decimal, float)):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    result = QUERIES[name](spark, sf_dir)
    expected = oracle.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got, want = _rows(result.columns, result.collect()), _rows(columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want
    assert want, "a comparison of nothing with nothing shows nothing"


def exchanged(spark, frame):
    """Column names that each shuffle of the plan moves."""
    text = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    return [{c.split("#")[0].strip() for c in columns.split(",")} for columns in found]


@pytest.mark.parametrize("name", ["clean_zone", "transform_stats", "zone_totals", "audit_zone_parity"])
def test_no_shuffle_moves_bytes(spark, sf_dir, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = exchanged(spark, QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved and not any(columns & {"content", "html", "_cleaned"} for columns in moved)


def test_bytes_meet_responses_not_records(spark, sf_dir):
    """Half of the line items share a document: it is one row wherever its bytes go."""
    frame = QUERIES["shared_contents"](spark, sf_dir)
    hot = frame.orderBy(frame.records.desc()).first()
    assert hot["records"] > 10_000 and frame.where(frame.doc_url == hot["doc_url"]).count() == 1
    assert frame.count() == frame.select("doc_url").distinct().count()


@pytest.mark.parametrize(
    "name,scans,shuffles", [("dedup_first", 1, 1), ("upsert_merge", 2, 2), ("assign_windows", 1, 1)]
)
def test_scans_and_shuffles(spark, sf_dir, name, scans, shuffles):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == scans and plan.count("Exchange") == shuffles
    assert "Broadcast" not in plan
