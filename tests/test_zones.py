"""Landing and clean runs end to end over a small stored site."""

import datetime
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_queries import exchanged

from tidemark.operators import audit, documents, reconcile
from tidemark.plans import landing, transform, zones
from tidemark.schemas import CLEAN_METADATA, FETCHES, LANDING_METADATA
from tidemark.sources import cells, tables, views
from tidemark.sources.fetches import as_fetches, read_fetches

BASE = "https://search.example.org/find"
D = datetime.date
START, END = D(2024, 1, 1), D(2024, 3, 1)
NOW = datetime.datetime(2024, 6, 1)


def search(body, start, end, page):
    return f"{BASE}?decisions=1&from={start}&to={end}&body={body}&pageNumber={page}"


def card(identifier, href, description="A v B", ref=None):
    link = f'<a href="{href}">{identifier}</a>' if href is not None else ""
    ref = f'<span class="refNO">{ref}</span>' if ref else ""
    return (
        f'<li class="each-item"><h2 class="title">{link}</h2>{ref}'
        f'<span class="date">02/01/2024</span><p class="description">{description}</p></li>'
    )


def listing(cards, total):
    return f"<ul>{''.join(cards)}</ul><p>Shows 1 to 2 of {total} results</p>"


def page(text):
    return (
        "<html><head><style>x</style></head><body><nav>menu</nav>"
        f'<div class="content"><p>{text}</p><script>t()</script></div></body></html>'
    )


SHELL = (
    '<div class="content"> </div><div class="related-file">'
    '<a class="download" href="/files/{}.pdf">Download</a></div>'
)
JAN, FEB = ("01/01/2024", "31/01/2024"), ("01/02/2024", "29/02/2024")
HOST = "https://search.example.org"


def site():
    """Labour Court: two windows, three pages in the first; another body: one window listed."""
    return {
        search("3", *JAN, 1): listing([card("ADJ 1", "/d/1.html"), card("ADJ2", "/d/2.html")], 6),
        search("3", *JAN, 2): listing([card("ADJ3", "/d/3.pdf"), card("ADJ4", "/d/4.html")], 6),
        search("3", *JAN, 3): listing([card("ADJ 1", "/d/again.html")], 6),
        search("3", *FEB, 1): listing([card("ADJ5", "/d/missing.html"), card("ADJ6", None, ref=" ADJ6 ")], 2),
        search("15376", *JAN, 1): listing([card("", "/d/7.html"), card("ADJ8", "/d/1.html")], 2),
        HOST + "/d/1.html": page("one"),
        HOST + "/d/2.html": SHELL.format("a"),
        HOST + "/d/3.pdf": b"%PDF\x00\x01three",
        HOST + "/d/4.html": SHELL.format("gone"),
        HOST + "/d/7.html": page("seven"),
        HOST + "/files/a.pdf": b"%PDF\x00\x01attached",
    }


def as_table(spark, pages, stamp=NOW):
    rows = [
        (url, 200, body if isinstance(body, bytes) else body.encode(), stamp)
        for url, body in pages.items()
    ]
    return spark.createDataFrame(rows, FETCHES)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    zone = str(tmp_path_factory.mktemp("zones") / "landing")
    summary = landing.run(
        spark, as_table(spark, site()), zone, BASE, START, END, "r1", NOW, wanted="3,15376"
    )
    return zone, summary


def by_id(df):
    return {row["identifier"]: row for row in df.collect()}


def test_landing_metadata(spark, landed):
    zone, _ = landed
    metadata = cells.read(spark, zone, LANDING_METADATA)
    rows = by_id(metadata)
    assert set(rows) == {"ADJ 1", "ADJ2", "ADJ3", "ADJ6", "ADJ8", None}
    # ADJ8 has the document of ADJ 1, and its own path, but no row of bytes of its own.
    assert rows["ADJ8"]["file_hash"] == rows["ADJ 1"]["file_hash"]
    assert {(rows[k]["file_run"], rows[k]["file_row"]) for k in ("ADJ8", "ADJ 1")} == {("r1", rows["ADJ 1"]["file_row"])}
    assert tables.read_files(spark, zone).count() == 4
    assert rows["ADJ 1"]["file_path"] == "labour-court/2024-01-01/ADJ 1.html"
    assert rows["ADJ2"]["doc_type"] == "pdf" and rows["ADJ2"]["doc_url"].endswith("/files/a.pdf")
    assert rows["ADJ6"]["file_path"] is None and rows["ADJ6"]["doc_url"] is None
    assert rows[None]["file_path"] == "workplace-relations-commission/2024-01-01/None.html"
    assert rows["ADJ 1"]["partition_date"] == D(2024, 1, 1)
    files = tables.live_files(tables.read_files(spark, zone), metadata)
    assert {r["file_path"]: r["content_type"] for r in files.collect()} == {
        "labour-court/2024-01-01/ADJ 1.html": "text/html",
        "labour-court/2024-01-01/ADJ2.pdf": "application/pdf",
        "labour-court/2024-01-01/ADJ3.pdf": "application/pdf",
        "workplace-relations-commission/2024-01-01/None.html": "text/html",
        "workplace-relations-commission/2024-01-01/ADJ8.html": "text/html",
    }


def test_accounting(landed):
    _, summary = landed
    got = {(str(r["partition_date"]), r["body"]): r for r in summary.collect()}
    assert len(got) == 4
    first = got[("2024-01-01", "Labour Court")]
    # Six announced, five listed: the repeated card is skipped, one attachment is gone.
    assert [first[c] for c in ("found", "scraped", "failed", "skipped", "missing")] == [6, 3, 1, 1, 1]
    second = got[("2024-02-01", "Labour Court")]
    assert [second[c] for c in ("found", "scraped", "failed", "skipped", "missing")] == [2, 1, 1, 0, 0]
    # Its second card has the page of a record in another cell.
    third = got[("2024-01-01", "Workplace Relations Commission")]
    assert [third[c] for c in ("found", "scraped", "failed", "skipped", "missing")] == [2, 2, 0, 0, 0]
    assert got[("2024-02-01", "Workplace Relations Commission")]["listing_missing"]


def test_events(spark, landed):
    zone, _ = landed
    events = [r.asDict() for r in spark.read.json(f"{zone}/events").collect()]
    kinds = sorted({e["event"] for e in events})
    assert kinds == [
        "download_failed", "listing_failed", "partition_found", "partition_summary",
        "records_unaccounted", "run_started", "run_summary",
    ]
    run = next(e for e in events if e["event"] == "run_summary")
    assert (run["found"], run["scraped"], run["failed"], run["skipped"], run["missing"]) == (10, 6, 2, 1, 1)
    started = next(e for e in events if e["event"] == "run_started")
    assert (started["start"], started["end"], started["windows"]) == ("01/01/2024", "29/02/2024", 2)


def test_second_run_skips_stored_records(spark, landed):
    zone, _ = landed
    before = set(by_id(cells.read(spark, zone, LANDING_METADATA)))
    summary = landing.run(
        spark, as_table(spark, site()), zone, BASE, START, END, "r2", NOW, wanted="3,15376"
    )
    totals = summary.agg(*(F.sum(c).alias(c) for c in ("scraped", "skipped", "failed"))).first()
    # Tried again: the failed records and the one without an identifier, which merges into its row.
    assert (totals["scraped"], totals["failed"]) == (1, 2)
    metadata = cells.read(spark, zone, LANDING_METADATA)
    assert metadata.count() == len(before)
    assert set(by_id(metadata)) == before


def test_every_card_has_a_reason(spark):
    """A card that a step loses, in the dedup or later, counts neither as skipped nor as an outcome."""
    cell = (D(2024, 1, 1), "A")
    keys = ["a", "a", "b", "c", "d", "e", None, "", "f"]
    cards = spark.createDataFrame([(*cell, k, f"r{i}") for i, k in enumerate(keys)], "partition_date date, body string, identifier string, row string")
    # The dedup has lost e, a later step d and the card with the empty key.
    firsts = spark.createDataFrame(
        [("a", "r0", False), ("b", "r2", True), ("c", "r3", False), ("d", "r4", False), (None, "r6", False), ("", "r7", False), ("f", "r8", True)],
        "identifier string, row string, was_stored boolean",
    )
    outcomes = spark.createDataFrame([("r0", "scraped"), ("r3", "failed"), ("r6", "scraped")], "row string, status string")
    told = reconcile.ledger(cards, firsts, outcomes)
    assert {r["row"]: r["reason"] for r in told.collect()} == {
        "r0": "scraped", "r1": "repeated", "r2": "stored", "r3": "failed", "r4": "lost", "r5": "lost", "r6": "scraped",
        "r7": "lost", "r8": "stored",
    }
    # Where stored records are fetched again, one without an outcome is lost.
    again = {r["row"]: r["reason"] for r in reconcile.ledger(cards, firsts, outcomes, skips=False).collect()}
    assert again["r2"] == again["r8"] == "lost"
    grid = spark.createDataFrame([cell], "partition_date date, body string")
    pages = grid.selectExpr("*", "1L AS page", "'scraped' AS status", "9L AS total")
    got = landing.account(grid, pages, told).first()
    assert [got[c] for c in ("found", "scraped", "failed", "skipped", "missing", "unplanned")] == [9, 2, 1, 3, 3, False]


def test_cells_outside_the_plan_are_told(spark):
    grid = spark.createDataFrame([(D(2024, 1, 1), "A")], "partition_date date, body string")
    found = spark.createDataFrame([(D(2024, 1, 1), "A", 2), (D(2024, 2, 1), "A", 1)], "partition_date date, body string, found long")
    outcomes = spark.createDataFrame(
        [(D(2024, 1, 1), "A", "scraped"), (D(2024, 1, 1), "B", "failed"), (None, "A", "scraped")], "partition_date date, body string, status string"
    )
    got = reconcile.by_partition(grid, found, reconcile.count_outcomes(outcomes))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # the counts, and the fold
    assert {(str(r["partition_date"]), r["body"]): (r["found"], r["scraped"], r["failed"], r["missing"], r["listing_missing"], r["unplanned"])
            for r in got.collect()} == {
        ("2024-01-01", "A"): (2, 1, 0, 1, False, False), ("2024-02-01", "A"): (1, 0, 0, 1, False, True),
        ("2024-01-01", "B"): (0, 0, 1, 0, True, True), ("None", "A"): (0, 1, 0, 0, True, True),
    }


def test_a_repeated_run_replaces_its_events(spark, tmp_path):
    zone = str(tmp_path / "z")
    broken = as_table(spark, site()).withColumn("body", F.raise_error(F.lit("disk gone")).cast("binary"))
    arguments = (zone, BASE, START, END, "r1", NOW, "3,15376")
    with pytest.raises(Exception, match="disk gone"):
        landing.run(spark, broken, *arguments)
    first = tables.read_events(spark, zone)
    assert {(r["event"], r["attempt"]) for r in first.collect()} == {("run_started", 1), ("run_failed", 1)}
    assert "disk gone" in first.where("event = 'run_failed'").first()["cause"]
    landing.run(spark, as_table(spark, site()), *arguments)
    events = tables.read_events(spark, zone)
    assert events.where("event = 'run_failed'").count() == 1
    told = reconcile.last_attempts(events)
    assert {r["attempt"] for r in told.collect()} == {2} and told.where("event = 'run_started'").count() == 1
    lost = {r["url"]: (r["status"], r["cause"]) for r in told.where("event LIKE '%_failed'").collect()}
    assert lost[HOST + "/d/missing.html"] == (None, "no response") and lost[HOST + "/files/gone.pdf"] == (None, "no response")
    assert lost[search("15376", *FEB, 1)] == (None, "no response") and len(lost) == 3


def test_failures_tell_status_and_cause(spark, tmp_path):
    zone, pages = str(tmp_path / "z"), site()
    refused = spark.createDataFrame(
        [(HOST + "/d/1.html", 503, None, NOW), (search("3", *FEB, 1), 404, b"none", NOW)], FETCHES
    )
    kept = as_table(spark, {u: b for u, b in pages.items() if u not in (HOST + "/d/1.html", search("3", *FEB, 1))})
    landing.run(spark, kept.unionByName(refused), zone, BASE, START, END, "r1", NOW, wanted="3,15376")
    events = tables.read_events(spark, zone).where("event LIKE '%_failed'").collect()
    lost = {(r["event"], r["identifier"] or r["body"]): (r["status"], r["cause"]) for r in events}
    assert lost[("download_failed", "ADJ 1")] == lost[("download_failed", "ADJ8")] == (503, "http 503")
    assert lost[("listing_failed", "Labour Court")] == (404, "http 404")


def test_a_finished_run_is_not_overwritten(spark, landed):
    zone, _ = landed
    with pytest.raises(ValueError, match="choose another run_id"):
        landing.run(spark, as_table(spark, site()), zone, BASE, START, END, "r1", NOW)


def test_refresh_rewrites_changed_bytes_only(spark, landed):
    zone, _ = landed
    changed = {**site(), HOST + "/d/3.pdf": b"%PDF\x00\x01three, amended"}
    old = by_id(cells.read(spark, zone, LANDING_METADATA))
    landing.run(
        spark, as_table(spark, changed), zone, BASE, START, END, "r3", NOW, wanted="3,15376", mode="refresh"
    )
    new = by_id(cells.read(spark, zone, LANDING_METADATA))
    assert set(new) == set(old)
    assert new["ADJ3"]["file_run"] == "r3" and new["ADJ3"]["file_hash"] != old["ADJ3"]["file_hash"]
    assert new["ADJ 1"]["file_run"] == old["ADJ 1"]["file_run"]
    written = tables.read_files(spark, zone).where("run_id = 'r3'").select("file_path").collect()
    assert [r["file_path"] for r in written] == ["labour-court/2024-01-01/ADJ3.pdf"]
    live = tables.live_files(tables.read_files(spark, zone), cells.read(spark, zone, LANDING_METADATA))
    assert live.count() == 5


def test_transform_run(spark, landed, tmp_path):
    zone, _ = landed
    clean = str(tmp_path / "clean")
    stats = transform.run(spark, zone, clean, START, END, "t1", NOW)
    # Without a file (ADJ6) or an identifier a record fails; the others are not held up.
    assert stats == {"read": 6, "transformed": 4, "failed": 2}
    metadata = cells.read(spark, clean, CLEAN_METADATA)
    rows = by_id(metadata)
    assert set(rows) == {"ADJ 1", "ADJ2", "ADJ3", "ADJ8"}
    assert rows["ADJ 1"]["file_path"] == "labour-court/2024-01-01/ADJ1.html"
    files = {r["file_path"]: r for r in tables.live_files(tables.read_files(spark, clean), metadata).collect()}
    page_bytes = bytes(files["labour-court/2024-01-01/ADJ1.html"]["content"])
    assert page_bytes == b'<div class="content"><p>one</p></div>'
    assert bytes(files["labour-court/2024-01-01/ADJ3.pdf"]["content"]).startswith(b"%PDF")
    again = transform.run(spark, zone, clean, START, END, "t2", NOW)
    assert again == stats
    assert cells.read(spark, clean, CLEAN_METADATA).count() == 4
    assert tables.live_files(tables.read_files(spark, clean), cells.read(spark, clean, CLEAN_METADATA)).count() == 4
    landed_files = tables.live_files(tables.read_files(spark, zone), cells.read(spark, zone, LANDING_METADATA))
    sizes = landed_files.select("identifier", "size")
    missing = cells.read(spark, zone, LANDING_METADATA).where("file_path IS NULL").selectExpr("identifier", "CAST(NULL AS BIGINT) AS size")
    cleaned = tables.live_files(tables.read_files(spark, clean), metadata).select("identifier", "size")
    parity = audit.zone_parity(sizes.unionByName(missing), cleaned).first()
    assert (parity["landing_files"], parity["clean_files"], parity["shrunk"]) == (5, 4, True)
    assert (parity["landing_records"], parity["clean_records"], parity["landing_only"]) == (6, 4, 2)


def test_transform_range_is_half_open(spark, landed, tmp_path):
    zone, _ = landed
    stats = transform.run(spark, zone, str(tmp_path / "c"), D(2024, 2, 1), D(2024, 3, 1), "t", NOW)
    assert stats["read"] == 1
    with pytest.raises(ValueError):
        transform.run(spark, zone, str(tmp_path / "c"), D(2024, 2, 1), D(2024, 2, 1), "t", NOW)


def test_both_stages(spark, tmp_path):
    where = str(tmp_path)
    stats = zones.run_zones(
        spark, as_table(spark, site()), f"{where}/l", f"{where}/c", BASE, "2024-01-01", "2024-02-01", "x", NOW
    )
    assert stats == {"read": 5, "transformed": 4, "failed": 1}
    views.register(spark, f"{where}/l", f"{where}/c")
    assert spark.sql("SELECT count(*) AS n FROM clean_metadata").first()["n"] == 4
    assert {r["zone"]: r["n"] for r in spark.sql("SELECT zone, count(*) AS n FROM files GROUP BY zone").collect()} == {
        "landing": 5, "clean": 4,
    }
    tables.export_feed(cells.read(spark, f"{where}/l", LANDING_METADATA), f"{where}/feed")
    lines = [json.loads(line) for name in os.listdir(f"{where}/feed") if name.endswith(".json")
             for line in open(f"{where}/feed/{name}")]
    assert len(lines) == 5 and all("content" not in line for line in lines)


def test_failing_landing_leaves_clean_untouched(spark, tmp_path):
    broken = as_table(spark, site()).drop("body")
    with pytest.raises(Exception):
        zones.run_zones(spark, broken, f"{tmp_path}/l", f"{tmp_path}/c", BASE, "2024-01-01", "2024-02-01", "x")
    assert not os.path.exists(f"{tmp_path}/c")


def test_an_unfinished_version_is_ignored(spark, tmp_path):
    zone = str(tmp_path / "z")
    row = dict.fromkeys(LANDING_METADATA.fieldNames()) | {"body_slug": "b", "n": 1, "has_content": False}

    def batch(*names):
        rows = [tuple((row | {"identifier": n}).values()) for n in names]
        return spark.createDataFrame(rows, T.StructType([*LANDING_METADATA.fields, T.StructField("n", T.IntegerType()), T.StructField("has_content", T.BooleanType())]))

    assert cells.upsert(spark, zone, LANDING_METADATA, batch("A"), ("n",)) == 1
    assert cells.upsert(spark, zone, LANDING_METADATA, batch("B"), ("n",)) == 2
    os.remove(f"{zone}/metadata/manifests/v=2/_SUCCESS")
    assert [r["identifier"] for r in cells.read(spark, zone, LANDING_METADATA).collect()] == ["A"]
    assert cells.upsert(spark, zone, LANDING_METADATA, batch("C"), ("n",)) == 2
    assert sorted(r["identifier"] for r in cells.read(spark, zone, LANDING_METADATA).collect()) == ["A", "C"]


def test_range_scan_prunes_partitions(spark, landed):
    zone, _ = landed
    scan = transform.select_range(cells.read(spark, zone, LANDING_METADATA), D(2024, 2, 1), D(2024, 3, 1))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "partition_date" in filters.split("PartitionFilters: [")[1].split("]")[0]


def test_bytes_are_cleaned_where_they_lie(spark, landed):
    zone, _ = landed
    metadata = cells.read(spark, zone, LANDING_METADATA)
    selected = transform.select_range(metadata, D(2024, 1, 1), D(2024, 2, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = transform.pointed(tables.read_files(spark, zone), selected)
        records = transform.clean_records(
            selected, transform.clean_contents(found), F.current_timestamp(), on={"file_run": "run_id", "file_row": "file_row"}
        )
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and "Exchange hashpartitioning(_pointer" in plan.split("BroadcastExchange")[1]
        filters = next(line for line in plan.splitlines() if "FileScan" in line and "content" in line)
        assert "partition_date" in filters.split("PartitionFilters: [")[1].split("]")[0]
        # With broadcasts off as well, what is exchanged never holds content.
        moved = exchanged(spark, records)
        assert moved and not any(columns & {"content", "_cleaned"} for columns in moved)
        assert records.where("error IS NULL").count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_from_a_directory_as_responses(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "one.html").write_bytes(page("one").encode())
    (tmp_path / "a" / "b" / "two.pdf").write_bytes(b"%PDF\x00")
    files = tables.read_directory(spark, str(tmp_path / "a"))
    assert sorted((r["file_path"].rsplit("/", 1)[1], r["size"]) for r in files.collect()) == [
        ("one.html", len(page("one"))), ("two.pdf", 5),
    ]
    name = F.concat(F.lit("https://h.example/"), F.substring_index("file_path", "/", -1))
    responses = as_fetches(files, name, F.col("content"))
    items = spark.createDataFrame([("https://h.example/two.pdf",)], "doc_url string")
    found = documents.resolve(items, responses).first()
    assert found["file_hash"] == hashlib.sha256(b"%PDF\x00").hexdigest() and found["status"] == "scraped"
    stored = str(tmp_path / "fetches")
    responses.write.parquet(stored)
    assert read_fetches(spark, stored).schema == FETCHES
