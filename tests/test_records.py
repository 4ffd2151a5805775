"""Keyed operators against straightforward loops, and the plans they run with."""

import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, documents, listing, reconcile, upsert
from tidemark.schemas import BODIES, FETCHES

D = datetime.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cards(spark):
    """1,200 records; a third share one key, a third have none."""
    rng = random.Random(5)
    rows = [
        (i, rng.choice(["hot", None, "", f"k{rng.randrange(40)}"]), rng.randrange(5), f"d{i}", rng.random() < 0.5, f"h{i % 7}")
        for i in range(1200)
    ]
    return spark.createDataFrame(
        rows, "n int, identifier string, page int, description string, has_content boolean, file_hash string"
    ).repartition(8)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_record_of_each_key_and_all_blank_ones(cards):
    got = rows_of(upsert.dedup_first(cards, ("page", "n")))
    seen, want = set(), []
    for row in sorted(cards.collect(), key=lambda r: (r["page"], r["n"])):
        if not row["identifier"] or row["identifier"] not in seen:
            want.append(tuple(row))
            seen.add(row["identifier"])
    assert got == sorted(want, key=repr)


def test_dedup_reads_once_and_cuts_keys_before_the_shuffle(spark, cards, tmp_path):
    cards.write.parquet(f"{tmp_path}/cards")
    plan = plan_of(upsert.dedup_first(spark.read.parquet(f"{tmp_path}/cards"), ("page", "n")))
    assert plan.count("FileScan") == 1
    shuffle = plan.index("Exchange hashpartitioning(identifier")
    assert "partial_min_by" in plan[shuffle:] and "partial_min_by" not in plan[:shuffle]


def test_composite_key(spark):
    rows = [("a", "x", 1), ("b", "x", 2), ("a", "x", 3), ("a", None, 4), ("a", "", 5), (None, "x", 6)]
    frame = spark.createDataFrame(rows, "body string, identifier string, n int")
    kept = upsert.dedup_first(frame, ("n",), key=("body", "identifier"))
    assert sorted(r["n"] for r in kept.collect()) == [1, 2, 4, 5, 6]


def test_stored_records_are_skipped_blank_ones_never(spark, cards):
    stored = spark.createDataFrame([("hot",), ("k1",), ("",), (None,)], "identifier string")
    new, skipped = upsert.split_stored(cards, stored)
    assert {r["identifier"] for r in skipped.collect()} == {"hot", "k1"}
    assert new.count() + skipped.count() == cards.count()
    marked = {r["identifier"]: r["already_stored"] for r in upsert.mark_stored(cards, stored).collect()}
    assert marked["hot"] and marked["k1"] and not marked[""] and not marked[None] and not marked["k2"]
    assert upsert.mark_stored(cards, stored).count() == cards.count()


def fold(stored, batch):
    """update-or-insert per key, one row after the other; absent fields keep their value."""
    table = {r["identifier"]: r for r in stored}
    for row in batch:
        old = table.get(row["identifier"], {"file_hash": None})
        fields = {k: row[k] for k in ("identifier", "description")}
        fields["file_hash"] = row["file_hash"] if row["has_content"] else old["file_hash"]
        table[row["identifier"]] = fields
    return table


def test_merge_equals_one_update_after_the_other(spark, cards):
    stored_rows = [
        {"identifier": k, "description": f"old {k}", "file_hash": h}
        for k, h in [("hot", "h"), ("k1", None), ("gone", "g"), (None, "n"), ("k2", "z")]
    ]
    stored = spark.createDataFrame(
        [tuple(r.values()) for r in stored_rows], "identifier string, description string, file_hash string"
    )
    merged = upsert.merge_set(stored, cards, ("page", "n"), sticky=("file_hash",))
    batch = sorted((r.asDict() for r in cards.collect()), key=lambda r: (r["page"], r["n"]))
    want = fold(stored_rows, batch)
    assert {r["identifier"]: r.asDict() for r in merged.collect()} == want
    assert merged.count() == len(want)


@pytest.fixture(scope="module")
def store(spark, cards, tmp_path_factory):
    """A store on disk that is far larger than a small batch."""
    path = str(tmp_path_factory.mktemp("store"))
    names = F.concat(F.lit("k"), F.col("id"))
    spark.range(2_000_000).select(
        names.alias("identifier"), names.alias("description"), F.sha2(names, 256).alias("file_hash"),
        F.concat(names, F.lit(".html")).alias("file_path"),
    ).write.parquet(path + "/big")
    cards.withColumn("file_path", F.lit("p")).write.parquet(path + "/small")
    return spark.read.parquet(path + "/big"), spark.read.parquet(path + "/small")


def test_every_input_is_read_once(spark, store):
    big, small = store
    results = (
        upsert.merge_set(big, small, ("page", "n"), sticky=("file_hash",)),
        upsert.mark_stored(small, big),
        upsert.classify_changes(small, big),
    )
    for limit in (None, "-1"):
        if limit:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            for result in results:
                plan = plan_of(result)
                assert plan.count("FileScan") == 2, plan
            merged = results[0]
            assert plan_of(merged).count("Exchange") == 1 and "partial_max_by" in plan_of(merged)
            assert merged.count() == 2_000_000 + 3
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_blank_records_that_are_equal_all_stay(spark):
    rows = [(None, 1, "x"), (None, 1, "x"), ("", 1, "x"), ("", 1, "x"), ("a", 1, "x"), ("a", 1, "x")]
    frame = spark.createDataFrame(rows, "identifier string, n int, d string").repartition(3)
    assert upsert.dedup_first(frame, ("n",)).count() == 5


def test_present_null_overwrites(spark):
    stored = spark.createDataFrame([("a", "text", "h")], "identifier string, description string, file_hash string")
    batch = spark.createDataFrame(
        [("a", None, None, 1, False)],
        "identifier string, description string, file_hash string, n int, has_content boolean",
    )
    row = upsert.merge_set(stored, batch, ("n",), sticky=("file_hash",)).first()
    assert (row["description"], row["file_hash"]) == (None, "h")


def test_changes(spark):
    schema = "identifier string, file_hash string, file_path string"
    stored = spark.createDataFrame([("a", "1", "p/a"), ("b", "1", "p/b"), ("c", "1", "p/c"), (None, "1", "p/n")], schema)
    new = spark.createDataFrame(
        [("a", "1", "p/a"), ("b", "2", "p/b"), ("c", "1", "q/c"), ("d", "1", "p/d"), (None, "1", "p/n"), ("e", None, None)],
        schema,
    )
    got = {r["identifier"]: (r["change"], r["write_file"]) for r in upsert.classify_changes(new, stored).collect()}
    # Equal bytes under another path are written, or the path would point nowhere.
    assert got == {
        "a": ("unchanged", False), "b": ("changed", True), "c": ("unchanged", True),
        "d": ("new", True), None: ("unchanged", False), "e": ("new", False),
    }


def accounts(spark):
    cells = [(D(2024, m, 1), b) for m in (1, 2) for b in ("A", "B")]
    grid = spark.createDataFrame(cells, "partition_date date, body string")
    found = spark.createDataFrame(
        [(D(2024, 1, 1), "A", 5), (D(2024, 2, 1), "A", 1), (D(2024, 1, 1), "B", None)],
        "partition_date date, body string, found bigint",
    )
    outcomes = [(D(2024, 1, 1), "A", s) for s in ("scraped", "failed", "skipped")]
    outcomes += [(D(2024, 2, 1), "A", "scraped")] * 3
    frame = spark.createDataFrame(outcomes, "partition_date date, body string, status string")
    return reconcile.by_partition(grid, found, reconcile.count_outcomes(frame))


def test_accounting(spark):
    got = {(r["partition_date"].month, r["body"]): r for r in accounts(spark).collect()}
    counters = ("found", "scraped", "failed", "skipped", "missing", "listing_missing")
    assert [got[1, "A"][c] for c in counters] == [5, 1, 1, 1, 2, False]
    assert [got[2, "A"][c] for c in counters] == [1, 3, 0, 0, 0, False]
    assert [got[1, "B"][c] for c in counters] == [0, 0, 0, 0, 0, False]
    assert [got[2, "B"][c] for c in counters] == [0, 0, 0, 0, 0, True]
    assert reconcile.unaccounted(accounts(spark)).count() == 1


def test_run_missing_is_not_the_sum(spark):
    totals = {(r["level"], r["body"]): r["missing"] for r in reconcile.rollup(accounts(spark)).collect()}
    assert totals == {("group", "A"): 0, ("group", "B"): 0, ("run", None): 0}


def test_bodies(spark):
    dimension = listing.bodies(spark)
    chosen = listing.select_bodies(dimension, "15376, 3,99").orderBy("body_order").collect()
    assert [r["body_id"] for r in chosen] == ["3", "15376"]
    for everything in (None, ""):
        rows = listing.select_bodies(dimension, everything).orderBy("body_order").collect()
        assert [r["body"] for r in rows] == list(BODIES.values())


def test_grid_is_bodies_by_windows(spark):
    grid = listing.plan_grid(listing.bodies(spark), D(2024, 1, 1), D(2024, 4, 1))
    assert grid.count() == 12
    assert "CartesianProduct" not in plan_of(grid) and "NestedLoop" not in plan_of(grid)


def test_pages(spark):
    rows = [("a", 0, 0), ("b", None, 3), ("c", 10, 10), ("d", 11, 10), ("e", 25, 0), ("f", 233, 7), ("g", 100000, 10)]
    frame = spark.createDataFrame(rows, "k string, total bigint, cards int")
    got = {}
    for r in listing.plan_pages(frame).collect():
        got.setdefault(r["k"], []).append(r["page"])
    want = {"a": 1, "b": 1, "c": 1, "d": 2, "e": 3, "f": 34, "g": 10000}
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(1, n + 1)) for k, n in want.items()}


def fetches(spark, rows):
    return spark.createDataFrame([(u, s, b, t) for u, s, b, t in rows], FETCHES)


T1, T2 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)


def test_newest_response_decides(spark):
    items = spark.createDataFrame(
        [(1, "u1", "pdf"), (2, "u2", "pdf"), (3, "u3", "pdf"), (4, None, None), (5, "u5", "pdf"), (6, "u6", "pdf")],
        "n int, doc_url string, doc_type string",
    )
    stored = fetches(spark, [
        ("u1", 200, b"old", T1), ("u1", 200, b"new", T2), ("u2", 200, b"ok", T1), ("u2", 500, b"no", T2),
        ("u5", 200, b"", None), ("u6", 304, b"x", T1), ("other", 200, b"x", T1), ("u1", 200, b"mew", T2),
    ])
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    got = {r["n"]: (r["status"], r["file_hash"], r["http_status"]) for r in documents.resolve(items, stored).collect()}
    assert got == {
        1: ("scraped", sha(b"new"), 200), 2: ("failed", None, 500), 3: ("failed", None, None), 4: ("scraped", None, None),
        5: ("scraped", sha(b""), 200), 6: ("failed", None, 304),
    }


def test_records_may_share_a_url(spark):
    items = spark.createDataFrame([(1, "u"), (2, "u"), (3, None), (4, "gone"), (5, "gone")], "n int, doc_url string")
    got = documents.resolve(items, fetches(spark, [("u", 200, b"x", T1)])).collect()
    assert sorted((r["n"], r["status"], r["size"] is not None) for r in got) == [
        (1, "scraped", True), (2, "scraped", True), (3, "scraped", False), (4, "failed", False), (5, "failed", False),
    ]


def test_attachments_are_followed(spark):
    shell = b'<div class="related-file"><a class="download" href="/f.pdf">x</a></div>'
    own = b'<div class="related-file"><a class="download" href="/own.doc">x</a></div>'
    direct = b'<div class="related-file"><a class="download" href="/d.pdf">x</a></div>'
    items = spark.createDataFrame(
        [(1, "http://h/1", "html"), (2, "http://h/2", "html"), (3, "http://h/3", "html"), (4, "http://h/d.pdf", "pdf"),
         (5, "http://h/5", "html"), (6, "http://h/6", "html")],
        "n int, doc_url string, doc_type string",
    )
    stored = fetches(spark, [
        ("http://h/1", 200, shell, T1), ("http://h/2", 200, shell, T1), ("http://h/3", 200, direct, T1),
        ("http://h/d.pdf", 200, b"pdf", T1), ("http://h/5", 200, own, T1), ("http://h/6", 200, b"\x00\x01", T1),
        ("http://h/f.pdf", 200, b"f", T1),
    ])
    marked = documents.resolve(items, stored).cache()
    assert {r["n"]: r["status"] for r in marked.collect()} == {
        1: "rerouted", 2: "rerouted", 3: "rerouted", 4: "scraped", 5: "rerouted", 6: "scraped",
    }
    got = documents.follow_attachment(marked, stored).collect()
    assert {r["n"]: (r["doc_url"], r["doc_type"], r["status"]) for r in got} == {
        1: ("http://h/f.pdf", "pdf", "scraped"), 2: ("http://h/f.pdf", "pdf", "scraped"),
        3: ("http://h/d.pdf", "pdf", "scraped"), 5: ("http://h/own.doc", "doc", "failed"),
    }


def test_audits(spark):
    rows = [
        ("ADJ 1", "Body A", D(2024, 1, 1), "html", "http://x/1"), ("ADJ1", "Body A", D(2024, 1, 1), "html", "http://x/2"),
        ("ADJ1", "Body A", D(2024, 2, 1), "html", "/x/3"), (None, "Body A", D(2024, 3, 1), "html", None),
    ]
    frame = spark.createDataFrame(
        rows, "identifier string, body string, partition_date date, doc_type string, doc_url string"
    )
    assert audit.identifiers(frame).first().asDict() == {
        "records": 4, "null_identifiers": 1, "repeated_identifiers": 1,
    }
    assert [tuple(r) for r in audit.duplicates(frame).collect()] == [("ADJ1", 2)]
    assert [tuple(r) for r in audit.key_collisions(frame).collect()] == [("body-a/2024-01-01/ADJ1.html", 2)]
    assert audit.links(frame, [D(2024, 1, 1), D(2024, 2, 1)]).first().asDict() == {
        "records": 4, "relative_links": 1, "missing_links": 1, "bad_partitions": 1,
    }
    sized = frame.withColumn("size", F.when(F.col("identifier").isNotNull(), 10))
    fewer = sized.where("identifier = 'ADJ1'").withColumn("size", F.lit(4))
    different = audit.zone_parity(sized, fewer).first()
    assert [different[c] for c in ("landing_records", "clean_records", "landing_only", "clean_only")] == [4, 2, 2, 0]
    assert [different[c] for c in ("landing_files", "clean_files", "landing_bytes", "clean_bytes")] == [3, 2, 30, 8]
    assert not different["parity"] and different["shrunk"]
    assert audit.zone_parity(sized, sized).first()["parity"]


def test_blank_keys_do_not_share_a_join_task(spark, cards):
    stored = cards.select("identifier")
    _, skipped = upsert.split_stored(cards, stored)
    assert skipped.where("coalesce(identifier, '') = ''").count() == 0
    salted, salts = upsert._salted(cards, ("identifier",))
    assert salted.where("identifier IS NULL").select("_salt").distinct().count() == salts
    assert salted.where("identifier = 'hot'").select("_salt").distinct().count() == 1
    new = cards.select("identifier", "file_hash", F.concat("identifier", F.lit(".html")).alias("file_path"))
    kept = upsert.classify_changes(new, new.dropDuplicates(["identifier"]))
    assert kept.count() == cards.count()
    assert kept.where("change = 'new'").count() == 0


def test_a_hot_document_is_joined_once(spark, tmp_path):
    url = F.concat(F.lit("u"), F.col("id"))
    spark.range(200_000).select(
        url.alias("url"), F.lit(200).alias("status"), F.sha2(url, 512).cast("binary").alias("body"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    ).write.parquet(f"{tmp_path}/big")
    stored = spark.read.schema(FETCHES).parquet(f"{tmp_path}/big")
    rows = [(i, f"u{i * 7}") for i in range(50)] + [(100 + i, "u3") for i in range(1000)] + [(99, None), (98, "no")]
    items = spark.createDataFrame(rows, "n int, doc_url string")
    located = documents.locate(items, stored)
    located.write.parquet(f"{tmp_path}/located")
    located = spark.read.parquet(f"{tmp_path}/located")
    documents.responses(located).write.parquet(f"{tmp_path}/responses")
    held = documents.contents(spark.read.parquet(f"{tmp_path}/responses"), stored)
    plan = plan_of(held)
    assert "SortMergeJoin" not in plan
    # Only responses stored twice for one moment (none here) would be brought together.
    assert plan.count("Exchange hashpartitioning") == 1
    assert held.count() == 51
    found = documents.outcomes(located, documents.examine(held))
    assert sorted((r["n"], r["status"]) for r in found.collect()) == sorted(
        [(n, "scraped") for n, u in rows if n != 98] + [(98, "failed")]
    )


def test_records_of_a_hot_document_take_no_shuffle(spark, monkeypatch):
    """What is known of a URL of very many records goes to them; those of other URLs, without one or without a response, stay whole."""
    monkeypatch.setattr(documents, "CROWD", 500)
    rows = [(f"u{i}", 503 if i == 1 else 200, f"b{i}".encode(), None) for i in range(40)]
    stored = spark.createDataFrame(rows, FETCHES)
    hot = spark.range(30_000).select(F.element_at(F.array(*map(F.lit, ("u0", "u1", "no"))), (F.col("id") % 3 + 1).cast("int")).alias("doc_url"))
    items = hot.unionByName(spark.createDataFrame([(f"u{i}",) for i in range(2, 60)] * 3 + [(None,)] * 700, "doc_url string"))
    want = {("u0", "scraped"): 10_000, ("u1", "failed"): 10_000, ("no", "failed"): 10_000, (None, "scraped"): 700}
    want |= {(f"u{i}", "scraped" if i < 40 else "failed"): 3 for i in range(2, 60)}
    located = documents.locate(items, stored)
    one_by_one = documents.outcomes(located, documents.examine(documents.contents(documents.responses(located), stored)))
    for found in (documents.resolve(items, stored), one_by_one):
        assert {(r["doc_url"], r["status"]): r["count"] for r in found.groupBy("doc_url", "status").count().collect()} == want
    assert documents.requested(items, stored).where("doc_url = 'u0'").first()["records"] == 10_000
    # Rows that a shuffle deals out by URL: those of the hot ones are not among them.
    told = documents.to_records(items.where("doc_url IS NOT NULL"), documents.latest_fetches(stored, items.select("doc_url")), ["doc_url"])
    plan = plan_of(told)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and told.count() == 30_174
