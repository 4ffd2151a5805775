"""The stages one after another over the given tables, and the SQL of the operators that have one."""

import glob
import os
import tracemalloc

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import voting
from tidemark.llm.queries import QUERIES, SQL
from tidemark.llm.staging import written
from tidemark.llm.words import split_words


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "quality_rules", "near_duplicates", "repeated_passages", "packing"]
    rows = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        rows.append(docs.count())
    assert rows[0] > rows[1] > rows[2] > rows[3] == rows[4]
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == rows[4]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    result, want = QUERIES[name](spark, sf_dir), connection.execute(SQL[name])
    order = [c[0] for c in want.description]
    assert sorted(order) == sorted(result.columns)
    assert sorted(map(tuple, result.select(*order).collect())) == sorted(want.fetchall())


def test_near_duplicates_keep_one_row_of_each_group(spark, sf_dir):
    """Rows are judged one by one, also where they share a doc_id or repeat."""
    say = lambda name: " ".join(f"{name}{k}" for k in range(60))
    a, b, c, d = map(say, "abcd")
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (3, c), (3, c + " more"), (4, d), (None, a), (None, a), (5, ""), (6, None)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, mark int").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert got.columns == docs.columns
    kept = sorted((r["doc_id"], r["text"]) for r in got.where("doc_id < 5").collect())
    assert [x for x in kept if x[0] != 3] == [(1, a), (2, b), (4, d)]
    assert len([x for x in kept if x[0] == 3]) == 1
    assert got.where("doc_id IS NULL").count() == 2 and got.where("doc_id > 4").count() == 2


def test_shapes_take_memory_by_the_block():
    """What a task holds for the shapes of its words does not grow with the text it is handed."""
    words = split_words(pa.array([f"Word{k} of-the 12,{k}" for k in range(2000)] + ["", None, "a"]))
    whole = voting.shape_hashes(words, len(words.start))
    assert (voting.shape_hashes(words, 7) == whole).all() and (voting.shape_hashes(words) == whole).all()
    assert len(voting.shape_hashes(split_words(pa.array(["", None])))) == 0
    long = split_words(pa.array(["some Words and 12 numbers " * 80_000]))
    tracemalloc.start()
    voting.shape_hashes(long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6


def test_written_hands_python_bounded_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows])})

    texts = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 1000) AS text")
    rows = written(texts.mapInArrow(sizes, "n long"), "sizes", 100_000).collect()
    assert sum(r["n"] for r in rows) == 2000 and max(r["n"] for r in rows) <= 200
    assert spark.conf.get(key) == before
