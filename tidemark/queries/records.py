"""Keyed operators and scalar functions over documents, orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keys
from tidemark.functions.text import WHITESPACE, strip
from tidemark.operators import audit, upsert
from tidemark.queries.registry import load, query

_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


@query(
    f"""
    WITH s AS (SELECT doc_id, trim(text, {_BLANKS}) AS body FROM documents)
    SELECT doc_id, sha256(body) AS stripped_hash, length(body) AS n FROM s
    """
)
def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts wrapped in white space of several scripts, and stripped again."""
    wrapped = F.concat(F.lit(" \t \xa0\r\n"), "text", F.lit(" 　\x1f\n\x85 "))
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        F.sha2(strip(wrapped), 256).alias("stripped_hash"),
        F.length(strip(wrapped)).cast("bigint").alias("n"),
    )


@query("SELECT doc_id, sha256(text) AS file_hash FROM documents")
def file_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", keys.file_hash("text").alias("file_hash"))


def _identified(orders: DataFrame) -> DataFrame:
    """Orders as cards: the customer is the identifier, absent for two priorities."""
    return orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("published_on"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("identifier"),
    )


_IDENTIFIED = """WITH c AS (
    SELECT o_orderkey, o_orderdate::date AS published_on, CASE o_orderpriority WHEN '5-LOW' THEN NULL
        WHEN '4-NOT SPECIFIED' THEN '' ELSE o_custkey::varchar END AS identifier FROM orders
)"""


@query(
    _IDENTIFIED
    + """, s AS (SELECT DISTINCT identifier FROM c WHERE published_on < DATE '1996-01-01' AND identifier <> '')
    SELECT o_orderkey, identifier, s.identifier IS NOT NULL AS already_stored
    FROM c LEFT JOIN s USING (identifier) WHERE published_on >= DATE '1996-01-01'"""
)
def skip_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stored in the first year against all later orders."""
    cards = _identified(load(spark, sf_dir, "orders"))
    cut = F.lit("1996-01-01").cast("date")
    return upsert.mark_stored(
        cards.where(F.col("published_on") >= cut), cards.where(F.col("published_on") < cut)
    ).drop("published_on")


@query(
    _IDENTIFIED
    + """, f AS (
        SELECT identifier FROM c WHERE identifier <> '' GROUP BY identifier
        UNION ALL SELECT identifier FROM c WHERE coalesce(identifier, '') = ''
    ), s1 AS (SELECT DISTINCT identifier FROM f),
    again AS (SELECT f.identifier FROM f WHERE coalesce(identifier, '') = '' OR identifier NOT IN
        (SELECT identifier FROM s1 WHERE identifier IS NOT NULL)),
    s2 AS (SELECT identifier FROM s1 UNION SELECT identifier FROM again)
    SELECT (SELECT count(*) FROM s1) AS stored_first, (SELECT count(*) FROM again) AS scraped_again,
        (SELECT count(*) FROM s2) AS stored_again"""
)
def rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over the same cards: only those without a key are taken again."""
    cards = _identified(load(spark, sf_dir, "orders")).withColumn("has_content", F.lit(False))
    order = ("published_on", "o_orderkey")
    firsts = upsert.dedup_first(cards, order)

    def merged(stored: DataFrame, new: DataFrame) -> DataFrame:
        return upsert.merge_set(stored, new, order, sticky=("published_on",))

    first = merged(cards.drop("has_content").where(F.lit(False)), firsts)
    again, _ = upsert.split_stored(firsts, first)
    counts = ((first, "stored_first"), (again, "scraped_again"), (merged(first, again), "stored_again"))
    told = [rows.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n") for rows, what in counts]
    return (
        told[0].unionByName(told[1]).unionByName(told[2])
        .agg(*(F.max(F.when(F.col("what") == w, F.col("n"))).alias(w) for _, w in counts))
    )


@query(
    """
    WITH n AS (
        SELECT doc_id::varchar AS identifier, sha256(text) AS file_hash, source || '/' || doc_id || '.html' AS file_path
        FROM documents
    ), s AS (
        SELECT l.doc_id::varchar AS identifier,
            CASE toxic WHEN 1 THEN sha256(text || ' (first version)') ELSE sha256(text) END AS file_hash,
            CASE quality WHEN 1 THEN source ELSE 'old' END || '/' || l.doc_id || '.html' AS file_path
        FROM labels l JOIN documents USING (doc_id)
    )
    SELECT n.identifier, n.file_hash, CASE WHEN s.identifier IS NULL THEN 'new'
        WHEN s.file_hash = n.file_hash THEN 'unchanged' ELSE 'changed' END AS change,
        s.identifier IS NULL OR s.file_hash <> n.file_hash OR s.file_path <> n.file_path AS write_file
    FROM n LEFT JOIN s USING (identifier)
    """
)
def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against an earlier store of the labelled ones.

    The toxic ones were stored with another text, the low-quality ones elsewhere.
    """
    documents = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = load(spark, sf_dir, "labels")

    def path(folder) -> F.Column:
        return F.concat(folder, F.lit("/"), F.col("doc_id"), F.lit(".html")).alias("file_path")

    identifier = F.col("doc_id").cast("string").alias("identifier")
    new = documents.select(identifier, keys.file_hash("text").alias("file_hash"), path(F.col("source")))
    old_text = F.when(F.col("toxic") == 1, F.concat("text", F.lit(" (first version)"))).otherwise(F.col("text"))
    old_folder = F.when(F.col("quality") == 1, F.col("source")).otherwise("old")
    stored = documents.join(labels, "doc_id").select(
        identifier, keys.file_hash(old_text).alias("file_hash"), path(old_folder)
    )
    return upsert.classify_changes(new, stored).drop("file_path")


_LINE_ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
_LINE_SORT = ", ".join(_LINE_ORDER)


@query(
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_SORT}) = 1"""
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE_ORDER, "l_quantity", "l_returnflag")
    return upsert.dedup_first(lines, _LINE_ORDER, key=("l_orderkey",)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )


@query(
    f"""
    WITH stored AS (
        SELECT *, l_returnflag <> 'N' AS has_content FROM lineitem WHERE l_shipdate < DATE '1998-01-01'
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_SORT}) = 1
    ), rows AS (
        SELECT *, 0 AS generation FROM stored UNION ALL
        SELECT *, l_returnflag <> 'N', 1 FROM lineitem WHERE l_shipdate >= DATE '1998-01-01'
    ), card AS (
        SELECT l_orderkey, l_partkey, l_linenumber FROM rows
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY generation DESC,
            l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
    ), file AS (
        SELECT l_orderkey, l_suppkey AS file_supplier, l_quantity AS file_quantity FROM rows WHERE has_content
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY generation DESC,
            l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
    )
    SELECT * FROM card LEFT JOIN file USING (l_orderkey)
    """
)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of later years merged, per order, into the first line of earlier ones."""
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", *_LINE_ORDER, (F.col("l_returnflag") != "N").alias("has_content"),
        F.col("l_suppkey").alias("file_supplier"), F.col("l_quantity").alias("file_quantity"),
    )
    cut = F.lit("1998-01-01").cast("date")
    has_content = F.col("has_content")
    stored = upsert.dedup_first(
        lines.where(F.col("l_shipdate") < cut), _LINE_ORDER, key=("l_orderkey",)
    ).select(
        "l_orderkey", "l_partkey", "l_linenumber",
        *(F.when(has_content, F.col(c)).alias(c) for c in ("file_supplier", "file_quantity")),
    )
    return upsert.merge_set(
        stored, lines.where(F.col("l_shipdate") >= cut), _LINE_ORDER,
        key=("l_orderkey",), sticky=("file_supplier", "file_quantity"),
    )


@query(
    """
    WITH k AS (SELECT CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_custkey END AS k, count(*) AS n
        FROM orders GROUP BY 1)
    SELECT sum(n)::bigint AS records, coalesce(sum(n) FILTER (WHERE k IS NULL), 0)::bigint AS null_identifiers,
        count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS repeated_identifiers FROM k
    """
)
def audit_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    identifier = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    return audit.identifiers(load(spark, sf_dir, "orders").select(identifier.alias("identifier")))


@query(
    """SELECT l_orderkey::varchar AS identifier, count(*) AS records FROM lineitem
       GROUP BY l_orderkey HAVING count(*) > 1"""
)
def audit_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    return audit.duplicates(lines.select(F.col("l_orderkey").cast("string").alias("identifier")))
