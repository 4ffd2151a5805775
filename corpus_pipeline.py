"""From raw documents to packed sequences: five stages, each an operator over all that the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns documents with the columns of documents, the last the packed pieces.
Tables that a stage needs besides, such as labels, are read from sf_dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import automata, minhash, packing, quality_rules, voting
from tidemark.llm.staging import written

#: Two shingle sets at this similarity are near copies; bands and rows that miss one in a million there.
NEAR, NEAR_BANDS, NEAR_ROWS = (80, 100), 60, 7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled ones vote for."""
    return voting.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the surface rules and whose words are likely enough under the trusted ones."""
    return quality_rules.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id, of several such that whose text has the least hash.

    Rows are told apart by doc_id and text; of equal ones one stays. Rows without doc_id or words are nobody's copies.
    """
    found = minhash.marked(docs, similarity=NEAR, bands=NEAR_BANDS, rows=NEAR_ROWS).where("component IS NOT NULL")
    found = written(found.groupBy("component", "doc_id", "mark").agg(F.count("*").alias("n")), "near-copies")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    judged = found.join(first, "component").withColumn("stays", F.struct("doc_id", "mark") == F.col("first"))
    dropped = judged.where("NOT stays").select("doc_id", "mark")
    again = judged.where("stays AND n > 1").select("doc_id", "mark")
    # Packed away, the columns of docs keep out of the way of names used here.
    rows = docs.select("doc_id", minhash.mark().alias("mark"), F.struct("*").alias("row"))
    left = rows.join(dropped, ["doc_id", "mark"], "left_anti")
    once = left.join(again, ["doc_id", "mark"], "left_semi").groupBy("doc_id", "mark").agg(F.first("row").alias("row"))
    return left.join(again, ["doc_id", "mark"], "left_anti").unionByName(once).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows; what is left of such a text has one space between words."""
    kept = automata.remove_repeats(docs, output="kept")
    place = {"doc_id": "doc_id", "text": "kept AS text"}
    return kept.selectExpr(*(place.get(c, f"others.`{c}` AS `{c}`") for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules_stage),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: Votes, hashes and token ids are not for SQL; tests compare the operators, and the stage of near copies, with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
