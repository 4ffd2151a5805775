"""Reliable intermediate results, for rows that several parts of a query need."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (`spark.checkpoint.dir`).

    Only a local session, whose executors are this machine, gets a folder of our own where it names none; on a cluster
    that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def staged(rows: DataFrame) -> DataFrame:
    """Checkpoint rows in the shared folder, so that they survive the loss of executors."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()
