"""Intermediate tables of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Remove the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of the rows that a Python task is handed at once; the executor holds them, and what comes back, beside its heap.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in a local session that sets none, as in tests, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = current.get() if current.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="stages-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """df as a table of the shared folder: lineage ends here, and a lost executor costs no earlier stage.

    `batch_bytes` bounds the batches of its Python steps, which must not depend on how rows are dealt to them.

    The shuffle files it took are removed once the table is there, not when the driver next collects garbage. The table's files are
    those of one run and go with the checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    settings = {_CLEANUP: "true"} | ({_BATCH: str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return spark.read.schema(df.schema).parquet(path)
