"""Cutting lineage at a table that survives the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir.

    Where none is named, a local session gets a temporary one; a cluster job
    must name a shared folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="glossmill-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of the session."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


# Shuffle files of a statement go when it ends, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as compressed Parquet in that folder, read again; its shuffle files go."""
    spark = df.sparkSession
    path = f"{_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
