"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``: a part of it that is this application's own.

    Where none is named, a temporary one is set if all runs on one machine, as
    in tests; on a cluster that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="spark-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there; its lineage ends."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the checkpoint folder, and read from there: smaller than a checkpoint, and read by column."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder of tables that nobody reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
