"""The folder that the driver and all executors share, and lineage cut in it."""

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its rows, partitions and their order fixed: a reliable checkpoint in spark.checkpoint.dir.

    Only where that is unset and all runs in one process (local tests) a temporary folder takes its place.
    """
    context_dir(df.sparkSession)
    return df.checkpoint()


def context_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    have = context.getCheckpointDir()
    if have:
        return have
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = f"file://{tempfile.gettempdir()}/vistaloom-{os.getpid()}"
    context.setCheckpointDir(top)
    return context.getCheckpointDir()
