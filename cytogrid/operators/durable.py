"""Cutting lineage in iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once: written as Parquet into the cluster's shared checkpoint folder and read again.

    The folder is the session's spark.checkpoint.dir; where that is unset, a temporary one in local mode and an error elsewhere. A plan read from files
    starts afresh: a checkpoint() would carry the old plan's constraints along, which loops with many renamed columns multiply.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.getCheckpointDir():
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cytogrid-"))
        folder = spark.sparkContext.getCheckpointDir()
    path = f"{folder.rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
