"""A shared folder for what is worked out once and read more often."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name for intermediate tables, in the checkpoint folder that the cluster shares.

    That is ``spark.checkpoint.dir``, or what was set as checkpoint folder of the context. Where
    neither is set and Spark runs on this machine only, a new folder is made and set.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    known = context._jsc.sc().getCheckpointDir()
    if not shared and known.isDefined():
        shared = known.get()
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The same rows, written to a folder and read back: what uses them repeats none of the work."""
    folder = folder or scratch_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
