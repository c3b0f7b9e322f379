"""New folders that every executor can reach, for tables that a query derives on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in local mode a temporary one where that is unset, elsewhere an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="logframe-checkpoints-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address below the shared one; its caller removes it."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
