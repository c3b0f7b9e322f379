"""Helpers that several operators use: normalising text, and folders all executors share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logframe.sources.folders import new_folder, shared_folder

# The characters between words, inside a character class.
WHITE = r"\x20\x09-\x0D"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


# Whether Spark removes a query's shuffle files when it ends, not when the driver's JVM collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries that are built and run inside leave no shuffle files.

    For results that are kept elsewhere: a frame that is run twice inside would shuffle twice.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows computed once and kept in the checkpoint folder, without their lineage."""
    shared_folder(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows kept as compressed Parquet in the checkpoint folder, for those with texts in them."""
    folder = new_folder(df.sparkSession, name)
    with tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the frame has a column called so."""
    taken = {name.lower() for name in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free
