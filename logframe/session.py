"""Session settings the package expects; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "logframe", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    ``master`` and ``conf`` are for tests and benchmarks; on a cluster leave
    them out so that the submit-time configuration decides executors, memory
    and the number of shuffle partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
