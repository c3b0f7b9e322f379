"""Tables laid out for the questions asked of them: JSON in typed columns, logs by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.fields import field, field_type
from logframe.functions.guards import bucket_grid
from logframe.functions.predicates import Condition, matching
from logframe.functions.times import (
    bucket_start,
    epoch_seconds,
    from_epoch_seconds,
    parse_interval,
    time_column,
    utc_day,
)
from logframe.operators.anomaly import Z_LIMIT, spikes

# Buckets that may be sent to every task.
SENT_BUCKETS = 100_000


def shredded(df: DataFrame, json_fields: list[str]) -> DataFrame:
    """JSON text columns as variants; text that is no JSON stays, as a variant that is a string.

    Nothing is lost but white space, the order of members and the spelling of
    numbers. Of members that repeat in one object Spark reads none: such text
    stays a string as well.
    """
    for name in json_fields:
        if not isinstance(field_type(df, name), T.StringType):
            raise ValueError(f"{name!r} holds no text")
    opened = {
        name: F.coalesce(F.try_parse_json(F.col(f"`{name}`")), F.col(f"`{name}`").cast("variant"))
        for name in json_fields
    }
    return df.withColumns(opened)


def write_shredded(df: DataFrame, path: str, json_fields: list[str]) -> DataFrame:
    """The table as Parquet at ``path``, frequent members of JSON columns in typed columns of their own; read back.

    Every writing task infers from its own rows which members are stored
    apart (``spark.sql.variant.inferShreddingSchema``); rare ones and values of
    another type stay in the variant's binary rest, so nothing depends on the
    choice but speed. :func:`json_field` of a member then reads its column
    alone, and a range on it reaches the scan.
    """
    shredded(df, json_fields).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def member_types(df: DataFrame, path: str) -> DataFrame:
    """One row: the merged type of all values of a variant column, from one pass with partial aggregation."""
    return df.agg(F.schema_of_variant_agg(field(df, path)).alias("type"))


def write_daily(
    df: DataFrame, path: str, ts_field: str = "@timestamp", day_column: str = "day", parts: int = 1
) -> DataFrame:
    """The table as Parquet at ``path`` with a partition for each UTC day, rows in order of time; read back.

    A day is written by ``parts`` tasks, so a day with most of the rows need
    not be one task's. Rows without a time are in a partition of their own.
    """
    if day_column in df.columns:
        raise ValueError(f"the table has a column {day_column!r} already")
    if parts < 1:
        raise ValueError(f"parts must be at least 1, got {parts}")
    column, dtype = time_column(df, ts_field)
    days = df.withColumn(day_column, utc_day(column, dtype))
    # All columns decide the part, so that a retried task deals its rows alike.
    part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns if _hashable(df.schema[name].dataType)]), F.lit(parts))
    dealt = days.withColumn("_part", part).repartition(day_column, "_part").drop("_part")
    dealt.sortWithinPartitions(day_column, column).write.partitionBy(day_column).parquet(path)
    return df.sparkSession.read.parquet(path)


def _hashable(dtype: T.DataType) -> bool:
    return not any(kind in dtype.simpleString() for kind in ("map", "variant", "interval"))


def during(
    df: DataFrame,
    buckets: DataFrame,
    interval: str,
    ts_field: str = "@timestamp",
    day_column: str | None = None,
    few: bool = False,
) -> DataFrame:
    """Rows whose time falls into one of the buckets (column ``bucket``: their starts), with their ``bucket``.

    On a table with a partition for each day (:func:`write_daily`) the days
    that the buckets touch become known while the query runs, and other days'
    files are not opened: dynamic partition pruning. Buckets may come from any
    operator. ``few`` says that their number has a bound, so that all of them
    are sent to every task and no row is shuffled.
    """
    sent = F.broadcast if few else lambda found: found
    width = parse_interval(interval)
    column, dtype = time_column(df, ts_field)
    seconds = epoch_seconds(column, dtype)
    wanted = buckets.select("bucket").dropDuplicates()
    if day_column is None:
        rows = df.withColumn("bucket", from_epoch_seconds(bucket_start(seconds, width), dtype))
        return rows.join(sent(wanted), "bucket", "left_semi")
    kind = buckets.schema["bucket"].dataType
    start = epoch_seconds(F.col("bucket"), kind)
    first, last = (utc_day(from_epoch_seconds(s, kind), kind) for s in (start, start + width - 1))
    wanted = wanted.select("bucket", F.explode(F.sequence(first, last)).alias(day_column))
    rows = df.withColumn("bucket", from_epoch_seconds(bucket_start(seconds, width), dtype))
    return rows.join(sent(wanted), [day_column, "bucket"], "left_semi")


def spike_rows(
    df: DataFrame,
    from_ts,
    to_ts,
    ts_field: str = "@timestamp",
    interval: str = "1h",
    where: Condition = None,
    z_limit: float = Z_LIMIT,
    day_column: str | None = None,
) -> DataFrame:
    """Matching rows of the buckets that hold unusually many, with their ``bucket``.

    Spikes are found first, from the time field alone; then only their days
    are read again, if the table has a partition for each.
    """
    first, last, width = bucket_grid(from_ts, to_ts, interval)
    found = spikes(df, from_ts, to_ts, ts_field, interval, where, z_limit).select("bucket")
    rows = matching(df, where, from_ts, to_ts, ts_field)
    return during(rows, found, interval, ts_field, day_column, few=(last - first) // width < SENT_BUCKETS)
