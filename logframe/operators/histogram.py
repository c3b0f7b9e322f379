"""Event counts over time, empty buckets included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.guards import bucket_grid
from logframe.functions.predicates import Condition, matching
from logframe.functions.times import (
    UNIT_SECONDS,
    bucket_start,
    epoch_seconds,
    from_epoch_seconds,
    time_column,
)
from logframe.operators.rank import ordered

# Most buckets an automatic histogram has by default, and the widths it
# chooses from, narrowest first.
AUTO_BUCKETS = 50
AUTO_WIDTHS = (
    "1s", "5s", "10s", "30s",
    "1m", "5m", "10m", "30m",
    "1h", "3h", "12h",
    "1d", "7d", "30d", "90d", "365d",
    "1825d", "3650d", "7300d", "18250d", "36500d",
)


def _seconds(label: str) -> int:
    return int(label[:-1]) * UNIT_SECONDS[label[-1]]


def _event_seconds(rows: DataFrame, ts_field: str) -> tuple[DataFrame, T.DataType]:
    column, dtype = time_column(rows, ts_field)
    timed = rows.filter(column.isNotNull())
    return timed.select(epoch_seconds(column, dtype).alias("second")), dtype


def _filled(events: DataFrame, grid: DataFrame, *also: Column) -> DataFrame:
    """Events per bucket; the grid adds a zero for each bucket, so no join is needed."""
    ones = events.withColumn("n", F.lit(1).cast("bigint"))
    zeros = grid.withColumn("n", F.lit(0).cast("bigint"))
    both = ones.unionByName(zeros)
    return both.groupBy("bucket").agg(F.sum("n").alias("doc_count"), *also)


def histogram(
    df: DataFrame,
    from_ts,
    to_ts,
    ts_field: str = "@timestamp",
    interval: str = "1h",
    where: Condition = None,
    bucket_cap: int | None = None,
    max_buckets: int = AUTO_BUCKETS,
) -> DataFrame:
    """Rows per bucket over the whole requested range: ``(bucket, doc_count)``.

    Buckets start at multiples of the interval since 1970. ``interval="auto"``
    gives an :func:`auto_histogram` of at most ``max_buckets`` buckets. Where a
    ``bucket_cap`` is given, a range that needs more buckets is refused before
    anything runs.
    """
    if interval == "auto":
        return auto_histogram(df, from_ts, to_ts, ts_field, where, max_buckets)
    first, last, width = bucket_grid(from_ts, to_ts, interval, bucket_cap)
    events, dtype = _event_seconds(matching(df, where, from_ts, to_ts, ts_field), ts_field)
    events = events.select(bucket_start(F.col("second"), width).alias("bucket"))
    grid = df.sparkSession.range(first, last + width, width, 1).toDF("bucket")
    buckets = (last - first) // width + 1
    filled = ordered(_filled(events, grid), [F.asc("bucket")], buckets)
    return filled.withColumn("bucket", from_epoch_seconds(F.col("bucket"), dtype))


def _auto_step(low: Column, high: Column, most: int) -> Column:
    """Place on the ladder, from 1, of the narrowest width that needs at most so many buckets.

    Each width is at least twice the one before, so all wider ones fit too.
    """

    def fits(width: Column) -> Column:
        span = bucket_start(high, width) - bucket_start(low, width)
        return span / width + 1 <= most

    wide_enough = F.size(F.filter(_ladder(), fits))
    return F.lit(len(AUTO_WIDTHS) + 1) - F.greatest(wide_enough, F.lit(1))


def _ladder() -> Column:
    return F.array(*[F.lit(_seconds(name)).cast("bigint") for name in AUTO_WIDTHS])


def auto_histogram(
    df: DataFrame,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    where: Condition = None,
    max_buckets: int = AUTO_BUCKETS,
) -> DataFrame:
    """Rows per bucket with a width chosen by the matching rows.

    ``(bucket, doc_count, interval_used)``, from the first to the last bucket
    that holds a row, empty ones between included; no rows when nothing
    matches. The time span comes from a scalar subquery: a second pass over
    the time and filter columns, whose one-row result is put into the plan.
    """
    events, dtype = _event_seconds(matching(df, where, from_ts, to_ts, ts_field), ts_field)
    span = events.agg(F.min("second").alias("low"), F.max("second").alias("high"))
    step = _auto_step(F.col("low"), F.col("high"), max_buckets)
    plan = span.withColumn("step", step).select(
        F.struct("low", "high", "step", F.element_at(_ladder(), F.col("step")).alias("width"))
    )
    # Two uses of the subquery; Spark runs it once.
    width = plan.scalar()["width"]
    events = events.select(
        bucket_start(F.col("second"), width).alias("bucket"), F.lit(None).cast("int").alias("step")
    )
    grid = (
        df.sparkSession.range(0, 1, 1, 1)
        .select(plan.scalar().alias("plan"))
        .select("plan.*")
        .select(
            F.explode(
                F.sequence(
                    bucket_start(F.col("low"), F.col("width")),
                    bucket_start(F.col("high"), F.col("width")),
                    F.col("width"),
                )
            ).alias("bucket"),
            "step",
        )
    )
    # Every bucket is in the grid, whose rows bring the chosen step along.
    filled = _filled(events, grid, F.max("step").alias("step"))
    names = F.array(*[F.lit(name) for name in AUTO_WIDTHS])
    return ordered(filled, [F.asc("bucket")], max_buckets).select(
        from_epoch_seconds(F.col("bucket"), dtype).alias("bucket"),
        "doc_count",
        F.element_at(names, F.col("step")).alias("interval_used"),
    )
