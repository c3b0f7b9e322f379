"""Histograms over long spans from counts that are kept at several widths."""

from __future__ import annotations

import datetime as dt
import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.functions.guards import bucket_grid
from logframe.functions.predicates import any_of
from logframe.functions.times import (
    EPOCH,
    bucket_start,
    epoch_seconds,
    from_epoch_seconds,
    parse_interval,
    parse_window,
    time_column,
    time_literal,
)
from logframe.operators.histogram import histogram

# Widths that counts are kept at, each a multiple of the one before.
WIDTHS = ("1m", "1h", "1d")

_MICRO = dt.timedelta(microseconds=1)
_SECOND = 1_000_000


def write_rollup(
    df: DataFrame, path: str, ts_field: str = "@timestamp", intervals: tuple[str, ...] = WIDTHS
) -> DataFrame:
    """``(bucket, n, width)``: rows per bucket at several widths as Parquet at ``path``; read back.

    Rows are counted at the narrowest width, in one pass; wider buckets add up
    narrower ones. ``bucket`` and ``width`` are seconds, and each width is a
    partition. Empty buckets and rows without a time are left out.
    """
    widths = [parse_interval(interval) for interval in intervals]
    if not widths or any(b % a or a == b for a, b in zip(widths, widths[1:])):
        raise ValueError(f"each width must be a multiple of the one before: {intervals}")
    column, kind = time_column(df, ts_field)
    seconds = df.select(epoch_seconds(column, kind).alias("second")).filter("second is not null")
    finest = seconds.groupBy(bucket_start(F.col("second"), widths[0]).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    levels = [finest]
    for width in widths[1:]:
        levels.append(
            levels[-1].groupBy(bucket_start(F.col("bucket"), width).alias("bucket")).agg(F.sum("n").alias("n"))
        )
    named = [level.withColumn("width", F.lit(width)) for level, width in zip(levels, widths)]
    functools.reduce(DataFrame.unionByName, named).write.partitionBy("width").parquet(path)
    return df.sparkSession.read.parquet(path)


def cover(low: int, high: int, widths: list[int]) -> list[tuple[int, int, int]]:
    """Pieces ``(width, from, to)`` that make up the whole narrowest buckets of a span, the widest possible.

    ``widths`` rise, each a multiple of the one before; ``low`` and ``high``
    are seconds and multiples of the first. At most two pieces a width.
    """
    if low >= high:
        return []
    width = widths[-1]
    first, last = -(-low // width) * width, high // width * width
    if len(widths) == 1:
        return [(width, low, high)]
    if first >= last:
        return cover(low, high, widths[:-1])
    return [*cover(low, first, widths[:-1]), (width, first, last), *cover(last, high, widths[:-1])]


def rolled_histogram(
    df: DataFrame,
    rollup: DataFrame,
    from_ts,
    to_ts,
    ts_field: str = "@timestamp",
    interval: str = "1d",
    intervals: tuple[str, ...] = WIDTHS,
    bucket_cap: int | None = None,
) -> DataFrame:
    """:func:`histogram` without a condition, from a rollup: the same rows, ``(bucket, doc_count)``.

    The span is covered by the widest buckets that lie in it whole and whose
    width divides the interval; rows of the table are read only between its
    ends and the first and last of these. ``intervals`` is what the rollup was
    written with. Where no width divides the interval all rows are read.
    """
    first, last, width = bucket_grid(from_ts, to_ts, interval, bucket_cap)
    usable = [own for own in map(parse_interval, intervals) if width % own == 0]
    if not usable:
        return histogram(df, from_ts, to_ts, ts_field, interval, bucket_cap=bucket_cap)
    start, end = parse_window(from_ts, to_ts)
    low = -(-((start - EPOCH) // _MICRO) // (usable[0] * _SECOND)) * usable[0]
    high = ((end - EPOCH) // _MICRO + 1) // (usable[0] * _SECOND) * usable[0]

    column, kind = time_column(df, ts_field)
    at = lambda moment: time_literal(kind, moment)
    of = lambda seconds: EPOCH + dt.timedelta(seconds=seconds)
    if low < high:
        ends = [(column >= at(start)) & (column < at(of(low))), (column >= at(of(high))) & (column <= at(end))]
    else:
        ends = [(column >= at(start)) & (column <= at(end))]
    raw = df.filter(any_of(*ends)).select(epoch_seconds(column, kind).alias("bucket"), F.lit(1).cast("bigint").alias("n"))
    pieces = [
        (F.col("width") == own) & (F.col("bucket") >= a) & (F.col("bucket") < b) for own, a, b in cover(low, high, usable)
    ]
    kept = rollup.filter(functools.reduce(operator.or_, pieces, F.lit(False))).select("bucket", "n")
    zeros = df.sparkSession.range(first, last + width, width, 1).select(
        F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("n")
    )
    counts = (
        raw.unionByName(kept)
        .withColumn("bucket", bucket_start(F.col("bucket"), width))
        .unionByName(zeros)
        .groupBy("bucket")
        .agg(F.sum("n").alias("doc_count"))
    )
    return counts.orderBy("bucket").withColumn("bucket", from_epoch_seconds(F.col("bucket"), kind))
