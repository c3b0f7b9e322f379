"""Sketches by day that merge into any range of days: different partners, and frequent values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field, field_type
from logframe.functions.predicates import day_range
from logframe.functions.times import time_column, utc_day
from logframe.operators.rank import ordered

# Registers of a sketch of different values, as a power of two: 4,096 are off by 1.6 % usually.
REGISTERS = 12

# Values that a sketch of frequent values follows.
TRACKED = 10_000


def fan_out_sketches(
    df: DataFrame, src: str, dst: str, ts_field: str = "@timestamp", day_column: str = "day", registers: int = REGISTERS
) -> DataFrame:
    """``(day, src, sketch)``: for each UTC day and source a HyperLogLog sketch of its destinations.

    Write it by day, once; :func:`fan_out_of` answers any range of days from
    it. Sketches are made in the tasks that read the rows and merged after one
    shuffle of them. Rows without a source or time are left out.
    """
    column, kind = time_column(df, ts_field)
    rows = df.select(
        utc_day(column, kind).alias(day_column), field(df, src).alias(src), field(df, dst).cast("string").alias("_dst")
    ).filter(F.col(day_column).isNotNull() & F.col(f"`{src}`").isNotNull())
    return rows.groupBy(day_column, f"`{src}`").agg(F.hll_sketch_agg("_dst", F.lit(registers)).alias("sketch"))


def fan_out_of(
    sketches: DataFrame, src: str, from_day=None, to_day=None, day_column: str = "day", size: int | None = None
) -> DataFrame:
    """``(src, fan_out)`` over a range of days, widest first: about how many different destinations each source met.

    The union of the days' sketches is the sketch of all their rows, so a
    destination met on several days counts once. Off by 1.04 divided by the
    root of the registers, usually, whatever the number of days.
    """
    days = sketches.filter(day_range(sketches, day_column, from_day, to_day))
    merged = days.groupBy(f"`{src}`").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("fan_out"))
    return ordered(merged, [F.desc("fan_out"), F.asc(f"`{src}`")], size)


def top_sketches(
    df: DataFrame, path: str, ts_field: str = "@timestamp", day_column: str = "day", tracked: int = TRACKED
) -> DataFrame:
    """``(day, sketch)``: for each UTC day a sketch of the frequent values of a field, one row a day."""
    column, kind = time_column(df, ts_field)
    rows = df.select(utc_day(column, kind).alias(day_column), field(df, path).alias("value"))
    rows = rows.filter(F.col(day_column).isNotNull() & F.col("value").isNotNull())
    return rows.groupBy(day_column).agg(_accumulated(F.col("value"), tracked).alias("sketch"))


def _accumulated(value: Column, tracked: int) -> Column:
    return F.call_function("approx_top_k_accumulate", value, F.lit(tracked))


def top_of(
    sketches: DataFrame, size: int = 10, from_day=None, to_day=None, day_column: str = "day", tracked: int = TRACKED
) -> DataFrame:
    """``(key, doc_count)`` of the most frequent values over a range of days, about.

    Counts are exact while a range's different values are within three
    quarters of ``tracked``; beyond, a value that makes up less than some 3.5
    divided by ``tracked`` of the rows may be missed, and counts may be too large by as
    much.
    """
    days = sketches.filter(day_range(sketches, day_column, from_day, to_day))
    merged = days.agg(F.call_function("approx_top_k_combine", "sketch", F.lit(tracked)).alias("sketch"))
    found = merged.select(
        F.explode(F.call_function("approx_top_k_estimate", "sketch", F.lit(size))).alias("top")
    )
    return found.select(F.col("top.item").alias("key"), F.col("top.count").alias("doc_count")).orderBy(
        F.desc("doc_count"), "key"
    )
