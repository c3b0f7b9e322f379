"""Rows joined with windows of time, of any length and overlapping as they like."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.functions.times import bucket_start, epoch_seconds, parse_interval, time_column

# Tasks that rows of one bin are dealt to.
PARTS = 8


def in_windows(
    df: DataFrame,
    windows: DataFrame,
    ts_field: str = "@timestamp",
    start: str = "start",
    end: str = "end",
    interval: str = "1h",
    parts: int = PARTS,
) -> DataFrame:
    """Every row once for each window that its time lies in, with the window's columns; both ends count.

    Time is cut into bins of ``interval``. A row is in one bin, a window is
    copied to all that it touches, and a row meets a window only in the row's
    bin: an equi-join that gives each pair once. A bin's rows are dealt to
    ``parts`` tasks, each with a copy of the bin's windows, so a bin with most
    of the rows is not one task's. ``interval`` should be near the usual length
    of a window: a longer one is copied more often, a shorter one meets more
    rows that it does not hold.

    Windows may repeat and overlap. One without a start or an end, or that ends
    before it starts, holds nothing, and neither does a row without a time.
    Windows' columns of a name that the rows have are an error.
    """
    if parts < 1:
        raise ValueError(f"parts must be at least 1, got {parts}")
    clash = sorted({c.lower() for c in df.columns} & {c.lower() for c in windows.columns})
    if clash:
        raise ValueError(f"rows and windows both have columns {clash}")
    width = parse_interval(interval)
    column, kind = time_column(df, ts_field)
    low, low_kind = time_column(windows, start)
    high, high_kind = time_column(windows, end)
    first = bucket_start(epoch_seconds(low, low_kind), width)
    last = bucket_start(epoch_seconds(high, high_kind), width)
    spread = (
        windows.withColumns({"_low": low.cast(kind), "_high": high.cast(kind)})
        .filter(F.col("_low") <= F.col("_high"))
        .withColumn("_bin", F.explode(F.sequence(first, last, F.lit(width).cast("bigint"))))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    )
    rows = df.withColumns(
        {
            "_at": column,
            "_bin": bucket_start(epoch_seconds(column, kind), width),
            # Dealt by time and whatever else can be hashed in one go.
            "_part": F.pmod(F.xxhash64(*_plain(df)), F.lit(parts)).cast("int"),
        }
    )
    inside = (F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_high"))
    joined = rows.join(spread, ["_bin", "_part"]).filter(inside)
    return joined.drop("_bin", "_part", "_at", "_low", "_high")


def _plain(df: DataFrame) -> list:
    """Columns that have a hash."""
    kinds = ("map", "variant", "interval")
    return [F.col(f"`{f.name}`") for f in df.schema if not any(k in f.dataType.simpleString() for k in kinds)]
