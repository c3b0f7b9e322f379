"""Unusual counts, wide connections and values seen on both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field as column_at
from logframe.functions.fields import field_type, is_array
from logframe.functions.predicates import Condition, matching
from logframe.operators.aggregate import field_values, multi_terms
from logframe.operators.histogram import histogram
from logframe.operators.rank import ordered

# Fixed value: deviations above the mean from which a count stands out.
Z_LIMIT = 2.0


def outliers(counts: DataFrame, z_limit: float = Z_LIMIT) -> DataFrame:
    """Rows whose ``doc_count`` lies more than ``z_limit`` deviations above the mean.

    Mean and deviation are one row, read by a scalar subquery over the same
    aggregate, whose shuffle Spark reuses.
    """
    spread = counts.agg(
        F.struct(F.avg("doc_count").alias("mean"), F.stddev_pop("doc_count").alias("deviation"))
    ).scalar()
    z = (F.col("doc_count") - spread["mean"]) / F.nullif(spread["deviation"], F.lit(0.0))
    return counts.withColumn("z", z).filter(F.col("z") > z_limit)


def anomalous_terms(
    df: DataFrame,
    field: str,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    z_limit: float = Z_LIMIT,
) -> DataFrame:
    """Values of a field that occur unusually often among all its values."""
    values = field_values(matching(df, where, from_ts, to_ts, ts_field), field)
    counts = values.groupBy("key").agg(F.count(F.lit(1)).alias("doc_count"))
    found = outliers(counts, z_limit).withColumnRenamed("key", field)
    return found.orderBy(F.desc("doc_count"), F.asc(f"`{field}`"))


def spikes(
    df: DataFrame,
    from_ts,
    to_ts,
    ts_field: str = "@timestamp",
    interval: str = "1h",
    where: Condition = None,
    z_limit: float = Z_LIMIT,
    bucket_cap: int | None = None,
) -> DataFrame:
    """Buckets of a histogram, empty ones included, that hold unusually many rows."""
    buckets = histogram(df, from_ts, to_ts, ts_field, interval, where, bucket_cap)
    return outliers(buckets, z_limit).orderBy("bucket")


def fan_out(
    df: DataFrame,
    src: str,
    dst: str,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    approximate: bool = False,
    size: int | None = None,
) -> DataFrame:
    """How many different ``dst`` values each ``src`` value meets: ``(src, fan_out)``, widest first.

    ``size`` keeps the widest so many; None keeps all. Arrays give each of
    their elements. The exact count spreads a hot source over the tasks by its
    destinations before adding up.
    """
    rows = matching(df, where, from_ts, to_ts, ts_field)
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    pairs = field_values(rows, src, column_at(rows, dst).alias("_dst"))
    if is_array(rows, dst):
        pairs = pairs.select("key", F.explode_outer("_dst").alias("_dst"))
    counts = pairs.groupBy("key").agg(distinct("_dst").alias("fan_out"))
    widest = ordered(counts, [F.desc("fan_out"), F.asc("key")], size)
    return widest.withColumnRenamed("key", src)


def pivot_values(
    df: DataFrame,
    src: str,
    dst: str,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    size: int = 20,
) -> DataFrame:
    """Values among the top of both fields: ``(key, src_count, dst_count)``.

    Both top lists come from one pass over the rows.
    """
    lists = [{"id": "src", "field": src, "size": size}, {"id": "dst", "field": dst, "size": size}]
    top = multi_terms(df, lists, where, from_ts, to_ts, ts_field)
    of = lambda ident: F.max(F.when(F.col("id") == ident, F.col("doc_count")))
    both = top.groupBy("key").agg(of("src").alias("src_count"), of("dst").alias("dst_count"))
    both = both.filter("src_count is not null and dst_count is not null")
    kinds = {field_type(df, src).simpleString(), field_type(df, dst).simpleString()}
    if len(kinds) == 1 and not kinds.pop().startswith("array"):
        both = both.withColumn("key", F.col("key").cast(field_type(df, src)))
    return both.orderBy(F.desc("src_count"), F.desc("dst_count"), F.asc("key"))
