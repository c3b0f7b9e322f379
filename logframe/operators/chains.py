"""Chains of connections: from a value to those it met, from these onward, in order of time."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field
from logframe.functions.predicates import Condition, matching
from logframe.sources.folders import new_folder

# Tasks that one value's connections are dealt to.
PARTS = 8


def reachable(
    df: DataFrame,
    start: list,
    src: str,
    dst: str,
    hops: int,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    parts: int = PARTS,
) -> DataFrame:
    """``(value, hop, at)``: values reached from ``start`` in at most ``hops`` steps, and how early.

    A step goes along a row from its ``src`` to its ``dst`` at the row's time; a
    chain's times must not fall. ``hop`` is the least number of steps that
    reach a value, and ``at`` the earliest time at which so many do; the values
    of ``start`` are hop 0 with a NULL time, from which any row may go on.
    Rows without a source, destination or time are no steps.

    Each step joins the values that the one before reached earlier than any
    before it with the rows, which are read anew. Only each value's earliest time is
    kept, as a later one leads nowhere that the earliest does not. A hub's rows
    are dealt to ``parts`` tasks by destination, each with a copy of its one
    line; earliest times are aggregated before they are shuffled. Steps are
    written to the shared folder, so a lost executor repeats one of them.
    """
    if hops < 1 or parts < 1:
        raise ValueError("hops and parts must be at least 1")
    rows = matching(df, where, from_ts, to_ts, ts_field)
    steps = rows.select(
        field(rows, src).cast("string").alias("src"), field(rows, dst).cast("string").alias("dst"), field(rows, ts_field).alias("at")
    ).filter("src is not null and dst is not null and at is not null")
    steps = steps.withColumn("part", F.pmod(F.xxhash64("dst"), F.lit(parts)).cast("int"))
    spark, kind = df.sparkSession, steps.schema["at"].dataType
    first = spark.createDataFrame([(str(value),) for value in dict.fromkeys(start)], "value string")
    frontier = first.select("value", F.lit(0).alias("hop"), F.lit(None).cast(kind).alias("at"))
    known = [frontier]
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    for hop in range(1, hops + 1):
        left = frontier.select(F.col("value").alias("src"), F.col("at").alias("since")).withColumn("part", every)
        met = (
            steps.join(left, ["src", "part"])
            .filter(F.col("since").isNull() | (F.col("at") >= F.col("since")))
            .groupBy(F.col("dst").alias("value"))
            .agg(F.min("at").alias("at"))
        )
        # What was reached at least as early before leads nowhere new.
        before = functools.reduce(DataFrame.unionByName, known).groupBy("value").agg(
            F.min(F.struct(F.col("at").isNotNull().alias("timed"), "at")).alias("old")
        )
        new = met.join(before, "value", "left").filter(
            F.col("old").isNull() | (F.col("old.timed") & (F.col("at") < F.col("old.at")))
        )
        path = new_folder(spark, "reached")
        new.select("value", F.lit(hop).alias("hop"), "at").write.parquet(path)
        frontier = spark.read.parquet(path)
        known.append(frontier)
        if frontier.isEmpty():
            break
    every_step = functools.reduce(DataFrame.unionByName, known)
    least = every_step.groupBy("value").agg(F.min(F.struct("hop", "at")).alias("least"))
    return least.select("value", "least.hop", "least.at")
