"""What changed in the top values of a field between two time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.functions.guards import top_size
from logframe.functions.predicates import Condition, condition, time_range
from logframe.operators.aggregate import field_tops, field_values, keyed_counts, labelled
from logframe.operators.rank import ordered, ordered_page

SIDES = ("baseline", "selection")

# The classes of a value, in the order they are reported.
STATUSES = ("added", "removed", "changed", "unchanged")


def compare(
    df: DataFrame,
    field: str,
    baseline_from,
    baseline_to,
    selection_from,
    selection_to,
    where: Condition = None,
    ts_field: str = "@timestamp",
    size: int = 20,
    exact: bool = False,
) -> DataFrame:
    """Top values of both windows: ``(key, status, baseline, selection, delta, pct_change)``.

    A value outside one window's top ``size`` counts as absent from that
    window; ``exact=True`` looks up its true count first. One pass counts both
    windows. Largest absolute change first within each status.
    """
    windows = _windows(df, ts_field, baseline_from, baseline_to, selection_from, selection_to)
    rows = _in_windows(df, where, windows)
    values = field_values(rows, field, *[F.col(f"_{side}") for side in SIDES])
    counts = values.groupBy("key").agg(*[m.alias(side) for side, m in _measures().items()])
    # Both tops are read from the same shuffle, which Spark reuses.
    tops = [
        ordered_page(counts.filter(F.col(side) > 0), side, ["key"], True, 0, top_size(size))
        for side in SIDES
    ]
    return _classified(_sided(tops), ["key"], size, exact)


def compare_fields(
    df: DataFrame,
    fields: list[str],
    baseline_from,
    baseline_to,
    selection_from,
    selection_to,
    where: Condition = None,
    ts_field: str = "@timestamp",
    size: int = 50,
    exact: bool = False,
) -> DataFrame:
    """:func:`compare` over several fields in one pass, keys as text, with a ``field`` column."""
    if not fields:
        raise ValueError("no fields given")
    windows = _windows(df, ts_field, baseline_from, baseline_to, selection_from, selection_to)
    rows = _in_windows(df, where, windows)
    counts, slots = keyed_counts(rows, fields, _measures())
    sizes = [top_size(size)] * len(fields)
    tops = [field_tops(counts.filter(F.col(side) > 0), slots, side, sizes) for side in SIDES]
    label, key = labelled(fields, slots)
    top = _sided(tops).withColumns({"field": label, "key": key})
    return _classified(top, ["field", "key"], size * len(fields), exact)


def _windows(df, ts_field, *bounds) -> tuple[Column, Column]:
    if not all(bounds):
        raise ValueError("both windows need a start and an end")
    return time_range(df, ts_field, *bounds[:2]), time_range(df, ts_field, *bounds[2:])


def _in_windows(df: DataFrame, where: Condition, windows: tuple[Column, Column]) -> DataFrame:
    baseline, selection = windows
    return (
        df.filter(baseline | selection)
        .filter(condition(where))
        .withColumns({f"_{side}": window for side, window in zip(SIDES, windows)})
    )


def _measures() -> dict[str, Column]:
    return {side: F.count_if(F.col(f"_{side}")) for side in SIDES}


def _sided(tops: list[DataFrame]) -> DataFrame:
    """Both top lists as one, each row marked with the list it is from."""
    baseline, selection = [
        top.withColumn("side", F.lit(side)) for top, side in zip(tops, SIDES)
    ]
    return baseline.unionByName(selection)


def _classified(top: DataFrame, keys: list[str], size: int, exact: bool) -> DataFrame:
    """One row per value of the two top lists of at most ``size`` rows each."""
    if exact:
        counted = lambda side: F.nullif(F.max(side), F.lit(0))
    else:
        counted = lambda side: F.max(F.when(F.col("side") == side, F.col(side)))
    baseline, selection = F.col("baseline"), F.col("selection")
    delta = selection - baseline
    status = (
        F.when(baseline.isNull(), "added")
        .when(selection.isNull(), "removed")
        .when(delta != 0, "changed")
        .otherwise("unchanged")
    )
    # Half to even on tenths of a percent.
    percent = F.bround(1000.0 * delta / baseline, 0) / 10
    diff = (
        top.groupBy(*keys)
        .agg(*[counted(side).alias(side) for side in SIDES])
        .withColumn("status", status)
        .withColumn("delta", delta)
        .withColumn("pct_change", F.when(F.col("status") == "changed", percent))
        .select(*keys, "status", "baseline", "selection", "delta", "pct_change")
    )
    place = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status"))
    most = F.abs(F.coalesce(F.col("delta"), baseline, selection)).desc()
    *group, key = [F.col(name) for name in keys]
    return ordered(diff, [*group, place, most, key], 2 * size)
