"""Whole investigations: named results of several operators over one table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field as column_at
from logframe.functions.fields import is_array
from logframe.functions.guards import top_size
from logframe.functions.predicates import Condition, all_of, between, matching, term, time_range
from logframe.functions.times import bucket_start, epoch_seconds, from_epoch_seconds, parse_interval, time_column
from logframe.operators.aggregate import keyed_counts, labelled, multi_terms
from logframe.operators.anomaly import spikes
from logframe.operators.compare import compare, compare_fields
from logframe.operators.histogram import auto_histogram
from logframe.operators.rank import top_per_group
from logframe.operators.retrieve import count

# How many rows or values each step of an investigation shows.
RULES_SHOWN = 20
DESCRIPTIONS_SHOWN = 10
EVENTS_SHOWN = 5
OFFENDERS_SHOWN = 20
COMPARED_VALUES = 50
SAMPLES_PER_VALUE = 5
# From this severity an event is severe; above this change, in
# percent, a value is worth a closer look.
SEVERE_LEVEL = 12
LARGE_CHANGE = 200.0


def investigate(
    df: DataFrame,
    entity_field: str,
    entity,
    from_ts,
    to_ts,
    ts_field: str = "@timestamp",
    rule_field: str = "rule.id",
    description_field: str | None = "rule.description",
    severity_field: str = "rule.level",
    min_severity=SEVERE_LEVEL,
    source_fields: list[str] | None = None,
    key: str | None = None,
    rules: int = RULES_SHOWN,
    descriptions: int = DESCRIPTIONS_SHOWN,
    events: int = EVENTS_SHOWN,
    peer_fields: list[str] | None = None,
    before=None,
) -> dict[str, DataFrame]:
    """Everything about one agent, user or host in a time window.

    ``count``; ``values`` (its rules and, when there is a field for them,
    descriptions, from one pass); ``timeline``; and ``events``, the most severe
    ones, newest first among equals. ``peer_fields`` name who the entity dealt
    with, such as destinations: ``peers`` counts how many different ones, and
    with ``before``, the start of an earlier window that ends at ``from_ts``,
    ``new_peers`` are those not met in it. The frames are lazy and read only the
    columns they need; ``persist`` the table first if it is small and slow to
    read.
    """
    mine = term(df, entity_field, entity)
    window = (from_ts, to_ts, ts_field)
    values = [{"id": "rules", "field": rule_field, "size": rules}]
    if description_field is not None:
        values.append(
            {"id": "descriptions", "field": description_field, "size": descriptions}
        )
    severe = all_of(mine, between(df, severity_field, min_severity))
    severity = column_at(df, severity_field)
    rows = matching(df, severe, *window)
    order = [severity.desc_nulls_last(), column_at(df, ts_field).desc_nulls_last()]
    if key is not None:
        order.append(column_at(df, key).asc())
    worst = rows.orderBy(*order).limit(events)
    if source_fields:
        worst = worst.select(*[column_at(df, path).alias(path) for path in source_fields])
    found = {
        "count": count(df, mine, *window),
        "values": multi_terms(df, values, mine, *window),
        "timeline": auto_histogram(df, *window, where=mine),
        "events": worst,
    }
    if peer_fields:
        own = matching(df, mine, *window)
        met = [
            F.struct(F.lit(path).alias("field"), F.count_distinct(column_at(own, path)).alias("peers"))
            for path in peer_fields
        ]
        found["peers"] = own.agg(F.array(*met).alias("met")).select(F.inline("met"))
        if before is not None:
            found["new_peers"] = _new_values(df, mine, peer_fields, before, *window)
    return found


def _new_values(df, mine, fields: list[str], before, from_ts, to_ts, ts_field: str) -> DataFrame:
    """Values with rows in the window, but none from ``before`` to its start: field, key, doc_count."""
    inside = time_range(df, ts_field, from_ts, to_ts)
    rows = matching(df, mine, before, to_ts, ts_field).withColumn("_inside", inside)
    measures = {
        "doc_count": F.count_if("_inside"),
        "earlier": F.count_if(~F.col("_inside")),
    }
    counts, slots = keyed_counts(rows, fields, measures)
    label, key = labelled(fields, slots)
    new = counts.filter("doc_count > 0 and earlier = 0")
    return new.select(label.alias("field"), key.alias("key"), "doc_count")


def top_offenders(
    df: DataFrame,
    fields: dict[str, str] | list[str],
    from_ts,
    to_ts,
    ts_field: str = "@timestamp",
    where: Condition = None,
    size: int = OFFENDERS_SHOWN,
    spike_interval: str | None = None,
    causes: int = SAMPLES_PER_VALUE,
) -> dict[str, DataFrame]:
    """The most frequent values of several fields from one pass, and the timeline.

    With ``spike_interval`` also ``causes``: for every bucket of that width
    that holds unusually many rows, the most frequent values of each field in
    it, ``(bucket, id, key, doc_count)``.
    """
    named = fields if isinstance(fields, dict) else {path: path for path in fields}
    lists = [{"id": ident, "field": path, "size": size} for ident, path in named.items()]
    found = {
        "values": multi_terms(df, lists, where, from_ts, to_ts, ts_field),
        "timeline": auto_histogram(df, from_ts, to_ts, ts_field, where),
    }
    if spike_interval is not None:
        found["causes"] = _causes(
            df, named, from_ts, to_ts, ts_field, where, spike_interval, causes
        )
    return found


def _causes(df, named: dict[str, str], from_ts, to_ts, ts_field, where, interval, size) -> DataFrame:
    """Top values inside each spike; the buckets are joined, so other rows are dropped first."""
    peaks = spikes(df, from_ts, to_ts, ts_field, interval, where).select("bucket")
    rows = matching(df, where, from_ts, to_ts, ts_field)
    column, dtype = time_column(rows, ts_field)
    start = bucket_start(epoch_seconds(column, dtype), parse_interval(interval))
    entries = []
    for ident, path in named.items():
        value = column_at(rows, path)
        values = F.array_distinct(value) if is_array(rows, path) else F.array(value)
        entries.append(F.transform(values, partial(_entry, ident)))
    held = rows.select(from_epoch_seconds(start, dtype).alias("bucket"), F.concat(*entries).alias("e"))
    counts = (
        held.join(peaks, "bucket", "left_semi")
        .select("bucket", F.inline("e"))
        .filter("key is not null")
        .groupBy("bucket", "id", "key")
        .agg(F.count(F.lit(1)).alias("doc_count"))
    )
    return top_per_group(counts, ["bucket", "id"], [F.desc("doc_count"), F.asc("key")], size)


def _entry(ident: str, value: Column) -> Column:
    return F.struct(F.lit(ident).alias("id"), value.cast("string").alias("key"))


def compare_report(
    df: DataFrame,
    fields: list[str],
    baseline_from,
    baseline_to,
    selection_from,
    selection_to,
    where: Condition = None,
    ts_field: str = "@timestamp",
    size: int = COMPARED_VALUES,
) -> DataFrame:
    """Changes in the top values of several fields, counted in one pass."""
    return compare_fields(
        df,
        fields,
        baseline_from,
        baseline_to,
        selection_from,
        selection_to,
        where,
        ts_field,
        size,
    )


def _with_values(rows: DataFrame, field: str, keys: DataFrame) -> DataFrame:
    """Rows whose field, as ``_value``, is among ``keys``."""
    column = column_at(rows, field)
    if is_array(rows, field):
        column = F.explode(F.array_distinct(column))
    rows = rows.withColumn("_value", column)
    return rows.join(keys, rows["_value"] == keys["_wanted"], "left_semi")


def added_samples(
    df: DataFrame,
    field: str,
    baseline_from,
    baseline_to,
    selection_from,
    selection_to,
    where: Condition = None,
    ts_field: str = "@timestamp",
    size: int = COMPARED_VALUES,
    samples: int = SAMPLES_PER_VALUE,
    source_fields: list[str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """The newest ``samples`` events of each value that is new in the selection window."""
    changes = compare(
        df,
        field,
        baseline_from,
        baseline_to,
        selection_from,
        selection_to,
        where,
        ts_field,
        size,
    )
    added = changes.filter("status = 'added'").select(F.col("key").alias("_wanted"))
    rows = matching(df, where, selection_from, selection_to, ts_field)
    rows = _with_values(rows, field, added)
    order = [column_at(df, ts_field).desc_nulls_last()]
    if key is not None:
        order.append(column_at(df, key).asc())
    newest = top_per_group(rows, ["_value"], order, samples).drop("_value")
    if not source_fields:
        return newest
    return newest.select(*[column_at(df, path).alias(path) for path in source_fields])


def changed_drill(
    df: DataFrame,
    field: str,
    drill_field: str,
    baseline_from,
    baseline_to,
    selection_from,
    selection_to,
    where: Condition = None,
    ts_field: str = "@timestamp",
    size: int = COMPARED_VALUES,
    threshold: float = LARGE_CHANGE,
    drill_size: int = OFFENDERS_SHOWN,
) -> DataFrame:
    """Top values of another field for each value that grew by more than ``threshold`` percent.

    ``(key, value, doc_count)`` over the selection window.
    """
    changes = compare(
        df,
        field,
        baseline_from,
        baseline_to,
        selection_from,
        selection_to,
        where,
        ts_field,
        size,
    )
    grown = changes.filter(F.col("pct_change") > threshold).select(F.col("key").alias("_wanted"))
    rows = matching(df, where, selection_from, selection_to, ts_field)
    rows = _with_values(rows, field, grown)
    value = column_at(rows, drill_field)
    if is_array(rows, drill_field):
        value = F.explode(F.array_distinct(value))
    pairs = rows.select(F.col("_value").alias("key"), value.alias("value"))
    pairs = pairs.filter("value is not null")
    counts = pairs.groupBy("key", "value").agg(F.count(F.lit(1)).alias("doc_count"))
    return top_per_group(counts, ["key"], [F.desc("doc_count"), F.asc("value")], top_size(drill_size))
