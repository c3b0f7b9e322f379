"""Most frequent values of one or many fields, and numeric summaries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.fields import field as column_at
from logframe.functions.fields import field_type, is_array
from logframe.functions.guards import top_size
from logframe.functions.predicates import Condition, any_of, matching
from logframe.operators.rank import ordered_page, top_per_group


def field_values(rows: DataFrame, path: str, *others: Column) -> DataFrame:
    """The non-null values of a field as ``key``; an array gives each distinct element once."""
    column = column_at(rows, path)
    if is_array(rows, path):
        column = F.explode(F.array_distinct(column))
    return rows.select(column.alias("key"), *others).filter(F.col("key").isNotNull())


def terms(
    df: DataFrame,
    field: str,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    size: int = 50,
) -> DataFrame:
    """The most frequent values of a field with exact counts, ties by value."""
    values = field_values(matching(df, where, from_ts, to_ts, ts_field), field)
    counts = values.groupBy("key").agg(F.count(F.lit(1)).alias("doc_count"))
    top = ordered_page(counts, "doc_count", ["key"], True, 0, top_size(size))
    return top.withColumnRenamed("key", field)


def keyed_counts(
    rows: DataFrame, fields: list[str], measures: dict[str, Column]
) -> tuple[DataFrame, list[str]]:
    """Measures per value of several fields from one pass: ``(_field, measures..., slots...)``.

    ``_field`` is the field's place in the list, from 1. Values keep their own
    type: fields of one type share a slot column, the other slots are NULL, so
    the rows are grouped by few columns and no value is turned into text. The
    names of the slots are returned too; in their order they sort the values
    of a field.
    """
    types = [field_type(rows, path) for path in fields]
    types = [t.elementType if isinstance(t, T.ArrayType) else t for t in types]
    slots = {t.simpleString(): f"_slot{n}" for n, t in enumerate(dict.fromkeys(types))}

    def entry(number: int, value: Column) -> Column:
        return F.struct(
            F.lit(number + 1).alias("_field"),
            *[
                (value if kind == types[number].simpleString() else F.lit(None))
                .cast(kind)
                .alias(slot)
                for kind, slot in slots.items()
            ],
        )

    def unfolded(number: int, path: str) -> Column:
        values = F.transform(F.array_distinct(column_at(rows, path)), partial(entry, number))
        return F.coalesce(values, F.array().cast(f"array<{layout}>"))

    layout = f"struct<_field:int,{','.join(f'{slot}:{kind}' for kind, slot in slots.items())}>"
    numbered = list(enumerate(fields))
    plain = [entry(n, column_at(rows, path)) for n, path in numbered if not is_array(rows, path)]
    arrays = [unfolded(n, path) for n, path in numbered if is_array(rows, path)]
    entries = F.array(*plain) if plain else F.array().cast(f"array<{layout}>")
    if arrays:
        entries = F.concat(entries, *arrays)
    names = list(slots.values())
    grouped = (
        rows.select("*", F.inline(entries))
        .filter(any_of(*[F.col(name).isNotNull() for name in names]))
        .groupBy("_field", *names)
    )
    return grouped.agg(*[m.alias(name) for name, m in measures.items()]), names


def labelled(ids: list[str], slots: list[str]) -> tuple[Column, Column]:
    """The field's label and the value as text, for rows of :func:`keyed_counts`."""
    label = F.element_at(F.array(*[F.lit(ident) for ident in ids]), F.col("_field"))
    return label, F.coalesce(*[F.col(name).cast("string") for name in slots])


def field_tops(counts: DataFrame, slots: list[str], by: str, sizes: list[int]) -> DataFrame:
    """The first rows of each field by a measure, for rows of :func:`keyed_counts`."""
    own_size = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("_field"))
    order = [F.desc(by), *[F.asc(name) for name in slots]]
    return top_per_group(counts, ["_field"], order, max(sizes), own_size)


def multi_terms(
    df: DataFrame,
    aggregations: list[dict],
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
) -> DataFrame:
    """Several :func:`terms` from one pass: ``(id, key, doc_count)`` with keys as text.

    Each aggregation is ``{"id": ..., "field": ..., "size": 50}``. The rows of
    an id come out together, most frequent first.
    """
    if not aggregations:
        raise ValueError("no aggregations given")
    sizes = {a["id"]: top_size(a.get("size", 50)) for a in aggregations}
    if len(sizes) < len(aggregations):
        raise ValueError("aggregation ids must differ")
    rows = matching(df, where, from_ts, to_ts, ts_field)
    counts, slots = keyed_counts(
        rows, [a["field"] for a in aggregations], {"doc_count": F.count(F.lit(1))}
    )
    top = field_tops(counts, slots, "doc_count", list(sizes.values()))
    label, key = labelled(list(sizes), slots)
    return top.select(label.alias("id"), key.alias("key"), "doc_count")


def extended_stats(
    df: DataFrame,
    field: str,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
) -> DataFrame:
    """Count, min, max, avg, sum and population deviation of a numeric field.

    An array of numbers gives each of its distinct elements once.
    """
    dtype = field_type(df, field)
    dtype = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
    if not isinstance(dtype, T.NumericType):
        raise ValueError(
            f"field {field!r} is {dtype.simpleString()}, not a number: use terms for its values"
        )
    values = field_values(matching(df, where, from_ts, to_ts, ts_field), field)
    # Sums of long integers are taken as doubles, which cannot overflow.
    number = F.col("key").cast("double")
    return values.agg(
        F.count("key").alias("count"),
        F.min("key").alias("min"),
        F.max("key").alias("max"),
        F.avg(number).alias("avg"),
        F.sum(number).alias("sum"),
        F.stddev_pop(number).alias("std_deviation"),
    )


def value_diversity(
    df: DataFrame,
    fields: list[str],
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
) -> DataFrame:
    """Values and about how many differ, per field; a ``ratio`` near 1 marks free text or a key.

    Measures what the name-based advice on text fields can only guess.
    """
    rows = matching(df, where, from_ts, to_ts, ts_field)
    sketches = []
    for path in fields:
        column = column_at(rows, path)
        sketches += [
            F.struct(
                F.lit(path).alias("field"),
                F.count(column).alias("doc_count"),
                F.approx_count_distinct(column).alias("about_distinct"),
            )
        ]
    summary = rows.agg(F.array(*sketches).alias("per_field"))
    ratio = F.col("about_distinct") / F.nullif(F.col("doc_count"), F.lit(0))
    return summary.select(F.inline("per_field")).withColumn("ratio", ratio)

