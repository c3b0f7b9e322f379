"""Fields that rows really hold, with nested and JSON members."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.fields import field, field_type, leaves
from logframe.functions.guards import sample_bound
from logframe.functions.predicates import Condition, matching

_FOUND = "array<struct<field:string,type:string>>"
_OPEN = "array<struct<path:string,value:variant,type:string>>"


def discover_fields(
    df: DataFrame,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    sample_size: int | None = 10,
    json_fields: tuple[str, ...] | list[str] = (),
    key: str | None = None,
) -> DataFrame:
    """Fields seen in the newest rows, and in how many: ``(field, type, n_docs)`` by field.

    A field without a value in the sample is not listed, and one that holds
    several types has a row for each. Columns named in ``json_fields`` (JSON
    text or variant) are opened at every depth. ``sample_size=None`` looks at
    all matching rows.
    """
    rows = matching(df, where, from_ts, to_ts, ts_field)
    typed = [(p, t) for p, t in leaves(df.schema) if p not in json_fields]
    if sample_size is not None:
        size = sample_bound(sample_size)
        order = [field(df, ts_field).desc_nulls_last()]
        if key is not None:
            order.append(field(df, key).asc())
        rows = rows.orderBy(*order).limit(size)
        seen = [_if_present(rows, path, dtype) for path, dtype in typed]
        found = F.array_compact(F.array(*seen)) if seen else F.array().cast(_FOUND)
        found = F.concat(found, *[_json_leaves(rows, path) for path in json_fields])
        counted = _counted(rows, found)
    else:
        counted = _column_counts(rows, typed)
        for path in json_fields:
            opened = _shape_counts(rows, path)
            counted = opened if counted is None else counted.unionByName(opened)
    return counted.orderBy("field", "type")


def _counted(rows: DataFrame, found: Column) -> DataFrame:
    return rows.select(F.inline(found)).groupBy("field", "type").agg(
        F.count(F.lit(1)).alias("n_docs")
    )


def _if_present(rows: DataFrame, path: str, dtype: T.DataType) -> Column:
    entry = F.struct(F.lit(path).alias("field"), F.lit(dtype.simpleString()).alias("type"))
    return F.when(field(rows, path).isNotNull(), entry)


def _column_counts(rows: DataFrame, typed: list[tuple[str, T.DataType]]) -> DataFrame | None:
    """All columns counted in one aggregate row, which is then turned on its side."""
    if not typed:
        return None
    entries = [
        F.struct(
            F.lit(path).alias("field"),
            F.lit(dtype.simpleString()).alias("type"),
            F.count(field(rows, path)).alias("n_docs"),
        )
        for path, dtype in typed
    ]
    return rows.agg(F.array(*entries).alias("e")).select(F.inline("e")).filter("n_docs > 0")


def _shape_counts(rows: DataFrame, path: str) -> DataFrame:
    """Leaves of a JSON column in all rows: values of one shape have the same ones, so one is opened."""
    column = field(rows, path)
    is_variant = isinstance(field_type(rows, path), T.VariantType)
    shapes = (
        rows.select(
            (F.to_json(column) if is_variant else column).alias("json"),
            F.schema_of_variant(column if is_variant else F.try_parse_json(column)).alias("shape"),
        )
        .filter("shape is not null")
        .groupBy("shape")
        .agg(F.any_value("json").alias("json"), F.count(F.lit(1)).alias("n"))
    )
    leaves = shapes.select(F.inline(_json_leaves(shapes, "json", path)), "n")
    return leaves.groupBy("field", "type").agg(F.sum("n").alias("n_docs"))


def _json_leaves(rows: DataFrame, path: str, name: str | None = None) -> Column:
    """``(field, type)`` of every leaf of a JSON value, called ``name``; NULL and bad JSON have none.

    Opens one level of objects per step. The text cannot nest deeper than its
    opening braces, and steps with nothing left to open cost next to nothing.
    """
    column = field(rows, path)
    if isinstance(field_type(rows, path), T.VariantType):
        text, value = F.to_json(column), column
    else:
        text, value = column, F.try_parse_json(column)
    braces = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    is_object = lambda entry: F.startswith(entry["type"], F.lit("object<"))
    members = lambda value: F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))

    def member(parent: Column) -> Callable[[Column], Column]:
        return lambda m: _entry(F.concat(parent["path"], F.lit("."), m["key"]), m["value"])

    def sorted_out(entries: Column, found: Column) -> Column:
        """Objects to open next, and everything else added to what was found."""
        leaf = lambda e: F.struct(e["path"].alias("field"), e["type"])
        more = F.transform(F.filter(entries, lambda e: ~is_object(e)), leaf)
        return F.struct(
            F.filter(entries, is_object).cast(_OPEN).alias("open"),
            F.concat(found, more).cast(_FOUND).alias("found"),
        )

    def opened(state: Column, _: Column) -> Column:
        children = F.flatten(
            F.transform(
                state["open"], lambda e: F.transform(members(e["value"]), member(e))
            )
        )
        # The one-element array gives the children a name, so they are made once.
        step = F.transform(F.array(children), lambda c: sorted_out(c, state["found"]))
        return F.when(F.size(state["open"]) == 0, state).otherwise(F.get(step, F.lit(0)))

    nothing = F.array().cast(_FOUND)
    levels = F.sequence(F.lit(1), F.greatest(braces, F.lit(1)))

    def all_below(root: Column) -> Column:
        return F.aggregate(levels, sorted_out(F.array(root), nothing), opened)["found"]

    # Again an array only to have a name: the text is parsed once.
    found = F.transform(F.array(_entry(F.lit(name or path), value)), all_below)
    return F.when(value.isNotNull(), F.get(found, F.lit(0))).otherwise(nothing)


def _entry(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"), _json_type(value).alias("type"))


def _json_type(value: Column) -> Column:
    """Spark's name of a JSON value's type; all fractions are doubles whatever their digits."""
    name = F.lower(F.schema_of_variant(value))
    return F.regexp_replace(name, r"decimal\([0-9]+,[0-9]+\)", "double")
