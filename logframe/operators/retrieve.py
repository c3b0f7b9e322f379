"""Pages of matching rows, and how many there are."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.fields import field, find_field, quoted
from logframe.functions.guards import page_bounds
from logframe.functions.predicates import Condition, matching
from logframe.operators.rank import order_of, ordered, ordered_page

CURSOR = "_cursor"


def search(
    df: DataFrame,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    limit: int = 50,
    offset: int = 0,
    sort_field: str | None = None,
    sort_dir: str = "desc",
    source_fields: list[str] | None = None,
    key: str | list[str] | None = None,
    limit_cap: int | None = None,
) -> DataFrame:
    """One page of matching rows, newest first unless told otherwise.

    Rows without the sort field come last in both directions. ``key`` names
    the column, or columns, that break ties; without it rows that tie may
    change places between pages. ``source_fields`` the table lacks are left
    out of the result. As many rows come as are asked for; a limit over
    ``limit_cap`` is an error where one is given.
    """
    limit, offset = page_bounds(limit, offset, limit_cap)
    rows = matching(df, where, from_ts, to_ts, ts_field)
    ties = [key] if isinstance(key, str) else key or []
    narrow, names = _narrow(rows, sort_field or ts_field, ties, sort_dir, source_fields)
    page = ordered_page(narrow, names[0], names[1:], sort_dir == "desc", offset, limit)
    return page.drop(*names)


def _narrow(
    rows: DataFrame, sort_field: str, ties: list[str], sort_dir: str, source_fields: list[str] | None
) -> tuple[DataFrame, list[str]]:
    """Only what is shown or sorted by, and the names of the columns of the order: the rest is not carried along."""
    if sort_dir not in ("asc", "desc"):
        raise ValueError(f"sort_dir must be asc or desc, not {sort_dir!r}")
    if source_fields:
        shown = [field(rows, path).alias(path) for path in source_fields if find_field(rows, path) is not None]
    else:
        shown = [F.col(quoted(name)) for name in rows.columns]
    helpers = {"_by": field(rows, sort_field)}
    helpers |= {f"_tie{n}": field(rows, path) for n, path in enumerate(ties)}
    return rows.select(*shown, *[c.alias(name) for name, c in helpers.items()]), list(helpers)


def search_after(
    df: DataFrame,
    cursor: str | Sequence | None = None,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
    limit: int = 50,
    sort_field: str | None = None,
    sort_dir: str = "desc",
    source_fields: list[str] | None = None,
    key: str | list[str] = "_id",
    limit_cap: int | None = None,
) -> DataFrame:
    """The page that follows a row, in the order of :func:`search`, with each row's own ``_cursor``.

    ``cursor`` is the ``_cursor`` of the last row of the page before, or the
    values of that row's sort field and key; None starts at the first page.
    It becomes a condition on these columns, which the scan gets too, and the
    page a top-k of what is left: a page costs the same however far down it is,
    and rows that come in meanwhile do not shift it. ``key`` has to tell rows
    apart that tie: of rows that agree with the cursor in all its columns none
    follows. Rows without the sort field come last, those without a key first
    among their equals, as in :func:`search`.
    """
    limit, _ = page_bounds(limit, 0, limit_cap)
    ties = [key] if isinstance(key, str) else list(key)
    if not ties:
        raise ValueError("pages that continue need a key that tells rows apart")
    rows = matching(df, where, from_ts, to_ts, ts_field)
    narrow, names = _narrow(rows, sort_field or ts_field, ties, sort_dir, source_fields)
    kinds = [narrow.schema[name].dataType for name in names]
    if cursor is not None:
        values = json.loads(cursor) if isinstance(cursor, str) else list(cursor)
        if len(values) != len(names):
            raise ValueError(f"a cursor of {len(values)} values for an order by {len(names)} columns")
        given = [None if value is None else _value(value, kind) for value, kind in zip(values, kinds)]
        narrow = narrow.filter(_follows(names, given, sort_dir == "desc"))
    text = F.to_json(F.array(*[_text(F.col(name), kind) for name, kind in zip(names, kinds)]))
    narrow = narrow.withColumn(CURSOR, text)
    return ordered(narrow, order_of(names[0], names[1:], sort_dir == "desc"), limit).limit(limit).drop(*names)


def _text(column: Column, kind: T.DataType) -> Column:
    """A value as text that is read back to the same value in any session."""
    if isinstance(kind, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, T.BinaryType):
        column = F.base64(column)
    return column.cast("string")


def _value(value, kind: T.DataType) -> Column:
    """A cursor's value as a constant of the column's type; text is what :func:`_text` made or what casts to it."""
    if isinstance(value, str) and isinstance(kind, T.TimestampType) and value.lstrip("-").isdigit():
        return F.timestamp_micros(F.lit(int(value)))
    if isinstance(value, str) and isinstance(kind, T.BinaryType):
        return F.unbase64(F.lit(value))
    return F.lit(value).cast(kind)


def _follows(names: list[str], values: list[Column | None], descending: bool) -> Column:
    """Whether a row comes after the values: first column up or down with NULLs last, others up with NULLs first."""
    later = F.lit(False)
    for name, value in reversed(list(zip(names[1:], values[1:]))):
        column = F.col(name)
        if value is None:
            later = column.isNotNull() | (column.isNull() & later)
        else:
            later = (column > value) | ((column == value) & later)
    column, value = F.col(names[0]), values[0]
    if value is None:
        return column.isNull() & later
    beyond = column < value if descending else column > value
    return beyond | ((column == value) & later) | column.isNull()


def walk(df: DataFrame, *args, pages: int | None = None, limit: int = 50, **kwargs) -> Iterator[DataFrame]:
    """Page after page by :func:`search_after`, until one is not full or there were ``pages`` of them.

    Each is lazy; going on to the next reads the last row's cursor, which runs
    the page's query.
    """
    cursor, done = kwargs.pop("cursor", None), 0
    while pages is None or done < pages:
        page = search_after(df, cursor, *args, limit=limit, **kwargs)
        yield page
        done += 1
        if pages is not None and done >= pages:
            return
        cursors = page.select(CURSOR).collect()
        if len(cursors) < limit or not cursors:
            return
        cursor = cursors[-1][0]


def count(
    df: DataFrame,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
) -> DataFrame:
    """How many rows match, as one row."""
    return matching(df, where, from_ts, to_ts, ts_field).agg(F.count(F.lit(1)).alias("count"))


def search_total(
    df: DataFrame,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
) -> DataFrame:
    """All matches of a search, whatever its page; always exact."""
    return count(df, where, from_ts, to_ts, ts_field).withColumnRenamed("count", "total")
