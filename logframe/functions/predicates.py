"""Row predicates as boolean columns.

Each builder takes the table first, so that a dotted path can be resolved
against its schema and array fields recognised. A field the table lacks
matches nothing, as a document without the field would.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.fields import field, field_type, find_field, walk
from logframe.functions.text import has_any_word, has_words_in_a_row, query_words
from logframe.functions.times import parse_window, time_column, time_literal

Condition = Column | str | None


def match_all() -> Column:
    return F.lit(True)


def condition(where: Condition) -> Column:
    """``None``, ``""`` and ``"*"`` keep every row; other text is a Spark SQL condition."""
    if where is None:
        return match_all()
    if isinstance(where, str):
        return match_all() if where.strip() in ("", "*") else F.expr(where)
    return where


def _test(df: DataFrame, path: str, check: Callable[[Column], Column]) -> Column:
    """``check`` on a value, or on any element of an array value."""
    found = find_field(df, path)
    if found is None:
        return F.lit(False)
    column, dtype = found
    return F.exists(column, check) if isinstance(dtype, T.ArrayType) else check(column)


def _literal(value, dtype: T.DataType) -> Column:
    """``value`` to compare with a column; one that its type cannot hold equals nothing."""
    if isinstance(value, Column):
        return value
    if isinstance(dtype, T.StringType):
        return F.lit(value if isinstance(value, str) else F.lit(value).cast("string"))
    if isinstance(dtype, T.NumericType) and not isinstance(value, (str, bool)):
        return F.lit(value)
    return F.lit(value).try_cast(dtype)


def term(df: DataFrame, path: str, value) -> Column:
    """The field, or one element of an array field, equals ``value``."""
    found = find_field(df, path)
    if found is None:
        return F.lit(False)
    column, dtype = found
    if isinstance(dtype, T.ArrayType):
        wanted = F.lit(value).try_cast(dtype.elementType)
        return F.coalesce(F.array_contains(column, wanted), F.when(column.isNotNull(), False))
    return column == _literal(value, dtype)


def phrase(df: DataFrame, path: str, text: str, analyzed: bool = False) -> Column:
    """Exact value of a keyword field, or with ``analyzed`` the words of ``text`` in a row."""
    if not analyzed:
        return term(df, path, text)
    words = query_words(text)
    return _test(df, path, lambda c: has_words_in_a_row(c, words))


def between(df: DataFrame, path: str | Column, low=None, high=None) -> Column:
    """Inclusive range; ``None`` or ``"*"`` leaves an end open.

    A column may stand in for the path; a computed one, such as from
    :func:`json_field`, is computed once, not once for each end. Numbers are
    compared with a text column as numbers, text that is none is outside.
    """
    low = None if isinstance(low, str) and low == "*" else low
    high = None if isinstance(high, str) and high == "*" else high
    if low is None and high is None:
        return path.isNotNull() if isinstance(path, Column) else exists(df, path)

    numbers = any(isinstance(end, (int, float)) for end in (low, high) if end is not None)

    def inside(column: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StringType) and numbers:
            column, dtype = column.try_cast("double"), T.DoubleType()
        checks = []
        if low is not None:
            checks.append(column >= _literal(low, dtype))
        if high is not None:
            checks.append(column <= _literal(high, dtype))
        return all_of(*checks)

    if isinstance(path, Column):
        dtype = df.select(path).schema[0].dataType
        # A member of a variant is read by the scan, which then gets the range too.
        if re.fullmatch(r"Column<'([\w.@`]+|try_variant_get\([\w.@`]+, [^()]*\))'>", str(path)):
            return inside(path, dtype)
        return F.exists(F.array(path), lambda column: inside(column, dtype))
    found = find_field(df, path)
    if found is None:
        return F.lit(False)
    dtype = found[1].elementType if isinstance(found[1], T.ArrayType) else found[1]
    return _test(df, path, lambda column: inside(column, dtype))


def wildcard(df: DataFrame, path: str, pattern: str) -> Column:
    """``*`` any run, ``?`` one character, backslash takes the next one literally.

    Written as LIKE, which Catalyst turns into a pushed-down prefix, suffix or
    substring test where the pattern allows it.
    """
    like = "".join(
        {"*": "%", "?": "_"}[char] if special else "\\" + char if char in "%_\\" else char
        for char, special in _wildcard_parts(pattern)
    )
    return _test(df, path, lambda c: c.like(like))


def _wildcard_parts(pattern: str) -> list[tuple[str, bool]]:
    """Each character that the pattern means, and whether it is a wildcard; a last backslash means itself."""
    parts, literal = [], False
    for char in pattern:
        if not literal and char == "\\":
            literal = True
            continue
        parts.append((char, not literal and char in "*?"))
        literal = False
    if literal:
        parts.append(("\\", False))
    return parts


def wildcard_runs(pattern: str) -> list[str]:
    """The pattern's longest pieces without a wildcard, as they stand in every text that matches."""
    runs = [""]
    for char, special in _wildcard_parts(pattern):
        if special:
            runs.append("")
        else:
            runs[-1] += char
    return [run for run in runs if run]


def text_fields(df: DataFrame) -> list[str]:
    """Every path that holds text, at any depth and in arrays."""
    found = []
    for path, _ in walk(df.schema):
        dtype = field_type(df, path)
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if isinstance(dtype, T.StringType):
            found.append(path)
    return found


def match_text(df: DataFrame, paths: str | list[str] | None, words, mode: str = "any") -> Column:
    """Free-text search: ``any`` or ``all`` of the words, or the words as a ``phrase``.

    With several fields the words may be spread over them, except for a phrase.
    ``paths=None`` searches every text field of the table.
    """
    if mode not in ("any", "all", "phrase"):
        raise ValueError(f"mode must be any, all or phrase, not {mode!r}")
    paths = text_fields(df) if paths is None else [paths] if isinstance(paths, str) else list(paths)
    if mode == "phrase":
        text = words if isinstance(words, str) else " ".join(words)
        found = [phrase(df, p, text, analyzed=True) for p in paths]
        return any_of(*[F.coalesce(p, F.lit(False)) for p in found])
    found = [find_field(df, p) for p in paths]
    texts = [
        F.array_join(c, " ") if isinstance(t, T.ArrayType) else c
        for c, t in filter(None, found)
    ]
    if not texts:
        return F.lit(False)
    # concat_ws skips missing fields instead of losing the row.
    text = texts[0] if len(texts) == 1 else F.concat_ws(" ", *texts)
    asked = list(dict.fromkeys(query_words(words)))
    if mode == "any":
        return has_any_word(text, asked)
    return all_of(*[has_any_word(text, [word]) for word in asked])


def exists(df: DataFrame, path: str) -> Column:
    """The row has a value here; an empty array is no value."""
    found = find_field(df, path)
    if found is None:
        return F.lit(False)
    column, dtype = found
    present = column.isNotNull()
    return present & (F.size(column) > 0) if isinstance(dtype, T.ArrayType) else present


def all_of(*predicates: Column) -> Column:
    return functools.reduce(operator.and_, predicates) if predicates else match_all()


def any_of(*predicates: Column) -> Column:
    return functools.reduce(operator.or_, predicates) if predicates else F.lit(False)


def none_of(*predicates: Column) -> Column:
    """No predicate holds; one that is NULL for lack of a value does not hold."""
    return all_of(*[~F.coalesce(p, F.lit(False)) for p in predicates])


def json_field(df: DataFrame, path: str, inner: str, dtype: str = "string") -> Column:
    """A dotted member of a JSON text column or variant, NULL when absent or of another type."""
    found = find_field(df, path)
    if found is None:
        return F.lit(None).cast(dtype)
    column, column_type = found
    location = "$." + inner
    if isinstance(column_type, T.VariantType):
        return F.try_variant_get(column, location, dtype)
    return F.get_json_object(column, location).try_cast(dtype)


def time_range(df: DataFrame, ts_field: str, from_ts=None, to_ts=None) -> Column:
    """Both ends inclusive and optional; without either every row matches.

    A time field that no scanned table has is an error, not an empty result.
    """
    start, end = parse_window(from_ts, to_ts)
    if start is None and end is None:
        return match_all()
    column, dtype = time_column(df, ts_field)
    bounds = []
    if start is not None:
        bounds.append(column >= time_literal(dtype, start))
    if end is not None:
        bounds.append(column <= time_literal(dtype, end))
    return all_of(*bounds)


def day_range(df: DataFrame, day_column: str, from_ts=None, to_ts=None) -> Column:
    """Days that a time range touches, on a date column.

    For tables partitioned by day: added to a time range as a condition it
    skips the other partitions, whose files are then never opened.
    """
    start, end = parse_window(from_ts, to_ts)
    day = field(df, day_column)
    bounds = []
    if start is not None:
        bounds.append(day >= F.lit(start.date()))
    if end is not None:
        bounds.append(day <= F.lit(end.date()))
    return all_of(*bounds)


def matching(
    df: DataFrame,
    where: Condition = None,
    from_ts=None,
    to_ts=None,
    ts_field: str = "@timestamp",
) -> DataFrame:
    """The rows every filtered operator starts from."""
    return df.filter(time_range(df, ts_field, from_ts, to_ts)).filter(condition(where))
