"""Dotted field paths over nested or already flattened tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def find_field(df: DataFrame, path: str) -> tuple[Column, T.DataType] | None:
    """Resolve ``path`` against the schema; ``None`` when it is absent.

    A column literally named ``a.b`` (as made by :func:`flatten`) is preferred
    over member ``b`` of struct ``a``.
    """
    parts = path.split(".")
    for cut in range(len(parts), 0, -1):
        head = ".".join(parts[:cut])
        if head not in df.columns:
            continue
        dtype = df.schema[head].dataType
        for name in parts[cut:]:
            dtype = _member(dtype, name)
            if dtype is None:
                return None
        reference = ".".join([quoted(head)] + [quoted(p) for p in parts[cut:]])
        return F.col(reference), dtype
    return None


def _member(dtype: T.DataType, name: str) -> T.DataType | None:
    if isinstance(dtype, T.StructType):
        return dtype[name].dataType if name in dtype.names else None
    if isinstance(dtype, T.ArrayType):
        inner = _member(dtype.elementType, name)
        return T.ArrayType(inner) if inner is not None else None
    return None


def field(df: DataFrame, path: str) -> Column:
    """The column at ``path``; an unknown path is an error."""
    found = find_field(df, path)
    if found is None:
        raise ValueError(f"no field {path!r} in columns {df.columns}")
    return found[0]


def field_type(df: DataFrame, path: str) -> T.DataType:
    found = find_field(df, path)
    if found is None:
        raise ValueError(f"no field {path!r} in columns {df.columns}")
    return found[1]


def is_array(df: DataFrame, path: str) -> bool:
    return isinstance(field_type(df, path), T.ArrayType)


def walk(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Every path in the schema, parents before their children."""
    for member in schema.fields:
        path = f"{prefix}.{member.name}" if prefix else member.name
        yield path, member.dataType
        dtype = member.dataType
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if isinstance(dtype, T.StructType):
            yield from walk(dtype, path)


def leaves(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Paths that hold a value: structs are descended, lists stay whole."""
    for member in schema.fields:
        path = f"{prefix}.{member.name}" if prefix else member.name
        if isinstance(member.dataType, T.StructType):
            yield from leaves(member.dataType, path)
        else:
            yield path, member.dataType


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as top-level columns named by their dotted path."""
    return df.select(*[field(df, path).alias(path) for path, _ in leaves(df.schema)])
