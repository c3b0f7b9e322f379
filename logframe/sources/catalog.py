"""Tables under a root folder: wildcard scans, listings, schemas and layout.

A table is a file or folder directly under the root, named with or without the
format's suffix. Days of one log kept as tables ``name-YYYY.MM.DD`` are read by
a single scan, so a year of them is not a union of 365 plans.
"""

from __future__ import annotations

import calendar
import fnmatch
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.fields import quoted, walk
from logframe.functions.predicates import day_range, wildcard
from logframe.functions.times import (
    parse_time,
    parse_window,
    time_column,
    time_literal,
    utc_day,
)
from logframe.operators.rank import ordered

INDEX = "_index"

# Fixed value: suffix of a table that holds one day.
DAY_SUFFIX = r"[0-9]{4}\.[0-9]{2}\.[0-9]{2}"


Pattern = str | list[str]


def _table_paths(spark: SparkSession, root: str, pattern: Pattern, fmt: str) -> dict[str, str]:
    """Name and path of each matching table, by one listing of the root folder."""
    patterns = [pattern] if isinstance(pattern, str) else pattern
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = {}
    for status in files.listStatus(folder):
        path = status.getPath()
        name = path.getName().removesuffix("." + fmt)
        if name.startswith((".", "_")):
            continue
        if any(fnmatch.fnmatchcase(name, p) for p in patterns):
            found[name] = path.toString()
    if not found:
        raise ValueError(f"no table matches {pattern!r} under {root}")
    return dict(sorted(found.items()))


def _families(paths: dict[str, str]) -> dict[str, list[str]]:
    """Table names by family: days of one log together, any other table alone."""
    families: dict[str, list[str]] = {}
    for name in paths:
        day = re.fullmatch(rf"([\w.\-]+)-{DAY_SUFFIX}", name, re.ASCII)
        families.setdefault(day[1] + "-*" if day else name, []).append(name)
    return families


def _read_family(
    spark: SparkSession, names: list[str], paths: dict[str, str], fmt: str, schema
) -> list[DataFrame]:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if len(names) > 1:
        merging = reader.option("mergeSchema", schema is None)
        location = F.col("_metadata.file_path")
        name = F.regexp_extract(location, rf"/([\w.\-]+-{DAY_SUFFIX})(\.{fmt})?(/|$)", 1)
        try:
            return [merging.load([paths[n] for n in names]).withColumn(INDEX, name)]
        except Exception as failure:  # PySpark passes this one on as the bridge's own error.
            if "[CANNOT_MERGE_SCHEMAS]" not in str(failure):
                raise
    # A single table, or days with a field whose type changed on the way.
    return [reader.load(paths[n]).withColumn(INDEX, F.lit(n)) for n in names]


def tables(
    spark: SparkSession, root: str, pattern: Pattern = "*", fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Each matching table on its own."""
    paths = _table_paths(spark, root, pattern, fmt)
    return {name: spark.read.format(fmt).load(path) for name, path in paths.items()}


def _in_window(name: str, from_ts, to_ts) -> bool:
    """Whether a table may hold rows of the window, by the day in its name if it has one."""
    day = re.search(rf"-({DAY_SUFFIX})$", name)
    if day is None:
        return True
    start, end = parse_window(from_ts, to_ts)
    first = start.strftime("%Y.%m.%d") if start else ""
    last = end.strftime("%Y.%m.%d") if end else "9999.99.99"
    return first <= day[1] <= last


def scan(
    spark: SparkSession,
    root: str,
    pattern: Pattern,
    fmt: str = "parquet",
    schema=None,
    from_ts=None,
    to_ts=None,
) -> DataFrame:
    """All tables that match a name, a wildcard or a list of them, told apart by ``_index``.

    Columns are matched by name, members of structs too, also inside arrays;
    missing ones are NULL. A value whose types cannot be widened to each other
    is read as text everywhere, alone, in the place where it is.
    ``schema`` skips schema inference, which for a family of daily tables
    reads the footer of every file. With ``from_ts`` or ``to_ts`` daily tables
    of other days are not opened at all; rows are not filtered by it.
    """
    paths = _table_paths(spark, root, pattern, fmt)
    paths = {n: path for n, path in paths.items() if _in_window(n, from_ts, to_ts)}
    if not paths:
        raise ValueError(f"no table matching {pattern!r} is of the days asked for")
    arms = [
        arm
        for names in _families(paths).values()
        for arm in _read_family(spark, names, paths, fmt, schema)
    ]
    return union_tables(arms)


def union_tables(arms: list[DataFrame]) -> DataFrame:
    """Tables one below the other, matched as :func:`scan` does."""
    kinds: dict[str, T.DataType] = {}
    for arm in arms:
        for member in arm.schema.fields:
            known = kinds.get(member.name)
            kinds[member.name] = member.dataType if known is None else _merged(known, member.dataType)
    merged = None
    for arm in arms:
        changed = {
            m.name: _as_type(F.col(quoted(m.name)), m.dataType, kinds[m.name])
            for m in arm.schema.fields
            if m.dataType != kinds[m.name]
        }
        arm = arm.withColumns(changed)
        merged = arm if merged is None else merged.unionByName(arm, allowMissingColumns=True)
    return merged


def _merged(one: T.DataType, other: T.DataType) -> T.DataType:
    """A type that holds values of both: structs member by member, numbers widened, else text."""
    if one == other:
        return one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        members = {m.name: m.dataType for m in one.fields}
        for m in other.fields:
            members[m.name] = _merged(members[m.name], m.dataType) if m.name in members else m.dataType
        return T.StructType([T.StructField(name, dtype) for name, dtype in members.items()])
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(_merged(one.elementType, other.elementType))
    if isinstance(one, T.NullType) or isinstance(other, T.NullType):
        return other if isinstance(one, T.NullType) else one
    if isinstance(one, T.IntegralType) and isinstance(other, T.IntegralType):
        return max(one, other, key=_INTEGERS.index)
    if isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        return T.DoubleType()
    return T.StringType()


_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def _as_type(column: Column, dtype: T.DataType, wanted: T.DataType) -> Column:
    if dtype == wanted:
        return column
    if isinstance(dtype, T.StructType) and isinstance(wanted, T.StructType):
        have = {m.name: m.dataType for m in dtype.fields}
        members = [
            _as_type(column[m.name], have[m.name], m.dataType).alias(m.name)
            if m.name in have
            else F.lit(None).cast(m.dataType).alias(m.name)
            for m in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*members))
    if isinstance(dtype, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: _as_type(x, dtype.elementType, wanted.elementType))
    return column.cast(wanted)


def scan_daily(
    df: DataFrame,
    name: str,
    pattern: str,
    ts_field: str = "@timestamp",
    day_column: str | None = None,
) -> DataFrame:
    """One table seen as daily tables ``name-YYYY.MM.DD`` and cut to a wildcard over them.

    The leading digits of the pattern also become a plain range on the time
    field, and on ``day_column`` (a date) where the table is partitioned by
    one, so whole row groups or partitions are skipped.
    """
    column, dtype = time_column(df, ts_field)
    days = F.replace(utc_day(column, dtype).cast("string"), F.lit("-"), F.lit("."))
    named = df.withColumn(INDEX, F.concat(F.lit(name + "-"), days))
    bounds = _day_bounds(name, pattern)
    if bounds is not None:
        first, last = bounds
        after = time_literal(dtype, parse_time(first))
        before = time_literal(dtype, parse_time(last + "T23:59:59.999999"))
        named = named.filter((column >= after) & (column <= before))
        if day_column is not None:
            named = named.filter(day_range(df, day_column, first, last))
        if re.fullmatch(r"[^*?\\]*\*", pattern):
            # The days that start with some digits are just those in the range.
            return named
    return named.filter(wildcard(named, INDEX, pattern))


def _day_bounds(name: str, pattern: str) -> tuple[str, str] | None:
    """First and last day that can match, from the literal start of the pattern."""
    literal = re.match(r"[^*?\\]*", pattern)[0]
    if not literal.startswith(name + "-"):
        return None
    digits = literal[len(name) + 1 :]
    lowest = digits + "0000.00.00"[len(digits) :]
    highest = digits + "9999.99.99"[len(digits) :]
    if not all(re.fullmatch(DAY_SUFFIX, day) for day in (lowest, highest)):
        return None
    year, month, day = (max(int(part), 1) for part in lowest.split("."))
    last_year, last_month, last_day = (int(part) for part in highest.split("."))
    last_month = min(last_month, 12)
    if month > 12 or day > calendar.monthrange(year, month)[1]:
        return None
    if min(last_year, last_month, last_day) < 1:
        return None
    last_day = min(last_day, calendar.monthrange(last_year, last_month)[1])
    return f"{year:04d}-{month:02d}-{day:02d}", f"{last_year:04d}-{last_month:02d}-{last_day:02d}"


def _named(path: Column, names: dict[str, str]) -> Column:
    """The table that a file belongs to, from its path: all tables lie right below one root."""
    plain = F.regexp_replace(path, "^file:/+", "file:/")
    root = re.sub("^file:/+", "file:/", next(iter(names.values()))).rpartition("/")[0]
    below = F.substring(plain, len(root) + 2, 1 << 30)
    return F.regexp_replace(F.substring_index(F.url_decode(below), "/", 1), r"\.parquet$", "")


def _file_totals(spark: SparkSession, root: str, pattern: Pattern) -> DataFrame:
    """Rows, files, bytes and file times of each table, without reading a data column.

    Files come from a listing, so those without rows count too; rows from one
    scan of no column over all tables.
    """
    paths = _table_paths(spark, root, pattern, "parquet")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths.values()))
        .select(
            _named(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")), paths).alias("index"),
            F.lit(0).cast("bigint").alias("rows"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("time"),
        )
    )
    # An empty schema: no column is read, and none has to be inferred.
    rows = spark.read.schema(T.StructType()).option("recursiveFileLookup", "true").parquet(*paths.values())
    counts = rows.groupBy(_named(F.col("_metadata.file_path"), paths).alias("index")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    counts = counts.select(
        "index",
        "rows",
        F.lit(None).cast("bigint").alias("bytes"),
        F.lit(None).cast("timestamp").alias("time"),
    )
    totals = (
        files.unionByName(counts)
        .groupBy("index")
        .agg(
            F.sum("rows").alias("doc_count"),
            F.count("bytes").alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("store_bytes"),
            F.min("time").alias("oldest_file"),
            F.max("time").alias("newest_file"),
        )
    )
    return ordered(totals, [F.asc("index")], len(paths))


def list_tables(spark: SparkSession, root: str, pattern: Pattern = "*") -> DataFrame:
    """Name, row count and stored bytes of each parquet table, by name."""
    totals = _file_totals(spark, root, pattern)
    return totals.select("index", "doc_count", "store_bytes")


def table_layout(spark: SparkSession, root: str, pattern: Pattern = "*") -> DataFrame:
    """How each parquet table is split into files, and when they were written."""
    totals = _file_totals(spark, root, pattern)
    return totals.select("index", "files", "store_bytes", "oldest_file", "newest_file")


def list_time_fields(
    spark: SparkSession, root: str, pattern: Pattern = "*", fmt: str = "parquet"
) -> DataFrame:
    """Each family of tables with its first time field: ``(id, title, time_field)``.

    Days of one log are one family ``name-*``, whose newest table is looked at.
    Timestamps come before dates, and top-level fields before nested ones.
    """
    paths = _table_paths(spark, root, pattern, fmt)
    rows = []
    for family, names in _families(paths).items():
        fields = list(walk(spark.read.format(fmt).load(paths[max(names)]).schema))
        title = family if len(names) > 1 else names[0]
        rows.append((title, title, _time_field(fields)))
    return spark.createDataFrame(rows, "id string, title string, time_field string")


def _time_field(fields: list[tuple[str, T.DataType]]) -> str | None:
    times = (T.TimestampType, T.TimestampNTZType)
    ranked = [
        (not isinstance(dtype, times), path.count("."), n, path)
        for n, (path, dtype) in enumerate(fields)
        if isinstance(dtype, (*times, T.DateType))
    ]
    return min(ranked)[-1] if ranked else None


def type_name(dtype: T.DataType) -> str:
    """Structs are objects; any other type keeps Spark's own name."""
    return "object" if isinstance(dtype, T.StructType) else dtype.simpleString()


def field_types(df: DataFrame, index: str) -> DataFrame:
    """Every field path with its type; a struct is listed itself, then its members."""
    rows = [(index, path, type_name(dtype)) for path, dtype in walk(df.schema)]
    return df.sparkSession.createDataFrame(rows, "index string, field string, type string")


def index_field_types(
    spark: SparkSession, root: str, pattern: Pattern = "*", fmt: str = "parquet"
) -> DataFrame:
    """:func:`field_types` of every matching table, which shows where a field's type drifts."""
    rows = [
        (name, path, type_name(dtype))
        for name, df in tables(spark, root, pattern, fmt).items()
        for path, dtype in walk(df.schema)
    ]
    return spark.createDataFrame(rows, "index string, field string, type string")
