"""Ordered pages and top values, kept out of a single task however deep they go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.functions.times import EPOCH, time_literal

# Up to this many rows an order is a merge of every task's own best rows, which
# are held in memory; a longer one is cut into ranges of the sort key first.
MERGED_ROWS = 10_000

# Marks that a deep page is looked for between, twice, and how exact they are.
CELLS = 256
ACCURACY = 10 * CELLS

# Parts that a group's rows are ranked in before its own best rows are, where
# more rows of a group than this may come together from all tasks.
PARTS = 64
GROUP_ROWS = 100_000


def ordered(df: DataFrame, order: list[Column], most: int | None) -> DataFrame:
    """All rows in order, or the first ``most``."""
    return df.orderBy(*order) if most is None or most > MERGED_ROWS else df.orderBy(*order).limit(most)


def order_of(by: str, ties: list[str], descending: bool) -> list[Column]:
    """One column up or down with NULLs last, then others up."""
    first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return [first, *[F.asc(name) for name in ties]]


def ordered_page(
    df: DataFrame, by: str, ties: list[str], descending: bool, offset: int, limit: int
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by one column, ties ascending by others, NULLs last.

    Lazy at any depth. Beyond ``MERGED_ROWS`` a page is enclosed between two
    marks (:func:`_enclosure`), and only the rows there, the page and some
    hundred-thousandths of all, are ranked. Of a long page only the rows around
    its two ends are; what lies between is taken as it is and sorted by all
    tasks.
    """
    order = order_of(by, ties, descending)
    if offset + limit <= MERGED_ROWS:
        return df.orderBy(*order).offset(offset).limit(limit)
    image, second = _images(df, by, ties, descending)
    if limit <= MERGED_ROWS:
        asked = lambda p: ~p["sure"] | _places(p["m"], image, second)[1]
        before = lambda p: F.when(p["sure"], p["before"]).otherwise(0)
        found = df.withColumn("_marks", _enclosure(df, image, second, offset, limit).scalar())
        ranked = found.filter(_about("_marks", asked)).withColumns(
            {"_group": F.lit(0), "_before": _about("_marks", before)}
        )
        between = None
    else:
        ends = F.struct(
            _enclosure(df, image, second, offset, 0).scalar().alias("head"),
            _enclosure(df, image, second, offset + limit, 0).scalar().alias("tail"),
        )

        def part(p: Column) -> Column:
            """0: in the first enclosure, or all must be ranked; 1: in the second alone; 2: between them; 3: outside."""
            under_head, in_head = _places(p["head"]["m"], image, second)
            under_tail, in_tail = _places(p["tail"]["m"], image, second)
            sure = p["head"]["sure"] & p["tail"]["sure"]
            middle = F.when(~under_head & under_tail, 2).otherwise(3)
            return F.when(~sure | in_head, 0).when(in_tail, 1).otherwise(middle)

        def before(p: Column) -> Column:
            """Rows ahead of those in a group; the second has what the first, before it, does not."""
            sure = p["head"]["sure"] & p["tail"]["sure"]
            after_head = p["head"]["before"] + p["head"]["rows"]
            tail = F.greatest(p["tail"]["before"], after_head)
            return F.when(~sure, 0).when(F.col("_group") == 1, tail).otherwise(p["head"]["before"])

        found = df.withColumn("_marks", ends).withColumn("_group", _about("_marks", part))
        ranked = found.filter("_group < 2").withColumn("_before", _about("_marks", before))
        between = found.filter("_group = 2").select(*df.columns)
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    page = (
        ranked.withColumn("_place", place)
        .filter((F.col("_place") > offset) & (F.col("_place") <= offset + limit))
        .select(*df.columns)
    )
    return (page if between is None else page.unionByName(between)).orderBy(*order)


def _about(name: str, say: Callable[[Column], Column]) -> Column:
    """What ``say`` makes of a column; a subquery behind it stands in the plan once, however often it is used."""
    return F.element_at(F.transform(F.array(F.col(name)), say), 1)


def _enclosure(df: DataFrame, image: Column, second: Column, offset: int, limit: int) -> DataFrame:
    """One row: marks around the rows ``offset`` to ``offset + limit``, and how many rows come before and lie inside.

    The page is enclosed twice between two marks of a sketch of the sort key,
    or, where one key fills the first enclosure, of what follows it. Each of
    three rounds reads sort keys only and is one row, used by the next as a
    scalar subquery. ``sure`` is whether exact counts bear the sketches out;
    where they do not, the enclosure must not be used.
    """
    images = df.select(image.alias("_one"), second.alias("_two"))
    one, two, n = F.col("_one"), F.col("_two"), F.count(F.lit(1))
    around = images.agg(_marks_around(one, n, F.lit(0), offset, limit, n).alias("_a"))
    in_a = _within(one, F.col("_a.low"), F.col("_a.high"))
    own = F.when(in_a, F.when(_one_key(F.col("_a")), two).otherwise(one))
    before = F.count_if(one < F.col("_a.low"))
    closer = images.withColumn("_a", around.scalar()).agg(
        F.struct(
            F.any_value("_a").alias("a"),
            _marks_around(own, F.count_if(in_a), before, offset, limit, n).alias("b"),
        ).alias("_m")
    )
    under, within = _places(F.col("_m"), one, two)
    enough = F.count_if(under) + F.count_if(within) >= F.least(F.lit(offset + limit), n)
    return images.withColumn("_m", closer.scalar()).agg(
        F.struct(
            F.any_value("_m").alias("m"),
            F.count_if(under).alias("before"),
            F.count_if(within).alias("rows"),
            ((F.count_if(under) <= offset) & enough).alias("sure"),
        ).alias("_page")
    )


def _places(marks: Column, one: Column, two: Column) -> tuple[Column, Column]:
    """Whether a row comes before both enclosures, and whether it lies in both."""
    a, b = marks["a"], marks["b"]
    own = F.when(_one_key(a), two).otherwise(one)
    inside = _within(one, a["low"], a["high"])
    return (one < a["low"]) | (inside & (own < b["low"])), inside & _within(own, b["low"], b["high"])


def _within(column: Column, low: Column, high: Column) -> Column:
    return (column >= low) & (column <= high)


def _marks_around(
    image: Column, rows: Column, before: Column, offset: int, limit: int, total: Column
) -> Column:
    """The marks around a page, a cell further out than it needs; ``before`` rows come ahead of the image's."""
    # One constant, where a list would be hundreds of them in every plan.
    shares = F.split(F.lit(",".join(str(i / CELLS) for i in range(1, CELLS))), ",").cast("array<double>")
    marks = F.percentile_approx(image, shares, F.lit(ACCURACY))
    rows = F.greatest(rows, F.lit(1))
    low = F.floor((F.lit(offset) - before) * CELLS / rows).cast("int") - 2
    last = F.least(F.lit(offset + limit), total)
    high = F.ceil((last - before) * CELLS / rows).cast("int")
    return F.struct(
        F.coalesce(F.when(low >= 0, F.get(marks, F.least(low, F.lit(CELLS - 2)))), F.lit(float("-inf"))).alias("low"),
        F.coalesce(F.when(high >= 0, F.get(marks, high)), F.lit(float("inf"))).alias("high"),
    )


def _images(df: DataFrame, by: str, ties: list[str], descending: bool) -> tuple[Column, Column]:
    """Two doubles that rise along the order, the second among rows whose first is the same number.

    The second stands for the first tie, or for what follows the first bytes
    of a text. Keys that a double cannot tell apart share the first's largest
    values, infinity among them, where the second is not asked for.
    """
    turned = (lambda x: -x) if descending else lambda x: x
    key, kind = F.col(by), df.schema[by].dataType
    first = F.coalesce(turned(_image(key, kind)), F.lit(float("inf")))
    if isinstance(kind, _EXACT):
        second = _image(F.col(ties[0]), df.schema[ties[0]].dataType) if ties else F.lit(0.0)
    else:
        second = turned(_image(F.substring(key.cast("string").cast("binary"), 7, 6), T.BinaryType()))
    return first, F.coalesce(second, F.lit(float("-inf")))


# Types whose image tells all keys apart, below EXACT_BELOW.
_EXACT = (T.IntegralType, T.DoubleType, T.FloatType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
EXACT_BELOW = 2.0**53


def _one_key(marks: Column) -> Column:
    """Whether the first image says all that it can about the rows between the marks."""
    return (marks["low"] == marks["high"]) & (F.abs(marks["low"]) < EXACT_BELOW)


def _image(column: Column, dtype: T.DataType) -> Column:
    """A double that does not fall where the column's order rises; NULL for NULL."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nanvl(column.cast("double"), F.lit(float("inf")))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("MICROSECOND", time_literal(dtype, EPOCH), column).cast("double")
    # The first six bytes of text, as a number.
    head = column if isinstance(dtype, T.BinaryType) else column.cast("string").cast("binary")
    return F.conv(F.rpad(F.hex(F.substring(head, 1, 6)), 12, "0"), 16, 10).cast("double")


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], size: int, own_size: Column | None = None
) -> DataFrame:
    """The first ``size`` rows of each group.

    The literal bound lets every task drop all but its own best rows of a
    group before the shuffle. Where tasks are so many that what they send
    would still be a long list, it is ranked in parts first, so that it never
    meets in one task. ``own_size`` is a tighter bound that may differ by row.
    """
    tasks = max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        df.sparkSession.sparkContext.defaultParallelism,
    )
    if tasks * size > GROUP_ROWS:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))
        window = Window.partitionBy(*group, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn("_rank", F.row_number().over(window))
            .filter(F.col("_rank") <= size)
            .drop("_rank", "_part")
        )
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= size)
    if own_size is not None:
        ranked = ranked.filter(F.col("_rank") <= own_size)
    return ranked.drop("_rank")
