"""Tables sorted along a space-filling curve, for ranges on several fields at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field, field_type
from logframe.operators.rank import _image

# Ranks of a field, as a power of two: cells of about equal rows, whatever its distribution.
RANK_BITS = 6


def write_zordered(
    df: DataFrame, path: str, fields: list[str], parts: int, bits: int = RANK_BITS
) -> DataFrame:
    """The table as Parquet at ``path``, rows that are near in all ``fields`` near each other; read back.

    Each field is ranked among quantiles of its values (times, numbers, text by
    its first six bytes); the ranks' bits, one of each field in turn, are a
    row's place on a Z-shaped curve, by which the rows are dealt to ``parts``
    files and sorted. A file and its row groups then hold a box of values, so
    that a range on any of the fields, or on several, skips most of them by
    the footers' least and greatest values. Rows without a value rank first.

    The quantiles are one row of ``2**bits`` numbers a field, from one pass over
    the fields alone; equal values share a rank, so that a value of many rows
    spreads along the other fields and not over all files.
    """
    if len(fields) < 2 or len(set(fields)) != len(fields):
        raise ValueError("an order of several fields needs two or more, each once")
    if not 1 <= bits <= 62 // len(fields):
        raise ValueError(f"{len(fields)} fields have at most {62 // len(fields)} bits each")
    images = {f"_f{n}": _image(field(df, name), field_type(df, name)) for n, name in enumerate(fields)}
    cells = 1 << bits
    shares = F.split(F.lit(",".join(str(i / cells) for i in range(1, cells))), ",").cast("array<double>")
    marks = df.agg(*[F.percentile_approx(image, shares, F.lit(10 * cells)).alias(name) for name, image in images.items()])
    found = marks.first()
    ranks = [_rank(image, sorted(set(found[name] or []))) for name, image in images.items()]
    place = _interleaved(ranks, bits)
    keyed = df.withColumn("_place", place)
    keyed.repartitionByRange(parts, "_place").sortWithinPartitions("_place").drop("_place").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _rank(image: Column, marks: list[float]) -> Column:
    """How many marks lie below the value, found by halving; 0 for none."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(image > F.lit(marks[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(image.isNull(), 0).otherwise(search(0, len(marks))).cast("bigint")


def _interleaved(ranks: list[Column], bits: int) -> Column:
    """One bit of each rank in turn, the highest first."""
    place = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for rank in ranks:
            own = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint"))
            place = F.shiftleft(place, 1).bitwiseOR(own)
    return place
