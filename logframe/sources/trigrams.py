"""Files that a wildcard can match, by a Bloom filter of the trigrams in each."""

from __future__ import annotations

import functools
import operator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logframe.functions.fields import field
from logframe.functions.predicates import wildcard, wildcard_runs

# Bits of a filter are kept in bitmaps of Spark's own size.
BITMAP_BITS = 8 * 4096

# Bitmaps of a file's filter: 16 have 64 kB and hold some 100,000 different trigrams.
BITMAPS = 16

# Bits that a trigram sets, each by another hash.
HASHES = 2


def _bit(trigram: Column, nr: int, bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(trigram, F.lit(nr)), F.lit(bitmaps * BITMAP_BITS))


def index_trigrams(df: DataFrame, column: str, bitmaps: int = BITMAPS) -> DataFrame:
    """``(file, bitmap, bits)``: for each file of a table a Bloom filter of its texts' trigrams.

    Write it next to the table and hand what is read back to :func:`scan_like`.
    Trigrams are unfolded and set in the task that reads them; what is shuffled
    is at most ``bitmaps`` bitmaps of 4 kB per file and task. Three characters
    in a row of any text count, in upper and lower case as they are.
    """
    text = field(df, column)
    rows = df.select(F.col("_metadata.file_path").alias("file"), text.alias("text")).filter(F.char_length("text") >= 3)
    starts = F.sequence(F.lit(1), F.char_length("text") - 2)
    found = rows.select("file", "text", F.explode(starts).alias("at")).select(
        "file", F.substring("text", F.col("at"), F.lit(3)).alias("trigram")
    )
    bits = F.explode(F.array(*[_bit(F.col("trigram"), nr, bitmaps) for nr in range(HASHES)]))
    return (
        found.select("file", bits.alias("bit"))
        .groupBy("file", F.floor(F.col("bit") / BITMAP_BITS).cast("int").alias("bitmap"))
        .agg(F.bitmap_construct_agg(F.pmod("bit", F.lit(BITMAP_BITS))).alias("bits"))
    )


def required_trigrams(pattern: str) -> list[str]:
    """What every text that matches a wildcard has: the trigrams of its runs without ``*`` and ``?``."""
    return list(
        dict.fromkeys(run[i : i + 3] for run in wildcard_runs(pattern) for i in range(len(run) - 2))
    )


def files_like(index: DataFrame, pattern: str, bitmaps: int = BITMAPS) -> DataFrame | None:
    """The files (``file``) that may have a match; None where the pattern requires no trigram.

    A file whose filter lacks one of the required trigrams' bits has no match
    for certain.
    """
    trigrams = required_trigrams(pattern)
    if not trigrams:
        return None
    bits = [_bit(F.lit(trigram), nr, bitmaps) for trigram in trigrams for nr in range(HASHES)]

    def has(bit: Column) -> Column:
        """Whether the bit is set, in a row of its bitmap."""
        place = F.pmod(bit, F.lit(BITMAP_BITS))
        byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        shifted = F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int"))
        mine = F.col("bitmap") == F.floor(bit / BITMAP_BITS).cast("int")
        return F.max(mine & (shifted.bitwiseAND(F.lit(1)) == 1))

    checks = index.groupBy("file").agg(*[has(bit).alias(f"_has{n}") for n, bit in enumerate(bits)])
    return checks.filter(
        functools.reduce(operator.and_, [F.col(f"_has{n}") for n in range(len(bits))])
    ).select("file")


def scan_like(
    spark: SparkSession, path: str, index: DataFrame, column: str, pattern: str, bitmaps: int = BITMAPS
) -> DataFrame:
    """Rows of the Parquet table at ``path`` whose column matches a wildcard, from the files that may have any.

    The same rows as by :func:`wildcard` on the whole table. Files are tested
    first, a job over the index; their names come to the driver, which lists
    a table's files in any case. Files that came after the index was built are
    in no filter and must be indexed before they are found.
    """
    whole = spark.read.parquet(path)
    found = files_like(index, pattern, bitmaps)
    if found is not None:
        names = sorted(row["file"] for row in found.collect())
        # The metadata column writes paths as addresses.
        names = [unquote(name) for name in names]
        if not names:
            return whole.filter(F.lit(False))
        whole = spark.read.schema(whole.schema).option("basePath", path).parquet(*names)
    return whole.filter(wildcard(whole, column, pattern))
