"""SimHash fingerprints of 64 bits, and all pairs of them within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logframe.llm.shared import WHITE

BITS = 64
# Two counters of 32 bits share a long: bit j's below, bit j + 32's above.
LANES = 0x0000_0001_0000_0001
LOW = 0xFFFF_FFFF


def terms(text: Column) -> Column:
    """Hashes come from pairs of neighbouring words, and the last word alone."""
    words = F.filter(F.split(F.lower(text), f"[{WHITE}]+"), lambda word: word != "")
    following = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    return F.arrays_zip(words.alias("one"), following.alias("two"))


def simhash(df: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """One fingerprint per text column, a long each, for every row: the keys and ``<text>_fp``.

    ``keys`` must tell rows apart. A term is a pair of neighbouring lower-cased
    words (a text's last word is one too), its weight how often it occurs. Each
    occurrence votes for the bits that its 64-bit hash sets and against the
    others; a fingerprint has the bits that won. A tie is 0, and so is every bit
    of a text without words (NULL, empty, white space).

    All terms of a text are in one task, so their votes are added up there, 32
    numbers a text, and only these are shuffled.
    """
    whole = df.select(*keys, F.posexplode(F.array(*[F.col(t) for t in texts])).alias("nr", "text"))
    votes = whole.select(*keys, "nr", F.explode_outer(terms(F.col("text"))).alias("term")).select(
        *keys, "nr", F.when(F.col("term").isNotNull(), F.xxhash64("term.one", "term.two")).alias("h")
    )
    sums = votes.groupBy(*keys, "nr").agg(
        F.count("h").alias("n"),
        *[
            F.sum(F.shiftright("h", j).bitwiseAND(F.lit(LANES))).alias(f"s{j}")
            for j in range(BITS // 2)
        ],
    )
    bits = [
        F.when(won * 2 > F.col("n"), F.lit(1 << bit if bit < 63 else -(1 << 63))).otherwise(0)
        for j in range(BITS // 2)
        for bit, won in (
            (j, F.col(f"s{j}").bitwiseAND(F.lit(LOW))),
            (j + 32, F.shiftrightunsigned(F.col(f"s{j}"), 32)),
        )
    ]
    fingerprint = F.lit(0).cast("long")
    for bit in bits:
        fingerprint = fingerprint.bitwiseOR(bit)
    prints = sums.select(*keys, "nr", fingerprint.alias("fp"))
    return prints.groupBy(*keys).agg(
        *[F.max(F.when(F.col("nr") == i, F.col("fp"))).alias(f"{t}_fp") for i, t in enumerate(texts)]
    )


def likeness(one: Column, other: Column) -> Column:
    """The share of equal bits of two fingerprints."""
    return 1 - F.bit_count(one.bitwiseXOR(other)) / F.lit(float(BITS))


def within_radius(prints: DataFrame, fp: str = "fp", radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs of different fingerprints at most ``radius`` bits apart: one, other, distance.

    The 64 bits are cut into ``blocks`` blocks. Whatever bits differ, they lie
    in at most ``radius`` blocks, so two fingerprints of a pair agree on some
    ``blocks - radius`` whole blocks. There is a table for every choice of so
    many blocks, with those blocks' bits as its key; a pair is kept by the
    first table that finds it. Equal fingerprints are one row before, so copies
    make no pairs. NULL fingerprints are left out.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError(f"radius {radius} must be under the number of blocks, {blocks}")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [
        sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        for chosen in combinations(range(blocks), blocks - radius)
    ]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    distinct = prints.select(F.col(fp).alias("fp")).filter("fp is not null").distinct()
    tables = distinct.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed]))
    ).toDF("fp", "nr", "key")
    differ = F.col("one").bitwiseXOR(F.col("other"))
    first = F.coalesce(
        *[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(signed)]
    )
    return (
        tables.withColumnRenamed("fp", "one")
        .join(tables.withColumnRenamed("fp", "other"), ["nr", "key"])
        .filter(F.col("one") < F.col("other"))
        .withColumn("distance", F.bit_count(differ).cast("int"))
        .filter((F.col("distance") <= radius) & (F.col("nr") == first))
        .select("one", "other", "distance")
    )


def order_marks(df: DataFrame, by: str) -> list[int]:
    """Values of an integer column that cut its rows into parts of about the same size.

    One per shuffle partition; the first is the least value of all.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(parts)]
    value = F.col(by)
    least, marks = df.agg(F.min(value), F.percentile_approx(value, shares, F.lit(10_000))).first()
    return sorted({least, *(marks or [])} - {None})


def with_next(df: DataFrame, by: str, ties: list[str], columns: list[str], marks: list[int]):
    """Each row with the columns ``next_...`` of the row after it; after the last comes the first.

    The rows are cut into ranges of ``by`` at values that occur; a row at such a
    value is also put at the end of the range before, so every range has the
    row after its last one and is put in order by itself.
    """
    if not marks:
        return df.withColumns({f"next_{name}": F.col(name) for name in columns})
    parts = len(marks)
    step = max(1, int(parts**0.5))
    fine, coarse = F.lit(marks), F.lit(marks[::step])
    row = F.greatest(F.size(F.filter(coarse, lambda x: x <= F.col(by))) - 1, F.lit(0)) * step
    part = row + F.size(F.filter(F.slice(fine, row + 1, F.lit(step)), lambda x: x <= F.col(by))) - 1
    starts = F.array_contains(fine, F.col(by))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    guest = F.struct(
        F.when(F.col("part") == 0, parts - 1).otherwise(F.col("part") - 1).alias("part"),
        F.lit(1).alias("guest"),
    )
    window = Window.partitionBy("at.part").orderBy("at.guest", by, *ties)
    return (
        df.withColumn("part", part)
        .withColumn("at", F.explode(F.when(starts, F.array(own, guest)).otherwise(F.array(own))))
        .withColumns({f"next_{name}": F.lead(name).over(window) for name in columns})
        .filter("at.guest = 0")
        .drop("part", "at")
    )
