"""Blocked Bloom filters of 64-bit keys: built by an aggregate, tested by vectorised functions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logframe.llm.shared import tidy

# A block is one cache line: eight words of 64 bits, of which a key sets one bit each.
WORDS = 8
# Blocks at most, 128 MB: a longer list makes more false hits, which the join removes.
MOST_BLOCKS = 1 << 21


def bloom_blocks(keys: DataFrame, key: str, n_keys: int) -> np.ndarray:
    """A blocked Bloom filter of 64-bit keys, which are hashes: blocks of eight words.

    About 16 bits a key; the words of a block are joined in the shuffle, so the
    driver gets one row per block in use and never the keys.
    """
    blocks = min(MOST_BLOCKS, 1 << max(4, math.ceil(math.log2(max(1, n_keys) * 16 / (64 * WORDS)))))
    block, bits = _places(F.col(key), blocks)
    with tidy(keys.sparkSession):
        rows = (
            keys.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
            .groupBy("block")
            .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
            .toArrow()
        )
    table = np.zeros((blocks, WORDS), dtype=np.int64)
    for i in range(WORDS):
        table[rows["block"].to_numpy(), i] = rows[f"w{i}"].to_numpy()
    del rows
    pa.default_memory_pool().release_unused()
    return table.view(np.uint64)


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block, from its low bits, and its bit in each word, six of its upper 48 bits."""
    block = key.bitwiseAND(F.lit(blocks - 1)).cast("int")
    return block, [_bit(key, i) for i in range(WORDS)]


def _bit(key: Column, i: int) -> Column:
    place = F.shiftrightunsigned(key, 16 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def possible(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether keys may be in the filter: never false for one that is."""
    found = np.ones(len(keys), dtype=bool)
    block = keys & np.uint64(len(table) - 1)
    for i in range(WORDS):
        place = (keys >> np.uint64(16 + 6 * i)) & np.uint64(63)
        found &= (table[block, i] >> place) & np.uint64(1) == 1
    return found


def tester(spark: SparkSession, blocks: np.ndarray, key: Column) -> Column:
    """``possible`` as a condition on a long column."""
    held = spark.sparkContext.broadcast(blocks)

    @F.pandas_udf(T.BooleanType())
    def test(key: pd.Series) -> pd.Series:
        return pd.Series(possible(held.value, key.to_numpy().view(np.uint64)))

    return test(key)


def may_hold(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of which a long column's value may be among the one column of ``keys``.

    For dropping most rows before a shuffle whose join is exact anyway.
    """
    (name,) = keys.columns
    blocks = bloom_blocks(keys, name, keys.count())
    return df.filter(tester(df.sparkSession, blocks, F.col(key)))
