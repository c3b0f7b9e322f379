"""Length buckets with the least padding, and batches of a token budget inside each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logframe.llm.shared import WHITE, checkpointed

# Rows of one bucket that are numbered in one task, about.
ROWS_PER_SALT = 1_000_000


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` ranges of length with the least padding in all.

    Dynamic programming over the histogram: ``cost[j]`` is the least padding of
    the lengths up to the j-th with the buckets used so far; the last bucket
    of a division ends at the greatest length. Ends are lengths that occur.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths)[order], np.asarray(counts, dtype=np.float64)[order]
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate([[0.0], np.cumsum(counts)])
    tokens = np.concatenate([[0.0], np.cumsum(counts * lengths)])
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, n)):
        following, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        following[0] = 0.0
        for j in range(1, n + 1):
            padded = cost[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(padded))
            following[j] = padded[cut[j]]
        cost = following
        cuts.append(cut)
    ends, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        ends.append(int(lengths[j - 1]))
        j = int(cut[j])
    return sorted(set(ends))


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_length: int = 2048,
    multiple: int = 8,
    buckets: int = 8,
    batch_tokens: int = 16_384,
) -> DataFrame:
    """Every piece of every document with its bucket, batch and place in the batch.

    Columns: doc_id, piece, first_word, n_words, bucket_length, batch, slot.
    A document's length is its number of words; one over ``max_length`` is cut
    into pieces of that length and a rest, so every word has exactly one place.
    Pieces are padded to their bucket's length, a multiple of ``multiple``; the
    boundaries are those with the least padding over the histogram of all
    pieces, which has at most ``max_length / multiple`` cells and is all that
    the driver sees. In a bucket of length L every batch but the last holds
    ``batch_tokens // L`` pieces (at least one), numbered by ``slot`` from 0.

    Documents without words (NULL, empty, white space) have one piece of
    length 0 in the first bucket. Repeated rows and ids are placed each.
    No rows in, no rows out. Other columns are ignored.

    A bucket's pieces are numbered in parallel: dealt by a hash of the id, piece
    and row as it was kept, so that an id on many rows is spread too, into salts, numbered in each, and moved by the sizes of the salts
    before.
    """
    if max_length % multiple:
        raise ValueError(f"max_length {max_length} is not a multiple of {multiple}")
    n_words = F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{WHITE}]+")), F.lit(0))
    sized = docs.select(F.col(doc_id).alias("doc_id"), n_words.cast("long").alias("n_all"))
    last = F.greatest(F.ceil(F.col("n_all") / max_length), F.lit(1)) - 1
    pieces = sized.select(
        "doc_id", "n_all", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * max_length).alias("first_word"),
        F.least(F.col("n_all") - F.col("piece") * max_length, F.lit(max_length)).alias("n_words"),
    )
    cell = F.greatest(F.ceil(F.col("n_words") / multiple), F.lit(1)) * multiple
    # The row number is kept with the rows, so it is the same whoever reads them.
    pieces = checkpointed(pieces.withColumns({"cell": cell.cast("int"), "kept": F.monotonically_increasing_id()}))
    histogram = pieces.groupBy("cell").count().collect()
    total = sum(row["count"] for row in histogram)
    ends = best_boundaries(
        np.array([row["cell"] for row in histogram], dtype=np.int64),
        np.array([row["count"] for row in histogram], dtype=np.int64),
        buckets,
    ) or [multiple]

    salts = max(64, -(-total // ROWS_PER_SALT))
    length = F.lit(ends[-1])
    for end in reversed(ends[:-1]):
        length = F.when(F.col("cell") <= end, F.lit(end)).otherwise(length)
    dealt = pieces.withColumn("bucket_length", length).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "kept"), F.lit(salts)).cast("int")
    )
    before = Window.partitionBy("bucket_length").orderBy("salt")
    offsets = (
        dealt.groupBy("bucket_length", "salt")
        .agg(F.count(F.lit(1)).alias("here"))
        .withColumn("offset", F.sum("here").over(before) - F.col("here"))
        .drop("here")
    )
    inside = Window.partitionBy("bucket_length", "salt").orderBy(
        "doc_id", "piece", "n_words", "first_word", "kept"
    )
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bucket_length")))
    return (
        dealt.withColumn("row", F.row_number().over(inside))
        .join(offsets, ["bucket_length", "salt"])
        .withColumn("place", F.col("offset") + F.col("row") - 1)
        .select(
            "doc_id",
            "piece",
            "first_word",
            F.col("n_words").cast("long").alias("n_words"),
            "bucket_length",
            F.floor(F.col("place") / per_batch).alias("batch"),
            (F.col("place") % per_batch).cast("int").alias("slot"),
        )
    )
