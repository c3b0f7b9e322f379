"""Importance resampling: documents drawn towards a target's distribution of n-grams.

Words and n-grams are made in Arrow and numpy, a few megabytes of text at a
time; Spark counts buckets, finds the score at which the draw ends and ranks
what is drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logframe.llm.shared import unused, written

# Bytes of text whose words are numbered together; a longer text is alone.
SLICE_BYTES = 8 << 20

# Between words, after A-Z have been lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Scores that are counted together on the way to a draw's last score.
SCORE_BLOCK = 1024


def _slices(column: pa.Array) -> Iterator[pa.Array]:
    """Rows whose texts are together within SLICE_BYTES; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(column):
        before = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, before + SLICE_BYTES, side="right")), low + 1)
        yield column.slice(low, high - low)
        low = high


def features(
    texts: pa.Array, buckets: int, width: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For 1 to ``width`` words the buckets of all runs of so many, each text's offset among them; its words.

    Words are numbered by a dictionary. Numbers of neighbours, shifted against
    each other, make a run; only different runs are hashed, the last word's
    bytes upon the hash of the run before it.
    """
    words = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    row = pc.list_parent_indices(words)
    flat = pc.list_flatten(words)
    real = pc.not_equal(flat, "")
    coded = flat.filter(real).dictionary_encode()
    row = row.filter(real).to_numpy(zero_copy_only=False)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = np.empty(len(coded.dictionary), dtype=object)
    names[:] = [word.encode() for word in coded.dictionary.to_pylist()]
    hashes = np.fromiter(map(zlib.crc32, names), dtype=np.int64, count=len(names))

    every = np.arange(len(texts) + 1)
    found = [((hashes % buckets)[code], np.searchsorted(row, every))]
    own, first = code, np.arange(len(code))  # of runs so far: their numbers and where they start
    for size in range(2, width + 1):
        longer = first + size - 1 < len(code)
        longer[longer] = row[first[longer]] == row[first[longer] + size - 1]
        first, head = first[longer], own[longer]
        pair = pa.array(head * len(names) + code[first + size - 1]).dictionary_encode()
        known = pair.dictionary.to_numpy()
        spaced = np.array([zlib.crc32(b" ", h) for h in hashes.tolist()], dtype=np.int64)
        head, tail = np.divmod(known, max(len(names), 1))
        hashes = np.fromiter(
            map(zlib.crc32, names[tail], spaced[head].tolist()), dtype=np.int64, count=len(known)
        )
        own = pair.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found.append(((hashes % buckets)[own], np.searchsorted(row[first], every)))
    return found, np.diff(found[0][1])


def bucket_counts(docs: DataFrame, buckets: int, width: int, text: str = "text") -> DataFrame:
    """How many runs of words fall into each bucket: ``(bucket, n)``; buckets without any are left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for texts in _slices(batch.column(0)):
                for runs, _ in features(texts, buckets, width)[0]:
                    total += np.bincount(runs, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(counted, "bucket bigint, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    docs: DataFrame, target: DataFrame, buckets: int, width: int, text: str = "text"
) -> np.ndarray:
    """What a run of each bucket speaks for the target, in thousandths of a natural logarithm.

    At most ``buckets`` numbers per table pass through the driver. Both
    distributions count each bucket once more than it was met.
    """
    found = []
    for table in (docs, target):
        counts = np.zeros(buckets, dtype=np.int64)
        rows = bucket_counts(table, buckets, width, text).toArrow()
        counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
        found.append(counts.tolist())
    raw, wanted = found
    all_raw, all_wanted = sum(raw), sum(wanted)
    gains = [
        math.floor(
            1000 * math.log(float((t + 1) * (all_raw + buckets)) / float((s + 1) * (all_wanted + buckets)))
        )
        for s, t in zip(raw, wanted)
    ]
    return np.array(gains, dtype=np.int64)


def _segment_sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring places."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[places])


def weigh(docs: DataFrame, gains: np.ndarray, width: int, text: str = "text") -> DataFrame:
    """The documents with ``n_words``, ``n_features`` and ``weight``, their runs' mean gain rounded down.

    Whole texts of any length count. One without words, or NULL, weighs 0.
    Columns of these three names are replaced, others kept; nothing is shuffled.
    """
    held = docs.sparkSession.sparkContext.broadcast(gains)

    @F.arrow_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def weight(column: pa.Array) -> pa.Array:
        parts = [(np.zeros(0, np.int64),) * 3]
        for texts in _slices(column):
            found, n_words = features(texts, len(held.value), width)
            n = sum(np.diff(places) for _, places in found)
            total = sum(_segment_sums(held.value.take(runs), places) for runs, places in found)
            parts.append((n_words, n, total // np.maximum(n, 1)))
        names = ["n_words", "n_features", "weight"]
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)], names
        )

    (own,) = unused(docs, "weighed")
    added = ["n_words", "n_features", "weight"]
    return docs.withColumn(own, weight(F.col(text))).select(
        *[F.col(name) for name in docs.columns if name not in added],
        *[F.col(own)[name].alias(name) for name in added],
    )


def draw(
    weighed: DataFrame, seed: int, percent: int, least_words: int, key: str = "doc_id"
) -> DataFrame:
    """Weighed documents with ``score`` and ``rank``: a draw without replacement, likelier by weight.

    A score is the weight and a Gumbel variate in thousandths, made from the
    seed and the key, so the highest ``percent`` of 100 scores of the documents
    of ``least_words`` words or more are the draw; ``rank`` counts them from 1
    and is NULL for the rest. Equal scores are in order of the key (NULL last),
    then of the number of runs. Rows that agree in all these may change places,
    which shows in nothing but their rank; a NULL key counts as empty text in
    the variate.

    Scores are whole numbers within some 100,000 of each other whatever the
    input, so rows per score are few and small; they say which scores are
    drawn, and only the rows of those are ranked, score by score. ``weighed``
    is read three times and should be a written table.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + gumbel)
    able = F.col("n_words") >= least_words

    block = F.floor(F.col("score") / SCORE_BLOCK)
    sizes = scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn("block", block)
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("of_block"))
    higher = F.sum("of_block").over(Window.orderBy(F.desc("block"))) - F.col("of_block")
    blocks = blocks.withColumn("above", higher)
    inside = F.sum("n").over(Window.partitionBy("block").orderBy(F.desc("score"))) - F.col("n")
    starts = sizes.withColumn("inside", inside).join(F.broadcast(blocks), "block")
    most = scored.filter(able).agg(F.floor(F.count(F.lit(1)) * percent / 100).cast("bigint")).collect()[0][0]
    starts = starts.select("score", (F.col("above") + F.col("inside")).alias("before"))
    starts = starts.filter(F.col("before") < most)

    (before,) = unused(scored, "before")
    marked = scored.join(F.broadcast(starts.withColumnRenamed("before", before)), "score", "left")
    drawn = able & F.col(before).isNotNull()
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last(key), "n_features")
    ranks = (F.col(before) + F.row_number().over(order)).cast("bigint")
    ranked = marked.filter(drawn).withColumn("rank", F.when(ranks <= most, ranks))
    rest = marked.filter(~drawn).withColumn("rank", F.lit(None).cast("bigint"))
    columns = [c for c in weighed.columns if c not in ("score", "rank")]
    return ranked.unionByName(rest).select(*columns, "score", "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    seed: int,
    percent: int,
    least_words: int = 20,
    buckets: int = 10_000,
    width: int = 2,
    keep: list[str] | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """``keep`` (by default the key) of every document, with its weight, score and rank in the draw.

    Texts are read twice: to count all of them, and to weigh each. Weights are
    kept in the checkpoint folder, so nothing is weighed again. An empty table
    gives no rows; an empty target speaks for rare buckets alone.
    """
    gains = bucket_gains(docs, target, buckets, width)
    rows = docs.select(*dict.fromkeys([key, *(keep or []), "text"]))
    weights = written(weigh(rows, gains, width).drop("text"), "weights")
    return draw(weights, seed, percent, least_words, key)
