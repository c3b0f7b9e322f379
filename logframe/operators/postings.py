"""Text search by an index: which word stands where in which document."""

from __future__ import annotations

import functools
import operator
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field
from logframe.functions.text import WORD_BREAK, query_words

# Folders that words are dealt to, and tasks that share the writing of one.
FOLDERS = 64
PARTS = 4

# Words that are sorted together, of some hundred bytes each on the way; a longer text is alone.
SLICE_WORDS = 250_000


def _folder(word: Column, folders: int) -> Column:
    return F.pmod(F.crc32(word.cast("binary")), F.lit(folders)).cast("int")


def write_postings(
    df: DataFrame, path: str, text: str, key: str, folders: int = FOLDERS, parts: int = PARTS
) -> DataFrame:
    """The table ``(word, doc, places)`` of a text column as Parquet at ``path``; read back.

    Words are those of :func:`match_text`; ``places`` are their numbers among
    the document's words, rising. ``key`` tells documents apart: rows that
    share one are found as one document, in which any words may be in a row;
    rows without one cannot be found and are left out. Words are dealt to
    folders by hash and sorted there, so that a search opens one folder a word
    and only that word's row groups. A folder is written by ``parts`` tasks, by
    document, so a word of nearly all documents is not one task's.

    A text's words are sorted and grouped in the task that reads it, in Arrow
    and numpy. One row for each document and folder is shuffled, its words and
    places as text: a fraction of what a row for each word takes.
    """
    doc, words = field(df, key), F.split(F.lower(field(df, text)), WORD_BREAK)
    rows = df.select(doc.alias("doc"), words.alias("words")).filter("doc is not null and words is not null")
    kind = rows.schema["doc"].dataType.simpleString()
    runs = rows.mapInArrow(_runs(folders), f"doc {kind}, folder int, words string, places string")
    dealt = runs.repartition("folder", F.pmod(F.xxhash64("doc"), F.lit(parts)))
    each = F.explode(F.arrays_zip(F.split("words", " ").alias("word"), F.split("places", " ").alias("places")))
    postings = dealt.select("folder", "doc", each.alias("own"))
    (
        postings.select("folder", "own.word", "doc", F.split("own.places", ",").cast("array<int>").alias("places"))
        .sortWithinPartitions("folder", "word", "doc")
        .write.partitionBy("folder")
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def _runs(folders: int) -> Callable:
    """Each document's words by folder, every word once, and the places of each."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(batch["words"].value_lengths().to_numpy(zero_copy_only=False))
            low = 0
            while low < batch.num_rows:
                before = ends[low - 1] if low else 0
                high = max(int(np.searchsorted(ends, before + SLICE_WORDS, side="right")), low + 1)
                yield _grouped(batch.slice(low, high - low), folders)
                low = high

    return runs


def _grouped(batch: pa.RecordBatch, folders: int) -> pa.RecordBatch:
    lists = batch["words"]
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    flat = pc.list_flatten(lists)
    real = pc.not_equal(flat, "")
    coded = flat.filter(real).dictionary_encode()
    kept = real.to_numpy(zero_copy_only=False)
    row, place = row[kept], place[kept]
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hashes = [zlib.crc32(word.encode()) for word in coded.dictionary.to_pylist()]
    folder = (np.array(hashes, dtype=np.int64) % folders)[code]
    order = np.lexsort((code, folder, row))  # stable, so a word's places rise
    row, place, code, folder = row[order], place[order], code[order], folder[order]
    new_run = np.diff(row * folders + folder, prepend=-1) != 0
    new_word = new_run | (np.diff(code, prepend=-1) != 0)
    of_word, of_run = np.flatnonzero(new_word), np.flatnonzero(new_run)
    texts = pa.array(place).cast(pa.string())
    joined = lambda values, starts, mark: pc.binary_join(
        pa.ListArray.from_arrays(pa.array([*starts, len(values)], pa.int32()), values), mark
    )
    runs = np.searchsorted(of_word, of_run)
    return pa.RecordBatch.from_arrays(
        [
            batch["doc"].take(pa.array(row[of_run])),
            pa.array(folder[of_run].astype(np.int32)),
            joined(coded.dictionary.take(pa.array(code[of_word])), runs, " "),
            joined(joined(texts, of_word, ","), runs, " "),
        ],
        ["doc", "folder", "words", "places"],
    )


def search_postings(
    postings: DataFrame, words: str | list[str], mode: str = "any", folders: int = FOLDERS
) -> DataFrame:
    """Keys (``doc``) of the documents with any or all of the words, or with them in a row as a ``phrase``.

    The same documents as by :func:`match_text` on the column, without its
    texts: only the asked words' folders are listed and only their row groups
    read. All and phrase are one aggregation by document, so a common word's
    documents are spread over all tasks. ``folders`` is what the index was
    written with.
    """
    if mode not in ("any", "all", "phrase"):
        raise ValueError(f"mode must be any, all or phrase, not {mode!r}")
    asked = query_words(words)
    different = list(dict.fromkeys(asked))
    where = functools.reduce(
        operator.or_,
        # The folder is a constant to the planner, which prunes the others before anything runs.
        [(F.col("folder") == _folder(F.lit(word), folders)) & (F.col("word") == word) for word in different],
    )
    met = postings.filter(where)
    if mode == "any" or len(asked) == 1:
        return met.select("doc").distinct()
    if mode == "all":
        counted = met.groupBy("doc").agg(F.count_distinct("word").alias("n"))
        return counted.filter(F.col("n") == len(different)).select("doc")
    # Where the phrase would begin for each place of each of its words.
    numbers = {word: [n for n, other in enumerate(asked) if other == word] for word in different}
    own = functools.reduce(
        lambda rest, word: F.when(F.col("word") == word, F.array(*map(F.lit, numbers[word]))).otherwise(rest),
        different,
        F.lit(None),
    )
    begins = met.select("doc", F.explode("places").alias("place"), own.alias("own"))
    begins = begins.select("doc", "place", F.explode("own").alias("n")).select(
        "doc", "n", (F.col("place") - F.col("n")).alias("start")
    )
    whole = begins.groupBy("doc", "start").agg(F.count_distinct("n").alias("n")).filter(F.col("n") == len(asked))
    return whole.select("doc").distinct()


def word_counts(postings: DataFrame) -> DataFrame:
    """``(word, doc_count, uses)``: documents with each word and its occurrences, from the index alone."""
    return postings.groupBy("word").agg(
        F.count(F.lit(1)).alias("doc_count"), F.sum(F.size("places")).alias("uses")
    )
