"""Importance resampling against a plain count of every run of words."""

import hashlib
import math
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logframe.llm import resample as R
from tests.llm.fixtures import SCHEMA, tricky

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}


def runs(text, width):
    words = [w for w in re.split(BETWEEN, (text or "").translate(LOWER)) if w]
    return words, [" ".join(words[i : i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]


def wanted(docs, target, seed, percent, least, buckets, width):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [text for _, text in docs]), (t, target)):
        for text in texts:
            for f in runs(text, width)[1]:
                counts[bucket(f)] += 1
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
        for a, b in zip(s, t)
    ]
    rows = []
    for ident, text in docs:
        words, own = runs(text, width)
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        name = f"{seed}:{'' if ident is None else ident}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([ident, len(own), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(repr, rows))


@pytest.mark.parametrize("width, percent, least", [(1, 100, 0), (2, 25, 20), (3, 60, 2)])
def test_same_as_plain_count(spark, width, percent, least):
    rows = tricky(seed=width)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"score": F.lit("a"), "rank": F.lit("b"), "weight": F.lit("c"), "before": F.lit(1)}
    )
    target = ["w1 w2 w3 the and", "É é w4", None, ""]
    frame = spark.createDataFrame([(text,) for text in target], "text string")
    found = R.resample(docs, frame, 5, percent, least, buckets=97, width=width, keep=["text"])
    found = found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
    expected = wanted([(r[0], r[1]) for r in rows], target, 5, percent, least, 97, width)
    assert sorted(repr(list(row)) for row in found.collect()) == expected


def test_texts_beyond_a_slice(monkeypatch):
    texts = [None, "", "a b a b", "x " * 300, "ß-É_9", "\x00\x7f"] * 3
    whole = R.features(pa.array([t or "" for t in texts], pa.large_string()), 50, 3)
    monkeypatch.setattr(R, "SLICE_BYTES", 10)
    parts = [R.features(part, 50, 3) for part in R._slices(pa.array(texts))]
    assert [n for _, n_words in parts for n in n_words] == whole[1].tolist()
    for size in range(3):
        assert [x for found, _ in parts for x in found[size][0]] == whole[0][size][0].tolist()


def test_columns_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 7, 8, "x"), (2, None, 9, 9, "y")], "doc_id int, text string, weighed int, n_words int, before string")
    import numpy as np

    found = R.draw(R.weigh(docs, np.zeros(10, dtype=np.int64), 2), 1, 100, 0)
    rows = {row["doc_id"]: row for row in found.collect()}
    assert rows[1]["n_words"] == 2 and rows[2]["n_words"] == 0
    assert (rows[1]["weighed"], rows[1]["before"]) == (7, "x")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert R.resample(docs, some, 7, 25).count() == 0
    (row,) = R.resample(some, docs, 7, 100, least_words=1).collect()
    assert row["rank"] == 1 and row["n_features"] == 5
