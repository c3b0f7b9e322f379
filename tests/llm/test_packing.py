"""Packing: boundaries against brute force, places without gaps."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from logframe.llm.packing import best_boundaries, pack
from tests.llm.fixtures import SCHEMA, tricky


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_the_best(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
    counts = rng.integers(1, 50, 9)
    for k in (1, 2, 3, 4, 20):
        ends = best_boundaries(lengths, counts, k)
        tried = [c for c in combinations(lengths, min(k, 9)) if c[-1] == lengths[-1]]
        assert len(ends) <= k
        assert padding(lengths, counts, ends) == min(padding(lengths, counts, c) for c in tried)


def test_every_word_has_one_place(spark):
    rows = tricky()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = pack(docs, max_length=64, multiple=8, buckets=3, batch_tokens=256).collect()
    words = Counter()
    for r in found:
        words[r.doc_id] += r.n_words
        assert r.n_words <= r.bucket_length and r.first_word == r.piece * 64
    wanted = Counter()
    for i, text, *_ in rows:
        wanted[i] += len((text or "").split())
    assert words == wanted
    assert len({r.bucket_length for r in found}) == 3
    places = defaultdict(list)
    for r in found:
        places[r.bucket_length, r.batch].append(r.slot)
    for length in {r.bucket_length for r in found}:
        sizes = [len(places[length, b]) for b in range(sum(1 for l, _ in places if l == length))]
        per = max(1, 256 // length)
        assert all(sorted(places[length, b]) == list(range(n)) for b, n in enumerate(sizes))
        assert set(sizes[:-1]) <= {per} and 1 <= sizes[-1] <= per


def test_no_documents(spark):
    assert pack(spark.createDataFrame([], SCHEMA)).count() == 0
