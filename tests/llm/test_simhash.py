"""SimHash: fingerprints, pairs within a radius, and the row after each row."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logframe.llm.queries import op3_simhash
from logframe.llm.simhash import order_marks, simhash, with_next, within_radius
from tests.llm.fixtures import SCHEMA, tricky


def test_votes(spark):
    rows = [(i, t) for i, (_, t, *_) in enumerate(tricky())]
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = {r.id: r.text_fp for r in simhash(df, ["id"], ["text"]).collect()}
    words = {i: (t or "").lower().split() for i, t in rows}
    pairs = sorted({(a, b) for w in words.values() for a, b in zip(w, [*w[1:], None])}, key=str)
    hashes = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h"))
    hashes = {(r.a, r.b): r.h for r in hashes.collect()}
    for i, w in words.items():
        own = [hashes[p] & (2**64 - 1) for p in zip(w, [*w[1:], None])]
        bits = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in own) > len(own))
        assert found[i] & (2**64 - 1) == bits
    assert len(found) == len(rows)


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 4), (3, 6)])
def test_all_pairs_in_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(40)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for p in prints for _ in range(4)]
    prints += prints[:5]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in [*signed, None]], "fp bigint")
    found = [tuple(r) for r in within_radius(df, "fp", radius, blocks).collect()]
    distinct = sorted(set(signed))
    near = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    wanted = [(a, b, near(a, b)) for a in distinct for b in distinct if a < b and near(a, b) <= radius]
    assert sorted(found) == wanted


@pytest.mark.parametrize("n", [0, 1, 2, 9, 200])
def test_next_rows(spark, n):
    rng = random.Random(n)
    rows = [(i, str(i)) for i in rng.sample(range(-(10**6), 10**6), n)] + [(5, "x")] * (n > 9)
    df = spark.createDataFrame(rows, "k bigint, v string")
    found = with_next(df, "k", ["v"], ["v"], order_marks(df, "k")).collect()
    order = sorted(rows)
    wanted = Counter((*row, order[(i + 1) % len(order)][1]) for i, row in enumerate(order))
    assert Counter(tuple(r) for r in found) == wanted


def test_query(spark, tmp_path):
    rows = tricky()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = op3_simhash(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert {r.n_chars for r in found if r.doc_id == 5001} == {0}
