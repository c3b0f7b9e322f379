"""The language model against formulas written out, the classifier on held-out rows, word hashes."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from logframe.llm import kneser_ney, toxicity
from logframe.llm.words import shingles, text_slices, word_hashes
from tests.llm.fixtures import SCHEMA, tricky

TEXTS = ["The cat", "", None, " the\tCAT ", "é É x", "a" * 3000 + " b", "one-two, three", "\n\n"]


@pytest.mark.parametrize("slice_bytes,hash_bytes", [(4 << 20, 1 << 19), (10, 64)])
def test_word_hashes(monkeypatch, slice_bytes, hash_bytes):
    monkeypatch.setattr("logframe.llm.words.SLICE_BYTES", slice_bytes)
    whole = hashes_of(TEXTS)
    monkeypatch.setattr("logframe.llm.words.HASH_BYTES", hash_bytes)
    assert hashes_of(TEXTS) == whole
    names = {}
    for text, own in zip(TEXTS, whole):
        words = (text or "").encode().lower().split()
        assert len(own) == len(words)
        for word, h in zip(words, own):
            assert names.setdefault(h, word) == word
    assert hashes_of(TEXTS[:2] + TEXTS[3:], sliced=1) == whole[1:2] + whole[3:]


def hashes_of(texts, sliced=0):
    out = []
    for _, _, data, offsets in text_slices(pa.array(texts, pa.string())[sliced:]):
        h, places = word_hashes(data, offsets)
        out += [h[a:b].tolist() for a, b in zip(places[:-1], places[1:])]
    return out


def test_shingles():
    h = np.arange(1, 10, dtype=np.uint64)
    runs, places = shingles(h, np.array([0, 0, 1, 3, 9]), 3)
    assert np.diff(places).tolist() == [0, 1, 1, 4]
    again, _ = shingles(h[3:6], np.array([0, 3]), 3)
    assert again[0] == runs[2] and len(set(runs.tolist())) == 6
    assert shingles(h[:0], np.array([0, 0]), 3)[1].tolist() == [0, 0]


def kneser_ney_by_hand(texts):
    """log10 P of a text, from the formulas of the interpolated model."""
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    pairs = Counter(p for w in tokens for p in zip(["start", *w[:-1]], w))
    single = Counter(x for w in tokens for x in w)
    left = Counter(b for _, b in pairs)
    census = lambda counts: {f"n{i}": sum(n == i for n in counts) for i in (1, 2, 3, 4)}
    d2, d1 = (dict(enumerate([0, *kneser_ney.discounts(census(c.values()))])) for c in (pairs, left))
    after = defaultdict(list)
    for (a, _), n in pairs.items():
        after[a].append(n)

    def low(b):
        spare = sum(d1[min(n, 3)] for n in left.values()) / len(pairs)
        return (left[b] - d1[min(left[b], 3)]) / len(pairs) + spare / (len(single) + 1)

    def p(a, b):
        if a not in after:
            return low(b)
        n = pairs[a, b]
        return ((n - d2[min(n, 3)]) + sum(d2[min(m, 3)] for m in after[a]) * low(b)) / sum(after[a])

    return single, p


def test_kneser_ney(spark):
    rows = tricky(n=80)
    docs = spark.createDataFrame(rows, SCHEMA)
    learn = docs.filter("doc_id % 3 != 0")
    texts = [t for i, t, *_ in rows if i is not None and i % 3]
    model = kneser_ney.train(learn)
    single, p = kneser_ney_by_hand(texts)
    n, v = sum(single.values()), len(single)
    found = kneser_ney.score(docs, model, ["doc_id", "lang"]).collect()
    text = {(i, t) for i, t, *_ in rows}
    assert len(found) == len(rows)
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r)
    for i, t in text:
        w = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(p(a, b)) for a, b in zip(["start", *w[:-1]], w))
        assert any(
            (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(single[x] > 0 for x in w), n)
            and math.isclose(r.base_score, base) and math.isclose(r.score, score)
            for r in by_id[i]
        )
    assert math.isclose(sum(p("start", x) for x in single) + p("start", "unknown"), 1)


def kneser_ney_of_order(texts, order):
    """P(word | tuple of words before) of any order, from the formulas."""
    tokens = [["start"] * (order - 1) + [*(t or "").encode().lower().split(), None] for t in texts]
    runs = Counter(tuple(w[i - order + 1 : i + 1]) for w in tokens for i in range(order - 1, len(w)))
    levels = [runs]
    for _ in range(order - 1):
        levels.insert(0, Counter(r[1:] for r in levels[0]))
    census = lambda counts: {f"n{i}": sum(n == i for n in counts) for i in (1, 2, 3, 4)}
    d = [[0, *kneser_ney.discounts(census(level.values()))] for level in levels]
    after = [defaultdict(list) for _ in levels]
    for level, held in zip(levels, after):
        for run, n in level.items():
            held[run[:-1]].append(n)

    def p(before, word, k=order - 1):
        if k < 0:
            return 1 / (len(levels[0]) + 1)
        mine = before[len(before) - k :]
        low = p(before, word, k - 1)
        if mine not in after[k]:
            return low
        n, others = levels[k][(*mine, word)], after[k][mine]
        return (n - d[k][min(n, 3)] + sum(d[k][min(m, 3)] for m in others) * low) / sum(others)

    return {w[-1] for w in levels[0]}, p


@pytest.mark.parametrize("order", [2, 3, 4])
def test_kneser_ney_of_order(spark, order):
    rows = tricky(n=60)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = kneser_ney.train(docs.filter("doc_id % 3 != 0"), order=order)
    words, p = kneser_ney_of_order([t for i, t, *_ in rows if i is not None and i % 3], order)
    found = defaultdict(list)
    for r in kneser_ney.score(docs, model, ["doc_id"]).collect():
        found[r.doc_id].append(r.score)
    for i, t, *_ in rows:
        w = ["start"] * (order - 1) + [*(t or "").encode().lower().split(), None]
        score = sum(math.log10(p(tuple(w[j - order + 1 : j]), w[j])) for j in range(order - 1, len(w)))
        assert any(math.isclose(x, score) for x in found[i])
    some = ("start", "start", "start")[: order - 1]
    assert math.isclose(sum(p(some, x) for x in words) + p(some, "unknown"), 1)


def test_kneser_ney_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    found = kneser_ney.score(docs, kneser_ney.train(docs.limit(0)), ["doc_id"]).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in sorted(found)] == [(3, 0, 0, 0), (1, 0, 0, 0)]
    assert all(r.score == 0 for r in found)
    assert kneser_ney.score(docs.limit(0), kneser_ney.train(docs), ["doc_id"]).count() == 0


def toxic_table(n=900):
    rng = random.Random(5)
    clean = ["".join(rng.choices("abdegiklmnorstu", k=rng.randint(2, 9))) for _ in range(4000)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(clean[: 200 if rng.random() < 0.5 else None], k=rng.randint(5, 80))
        toxic = rng.random() < 0.25
        for _ in range(rng.randint(1, 3) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["Vexling", "grumbok!", "zorp" + rng.choice(clean)]))
        rows.append((i, " ".join(words), "en" if i % 2 else "de"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_table()
    extra = [(None, None, None), (10**6, "", "en"), (10**6 + 1, "w " * 200_000 + "Vexling", "en")]
    docs = spark.createDataFrame(rows + extra, "doc_id bigint, text string, lang string")
    docs = docs.selectExpr("*", "'own' as score", "1 as toxic_")
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 7), labels[0]], "doc_id bigint, toxic int")
    from pyspark.sql import functions as F

    network = toxicity.train(docs, known, learn=F.col("doc_id") % 3 != 0)
    scored = toxicity.score(docs, network)
    assert "toxic_" in scored.columns and scored.count() == len(rows) + 3
    found = {r.doc_id: r for r in scored.collect()}
    truth = dict(labels)
    held = [i for i in truth if i % 3 == 0]
    right = sum((found[i].score >= 0.5) == truth[i] for i in held)
    assert right > 0.93 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert found[10**6 + 1].score > 0.5 > found[10**6].score
    assert {r.threshold for r in found.values() if r.lang is None} == {0.5}


def test_all_labelled_rows_calibrate(spark, monkeypatch):
    rows, labels = toxic_table(1500)
    # A language with 1 in 50 of the rows, and one whose texts are all long.
    rows = [(i, text, "rare" if i % 50 == 0 else "long" if i % 8 == 2 else "en") for i, text, _ in rows]
    rows = [(i, text + " w" * 4000 * (lang == "long"), lang) for i, text, lang in rows]
    labels = [(i, int(i % 100 == 0) if i % 50 == 0 else toxic) for i, toxic in labels]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    from pyspark.sql import functions as F

    seen = []
    monkeypatch.setattr(toxicity, "calibrate", lambda network, raw, toxic, weight: seen.append((toxic, weight)))
    settings = toxicity.Settings(language_rows=15, fit_toxic=60, fit_clean=100, epochs=1)
    network = toxicity.train(docs, known, check=F.col("doc_id") % 4 < 3, settings=settings)
    ((toxic, weight),) = seen
    counted = [i for i, _ in labels if i % 4 < 3]
    assert weight.sum() == len(counted) and (toxic * weight).sum() == sum(dict(labels)[i] for i in counted)
    assert network.thresholds.keys() == {"en", "long", "rare"}


def test_a_repeated_id_is_one_text_of_the_sample(spark, monkeypatch):
    rows = [(i, f"word{i} and more", "en") for i in range(40)] + [(1, f"copy {i}", "en") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    from pyspark.sql import functions as F

    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda network, texts, *rest: sizes.append(len(texts)))
    toxicity.train(docs, labels, check=F.col("doc_id") >= 30)
    assert sizes == [30]


def test_best_threshold_keeps_equal_scores_together():
    scores = np.array([0.9, 0.5, 0.5, 0.1])
    assert toxicity.best_threshold(scores, np.array([1.0, 1, 0, 0]), np.array([5.0, 1, 100, 1])) == pytest.approx(0.7)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    network = toxicity.train(docs, labels)
    assert [r.score for r in toxicity.score(docs, network).collect()] == [0.5]
    assert toxicity.score(docs.limit(0), network).count() == 0


def test_long_texts_in_blocks(monkeypatch):
    s = toxicity.Settings(buckets=1 << 8, least_texts=1)
    network = toxicity.Network.new(s)
    rng = np.random.default_rng(1)
    network.table[:] = rng.normal(0, 1, network.table.shape)
    network.tags[:] = rng.integers(0, 9, len(network.tags))
    hashes = rng.integers(0, 1 << 11, (500, 3), dtype=np.uint32)
    places = np.array([0, 3, 3, 480, 500])
    whole = network.scores(hashes, places)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 7)
    assert np.allclose(network.scores(hashes, places), whole)


def test_runs_take_few_bytes_and_no_shuffle_file_stays(spark, tmp_path):
    # 12 bytes a run and 24 for each that others begin with were more disk than the texts allow.
    draw = random.Random(5)
    rows = [(i, " ".join(f"w{draw.randrange(3000)}" for _ in range(300))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tidied, frames = [], kneser_ney.tidy
    try:
        kneser_ney.tidy = lambda session: tidied.append(1) or frames(session)
        model = kneser_ney.train(docs, folder=f"file:{tmp_path}", order=3)
    finally:
        kneser_ney.tidy = frames
    runs = sum(table.rows for table in model.tables)
    assert runs > 100_000 and len(tidied) == 5
    assert sum(file.stat().st_size for file in tmp_path.iterdir()) < 12 * runs


def test_packed_tables():
    draw = np.random.default_rng(3)
    for width in (11, 40, 64):
        numbers = np.unique(draw.integers(0, (1 << width) - 1, 900, dtype=np.uint64, endpoint=True))
        spread = kneser_ney.spread(numbers, width)
        assert len(set(spread.tolist())) == len(numbers) and int(spread.max()) < 1 << width
        assert (kneser_ney.gather(spread, width) == numbers).all()
        counts = np.where(numbers % 7 == 0, 1 << 40, numbers % 300 + 1).astype(np.int64)
        held = kneser_ney._unpack(kneser_ney._pack([numbers, counts]), len(numbers), 2)
        assert (held[0] == numbers).all() and (held[1].view(np.int64) == counts).all()
