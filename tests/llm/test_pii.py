"""Personal data: rules against plain patterns, gradients against differences, accuracy held out."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from logframe.llm import pii as P
from logframe.llm.queries import op13_pii
from tests.llm.fixtures import SCHEMA, tricky

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [
        (kind, *match.span())
        for kind, pattern in PATTERNS.items()
        for match in re.finditer(pattern, text or "")
        if holds(kind, match[0])
    ]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_rules():
    rng = random.Random(3)
    n = 0
    for _ in range(30_000):
        letters = rng.choice(["a@b.-_1é \n", "0123.@ ", "+1 (0)-.23456789", "0 -12345678"])
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert P.rule_spans(text) == plain(text), text
        n += len(plain(text))
    assert n > 2000


@pytest.mark.parametrize("text", ["a", "1", "1.", "@", "a@", "+1 ", "1 ", "a.b@c-", "+"])
def test_long_runs_take_linear_time(text):
    start = time.time()
    P.rule_spans(text * 300_000)
    P.window_starts("x" * 300_000)
    assert time.time() - start < 10


def test_window_starts():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("a" * rng.choice([1, 10, 90]) + "1@") for _ in range(rng.randrange(300)))
        starts = range(0, max(len(text) - P.WINDOW + P.STRIDE - 1, 0) // P.STRIDE * P.STRIDE + 1, P.STRIDE)
        assert P.window_starts(text) == [s for s in starts if re.search("[0-9@]", text[s : s + P.WINDOW])]


def test_gradient():
    network = P.Network(P.Settings(units=5, embedding=4))
    rng = np.random.default_rng(0)
    for name, x in network.weights.items():
        network.weights[name] = x + rng.normal(0, 0.3, x.shape)
    codes, tags = rng.integers(0, P.CODES, (3, P.WINDOW)), rng.integers(0, P.TAGS, (3, P.WINDOW))
    _, gradient = network.gradient(codes, tags)
    for name, x in network.weights.items():
        place = np.unravel_index(np.abs(gradient[name]).argmax(), x.shape)
        losses = []
        for moved in (1e-4, -2e-4):
            x[place] += moved
            losses.append(network.gradient(codes, tags)[0])
        x[place] += 1e-4
        assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(gradient[name][place], rel=1e-3)


def test_decode_is_the_best_path():
    network = P.Network(P.Settings(units=3, embedding=3))
    rng = np.random.default_rng(1)
    for name, x in network.weights.items():
        network.weights[name] = (x + rng.normal(0, 0.5, x.shape)).astype(np.float32)
    codes = rng.integers(0, P.CODES, (1, P.WINDOW))
    scores, w = network._run(codes)["scores"][0], network.weights
    of = lambda row: w["start"][row[0]] + scores[np.arange(len(row)), row].sum() + w["step"][row[:-1], row[1:]].sum()
    best = network.decode(codes)[0][0]
    for _ in range(500):  # no change of one or two tags is better
        other = best.copy()
        other[rng.integers(0, P.WINDOW, 2)] = rng.integers(0, P.TAGS, 2)
        assert of(other) <= of(best) + 1e-3


def test_reconciled():
    spans = [("card", 0, 10, 0.5), ("card", 8, 20, 0.9), ("phone", 15, 30, 0.6), ("ip", 30, 35, 0.1)]
    assert P._reconciled(spans) == [("card", 0, 20, 0.9), ("ip", 30, 35, 0.1)]


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return P.train(docs.filter("doc_id % 2 = 0"))


def test_held_out(spark, network):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 1")
    texts = [row["text"] for row in docs.select("text").collect()]
    hit = wanted = 0
    for text, seen in zip(texts, P.network_spans(network, texts)):
        own = plain(text)
        wanted += len(own)
        hit += sum(any(k == kind and s < end and e > start for k, s, e, _ in seen) for kind, start, end in own)
    assert wanted > 100 and hit / wanted > 0.9


def test_adds_what_rules_miss(network):
    texts = [
        "and then call (415) 555-2671 for the rest of it",
        "the lines of 10[.]20[.]0[.]12 were seen again",
        "only plain words, 4.0 of them and version 3. or token = \"93d0\"",
    ]
    found = [[(k, text[s:e]) for k, s, e in added] for text, (_, added) in zip(texts, P.all_spans(texts, network))]
    assert found[0] and found[0][0][0] == "phone"
    assert found[1] == [("ip", "10[.]20[.]0[.]12")]
    assert found[2] == []


def test_whole_texts_and_odd_rows(spark, network):
    rows = tricky()
    far = "word " * 30_000 + "mail a.b@c.de and 1.2.3.4 " + "é" * 1000 + " +1 (415) 555-2671"
    rows += [(9000, far, None, None, None, "h", "x"), (9001, "1" * 50_000, None, None, None, "h", "x")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("host", "spans").withColumnRenamed("site", "found_spans")
    found = P.find(docs, network)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "found_spans", "spans"]
    for row in found.collect():
        base = [(s["kind"], s["start"], s["end"]) for s in row["spans"] if not s["added"]]
        assert base == plain(row["text"])
    assert P.find(docs.limit(0), network).count() == 0
    untrained = P.train(docs.limit(0))
    assert P.network_spans(untrained, [far]) == [[]]


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    wanted = {row["doc_id"]: plain(row["text"]) for row in docs}
    rows = op13_pii(spark, "/root/testdata/sf0.01").collect()
    assert {row["doc_id"] for row in rows} == set(wanted) and len(rows) == len(docs)
    for row in rows:
        base = wanted[row["doc_id"]]
        names = [f"{kind}:{start}:{end}" for kind, start, end in base]
        assert row["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in P.KINDS] == [sum(s[0] == kind for s in base) for kind in P.KINDS]
        assert set(names) <= set(row["spans"].split(",")) | ({""} if not names else set())
