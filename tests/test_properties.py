"""Operators against brute force in Python on random rows."""

import datetime as dt
import json
import random
from collections import Counter

import pytest

import logframe as lf
from logframe.operators.histogram import AUTO_BUCKETS, AUTO_WIDTHS, _seconds

START = dt.datetime(2024, 5, 1)
EPOCH = dt.datetime(1970, 1, 1)
SPANS = {1: 40, 2: 5_000, 3: 90_000, 4: 40_000_000}


def random_rows(seed: int):
    """Rows with missing times, keys and arrays, over a span that depends on the seed."""
    dice = random.Random(seed)
    rows = []
    for n in range(300):
        later = dt.timedelta(
            seconds=dice.randrange(SPANS[seed]), microseconds=dice.randrange(10**6)
        )
        ts = START + later if dice.random() > 0.05 else None
        # One hot key holds about a third of the rows.
        key = dice.choice([7, 7, 7, *range(20), None])
        tags = dice.choice([None, [], ["a"], ["a", "b", "a"], ["b", None], ["c", "d"]])
        rows.append((n, ts, key, tags))
    return rows


@pytest.fixture(params=sorted(SPANS))
def case(request, spark):
    rows = random_rows(request.param)
    docs = spark.createDataFrame(rows, "id int, ts timestamp_ntz, k int, tags array<string>")
    middle = START + dt.timedelta(seconds=SPANS[request.param] // 2)
    end = START + dt.timedelta(seconds=SPANS[request.param])
    return rows, docs, middle, end


def ranked(counts: Counter) -> list:
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))


def test_terms(case):
    rows, docs, middle, end = case
    keys = Counter(r[2] for r in rows if r[2] is not None)
    assert [tuple(r) for r in lf.terms(docs, "k", size=10**6).collect()] == ranked(keys)
    later = Counter(r[2] for r in rows if r[1] and middle <= r[1] <= end and r[2] is not None)
    found = lf.terms(docs, "k", None, middle, end, "ts", size=5).collect()
    assert [tuple(r) for r in found] == ranked(later)[:5]
    tags = Counter(tag for r in rows for tag in set(r[3] or []) if tag is not None)
    assert [tuple(r) for r in lf.terms(docs, "tags").collect()] == ranked(tags)
    lists = [{"id": "k", "field": "k", "size": 4}, {"id": "t", "field": "tags"}]
    both = lf.multi_terms(docs, lists)
    wanted = [("k", str(k), n) for k, n in ranked(keys)[:4]]
    wanted += [("t", t, n) for t, n in ranked(tags)]
    assert sorted(tuple(r) for r in both.collect()) == sorted(wanted)


def bucket(moment: dt.datetime, width: int) -> int:
    return (moment - EPOCH) // dt.timedelta(seconds=width) * width


def test_histograms(case):
    rows, docs, middle, end = case
    inside = [r[1] for r in rows if r[1] and middle <= r[1] <= end]
    width = max(int((end - middle).total_seconds()) // 60, 1)
    counts = Counter(bucket(t, width) for t in inside)
    grid = range(bucket(middle, width), bucket(end, width) + 1, width)
    found = lf.histogram(docs, middle, end, "ts", f"{width}s").collect()
    assert [tuple(r) for r in found] == [
        (EPOCH + dt.timedelta(seconds=s), counts[s]) for s in grid
    ]
    times = [r[1] for r in rows if r[1]]
    for name in AUTO_WIDTHS:
        width = _seconds(name)
        first, last = bucket(min(times), width), bucket(max(times), width)
        if (last - first) // width + 1 <= AUTO_BUCKETS:
            break
    counts = Counter(bucket(t, width) for t in times)
    found = lf.auto_histogram(docs, ts_field="ts").collect()
    assert [tuple(r) for r in found] == [
        (EPOCH + dt.timedelta(seconds=s), counts[s], name) for s in range(first, last + 1, width)
    ]


@pytest.mark.parametrize("size", [3, 50])
def test_compare(case, size):
    rows, docs, middle, end = case

    def top(low, high):
        inside = [r[2] for r in rows if r[1] and low <= r[1] <= high and r[2] is not None]
        return dict(ranked(Counter(inside))[:size])

    before, after = top(START, middle), top(middle, end)
    wanted = {}
    for key in before.keys() | after.keys():
        b, s = before.get(key), after.get(key)
        if b is None:
            wanted[key] = ("added", b, s, None)
        elif s is None:
            wanted[key] = ("removed", b, s, None)
        else:
            wanted[key] = ("unchanged" if b == s else "changed", b, s, s - b)
    found = lf.compare(docs, "k", START, middle, middle, end, ts_field="ts", size=size).collect()
    assert {r.key: tuple(r)[1:5] for r in found} == wanted
    deltas = [abs(r.delta) for r in found if r.status == "changed"]
    assert deltas == sorted(deltas, reverse=True)


def random_value(dice: random.Random, depth: int):
    kinds = ["int", "float", "text", "list", "null", "flag"] + ["object"] * (3 if depth < 5 else 0)
    kind = dice.choice(kinds)
    if kind == "object":
        names = [dice.choice("abc{") for _ in range(dice.randrange(4))]
        return {name: random_value(dice, depth + 1) for name in names}
    return {
        "int": dice.randrange(100),
        "float": dice.randrange(100) + 0.25,
        "text": dice.choice(["{", "}", "x {y} z", ""]),
        "list": [1, 2],
        "null": None,
        "flag": True,
    }[kind]


def leaves(value, path):
    if isinstance(value, dict):
        for name, member in value.items():
            yield from leaves(member, f"{path}.{name}")
        return
    names = {int: "bigint", float: "double", str: "string", list: "array<bigint>", bool: "boolean"}
    yield path, names.get(type(value), "void")


@pytest.mark.parametrize("seed", [1, 2])
def test_json_leaves(spark, seed):
    dice = random.Random(seed)
    docs = [random_value(dice, 0) for _ in range(60)]
    wanted = Counter(leaf for doc in docs for leaf in leaves(doc, "doc"))
    table = spark.createDataFrame([(json.dumps(doc),) for doc in docs], "doc string")
    found = lf.discover_fields(table, ts_field="doc", sample_size=None, json_fields=["doc"])
    assert {(r.field, r.type): r.n_docs for r in found.collect()} == dict(wanted)


WORDS = ["red", "Red", "reddish", "blue", "BLUE_red", "über", "Überall", "x1", "1", "straße", "…"]
GAPS = [" ", "  ", "\n", ", ", "_", "'"]


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    dice = random.Random(seed)
    texts = [
        "".join(dice.choice(WORDS) + dice.choice(GAPS) for _ in range(dice.randrange(8)))
        for _ in range(80)
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string")

    def split(text):
        words, word = [], ""
        for char in text.lower() + " ":
            if char.isalnum():
                word += char
            elif word:
                words.append(word)
                word = ""
        return words

    def ids(where):
        return sorted(r.id for r in table.filter(where).collect())

    words = [split(text) for text in texts]
    for asked in (["red"], ["über", "x1"], ["straße", "blue"]):
        any_of = [n for n, w in enumerate(words) if set(asked) & set(w)]
        all_of = [n for n, w in enumerate(words) if set(asked) <= set(w)]
        in_a_row = [
            n
            for n, w in enumerate(words)
            if any(w[i : i + len(asked)] == asked for i in range(len(w)))
        ]
        assert ids(lf.match_text(table, "text", asked)) == any_of
        assert ids(lf.match_text(table, "text", asked, "all")) == all_of
        assert ids(lf.match_text(table, "text", asked, "phrase")) == in_a_row
        scores = lf.text_score(table, "text", asked, "id").collect()
        assert {(r.id, r.word): r.tf for r in scores} == {
            (n, a): w.count(a) for n, w in enumerate(words) for a in asked if a in w
        }
