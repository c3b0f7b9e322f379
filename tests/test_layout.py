"""Tables laid out for questions: typed JSON members, days as partitions, word postings."""

import datetime as dt
import random
import re

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

import logframe as lf
from logframe.operators import postings as postings_module
from logframe.functions.times import parse_time
from registered.queries import table
from tests.test_plans import executed

ROOT = "/root/testdata/sf0.01"


# JSON members in columns of their own.


@pytest.fixture(scope="module")
def shapes(spark, tmp_path_factory):
    rows = [(n, '{"a": {"b": %d, "c": "x%d"}, "k": %d}' % (n % 7, n, n)) for n in range(400)]
    rows += [(400, '{"k": "12"}'), (401, '{"k": 12.0, "rare": true}'), (402, "no json"), (403, None)]
    rows += [(404, "[1, 2]"), (405, '{"k": null}'), (406, ""), (407, '{"k": 1, "k": 2}'), (408, '{"a": 5}')]
    df = spark.createDataFrame(rows, "id int, body string")
    return df, lf.write_shredded(df, str(tmp_path_factory.mktemp("shredded") / "t"), ["body"])


def test_members_are_the_same_as_from_text(shapes):
    text, stored = shapes
    for inner, kind in (("k", "int"), ("a.b", "int"), ("a.c", "string"), ("rare", "boolean"), ("none", "int")):
        of = lambda df: {r[0]: r[1] for r in df.select("id", lf.json_field(df, "body", inner, kind)).collect()}
        plain, own = of(text), of(stored)
        # The number 12.0 read as a whole one is where text and number differ.
        assert {i: v for i, v in own.items() if i not in (401, 407)} == {
            i: v for i, v in plain.items() if i not in (401, 407)
        }
    assert stored.filter("id = 402").first()["body"].toPython() == "no json"
    assert stored.filter("id = 403").first()["body"] is None
    assert lf.discover_fields(stored, ts_field="id", sample_size=None, json_fields=["body"]).count() > 3
    with pytest.raises(ValueError, match="no text"):
        lf.shredded(text, ["id"])
    typed = lf.member_types(stored.filter("id < 400"), "body").first()["type"]
    assert typed == "OBJECT<a: OBJECT<b: BIGINT, c: STRING>, k: BIGINT>"


def test_a_range_on_a_member_reads_its_column_alone(spark, shapes):
    _, stored = shapes
    count = lf.count(stored, lf.between(stored, lf.json_field(stored, "body", "a.b", "int"), 2, 3))
    assert count.first()["count"] == sum(n % 7 in (2, 3) for n in range(400))
    plan = executed(count)
    assert "ReadSchema: struct<body:struct<0:int>>" in plan
    assert "GreaterThanOrEqual(body.`0`,2)" in plan and "LessThanOrEqual(body.`0`,3)" in plan


# Days as partitions.


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    events = table(spark, ROOT, "events")
    return events, lf.write_daily(events, str(tmp_path_factory.mktemp("daily") / "t"), "ts", parts=3)


def read_files(df):
    """Files that the scans of a query which ran have opened."""
    found, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif "QueryStage" in name:
            stack.append(node.plan())
        else:
            if name.startswith("Scan parquet"):
                found.append(node.metrics().apply("numFiles").value())
            stack += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_a_daily_table_is_the_table(daily):
    events, stored = daily
    assert sorted(map(tuple, stored.select(events.columns).collect())) == sorted(map(tuple, events.collect()))
    assert stored.filter(F.col("day") != F.col("ts").cast("date")).count() == 0
    week = ("2024-01-03", "2024-01-05T12:00:00")
    found = lf.count(stored, lf.day_range(stored, "day", *week), *week, "ts")
    assert found.collect() == lf.count(events, None, *week, "ts").collect()
    assert read_files(found) == [3]  # small parts of a day are one file
    with pytest.raises(ValueError, match="already"):
        lf.write_daily(stored, "nowhere", "ts")


def test_days_of_spikes_are_pruned_while_the_query_runs(daily):
    events, stored = daily
    span = ("2024-01-01", "2024-01-30T23:59:59")
    asked = dict(ts_field="ts", interval="1h", z_limit=2.5)
    plain = lf.spike_rows(events, *span, **asked)
    pruned = lf.spike_rows(stored, *span, day_column="day", **asked)
    rows = pruned.select(*events.columns, "bucket").collect()
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, plain.select(*events.columns, "bucket").collect()))
    pruned.collect()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastNestedLoopJoin" not in plan
    days = {row["bucket"].date() for row in rows}
    assert sorted(read_files(pruned)) == [len(days), 30]


def test_buckets_wider_than_a_day_and_rows_without_a_time(spark, tmp_path):
    rows = [(n, f"2024-01-{n % 20 + 1:02d}T{n % 24:02d}:30:00") for n in range(200)] + [(200, None)]
    df = spark.createDataFrame(rows, "n int, at string").withColumn("ts", F.col("at").cast("timestamp_ntz"))
    stored = lf.write_daily(df, str(tmp_path / "t"), "ts")
    assert stored.count() == 201 and stored.filter("day is null").count() == 1
    for interval, days in (("3d", 3), ("36h", 1.5), ("1d", 1)):
        width = int(days * 86400)
        buckets = lf.histogram(df, "2024-01-02", "2024-01-15", "ts", interval).filter("doc_count > 25").select("bucket")
        starts = [row["bucket"] for row in buckets.collect()]
        inside = lambda text: text and any(
            s <= parse_time(text) < s + dt.timedelta(seconds=width) for s in starts
        )
        wanted = sorted(n for n, text in rows if inside(text))
        for frame, day in ((df, None), (stored, "day")):
            found = lf.during(frame, buckets, interval, "ts", day)
            assert sorted(row["n"] for row in found.collect()) == wanted


# Postings.


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "delta", "élan", "x1", "of"]
    joins = [" ", "-", ", ", "_", "\n", "  ", "."]
    rows = [
        (n, "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randrange(25)))) for n in range(300)
    ]
    rows += [(300, None), (301, ""), (302, " ,; "), (None, "alpha beta"), (303, "alphabeta gammas")]
    rows += [(304, "of " * 3000 + "gamma delta"), (305, "alpha alpha alpha")]
    df = spark.createDataFrame(rows, "id bigint, body string")
    return df, lf.write_postings(df, str(tmp_path_factory.mktemp("postings") / "t"), "body", "id", folders=5, parts=2)


@pytest.mark.parametrize("mode", ["any", "all", "phrase"])
@pytest.mark.parametrize("words", ["alpha", "Alpha beta", "gamma delta", "alpha alpha", "of of of élan", "X1, of", "none"])
def test_postings_find_what_match_text_finds(texts, mode, words):
    df, postings = texts
    known = df.filter("id is not null")
    wanted = {row["id"] for row in known.filter(lf.match_text(known, "body", words, mode)).collect()}
    found = [row["doc"] for row in lf.search_postings(postings, words, mode, folders=5).collect()]
    assert sorted(found) == sorted(wanted)


def test_word_counts(texts):
    df, postings = texts
    counts = {row["word"]: (row["doc_count"], row["uses"]) for row in lf.word_counts(postings).collect()}
    wanted = {}
    for row in df.filter("id is not null").collect():
        own = [w for w in re.split(r"[\W_]+", (row["body"] or "").lower()) if w]
        for word in set(own):
            docs, uses = wanted.get(word, (0, 0))
            wanted[word] = (docs + 1, uses + own.count(word))
    assert counts == wanted
    with pytest.raises(ValueError, match="any, all or phrase"):
        lf.search_postings(postings, "x", "near")


def test_a_search_opens_the_folders_of_its_words(texts):
    _, postings = texts
    found = lf.search_postings(postings, "gamma delta", "all", folders=5)
    plan = executed(found)
    assert plan.count("FileScan") == 1 and "PartitionFilters: [" in plan
    assert "EqualTo(word,gamma)" in plan and "EqualTo(word,delta)" in plan
    assert "body" not in plan
    one = lf.search_postings(postings, "gamma", folders=5)
    one.collect()
    assert read_files(one)[0] <= 2  # one folder, in two parts at most


def test_postings_group_few_words_at_a_time(monkeypatch):
    sizes, grouped = [], postings_module._grouped

    def spy(batch, folders):
        sizes.append(int(pc.sum(batch["words"].value_lengths()).as_py()))
        return grouped(batch, folders)

    monkeypatch.setattr(postings_module, "_grouped", spy)
    words = pa.array([[f"w{i % 50}" for i in range(1000)]] * 900)
    batch = pa.RecordBatch.from_arrays([pa.array(range(900)), words], ["doc", "words"])
    rows = sum(out.num_rows for out in postings_module._runs(4)([batch]))
    assert sum(sizes) == 900_000 and max(sizes) <= 250_000 and rows == 900 * 4
