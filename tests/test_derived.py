"""Trigram filters, joins with windows, rollups and sketches by day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import logframe as lf
from logframe.functions.predicates import wildcard_runs
from logframe.operators.rollup import cover
from logframe.sources.trigrams import required_trigrams
from registered.queries import table
from tests.test_layout import read_files

ROOT = "/root/testdata/sf0.01"


# Trigrams.


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    rng = random.Random(8)
    folder = tmp_path_factory.mktemp("files with space%")
    rows = [(n, "".join(rng.choice("abcé%_* \\") for _ in range(rng.randrange(12)))) for n in range(600)]
    rows += [(600, None), (601, "only here: needle in a haystack"), (602, "")]
    df = spark.createDataFrame(rows, "n int, s string")
    path, index = str(folder / "t"), str(folder / "index")
    df.repartitionByRange(24, "n").write.parquet(path)
    lf.index_trigrams(spark.read.parquet(path), "s", bitmaps=2).write.parquet(index)
    return spark.read.parquet(path), path, spark.read.parquet(index)


def test_no_match_is_lost(spark, many_files):
    df, path, index = many_files
    rng = random.Random(9)
    texts = [row["s"] for row in df.filter("char_length(s) > 4").collect()]
    for _ in range(25):
        text = rng.choice(texts)
        a = rng.randrange(len(text))
        piece = list(text[a : a + rng.randint(1, 6)])
        piece = ["\\" + c if c in "*?\\" else c for c in piece]
        if rng.random() < 0.5:
            piece[rng.randrange(len(piece))] = rng.choice("?*")
        pattern = rng.choice(["*", ""]) + "".join(piece) + rng.choice(["*", "?", ""])
        wanted = sorted(row["n"] for row in df.filter(lf.wildcard(df, "s", pattern)).collect())
        found = lf.scan_like(spark, path, index, "s", pattern, bitmaps=2)
        assert sorted(row["n"] for row in found.collect()) == wanted, pattern


def test_few_files_are_opened(spark, many_files):
    df, path, index = many_files
    found = lf.scan_like(spark, path, index, "s", "*needle in*", bitmaps=2)
    assert [row["n"] for row in found.collect()] == [601]
    assert read_files(found) == [1] and len(df.inputFiles()) > 15
    assert lf.scan_like(spark, path, index, "s", "*nowhere to be found*", bitmaps=2).count() == 0
    assert lf.files_like(index, "ab*", bitmaps=2) is None
    assert index.count() <= 2 * len(df.inputFiles())


def test_runs_of_a_pattern():
    assert wildcard_runs(r"ab?c\*d*\?e\\") == ["ab", "c*d", "?e\\"]
    assert required_trigrams(r"*abcd?ef*abc") == ["abc", "bcd"]


# Windows.


def test_windows_like_brute_force(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    moment = lambda: start + dt.timedelta(seconds=rng.randrange(4 * 86400), microseconds=rng.choice([0, 0, 999_999]))
    rows = [(n, moment()) for n in range(400)] + [(400, None), (401, start), (401, start)]
    windows = []
    for n in range(40):
        low = moment()
        windows.append((n, low, low + dt.timedelta(seconds=rng.choice([0, 1, 300, 7200, 100_000, -5]))))
    windows += [(40, rows[3][1], rows[3][1]), (41, None, start), (42, start, None), (43, *windows[5][1:]), (44, *windows[5][1:])]
    df = spark.createDataFrame(rows, "n int, at timestamp_ntz")
    spans = spark.createDataFrame(windows, "w int, start timestamp_ntz, end timestamp_ntz")
    wanted = sorted(
        (n, w) for n, at in rows for w, low, high in windows if at and low and high and low <= at <= high
    )
    assert len(wanted) > 500
    for interval, parts in (("1h", 8), ("10m", 1), ("30d", 3)):
        found = lf.in_windows(df, spans, "at", interval=interval, parts=parts)
        assert sorted((row["n"], row["w"]) for row in found.collect()) == wanted
    plan = lf.in_windows(df, spans, "at")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert lf.in_windows(df, spans.limit(0), "at").count() == 0
    with pytest.raises(ValueError, match="both have"):
        lf.in_windows(df.withColumnRenamed("n", "W"), spans, "at")


# Rollups.


def test_cover():
    rng = random.Random(1)
    for _ in range(500):
        low, high = sorted(rng.randrange(-5000, 5000) * 60 for _ in range(2))
        pieces = cover(low, high, [60, 3600, 86400])
        assert len(pieces) <= 5 and sum(b - a for _, a, b in pieces) == high - low
        assert all(a % w == 0 and b % w == 0 and a < b for w, a, b in pieces)
        at = low
        for _, a, b in pieces:
            assert a == at
            at = b


@pytest.fixture(scope="module")
def rollup(spark, tmp_path_factory):
    events = table(spark, ROOT, "events").unionByName(
        spark.sql(
            "select -1L event_id, timestamp_ntz'1969-12-31 23:59:59.5' ts, 1L user_id, 'x' event_type, 0d value, '' props "
            "union all select -2L, cast(null as timestamp_ntz), 1L, 'x', 0d, ''"
        )
    )
    folder = tmp_path_factory.mktemp("rollup")
    events.write.parquet(str(folder / "events"))
    events = spark.read.parquet(str(folder / "events"))
    return events, lf.write_rollup(events, str(folder / "t"), "ts")


def test_rolled_histograms_equal_plain_ones(rollup):
    events, kept = rollup
    rng = random.Random(2)
    spans = [("1969-12-31T20:00:00", "1970-01-01T02:00:00", "1h"), ("2024-01-05", "2024-01-05", "1d")]
    for _ in range(8):
        low = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(20 * 86400), microseconds=rng.choice([0, 1]))
        high = low + dt.timedelta(seconds=rng.choice([3, 59, 4000, 90_000, 700_000]))
        spans.append((low.isoformat(), high.isoformat(), rng.choice(["30s", "5m", "1h", "90m", "7h", "1d", "1w"])))
    for low, high, interval in spans:
        plain = lf.histogram(events, low, high, "ts", interval).collect()
        assert lf.rolled_histogram(events, kept, low, high, "ts", interval).collect() == plain


def test_rows_are_read_at_the_ends_only(rollup):
    events, kept = rollup
    found = lf.rolled_histogram(events, kept, "2024-01-02T00:00:30", "2024-01-28T10:30:59", "ts", "1d")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts,2024-01-02T00:01)" in plan and "GreaterThanOrEqual(ts,2024-01-28T10:30)" in plan
    assert found.agg(F.sum("doc_count")).first()[0] == lf.count(events, None, "2024-01-02T00:00:30", "2024-01-28T10:30:59", "ts").first()[0]
    with pytest.raises(ValueError, match="multiple"):
        lf.write_rollup(events, "nowhere", "ts", ("1m", "90s"))


# Sketches.


def test_merged_sketches(spark):
    lines = table(spark, ROOT, "lineitem").withColumn("month", F.trunc("l_shipdate", "month").cast("timestamp_ntz"))
    sketches = lf.fan_out_sketches(lines, "l_suppkey", "l_partkey", "month")
    merged = {row["l_suppkey"]: row["fan_out"] for row in lf.fan_out_of(sketches, "l_suppkey").collect()}
    once = lines.groupBy("l_suppkey").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(F.col("l_partkey").cast("string"), F.lit(12))).alias("n")
    )
    exact = {row["l_suppkey"]: row["fan_out"] for row in lf.fan_out(lines, "l_suppkey", "l_partkey").collect()}
    assert set(merged) == set(exact)
    for row in once.collect():
        # Merging days adds no error to speak of, and both are near the truth.
        assert abs(merged[row["l_suppkey"]] - row["n"]) <= 0.05 * row["n"]
        assert abs(merged[row["l_suppkey"]] - exact[row["l_suppkey"]]) <= 0.08 * exact[row["l_suppkey"]]
    part = lf.fan_out_of(sketches, "l_suppkey", size=5).collect()
    assert len(part) == 5 and part == sorted(part, key=lambda r: (-r["fan_out"], r["l_suppkey"]))


def test_merged_tops(spark):
    events = table(spark, ROOT, "events")
    sketches = lf.top_sketches(events, "user_id", "ts")
    assert sketches.count() == events.select(F.col("ts").cast("date")).distinct().count()
    found = [tuple(row) for row in lf.top_of(sketches, 5, "2024-01-03", "2024-01-20").collect()]
    exact = lf.terms(events, "user_id", None, "2024-01-03", "2024-01-20T23:59:59.999999", "ts", size=200).collect()
    counts = {row[0]: row[1] for row in exact}
    assert [n for _, n in found] == sorted(counts.values(), reverse=True)[:5]
    assert all(counts[key] == n for key, n in found)


# Several fields in order.


def test_zordered_files_are_boxes(spark, tmp_path):
    rng = random.Random(6)
    rows = [
        (n, rng.gauss(0, 1), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(50_000)), None if n % 50 == 0 else f"v{rng.randrange(90)}")
        for n in range(6000)
    ]
    rows += [(6000, None, None, None), (6001, float("nan"), None, "")] + [(6002 + n, 0.5, rows[0][2], "same") for n in range(3000)]
    df = spark.createDataFrame(rows, "n int, x double, at timestamp_ntz, s string")
    stored = lf.write_zordered(df, str(tmp_path / "z"), ["x", "at"], parts=16)
    assert sorted(row["n"] for row in stored.collect()) == [row[0] for row in rows]
    df.repartition(16).write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    read = {}
    for name, table_ in (("z", stored), ("plain", plain)):
        where = lf.all_of(lf.between(table_, "x", 0.6, 1.2), lf.time_range(table_, "at", "2024-01-05", "2024-01-10"))
        found = table_.filter(where)
        numbers = sorted(row["n"] for row in found.collect())
        read[name] = (numbers, scanned_rows(found))
    assert read["z"][0] == read["plain"][0] and read["z"][0]
    assert read["z"][1] < read["plain"][1] / 3
    three = lf.write_zordered(df, str(tmp_path / "three"), ["x", "at", "s"], parts=4, bits=3)
    assert three.count() == len(rows)
    assert lf.write_zordered(df.limit(0), str(tmp_path / "none"), ["x", "at"], parts=4).count() == 0
    for fields, bits in ((["x"], 6), (["x", "x"], 6), (["x", "at"], 32)):
        with pytest.raises(ValueError):
            lf.write_zordered(df, "nowhere", fields, 4, bits)


def scanned_rows(df):
    """Rows that the scan of a plain filter handed on."""
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        stack += [node.children().apply(i) for i in range(node.children().size())]


# Chains.


def test_reachable_like_a_search(spark):
    rng = random.Random(12)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (f"h{rng.randrange(40)}", f"h{rng.randrange(40)}", start + dt.timedelta(hours=rng.randrange(200))) for _ in range(150)
    ]
    rows += [("hub", f"h{n}", start + dt.timedelta(hours=n)) for n in range(40)] + [(f"h{n}", "hub", start) for n in range(20)]
    rows += [(None, "h1", start), ("h1", None, start), ("h1", "h2", None)]
    df = spark.createDataFrame(rows, "src string, dst string, at timestamp_ntz")
    for hops in (1, 2, 4):
        best = {"h1": None, "h7": None}  # the earliest time within the hops so far
        wanted = {value: (0, None) for value in best}
        for hop in range(1, hops + 1):
            met = {}
            for src, dst, at in rows:
                if src in best and dst and at and (best[src] is None or at >= best[src]):
                    met[dst] = min(met.get(dst, at), at)
            for value, at in met.items():
                wanted.setdefault(value, (hop, at))
                if value not in best or best[value] is not None and at < best[value]:
                    best[value] = at
        for parts in (1, 5):
            found = lf.reachable(df, ["h1", "h7"], "src", "dst", hops, ts_field="at", parts=parts)
            assert {row["value"]: (row["hop"], row["at"]) for row in found.collect()} == wanted
    assert lf.reachable(df.limit(0), ["h1"], "src", "dst", 3, ts_field="at").count() == 1
    with pytest.raises(ValueError):
        lf.reachable(df, ["h1"], "src", "dst", 0, ts_field="at")
