"""Operators on nested documents with missing values, ties, arrays and boundary instants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import logframe as lf
from logframe.operators.aggregate import keyed_counts
from tests.alerts import BASELINE, FROM, ROWS, SELECTION, TO, alerts, at


@pytest.fixture(scope="module")
def docs(spark):
    return alerts(spark).cache()


def ids(df):
    return [r["_id"] for r in df.collect()]


def matched(docs, where):
    return sorted(ids(docs.filter(where)))


def test_time_bounds_are_inclusive(docs):
    found = matched(docs, lf.time_range(docs, "@timestamp", FROM, TO))
    assert "a01" in found and "a02" in found
    assert "a03" not in found and "a04" not in found and "a11" not in found
    assert lf.count(docs, None, FROM, TO).first()["count"] == len(found) == 10


def test_open_time_range_keeps_rows_without_time(docs):
    assert lf.count(docs).first()["count"] == len(ROWS)
    assert lf.count(docs, "", FROM).first()["count"] == 12
    assert lf.count(docs, "*", None, FROM).first()["count"] == 4


def test_term_on_nested_and_array_fields(docs):
    assert matched(docs, lf.term(docs, "agent.name", "srv-web01")) == [
        "a05", "a06", "a08", "a12", "a13", "a14",
    ]
    assert matched(docs, lf.term(docs, "rule.groups", "web")) == ["a05", "a06", "a07", "a10"]
    assert matched(docs, lf.term(docs, "no.such.field", 1)) == []


def test_not_keeps_rows_that_lack_the_field(docs):
    found = matched(docs, lf.none_of(lf.term(docs, "agent.name", "WIN-DC01")))
    assert "a10" in found and "a01" not in found
    assert len(found) == 7


def test_between_open_ends(docs):
    assert matched(docs, lf.between(docs, "rule.level", 12, "*")) == [
        "a05", "a06", "a07", "a10", "a13", "a14",
    ]
    assert matched(docs, lf.between(docs, "rule.level", None, 3)) == ["a15", "a16"]
    assert matched(docs, lf.between(docs, "rule.level")) == matched(
        docs, lf.exists(docs, "rule.level")
    )


def test_exists(docs):
    assert "a10" not in matched(docs, lf.exists(docs, "agent"))
    assert "a09" not in matched(docs, lf.exists(docs, "rule.level"))
    groups = matched(docs, lf.exists(docs, "rule.groups"))
    assert "a13" not in groups and "a15" not in groups and "a01" in groups
    assert matched(docs, lf.exists(docs, "nothing")) == []


def test_wildcard(docs):
    assert matched(docs, lf.wildcard(docs, "agent.name", "srv-*")) == matched(
        docs, lf.term(docs, "agent.name", "srv-web01")
    )
    assert len(matched(docs, lf.wildcard(docs, "data.srcip", "10.0.0.?"))) == 15
    assert matched(docs, lf.wildcard(docs, "rule.groups", "w*b")) == ["a05", "a06", "a07", "a10"]
    # A percent sign, an underscore and an escaped star are plain characters.
    assert matched(docs, lf.wildcard(docs, "rule.id", "%")) == []
    assert matched(docs, lf.wildcard(docs, "rule.id", "_warn*")) == ["a15", "a16"]
    assert matched(docs, lf.wildcard(docs, "rule.id", "_warnin\\*")) == []


def test_text(docs):
    description = "rule.description"
    assert matched(docs, lf.match_text(docs, description, "APACHE, seen")) == [
        "a05", "a06", "a07", "a10", "a13", "a14",
    ]
    assert matched(docs, lf.match_text(docs, description, "failed root", "all"))[0] == "a01"
    assert "a09" not in matched(docs, lf.match_text(docs, description, "failed root", "all"))
    # The underscore parts words; a word inside a longer one is no match.
    both = ["a05", "a06", "a07", "a10", "a13", "a14"]
    assert matched(docs, lf.match_text(docs, description, "Apache License", "phrase")) == both
    assert matched(docs, lf.match_text(docs, description, "log", "any")) == []
    spread = lf.match_text(docs, [description, "agent.name"], "dc01 web", "all")
    assert matched(docs, spread) == ["a07"]
    assert matched(docs, lf.phrase(docs, "rule.description", "nothing")) == ["a15", "a16"]
    with pytest.raises(ValueError):
        lf.match_text(docs, description, "--")
    with pytest.raises(ValueError):
        lf.match_text(docs, description, "x", "some")


def test_json_field(spark):
    docs = spark.createDataFrame(
        [('{"rule": {"level": 12}}',), ('{"rule": {"level": "12"}}',), ("{bad",), ("{}",)],
        "doc string",
    )
    level = lf.json_field(docs, "doc", "rule.level", "int")
    assert docs.filter(lf.between(docs, level, 12, 12)).count() == 2
    assert docs.filter(lf.none_of(lf.between(docs, level, 13))).count() == 4
    assert docs.filter(lf.between(docs, level)).count() == 2
    assert [r[0] for r in docs.select(level).collect()] == [12, 12, None, None]
    variant = docs.select(F.try_parse_json("doc").alias("doc"))
    assert [
        r[0] for r in variant.select(lf.json_field(variant, "doc", "rule.level", "int")).collect()
    ] == [12, 12, None, None]


def test_search_order_ties_and_missing_values(docs):
    newest = ids(lf.search(docs, key="_id"))
    assert newest[0] == "a14" and newest[-1] == "a11"
    assert newest[newest.index("a05") :][:3] == ["a05", "a06", "a07"]
    oldest = ids(lf.search(docs, sort_dir="asc", key="_id"))
    assert oldest[0] == "a15" and oldest[-1] == "a11"
    by_level = ids(lf.search(docs, sort_field="rule.level", sort_dir="asc", key="_id"))
    assert by_level[:2] == ["a15", "a16"] and by_level[-2:] == ["a09", "a12"]


def test_search_pages_make_up_the_whole(docs):
    whole = ids(lf.search(docs, key="_id"))
    pages = [ids(lf.search(docs, limit=5, offset=o, key="_id")) for o in range(0, 20, 5)]
    assert sum(pages, []) == whole
    assert ids(lf.search(docs, limit=0)) == []
    assert ids(lf.search(docs, offset=-3, limit=2, key="_id")) == whole[:2]


def test_search_fields(docs):
    page = lf.search(docs, source_fields=["agent.name", "absent", "rule.level"], limit=1)
    assert page.columns == ["agent.name", "rule.level"]
    assert page.first() == ("srv-web01", 15)


def test_search_far_page(docs, monkeypatch):
    monkeypatch.setattr("logframe.operators.rank.MERGED_ROWS", 3)
    whole = ids(lf.search(docs, limit=3, key="_id"))
    for offset in range(3, 18, 4):
        whole += ids(lf.search(docs, limit=4, offset=offset, key="_id"))
    monkeypatch.undo()
    assert whole == ids(lf.search(docs, key="_id"))


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("by", ["@timestamp", "rule.level", "data.bytes", "agent.name", "rule.id"])
def test_search_far_page_by_any_type(docs, monkeypatch, by, direction):
    wanted = ids(lf.search(docs, sort_field=by, sort_dir=direction, key="_id"))
    monkeypatch.setattr("logframe.operators.rank.MERGED_ROWS", 1)
    for offset in (0, 4, 13, 20):
        page = lf.search(docs, sort_field=by, sort_dir=direction, offset=offset, limit=3, key="_id")
        assert ids(page) == wanted[offset : offset + 3]


def test_search_far_page_by_date_and_long_text(spark, monkeypatch):
    rows = [(n, f"same beginning {n * 7919 % 1000:03d}", f"2024-{n % 12 + 1:02d}-11") for n in range(500)]
    rows += [(500, None, None), (501, "", "1960-01-01"), (502, "é", "2024-01-11")]
    df = spark.createDataFrame(rows, "n int, s string, d string").withColumn("d", F.col("d").cast("date"))
    monkeypatch.setattr("logframe.operators.rank.MERGED_ROWS", 10)
    for by in ("s", "d", "n"):
        order = [F.desc_nulls_last(by), F.asc("n")]
        whole = [r.n for r in df.orderBy(*order).collect()]
        far = lf.search(df, ts_field="d", sort_field=by, limit=60, offset=333, key="n")
        assert [r.n for r in far.collect()] == whole[333:393]


def test_limits_are_what_is_asked(docs, spark):
    many = spark.range(3000).withColumn("@timestamp", F.timestamp_seconds("id"))
    assert lf.search(many, limit=2500).count() == 2500
    with pytest.raises(ValueError, match="over the cap"):
        lf.search(many, limit=11, limit_cap=10)
    found = lf.discover_fields(many, sample_size=1500).collect()
    assert {r.n_docs for r in found} == {1500}
    fine = lf.histogram(many, "1970-01-01", "1970-01-01T01:00:00", interval="1s")
    assert fine.count() == 3601
    assert lf.auto_histogram(many, max_buckets=400).count() == 300


def test_types_that_do_not_fit_match_nothing(spark):
    df = spark.createDataFrame(
        [("5710", 7, ["1", "x"]), ("_warning", 12, []), (None, None, None)],
        "id string, n int, many array<string>",
    )
    count = lambda condition: lf.count(df, condition).first()[0]
    assert count(lf.term(df, "id", 5710)) == 1 and count(lf.term(df, "n", "x")) == 0
    assert count(lf.term(df, "n", "12")) == 1 and count(lf.term(df, "many", 1)) == 1
    assert count(lf.between(df, "id", 10, "*")) == 1 and count(lf.between(df, "n", "8", "x")) == 0
    assert count(lf.between(df, "many", 0, 5)) == 1 and count(lf.between(df, F.col("n"), 7, 9)) == 1


def test_text_times_with_an_offset(spark):
    texts = ["2024-03-01T10:00:00Z", "2024-03-01T10:00:00+00:00", "2024-03-01 12:00:00+0200", "2024-03-01T12:00:00", "no"]
    df = spark.createDataFrame([(t,) for t in texts], "ts string")
    assert lf.count(df, None, "2024-03-01T09:59:59", "2024-03-01T10:00:00", "ts").first()[0] == 3
    assert lf.count(df, None, "2024-03-01T13:00:00+03:00", None, "ts").first()[0] == 4
    with pytest.raises(ValueError, match="no field"):
        lf.count(df, None, "2024-03-01", "2024-03-02")


def test_arrays_are_opened_everywhere(spark):
    df = spark.createDataFrame(
        [("a", [1, 2, 2], ["x", "y"]), ("a", [3], ["y"]), ("b", None, None)],
        "k string, n array<int>, d array<string>",
    )
    stats = lf.extended_stats(df, "n").first()
    assert (stats["count"], stats["sum"]) == (3, 6.0)
    assert [tuple(r) for r in lf.fan_out(df, "k", "d").collect()] == [("a", 2), ("b", 0)]
    assert [tuple(r) for r in lf.fan_out(df, "d", "n", size=1).collect()] == [("y", 3)]


def test_text_search_over_all_fields(docs):
    found = matched(docs, lf.match_text(docs, None, "WIN-DC01"))
    assert found == matched(docs, lf.match_text(docs, "agent.name", "WIN-DC01")) and found
    assert matched(docs, lf.match_text(docs, None, "ssh")) == matched(docs, lf.term(docs, "rule.groups", "ssh"))


def test_causes_of_spikes_and_new_peers(spark):
    rows = [(f"2024-03-01T{h:02d}:00:00", "u", f"h{h % 3}") for h in range(20)]
    rows += [("2024-03-01T07:30:00", "u", "burst")] * 50
    df = spark.createDataFrame(rows, "at string, who string, host string").withColumn("@timestamp", F.col("at").cast("timestamp_ntz"))
    day = ("2024-03-01", "2024-03-01T23:00:00")
    found = lf.top_offenders(df, ["host"], *day, spike_interval="1h", causes=1)["causes"].collect()
    assert [(str(r.bucket), r.id, r.key, r.doc_count) for r in found] == [("2024-03-01 07:00:00", "host", "burst", 50)]
    parts = lf.investigate(
        df, "who", "u", "2024-03-01T07:00:00", day[1], rule_field="host", description_field=None,
        severity_field="host", min_severity="", peer_fields=["host"], before="2024-03-01",
    )
    assert [tuple(r) for r in parts["peers"].collect()] == [("host", 4)]
    assert [tuple(r) for r in parts["new_peers"].collect()] == [("host", "burst", 50)]


def test_terms(docs):
    rows = lf.terms(docs, "agent.name").collect()
    assert [tuple(r) for r in rows] == [("WIN-DC01", 9), ("srv-web01", 6)]
    tied = lf.terms(docs, "rule.id", "`rule`.`id` in ('99001', '_warning')").collect()
    assert [tuple(r) for r in tied] == [("99001", 2), ("_warning", 2)]
    assert lf.terms(docs, "rule.id", size=1).collect() == [("5710", 7)]


def test_terms_of_an_array_count_a_document_once(docs):
    rows = {r[0]: r[1] for r in lf.terms(docs, "rule.groups").collect()}
    assert rows == {"auth": 7, "ssh": 6, "web": 4}


def test_multi_terms_are_separate_terms(docs):
    fields = ["rule.level", "agent.name", "rule.groups", "data.dstip"]
    sizes = [2, 50, 50, 1]
    # Without the array field, and with it, which changes how rows are unfolded.
    for chosen in ([0, 1, 3], [0, 1, 2, 3]):
        wanted = [
            (fields[n], str(r[0]), r[1])
            for n in chosen
            for r in lf.terms(docs, fields[n], size=sizes[n]).collect()
        ]
        specs = [{"id": fields[n], "field": fields[n], "size": sizes[n]} for n in chosen]
        found = [tuple(r) for r in lf.multi_terms(docs, specs).collect()]
        assert sorted(found) == sorted(wanted)
        for ident in fields:
            ranked = [f for f in found if f[0] == ident]
            assert ranked == [w for w in wanted if w[0] == ident]


def test_long_tops_are_the_same(docs, monkeypatch):
    """Sizes beyond what one task may merge take another way to the same rows."""
    lists = [{"id": "r", "field": "rule.id", "size": 9}, {"id": "g", "field": "rule.groups"}]
    calls = [
        lambda: lf.multi_terms(docs, lists),
        lambda: lf.terms(docs, "agent.name"),
        lambda: lf.compare(docs, "rule.id", *BASELINE, *SELECTION),
        lambda: lf.compare_report(docs, ["rule.id", "agent.name"], *BASELINE, *SELECTION),
        lambda: lf.histogram(docs, FROM, TO, interval="10m"),
    ]
    usual = [call().collect() for call in calls]
    monkeypatch.setattr("logframe.operators.rank.MERGED_ROWS", 2)
    assert [call().collect() for call in calls] == usual


def test_multi_terms_ties_follow_the_value_not_its_text(spark):
    docs = spark.createDataFrame([(n, "x") for n in (100, 20, 3)], "n int, s string")
    found = lf.multi_terms(docs, [{"id": "n", "field": "n"}, {"id": "s", "field": "s"}])
    assert [r.key for r in found.collect() if r.id == "n"] == ["3", "20", "100"]


def test_multi_terms_same_field_twice(docs):
    specs = [
        {"id": "one", "field": "agent.name", "size": 1},
        {"id": "two", "field": "agent.name"},
    ]
    found = sorted(tuple(r) for r in lf.multi_terms(docs, specs).collect())
    assert found == [("one", "WIN-DC01", 9), ("two", "WIN-DC01", 9), ("two", "srv-web01", 6)]
    with pytest.raises(ValueError):
        lf.multi_terms(docs, [])
    with pytest.raises(ValueError):
        lf.multi_terms(docs, [specs[0], specs[0]])


def test_histogram_has_every_bucket(docs):
    rows = lf.histogram(docs, FROM, TO, interval="30m").collect()
    half_hours = [at("01:00") + dt.timedelta(minutes=30 * n) for n in range(9)]
    assert [r.bucket for r in rows] == half_hours
    assert [r.doc_count for r in rows] == [1, 0, 3, 0, 1, 0, 1, 3, 1]
    assert sum(r.doc_count for r in rows) == lf.count(docs, None, FROM, TO).first()["count"]


def test_histogram_without_rows(docs):
    rows = lf.histogram(docs, "2030-01-01", "2030-01-02", interval="6h").collect()
    assert [r.doc_count for r in rows] == [0, 0, 0, 0, 0]
    assert lf.auto_histogram(docs, "2030-01-01", "2030-01-02").collect() == []


def test_auto_histogram(docs):
    rows = lf.histogram(docs, None, None, interval="auto").collect()
    assert {r.interval_used for r in rows} == {"10m"}
    assert rows[0].bucket == at("00:10") and rows[-1].bucket == at("05:10")
    assert len(rows) == 31 and sum(r.doc_count for r in rows) == 15
    one = lf.auto_histogram(docs, where=lf.term(docs, "_id", "a05")).collect()
    assert [tuple(r) for r in one] == [(at("02:10"), 1, "1s")]


def test_buckets_before_1970_round_down(spark):
    docs = spark.sql("""
      select * from values
        (timestamp_ntz'1969-12-31 23:59:59.5'), (timestamp_ntz'1969-12-31 23:59:59'),
        (timestamp_ntz'1970-01-01 00:00:00.4') t(ts)""")
    rows = lf.histogram(docs, "1969-12-31T23:59:58", "1970-01-01T00:00:00.5", "ts", "1s").collect()
    assert [r.doc_count for r in rows] == [0, 2, 1]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_times_do_not_depend_on_the_session_zone(spark, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = spark.createDataFrame(
            [("2024-03-10T06:59:59Z",), ("2024-03-10T07:00:00Z",), ("2024-03-10T23:59:59Z",)],
            "ts string",
        )
        docs = text if kind == "string" else text.select(F.col("ts").cast(kind))
        found = lf.count(docs, None, "2024-03-10T07:00:00Z", "2024-03-11", "ts")
        assert found.first()["count"] == 2
        rows = lf.histogram(docs, "2024-03-10", "2024-03-10T23:59:59Z", "ts", "1h")
        seconds = rows.select(
            F.unix_timestamp("bucket").alias("s"), "doc_count"
        ).collect()
        midnight = 1710028800
        assert {(r.s - midnight) // 3600: r.doc_count for r in seconds if r.doc_count} == {
            6: 1, 7: 1, 23: 1,
        }
        days = lf.scan_daily(docs, "log", "log-2024.03.10", "ts")
        assert [r[0] for r in days.select("_index").distinct().collect()] == ["log-2024.03.10"]
        assert days.count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_date_column_as_time_field(spark):
    docs = spark.sql("select * from values (date'2024-03-01'), (date'2024-03-02') t(day)")
    assert lf.count(docs, None, "2024-03-01T00:00:01", None, "day").first()["count"] == 1
    assert lf.count(docs, None, "2024-03-01", "2024-03-01", "day").first()["count"] == 1


def test_stats(docs):
    row = lf.extended_stats(docs, "data.bytes", None, FROM, TO).first()
    assert (row["count"], row["min"], row["max"]) == (7, 100, 9_000_000_000)
    assert row["sum"] == 36_000_000_300.0
    empty = lf.extended_stats(docs, "rule.level", lf.term(docs, "_id", "none")).first()
    assert tuple(empty) == (0, None, None, None, None, None)
    with pytest.raises(ValueError, match="not a number"):
        lf.extended_stats(docs, "rule.id")


def test_compare(docs):
    rows = lf.compare(docs, "rule.id", *BASELINE, *SELECTION).collect()
    assert [tuple(r) for r in rows] == [
        ("99001", "added", None, 2, None, None),
        ("_warning", "removed", 2, None, None, None),
        ("31101", "changed", 3, 1, -2, -66.7),
        ("5710", "changed", 3, 4, 1, 33.3),
    ]


def test_compare_shares_the_touching_instant(docs):
    only = lf.term(docs, "_id", "a08")
    rows = lf.compare(docs, "agent.name", *BASELINE, *SELECTION, where=only).collect()
    assert [tuple(r) for r in rows] == [("srv-web01", "unchanged", 1, 1, 0, None)]


def test_compare_top_cut_and_exact(docs):
    cut = {r.key: r for r in lf.compare(docs, "rule.id", *BASELINE, *SELECTION, size=1).collect()}
    assert cut["31101"].status == "removed" and cut["5710"].status == "added"
    exact = {
        r.key: r
        for r in lf.compare(docs, "rule.id", *BASELINE, *SELECTION, size=1, exact=True).collect()
    }
    assert tuple(exact["31101"])[1:5] == ("changed", 3, 1, -2)
    assert tuple(exact["5710"])[1:5] == ("changed", 3, 4, 1)


def test_compare_with_itself_and_swapped(docs):
    same = lf.compare(docs, "rule.id", *BASELINE, *BASELINE).collect()
    assert same and {r.status for r in same} == {"unchanged"}
    there = {r.key: r for r in lf.compare(docs, "agent.name", *BASELINE, *SELECTION).collect()}
    back = {r.key: r for r in lf.compare(docs, "agent.name", *SELECTION, *BASELINE).collect()}
    swapped = {"added": "removed", "removed": "added"}
    assert there.keys() == back.keys()
    for key, row in there.items():
        assert back[key].status == swapped.get(row.status, row.status)
        assert row.delta is None or back[key].delta == -row.delta


def test_compare_percent_ties_go_to_even(spark):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    docs = spark.createDataFrame(
        [("x", start)] * 80 + [("x", end)] * 81 + [("y", start)] * 80 + [("y", end)] * 83,
        "k string, ts timestamp_ntz",
    )
    windows = ("2024-01-01", "2024-01-01", "2024-01-02", "2024-01-02")
    found = {r.key: r.pct_change for r in lf.compare(docs, "k", *windows, ts_field="ts").collect()}
    assert found == {"x": 1.2, "y": 3.8}


def test_compare_fields_are_separate_compares(docs):
    fields = ["rule.id", "agent.name"]
    report = lf.compare_report(docs, fields, *BASELINE, *SELECTION).collect()
    for path in fields:
        one = [tuple(r) for r in lf.compare(docs, path, *BASELINE, *SELECTION, size=50).collect()]
        assert [tuple(r)[1:] for r in report if r.field == path] == one


def test_chain(docs):
    rows = (
        lf.chain(docs)
        .where("rule.level > 4")
        .stats(hits=F.count(F.lit(1)), worst=F.max("rule.level"), by="agent.name")
        .sort("-hits", "agent.name")
        .fields("agent.name", "hits")
        .head(2)
        .df.collect()
    )
    assert [tuple(r) for r in rows] == [("WIN-DC01", 6), ("srv-web01", 5)]
    with pytest.raises(ValueError):
        lf.chain(docs).stats(by="agent.name")


def test_explain(docs):
    clauses = {
        "severe": lf.between(docs, "rule.level", 12),
        "on_web": lf.term(docs, "agent.name", "srv-web01"),
    }
    rows = {r._id: tuple(r)[1:] for r in lf.match_explain(docs, "_id", clauses).collect()}
    assert len(rows) == len(ROWS)
    assert rows["a05"] == (True, True, True)
    assert rows["a07"] == (True, False, False)
    assert rows["a12"] == (False, True, False)
    few = lf.match_explain(docs, "_id", clauses, ids=["a05", "a99"]).collect()
    assert [tuple(r) for r in few] == [("a05", True, True, True)]


def test_text_score(spark):
    texts = spark.createDataFrame(
        [(1, "red red blue"), (2, "Red_green"), (3, "...:"), (4, None), (5, "reddish blue blue")],
        "id int, text string",
    )
    rows = sorted(tuple(r) for r in lf.text_score(texts, "text", "red blue", "id").collect())
    assert [r[:4] for r in rows] == [
        (1, "blue", 1, 2), (1, "red", 2, 2), (2, "red", 1, 2), (5, "blue", 2, 2),
    ]
    # Three texts with words, 8/3 words on average.
    import math

    rarity = math.log(1 + (3 - 2 + 0.5) / (2 + 0.5))
    assert rows[1][4] == pytest.approx(
        rarity * 2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 3 / (8 / 3)))
    )


def test_flatten_and_paths_of_flat_columns(docs):
    flat = lf.flatten(docs)
    assert flat.columns[:4] == ["_id", "@timestamp", "agent.id", "agent.name"]
    assert lf.count(flat, lf.term(flat, "agent.name", "WIN-DC01")).first()["count"] == 9
    assert [tuple(r) for r in lf.terms(flat, "agent.name", size=1).collect()] == [("WIN-DC01", 9)]


def test_field_types(docs):
    rows = [tuple(r)[1:] for r in lf.field_types(docs, "alerts").collect()]
    assert ("agent", "object") in rows and ("agent.name", "string") in rows
    assert rows.index(("agent", "object")) < rows.index(("agent.name", "string"))
    assert ("rule.groups", "array<string>") in rows and ("rule.level", "int") in rows


def test_discover(docs):
    every = lf.discover_fields(docs, sample_size=None).collect()
    rows = {r.field: (r.type, r.n_docs) for r in every}
    assert rows["agent.name"] == ("string", 15)
    assert rows["rule.groups"] == ("array<string>", 13)
    newest = lf.discover_fields(docs, sample_size=2, key="_id").collect()
    assert {r.n_docs for r in newest} == {2}
    only = lf.discover_fields(docs, lf.term(docs, "_id", "a10")).collect()
    assert "agent.name" not in [r.field for r in only]


def test_discover_json(spark):
    lines = [
        (1, '{"rule": {"level": 12, "tags": ["a"]}, "data": {"x": {"y": 1.5}}}'),
        (2, '{"rule": {"level": "12", "tags": []}, "none": null, "empty": {}}'),
        (3, "not json {"),
        (4, None),
        (5, '[{"a": 1}]'),
    ]
    docs = spark.createDataFrame(lines, "id int, doc string")
    wanted = {
        ("doc.rule.level", "bigint", 1),
        ("doc.rule.level", "string", 1),
        ("doc.rule.tags", "array<string>", 1),
        ("doc.rule.tags", "array<void>", 1),
        ("doc.data.x.y", "double", 1),
        ("doc.none", "void", 1),
        ("doc", "array<object<a: bigint>>", 1),
        ("id", "int", 5),
    }
    for sample in (10, None):
        found = lf.discover_fields(docs, ts_field="id", sample_size=sample, json_fields=["doc"])
        assert {tuple(r) for r in found.collect()} == wanted


def test_investigate(docs):
    found = lf.investigate(docs, "agent.name", "srv-web01", FROM, TO, key="_id")
    assert found["count"].first()["count"] == 5
    values = [tuple(r) for r in found["values"].collect()]
    assert ("rules", "31101", 2) in values and ("descriptions", "Apache License seen", 1) in values
    assert sum(r.doc_count for r in found["timeline"].collect()) == 5
    assert ids(found["events"]) == ["a13", "a05", "a06"]


def test_pivot_values(docs):
    rows = lf.pivot_values(docs, "data.srcip", "data.dstip").collect()
    assert [tuple(r) for r in rows] == [("10.0.0.2", 5, 8)]


def test_fan_out(docs):
    rows = {r[0]: r[1] for r in lf.fan_out(docs, "data.srcip", "data.dstip").collect()}
    assert rows == {"10.0.0.1": 2, "10.0.0.2": 1}


def test_added_samples_and_drill(docs):
    windows = (*BASELINE, *SELECTION)
    samples = lf.added_samples(
        docs, "rule.id", *windows, samples=1, source_fields=["_id"], key="_id"
    )
    assert ids(samples) == ["a14"]
    drill = lf.changed_drill(docs, "rule.id", "agent.name", *windows, threshold=30.0)
    drilled = [tuple(r) for r in drill.collect()]
    assert drilled == [("5710", "WIN-DC01", 3), ("5710", "srv-web01", 1)]
    grouped = lf.added_samples(docs, "rule.groups", *windows, source_fields=["_id"], key="_id")
    assert ids(grouped) == []


def test_outliers(spark):
    rows = [(n, 10) for n in range(20)] + [(99, 100)]
    counts = spark.createDataFrame(rows, "k int, doc_count int")
    assert [r.k for r in lf.outliers(counts).collect()] == [99]
    level = spark.createDataFrame([(1, 5), (2, 5)], "k int, doc_count int")
    assert lf.outliers(level).collect() == []


def test_value_diversity(docs):
    rows = {r.field: r for r in lf.value_diversity(docs, ["_id", "agent.name"]).collect()}
    assert rows["_id"].ratio > 0.9 and rows["agent.name"].ratio < 0.2


def test_keyed_counts_drop_missing_keys(docs):
    counts, _ = keyed_counts(docs, ["rule.level"], {"n": F.count(F.lit(1))})
    assert sum(r.n for r in counts.collect()) == 14
