"""Wildcard scans over tables written for the test."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import logframe as lf


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for day in (1, 2, 3):
        rows = [(n, dt.datetime(2024, 3, day, n), f"h{n % 2}") for n in range(day)]
        log = spark.createDataFrame(rows, "id int, ts timestamp_ntz, host string")
        if day == 3:
            log = log.withColumn("extra", F.lit("new"))
        log.coalesce(1).write.parquet(f"{folder}/log-2024.03.0{day}.parquet")
    other = spark.createDataFrame([("x", 1.5)], "id string, value double")
    other.write.parquet(f"{folder}/log-other")
    spark.createDataFrame([], "id int, ts timestamp").write.parquet(f"{folder}/none.parquet")
    spark.range(10).repartition(2).write.parquet(f"{folder}/two_files.parquet")
    return str(folder)


def test_a_family_of_days_is_one_scan(spark, root):
    days = lf.scan(spark, root, "log-2024.03.*")
    assert set(days.columns) == {"id", "ts", "host", "extra", "_index"}
    found = {r["_index"]: r["count"] for r in days.groupBy("_index").count().collect()}
    assert found == {f"log-2024.03.0{n}": n for n in (1, 2, 3)}
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert lf.count(days, lf.exists(days, "extra")).first()["count"] == 3


def test_a_family_with_a_given_schema(spark, root):
    days = lf.scan(spark, root, "log-2024*", schema="id int, host string")
    assert days.columns == ["id", "host", "_index"] and days.count() == 6


def test_types_that_do_not_fit_become_text(spark, root):
    mixed = lf.scan(spark, root, "log-*")
    assert dict(mixed.dtypes)["id"] == "string"
    assert sorted(r[0] for r in mixed.select("id").collect()) == ["0", "0", "0", "1", "1", "2", "x"]
    assert mixed.filter("value is not null").count() == 1


def test_a_family_whose_types_changed(spark, tmp_path):
    for day, level in ((1, "12"), (2, "'high'")):
        spark.sql(f"select {level} as level").write.parquet(f"{tmp_path}/app-2024.03.0{day}")
    days = lf.scan(spark, str(tmp_path), "app-*")
    rows = sorted(tuple(r) for r in days.select("_index", "level").collect())
    assert rows == [("app-2024.03.01", "12"), ("app-2024.03.02", "high")]


def test_only_the_days_of_a_window_are_opened(spark, root):
    def opened(from_ts, to_ts):
        days = lf.scan(spark, root, "log-2024*", from_ts=from_ts, to_ts=to_ts)
        return sorted({path.split("log-2024.03.0")[1][0] for path in days.inputFiles()})

    assert opened("2024-03-02", "2024-03-02T12:00:00") == ["2"]
    assert opened("2024-03-02", None) == ["2", "3"]
    assert opened(None, "2024-03-02") == ["1", "2"]
    with pytest.raises(ValueError, match="days asked for"):
        opened("2025-01-01", None)


def test_a_list_of_names(spark, root):
    found = lf.scan(spark, root, ["two_files", "log-2024.03.02"])
    assert {r[0]: r[1] for r in found.groupBy("_index").count().collect()} == {
        "two_files": 10, "log-2024.03.02": 2,
    }


def test_one_table_by_name(spark, root):
    assert lf.scan(spark, root, "two_files").count() == 10
    with pytest.raises(ValueError, match="no table"):
        lf.scan(spark, root, "nothing*")


def test_time_filter_drops_tables_without_the_field(spark, root):
    mixed = lf.scan(spark, root, "*")
    timed = lf.matching(mixed, None, "2024-03-02", "2024-03-03", "ts")
    assert timed.count() == 3


def test_list_tables(spark, root):
    rows = {r["index"]: r for r in lf.list_tables(spark, root).collect()}
    assert list(rows) == sorted(rows)
    assert rows["two_files"].doc_count == 10 and rows["none"].doc_count == 0
    assert rows["log-2024.03.03"].doc_count == 3 and rows["log-other"].store_bytes > 0


def test_table_layout(spark, root):
    rows = {r["index"]: r for r in lf.table_layout(spark, root, "*o*").collect()}
    assert rows["two_files"].files == 2
    assert rows["two_files"].oldest_file <= rows["two_files"].newest_file


def test_list_time_fields(spark, root):
    rows = {r.title: r.time_field for r in lf.list_time_fields(spark, root).collect()}
    assert rows["none"] == "ts" and rows["two_files"] is None


def test_scan_daily(spark, root):
    whole = lf.scan(spark, root, "log-2024*").drop("_index")
    for pattern, wanted in (
        ("day-2024.03.0*", [1, 2, 3]),
        ("day-2024.03.02", [2]),
        ("day-*.0?", [1, 2, 3]),
        ("day-2024*3", [3]),
        ("night-*", []),
        ("day-2024.02*", []),
    ):
        days = lf.scan_daily(whole, "day", pattern, "ts")
        found = {r[0]: r[1] for r in days.groupBy("_index").count().collect()}
        assert found == {f"day-2024.03.0{n}": n for n in wanted}


def test_scan_daily_prunes_partitions(spark, root, tmp_path):
    lf.scan(spark, root, "log-2024*").withColumn("day", F.to_date("ts")).write.partitionBy(
        "day"
    ).parquet(f"{tmp_path}/by_day")
    table = spark.read.parquet(f"{tmp_path}/by_day")
    days = lf.scan_daily(table, "log", "log-2024.03.02", "ts", day_column="day")
    assert days.count() == 2
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan


def test_a_day_range_prunes_partitions(spark, root, tmp_path):
    lf.scan(spark, root, "log-2024*").withColumn("day", F.to_date("ts")).write.partitionBy(
        "day"
    ).parquet(f"{tmp_path}/by_day")
    table = spark.read.parquet(f"{tmp_path}/by_day")
    window = ("2024-03-02T00:30:00", "2024-03-03T00:30:00")
    found = lf.count(table, lf.day_range(table, "day", *window), *window, "ts")
    assert found.first()["count"] == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "day" not in plan.split("PushedFilters")[1].split("]")[0]


def test_json_lines(spark, root, tmp_path):
    lf.scan(spark, root, "log-2024*").drop("_index").write.json(f"{tmp_path}/lines.json")
    lines = lf.scan(spark, str(tmp_path), "li*", fmt="json")
    assert lf.count(lines, None, "2024-03-02", "2024-03-03", "ts").first()["count"] == 3


def test_structs_merge_member_by_member(spark, tmp_path):
    spark.sql("select struct(1 as id, 5 as level) as rule, array(struct(1 as a)) as l").write.parquet(f"{tmp_path}/a")
    spark.sql(
        "select struct('x' as id, 7L as level, true as extra) as rule, array(struct(2 as a, 'm' as b)) as l"
    ).write.parquet(f"{tmp_path}/b")
    both = lf.scan(spark, str(tmp_path), "*")
    assert dict(both.dtypes)["rule"] == "struct<id:string,level:bigint,extra:boolean>"
    assert dict(both.dtypes)["l"] == "array<struct<a:int,b:string>>"
    assert lf.count(both, lf.between(both, "rule.level", 5, 7)).first()[0] == 2
    assert lf.count(both, lf.term(both, "rule.id", 1)).first()[0] == 1
    assert lf.count(both, lf.term(both, "l.b", "m")).first()[0] == 1
    types = {(r["index"], r.field): r.type for r in lf.index_field_types(spark, str(tmp_path)).collect()}
    assert types["a", "rule.id"] == "int" and types["b", "rule.id"] == "string"


def test_empty_files_count(spark, tmp_path):
    spark.createDataFrame([], "a int").coalesce(1).write.parquet(f"{tmp_path}/none")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/some")
    spark.range(0).coalesce(1).write.mode("append").parquet(f"{tmp_path}/some")
    found = {r["index"]: r for r in lf.list_tables(spark, str(tmp_path)).collect()}
    assert found["none"].doc_count == 0 and found["none"].store_bytes > 0
    layout = {r["index"]: r.files for r in lf.table_layout(spark, str(tmp_path)).collect()}
    assert found["some"].doc_count == 3 and layout == {"none": 1, "some": 2}


def test_nested_times_and_dates(spark, tmp_path):
    spark.sql("select struct(now() as at) as meta, date'2024-01-01' as day").write.parquet(f"{tmp_path}/n")
    spark.sql("select date'2024-01-01' as day").write.parquet(f"{tmp_path}/d")
    found = {r.title: r.time_field for r in lf.list_time_fields(spark, str(tmp_path)).collect()}
    assert found == {"n": "meta.at", "d": "day"}


def test_bytes_and_files_are_those_of_the_file_system(spark):
    sizes = {path.stem: path.stat().st_size for path in Path("/root/testdata/sf0.01").glob("*.parquet")}
    listed = lf.list_tables(spark, "/root/testdata/sf0.01").collect()
    assert {row["index"]: row["store_bytes"] for row in listed} == sizes
    layout = lf.table_layout(spark, "/root/testdata/sf0.01").collect()
    assert {row["index"]: (row["files"], row["store_bytes"]) for row in layout} == {n: (1, b) for n, b in sizes.items()}
