"""The physical plans the operators are built for."""

import pytest
from pyspark.sql import functions as F

import logframe as lf
from registered.queries import QUERIES, W1, W2, table

ROOT = "/root/testdata/sf0.01"


def executed(df) -> str:
    """The plan that ran, after adaptive execution."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_time_range_and_term_reach_the_scan(spark):
    plan = executed(QUERIES["search_page"](spark, ROOT))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan and "LessThanOrEqual(ts" in plan
    assert "TakeOrderedAndProject(limit=70, offset=50" in plan
    assert "Exchange" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint" in plan
    assert "props" not in plan


def test_deep_pages_and_long_tops_run_nothing_when_called(spark):
    status = spark.sparkContext.statusTracker()
    events = table(spark, ROOT, "events")
    before = max(status.getJobIdsForGroup() or [0])
    lf.search(events, ts_field="ts", offset=20_000, key="event_id")
    lf.terms(events, "user_id", size=20_000)
    lf.compare(events, "user_id", *W1, *W2, ts_field="ts", size=20_000)
    lf.compare_report(events, ["user_id", "event_type"], *W1, *W2, ts_field="ts", size=20_000)
    assert max(status.getJobIdsForGroup() or [0]) == before


def test_a_column_range_is_pushed_down(spark):
    events = table(spark, ROOT, "events")
    plan = executed(lf.count(events, lf.between(events, F.col("value"), 10.0, 20.0)))
    assert "GreaterThanOrEqual(value,10.0)" in plan


def test_prefix_wildcard_reaches_the_scan(spark):
    plan = executed(QUERIES["wildcard_part"](spark, ROOT))
    assert "StringStartsWith(p_name,small)" in plan


def test_count_reads_no_column(spark):
    assert "ReadSchema: struct<>" in executed(QUERIES["count_all"](spark, ROOT))


@pytest.mark.parametrize(
    "name",
    [
        "terms_users", "multi_terms_orders", "multi_terms_array", "compare_users",
        "compare_report", "histogram_where", "top_offenders", "discover_fields",
    ],
)
def test_one_scan(spark, name):
    assert executed(QUERIES[name](spark, ROOT)).count("FileScan") == 1


@pytest.mark.parametrize("name", ["multi_terms_orders", "compare_report", "added_samples"])
def test_top_values_are_cut_before_the_shuffle(spark, name):
    plan = executed(QUERIES[name](spark, ROOT))
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_compare_reads_both_tops_from_one_shuffle(spark):
    events = table(spark, ROOT, "events")
    plan = executed(lf.compare(events, "user_id", *W1, *W2, ts_field="ts"))
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(ts" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = QUERIES[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_outliers_reuse_the_counts(spark):
    df = QUERIES["anomalous_users"](spark, ROOT)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_scan_leaves_out_tables_without_the_time_field(spark):
    plan = executed(QUERIES["scan_time_range"](spark, ROOT))
    assert plan.count("FileScan") == 1


def test_a_date_column_is_pushed_down(spark, tmp_path):
    spark.sql(
        "select date'2024-03-01' + make_interval(0, 0, 0, int(id)) as day from range(10)"
    ).select(F.col("day").cast("date")).write.parquet(f"{tmp_path}/days")
    days = spark.read.parquet(f"{tmp_path}/days")
    found = lf.count(days, None, "2024-03-02T01:00:00", "2024-03-05", "day")
    assert found.first()["count"] == 3
    plan = executed(found)
    assert "GreaterThanOrEqual(day" in plan or "GreaterThan(day" in plan
