"""Pages that continue by cursor, and pages far down."""

import json

import pytest
from pyspark.sql import functions as F

import logframe as lf
from registered.queries import QUERIES, table
from tests.alerts import alerts
from tests.test_plans import executed

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return alerts(spark).cache()


@pytest.fixture(scope="module")
def mixed(spark):
    """Ties, NULLs in the sort field and in the key, NaN, infinities and times with a zone."""
    rows = [(n, n % 3, None if n % 7 == 0 else float(n % 5), n % 4) for n in range(60)]
    rows += [(60, 1, float("nan"), 1), (61, 1, float("inf"), 0), (62, 2, float("-inf"), 0), (None, 1, 2.0, 3)]
    df = spark.createDataFrame(rows, "id int, part int, x double, t int")
    moment = F.timestamp_micros(F.lit(1_700_000_000_123_456) + F.col("t") * 1_000_001)
    return df.withColumns(
        {"at": F.when(F.col("t") > 0, moment), "b": F.encode(F.concat(F.lit("é"), F.col("t")), "utf-8")}
    ).cache()


def walked(df, **kwargs):
    rows = []
    for page in lf.walk(df, **kwargs):
        found = page.collect()
        assert len(found) <= kwargs["limit"]
        rows += [tuple(row)[:-1] for row in found]
    return rows


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("by", ["@timestamp", "rule.level", "data.bytes", "agent.name"])
def test_cursors_visit_every_document(docs, by, direction):
    wanted = [tuple(row) for row in lf.search(docs, sort_field=by, sort_dir=direction, key="_id").collect()]
    assert walked(docs, sort_field=by, sort_dir=direction, key="_id", limit=3) == wanted
    assert walked(docs, sort_field=by, sort_dir=direction, key="_id", limit=len(wanted)) == wanted


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("by", ["x", "at", "b", "id", "part"])
def test_cursors_of_any_type(mixed, spark, by, direction):
    order = [F.desc_nulls_last(by) if direction == "desc" else F.asc_nulls_last(by), F.asc("part"), F.asc("id")]
    wanted = [row["id"] for row in mixed.orderBy(*order).collect()]
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = []
    try:
        for n, page in enumerate(lf.walk(
            mixed, ts_field="at", sort_field=by, sort_dir=direction, key=["part", "id"], limit=7, source_fields=["id"]
        )):
            found += [row["id"] for row in page.collect()]
            # A cursor means the same in a session of another zone.
            spark.conf.set("spark.sql.session.timeZone", ["Asia/Tokyo", "Europe/Berlin"][n % 2])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == wanted


def test_cursor_values_and_errors(docs):
    first = lf.search_after(docs, limit=4, key="_id", source_fields=["_id"]).collect()
    cursor = first[-1]["_cursor"]
    values = json.loads(cursor)
    assert values[1] == first[-1]["_id"]
    by_text = lf.search_after(docs, cursor, limit=4, key="_id", source_fields=["_id"]).collect()
    assert lf.search_after(docs, values, limit=4, key="_id", source_fields=["_id"]).collect() == by_text
    with pytest.raises(ValueError, match="2 values"):
        lf.search_after(docs, [1, 2], key=["_id", "agent.name"])
    with pytest.raises(ValueError, match="tells rows apart"):
        lf.search_after(docs, key=[])
    with pytest.raises(ValueError, match="over the cap"):
        lf.search_after(docs, limit=5, limit_cap=4)
    assert lf.search_after(docs, limit=0).collect() == []
    assert walked(docs.limit(0), limit=3) == []


def test_a_cursor_reaches_the_scan_and_ends_in_a_top_k(spark):
    orders = table(spark, ROOT, "orders")
    page = lf.search_after(
        orders, ["1996-06-01", 5], ts_field="o_orderdate", key="o_orderkey", source_fields=["o_custkey"]
    )
    plan = executed(page)
    assert "LessThan(o_orderdate,1996-06-01T00:00)" in plan and "GreaterThan(o_orderkey,5)" in plan
    assert "TakeOrderedAndProject(limit=50" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate" in plan


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr("logframe.operators.rank.MERGED_ROWS", 40)


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("by", ["tied", "x", "s", "n"])
def test_far_pages_among_ties(spark, small, by, direction):
    rows = spark.range(0, 3000, 1, 4).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("tied"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.cos("id")).alias("x"),
        F.concat(F.lit("same start "), F.col("id") * 7919 % 3001).alias("s"),
    )
    order = [F.desc_nulls_last(by) if direction == "desc" else F.asc_nulls_last(by), F.asc("n")]
    whole = [row["n"] for row in rows.orderBy(*order).select("n").collect()]
    pages = [(1, 40), (700, 30), (1250, 600)] if direction == "asc" else [(2990, 40), (4000, 5), (0, 400)]
    for offset, limit in pages:
        page = lf.search(
            rows, ts_field="x", sort_field=by, sort_dir=direction, offset=offset, limit=limit, key="n",
            source_fields=["n"],
        )
        assert [row["n"] for row in page.collect()] == whole[offset : offset + limit]


def test_a_sketch_that_is_off_is_not_trusted(spark, small, monkeypatch):
    monkeypatch.setattr("logframe.operators.rank.ACCURACY", 1)
    rows = spark.range(3000).select(F.col("id").alias("n"), (F.col("id") * 7919 % 3001).alias("x"))
    whole = [row["n"] for row in rows.orderBy("x").collect()]
    page = lf.search(rows, ts_field="x", sort_dir="asc", offset=1200, limit=30, key="n")
    assert [row["n"] for row in page.collect()] == whole[1200:1230]


def test_far_page_sorts_few_rows(spark, small):
    rows = spark.range(100_000).select(F.col("id").alias("n"), (F.col("id") * 7919 % 100_003).alias("x"))
    page = lf.search(rows, ts_field="x", sort_dir="asc", offset=60_000, limit=30, key="n")
    assert page.count() == 30
    plan = page._jdf.queryExecution().executedPlan()
    page.collect()
    windows, stack = [], [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif "QueryStage" in name:
            stack.append(node.plan())
        else:
            if name == "Exchange":
                windows.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
    assert windows and max(windows) < 200


def test_registered_deep_page_has_a_small_plan(spark):
    plan = QUERIES["search_deep_page"](spark, ROOT)._jdf.queryExecution().optimizedPlan()
    assert len(plan.treeString()) < 200_000
