"""The registered queries: every operator on the given tables, whole tables each time."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import logframe as lf
from logframe.sources.catalog import union_tables
from logframe.plans.chain import count

Query = Callable[[SparkSession, str], DataFrame]

# Two touching weeks and the whole month of the events table.
W1 = ("2024-01-01", "2024-01-08")
W2 = ("2024-01-08", "2024-01-15")
MONTH = ("2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def nested_events(spark: SparkSession, root: str) -> DataFrame:
    """Events as nested documents."""
    return table(spark, root, "events").select(
        "event_id",
        F.col("ts").alias("@timestamp"),
        F.struct(F.col("user_id").alias("id")).alias("agent"),
        F.struct(
            F.col("event_type").alias("id"),
            F.struct(F.col("value").alias("level"), "props").alias("detail"),
        ).alias("rule"),
    )


def part_words(spark: SparkSession, root: str) -> DataFrame:
    """Parts with the words of their name as an array field."""
    return table(spark, root, "part").withColumn("words", F.split("p_name", " "))


def trade(spark: SparkSession, root: str) -> DataFrame:
    """Line items with the nations of their supplier and customer."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    return (
        table(spark, root, "lineitem")
        .select("l_orderkey", "l_suppkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Doubles cut to four decimals: their last digits depend on the order of addition."""
    return df.withColumns({name: F.round(name, 4) for name in names})


# Scans, catalog and schema.


def scan_pattern(spark, root):
    found = lf.scan(spark, root, "c*")
    return found.groupBy("_index").agg(
        F.count(F.lit(1)).alias("docs"), F.count("c_custkey").alias("with_custkey")
    )


def scan_time_range(spark, root):
    found = lf.matching(lf.scan(spark, root, "[eo]*"), None, *W1, "ts")
    return found.groupBy("_index").agg(F.count(F.lit(1)).alias("docs"))


def scan_daily(spark, root):
    days = lf.scan_daily(table(spark, root, "events"), "events", "events-2024.01.0*", "ts")
    return days.groupBy("_index").agg(F.count(F.lit(1)).alias("docs"))


def list_tables(spark, root):
    return lf.list_tables(spark, root).select("index", "doc_count")


def list_tables_bytes(spark, root):
    return lf.list_tables(spark, root)


def table_layout(spark, root):
    return lf.table_layout(spark, root)


def time_fields(spark, root):
    """Each table's time field, with the table's size next to it."""
    named = lf.list_time_fields(spark, root)
    sizes = lf.list_tables(spark, root).select(F.col("index").alias("title"), "doc_count")
    return named.join(sizes, "title").select("id", "title", "time_field", "doc_count")


def field_types(spark, root):
    """Declared types next to the number of documents that hold each field."""
    events = nested_events(spark, root)
    seen = lf.discover_fields(events, ts_field="@timestamp", sample_size=None)
    declared = lf.field_types(events, "events")
    return declared.join(seen.select("field", "n_docs"), "field", "left").select(
        "index", "field", "type", "n_docs"
    )


def discover_fields(spark, root):
    return lf.discover_fields(
        table(spark, root, "events"), ts_field="ts", sample_size=100, json_fields=["props"]
    )


def discover_all(spark, root):
    return lf.discover_fields(
        table(spark, root, "events"), ts_field="ts", sample_size=None, json_fields=["props"]
    )


def discover_deep_sample(spark, root):
    return lf.discover_fields(
        table(spark, root, "events"), ts_field="ts", sample_size=5000, json_fields=["props"], key="event_id"
    )


def index_field_types(spark, root):
    """Types of the tables by name, next to each table's size."""
    types = lf.index_field_types(spark, root, ["nation", "part", "events"])
    return types.join(lf.list_tables(spark, root).select("index", "doc_count"), "index")


def scan_nested(spark, root):
    """Two shapes of one document: severe errors of either."""
    events = nested_events(spark, root)
    struct = F.struct(
        F.struct(F.col("o_totalprice").cast("int").alias("level")).alias("detail"),
        F.col("o_orderpriority").alias("id"),
        F.col("o_orderkey").alias("extra"),
    )
    orders = table(spark, root, "orders").select(struct.alias("rule"))
    both = union_tables([events, orders])
    return lf.count(both, lf.between(both, "rule.detail.level", 60))


def flatten_docs(spark, root):
    return lf.flatten(nested_events(spark, root))


# Predicates.


def count_all(spark, root):
    return lf.count(table(spark, root, "lineitem"), "*")


def count_range(spark, root):
    return lf.count(table(spark, root, "events"), None, *W1, "ts")


def count_json_between(spark, root):
    events = table(spark, root, "events")
    k = lf.json_field(events, "props", "k", "int")
    return lf.count(events, lf.between(events, k, 12, 40), *W1, "ts")


def count_shredded_between(spark, root):
    """A range on a JSON member that has a column of its own."""
    path = lf.new_folder(spark, "shredded")
    events = lf.write_shredded(table(spark, root, "events"), path, ["props"])
    k = lf.json_field(events, "props", "k", "int")
    return lf.count(events, lf.between(events, k, 12, 40), *W1, "ts")


def terms_shredded(spark, root):
    """The most frequent values of a JSON member, with their largest value of another field."""
    path = lf.new_folder(spark, "shredded")
    events = lf.write_shredded(table(spark, root, "events"), path, ["props"])
    k = lf.json_field(events, "props", "k", "bigint")
    opened = events.select(k.alias("k"), "value")
    return opened.groupBy("k").agg(F.count(F.lit(1)).alias("doc_count"), F.max("value").alias("most"))


def daily_range(spark, root):
    """Events and users of some days of a table that has a partition for each day."""
    events = lf.write_daily(table(spark, root, "events"), lf.new_folder(spark, "daily"), "ts")
    days = lf.scan_daily(events, "events", "events-2024.01.0*", "ts", day_column="day")
    return days.groupBy("_index").agg(
        F.count(F.lit(1)).alias("docs"), F.count_distinct("user_id").alias("users")
    )


def spike_rows(spark, root):
    """Event types in the hours that hold unusually many events, from a table by day."""
    events = lf.write_daily(table(spark, root, "events"), lf.new_folder(spark, "daily"), "ts")
    rows = lf.spike_rows(events, "2024-01-01", "2024-01-30T23:59:59", "ts", "1h", day_column="day")
    return rows.groupBy("bucket", "event_type").agg(
        F.count(F.lit(1)).alias("doc_count"), F.count_distinct("user_id").alias("users")
    )


def postings_search(spark, root):
    """Documents with any or all of some words, and with a phrase, found by an index."""
    documents = table(spark, root, "documents")
    index = lf.write_postings(documents, lf.new_folder(spark, "postings"), "text", "doc_id")
    asked = [("any", "license the"), ("all", "apache license"), ("phrase", "Apache License, version 2.0")]
    found = [lf.search_postings(index, words, mode).withColumn("mode", F.lit(mode)) for mode, words in asked]
    return functools.reduce(DataFrame.unionByName, found).withColumnRenamed("doc", "doc_id")


def postings_words(spark, root):
    """How many documents have each word, and how often they use it."""
    documents = table(spark, root, "documents")
    return lf.word_counts(lf.write_postings(documents, lf.new_folder(spark, "postings"), "text", "doc_id"))


def count_term_mixed(spark, root):
    """A number asked of a text column."""
    events = table(spark, root, "events").withColumn("code", F.col("user_id").cast("string"))
    return lf.count(events, lf.term(events, "code", 149))


def count_between_text(spark, root):
    """A range of numbers over a text column, some values of which are none."""
    text = F.when(F.col("event_id") % 3 == 0, "_warning").otherwise(F.col("value").cast("string"))
    events = table(spark, root, "events").withColumn("text", text)
    return lf.count(events, lf.between(events, "text", 10, 20))


def count_text_time(spark, root):
    """Times as text with an offset."""
    later = F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss")
    events = table(spark, root, "events").withColumn("at", F.concat(later, F.lit("+02:00")))
    return lf.count(events, None, *W1, "at")


def count_any_none(spark, root):
    orders = table(spark, root, "orders")
    urgent = lf.any_of(
        lf.term(orders, "o_orderpriority", "1-URGENT"), lf.term(orders, "o_orderpriority", "2-HIGH")
    )
    closed = lf.none_of(
        lf.term(orders, "o_orderstatus", "F"), lf.between(orders, "o_totalprice", None, 1000.0)
    )
    return lf.count(orders, lf.all_of(urgent, closed))


def count_term_open_range(spark, root):
    events = nested_events(spark, root)
    severe = lf.all_of(
        lf.term(events, "rule.id", "error"), lf.between(events, "rule.detail.level", 12, "*")
    )
    return lf.count(events, severe, *MONTH)


def count_array_term(spark, root):
    parts = part_words(spark, root)
    return lf.count(parts, lf.term(parts, "words", "small"))


def wildcard_part(spark, root):
    parts = table(spark, root, "part")
    return lf.count(parts, lf.wildcard(parts, "p_name", "small*"))


def wildcard_inner(spark, root):
    parts = table(spark, root, "part")
    found = lf.wildcard(parts, "p_brand", "Brand#?5")
    return parts.filter(found).select("p_partkey", "p_brand")


def wildcard_by_file(spark, root):
    """Parts by an inner wildcard, from the files whose trigrams allow a match."""
    path = lf.new_folder(spark, "parts")
    table(spark, root, "part").repartitionByRange(16, "p_name").write.parquet(path)
    parts = spark.read.parquet(path)
    index_path = lf.new_folder(spark, "trigrams")
    lf.index_trigrams(parts, "p_name").write.parquet(index_path)
    found = lf.scan_like(spark, path, spark.read.parquet(index_path), "p_name", "*all g?z*")
    return found.select("p_partkey", "p_name")


def text_any(spark, root):
    documents = table(spark, root, "documents")
    return documents.filter(lf.match_text(documents, "text", "license the")).select("doc_id")


def text_all(spark, root):
    documents = table(spark, root, "documents")
    found = lf.match_text(documents, ["text", "source"], ["license", "apache"], "all")
    return documents.filter(found).select("doc_id")


def text_phrase(spark, root):
    documents = table(spark, root, "documents")
    found = lf.match_text(documents, "text", "Apache License", "phrase")
    return documents.filter(found).select("doc_id")


def text_everywhere(spark, root):
    pages = table(spark, root, "pages")
    return pages.filter(lf.match_text(pages, None, "example article", "all")).select("page_id")


def exists_by_index(spark, root):
    found = lf.scan(spark, root, "[clo]*")
    timed = found.filter(lf.any_of(lf.exists(found, "o_orderdate"), lf.exists(found, "l_shipdate")))
    return timed.groupBy("_index").agg(F.count(F.lit(1)).alias("docs"))


# Retrieval.


def search_page(spark, root):
    events = table(spark, root, "events")
    return lf.search(
        events,
        lf.term(events, "event_type", "error"),
        *W1,
        "ts",
        limit=20,
        offset=50,
        source_fields=["event_id", "ts", "user_id", "value"],
        key="event_id",
    )


def search_sorted_asc(spark, root):
    return lf.search(
        table(spark, root, "orders"),
        ts_field="o_orderdate",
        limit=500,
        sort_field="o_totalprice",
        sort_dir="asc",
        source_fields=["o_orderkey", "o_totalprice", "no_such_field"],
        key="o_orderkey",
    )


def search_deep_page(spark, root):
    return lf.search(
        table(spark, root, "orders"),
        ts_field="o_orderdate",
        limit=50,
        offset=12_000,
        source_fields=["o_orderkey", "o_orderdate"],
        key="o_orderkey",
    )


def search_deep_text(spark, root):
    return lf.search(
        table(spark, root, "customer"),
        ts_field="c_name",
        limit=100,
        offset=1_000,
        sort_field="c_mktsegment",
        sort_dir="asc",
        source_fields=["c_custkey", "c_mktsegment"],
        key="c_custkey",
    )


def search_continued(spark, root):
    """The page after a row that is told by its date and key."""
    return lf.search_after(
        table(spark, root, "orders"),
        ["1996-06-01", 0],
        ts_field="o_orderdate",
        limit=200,
        source_fields=["o_orderkey", "o_orderdate"],
        key="o_orderkey",
    ).drop("_cursor")


def search_walked(spark, root):
    """Four pages, each by the cursor that the one before ended with."""
    pages = lf.walk(
        table(spark, root, "events"),
        where="event_type = 'error'",
        ts_field="ts",
        sort_field="user_id",
        sort_dir="asc",
        pages=4,
        limit=50,
        source_fields=["user_id", "event_id"],
        key="event_id",
    )
    return functools.reduce(DataFrame.unionByName, pages).drop("_cursor")


def search_total(spark, root):
    events = table(spark, root, "events")
    return lf.search_total(events, lf.term(events, "event_type", "error"), *W1, "ts")


# Aggregations.


def terms_users(spark, root):
    return lf.terms(table(spark, root, "events"), "user_id", None, *W1, "ts", size=20)


def terms_long(spark, root):
    return lf.terms(table(spark, root, "orders"), "o_custkey", size=20_000)


def terms_status(spark, root):
    return lf.terms(table(spark, root, "orders"), "o_orderstatus")


def terms_array(spark, root):
    return lf.terms(part_words(spark, root), "words")


def multi_terms_orders(spark, root):
    return lf.multi_terms(
        table(spark, root, "orders"),
        [
            {"id": "status", "field": "o_orderstatus"},
            {"id": "priority", "field": "o_orderpriority", "size": 3},
            {"id": "customer", "field": "o_custkey", "size": 20},
        ],
    )


def multi_terms_array(spark, root):
    return lf.multi_terms(
        part_words(spark, root),
        [{"id": "word", "field": "words", "size": 6}, {"id": "brand", "field": "p_brand"}],
    )


def histogram_1h_zero(spark, root):
    events = table(spark, root, "events")
    return lf.histogram(events, "2024-01-30T18:00:00", "2024-01-31T06:00:00", "ts", "1h")


def histogram_1M(spark, root):
    orders = table(spark, root, "orders")
    return lf.histogram(orders, "1995-01-01", "1995-12-31", "o_orderdate", "1M")


def histogram_where(spark, root):
    events = table(spark, root, "events")
    return lf.histogram(events, *MONTH, "ts", "30m", lf.term(events, "event_type", "purchase"))


def histogram_fine(spark, root):
    return lf.histogram(table(spark, root, "events"), *MONTH, "ts", "10m")


def auto_histogram(spark, root):
    return lf.histogram(table(spark, root, "events"), *MONTH, "ts", "auto")


def auto_histogram_orders(spark, root):
    orders = table(spark, root, "orders")
    rich = lf.between(orders, "o_totalprice", 400_000.0)
    return lf.auto_histogram(orders, ts_field="o_orderdate", where=rich)


def stats_value(spark, root):
    events = table(spark, root, "events")
    stats = lf.extended_stats(events, "value", lf.term(events, "event_type", "purchase"))
    return rounded(stats, "avg", "sum", "std_deviation")


def stats_array(spark, root):
    """Numbers of an array field: the lengths of the words of a name."""
    lengths = F.transform("words", F.length)
    parts = part_words(spark, root).withColumn("lengths", lengths)
    return rounded(lf.extended_stats(parts, "lengths"), "avg", "sum", "std_deviation")


def stats_none(spark, root):
    events = table(spark, root, "events")
    return lf.extended_stats(events, "user_id", lf.term(events, "event_type", "no such type"))


def compare_users(spark, root):
    return lf.compare(table(spark, root, "events"), "user_id", *W1, *W2, ts_field="ts")


def compare_long(spark, root):
    return lf.compare(table(spark, root, "events"), "user_id", *W1, *W2, ts_field="ts", size=20_000)


def compare_types(spark, root):
    return lf.compare(table(spark, root, "events"), "event_type", *W1, *W2, ts_field="ts")


def compare_exact(spark, root):
    events = table(spark, root, "events")
    return lf.compare(events, "user_id", *W1, *W2, ts_field="ts", exact=True)


# Chains.


def chain_top_users(spark, root):
    return (
        lf.chain(table(spark, root, "events"))
        .where(F.col("value") > 50)
        .stats(hits=count(), by="user_id")
        .sort("-hits", "user_id")
        .head(20)
        .df
    )


def chain_fields(spark, root):
    return (
        lf.chain(lf.scan(spark, root, "l*"))
        .where("l_discount > 0.05")
        .stats(hits=count(), pieces=F.sum("l_quantity"), by=["_index", "l_returnflag"])
        .fields("_index", "l_returnflag", "pieces", "hits")
        .sort("-hits")
        .df
    )


# Explaining.


def match_explain(spark, root):
    events = table(spark, root, "events")
    return lf.match_explain(
        events,
        "event_id",
        {
            "is_error": lf.term(events, "event_type", "error"),
            "is_large": lf.between(events, "value", 50.0),
            "in_week": lf.time_range(events, "ts", *W1),
        },
    )


def text_score(spark, root):
    documents = table(spark, root, "documents")
    return rounded(lf.text_score(documents, "text", "license apache", "doc_id"), "score")


# Investigations.


def _investigation(spark, root):
    return lf.investigate(
        table(spark, root, "events"),
        "user_id",
        149,
        *MONTH,
        ts_field="ts",
        rule_field="event_type",
        description_field="props",
        severity_field="value",
        min_severity=100,
        source_fields=["event_id", "ts", "value", "event_type"],
        key="event_id",
    )


def investigate_count(spark, root):
    return _investigation(spark, root)["count"]


def investigate_values(spark, root):
    return _investigation(spark, root)["values"]


def investigate_timeline(spark, root):
    return _investigation(spark, root)["timeline"]


def investigate_peers(spark, root):
    """How many priorities a customer's orders have, and those not seen in the years before."""
    found = lf.investigate(
        table(spark, root, "orders"),
        "o_orderstatus",
        "P",
        "1995-03-01",
        "1995-04-01",
        ts_field="o_orderdate",
        rule_field="o_orderpriority",
        description_field=None,
        severity_field="o_totalprice",
        peer_fields=["o_orderpriority", "o_custkey"],
        before="1995-01-01",
    )
    new = found["new_peers"].groupBy("field").agg(F.count(F.lit(1)).alias("new"))
    return found["peers"].join(new, "field", "left").select("field", "peers", "new")


def investigate_events(spark, root):
    return _investigation(spark, root)["events"]


def _offenders(spark, root):
    fields = {
        "status": "o_orderstatus",
        "priority": "o_orderpriority",
        "customer": "o_custkey",
    }
    orders = table(spark, root, "orders")
    return lf.top_offenders(orders, fields, "1995-01-01", "1996-01-01", "o_orderdate")


def top_offenders(spark, root):
    return _offenders(spark, root)["values"]


def top_offenders_timeline(spark, root):
    return _offenders(spark, root)["timeline"]


def zordered_range(spark, root):
    """Orders in a range of dates and of prices, from files sorted by both."""
    path = lf.new_folder(spark, "zordered")
    orders = lf.write_zordered(table(spark, root, "orders"), path, ["o_orderdate", "o_totalprice"], parts=8)
    rich = lf.between(orders, "o_totalprice", 200_000.0, 300_000.0)
    rows = lf.matching(orders, rich, "1995-01-01", "1995-12-31", "o_orderdate")
    return rows.select("o_orderkey", "o_orderdate", "o_totalprice")


def reachable_nations(spark, root):
    """Where goods of one nation's suppliers may have come in three steps of rising order dates."""
    found = lf.reachable(trade(spark, root), [3], "s_nationkey", "c_nationkey", 3, ts_field="o_orderdate")
    return found.select("value", "hop", "at")


def reachable_parts(spark, root):
    """Steps from a supplier by a part to the suppliers that ship it later, and on from these."""
    lines = table(spark, root, "lineitem")
    out = lines.select(
        F.concat(F.lit("s"), "l_suppkey").alias("one"), F.concat(F.lit("p"), "l_partkey").alias("other"), "l_shipdate"
    )
    back = out.select(F.col("other").alias("one"), F.col("one").alias("other"), "l_shipdate")
    steps = out.unionByName(back)
    return lf.reachable(steps, ["s1", "s2"], "one", "other", 2, from_ts="1998-06-01", ts_field="l_shipdate")


def pivot_nations(spark, root):
    return lf.pivot_values(trade(spark, root), "s_nationkey", "c_nationkey", size=10)


def anomalous_users(spark, root):
    return rounded(lf.anomalous_terms(table(spark, root, "events"), "user_id"), "z")


def spikes(spark, root):
    day_end = "2024-01-30T23:59:59"
    found = lf.spikes(table(spark, root, "events"), "2024-01-01", day_end, "ts", "1h")
    return rounded(found, "z")


def window_events(spark, root):
    """Events of each type around every spike: from half an hour before it to half an hour after."""
    events = table(spark, root, "events")
    peaks = lf.spikes(events, "2024-01-01", "2024-01-30T23:59:59", "ts", "1h")
    around = peaks.select(
        "bucket",
        (F.col("bucket") - F.expr("interval 30 minutes")).alias("start"),
        (F.col("bucket") + F.expr("interval 90 minutes")).alias("end"),
    )
    rows = lf.in_windows(events, around, "ts", interval="2h")
    return rows.groupBy("bucket", "event_type").agg(
        F.count(F.lit(1)).alias("doc_count"), F.count_distinct("user_id").alias("users")
    )


def rollup_histogram(spark, root):
    """Events by six hours from counts by minute, hour and day."""
    events = table(spark, root, "events")
    kept = lf.write_rollup(events, lf.new_folder(spark, "rollup"), "ts")
    return lf.rolled_histogram(events, kept, "2024-01-02T03:04:05", "2024-01-27T22:10:59", "ts", "6h")


def fan_out_sketched(spark, root):
    """Users of each event type over two weeks, merged from sketches by day: whether near the exact number."""
    events = table(spark, root, "events")
    path = lf.new_folder(spark, "sketches")
    lf.fan_out_sketches(events, "event_type", "user_id", "ts").write.parquet(path)
    about = lf.fan_out_of(spark.read.parquet(path), "event_type", "2024-01-05", "2024-01-18")
    exact = lf.fan_out(events, "event_type", "user_id", None, "2024-01-05", "2024-01-18T23:59:59.999999", "ts")
    exact = exact.withColumnRenamed("fan_out", "exact")
    near = F.abs(F.col("fan_out") - F.col("exact")) <= F.col("exact") / 10
    return about.join(exact, "event_type").select("event_type", "exact", near.alias("near"))


def top_sketched(spark, root):
    """The most frequent event types over two weeks, merged from sketches by day."""
    events = table(spark, root, "events")
    path = lf.new_folder(spark, "sketches")
    lf.top_sketches(events, "event_type", "ts").write.parquet(path)
    return lf.top_of(spark.read.parquet(path), 3, "2024-01-05", "2024-01-18")


def spike_causes(spark, root):
    found = lf.top_offenders(
        table(spark, root, "events"), ["event_type"], "2024-01-01", "2024-01-30T23:59:59", "ts",
        spike_interval="1h", causes=2,
    )
    return found["causes"]


def fan_out(spark, root):
    return lf.fan_out(table(spark, root, "orders"), "o_custkey", "o_orderpriority")


def fan_out_approximate(spark, root):
    """Whether each approximate count is within a seventh of the exact one."""
    lines = table(spark, root, "lineitem")
    about = lf.fan_out(lines, "l_suppkey", "l_partkey", approximate=True)
    exact = lf.fan_out(lines, "l_suppkey", "l_partkey").withColumnRenamed("fan_out", "exact")
    near = F.abs(F.col("fan_out") - F.col("exact")) <= F.col("exact") / 7
    return about.join(exact, "l_suppkey").select("l_suppkey", near.alias("near"))


def compare_report(spark, root):
    events = table(spark, root, "events")
    return lf.compare_report(events, ["user_id", "event_type"], *W1, *W2, ts_field="ts")


def added_samples(spark, root):
    return lf.added_samples(
        table(spark, root, "events"),
        "user_id",
        *W1,
        *W2,
        ts_field="ts",
        size=20,
        source_fields=["user_id", "event_id", "ts", "event_type"],
        key="event_id",
    )


def changed_drill(spark, root):
    return lf.changed_drill(
        table(spark, root, "events"),
        "user_id",
        "event_type",
        *W1,
        *W2,
        ts_field="ts",
        size=150,
        threshold=50.0,
        drill_size=3,
    )


def value_diversity(spark, root):
    """Each field's values, and whether the approximate number of different ones is near."""
    documents = table(spark, root, "documents")
    names = ["text", "lang", "source", "doc_id"]
    about = lf.value_diversity(documents, names)
    exact = documents.agg(
        F.array(
            *[F.struct(F.lit(n).alias("field"), F.count_distinct(n).alias("exact")) for n in names]
        ).alias("e")
    ).select(F.inline("e"))
    near = F.abs(F.col("about_distinct") - F.col("exact")) <= F.col("exact") / 7
    return about.join(exact, "field").select("field", "doc_count", near.alias("near"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_pattern,
        scan_time_range,
        scan_daily,
        list_tables,
        list_tables_bytes,
        table_layout,
        time_fields,
        field_types,
        discover_fields,
        discover_all,
        discover_deep_sample,
        index_field_types,
        scan_nested,
        flatten_docs,
        count_all,
        count_range,
        count_json_between,
        count_shredded_between,
        terms_shredded,
        daily_range,
        spike_rows,
        postings_search,
        postings_words,
        count_term_mixed,
        count_between_text,
        count_text_time,
        count_any_none,
        count_term_open_range,
        count_array_term,
        wildcard_part,
        wildcard_inner,
        wildcard_by_file,
        text_any,
        text_all,
        text_phrase,
        text_everywhere,
        exists_by_index,
        search_page,
        search_sorted_asc,
        search_deep_page,
        search_deep_text,
        search_continued,
        search_walked,
        search_total,
        terms_users,
        terms_long,
        terms_status,
        terms_array,
        multi_terms_orders,
        multi_terms_array,
        histogram_1h_zero,
        histogram_1M,
        histogram_where,
        histogram_fine,
        auto_histogram,
        auto_histogram_orders,
        stats_value,
        stats_array,
        stats_none,
        compare_users,
        compare_long,
        compare_types,
        compare_exact,
        chain_top_users,
        chain_fields,
        match_explain,
        text_score,
        investigate_count,
        investigate_values,
        investigate_timeline,
        investigate_peers,
        investigate_events,
        top_offenders,
        top_offenders_timeline,
        zordered_range,
        reachable_nations,
        reachable_parts,
        pivot_nations,
        anomalous_users,
        spikes,
        window_events,
        rollup_histogram,
        fan_out_sketched,
        top_sketched,
        spike_causes,
        fan_out,
        fan_out_approximate,
        compare_report,
        added_samples,
        changed_drill,
        value_diversity,
    )
}
