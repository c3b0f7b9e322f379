"""The same results in DuckDB SQL over the same tables."""

from __future__ import annotations

TABLES = (
    "benchmark",
    "conversations",
    "customer",
    "documents",
    "embeddings",
    "events",
    "labels",
    "lineitem",
    "nation",
    "orders",
    "pages",
    "part",
    "region",
    "supplier",
)

W1 = "ts >= timestamp '2024-01-01' and ts <= timestamp '2024-01-08'"
W2 = "ts >= timestamp '2024-01-08' and ts <= timestamp '2024-01-15'"
MONTH = "ts >= timestamp '2024-01-01' and ts <= timestamp '2024-01-31'"


def _counts(names, where=lambda name: "true"):
    return " union all ".join(
        f"select '{name}' as _index, count(*) as docs from {name} where {where(name)}"
        for name in names
    )


def _words(column: str) -> str:
    pieces = rf"string_split_regex(lower({column}), '[^\p{{L}}\p{{N}}]+')"
    return f"list_filter({pieces}, lambda w: w <> '')"


def _top(table: str, field: str, size: int, where: str = "true", key: str = "key") -> str:
    return (
        f"(select {field} as {key}, count(*) as doc_count from {table} "
        f"where ({where}) and {field} is not null group by 1 order by 2 desc, 1 limit {size})"
    )


def _top_text(ident: str, table: str, field: str, size: int, where: str = "true") -> str:
    return (
        f"select '{ident}' as id, cast(key as varchar) as key, doc_count "
        f"from {_top(table, field, size, where)}"
    )


def _reachable(steps: str, start: list[str], hops: int) -> str:
    """Values by least number of steps and the earliest time of so many, a step after the other."""
    values = ", ".join(f"('{value}')" for value in start)
    parts = [f"steps as ({steps})", f"r0 as (select value, 0 as hop, cast(null as timestamp) as t from (values {values}) v(value))"]
    known = "select * from r0"
    for hop in range(1, hops + 1):
        parts.append(
            f"""r{hop} as (
              select dst as value, {hop} as hop, min(s.t) as t
              from steps s join ({known}) k on s.src = k.value and (k.t is null or s.t >= k.t)
              group by 1)"""
        )
        known += f" union all select * from r{hop}"
    return f"""
      with {", ".join(parts)}
      select value, min(hop) as hop, arg_min_null(t, hop) as "at" from (
        select value, hop, min(t) as t from ({known}) group by 1, 2) group by 1"""


def _histogram(table: str, ts: str, step: str, low: str, high: str, where: str = "true") -> str:
    bucket = f"time_bucket(interval '{step}', {{0}}, timestamp '1970-01-01')"
    grid_low = bucket.format(f"timestamp '{low}'")
    grid_high = bucket.format(f"timestamp '{high}'")
    return f"""
    select g.bucket, coalesce(n, 0) as doc_count
    from (select unnest(generate_series({grid_low}, {grid_high}, interval '{step}')) as bucket) g
    left join (
      select {bucket.format(ts)} as bucket, count(*) as n from {table}
      where {ts} >= timestamp '{low}' and {ts} <= timestamp '{high}' and ({where})
      group by 1
    ) c on g.bucket = c.bucket"""


# Widths of an automatic histogram in seconds, with their names.
LADDER = (
    (1, "1s"), (5, "5s"), (10, "10s"), (30, "30s"),
    (60, "1m"), (300, "5m"), (600, "10m"), (1800, "30m"),
    (3600, "1h"), (10800, "3h"), (43200, "12h"),
    (86400, "1d"), (604800, "7d"), (2592000, "30d"), (7776000, "90d"), (31536000, "365d"),
    (157680000, "1825d"), (315360000, "3650d"), (630720000, "7300d"),
    (1576800000, "18250d"), (3153600000, "36500d"),
)


def _auto(table: str, ts: str, where: str = "true") -> str:
    ladder = ", ".join(f"({width}, '{name}')" for width, name in LADDER)
    return f"""
    with e as (
      select cast(floor(epoch_us({ts}) / 1000000.0) as bigint) as s from {table} where {where}
    ), span as (select min(s) as lo, max(s) as hi from e),
    pick as (
      select w, label, lo, hi from span, (values {ladder}) l(w, label)
      where floor(hi / w::double) - floor(lo / w::double) + 1 <= 50 order by w limit 1
    ), grid as (
      select unnest(generate_series(
        cast(floor(lo / w::double) as bigint) * w, cast(floor(hi / w::double) as bigint) * w, w
      )) as b, w, label from pick
    ), counted as (
      select cast(floor(s / w::double) as bigint) * w as b, count(*) as n from e, pick group by 1
    )
    select make_timestamp(grid.b * 1000000) as bucket, coalesce(n, 0) as doc_count,
           label as interval_used
    from grid left join counted on grid.b = counted.b"""


def _compare(field: str, size: int, exact: bool = False, extra: str = "") -> str:
    if exact:
        present = f"""
        select k.key, b.doc_count as b, s.doc_count as s
        from (select key from {_top("events", field, size, W1)}
              union select key from {_top("events", field, size, W2)}) k
        left join {_top("events", field, 1000000000, W1)} b on k.key = b.key
        left join {_top("events", field, 1000000000, W2)} s on k.key = s.key"""
    else:
        present = f"""
        select coalesce(b.key, s.key) as key, b.doc_count as b, s.doc_count as s
        from {_top("events", field, size, W1)} b
        full outer join {_top("events", field, size, W2)} s on b.key = s.key"""
    return f"""
    select {extra} key,
      case when b is null then 'added' when s is null then 'removed'
           when b <> s then 'changed' else 'unchanged' end as status,
      b as baseline, s as selection, s - b as delta,
      case when b <> s then round_even(1000::double * (s - b) / b, 0) / 10 end as pct_change
    from ({present})"""


def _auto_user_values() -> str:
    where = f"user_id = 149 and {MONTH}"
    return " union all ".join(
        [
            _top_text("rules", "events", "event_type", 20, where),
            _top_text("descriptions", "events", "props", 10, where),
        ]
    )


def _discover(rows: str) -> str:
    columns = (
        ("event_id", "bigint"),
        ("ts", "timestamp_ntz"),
        ("user_id", "bigint"),
        ("event_type", "string"),
        ("value", "double"),
    )
    parts = [
        f"select '{name}' as field, '{kind}' as type, count({name}) as n_docs from ({rows})"
        for name, kind in columns
    ]
    parts.append(
        "select 'props.k' as field, 'bigint' as type, count(json_extract(props, '$.k')) as n_docs "
        f"from ({rows})"
    )
    return " union all ".join(parts)


_EVENTS_BY_FIELD = (
    ("event_id", "bigint", "event_id"),
    ("@timestamp", "timestamp_ntz", "ts"),
    ("agent", "object", None),
    ("agent.id", "bigint", "user_id"),
    ("rule", "object", None),
    ("rule.id", "string", "event_type"),
    ("rule.detail", "object", None),
    ("rule.detail.level", "double", "value"),
    ("rule.detail.props", "string", "props"),
)

# Tables whose schema has a timestamp column.
_TIME_FIELDS = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}

_WEEK_TOP = f"""
  select key from ({_compare("user_id", 20)}) where status = 'added'"""

ORACLE: dict[str, str] = {
    "scan_pattern": """
      select 'conversations' as _index, count(*) as docs, 0::bigint as with_custkey
      from conversations
      union all select 'customer', count(*), count(c_custkey) from customer""",
    "scan_time_range": f"select 'events' as _index, count(*) as docs from events where {W1}",
    "scan_daily": """
      select 'events-' || strftime(ts, '%Y.%m.%d') as _index, count(*) as docs from events
      where strftime(ts, '%Y.%m.%d') like '2024.01.0%' group by 1""",
    "list_tables": " union all ".join(
        f'select \'{name}\' as "index", count(*) as doc_count from {name}' for name in TABLES
    ),
    "time_fields": " union all ".join(
        f"select '{name}' as id, '{name}' as title, "
        + (f"'{_TIME_FIELDS[name]}'" if name in _TIME_FIELDS else "cast(null as varchar)")
        + f" as time_field, count(*) as doc_count from {name}"
        for name in TABLES
    ),
    "field_types": " union all ".join(
        f"select 'events' as \"index\", '{path}' as field, '{kind}' as type, "
        + (f"(select count({column}) from events)" if column else "cast(null as bigint)")
        + " as n_docs"
        for path, kind, column in _EVENTS_BY_FIELD
    ),
    "discover_fields": _discover("select * from events order by ts desc limit 100"),
    "discover_deep_sample": _discover("select * from events order by ts desc, event_id limit 5000"),
    "index_field_types": """
      select t.*, n as doc_count from (values
        ('nation', 'n_nationkey', 'int'), ('nation', 'n_name', 'string'), ('nation', 'n_regionkey', 'int'),
        ('part', 'p_partkey', 'bigint'), ('part', 'p_name', 'string'), ('part', 'p_brand', 'string'),
        ('part', 'p_type', 'string'), ('part', 'p_size', 'int'), ('part', 'p_retailprice', 'double'),
        ('events', 'event_id', 'bigint'), ('events', 'ts', 'timestamp_ntz'),
        ('events', 'user_id', 'bigint'), ('events', 'event_type', 'string'),
        ('events', 'value', 'double'), ('events', 'props', 'string')) t("index", field, type)
      join (select 'nation' as name, count(*) as n from nation union all
            select 'part', count(*) from part union all select 'events', count(*) from events) c
      on name = t."index" """,
    "scan_nested": """
      select (select count(*) from events where value >= 60)
        + (select count(*) from orders where trunc(o_totalprice) >= 60) as count""",
    "discover_all": _discover("select * from events"),
    "flatten_docs": """
      select event_id, ts as "@timestamp", user_id as "agent.id", event_type as "rule.id",
             value as "rule.detail.level", props as "rule.detail.props" from events""",
    "count_all": "select count(*) as count from lineitem",
    "count_range": f"select count(*) as count from events where {W1}",
    "count_json_between": f"""
      select count(*) as count from events
      where {W1} and cast(json_extract(props, '$.k') as int) between 12 and 40""",
    "count_shredded_between": f"""
      select count(*) as count from events
      where {W1} and cast(json_extract(props, '$.k') as int) between 12 and 40""",
    "terms_shredded": """
      select cast(json_extract(props, '$.k') as bigint) as k, count(*) as doc_count, max(value) as most
      from events group by 1""",
    "daily_range": """
      select strftime(ts, 'events-%Y.%m.%d') as _index, count(*) as docs, count(distinct user_id) as users
      from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-01-10' group by 1""",
    "spike_rows": f"""
      with c as ({_histogram("events", "ts", "1 hour", "2024-01-01", "2024-01-30 23:59:59")}),
      m as (select avg(doc_count) as mean, stddev_pop(doc_count) as dev from c),
      peak as (select bucket from c, m where (doc_count - mean) / dev > 2)
      select bucket, event_type, count(*) as doc_count, count(distinct user_id) as users
      from (select *, time_bucket(interval '1 hour', ts, timestamp '1970-01-01') as bucket
            from events where ts <= timestamp '2024-01-30 23:59:59')
      where bucket in (select bucket from peak) group by 1, 2""",
    "postings_search": f"""
      with w as (select doc_id, {_words("text")} as w from documents)
      select 'any' as mode, doc_id from w where list_has_any(w, ['license', 'the'])
      union all select 'all', doc_id from w where list_has_all(w, ['apache', 'license'])
      union all select 'phrase', doc_id from w
      where contains(' ' || array_to_string(w, ' ') || ' ', ' apache license version 2 0 ')""",
    "postings_words": f"""
      select word, count(distinct doc_id) as doc_count, count(*) as uses
      from (select doc_id, unnest({_words("text")}) as word from documents)
      where word <> '' group by 1""",
    "count_term_mixed": "select count(*) as count from events where user_id = 149",
    "count_between_text": """
      select count(*) as count from events where event_id % 3 <> 0 and value between 10 and 20""",
    "count_text_time": f"""
      select count(*) as count
      from (select date_trunc('second', ts) as ts from events) where {W1}""",
    "count_any_none": """
      select count(*) as count from orders
      where o_orderpriority in ('1-URGENT', '2-HIGH')
        and not (o_orderstatus = 'F') and not (o_totalprice <= 1000)""",
    "count_term_open_range": f"""
      select count(*) as count from events
      where event_type = 'error' and value >= 12 and {MONTH}""",
    "count_array_term": """
      select count(*) as count from part where list_contains(string_split(p_name, ' '), 'small')""",
    "wildcard_part": "select count(*) as count from part where p_name like 'small%'",
    "wildcard_inner": "select p_partkey, p_brand from part where p_brand like 'Brand#_5'",
    "text_any": f"""
      select doc_id from documents where list_has_any({_words("text")}, ['license', 'the'])""",
    "text_all": f"""
      select doc_id from documents
      where list_has_all({_words("text || ' ' || source")}, ['license', 'apache'])""",
    "text_phrase": f"""
      select doc_id from documents
      where contains(' ' || array_to_string({_words("text")}, ' ') || ' ', ' apache license ')""",
    "text_everywhere": f"""
      select page_id from pages
      where list_has_all({_words("coalesce(url, '') || ' ' || coalesce(html, '')")},
        ['example', 'article'])""",
    "exists_by_index": """
      select 'orders' as _index, count(o_orderdate) as docs from orders
      union all select 'lineitem', count(l_shipdate) from lineitem""",
    "search_page": f"""
      select event_id, ts, user_id, value from events where event_type = 'error' and {W1}
      order by ts desc, event_id limit 20 offset 50""",
    "search_sorted_asc": """
      select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 500""",
    "search_deep_page": """
      select o_orderkey, o_orderdate from orders
      order by o_orderdate desc, o_orderkey limit 50 offset 12000""",
    "search_deep_text": """
      select c_custkey, c_mktsegment from customer
      order by c_mktsegment, c_custkey limit 100 offset 1000""",
    "search_continued": """
      select o_orderkey, o_orderdate from orders
      where o_orderdate < date '1996-06-01' or o_orderdate is null
        or (o_orderdate = date '1996-06-01' and o_orderkey > 0)
      order by o_orderdate desc nulls last, o_orderkey limit 200""",
    "search_walked": """
      select user_id, event_id from events where event_type = 'error'
      order by user_id, event_id limit 200""",
    "search_total": f"select count(*) as total from events where event_type = 'error' and {W1}",
    "terms_users": f"select * from {_top('events', 'user_id', 20, W1, 'user_id')}",
    "terms_long": f"select * from {_top('orders', 'o_custkey', 20000, 'true', 'o_custkey')}",
    "terms_status": f"select * from {_top('orders', 'o_orderstatus', 50, 'true', 'o_orderstatus')}",
    "terms_array": """
      select words, count(*) as doc_count
      from (select unnest(list_distinct(string_split(p_name, ' '))) as words from part)
      group by 1 order by 2 desc, 1 limit 50""",
    "multi_terms_orders": " union all ".join(
        [
            _top_text("status", "orders", "o_orderstatus", 50),
            _top_text("priority", "orders", "o_orderpriority", 3),
            _top_text("customer", "orders", "o_custkey", 20),
        ]
    ),
    "multi_terms_array": " union all ".join(
        [
            _top_text(
                "word",
                "(select unnest(list_distinct(string_split(p_name, ' '))) as w from part)",
                "w",
                6,
            ),
            _top_text("brand", "part", "p_brand", 50),
        ]
    ),
    "histogram_1h_zero": _histogram(
        "events", "ts", "1 hour", "2024-01-30 18:00:00", "2024-01-31 06:00:00"
    ),
    "histogram_1M": _histogram("orders", "o_orderdate", "30 days", "1995-01-01", "1995-12-31"),
    "histogram_where": _histogram(
        "events", "ts", "30 minutes", "2024-01-01", "2024-01-31", "event_type = 'purchase'"
    ),
    "histogram_fine": _histogram("events", "ts", "10 minutes", "2024-01-01", "2024-01-31"),
    "auto_histogram": _auto("events", "ts", MONTH),
    "auto_histogram_orders": _auto("orders", "o_orderdate", "o_totalprice >= 400000"),
    "stats_array": """
      select count(v) as count, min(v)::int as min, max(v)::int as max, round(avg(v), 4) as avg,
             round(sum(v::double), 4) as sum, round(stddev_pop(v), 4) as std_deviation
      from (select unnest(list_distinct(list_transform(string_split(p_name, ' '),
        lambda w: length(w)))) as v from part)""",
    "investigate_peers": """
      with o as (select *, o_orderdate >= timestamp '1995-03-01' as inside from orders
        where o_orderstatus = 'P' and o_orderdate between timestamp '1995-01-01' and timestamp '1995-04-01'),
      v as (select 'o_orderpriority' as field, o_orderpriority as key, inside from o union all
            select 'o_custkey', o_custkey::varchar, inside from o),
      k as (select field, key, bool_or(inside) as now, bool_and(inside) as new from v group by 1, 2)
      select field, count_if(now)::bigint as peers, nullif(count_if(new), 0)::bigint as new from k
      where field in ('o_orderpriority', 'o_custkey') group by 1""",
    "stats_value": """
      select count(value) as count, min(value) as min, max(value) as max,
             round(avg(value), 4) as avg, round(sum(value), 4) as sum,
             round(stddev_pop(value), 4) as std_deviation
      from events where event_type = 'purchase'""",
    "stats_none": """
      select count(user_id) as count, min(user_id) as min, max(user_id) as max,
             avg(user_id) as avg, cast(sum(user_id) as double) as sum,
             stddev_pop(user_id) as std_deviation
      from events where event_type = 'no such type'""",
    "compare_users": _compare("user_id", 20),
    "compare_long": _compare("user_id", 20_000),
    "compare_types": _compare("event_type", 20),
    "compare_exact": _compare("user_id", 20, exact=True),
    "chain_top_users": """
      select user_id, count(*) as hits from events where value > 50
      group by 1 order by 2 desc, 1 limit 20""",
    "chain_fields": """
      select 'lineitem' as _index, l_returnflag, sum(l_quantity) as pieces, count(*) as hits
      from lineitem where l_discount > 0.05 group by 2""",
    "match_explain": f"""
      select event_id, event_type = 'error' as is_error, value >= 50 as is_large,
             ({W1}) as in_week, event_type = 'error' and value >= 50 and {W1} as matched
      from events""",
    "text_score": f"""
      with t as (select doc_id, {_words("text")} as words from documents),
      d as (select doc_id, words, len(words)::double as length from t where len(words) > 0),
      c as (select count(*)::double as n, avg(length) as mean from d),
      h as (
        select doc_id, length, word, len(list_filter(words, lambda w: w = word)) as tf
        from d, (values ('license'), ('apache')) q(word)
      ), f as (select word, count(*) as df from h where tf > 0 group by 1)
      select doc_id, h.word, tf, df,
        round(ln(1::double + (n - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double
          / (tf + 1.2::double * (0.25::double + 0.75::double * length / mean)), 4) as score
      from h join f on h.word = f.word, c where tf > 0""",
    "investigate_count": f"select count(*) as count from events where user_id = 149 and {MONTH}",
    "investigate_values": _auto_user_values(),
    "investigate_timeline": _auto("events", "ts", f"user_id = 149 and {MONTH}"),
    "investigate_events": f"""
      select event_id, ts, value, event_type from events
      where user_id = 149 and value >= 100 and {MONTH}
      order by value desc, ts desc, event_id limit 5""",
    "top_offenders": " union all ".join(
        _top_text(
            ident,
            "orders",
            field,
            20,
            "o_orderdate >= timestamp '1995-01-01' and o_orderdate <= timestamp '1996-01-01'",
        )
        for ident, field in (
            ("status", "o_orderstatus"),
            ("priority", "o_orderpriority"),
            ("customer", "o_custkey"),
        )
    ),
    "top_offenders_timeline": _auto(
        "orders",
        "o_orderdate",
        "o_orderdate >= timestamp '1995-01-01' and o_orderdate <= timestamp '1996-01-01'",
    ),
    "zordered_range": """
      select o_orderkey, o_orderdate, o_totalprice from orders
      where o_orderdate >= date '1995-01-01' and o_orderdate <= date '1995-12-31'
        and o_totalprice between 200000 and 300000""",
    "reachable_nations": _reachable(
        """select cast(s_nationkey as varchar) as src, cast(c_nationkey as varchar) as dst, o_orderdate as t
        from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey""",
        ["3"],
        3,
    ),
    "reachable_parts": _reachable(
        """select 's' || l_suppkey as src, 'p' || l_partkey as dst, l_shipdate as t
        from lineitem where l_shipdate >= timestamp '1998-06-01'
        union all select 'p' || l_partkey, 's' || l_suppkey, l_shipdate
        from lineitem where l_shipdate >= timestamp '1998-06-01'""",
        ["s1", "s2"],
        2,
    ),
    "pivot_nations": f"""
      with t as (
        select s_nationkey, c_nationkey from lineitem
        join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join supplier on l_suppkey = s_suppkey
      )
      select s.key, s.doc_count as src_count, c.doc_count as dst_count
      from {_top("t", "s_nationkey", 10)} s
      join {_top("t", "c_nationkey", 10)} c on s.key = c.key""",
    "anomalous_users": """
      with c as (select user_id, count(*) as doc_count from events group by 1),
      m as (select avg(doc_count) as mean, stddev_pop(doc_count) as dev from c)
      select user_id, doc_count, round((doc_count - mean) / dev, 4) as z from c, m
      where (doc_count - mean) / dev > 2""",
    "spikes": f"""
      with c as ({_histogram("events", "ts", "1 hour", "2024-01-01", "2024-01-30 23:59:59")}),
      m as (select avg(doc_count) as mean, stddev_pop(doc_count) as dev from c)
      select bucket, doc_count, round((doc_count - mean) / dev, 4) as z from c, m
      where (doc_count - mean) / dev > 2""",
    "wildcard_by_file": "select p_partkey, p_name from part where p_name like '%all g_z%'",
    "window_events": f"""
      with c as ({_histogram("events", "ts", "1 hour", "2024-01-01", "2024-01-30 23:59:59")}),
      m as (select avg(doc_count) as mean, stddev_pop(doc_count) as dev from c),
      peak as (select bucket from c, m where (doc_count - mean) / dev > 2)
      select bucket, event_type, count(*) as doc_count, count(distinct user_id) as users
      from peak join events
        on ts >= bucket - interval '30 minutes' and ts <= bucket + interval '90 minutes'
      group by 1, 2""",
    "rollup_histogram": _histogram("events", "ts", "6 hours", "2024-01-02 03:04:05", "2024-01-27 22:10:59"),
    "fan_out_sketched": """
      select event_type, count(distinct user_id) as exact, true as near from events
      where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-19' group by 1""",
    "top_sketched": """
      select event_type as key, count(*) as doc_count from events
      where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-19'
      group by 1 order by 2 desc, 1 limit 3""",
    "spike_causes": f"""
      with c as ({_histogram("events", "ts", "1 hour", "2024-01-01", "2024-01-30 23:59:59")}),
      m as (select avg(doc_count) as mean, stddev_pop(doc_count) as dev from c),
      peak as (select bucket from c, m where (doc_count - mean) / dev > 2),
      n as (
        select bucket, event_type as key, count(*) as doc_count
        from (select *, time_bucket(interval '1 hour', ts, timestamp '1970-01-01') as bucket
              from events where ts <= timestamp '2024-01-30 23:59:59')
        where bucket in (select bucket from peak) and event_type is not null group by 1, 2)
      select bucket, 'event_type' as id, key, doc_count from n
      qualify row_number() over (partition by bucket order by doc_count desc, key) <= 2""",
    "fan_out_approximate": "select distinct l_suppkey, true as near from lineitem",
    "value_diversity": " union all ".join(
        f"select '{name}' as field, count({name}) as doc_count, true as near from documents"
        for name in ("text", "lang", "source", "doc_id")
    ),
    "fan_out": """
      select o_custkey, count(distinct o_orderpriority) as fan_out from orders group by 1""",
    "compare_report": " union all ".join(
        f"select field, cast(key as varchar) as key, status, baseline, selection, delta, pct_change"
        f" from ({_compare(field, 50, extra=chr(39) + field + chr(39) + ' as field,')})"
        for field in ("user_id", "event_type")
    ),
    "added_samples": f"""
      select user_id, event_id, ts, event_type from (
        select *, row_number() over (partition by user_id order by ts desc, event_id) as rn
        from events where {W2} and user_id in ({_WEEK_TOP})
      ) where rn <= 5""",
    "changed_drill": f"""
      select key, value, doc_count from (
        select user_id as key, event_type as value, count(*) as doc_count,
               row_number() over (partition by user_id order by count(*) desc, event_type) as rn
        from events where {W2} and user_id in (
          select key from ({_compare("user_id", 150)}) where pct_change > 50
        ) group by 1, 2
      ) where rn <= 3""",
}
