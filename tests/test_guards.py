"""Checks that need no Spark job."""

import datetime as dt

import pytest

from logframe.functions import guards
from logframe.functions.times import (
    parse_interval,
    parse_time,
    parse_window,
    seconds_since_epoch,
)
from logframe.sources.catalog import _day_bounds


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2024-03-01T10:20:30.123456Z", dt.datetime(2024, 3, 1, 10, 20, 30, 123456)),
        ("2024-03-01T10:20:30", dt.datetime(2024, 3, 1, 10, 20, 30)),
        ("2024-03-01", dt.datetime(2024, 3, 1)),
        ("2024-03-01T10:20:30+02:00", dt.datetime(2024, 3, 1, 8, 20, 30)),
        (dt.date(2024, 3, 1), dt.datetime(2024, 3, 1)),
        (
            dt.datetime(2024, 3, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2))),
            dt.datetime(2024, 3, 1),
        ),
    ],
)
def test_readable_times(text, moment):
    assert parse_time(text) == moment


@pytest.mark.parametrize("text", ["yesterday", "2024-13-01", ""])
def test_unreadable_times(text):
    with pytest.raises(ValueError, match="unreadable timestamp"):
        parse_time(text)


def test_reversed_window():
    with pytest.raises(ValueError, match="reversed"):
        parse_window("2024-03-02", "2024-03-01")
    assert parse_window("", None) == (None, None)


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("1s", 1),
        ("15m", 900),
        ("2h", 7200),
        ("1d", 86400),
        ("1w", 604800),
        ("1M", 30 * 86400),
        ("1y", 365 * 86400),
    ],
)
def test_intervals(text, seconds):
    assert parse_interval(text) == seconds


@pytest.mark.parametrize("text", ["0h", "h", "1", "1.5h", "-1h", "1 h", "1H", "auto", "1h\n"])
def test_bad_intervals(text):
    with pytest.raises(ValueError, match="bad interval"):
        parse_interval(text)


def test_seconds_round_down_before_1970():
    assert seconds_since_epoch(dt.datetime(1969, 12, 31, 23, 59, 59, 500000)) == -1
    assert seconds_since_epoch(dt.datetime(1970, 1, 1, 0, 0, 1, 500000)) == 1


def test_page_bounds():
    assert guards.page_bounds(50, 0) == (50, 0)
    assert guards.page_bounds(500, -7) == (500, 0)
    assert guards.page_bounds(500, 3, cap=1000) == (500, 3)
    with pytest.raises(ValueError, match="over the cap"):
        guards.page_bounds(500, 3, cap=200)
    with pytest.raises(ValueError):
        guards.page_bounds(-1, 0)


def test_sample_bound():
    assert guards.sample_bound(10) == 10
    assert guards.sample_bound(1000) == 1000
    with pytest.raises(ValueError):
        guards.sample_bound(-1)


def test_bucket_grid():
    first, last, width = guards.bucket_grid("2024-03-01T00:30:00", "2024-03-01T03:00:00", "1h")
    assert (last - first) // width + 1 == 4
    with pytest.raises(ValueError, match="both"):
        guards.bucket_grid("2024-03-01", None, "1h")


def test_too_many_buckets():
    guards.bucket_grid("2024-03-01T00:00:00", "2024-03-01T00:33:19", "1s", cap=2000)
    with pytest.raises(ValueError, match="2,001 buckets"):
        guards.bucket_grid("2024-03-01T00:00:00", "2024-03-01T00:33:20", "1s", cap=2000)
    guards.bucket_grid("2024-03-01", "2024-03-02", "1s")


@pytest.mark.parametrize(
    "name", ["rule.description", "message", "full_log", "app-log", "fullLog", "Event.TEXT"]
)
def test_names_that_sound_like_text(name):
    assert guards.looks_like_text(name)


@pytest.mark.parametrize("name", ["agent.name", "rule.id", "data.srcip", "message.id", "catalog", "login", "context"])
def test_names_that_do_not(name):
    assert not guards.looks_like_text(name)


def test_advice():
    assert guards.advise(limit=50, from_ts="2024-03-01") == []
    assert len(guards.advise()) == 1
    assert guards.advise(timed=False) == []
    texts = guards.advise(limit=500, sample_size=101, fields=["rule.id", "rule.description"])
    assert len(texts) == 4
    assert "above 200" in texts[0] and "above 100" in texts[1] and "rule.description" in texts[3]


@pytest.mark.parametrize(
    "pattern, bounds",
    [
        ("log-2024.01.0*", ("2024-01-01", "2024-01-09")),
        ("log-2024.02*", ("2024-02-01", "2024-02-29")),
        ("log-2024.1*", ("2024-10-01", "2024-12-31")),
        ("log-2024.03.15", ("2024-03-15", "2024-03-15")),
        ("log-2024*15", ("2024-01-01", "2024-12-31")),
        ("log-20*", ("2000-01-01", "2099-12-31")),
        ("log-2024.02.3*", None),
        ("log-2024.00*", None),
        ("log-2024.13*", None),
        ("l*", None),
        ("log-x*", None),
        ("log-2024.01.01.5*", None),
    ],
)
def test_days_of_a_pattern(pattern, bounds):
    assert _day_bounds("log", pattern) == bounds
