"""Checks made on the driver before a plan is built; none of them runs a job."""

from __future__ import annotations

import re
from collections.abc import Iterable

from logframe.functions.times import parse_interval, parse_window, seconds_since_epoch

# Sizes from which advice is given. Nothing is cut to them.
LARGE_LIMIT = 200
LARGE_SAMPLE = 100

# Words in a name that point to free text rather than a keyword.
TEXT_NAME_HINTS = (
    "description",
    "message",
    "full_log",
    "log",
    "content",
    "text",
    "comment",
    "detail",
    "summary",
    "reason",
    "output",
)


def page_bounds(limit: int, offset: int, cap: int | None = None) -> tuple[int, int]:
    """Limit and offset from zero up; a negative limit is an error, and so is one over a given cap."""
    if limit < 0:
        raise ValueError(f"limit must not be negative, got {limit}")
    if cap is not None and limit > cap:
        raise ValueError(f"limit {limit} is over the cap of {cap}")
    return limit, max(offset, 0)


def sample_bound(sample_size: int) -> int:
    if sample_size < 0:
        raise ValueError(f"sample_size must not be negative, got {sample_size}")
    return sample_size


def top_size(size: int) -> int:
    if size < 1:
        raise ValueError(f"size must be at least 1, got {size}")
    return size


def bucket_grid(
    from_ts, to_ts, interval: str, cap: int | None = None
) -> tuple[int, int, int]:
    """First bucket, last bucket and width in epoch seconds for a fixed interval."""
    width = parse_interval(interval)
    if not from_ts or not to_ts:
        raise ValueError("a histogram needs both from_ts and to_ts")
    first, last = (
        seconds_since_epoch(moment) // width * width for moment in parse_window(from_ts, to_ts)
    )
    buckets = (last - first) // width + 1
    if cap is not None and buckets > cap:
        raise ValueError(
            f"{interval} from {from_ts} to {to_ts} makes {buckets:,} buckets, "
            f"over the limit of {cap:,}: take a wider interval or a shorter range"
        )
    return first, last, width


def _name_words(name: str) -> list[str]:
    """``fullLog``, ``full_log`` and ``full-log`` are all ``full`` and ``log``."""
    return [part.lower() for part in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[^A-Z_\W]+", name)]


def looks_like_text(path: str) -> bool:
    """Whether words of the last part of a field name hint at free text."""
    words = f" {' '.join(_name_words(path.rpartition('.')[2]))} "
    return any(f" {' '.join(_name_words(hint))} " in words for hint in TEXT_NAME_HINTS)


def advise(
    *,
    limit: int | None = None,
    sample_size: int | None = None,
    fields: Iterable[str] = (),
    timed: bool = True,
    from_ts=None,
    to_ts=None,
) -> list[str]:
    """Advice on a call that is allowed but probably not what was meant.

    ``timed=False`` leaves out the time-range advice, which concerns search
    and count only.
    """
    advice = []
    if limit is not None and limit > LARGE_LIMIT:
        advice.append(
            f"limit {limit} is above {LARGE_LIMIT}: select fewer fields or fetch several pages"
        )
    if sample_size is not None and sample_size > LARGE_SAMPLE:
        advice.append(f"sample_size {sample_size} is above {LARGE_SAMPLE}: fewer rows may do")
    if timed and not from_ts and not to_ts:
        advice.append("no time range: the whole table is read, pass from_ts or to_ts to narrow it")
    for path in fields:
        if looks_like_text(path):
            advice.append(
                f"field {path!r} sounds like free text: its values may be almost all different"
            )
    return advice
