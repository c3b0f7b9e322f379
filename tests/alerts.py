"""About thirty hand-written alert documents that cover the edge cases."""

from __future__ import annotations

import datetime as dt

SCHEMA = """
  _id string,
  `@timestamp` timestamp_ntz,
  agent struct<id: string, name: string>,
  rule struct<id: string, level: int, description: string, groups: array<string>>,
  data struct<srcip: string, dstip: string, bytes: bigint>
"""

# The window most tests ask for, and the touching windows of a comparison.
FROM, TO = "2024-03-01T01:00:00Z", "2024-03-01T05:00:00Z"
BASELINE = ("2024-03-01T00:00:00Z", "2024-03-01T03:00:00Z")
SELECTION = ("2024-03-01T03:00:00Z", "2024-03-01T06:00:00Z")


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat("2024-03-01 " + text)


def row(ident, time, agent, rule, data):
    return (ident, at(time) if time else None, agent, rule, data)


SSH = ("5710", 5, "Failed login for root", ["auth", "ssh", "auth"])
WEB = ("31101", 12, "Web server error: apache_license missing", ["web"])
NEW = ("99001", 15, "Apache License seen", [])
WARNING = ("_warning", 3, "nothing", None)
NO_LEVEL = ("5710", None, "Failed login for admin", ["auth"])

DC, WWW = ("001", "WIN-DC01"), ("002", "srv-web01")
A_TO_B = ("10.0.0.1", "10.0.0.2", 100)
B_TO_C = ("10.0.0.2", "10.0.0.3", 9_000_000_000)
A_TO_C = ("10.0.0.1", "10.0.0.3", None)

ROWS = [
    # On both bounds of the window, and a microsecond outside of each.
    row("a01", "01:00:00", DC, SSH, A_TO_B),
    row("a02", "05:00:00", DC, SSH, A_TO_B),
    row("a03", "00:59:59.999999", DC, SSH, A_TO_B),
    row("a04", "05:00:00.000001", DC, SSH, A_TO_B),
    # Equal counts and equal times of two agents.
    row("a05", "02:10:00", WWW, WEB, B_TO_C),
    row("a06", "02:10:00", WWW, WEB, B_TO_C),
    row("a07", "02:10:00", DC, WEB, A_TO_C),
    # The instant both comparison windows share.
    row("a08", "03:00:00", WWW, SSH, A_TO_C),
    # Values missing at every level.
    row("a09", "04:20:00", DC, NO_LEVEL, A_TO_B),
    row("a10", "04:30:00", None, WEB, None),
    row("a11", None, DC, SSH, A_TO_B),
    row("a12", "04:40:00", WWW, None, B_TO_C),
    # New in the selection window; a value that looks like a marker.
    row("a13", "04:50:00", WWW, NEW, B_TO_C),
    row("a14", "05:10:00", WWW, NEW, B_TO_C),
    row("a15", "00:10:00", DC, WARNING, A_TO_B),
    row("a16", "00:20:00", DC, WARNING, A_TO_B),
]


def alerts(spark):
    return spark.createDataFrame(ROWS, SCHEMA)
