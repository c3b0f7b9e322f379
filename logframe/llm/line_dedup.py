"""Boilerplate lines: those that a large share of a site's pages have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.llm.shared import checkpointed, unused

# A broadcast list of boilerplate holds at most this many lines, at 8 bytes each
# besides its hosts; a longer one is joined by a shuffle instead.
BROADCAST_LINES = 200_000


def boilerplate_lines(
    docs: DataFrame, host: str, text: str, ratio: float, min_pages: int
) -> DataFrame:
    """Per host the hashes of the lines on more than ``ratio`` of its pages: host, lines.

    A page counts once for a line however often it repeats it; lines are
    compared without white space at their ends, and blank ones are left out.
    Counts are made in every task before the shuffle, so a host or a line with
    a third of all rows becomes one row per task.
    """
    pages = docs.select(
        F.coalesce(F.col(host), F.lit("")).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    hashes = F.array_distinct(F.transform(_lines(F.col("text")), _line_hash))
    counts = (
        pages.select("host", F.explode(hashes).alias("line"))
        .filter("line is not null")
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n_with"))
        .filter(F.col("n_with") >= min_pages)
    )
    return (
        counts.join(totals, "host")
        .filter(F.col("n_with") > F.col("n_pages") * F.lit(float(ratio)))
        .groupBy("host")
        .agg(F.collect_list("line").alias("lines"))
    )


def line_dedup(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = 0.1,
    min_pages: int = 5,
) -> DataFrame:
    """The documents with boilerplate lines cut out of their text, and two counts added.

    A line is boilerplate if more than ``ratio`` of its host's pages, and at
    least ``min_pages`` of them, have it; every such line goes, all others stay
    with their order, blank lines and line ends. All columns are kept;
    ``n_lines`` and ``n_dropped`` are added (and replace columns of those
    names). No document is dropped: one made of boilerplate keeps its row with
    an empty text. A NULL text stays NULL with counts 0, NULL hosts are one
    host, and no rows give no rows. A host has at most (lines of its pages on
    average) / ``ratio`` boilerplate lines, whatever its number of pages.
    """
    found = checkpointed(boilerplate_lines(docs, host, text, ratio, min_pages))
    held = found.agg(F.sum(F.size("lines") + 1)).first()[0] or 0
    site, bad, own, stays = unused(docs, "site", "bad", "own", "stays")
    found = found.select(F.col("host").alias(site), F.col("lines").alias(bad))
    if held <= BROADCAST_LINES:
        found = F.broadcast(found)
    known = F.coalesce(F.col(bad), F.array().cast("array<bigint>"))
    is_bad = lambda line: F.coalesce(F.array_contains(known, _line_hash(line)), F.lit(False))
    n_lines = F.when(F.col(text).isNotNull(), F.size(_lines(F.col(text)))).otherwise(0)
    n_stays = F.when(F.col(text).isNotNull(), F.size(stays)).otherwise(0)
    added = {
        text: F.array_join(stays, "\n"),
        "n_lines": n_lines.cast("long"),
        "n_dropped": (n_lines - n_stays).cast("long"),
    }
    return (
        docs.withColumn(own, F.coalesce(F.col(host), F.lit("")))
        .join(found, F.col(own) == F.col(site), "left")
        .withColumn(stays, F.filter(_lines(F.col(text)), lambda line: ~is_bad(line)))
        .select(
            *[F.col(name) for name in docs.columns if name not in added],
            *[column.alias(name) for name, column in added.items()],
        )
    )


def _lines(text):
    return F.split(text, "\n", -1)


def _line_hash(line):
    """The hash of a line without white space at its ends; NULL for a blank one."""
    bare = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(bare != "", F.xxhash64(bare))
