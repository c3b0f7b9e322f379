"""URL rules: a blocked Bloom filter passes possible hits to an exact join with the list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.llm.bloom import bloom_blocks, tester
from logframe.llm.shared import ascii_lower

RULES = "host string, path string, action string"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    """How many labels a host has: one more than dots."""
    return F.char_length(host) - F.char_length(F.replace(host, F.lit("."))) + 1


def url_verdicts(
    urls: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """The rule that judges each different URL place: host, path, rule (NULL if none), verdict.

    ``rules`` has host, path and action ("allow" or "block"). A rule fits its
    host and all hosts below it, for paths that start with its own; of several
    the longest wins (of equal length, that with the longer host). Rules with
    NULLs are left out; of repeated rules a block wins. Rows come once for
    every different host and path, whatever the number of pages.

    A URL's possible keys are its host and the hosts above it with as many
    labels as some rule's host, each with the beginnings of its path of the
    lengths that the rules have: work in proportion to the URL. A vectorised
    test of the filter drops nearly all that are not listed; only what it
    passes is joined with the list, which may be larger than memory.
    """
    spark = urls.sparkSession
    listed = (
        rules.select(ascii_lower(F.col("host")).alias("host"), "path", "action")
        .filter("host is not null and path is not null and action is not null")
        .groupBy("host", "path")
        .agg(F.max("action").alias("action"))
    )
    sizes = listed.agg(
        F.count(F.lit(1)), F.collect_set(F.char_length("path")), F.collect_set(_labels(F.col("host")))
    ).first()
    lengths, depths = sorted(sizes[1]), sorted(sizes[2])
    blocks = bloom_blocks(listed.select(F.xxhash64("host", "path").alias("key")), "key", sizes[0])

    places = urls.select(
        url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    ).distinct()
    # Only hosts above with as many labels as some rule's host has, so a long host costs no more.
    above = F.array_compact(
        F.array(
            *[F.when(_labels(F.col("host")) >= n, F.substring_index("host", ".", -n)) for n in depths]
        ).cast("array<string>")
    )
    fitting = F.filter(
        F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("path")
    )
    keys = (
        places.withColumn("rule_host", F.explode(above))
        .withColumn("n", F.explode(fitting))
        .withColumn("rule_path", F.col("path").substr(F.lit(1), F.col("n")))
        .withColumn("key", F.xxhash64("rule_host", "rule_path"))
        .filter(tester(spark, blocks, F.col("key")))
    )
    hits = keys.join(
        listed.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action"),
        ["rule_host", "rule_path"],
    )
    weight = F.struct(
        (F.char_length("rule_host") + F.char_length("rule_path")).alias("length"),
        F.char_length("rule_host").alias("host_length"),
        F.concat("rule_host", "rule_path").alias("rule"),
        "action",
    )
    best = hits.groupBy("host", "path").agg(F.max(weight).alias("best"))
    return places.join(best, ["host", "path"], "left").select(
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """Every page's host, path, rule and verdict: page_id, host, path, rule, verdict.

    A URL without ``://`` and a NULL one have an empty host and path, which no
    rule with a host fits: they are allowed. Repeated rows are judged each;
    no pages, no rows. Other columns are ignored.
    """
    own = pages.select(
        F.col(page_id).alias("page_id"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
    )
    return own.join(url_verdicts(pages, rules, url), ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", "verdict"
    )
