"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.llm.shared import checkpointed


def components(links: DataFrame, one: str = "one", other: str = "other") -> DataFrame:
    """The least node that can be reached from each linked node: node, root.

    Links are turned into stars: each round every node hands its greater
    neighbours, then its lesser ones, to the least node it knows, until nothing
    changes; about log2 of the longest chain many rounds. A node's neighbours
    are never gathered: its least one is an aggregate, joined back to its links,
    so a node that a third of all links have is split like any hot key.
    Links to itself and repeated ones do no harm. No links, no rows.
    """
    pair = links.select(F.col(one).alias("u"), F.col(other).alias("v")).filter("u != v")
    stars = checkpointed(_down(pair).distinct())
    before = None
    while True:
        seen = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("link")
        )
        stars = checkpointed(small.select("link.u", "link.v").filter("u != v").distinct())
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())


def _down(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
