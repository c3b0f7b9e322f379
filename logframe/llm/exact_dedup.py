"""Exact duplicates found by length, then by the hash of a prefix, then by the full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.llm.shared import ascii_lower, checkpointed


def exact_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    prefix: int = 64,
    digests: bool = False,
) -> DataFrame:
    """The copy that stays, for each document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL is the empty
    text. Of equal texts the largest doc_id stays. Each step looks at what the
    one before left: lengths that occur twice, then hashes of the length and
    the first ``prefix`` characters that occur twice, then SHA-256 of whole
    texts. A text whose length or prefix nothing shares is never hashed, and
    its ``text_sha256`` is NULL unless ``digests`` asks for every row's.

    Rows that repeat a doc_id and text are copies like others: all rows with
    the id that stays are kept. A NULL doc_id stays only where the whole group
    has none. No rows in, no rows out. Other columns are ignored.

    Groups are counted before they are shuffled. Rows are joined with the counts
    by the group's key, so a large group's rows, of some 50 bytes, meet where
    adaptive execution does not split them. With ``digests`` whole hashes are
    taken in the task that reads a text, and no text is shuffled; without, the
    shuffle before the full hash moves texts.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("n_bytes", F.octet_length("text"))
    start = F.xxhash64("n_bytes", ascii_lower(F.substring("text", 1, prefix)))

    lengths = rows.groupBy("n_bytes").count().filter("count > 1").select("n_bytes")
    starts = (
        rows.select("n_bytes", start.alias("start"))
        .join(lengths, "n_bytes", "left_semi")
        .groupBy("start")
        .count()
        .filter("count > 1")
        .select("start", F.lit(True).alias("shared"))
    )
    digest = F.sha2(ascii_lower(F.col("text")), 256)
    shared = F.coalesce("shared", F.lit(False))
    if digests:
        # Owed for every row, so it is taken where the text is read and sent instead of it.
        read = rows.select("doc_id", start.alias("start"), F.unhex(digest).alias("digest")).join(starts, "start", "left")
        own = F.lower(F.hex("digest"))
    else:
        read = rows.select("doc_id", "text", start.alias("start")).join(starts, "start", "left")
        own = F.when(F.col("shared"), digest)
    read = checkpointed(read.select("doc_id", shared.alias("shared"), own.alias("text_sha256")))
    groups = (
        read.filter("shared")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )
    alone = read.filter("not shared").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    found = F.col("group_size").isNotNull()
    grouped = (
        read.filter("shared")
        .join(groups, "text_sha256", "left")
        .select(
            "doc_id",
            F.when(found, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            (~found | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            "text_sha256",
        )
    )
    return grouped.unionByName(alone)
