"""From documents to batches: drop toxic ones, cut boilerplate lines, thin near copies, pack.

Stages take and return whole tables; each works on what the one before kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logframe.llm.jaccard_join import jaccard_components
from logframe.llm.line_dedup import line_dedup
from logframe.llm.packing import pack
from logframe.llm.queries import fold, labels
from logframe.llm.shared import WHITE, new_folder, unused
from logframe.llm.toxicity import score, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under their language's threshold.

    The classifier learns from the labels of the folder, but for the held-out
    fold, as far as their documents are here.
    """
    network = train(docs, labels(spark, sf_dir), learn=fold(5) != 0, check=fold(5) == 1)
    scored = score(docs, network)
    return scored.filter(~F.col("toxic")).select(*docs.columns)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a tenth of their source's documents have."""
    cut = line_dedup(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 80 in 100): that with the least doc_id.

    Of rows with the same id in a group that with the least hash of its text
    stays, and a row without an id only where no row has one. Documents without
    words are no copies of each other. Rows that repeat both id and text are one
    row after, but those without id and words all stay.
    """
    own, stays_id, stays_hash = unused(docs, "text_hash", "stays_id", "stays_hash")
    classes = jaccard_components(docs, words=5, percent=80, keys=True)
    group = F.coalesce("root", F.concat_ws("|", F.lit(""), F.col("doc_id").cast("string"), "text_hash"))
    stays = (
        classes.filter("doc_id is not null or n_shingles > 0")
        .groupBy(group.alias("group"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("row"))
        .select(F.col("row.doc_id").alias(stays_id), F.col("row.text_hash").alias(stays_hash))
    )
    same = F.col("doc_id").eqNullSafe(F.col(stays_id)) & (F.col(own) == F.col(stays_hash))
    rows = docs.withColumn(own, F.xxhash64("text"))
    kept = rows.join(stays, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
    blank = ~F.coalesce("text", F.lit("")).rlike(f"[^{WHITE}]")
    return kept.unionByName(docs.filter(F.col("doc_id").isNull() & blank)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every piece of every document that is left."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", boilerplate),
    ("jaccard_join", near_copies),
    ("packing", packing),
]

# A trained classifier and an optimal packing are no SQL; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what lies between stages is written to the checkpoint folder."""
    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
