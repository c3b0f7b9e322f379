"""One query per training-data operator over its whole table, and the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logframe.llm import bpe, kneser_ney, pii
from logframe.llm.exact_dedup import exact_dedup
from logframe.llm.jaccard_join import jaccard_components
from logframe.llm.line_dedup import line_dedup
from logframe.llm.negatives import hard_negatives
from logframe.llm.packing import pack
from logframe.llm.resample import resample
from logframe.llm.shared import new_folder
from logframe.llm.simhash import likeness, order_marks, simhash, with_next, within_radius
from logframe.llm.toxicity import score, train
from logframe.llm.url_filter import RULES, judge_urls
from logframe.llm.warc import read_warc, write_warc

# The tokenizer file of op10, which is never copied into the package.
TOKENIZER = "word_bpe_49k.json"

# The rules of op7: host, beginning of the path, action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# Hamming radius in which op3 counts other fingerprints.
NEAR_BITS = 3


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from four of five folds; fold 1 calibrates.

    A document without an id is in no fold: it is not held out, and no label is its.
    """
    docs = documents(spark, sf_dir)
    network = train(docs, labels(spark, sf_dir), learn=fold(5) != 0, check=fold(5) == 1)
    return score(docs, network).select(
        "doc_id",
        F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "toxic",
    )


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under a model of runs of three words of six of seven folds."""
    docs = documents(spark, sf_dir).select(
        "doc_id", F.coalesce(fold(7) == 2, F.lit(False)).alias("held_out"), "text"
    )
    model = kneser_ney.train(docs.filter("not held_out"), order=3)
    return kneser_ney.score(docs, model, ["doc_id", "held_out"])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how near they are.

    ``n_near`` is the number of other fingerprints within the radius. A NULL
    doc_id comes first in the order; rows with equal ids are in order of text.
    """
    docs = documents(spark, sf_dir).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("place"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    marks = order_marks(docs, "place")
    n = F.char_length("text").cast("long")
    rows = (
        with_next(docs, "place", ["text"], ["text"], marks)
        .withColumn("n_chars", n)
        .withColumn("moved", F.floor(F.col("n_chars") / 4).cast("int"))
        .withColumn(
            "edited",
            F.concat(
                F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - F.col("moved")),
                F.col("next_text").substr(F.lit(1), F.col("moved")),
            ),
        )
        .select(
            "place",
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "text",
            "edited",
        )
    )
    keys = ["place", "doc_id", "row", "n_chars", "edited_sha256"]
    prints = simhash(rows, keys, ["text", "edited"])
    prints = with_next(prints, "place", ["row"], ["text_fp"], marks)
    pairs = within_radius(prints, "text_fp", NEAR_BITS)
    near = (
        pairs.select(F.explode(F.array("one", "other")).alias("text_fp"))
        .groupBy("text_fp")
        .agg(F.count(F.lit(1)).alias("n_near"))
    )
    return prints.join(near, "text_fp", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _hex64("text_fp").alias("fingerprint"),
        _hex64("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("text_fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("text_fp"), F.col("next_text_fp")).alias("near_next"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )


def _hex64(name: str):
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its source's boilerplate lines.

    A line needs five of the source's documents besides a tenth of them, so a
    source of fewer than five keeps all its lines.
    """
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2("text", 256).alias("text_sha256"),
    )


OP4_SQL = r"""
with doc as (
  select doc_id, coalesce(source, '') as host, string_split(text, chr(10)) as lines from documents
), line as (
  select doc_id, host, unnest(lines) as line, unnest(range(len(lines))) as nr from doc
), bare as (
  select *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as b from line
), total as (
  select host, count(*) as pages from doc group by host
), bad as (
  select host, b from bare join total using (host) where b <> ''
  group by host, b, pages
  having count(distinct doc_id) >= 5 and count(distinct doc_id) > pages * 0.1
)
select doc_id, count(*)::bigint as n_lines, count(bad.b)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by nr) filter (bad.b is null), '')) as text_sha256
from bare left join bad using (host, b) group by doc_id
"""


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which copy of every document stays."""
    return exact_dedup(documents(spark, sf_dir), digests=True)


OP5_SQL = """
with low as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents
)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id = max(doc_id) over g as kept, text_sha256
from low window g as (partition by text_sha256)
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archives that were written from the table."""
    files = write_warc(pages(spark, sf_dir), new_folder(spark, "warc"))
    number = lambda name: F.regexp_extract(name, r"^<urn:page:(-?\d*)>$", 1).try_cast("long")
    return read_warc(spark, files).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
        "intact",
    )


OP6_SQL = """
with page as (
  select page_id, coalesce(html, '') as html from pages
), digest as (
  select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as hex,
    max(page_id) over (partition by html) as keep
  from page
)
select page_id, payload_bytes,
  list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (5 * (i // 4) + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1,
    1)), lambda a, b: a || b) as payload_digest,
  case when page_id = keep then 'response' else 'revisit' end as record_type,
  case when page_id <> keep then keep end as refers_to,
  true as intact
from digest
"""


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return judge_urls(pages(spark, sf_dir), spark.createDataFrame(URL_RULES, RULES))


OP7_SQL = r"""
with place as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rules(rule_host, rule_path, action) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hit as (
  select host, path, rule_host || rule_path as rule, action
  from (select distinct host, path from place), rules
  where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
), best as (
  select host, path, arg_max(rule, length(rule)) as rule, arg_max(action, length(rule)) as action
  from hit group by host, path
)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict
from place left join best using (host, path)
"""


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-copy component of every document: three words, 90 in 100."""
    return jaccard_components(documents(spark, sf_dir), words=3, percent=90)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every piece of every document."""
    return pack(documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    import public_tokenizers

    told = bpe.digest(F.col("text"), str(public_tokenizers.path(TOKENIZER)))
    return documents(spark, sf_dir).select("doc_id", told.alias("told")).select("doc_id", "told.*")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight for the benchmark's texts, and its rank if it is drawn: a quarter are."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = resample(documents(spark, sf_dir), target, seed=7, percent=25, least_words=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


OP11_SQL = r"""
with text as (
  select doc_id as id, true as raw, text from documents
  union all select item_id, false, text from benchmark
), word as (
  select id, raw, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from text
), run as (
  select id, raw, len(w) as n_words,
    unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f
  from word
), byte as (
  select f, list_transform(range(strlen(f)), lambda i: ('0x' || substr(hex(f), (2 * i + 1)::int, 2))::bigint) as b
  from (select distinct f from run)
), crc as (
  select f, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: list_reduce(
    list_prepend(xor(c, x), range(8)),
    lambda d, k: xor(d >> 1, (d & 1) * 3988292384::bigint))), 4294967295::bigint) % 10000 as bucket
  from byte
), hit as (
  select id, raw, n_words, bucket from run join crc using (f)
), bucket as (
  select bucket, count(*) filter (raw) as s, count(*) filter (not raw) as t from hit group by bucket
), total as (
  select count(*) filter (raw) as all_s, count(*) filter (not raw) as all_t from hit
), gain as (
  select bucket, floor(1000 * ln(((t + 1) * (all_s + 10000))::double
    / ((s + 1) * (all_t + 10000))::double))::bigint as g
  from bucket, total
), weight as (
  select id as doc_id, any_value(n_words) as n_words, count(*) as n_features,
    floor(sum(g)::double / count(*))::bigint as weight
  from hit join gain using (bucket) where raw group by id
), score as (
  select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_features, 0) as n_features,
    coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from documents left join weight using (doc_id)
), able as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
  from score where n_words >= 20
)
select doc_id, n_features::bigint as n_features, weight, score,
  case when rank <= 25 * n // 100 then rank end as rank, n_words::bigint as n_words
from score left join able using (doc_id)
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hundredth vector's positives, and the hard negatives of each of them."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=moved)


OP12_SQL = """
with vec as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pair as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    list_inner_product(a.e, b.e)::bigint as score
  from vec a join vec b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
), positive as (
  select anchor_id, vec_id as positive_id, score as positive_score from pair where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
  (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positive join pair using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: the rules' spans counted and digested, and all spans."""
    docs = documents(spark, sf_dir)
    found = pii.find(docs.select("doc_id", "text"), pii.train(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: ~s["added"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.withColumn("base", base).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_simhash": op3_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_warc": op6_warc,
    "op7_url_filter": op7_url_filter,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_packing": op9_packing,
    "op10_bpe": op10_bpe,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_pii": op13_pii,
}

ORACLE = {
    "op4_line_dedup": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op7_url_filter": OP7_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
