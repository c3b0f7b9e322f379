"""The registered queries over tables with odd rows, against brute force, and over empty tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logframe.llm.queries import QUERIES
from logframe.llm.url_filter import RULES, judge_urls
from tests.llm.fixtures import SCHEMA, tricky
from tests.llm.test_dedup import brute_jaccard
from tests.llm.test_models import kneser_ney_of_order, toxic_table

SMALL = "/root/testdata/sf0.001"


def fold(ident, folds):
    return None if ident is None else zlib.crc32(str(ident).encode()) % folds


@pytest.fixture(scope="module")
def rows():
    return tricky(seed=5, n=40)


@pytest.fixture(scope="module")
def root(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for path in Path(SMALL).glob("*.parquet"):
        spark.read.parquet(str(path)).limit(0).write.parquet(f"{folder}/{path.name}")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_pipeline_of_nothing(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_op1(spark, tmp_path):
    docs, labels = toxic_table(500)
    docs = [*docs, (None, "no id", "en"), (90_001, None, None), (90_002, "", "de")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    frame = frame.withColumns({"score": F.lit("x"), "held_out": F.lit(1), "source": F.lit(None).cast("string")})
    found = {}
    for name, given in (
        ("same", labels),
        ("turned", [(i, 1 - toxic if fold(i, 5) == 0 else toxic) for i, toxic, *_ in labels]),
    ):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        given = [row[:2] for row in given]
        spark.createDataFrame(given, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
        result = QUERIES["op1_toxicity"](spark, folder)
        assert result.dtypes[:4] == [
            ("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int"),
        ]
        found[name] = sorted(result.collect(), key=str)
    assert found["same"] == found["turned"]  # labels of the held-out fold are not learnt from
    assert Counter(r.doc_id for r in found["same"]) == Counter(i for i, *_ in docs)
    for row in found["same"]:
        assert row.held_out == (fold(row.doc_id, 5) == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
    held = {r.doc_id: r.predicted for r in found["same"] if r.held_out}
    truth = {i: toxic for i, toxic, *_ in labels if i in held}
    assert sum(held[i] == t for i, t in truth.items()) > 0.85 * len(truth)


def test_op2(spark, root, rows):
    train = [text for i, text, *_ in rows if fold(i, 7) != 2]
    words, p = kneser_ney_of_order(train, 3)
    counts = Counter(w for text in train for w in [*(text or "").encode().lower().split(), None])
    total = sum(counts.values())
    found = defaultdict(list)
    for row in QUERIES["op2_kneser_ney"](spark, root).collect():
        found[row.doc_id].append(row)
    for i, text, *_ in rows:
        w = ["start", "start", *(text or "").encode().lower().split(), None]
        tokens = w[2:]
        base = sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in tokens)
        score = sum(math.log10(p(tuple(w[j - 2 : j]), w[j])) for j in range(2, len(w)))
        assert any(
            (r.held_out, r.n_tokens, r.n_known, r.train_tokens)
            == (fold(i, 7) == 2, len(tokens), sum(x in counts for x in tokens), total)
            and math.isclose(r.base_score, base)
            and math.isclose(r.score, score)
            for r in found[i]
        )


def test_op3(spark, root, rows):
    order = sorted(((i, text or "") for i, text, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    result = QUERIES["op3_simhash"](spark, root).collect()
    bits = lambda row: int(row.fingerprint, 16)
    likeness = lambda one, other: 1 - (one ^ other).bit_count() / 64
    prints = {}
    wanted = Counter()
    for n, (i, text) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        moved = min(len(text) // 4, len(after))
        cut = len(text) - len(text) // 4
        edited = text[:cut] + after[: len(text) // 4]
        wanted[i, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
        assert moved <= len(text) // 4
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in result) == wanted
    for row in result:
        assert row.near_edited == likeness(bits(row), int(row.edited_fingerprint, 16))
        assert prints.setdefault((row.doc_id, row.n_chars, row.edited_sha256), row.fingerprint) == row.fingerprint
    different = {r.fingerprint for r in result}
    for row in result:
        near = sum(0 < (bits(row) ^ int(f, 16)).bit_count() <= 3 for f in different)
        assert row.n_near == near


def test_op8(spark, root, rows):
    found = QUERIES["op8_jaccard_join"](spark, root)
    assert found.dtypes[:3] == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    found = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found.collect())
    assert found == Counter(brute_jaccard(rows, 3, 90))


def test_op9(spark, root, rows):
    packed = QUERIES["op9_packing"](spark, root).collect()
    words = Counter()
    for row in packed:
        words[row.doc_id] += row.n_words
    wanted = Counter()
    for i, text, *_ in rows:
        wanted[i] += len((text or "").encode().split())
    assert +words == +wanted


def test_op10(spark, root, rows):
    library = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    library.no_truncation()
    library.no_padding()
    wanted = Counter()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted[i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)] += 1
    found = QUERIES["op10_bpe"](spark, root).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == wanted


def test_urls_of_a_megabyte(spark):
    long_host = ".".join(["a"] * 500_000)
    urls = [f"http://{long_host}.example.com/en/x", f"http://{long_host}/", "http://com/" + "x/" * 500_000, "http://" + "." * 1_000_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block")], RULES)
    found = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert found == {0: ("example.com/en/", "block"), 1: (None, "allow"), 2: ("com/", "allow"), 3: (None, "allow")}


def test_stages_with_clashing_columns(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {name: F.lit(n) for n, name in enumerate(["stays_id", "stays_hash", "text_hash", "root", "score", "region"])}
    )
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= len(rows)
    scored = corpus_pipeline.toxicity(spark, docs, SMALL)
    assert scored.columns == docs.columns and scored.count() > 0
    assert corpus_pipeline.packing(spark, docs, SMALL).count() > 0
