"""WARC round trips at every split size, URL rules against brute force, BPE against its library."""

import base64
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logframe.llm import bpe, warc
from logframe.llm.url_filter import RULES, judge_urls

PAGES = [
    (1, "http://a.com/x y", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (3, "http://b.com/\r\nWARC-Type: fake", "é" * 3000),
    (4, "u", ""),
    (5, "u", None),
    (None, "u", "<p>one</p>"),
    (None, "u", "only without id"),
    (6, "u", "x" * 200_000),
    (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    *[(100 + i, f"http://h/{i}", f"page {i} " * i) for i in range(60)],
    *[(900 + i, "c", "copied") for i in range(20)],
]


def wanted_records(least):
    best = {}
    for i, _, html in PAGES:
        payload = (html or "").encode()
        best[payload] = max(best.get(payload, -1), -1 if i is None else i)
    for i, _, html in PAGES:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        keep = best[payload]
        revisit = len(payload) >= least and keep >= 0 and i != keep
        yield (
            f"<urn:page:{'' if i is None else i}>",
            "revisit" if revisit else "response",
            f"<urn:page:{keep}>" if revisit else None,
            len(payload),
            digest,
            None if revisit else payload,
        )


@pytest.mark.parametrize("split,least", [(1 << 25, 0), (37, 0), (1000, 7)])
def test_warc_round_trip(spark, tmp_path, split, least):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    pages = pages.selectExpr("*", "1 as digest", "2 as payload").repartition(3)
    files = warc.write_warc(pages, f"file://{tmp_path}/w", least_bytes=least)
    assert files == warc.list_warc(f"file://{tmp_path}/w")
    rows = warc.read_warc(spark, files, split).collect()
    found = Counter(
        (r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload) if r.payload is None or len(r.payload) else b"")
        for r in rows
    )
    assert found == Counter(wanted_records(least))
    assert all(r.intact for r in rows)
    assert len({(r.file, r.offset) for r in rows}) == len(PAGES)


@pytest.mark.parametrize("split", [1 << 25, 5000])
def test_long_heads(spark, tmp_path, split):
    rng = random.Random(3)
    urls = ["http://h/" + "".join(rng.choices("abcdefghij", k=150_000)), " " * 40_000, "u" * 2_500_000, "u"]
    rows = [(i, url, f"page {i}") for i, url in enumerate(urls)] + [(9, urls[0], "page 0")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    files = warc.write_warc(pages, f"{tmp_path}/w")
    found = {(r.record_id, r.url, r.record_type, r.intact) for r in warc.read_warc(spark, files, split).collect()}
    assert found == {
        (f"<urn:page:{i}>", url.replace(" ", "%20"), "revisit" if i == 0 else "response", True) for i, url, _ in rows
    }


def test_record_without_head(tmp_path):
    data = warc._member(b"WARC/1.1\r\nWARC-Type: response\r\n" + b"x" * 99)
    (tmp_path / "bad.warc.gz").write_bytes(data)
    with pytest.raises(ValueError):
        list(warc.records_in(str(tmp_path / "bad.warc.gz"), len(data), 0, 10))


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    files = warc.write_warc(pages, str(tmp_path / "none"))
    assert files == [] and warc.list_warc(str(tmp_path / "none")) == []
    assert warc.read_warc(spark, files).count() == 0


def test_cut_record(spark, tmp_path):
    data = warc._member(warc._record(1, "u", b"abc" * 999, None))
    (tmp_path / "cut.warc.gz").write_bytes(data[:-20])
    with pytest.raises(ValueError):
        list(warc.records_in(str(tmp_path / "cut.warc.gz"), len(data) - 20, 0, 10))


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_url_rules(spark):
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "A.Com", "net", "xcom", "com:80", "", "É.com"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/fr/?q=/en/", "#/en/", "?x", "/en/#f", "//"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "nothing", "a://b://com/en/", "http://a.com/\nx"]
    pages = [(i, u) for i, u in enumerate(urls * 2)]
    rules = [("com", "/", "allow"), ("a.com", "/en", "block"), ("b.a.com", "/en/", "allow"), ("COM", "/en/x", "block")]
    rules += [("net", "", "block"), ("net", "/", "allow"), ("net", "/", "block")]
    rules += [(f"h{i}.org", f"/p{i}", rng.choice(["allow", "block"])) for i in range(500)]
    given = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], RULES)
    df = spark.createDataFrame(pages, "page_id bigint, url string").selectExpr("*", "1 as host", "2 as rule")
    found = Counter(tuple(r) for r in judge_urls(df, given).collect())
    wanted = Counter()
    for i, url in pages:
        host, path = split_url(url)
        fits = [
            (len(h) + len(p), len(h), h.lower() + p, action)
            for h, p, action in rules
            if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
        ]
        best = max(fits, default=(0, 0, None, "allow"))
        wanted[i, host, path, best[2], best[3]] += 1
    assert found == wanted
    assert judge_urls(df.limit(0), given).count() == 0
    assert {r.verdict for r in judge_urls(df, given.limit(0)).collect()} == {"allow"}


def test_bpe_like_its_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = str(public.path("word_bpe_49k.json"))
    library = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(4)
    pool = "abcdeé'stLlVvDm ñßüİΣς ﬁ́中文😀\x1c\x85 123٣<|>endoftext.!?-_\n\t"
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 80))) for _ in range(600)]
    texts += [" ".join("".join(rng.choices("etaoinshr", k=rng.randint(1, 30))) for _ in range(9)) for _ in range(200)]
    texts += [None, "", "  ", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "a" * 5000, "ab" * 4000, "it's we'll"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(4)
    ids = bpe.encode(F.col("text"), path)
    rows = df.select("id", "text", ids.alias("ids")).select(
        "*", bpe.decode(F.col("ids"), path).alias("back"), bpe.digest(F.col("text"), path).alias("told")
    ).collect()
    assert len(rows) == len(texts)
    for r in rows:
        wanted = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(wanted, skip_special_tokens=False)
        assert r.ids == wanted and r.back == back
        digest = hashlib.sha256(" ".join(map(str, wanted)).encode()).hexdigest()
        assert tuple(r.told) == (len(wanted), digest, hashlib.sha256(back.encode()).hexdigest())
