"""The pipeline's stages: columns, what goes and what stays."""

import corpus_pipeline
from tests.llm.test_dedup import brute_jaccard, brute_lines

ROOT = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    ids = {r.doc_id for r in before}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, ROOT).write.parquet(str(tmp_path / name))
        given, docs = docs.collect(), spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        rows = docs.collect()
        assert {r.doc_id for r in rows} <= ids and len({r.doc_id for r in rows}) == len(rows)
        rows_in = [(r.doc_id, r.text, r.lang, r.source) for r in given]
        if name == "toxicity":
            assert 0 < len(given) - len(rows) < 0.15 * len(given)
            assert set(rows) <= set(given)
        if name == "line_dedup":
            assert {(r.doc_id, r.text) for r in rows} == {x[:2] for x in brute_lines(rows_in, 0.1, 5)}
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "jaccard_join":
            stays = {i for i, _, least, _ in brute_jaccard(rows_in, 5, 80) if i == least}
            assert {r.doc_id for r in rows} == stays and len(rows) < len(given)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert sum(r.n_words for r in packed) == sum(len(r.text.encode().split()) for r in docs.collect())


def test_one_row_of_each_group_with_odd_ids(spark):
    one, two, three, four = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [
        (1, one), (1, two), (1, two), (2, one + " more"), (3, two),  # an id with two texts, both kept
        (None, three), (None, three), (None, three + " more"), (None, one),  # copies without ids
        (5, four), (6, four), (6, one),
        (7, ""), (8, None), (8, None), (None, " "), (None, " "),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, ROOT).collect()), key=str)
    threes = [r for r in kept if r[1] in (three, three + " more")]
    assert len(threes) == 1 and threes[0][0] is None
    rest = [(1, one), (1, two), (5, four), (7, ""), (8, None), (None, " "), (None, " ")]
    assert sorted((r for r in kept if r not in threes), key=str) == sorted(rest, key=str)


def test_run(spark):
    assert corpus_pipeline.run(spark, ROOT).count() > 0
    assert len(corpus_pipeline.STAGES) == 4
