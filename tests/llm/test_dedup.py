"""Exact dedup, line dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from logframe.llm import jaccard_join
from logframe.llm.components import components
from logframe.llm.exact_dedup import exact_dedup
from logframe.llm.jaccard_join import class_keys, jaccard_components
from logframe.llm.line_dedup import line_dedup
from logframe.llm.shared import CLEANUP, checkpointed, written
from tests.llm.fixtures import SCHEMA, tricky

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_exact_dedup(spark):
    rows = tricky()
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[(text or "").translate(LOW)].append(i)
    wanted = Counter()
    for low, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            kept = i == keep if len(ids) > 1 else True
            wanted[(i, keep, len(ids), kept, hashlib.sha256(low.encode()).hexdigest())] += 1
    found = Counter(tuple(r) for r in exact_dedup(frame(spark, rows), digests=True).collect())
    assert found == wanted
    bare = exact_dedup(frame(spark, rows))
    assert Counter(r[:4] for r in bare.collect()) == Counter(r[:4] for r in wanted.elements())
    assert exact_dedup(frame(spark, [])).count() == 0


def brute_lines(rows, ratio, least):
    bare = lambda line: line.strip(" \t\n\x0b\x0c\r")
    pages, have = Counter(), Counter()
    for _, text, _, source, *_ in rows:
        host = source or ""
        pages[host] += 1
        for line in {bare(x) for x in (text or "").split("\n")} - {""}:
            have[host, line] += 1
    bad = {k for k, n in have.items() if n >= least and n > ratio * pages[k[0]]}
    for i, text, _, source, *_ in rows:
        lines = [] if text is None else text.split("\n")
        stays = [x for x in lines if (source or "", bare(x)) not in bad]
        yield i, None if text is None else "\n".join(stays), len(lines), len(lines) - len(stays)


@pytest.mark.parametrize("broadcast", [True, False])
def test_line_dedup(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("logframe.llm.line_dedup.BROADCAST_LINES", -1)
    rows = tricky()
    for k in range(40):
        lines = [f"own {k}", "  menu | home\t", "", "menu | home" if k % 3 else "other", f"own {k}"]
        rows.append((9000 + k, "\n".join(lines), "en", "a" if k % 2 else None, None, "h", "x"))
    found = line_dedup(frame(spark, rows), ratio=0.2, min_pages=4)
    assert {"lang", "source", "n_chars", "host", "site"} <= set(found.columns)
    found = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect())
    assert found == Counter(brute_lines(rows, 0.2, 4))
    assert any(n for *_, n in found)
    assert line_dedup(frame(spark, [])).count() == 0


def brute_jaccard(rows, k, percent):
    sets = []
    for i, text, *_ in rows:
        w = (text or "").translate(LOW)
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        runs = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        sets.append((i, frozenset(runs)))
    distinct = {s for _, s in sets if s}
    near = {s: {s} for s in distinct}
    for a in distinct:
        for b in distinct:
            if a != b and 100 * len(a & b) >= percent * len(a | b):
                near[a].add(b)
    for i, s in sets:
        if not s:
            yield i, 0, i, 0
            continue
        reach, todo = {s}, [s]
        while todo:
            for b in near[todo.pop()] - reach:
                reach.add(b)
                todo.append(b)
        least = min((j for j, other in sets if other in reach and j is not None), default=None)
        yield i, len(s), least, len(near[s]) - 1


@pytest.mark.parametrize("k,percent,cap", [(3, 90, 256), (2, 70, 3)])
def test_jaccard_join(spark, k, percent, cap):
    rows = tricky()
    found = jaccard_components(frame(spark, rows), words=k, percent=percent, region_sets=cap)
    found = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found.collect())
    assert found == Counter(brute_jaccard(rows, k, percent))
    assert any(n for *_, n in found)


def test_jaccard_join_of_nothing(spark):
    assert jaccard_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_linking_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    linked = 0
    for _ in range(600):
        n = int(rng.integers(1, 200))
        one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        most = max(1, int(len(one) * (100 - percent) / 60))
        other = one[rng.permutation(len(one))[: max(1, len(one) - int(rng.integers(0, most + 1)))]]
        new = rng.integers(0, 1 << 63, int(rng.integers(0, most + 1)), dtype=np.uint64)
        other = np.unique(np.concatenate([other, new]))
        both = len(np.intersect1d(one, other))
        if set(one) != set(other) and 100 * both >= percent * (len(one) + len(other) - both):
            linked += 1
            assert len(np.intersect1d(class_keys(one, percent), class_keys(other, percent)))
    assert linked > 50


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2), (500, 450)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "one bigint, other bigint")).collect()}
    wanted = {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)} | {500: 450, 450: 450}
    assert found == wanted


@pytest.mark.parametrize("k,percent", [(2, 80), (3, 60)])
def test_a_shared_passage_chains_nothing(spark, k, percent):
    """Documents with one of few passages, and near copies among them, in regions that have to be divided."""
    rng = random.Random(k)
    passages = [[f"p{n}-{i}" for i in range(12)] for n in range(3)]
    rows = []
    for n in range(220):
        own = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(8, 30))]
        if n % 3 == 0:
            at = rng.randrange(len(own))
            own[at:at] = passages[n % 9 // 3]
        rows.append((n, " ".join(own)))
        if n % 7 == 0:
            near = list(own)
            near[rng.randrange(len(near))] = "other"
            rows.append((1000 + n, " ".join(near)))
    rows += [(2000 + n, " ".join(passages[0] + [f"t{n}"])) for n in range(40)]  # hardly more than the passage
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard_components(docs, words=k, percent=percent, region_sets=6)
    found = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found.collect())
    assert found == Counter(brute_jaccard(rows, k, percent))
    assert max(n for *_, n in found) > 20


def test_rare_shingles_are_counted_over_all_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COUNTED", 10, raising=False)
    seen, rare = [], jaccard_join._rare_shingles

    def spy(words, percent, held):
        seen.append(held.value)
        return rare(words, percent, held)

    monkeypatch.setattr(jaccard_join, "_rare_shingles", spy)
    rows = [("r", f"n{i}", True, 18, " ".join(f"w{i % 7}x{j}" for j in range(20))) for i in range(50)]
    members = spark.createDataFrame(rows, "region string, node string, home boolean, n_shingles bigint, text string")
    regions = jaccard_join._by_rare_shingles(members, 3, 80).select("region", "node").collect()
    assert seen[0].sum() == 50 * 18 and sorted(set(seen[0][seen[0] > 0])) == [7, 8]
    groups = defaultdict(set)
    for region, node in regions:
        groups[region].add(int(node[1:]) % 7)
    assert sorted(groups.values(), key=min) == [{i} for i in range(7)]


def test_blocks_send_texts_few_times_and_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 7, raising=False)
    rng = random.Random(5)
    rows, sets = [], []
    for n in range(90):
        own = [f"w{n // 6}x{i}" for i in range(10 + n // 4)]
        own[rng.randrange(len(own))] = f"o{n}"
        sets.append({" ".join(own[i : i + 2]) for i in range(len(own) - 1)})
        rows.append(("r", f"n{n}", True, len(sets[-1]), " ".join(own)))
    kinds = "region string, node string, home boolean, n_shingles bigint, text string"
    blocks = jaccard_join._blocks(spark.createDataFrame(rows, kinds), 8, 70).cache()
    assert blocks.count() <= 90 * 3
    found = jaccard_join._compared(blocks, 2, 70, blocked=True).collect()
    degrees = Counter()
    for r in found:
        degrees[r.one] += r.links or 0
    near = lambda a, b: 100 * len(a & b) >= 70 * len(a | b)
    wanted = {f"n{i}": sum(near(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)}
    assert +degrees == +Counter(wanted) and max(wanted.values()) > 2


@pytest.mark.parametrize("keep", [checkpointed, lambda df: written(df, "kept")])
def test_kept_rows_leave_no_shuffle_files(spark, monkeypatch, keep):
    modes = []
    monkeypatch.setattr(type(spark.conf), "set", _noting(type(spark.conf).set, modes))
    before = spark.conf.get(CLEANUP, None)
    kept = keep(spark.range(100).repartition(3))
    assert kept.count() == kept.count() == 100
    assert modes[0] == (CLEANUP, "true") and spark.conf.get(CLEANUP, None) == before


def _noting(put, noted):
    return lambda conf, key, value: (noted.append((key, value)), put(conf, key, value))[1]


def test_late_shingles_join_no_sets(spark):
    # Two sets of 20, of which 3 are early: their own. What they share comes after.
    common = [f"c{i}" for i in range(16)]
    texts = [" ".join([f"{name}{i}" for i in range(3)] + ["both"] + common) for name in ("u", "v")]
    texts += [" ".join([f"d{n}x{i}" for i in range(19)] + [common[n % 16]]) for n in range(32)]
    rows = [("r", f"n{n}", True, 20, text) for n, text in enumerate(texts)]
    kinds = "region string, node string, home boolean, n_shingles bigint, text string"
    assert jaccard_join._by_rare_shingles(spark.createDataFrame(rows, kinds), 1, 80).collect() == []


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linking_sets_share_an_early_shingle(percent):
    class Held:
        value = np.zeros(jaccard_join.CELLS, np.int64)

    draw = random.Random(percent)
    texts = []
    for n in range(120):
        own = [f"w{n // 4}x{i}" for i in range(8 + n // 4)]
        for _ in range(draw.randrange(5)):
            own.pop(draw.randrange(len(own)))
        texts.append(" ".join(own))
    batch = pa.RecordBatch.from_pydict({"region": ["r"] * 120, "place": list(range(120)), "text": texts})
    found = pa.Table.from_batches(jaccard_join._rare_shingles(1, percent, Held)(iter([batch]))).to_pylist()
    early = [{r["item"] for r in found if r["place"] == i and r["early"]} for i in range(120)]
    every = [{r["item"] for r in found if r["place"] == i} for i in range(120)]
    sets, linked = [set(text.split()) for text in texts], 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and len(a) <= len(b) and 100 * len(a & b) >= percent * len(a | b):
                linked += 1
                assert early[i] & every[j]
    assert linked > 50 and sum(map(len, early)) < sum(map(len, every))


def _near_sets(rng, percent, n_groups):
    """Distinct random sets, by group: some nearly the same, some half the same, some unlike."""
    groups = []
    for _ in range(n_groups):
        base = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64))
        own = []
        for _ in range(int(rng.integers(2, 60))):
            change = len(base) * (100 - percent) / 100 * rng.choice([0.1, 0.5, 1.0, 4.0])
            stays = base[rng.permutation(len(base))[: max(1, len(base) - int(change))]]
            own.append(np.unique(np.concatenate([stays, rng.integers(0, 1 << 63, int(change / 2), dtype=np.uint64)])))
        groups.append(own)
    return groups


def _links(a, b, percent):
    both = len(np.intersect1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


@pytest.mark.parametrize("percent,most", [(50, 1 << 16), (80, 1 << 16), (90, 30)])
def test_sketches_connect_what_links(monkeypatch, percent, most):
    monkeypatch.setattr(jaccard_join, "GROUP_SETS", most)
    rows, groups = [], _near_sets(np.random.default_rng(percent), percent, 40)
    for g, own in enumerate(groups):
        sets = sorted(own, key=len)
        rows += [(g * 7 - 90, g * 100 + i, len(x), jaccard_join.sketch(x)) for i, x in enumerate(sets)]
        groups[g] = sets
    kinds = [("group", pa.int64()), ("set_a", pa.int64()), ("n_shingles", pa.int64()), ("sketch", pa.binary())]
    table = pa.table([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])
    found = pa.Table.from_batches(jaccard_join._close_pairs(percent)(iter(table.to_batches(max_chunksize=23))))
    root = {n: n for n in range(100 * len(groups))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found.to_pylist():
        assert r["one"] // 100 == r["other"] // 100
        root[find(r["one"])] = find(r["other"])
    linked = 0
    for g, sets in enumerate(groups):
        for i, a in enumerate(sets):
            for j in range(i):
                if _links(a, sets[j], percent):
                    linked += 1
                    assert find(g * 100 + i) == find(g * 100 + j)
    assert linked > 100 and len({find(g * 100 + i) for g, x in enumerate(groups) for i in range(len(x))}) > len(groups)


def test_sets_that_agree_by_chance_are_no_region(spark, monkeypatch):
    """Half of each text is a passage that all have: class keys agree by chance, but nothing may link."""
    seen, links = [], jaccard_join.region_links

    def spy(members, words, percent, region_sets):
        seen.append(members.count())
        return links(members, words, percent, region_sets)

    monkeypatch.setattr(jaccard_join, "region_links", spy)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = [(n, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(40)])) for n in range(400)]
    rows += [(1000, rows[0][1] + " more"), (1001, rows[0][1] + " other")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard_components(docs, words=2, percent=80).collect()
    found = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found)
    assert found == Counter(brute_jaccard(rows, 2, 80))
    assert seen == [3]
