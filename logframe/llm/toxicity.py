"""Toxicity: a convolutional classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.llm.shared import unused
from logframe.llm.words import mix, text_slices, word_hashes

# Words that are convolved at once.
BLOCK_WORDS = 1 << 15

# Answers are binned for calibrating: bins in 1, and the greatest answer told apart.
BINS = 1024
FURTHEST = 60

# Lengths in bytes of the beginnings of words that have embeddings of their own.
PREFIXES = (4, 6)


@dataclass
class Settings:
    """The size of the network, and the bounds of the sample that it learns from."""

    buckets: int = 1 << 18
    size: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    epochs: int = 6
    batch: int = 32
    rate: float = 0.05
    seed: int = 7
    # Words and beginnings of words of fewer sampled texts have the embedding 0.
    least_texts: int = 3
    # Labelled rows taken at most for fitting, of each class.
    fit_toxic: int = 1500
    fit_clean: int = 2500
    # A language with fewer toxic rows to calibrate on has the common threshold.
    language_rows: int = 20


@dataclass
class Network:
    """Embeddings of a word and its beginnings, summed; filters of several widths; the greatest answers.

    A word's 32-bit hash and its beginnings' have a bucket each, by their low
    bits. A bucket is for the hash whose upper bits, its tag, it was trained
    with; other hashes that fall in it have the embedding 0, row 0 of ``table``.
    """

    table: np.ndarray
    tags: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def new(cls, s: Settings) -> Network:
        random = np.random.default_rng(s.seed)
        return cls(
            np.zeros((s.buckets + 1, s.size), dtype=np.float32),
            np.zeros(s.buckets, dtype=np.uint32),
            [random.normal(0, 0.3, (w, s.size, s.filters)).astype(np.float32) for w in s.widths],
            [np.zeros(s.filters, dtype=np.float32) for _ in s.widths],
            random.normal(0, 0.3, s.filters * len(s.widths)).astype(np.float32),
            0.0,
        )

    def rows_of(self, hashes: np.ndarray) -> np.ndarray:
        bucket = (hashes & np.uint32(len(self.tags) - 1)).astype(np.int64)
        return np.where(self.tags[bucket] == _tag(hashes, len(self.tags)), bucket + 1, 0)

    def embed(self, rows: np.ndarray, more: int) -> np.ndarray:
        """The words' embeddings, then ``more`` zeros."""
        x = np.zeros((len(rows) + more, self.table.shape[1]), dtype=np.float32)
        for column in rows.T:
            x[: len(rows)] += self.table[column]
        return x

    def answers(self, x: np.ndarray, left: np.ndarray, kernel: np.ndarray, bias: np.ndarray):
        """A width's answer at every word; ``left`` words of the text follow, then zeros."""
        n = len(left)
        z = x[:n] @ kernel[0] + bias
        for j in range(1, len(kernel)):
            z += (x[j : n + j] * (left >= j)[:, None]) @ kernel[j]
        return z

    def greatest(self, hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's greatest answer of every filter, at least 0, and the word that first gives it.

        Texts of any length: blocks of words are answered one after the other.
        """
        n_rows, most = len(places) - 1, max(len(k) for k in self.kernels)
        best = np.zeros((n_rows, len(self.out)), dtype=np.float32)
        at = np.zeros((n_rows, len(self.out)), dtype=np.int64)
        row = np.repeat(np.arange(n_rows), np.diff(places))
        for low in range(0, len(hashes), BLOCK_WORDS):
            high = min(low + BLOCK_WORDS, len(hashes))
            x = self.embed(self.rows_of(hashes[low : high + most - 1]), most)
            own = row[low:high]
            left = places[own + 1] - 1 - np.arange(low, high)
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            z = np.concatenate([self.answers(x, left, k, b) for k, b in zip(self.kernels, self.biases)], axis=1)
            top = np.maximum.reduceat(z, starts, axis=0)
            texts = own[starts]
            better = top > best[texts]
            if better.any():
                first = self._first(z, top, starts)
                at[texts] = np.where(better, first + low, at[texts])
                best[texts] = np.where(better, top, best[texts])
        return best, at

    @staticmethod
    def _first(z: np.ndarray, top: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each part of rows and each column the first row that holds the part's greatest value."""
        part = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(z)))
        row, column = np.nonzero(z == top[part])
        first = np.zeros(top.shape, dtype=np.int64)
        first[part[row[::-1]], column[::-1]] = row[::-1]
        return first

    def raw(self, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        return (self.greatest(hashes, places)[0] @ self.out + self.bias).astype(np.float64)

    def scores(self, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.scaled(self.raw(hashes, places))

    def scaled(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -60, 60)))


def _tag(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bits above those of the bucket, never 0: that marks a free bucket."""
    return (hashes >> np.uint32(buckets.bit_length() - 1)) + np.uint32(1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of 32-bit hashes per word, its own and those of its beginnings; each text's offset."""
    hashes, places, *heads = word_hashes(data, offsets, marks=True, prefixes=PREFIXES)
    parts = [mix(h ^ np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64))) for i, h in enumerate([hashes, *heads])]
    return np.stack(parts, axis=1).astype(np.uint32), places


def fit(network: Network, texts: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, s: Settings):
    """Adagrad on the weighted logistic loss; only the words that gave a greatest answer move."""
    random = np.random.default_rng(s.seed)
    seen, n_texts = np.unique(np.concatenate([np.unique(t) for t in texts]), return_counts=True)
    known = seen[n_texts >= s.least_texts]
    bucket = known & np.uint32(s.buckets - 1)
    network.tags[bucket] = _tag(known, s.buckets)
    table = network.table
    table[bucket.astype(np.int64) + 1] = random.normal(0, 0.1, (len(known), s.size))
    slow = {id(p): np.full_like(p, 1e-4) for p in (*network.kernels, *network.biases, network.out)}
    table_slow = np.full(len(table), 1e-4, dtype=np.float32)
    bias_slow = 1e-4

    def move(p: np.ndarray, g: np.ndarray, rate: float = s.rate) -> None:
        slow[id(p)] += g * g
        p -= rate * g / np.sqrt(slow[id(p)])

    for _ in range(s.epochs):
        order = random.permutation(len(texts))
        for low in range(0, len(order), s.batch):
            part = [i for i in order[low : low + s.batch] if len(texts[i])]
            if not part:
                continue
            hashes = np.concatenate([texts[i] for i in part])
            sizes = np.array([len(texts[i]) for i in part])
            places = np.concatenate([[0], np.cumsum(sizes)])
            pooled, chosen = network.greatest(hashes, places)
            last = (places[1:] - 1)[:, None]
            raw = pooled @ network.out + network.bias
            error = (1 / (1 + np.exp(-raw)) - toxic[part]) * weight[part] / len(part)
            back = error[:, None] * network.out[None, :] * (pooled > 0)
            moved, moves = [], []
            for i, (kernel, bias) in enumerate(zip(network.kernels, network.biases)):
                own = slice(i * s.filters, (i + 1) * s.filters)
                g = back[:, own].astype(np.float32)
                change = np.zeros_like(kernel)
                for j in range(len(kernel)):
                    inside = (chosen[:, own] + j <= last)[:, :, None]
                    at = np.minimum(chosen[:, own] + j, last).ravel()
                    seen = network.embed(network.rows_of(hashes[at]), 0).reshape(*g.shape, s.size) * inside
                    change[j] = np.einsum("bf,bfd->df", g, seen)
                    moves.append((g[:, :, None] * kernel[j].T[None] * inside).reshape(-1, s.size))
                    moved.append(network.rows_of(hashes[at]))
                move(bias, g.sum(axis=0))
                move(kernel, change)
            move(network.out, pooled.T @ error.astype(np.float32))
            bias_slow += float(error.sum()) ** 2
            network.bias -= s.rate * float(error.sum()) / bias_slow**0.5
            at = np.concatenate(moved).T
            at, g = at.ravel(), np.concatenate([np.concatenate(moves)] * len(at))
            at, g = at[at > 0], g[at > 0]
            used, index = np.unique(at, return_inverse=True)
            total = np.zeros((len(used), s.size), dtype=np.float32)
            np.add.at(total, index, g)
            table_slow[used] += (total * total).mean(axis=1)
            table[used] -= s.rate * total / np.sqrt(table_slow[used])[:, None]


def calibrate(network: Network, raw: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
    """Slope and shift that fit scores to the labels, by Newton steps on smoothed targets."""
    n1, n0 = (weight * toxic).sum(), (weight * (1 - toxic)).sum()
    if not n1 or not n0:
        return
    target = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([raw, np.ones_like(raw)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -60, 60)))
        slope = design.T @ (weight * (p - target)) + 1e-3 * (theta - [1.0, 0.0])
        curve = design.T @ (design * (weight * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta -= step
        if np.abs(step).max() < 1e-9:
            break
    network.slope, network.shift = float(max(theta[0], 1e-3)), float(theta[1])


def best_threshold(scores: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the greatest F1, in the middle of the gap that it lies in."""
    order = np.argsort(-scores)
    scores, toxic, weight = scores[order], toxic[order], weight[order]
    right = np.cumsum(weight * toxic)
    f1 = 2 * right / (np.cumsum(weight) + (weight * toxic).sum())
    f1[:-1][scores[:-1] == scores[1:]] = -1  # equal scores are on one side
    best = int(np.argmax(f1))
    below = scores[best + 1] if best + 1 < len(scores) else 0.0
    return float((scores[best] + below) / 2)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    check: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
    settings: Settings | None = None,
) -> Network:
    """A network fitted to a bounded sample of labelled documents, calibrated on all of a part.

    ``learn`` and ``check`` are conditions on the column ``doc_id`` of the labels: which rows may
    be used at all, and which of them calibrate instead of fit. The sample for
    fitting is the rows with the least hashes of their id, ``settings`` bounds it;
    of documents that repeat an id it has one. Of these rows' whole texts, whatever
    their length, the words' hashes reach the driver, 12 bytes a word. Labels other than 0 and 1, NULL ids and labels without a
    document are ignored; of repeated labels 1 wins. Without a row of each
    class to fit every score is about 0.5.

    All labelled documents that calibrate count, of any length and language:
    slope, centre and thresholds come from how many there are of each language,
    class and bin of the answer, 1 / ``BINS`` wide. They are scored where they are
    read; ids, languages and bins are joined with labels, texts are not.

    A language is never an input of a score; it has a threshold of its own.
    """
    s = settings or Settings()
    learn = F.lit(True) if learn is None else learn
    check = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0 if check is None else check
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .filter(learn)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = None
    for kind, most in ((1, s.fit_toxic), (0, s.fit_clean)):
        part = (
            known.filter(~check & (F.col("toxic") == kind))
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(most)
        )
        picked = part if picked is None else picked.unionByName(part)
    lang_column = F.coalesce(F.col(lang), F.lit("")) if lang in docs.columns else F.lit("")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), lang_column.alias("lang"))
    sample = (
        rows.join(F.broadcast(picked), "doc_id")  # at most as many ids as the bounds
        .groupBy("doc_id", "toxic")
        .agg(F.max(F.struct(F.xxhash64("text"), "text")).alias("row"))
        .select("toxic", F.xxhash64("doc_id").alias("place"), "row.text")
        .mapInArrow(_hashed, "toxic int, place bigint, words array<int>")
        .toArrow()
    )
    sample = sample.sort_by("place")
    network = Network.new(s)
    lists = sample.column("words").combine_chunks()
    flat = lists.flatten().to_numpy().view(np.uint32).reshape(-1, 1 + len(PREFIXES))
    sizes = lists.value_lengths().to_numpy() // (1 + len(PREFIXES))
    words = np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []
    toxic = sample.column("toxic").to_numpy().astype(np.float64)
    if len(set(toxic)) < 2:
        network.out[:] = 0
        return network
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    fair = np.where(toxic == 1, max(1.0, 0.5 * n0 / n1), 1.0)
    fit(network, words, toxic, fair, s)
    del sample, lists, flat, words  # the driver keeps nothing of them, nor the memory
    pa.default_memory_pool().release_unused()

    all_rows, own_rows = _binned(rows.filter(learn & check), known.filter(check), network, s.language_rows)
    raw, held, count = all_rows
    if len(raw):
        calibrate(network, raw, held, count)
        if 0 < held.sum() < len(held):
            # Scores of one half are where the two classes are told apart best.
            cut = min(max(best_threshold(network.scaled(raw), held, count), 0.02), 0.98)
            network.shift -= float(np.log(cut / (1 - cut)))
    for name, (raw, held, count) in sorted(own_rows.items()):
        network.thresholds[name] = best_threshold(network.scaled(raw), held, count)
    return network


Bins = tuple[np.ndarray, np.ndarray, np.ndarray]


def _binned(rows: DataFrame, known: DataFrame, network: Network, least: int) -> tuple[Bins, dict[str, Bins]]:
    """Answers, classes and how many labelled rows have them: of all, and of each language with
    ``least`` rows of each class."""
    held = rows.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("bigint")
    def bin_of(column: pa.Array) -> pa.Array:
        parts = [held.value.raw(*features(data, offsets)) for _, _, data, offsets in text_slices(column)]
        raw = np.concatenate(parts) if parts else np.zeros(0)
        return pa.array(np.rint(np.clip(raw, -FURTHEST, FURTHEST) * BINS).astype(np.int64))

    # Counted before the join, so that an id on many rows is a row for each language and bin.
    bins = (
        rows.select("doc_id", "lang", bin_of("text").alias("bin"))
        .groupBy("doc_id", "lang", "bin")
        .count()
        .join(known, "doc_id")
        .groupBy("lang", "toxic", "bin")
        .agg(F.sum("count").alias("n"))
    )
    found = bins.select("lang", F.col("toxic").cast("int"), "bin", "n").toArrow()
    held.destroy()
    whole = found.group_by(["toxic", "bin"]).aggregate([("n", "sum")]).rename_columns(["toxic", "bin", "n"])
    languages = {}
    for name in found.column("lang").unique().to_pylist():
        own = _arrays(found.filter(pc.equal(found.column("lang"), name)))
        if min((own[1] * own[2]).sum(), ((1 - own[1]) * own[2]).sum()) >= least:
            languages[name] = own
    return _arrays(whole), languages


def _arrays(found: pa.Table) -> Bins:
    found = found.sort_by([("toxic", "ascending"), ("bin", "ascending")])
    columns = [found.column(c).to_numpy().astype(np.float64) for c in ("bin", "toxic", "n")]
    return columns[0] / BINS, columns[1], columns[2]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_slices(batch.column("text")):
            hashes, places = features(data, offsets)
            part = batch.slice(low, high - low)
            words = [hashes[a:b].ravel().view(np.int32) for a, b in zip(places[:-1], places[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("toxic").cast(pa.int32()),
                    part.column("place"),
                    pa.array(words, pa.list_(pa.int32())),
                ],
                ["toxic", "place", "words"],
            )


def score(docs: DataFrame, network: Network, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents with ``score``, ``threshold`` (their language's) and ``toxic`` (score at or above it).

    Whole texts are scored, of any length; NULL and empty ones too, from no
    words at all. Columns of these three names are replaced, others kept. A
    language without a threshold of its own, and a NULL one, has 0.5.
    Each document is scored in the task that reads it; nothing is shuffled.
    """
    held = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("double")
    def scorer(column: pa.Array) -> pa.Array:
        parts = [
            held.value.scores(*features(data, offsets))
            for _, _, data, offsets in text_slices(column)
        ]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    threshold = F.lit(0.5)
    if lang in docs.columns:
        for name, value in sorted(network.thresholds.items()):
            threshold = F.when(F.col(lang) == name, F.lit(value)).otherwise(threshold)
    (own,) = unused(docs, "own_score")
    added = {
        "score": F.col(own),
        "threshold": threshold,
        "toxic": F.col(own) >= threshold,
    }
    return docs.withColumn(own, scorer(F.col(text))).select(
        *[F.col(name) for name in docs.columns if name not in added],
        *[column.alias(name) for name, column in added.items()],
    )
