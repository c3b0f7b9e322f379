"""A modified Kneser-Ney model of runs of words, counted by Spark, kept in packed sorted arrays on disk."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logframe.llm.shared import new_folder, tidy
from logframe.llm.warc import place
from logframe.llm.words import mix, text_slices, word_hashes

# The hash that stands for the end of a text, and an odd number that spreads
# the keys of runs over the shards; multiplying by its inverse undoes it.
END = mix(np.array([0x5EED], dtype=np.uint64))[0]
SPREAD = 0x9E3779B97F4A7C15
GATHER = pow(SPREAD, -1, 1 << 64)

# Runs whose followers and forerunners are counted together in one task.
PAIRS_PER_TASK = 1_000_000

# Tokens whose runs are counted together before the shuffle.
COUNTED_TOKENS = 2_500_000

# Bytes of a batch that goes back to Spark, which holds it whole beside its heap.
BATCH_BYTES = 1 << 21

# A file has at most so many rows, about, where there are more than LEAST_BITS allows,
# and so many are added up at a time.
SHARD_ROWS = 1 << 22
RANGE_ROWS = 1 << 19
LEAST_BITS = 6

# Keys in a bucket of a shard, about: their upper bits are stored once for all.
BUCKET_KEYS = 2

# Shuffled rows: the counted keys of one range, from one part of the texts.
PACKED = "shard bigint, place bigint, n bigint, data binary"


class Part:
    """The rows of a table in one file, mapped into memory.

    Keys are in order. Of a key the file has only the lowest bits, in 1, 2, 4 or 8 bytes:
    those of the shard are known, and the next ones say in which bucket it is.
    The file holds for each column the rows and values of the large ones, then, unless
    there is a row for every key, where buckets begin and the keys' lowest bits,
    and the columns.
    """

    def __init__(self, table: Table, shard: int):
        path, self.n, bucket_bits, large = table.files[shard]
        self.dense = table.dense
        self.low_bits = table.width - table.bits - bucket_bits
        self.first = np.uint64(shard << (table.width - table.bits))
        data = np.asarray(np.memmap(local(path), np.uint8, "r"))
        place, self.large, self.columns = 0, {}, {}

        def section(size: int) -> np.ndarray:
            nonlocal place
            place += size
            return data[place - size : place]

        for name, count in zip(table.columns, large):
            self.large[name] = section(8 * count).view("<i8"), section(8 * count).view("<i8")
        if not table.dense:
            self.at = section(4 * ((1 << bucket_bits) + 1)).view("<u4")
            kind = _rest_kind(self.low_bits)
            self.rest = section(self.n * kind.itemsize).view(kind)
        for name in table.columns:
            self.columns[name] = section(self.n * np.dtype(table.kind).itemsize).view(table.kind)
        self.most = table.large

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """The rows of keys, -1 where absent."""
        if self.dense:
            rows = (keys - self.first).astype(np.int64)
            return np.where(rows < self.n, rows, -1)
        bucket = ((keys >> np.uint64(self.low_bits)) & np.uint64(len(self.at) - 2)).astype(np.int64)
        rest = (keys & np.uint64((1 << self.low_bits) - 1)).astype(self.rest.dtype)
        low, end = self.at[bucket].astype(np.int64), self.at[bucket + 1].astype(np.int64)
        rows = np.full(len(keys), -1, dtype=np.int64)
        left = np.flatnonzero(low < end)
        while len(left):
            held, own = self.rest[low[left]], rest[left]
            found = left[held == own]
            rows[found] = low[found]
            left = left[held < own]
            low[left] += 1
            left = left[low[left] < end[left]]
        return rows

    def keys_at(self, rows: np.ndarray) -> np.ndarray:
        bucket = np.searchsorted(self.at, rows.astype(np.uint32), side="right") - 1
        return self.first | (bucket.astype(np.uint64) << np.uint64(self.low_bits)) | self.rest[rows].astype(np.uint64)

    def values(self, name: str, rows: np.ndarray) -> np.ndarray:
        out = self.columns[name][rows].astype(np.int64)
        large = np.flatnonzero(out == self.most)
        if len(large):
            places, values = self.large[name]
            out[large] = values[np.searchsorted(places, rows[large])]
        return out


def _bytes(bits: int) -> int:
    return -(-bits // 8)


def _rest_kind(bits: int) -> np.dtype:
    return np.dtype(next(f"<u{size}" for size in (1, 2, 4, 8) if bits <= 8 * size))


@dataclass
class Table:
    """Numbers by key, in files of consecutive ranges of keys of ``width`` bits, one for each value of the upper ``bits``.

    A file is its path, its rows, the bits that tell its buckets and how many large values each column has.
    Rows are added up in ranges of keys, by ``range_bits`` more. A dense table has rows of zeros for
    keys that are absent. Values are of ``kind``, whose greatest says that the value is in the list of large ones.
    """

    bits: int
    range_bits: int
    width: int
    columns: list[str]
    kind: str = "<u1"
    dense: bool = False
    files: dict[int, tuple[str, int, int, list[int]]] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: int, most: int, columns: list[str], **more) -> Table:
        """A table of at most ``rows`` rows, with keys of up to ``most``."""
        bits = max(LEAST_BITS, math.ceil(math.log2(max(1, rows / SHARD_ROWS))))
        range_bits = max(0, math.ceil(math.log2(max(1, rows / RANGE_ROWS))) - bits)
        return cls(bits, range_bits, max(bits + range_bits, most.bit_length()), columns, **more)

    @property
    def large(self) -> int:
        return int(np.iinfo(self.kind).max)

    @property
    def rows(self) -> int:
        return sum(file[1] for file in self.files.values())

    @cached_property
    def starts(self) -> dict[int, int]:
        """The rows before each shard."""
        total, starts = 0, {}
        for shard in sorted(self.files):
            starts[shard] = total
            total += self.files[shard][1]
        return starts

    def part(self, shard: int) -> Part:
        held = self.__dict__.setdefault("_maps", {})
        if shard not in held:
            held[shard] = Part(self, shard)
        return held[shard]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_maps"}

    def find(self, keys: np.ndarray, *names: str) -> list[np.ndarray]:
        """For keys the values of columns, 0 where absent; "row" stands for the rows, -1 where absent."""
        shards = (keys >> np.uint64(self.width - self.bits)).astype(np.uint16 if self.bits <= 16 else np.int64)
        order = np.argsort(shards, kind="stable")  # of short numbers: in linear time
        shards, keys = shards[order], keys[order]
        held = [np.full(len(keys), -1 if name == "row" else 0, dtype=np.int64) for name in names]
        for shard, low, high in _runs(shards):
            if shard in self.files:
                part = self.part(shard)
                rows = part.rows_of(keys[low:high])
                there = slice(None)
                if len(rows) and rows.min() < 0:
                    there = np.flatnonzero(rows >= 0)
                    rows = rows[there]
                for name, values in zip(names, held):
                    values[low:high][there] = rows + self.starts[shard] if name == "row" else part.values(name, rows)
        out = []
        for values in held:
            back = np.empty_like(values)
            back[order] = values
            out.append(back)
        return out

    def keys_at(self, rows: np.ndarray) -> np.ndarray:
        """The keys of rows in ascending order."""
        shards = sorted(self.files)
        edges = np.searchsorted(rows, [*[self.starts[x] for x in shards], self.rows])
        out = np.zeros(len(rows), dtype=np.uint64)
        for shard, low, high in zip(shards, edges[:-1], edges[1:]):
            if high > low:
                out[low:high] = self.part(shard).keys_at(rows[low:high] - self.starts[shard])
        return out


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value of a sorted array, and where its run begins and ends."""
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1), len(values)] if len(values) else []
    for low, high in zip(edges[:-1], edges[1:]):
        yield int(values[low]), int(low), int(high)


def local(path: str) -> str:
    """A file's path for mapping into memory: itself if it is in a mounted file system, else a copy.

    Copies are in a temporary folder of the process and go with it.
    """
    system, name = place(path)
    if isinstance(system, fs.LocalFileSystem):
        return name
    folder = _copies()
    copy = f"{folder}/{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    if not Path(copy).exists():
        fs.copy_files(name, f"{copy}.part", source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
        Path(f"{copy}.part").rename(copy)
    return copy


_FOLDER: list[tempfile.TemporaryDirectory] = []


def _copies() -> str:
    if not _FOLDER:
        _FOLDER.append(tempfile.TemporaryDirectory(prefix="logframe-model-"))
    return _FOLDER[0].name


def _pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of equal length, the first one sorted: its differences, and all numbers byte by byte, compressed.

    First come the bytes that a number of each array takes.
    """
    head, planes = [], []
    for i, column in enumerate(columns):
        if i == 0:
            column = np.diff(column, prepend=column.dtype.type(0))
        size = _bytes(int(column.max()).bit_length())
        head.append(size)
        planes.append(np.ascontiguousarray(column, "<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes())
    return bytes(head) + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, columns: int) -> np.ndarray:
    sizes, held = data[:columns], np.zeros((columns, n, 8), np.uint8)
    planes = np.frombuffer(pa.decompress(data[columns:], n * sum(sizes), codec="zstd"), np.uint8).reshape(-1, n)
    low = 0
    for column, size in zip(held, sizes):
        column[:, :size] = planes[low : low + size].T
        low += size
    held = held.view("<u8")[..., 0]
    held[0] = np.cumsum(held[0], dtype=np.uint64)
    return held


def _packed(table: Table, keys: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows for ``_write_table`` of sorted distinct keys and their columns: one for each range of keys."""
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["shard", "place", "n", "data"]
        )

    for place, low, high in _runs(keys >> np.uint64(table.width - table.bits - table.range_bits)):
        data = _pack([keys[low:high], *[c[low:high] for c in columns]])
        rows.append((place >> table.range_bits, place, high - low, data))
        size += len(data) + 32
        if size >= BATCH_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def _write_table(rows: DataFrame, folder: str, name: str, table: Table, census: str) -> dict[str, int]:
    """Adds up packed rows by key and writes them in order into the table's files: the census.

    Rows are dealt by the key's upper bits and sorted by range, so a task adds up
    one range at a time and holds the packed rows of one file. A key's rows are
    at most one per part that counted it. Files are named by attempt and reported
    when done, so what a lost task wrote is never read. The shuffle's files go
    when the table is there. The census is the sum of column ``census`` and how
    often it is 1, 2, 3 and 4.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with tidy(rows.sparkSession):
        done = (
            rows.repartition(parts, "shard")
            .sortWithinPartitions("place")
            .mapInArrow(
                _merge(folder, name, table, census),
                "shard bigint, path string, n bigint, bucket_bits bigint, large array<bigint>, "
                "total bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint",
            )
            .collect()
        )
    table.files = {row["shard"]: (row["path"], row["n"], row["bucket_bits"], row["large"]) for row in done}
    return {k: sum(row[k] for row in done) for k in ("total", "n1", "n2", "n3", "n4")}


class _Writer:
    """What is to be in one file."""

    def __init__(self, table: Table, first_range: int):
        self.table, self.n, self.counted = table, 0, np.zeros(5, np.int64)
        # As if every range had as many keys; no result depends on it.
        most = max(0, math.ceil(math.log2((first_range << table.range_bits) / BUCKET_KEYS)))
        self.bucket_bits = min(most, table.width - table.bits)
        self.low_bits = table.width - table.bits - self.bucket_bits
        self.buckets = np.zeros(1 << self.bucket_bits, np.int64)
        self.rest: list[bytes] = []
        self.columns: dict[str, list[bytes]] = {c: [] for c in table.columns}
        self.large: dict[str, list[np.ndarray]] = {c: [] for c in table.columns}

    def add(self, keys: np.ndarray, values: list[np.ndarray], census: str) -> None:
        if self.table.dense:
            rows = (keys & np.uint64((1 << (self.table.width - self.table.bits)) - 1)).astype(np.int64) - self.n
            held = np.zeros((len(values), int(rows[-1]) + 1), np.int64)
            held[:, rows] = values
            keys, values = np.arange(held.shape[1], dtype=np.uint64), list(held)
        else:
            self._add_keys(keys)
        for name, column in zip(self.table.columns, values):
            self.columns[name].append(np.minimum(column, self.table.large).astype(self.table.kind).tobytes())
            large = np.flatnonzero(column >= self.table.large)
            self.large[name].append(np.array([large + self.n, column[large]], dtype="<i8"))
            if name == census:
                self.counted += [int(column.sum()), *[int((column == i).sum()) for i in (1, 2, 3, 4)]]
        self.n += len(keys)
        if self.n >= 1 << 32:
            raise ValueError("a file has at most 2**32 - 1 rows")

    def _add_keys(self, keys: np.ndarray) -> None:
        bucket = ((keys >> np.uint64(self.low_bits)) & np.uint64(len(self.buckets) - 1)).astype(np.int64)
        counts = np.bincount(bucket - bucket[0])
        self.buckets[bucket[0] : bucket[0] + len(counts)] += counts
        rest = keys & np.uint64((1 << self.low_bits) - 1)
        self.rest.append(rest.astype(_rest_kind(self.low_bits)).tobytes())

    def write(self, system: fs.FileSystem, path: str) -> list[int]:
        large = [np.concatenate(self.large[c], axis=1) for c in self.table.columns]
        with system.open_output_stream(path, compression=None) as out:
            for rows in large:
                out.write(rows.tobytes())
            if not self.table.dense:
                out.write(np.concatenate([[0], np.cumsum(self.buckets)]).astype("<u4").tobytes())
            for chunks in (self.rest, *self.columns.values()):
                for chunk in chunks:
                    out.write(chunk)
        return [rows.shape[1] for rows in large]


def _merge(folder: str, name: str, table: Table, census: str):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        system.create_dir(root, recursive=True)
        shard, writer, report = None, None, []

        def close() -> None:
            file = f"{name}-{shard}-{attempt}"
            large = writer.write(system, f"{root}/{file}")
            report.append([shard, f"{folder}/{file}", writer.n, writer.bucket_bits, large, *writer.counted.tolist()])

        for own, packed in _ranges(batches):
            held = np.concatenate([_unpack(data, n, 1 + len(table.columns)) for data, n in packed], axis=1)
            held = held[:, np.argsort(held[0], kind="stable")]
            first = np.flatnonzero(np.concatenate([[True], held[0, 1:] != held[0, :-1]]))
            values = [np.add.reduceat(c.view(np.int64), first) for c in held[1:]]
            if own >> table.range_bits != shard:
                if writer is not None:
                    close()
                shard, writer = own >> table.range_bits, _Writer(table, len(first))
            writer.add(held[0, first], values, census)
        if writer is not None:
            close()
            names = ["shard", "path", "n", "bucket_bits", "large", "total", "n1", "n2", "n3", "n4"]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*report), kinds)], names)

    return merge


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[bytes, int]]]]:
    """The packed rows of one range after the other."""
    now, held = None, []
    for batch in batches:
        for own, n, data in zip(*(batch.column(c).to_pylist() for c in ("place", "n", "data"))):
            if own != now and held:
                yield now, held
                held = []
            now = own
            held.append((data, n))
    if held:
        yield now, held


def discounts(census: dict[str, int]) -> tuple[float, float, float]:
    """What is taken from counts of 1, of 2, and of 3 and more; usual values where counts are too few."""
    n1, n2, n3, n4 = (census[f"n{i}"] for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(float(min(max(d, 0.05), k - 0.05)) for k, d in ((1, d1), (2, d2), (3, d3)))


@dataclass
class Model:
    """Runs of 1, 2, ... words with their counts, and per run but the longest its followers and forerunners.

    A run's key is made of the row of the run before its last word and that word's
    row. The row after a table's last is for a run of starts alone.
    """

    folder: str
    tables: list[Table]
    tokens: int
    texts: int = 0
    # By the rows of the runs of each length: followers once, twice and more often, forerunners;
    # for shorter runs also all their followers' counts.
    ids: list[Table] = field(default_factory=list)
    discounts: list[tuple[float, float, float]] = field(default_factory=list)
    base_weight: float = 1.0

    @property
    def words(self) -> Table:
        return self.tables[0]

    def word_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of words."""
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts = self.words.find(distinct, "row", "n")
        return ids[back], counts[back]

    def run_keys(self, level: int, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Keys of runs; ``parts_of`` undoes it."""
        joined = before.astype(np.uint64) * np.uint64(self.words.rows) + ids.astype(np.uint64)
        return spread(joined, self.tables[level].width)

    def parts_of(self, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined, words = gather(keys, self.tables[level].width), np.uint64(self.words.rows)
        return (joined // words).astype(np.int64), (joined % words).astype(np.int64)

    def found(self, level: int, before: np.ndarray, ids: np.ndarray, *names: str) -> list[np.ndarray]:
        """Rows ("row", -1: unknown) and counts of runs."""
        known = np.flatnonzero((before >= 0) & (ids >= 0))
        out = []
        for name, values in zip(names, self.tables[level].find(self.run_keys(level, before[known], ids[known]), *names)):
            own = np.full(len(ids), -1 if name == "row" else 0, dtype=np.int64)
            own[known] = values
            out.append(own)
        return out

    def of_ids(self, level: int, ids: np.ndarray, *names: str) -> list[np.ndarray]:
        """Columns for rows of runs, 0 for -1."""
        known = np.flatnonzero(ids >= 0)
        out = []
        for values in self.ids[level].find(ids[known].astype(np.uint64), *names):
            own = np.zeros(len(ids), dtype=np.int64)
            own[known] = values
            out.append(own)
        return out

    def words_before(self, ids: np.ndarray, places: np.ndarray, level: int) -> np.ndarray:
        """The rows of the runs of ``level`` words before each token."""
        before = _before(ids, places, self.words.rows)
        for i in range(1, level):
            before = _before(self.found(i, before, ids, "row")[0], places, self.tables[i].rows)
        return before

    def without_first(self, level: int, rows: np.ndarray) -> np.ndarray:
        """The rows of runs without their first word."""
        distinct, back = np.unique(rows, return_inverse=True)
        before, ids = self.parts_of(level, self.tables[level].keys_at(distinct))
        out = ids if level == 1 else self.found(level - 1, self.rest_of(level - 1, before), ids, "row")[0]
        return out[back]

    def rest_of(self, level: int, rows: np.ndarray) -> np.ndarray:
        """As ``without_first``, also for the run of starts."""
        starts = rows == self.tables[level].rows
        inner = self.without_first(level, np.where(starts, 0, rows))
        return np.where(starts, self.tables[level - 1].rows, inner)

    def token_scores(self, ids: np.ndarray, counts: np.ndarray, places: np.ndarray) -> np.ndarray:
        """log10 P(word | words before) for the ids of texts' words; -1 is any unknown word."""
        uniform = 1 / (self.words.rows + 1)
        if not self.ids:
            return np.log10(np.full(len(ids), uniform))
        # Of the runs that end at each token, by length, their rows and counts, and what follows them.
        # That of the run before a token is that of the one that ends a token earlier.
        last, row, number = len(self.tables) - 1, ids, counts
        names = ["ends", "once", "twice", "more", "total"]
        count, *after = self.of_ids(0, row, *names[: 5 if last > 1 else 4])
        low = taken(count, self.discounts[0]) / self.tables[1].rows + self.base_weight * uniform
        for level in range(1, last + 1):
            start = self.tables[level - 1].rows
            starts = self.of_ids(level - 1, np.array([start]), *names[1 : 1 + len(after)])
            n1, n2, n3, *total = [_before(own, places, int(first[0])) for own, first in zip(after, starts)]
            # A run begins as many of the longest as it is there for, that of starts one per text.
            total = total[0] if level < last else _before(number, places, self.texts)
            before = _before(row, places, start)
            if level < last:
                row, number = self.found(level, before, ids, "row", "n")
                count, *after = self.of_ids(level, row, *names[: 5 if level < last - 1 else 4])
            else:
                count = self.found(level, before, ids, "n")[0]
            d1, d2, d3 = self.discounts[level]
            rest = np.where(total > 0, (d1 * n1 + d2 * n2 + d3 * n3) / np.maximum(total, 1), 1.0)
            own = np.where(total > 0, taken(count, self.discounts[level]) / np.maximum(total, 1), 0.0)
            low = own + rest * low
        return np.log10(low)


def taken(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discounts."""
    return counts - np.array([0.0, *d])[np.minimum(counts, 3)]


def spread(x: np.ndarray, width: int) -> np.ndarray:
    """A bijection of numbers of ``width`` bits that spreads them evenly; ``gather`` undoes it."""
    mask, half = np.uint64((1 << width) - 1), np.uint64((width + 1) // 2)
    x = (x * np.uint64(SPREAD)) & mask
    x ^= x >> half
    return (x * np.uint64(SPREAD)) & mask


def gather(x: np.ndarray, width: int) -> np.ndarray:
    mask, half = np.uint64((1 << width) - 1), np.uint64((width + 1) // 2)
    x = (x * np.uint64(GATHER)) & mask
    x ^= x >> half
    return (x * np.uint64(GATHER)) & mask


def tokens_of(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words, each text followed by END, and each text's offset."""
    ends = places[1:] + np.arange(len(places) - 1)
    out = np.empty(len(hashes) + len(ends), dtype=np.uint64)
    out[ends] = END
    word = np.ones(len(out), dtype=bool)
    word[ends] = False
    out[word] = hashes
    return out, np.concatenate([[0], ends + 1])


def _before(ids: np.ndarray, places: np.ndarray, start: int) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[places[:-1]] = start
    return before


def _counted(table: Table, keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
    return _packed(table, distinct, [counts])


def _count(table: Table, keys_of):
    """Counts the keys that texts have, some texts at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, size = [], 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                keys.append(keys_of(*tokens_of(*word_hashes(data, offsets))))
                size += len(keys[-1])
                if size >= COUNTED_TOKENS:
                    yield from _counted(table, keys)
                    keys, size = [], 0
        if keys:
            yield from _counted(table, keys)

    return count


def _runs_of(model: Model, level: int):
    def runs(tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
        ids, _ = model.word_ids(tokens)
        return model.run_keys(level, model.words_before(ids, places, level), ids)

    return runs


def _neighbours(model: Model, level: int):
    """Per run, from a part of the runs of a word more: those it begins, by count, and those that it ends.

    Where the longer runs are not the longest, their counts are those of their
    forerunners, and are added up too.
    """
    table, top = model.tables[level + 1], level + 2 == len(model.tables)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            begin, second = model.parts_of(level + 1, np.concatenate([k for k, _ in held]))
            counts = np.concatenate([c for _, c in held])
            if level:
                second = model.found(level, model.rest_of(level, begin), second, "row")[0]
            second, ends = np.unique(second, return_counts=True)
            # The first run and, in the lowest bits, 0 for a count of 1, 1 for 2, 2 for more.
            first, times = np.unique((begin << 2) | (np.minimum(counts, 3) - 1), return_counts=True)
            begins, kind = first >> 2, first & 3
            ids = np.sort(np.concatenate([begins, second]))
            ids = ids[np.flatnonzero(np.diff(ids, prepend=-1))]
            columns = [np.zeros(len(ids), np.int64) for _ in range(4)]
            at = np.searchsorted(ids, begins)
            for value in range(3):
                own = kind == value
                columns[value][at[own]] = times[own]
            columns[3][np.searchsorted(ids, second)] = ends
            if not top:
                total = np.bincount(np.searchsorted(ids, begin), weights=counts, minlength=len(ids))
                columns.append(total.astype(np.int64))
            return _packed(model.ids[level], ids.astype(np.uint64), columns)

        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                part, n = table.part(shard), table.files[shard][1]
                for low in range(0, n, PAIRS_PER_TASK):
                    rows = np.arange(low, min(low + PAIRS_PER_TASK, n))
                    if top:
                        counts = part.values("n", rows)
                    else:
                        counts = model.of_ids(level + 1, rows + table.starts[shard], "ends")[0]
                    held.append((part.keys_at(rows), counts))
                    size += len(rows)
                    if size >= PAIRS_PER_TASK:
                        yield from counted()
                        held, size = [], 0
        if held:
            yield from counted()

    return neighbours


def train(docs: DataFrame, text: str = "text", folder: str | None = None, order: int = 2) -> Model:
    """Counts runs of 1 to ``order`` neighbouring words of all texts and writes the model's arrays.

    A text's words are its runs without white space, A-Z lower-cased, and one
    end; before the first stand ``order`` - 1 starts. All counts cover all rows.
    Batches are counted before the shuffle, so a word or run that a third of all
    text is costs a row per batch.

    Words are numbered by the order of their hashes (of 64 bits); a longer run's
    key is made of the number of the run before its last word and of that word's,
    and is exact: a number under different runs of a length times different
    words, which must be under 2**63. Arrays lie in ``folder`` (a new one in the checkpoint folder if None), which must
    be there as long as texts are scored and is the caller's to remove. The
    driver gets one row per file. NULL and empty texts are an end. No rows make
    a model without words, for which any token is as likely.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "ngrams")
    texts = docs.select(F.col(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # How many words there are is not known yet.
    words = Table(max(LEAST_BITS, math.ceil(math.log2(2 * parts))), 0, 64, ["n"], "<u4")
    rows = texts.mapInArrow(_count(words, lambda tokens, places: tokens), PACKED)
    seen = _write_table(rows, folder, "words", words, "n")
    model = Model(folder, [words], seen["total"])
    model.texts = int(words.find(np.array([END], dtype=np.uint64), "n")[0][0])
    for level in range(1, order):
        most = (model.tables[-1].rows + 1) * words.rows
        if most > 1 << 63:
            raise ValueError(f"{model.tables[-1].rows} different runs of {words.rows} words are too many for keys")
        table = Table.of(model.tokens, most, ["n"])
        model.tables.append(table)
        rows = texts.mapInArrow(_count(table, _runs_of(model, level)), PACKED)
        seen = _write_table(rows, folder, "pairs" if level == 1 else f"runs{level + 1}", table, "n")
        if not table.rows:
            model.tables.pop()
            return model

    found = [discounts(seen)]
    names = ["once", "twice", "more", "ends", "total"]
    model.ids = [
        Table.of(table.rows, table.rows, names[:], kind="<u1" if level else "<u4", dense=True)
        for level, table in enumerate(model.tables[:-1])
    ]
    model.ids[-1].columns.pop()  # a run is the beginning of as many of the longest as it is there for
    for level in range(order - 2, -1, -1):
        table = model.tables[level + 1]
        tasks = max(1, -(-table.rows // PAIRS_PER_TASK), spark.sparkContext.defaultParallelism)
        shards = spark.createDataFrame([(s,) for s in sorted(table.files)], "shard bigint")
        rows = shards.repartition(tasks, "shard").mapInArrow(_neighbours(model, level), PACKED)
        seen = _write_table(rows, folder, f"ids{level + 1}", model.ids[level], "ends")
        found.insert(0, discounts(seen))
    model.discounts = found
    # What the discounts take from all words: each word is one of n1, n2 or more.
    d1, d2, d3 = model.discounts[0]
    more = words.rows - seen["n1"] - seen["n2"]
    model.base_weight = (d1 * seen["n1"] + d2 * seen["n2"] + d3 * more) / model.tables[1].rows
    return model


def score(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """Each text's log10 probability: the keys, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` adds log10 P(token | tokens before, one less than the order) over
    the text's words and its end, by interpolated modified Kneser-Ney: the longest
    run's discounted share of what follows its first words, and for the rest the
    discounted share of different words that the run without its first word
    follows, down to single words, and for the rest of that all known words
    and one unknown alike. ``base_score`` is that of single tokens with one
    added to every count. ``n_known`` counts tokens seen in training. Perplexity
    is ``10 ** (-score / n_tokens)``. NULL and empty texts are an end.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(len(keys))):
                tokens, places = tokens_of(*word_hashes(data, offsets))
                ids, counts = model.word_ids(tokens)
                tops = model.token_scores(ids, counts, places)
                base = np.log10((counts + 1) / (model.tokens + model.words.rows + 1))
                part, first = batch.slice(low, high - low), places[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[: len(keys)],
                        pa.array(np.diff(places), pa.int64()),
                        pa.array(np.add.reduceat((counts > 0).astype(np.int64), first)),
                        pa.array(np.full(high - low, model.tokens), pa.int64()),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(tops, first)),
                    ],
                    [*keys, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return docs.select(*keys, F.col(text).alias("scored text")).mapInArrow(
        scored,
        f"{fields}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
