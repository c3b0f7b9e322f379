"""Hard negatives: for every anchor and positive the best other rows inside a window of scores.

Rows lie in packed blocks of bounded size, a written table of few rows. Every
block of candidates meets every block of anchors as one tile: a Strassen
product of whole numbers, of which each anchor's best rows go on. What tiles
keep is merged by Spark. Two rounds of tiles: one for positives, and one for
the windows that they open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logframe.llm.shared import written

# Rows of a block of candidates, and components: a longer vector makes shorter blocks.
BLOCK_ROWS = 4096
BLOCK_CELLS = 1 << 20

# Anchors that are packed together, about, and blocks of candidates that a task call takes.
ANCHOR_ROWS = 1024
CALL_BLOCKS = 4

# Edge of a matrix from which it is multiplied without another division.
LEAF = 32

# A row's number: its partition, its block there, its place in the block.
BLOCK_BITS, PLACE_BITS = 20, 14

BLOCKS = "block bigint, n int, dim int, n_anchors bigint, ids binary, labels binary, vectors binary, kind string"
ANCHORS = (
    "tile_row int, n int, dim int, numbers binary, ids binary, labels binary, vectors binary, kind string, "
    "n_positives binary, positive_ids binary, positive_scores binary"
)
POSITIVES = "anchor bigint, anchor_id bigint, number bigint, positive_id bigint, positive_score bigint"
NEGATIVES = (
    "anchor bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, "
    "number bigint, negative_id bigint, negative_score bigint"
)


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return x if x.shape == (rows, columns) else np.pad(x, ((0, rows - x.shape[0]), (0, columns - x.shape[1])))


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """All inner products of the rows of two matrices, by Strassen's seven products of quarters.

    Odd edges are padded with zeros. Additions of 64-bit integers are exact,
    and modulo 2**64 where a sum on the way is larger than a result.
    """
    m, k, n = len(a), a.shape[1], len(b)
    if min(m, k, n) <= leaf:
        return a @ b.T
    m2, k2, n2 = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = _padded(a, 2 * m2, 2 * k2), _padded(b, 2 * n2, 2 * k2)
    a11, a12, a21, a22 = a[:m2, :k2], a[:m2, k2:], a[m2:, :k2], a[m2:, k2:]
    # Rows of b are columns of the right factor.
    b11, b21, b12, b22 = b[:n2, :k2], b[:n2, k2:], b[n2:, :k2], b[n2:, k2:]
    out = np.empty((2 * m2, 2 * n2), dtype=np.int64)
    c11, c12, c21, c22 = out[:m2, :n2], out[:m2, n2:], out[m2:, :n2], out[m2:, n2:]
    p = product(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = product(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = product(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = product(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = product(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += product(a21 - a11, b11 + b12, leaf)
    c11 += product(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def best(scores: np.ndarray, fits: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``size`` highest fitting scores; of equal ones the first columns."""
    many = np.flatnonzero(np.count_nonzero(fits, axis=1) > size)
    if len(many):
        own = np.where(fits[many], scores[many], np.iinfo(np.int64).min)
        least = np.partition(own, own.shape[1] - size, axis=1)[:, own.shape[1] - size]
        fits = fits.copy()
        fits[many] &= scores[many] >= least[:, None]
    row, column = np.nonzero(fits)
    order = np.lexsort((column, ~scores[row, column], row))
    row, column = row[order], column[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < size
    return row[kept], column[kept]


def _matrix(record: dict) -> np.ndarray:
    kind = np.dtype(record["kind"])
    return np.frombuffer(record["vectors"], kind).reshape(record["n"], record["dim"]).astype(np.int64)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _bytes_of(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type that holds them."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


def _rectangle(vectors: pa.Array, scale: float) -> np.ndarray:
    """Scaled components rounded down, a row for each vector; shorter ones end in zeros."""
    ends = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.float64)
    whole = np.clip(np.floor(flat * scale), -(2.0**62), 2.0**62).astype(np.int64)
    sizes = np.diff(ends)
    if len(sizes) and (sizes == sizes[0]).all():
        return whole.reshape(len(sizes), sizes[0])
    out = np.zeros((len(sizes), max(sizes, default=0)), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = whole
    return out


def _blocks_of(scale: float, every: int) -> Callable:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << BLOCK_BITS
        for batch in batches:
            low = 0
            sizes = batch["vector"].value_lengths().to_numpy(zero_copy_only=False)
            while low < batch.num_rows:
                part = sizes[low : low + BLOCK_ROWS]
                widest = np.maximum.accumulate(part) * np.arange(1, len(part) + 1)
                n = max(int(np.searchsorted(widest, BLOCK_CELLS, side="right")), 1)
                piece = batch.slice(low, n)
                ids = piece["id"].to_numpy()
                order = np.argsort(ids, kind="stable")
                vectors = _narrow(_rectangle(piece["vector"].take(pa.array(order)), scale))
                labels = piece["label"].to_numpy()[order]
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "block": block,
                            "n": len(ids),
                            "dim": vectors.shape[1],
                            "n_anchors": int(np.count_nonzero(ids % every == 0)),
                            "ids": _bytes_of(ids[order]),
                            "labels": _bytes_of(labels),
                            "vectors": _bytes_of(vectors),
                            "kind": vectors.dtype.str,
                        }
                    ],
                    _BLOCK_SCHEMA,
                )
                block, low = block + 1, low + n

    return packed


_BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("n", pa.int32()), ("dim", pa.int32()), ("n_anchors", pa.int64())]
    + [(name, pa.binary()) for name in ("ids", "labels", "vectors")]
    + [("kind", pa.string())]
)


def _anchor_rows(every: int) -> Callable:
    """The anchors of blocks as rows of their own."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                ids = _longs(record["ids"])
                own = np.flatnonzero(ids % every == 0)
                vectors = _matrix(record)[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((record["block"] << PLACE_BITS) + own),
                        pa.array(ids[own]),
                        pa.array(_longs(record["labels"])[own]),
                        pa.array([_bytes_of(vector) for vector in vectors], pa.binary()),
                    ],
                    ["number", "id", "label", "vector"],
                )

    return rows


def _pack_anchors(size: int) -> Callable:
    """The anchors of a tile's rows as one record, with the positives that they have so far."""

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        vectors = [_longs(data) for data in table["vector"].to_pylist()]
        dim = max(map(len, vectors))
        matrix = _narrow(np.array([np.pad(v, (0, dim - len(v))) for v in vectors]).reshape(len(vectors), dim))
        found = [positives or [] for positives in table["positives"].to_pylist()]
        known = np.zeros((2, len(found), size), dtype=np.int64)
        for i, positives in enumerate(found):
            for j, positive in enumerate(positives):
                known[:, i, j] = positive["positive_id"], positive["positive_score"]
        record = {
            "tile_row": table["tile_row"][0].as_py(),
            "n": len(vectors),
            "dim": dim,
            "numbers": _bytes_of(table["number"].to_numpy()),
            "ids": _bytes_of(table["id"].to_numpy()),
            "labels": _bytes_of(table["label"].to_numpy()),
            "vectors": _bytes_of(matrix),
            "kind": matrix.dtype.str,
            "n_positives": _bytes_of(np.array([len(positives) for positives in found], dtype=np.int64)),
            "positive_ids": _bytes_of(known[0]),
            "positive_scores": _bytes_of(known[1]),
        }
        return pa.Table.from_pylist([record], _ANCHOR_SCHEMA)

    return packed


_ANCHOR_SCHEMA = pa.schema(
    [("tile_row", pa.int32()), ("n", pa.int32()), ("dim", pa.int32())]
    + [(name, pa.binary()) for name in ("numbers", "ids", "labels", "vectors")]
    + [("kind", pa.string())]
    + [(name, pa.binary()) for name in ("n_positives", "positive_ids", "positive_scores")]
)


def _tile(anchors: dict, block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of a tile, which of its pairs have one label, and the candidates' numbers."""
    a, b = _matrix(anchors), _matrix(block)
    dim = max(a.shape[1], b.shape[1])
    scores = product(_padded(a, len(a), dim), _padded(b, len(b), dim))
    same = _longs(anchors["labels"])[:, None] == _longs(block["labels"])[None, :]
    return scores, same, (block["block"] << PLACE_BITS) + np.arange(block["n"])


def _merged(found: list[tuple[np.ndarray, ...]], size: int) -> list[np.ndarray]:
    """Each group's best of several tiles: the first column is the group, the last three number, id and score."""
    columns = [np.concatenate(column) for column in zip(*found)]
    group, number, ident, score = columns[0], *columns[-3:]
    order = np.lexsort((number, ident, ~score, group))
    columns = [column[order] for column in columns]
    kept = np.arange(len(order)) - np.searchsorted(columns[0], columns[0]) < size
    return [column[kept] for column in columns]


def _positives(size: int) -> Callable:
    def found(anchor_table: pa.Table, block_table: pa.Table) -> pa.Table:
        tiles = []
        for anchors in anchor_table.to_pylist():
            numbers, ids = _longs(anchors["numbers"]), _longs(anchors["ids"])
            for block in block_table.to_pylist():
                scores, same, others = _tile(anchors, block)
                own = np.searchsorted(numbers, others)
                met = np.flatnonzero(numbers[np.minimum(own, len(numbers) - 1)] == others)
                same[own[met], met] = False
                row, column = best(scores, same, size)
                tiles.append(
                    (numbers[row], ids[row], others[column], _longs(block["ids"])[column], scores[row, column])
                )
        columns = _merged(tiles, size) if tiles else [np.zeros(0, np.int64)] * 5
        names = ["anchor", "anchor_id", "number", "positive_id", "positive_score"]
        return pa.table([pa.array(column) for column in columns], names)

    return found


def _negatives(size: int, low: int, high: int) -> Callable:
    def found(anchor_table: pa.Table, block_table: pa.Table) -> pa.Table:
        tiles = []
        for anchors in anchor_table.to_pylist():
            numbers, ids = _longs(anchors["numbers"]), _longs(anchors["ids"])
            n_positives = _longs(anchors["n_positives"])
            known = [_longs(anchors[f"positive_{x}"]).reshape(len(ids), -1) for x in ("ids", "scores")]
            for block in block_table.to_pylist():
                scores, same, others = _tile(anchors, block)
                for place in range(known[0].shape[1]):
                    own = np.flatnonzero(n_positives > place)
                    bound = known[1][own, place]
                    part = scores[own]
                    fits = (part >= -(-low * bound // 100)[:, None]) & (part <= (high * bound // 100)[:, None])
                    row, column = best(part, fits & ~same[own], size)
                    whole = own[row]
                    tiles.append(
                        (
                            whole * known[0].shape[1] + place,
                            numbers[whole],
                            ids[whole],
                            np.full(len(row), place, dtype=np.int64),
                            known[0][whole, place],
                            known[1][whole, place],
                            others[column],
                            _longs(block["ids"])[column],
                            part[row, column],
                        )
                    )
        columns = _merged(tiles, size)[1:] if tiles else [np.zeros(0, np.int64)] * 8
        names = [part.split()[0] for part in NEGATIVES.split(", ")]
        arrays = [pa.array(column) for column in columns]
        arrays[2] = arrays[2].cast(pa.int32())
        return pa.table(arrays, names)

    return found


def _tiles(anchors: DataFrame, blocks: DataFrame, rows: int, columns: int, keep: Callable, schema: str) -> DataFrame:
    """What every block of anchors keeps of every block of candidates, a few of these at a time.

    ``rows`` and ``columns`` are the numbers of tiles down and across. A copy of
    a block goes to each tile that it is in, so a task call holds one record of
    anchors and about CALL_BLOCKS of candidates, whatever the table's size.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    down = anchors.withColumn("tile_column", every(columns))
    across = blocks.withColumn("tile_column", F.pmod(F.xxhash64("block"), F.lit(columns)).cast("int"))
    across = across.withColumn("tile_row", every(rows))
    tile = ["tile_row", "tile_column"]
    return down.groupBy(*tile).cogroup(across.groupBy(*tile)).applyInArrow(keep, schema)


def _first(df: DataFrame, group: list[str], score: str, ident: str, size: int, rank: str) -> DataFrame:
    """Each group's ``size`` best rows; tasks drop all but their own best before the shuffle."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), ident, "number")
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= size)


def hard_negatives(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose key is divisible by ``every``. A row's score is
    its inner product with the anchor, components being multiplied by ``scale``
    and rounded down first; higher comes first, ties by smaller key. An anchor's
    positives are its first other rows of the same label, and for each of them
    come the first rows of other labels whose score is ``low`` to ``high``
    percent of the positive's.

    Rows with a NULL key, label or vector, or with a component that is NULL or
    not finite, take no part. Vectors may differ in length: components that are
    not there are zero, and an empty vector scores 0. A key that repeats is as
    many rows, anchors and other rows to each other. Scaled components end at
    plus and minus 2**62; scores are 64-bit integers and wrap beyond. Other
    columns are not read. Empty tables give no rows.
    """
    wrong = F.exists(
        F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    label = F.col(label) if isinstance(label, str) else label
    taken = rows.select(
        F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).alias("vector")
    ).filter(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & ~wrong)
    blocks = written(taken.mapInArrow(_blocks_of(scale, every), BLOCKS), "blocks")
    n_blocks, n_anchors = blocks.agg(F.count("block"), F.coalesce(F.sum("n_anchors"), F.lit(0))).collect()[0]
    down, across = -(-n_anchors // ANCHOR_ROWS) or 1, -(-n_blocks // CALL_BLOCKS) or 1

    found = blocks.filter("n_anchors > 0").mapInArrow(
        _anchor_rows(every), "number bigint, id bigint, label bigint, vector binary"
    )
    found = found.withColumn("tile_row", F.pmod(F.xxhash64("number"), F.lit(down)).cast("int"))
    known = "array<struct<place:int,positive_id:bigint,positive_score:bigint>>"
    anchors = found.withColumn("positives", F.lit(None).cast(known))
    anchors = anchors.groupBy("tile_row").applyInArrow(_pack_anchors(positives), ANCHORS)
    tops = _tiles(anchors, blocks, down, across, _positives(positives), POSITIVES)
    tops = _first(tops, ["anchor"], "positive_score", "positive_id", positives, "place")
    tops = tops.groupBy(F.col("anchor").alias("number")).agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives")
    )

    tops = written(tops, "positives")
    anchors = found.join(tops, "number").groupBy("tile_row").applyInArrow(_pack_anchors(positives), ANCHORS)
    tiles = _tiles(anchors, blocks, down, across, _negatives(negatives, low, high), NEGATIVES)
    ranked = _first(tiles, ["anchor", "place"], "negative_score", "negative_id", negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
