"""Exact Jaccard join of shingle sets by metric regions: pivots, windows and recursion."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logframe.llm.bloom import bloom_blocks, may_hold, possible
from logframe.llm.components import components
from logframe.llm.shared import checkpointed, tidy, written
from logframe.llm.words import mix, shingles, text_slices, word_hashes

# A region of at most so many sets, and shingles in all, is joined in one task.
REGION_SETS = 256
REGION_SHINGLES = 4_000_000
# Sets that are compared with so many others at a time, and how many times REGION_SETS
# are a block of a region that cannot be cut: each text is sent once for every block.
TILE = 128
BLOCK = 4
# Tasks that a larger region's sets are dealt to when it is cut.
PARTS = 8
# Pivots of a larger region, and the share of it that a new region may have at most.
PIVOTS = 8
SHRINK = 0.7
# Added to distances before they are compared, against rounding.
SLACK = 1e-9
# How often shingles occur is counted in so many cells: it orders them, and no
# result depends on the order.
CELLS = 1 << 20
# Bits of a sketch at most, sets of a group whose pairs are all compared, and pairs at a time, of long sketches fewer.
SKETCH_BITS = 1 << 16
FEW_SETS = 16
PAIRS = 1 << 18
# Larger groups, or those with more bytes of sketches, are joined without looking at sketches.
GROUP_SETS = 1 << 16
GROUP_BYTES = 64 << 20

ROW_KEY = ["row_hash", "row_id", "no_id", "row_text"]

_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def jaccard_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    region_sets: int = REGION_SETS,
    keys: bool = False,
) -> DataFrame:
    """The component of every document in the graph of near copies.

    Columns: doc_id, n_shingles, component_id, n_links. Words are runs without
    white space, A-Z lower-cased; a document's set has its distinct shingles of
    ``words`` words, or its whole sequence if it has fewer. Two documents link
    if ``100 * intersection >= percent * union``. ``component_id`` is the
    smallest doc_id that links lead to, its own included; ``n_links`` counts the
    different sets linked with the document's own. Texts without words (NULL,
    empty, white space) have 0 shingles and are linked with nothing. Rows with
    a NULL doc_id take part, but give no component its id. Repeated rows are
    copies. No rows in, no rows out. Other columns are ignored. With ``keys`` there
    are text_hash, ``xxhash64`` of the text, and root, which tells components apart
    also where ids repeat or are NULL, and is NULL for texts without words.

    1 - Jaccard is a metric, so a set within e of x is at most e further from
    any pivot than x. Pivots alone cannot cut a corpus, though: nearly all of
    it lies at distance 1 from any of them. So the first regions are made of
    agreement (``class_keys``): sets that may link share a class of shingles,
    and those that share one, and whose sketches differ in no more bits than
    linking sets can, are a region, directly or by others. Without the sketches
    agreements by chance, ever more with more documents, would chain a corpus into
    one region. Large regions are divided
    once more by agreement on a rare shingle. Inside, distances differ.
    ``region_links`` cuts what is large still by pivots into
    Voronoi cells, copies the sets whose distance is in the window of another
    cell too, and goes on with every cell until it is small enough for one task.

    Copies of a set are one node before anything is joined. Shingles are
    compared by 64-bit hashes, sets are told apart by 128 bits.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    # Where sets meet. Nodes are known by half their id here: to take two for
    # one costs a comparison, no more. Most keys are of one row. They are counted
    # without their sets, and those of one row dropped where they are made, by a
    # second reading of the texts: cheaper than keeping them in between.
    met = rows.select("text").mapInArrow(_keys(words, percent), "key bigint")
    repeated = checkpointed(met.groupBy("key").count().filter("count > 1").select("key"))
    held = docs.sparkSession.sparkContext.broadcast(bloom_blocks(repeated, "key", repeated.count()))
    sets = checkpointed(
        rows.mapInArrow(
            _describe(words, percent, held),
            "doc_id bigint, text_hash bigint, n_shingles bigint, set_a bigint, set_b bigint, "
            "keys array<bigint>, sketch binary",
        )
    )
    regions = components(_near(sets, percent)).select(F.col("node").alias("set_a"), F.col("root").alias("region"))
    # One row of each set in a region brings its text, which is what regions are
    # sent: a third of the bytes of its shingles' hashes.
    chosen = checkpointed(
        sets.filter("n_shingles > 0")
        .join(regions, "set_a")
        .groupBy("region", "set_a", "set_b", "n_shingles")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("row"))
        .select(
            F.col("region").cast("string").alias("region"),
            F.concat(F.hex("set_a"), F.lit("-"), F.hex("set_b")).alias("node"),
            "n_shingles",
            *row_key("row.doc_id", "row.text_hash"),
        )
    )
    # Repeated rows are dropped by the key of the join, so texts are sent once.
    rows = rows.select("text", *row_key("doc_id", "text_hash"))
    rows = may_hold(rows, "row_hash", chosen.select("row_hash")).dropDuplicates(ROW_KEY)
    members = written(
        rows.join(chosen, ROW_KEY).select(
            "region", "node", F.lit(True).alias("home"), "n_shingles", "text"
        ),
        "jaccard-members",
    )
    found = checkpointed(region_links(members, words, percent, region_sets))
    roots = components(found.filter("other is not null"))
    degrees = found.filter("other is null").groupBy("one").agg(F.sum("links").alias("n_links"))

    node = F.concat(F.hex("set_a"), F.lit("-"), F.hex("set_b"))
    more = ["text_hash", "root"] if keys else []
    named = sets.select("doc_id", *more[:1], "n_shingles", node.alias("node"))
    groups = named.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named_roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = (
        rooted.join(named_roots, "root")
        .join(degrees.withColumnRenamed("one", "node"), "node", "left")
        .select("node", "component_id", "n_links", *more[1:])
    )
    empty = named.filter("n_shingles = 0").select(
        "doc_id",
        "n_shingles",
        F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"),
        *([F.col("text_hash"), F.lit(None).cast("string").alias("root")] if keys else []),
    )
    return (
        named.filter("n_shingles > 0")
        .join(classes, "node", "left")
        .select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), *more)
        .unionByName(empty)
    )


def _near(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that share a key and may link by their sketches, enough to connect all such: one, other.

    Near copies share many keys, mostly with the same other sets: of keys
    whose sets are the same one is enough. Its sets are brought together with
    their sketches, which take less than three bits a shingle, 64 at least.
    """
    met = sets.filter("size(keys) > 0").select(F.explode("keys").alias("key"), "set_a")
    # Which sets a key has, by their number and sums that cannot overflow.
    half = F.lit(0xFFFFFFFF)
    own = [F.count(F.lit(1)), F.sum(F.col("set_a").bitwiseAND(half)), F.sum(F.shiftrightunsigned("set_a", 32))]
    names = ["first", "last", "n", "low", "high"]
    ends = [F.min("set_a"), F.max("set_a")]
    shared = (
        met.groupBy("key")
        .agg(*[value.alias(name) for name, value in zip(names, ends + own)])
        .filter("first != last")
        .select("key", F.xxhash64(*names).alias("group"))
    )
    groups = met.join(shared, "key").select("group", "set_a").distinct()
    sketches = sets.filter("size(keys) > 0").select("set_a", "n_shingles", "sketch").distinct()
    return (
        groups.join(sketches, "set_a")
        .select("group", "set_a", "n_shingles", "sketch")
        .repartition("group")
        .sortWithinPartitions("group", "n_shingles")
        .mapInArrow(_close_pairs(percent), "one bigint, other bigint")
    )


def row_key(doc_id: str, text_hash: str) -> list[Column]:
    """A row's id, also one that is NULL, and text, and a hash of both."""
    return [
        F.xxhash64(doc_id, text_hash).alias("row_hash"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("row_id"),
        F.col(doc_id).isNull().alias("no_id"),
        F.col(text_hash).alias("row_text"),
    ]


def region_links(
    members: DataFrame, words: int, percent: int, region_sets: int = REGION_SETS
) -> DataFrame:
    """Links inside regions, enough to connect what is linked, and each set's number of links.

    ``members``: region, node, home, n_shingles, text (of distinct sets). Result: one, other (NULL in rows
    that count), links. A set is at home in one region and a guest in others;
    only pairs with a set at home are compared, and a set's links are counted
    at home, where all its partners are.
    """
    reach = 1 - percent / 100
    out, work = None, members.withColumn("rare", F.lit(False))
    while True:
        sizes = work.groupBy("region").agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"), F.max("rare").alias("rare")
        )
        # A table's size is known, so Spark joins a short list without sending the texts.
        large = written(
            sizes.filter((F.col("n") > region_sets) | ((F.col("n") > 2) & (F.col("weight") > REGION_SHINGLES))),
            "jaccard-large",
        )
        if large.isEmpty():
            return _join(out, _compared(work, words, percent))
        small = work.join(large.select("region"), "region", "left_anti")
        out = _join(out, _compared(small, words, percent))
        chained = large.filter("not rare").select("region")
        wide = large.filter("rare")
        parted = None
        if not chained.isEmpty():
            parted = _by_rare_shingles(work.join(chained, "region", "left_semi"), words, percent)
        if wide.isEmpty():
            work = parted
            continue
        work = work.filter("rare").drop("rare")
        pivots = (
            work.join(wide.select("region"), "region", "left_semi")
            .withColumn(
                "rank",
                F.row_number().over(
                    Window.partitionBy("region").orderBy(F.xxhash64("node", "region"), "node")
                ),
            )
            .filter(F.col("rank") <= PIVOTS)
        )
        # Pivots come before the sets of their region, once for each part of it.
        part = F.pmod(F.xxhash64("node"), F.lit(PARTS)).cast("int")
        kept = ["node", "home", "n_shingles", "text"]
        dealt = pivots.select(
            "region", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.lit(0).alias("turn"), *kept
        ).unionByName(
            work.join(wide.select("region"), "region", "left_semi").select(
                "region", part.alias("part"), F.lit(1).alias("turn"), *kept
            )
        )
        cells = written(
            dealt.repartition("region", "part")
            .sortWithinPartitions("region", "part", "turn", "node")
            .mapInArrow(
                _voronoi(words, reach),
                "parent string, region string, node string, home boolean, n_shingles bigint, text string",
            ),
            "jaccard-cells",
        )
        grown = (
            cells.groupBy("parent", "region")
            .count()
            .groupBy("parent")
            .agg(F.max("count").alias("most"))
            .join(wide.drop("rare").withColumnRenamed("region", "parent"), "parent")
            .withColumn("stuck", F.col("most") > F.col("n") * SHRINK)
        )
        grown = written(grown, "jaccard-grown")
        stuck = grown.filter("stuck").select(F.col("parent").alias("region"))
        if not stuck.isEmpty():
            blocks = _blocks(work.join(stuck, "region", "left_semi"), region_sets, percent)
            out = _join(out, _compared(blocks, words, percent, blocked=True))
        cells = cells.join(grown.filter("not stuck").select("parent"), "parent", "left_semi").drop("parent")
        cells = cells.withColumn("rare", F.lit(True))
        work = cells if parted is None else parted.unionByName(cells)


def _by_rare_shingles(members: DataFrame, words: int, percent: int) -> DataFrame:
    """Large regions cut into those of sets that share a rare shingle, directly or by others.

    Two linking sets of at least n shingles share all but few, so whatever the
    order, they share one of the first ``n - ceil(n * percent / 100) + 1`` of
    each. Of the smaller it is even one of the first
    ``n - ceil(n * 2 * percent / (100 + percent)) + 1``, since the intersection is at
    least ``percent / (100 + percent)`` of both sizes together: only there a shingle
    joins sets. Rare shingles come first: a passage that many documents share is in
    hardly any document's first ones, and joins nothing. How often shingles
    occur is counted in CELLS cells over all sets; where shingles share a cell that
    costs comparisons, never a link. Sets go on alone where nothing is
    shared. Rows with shingles' hashes are two numbers; each text is sent once.
    """
    held = members.sparkSession.sparkContext.broadcast(_often(members, words))
    told = members.withColumn("place", F.xxhash64("region", "node"))
    rare = checkpointed(
        told.select("region", "place", "text")
        .mapInArrow(
            _rare_shingles(words, percent, held), "region string, place bigint, item bigint, early boolean"
        )
        .select("place", F.xxhash64("region", "item").alias("key"), "early")
    )
    meeting = (
        rare.groupBy("key")
        .agg(
            F.min(F.when(F.col("early"), F.col("place"))).alias("first"),
            F.min("place").alias("least"),
            F.max("place").alias("last"),
        )
        .filter("least != last and first is not null")
        .select("key", "first")
    )
    edges = rare.join(meeting, "key").filter("place != first").select("place", "first").distinct()
    roots = components(edges, "place", "first").withColumnRenamed("node", "place")
    return written(
        told.join(roots, "place").select(
            F.concat_ws("/", "region", F.lit("rare"), F.col("root").cast("string")).alias("region"),
            "node",
            "home",
            "n_shingles",
            "text",
            F.lit(True).alias("rare"),
        ),
        "jaccard-rare",
    )


def _often(members: DataFrame, words: int) -> np.ndarray:
    """How many sets have shingles of each cell, over all members; the driver gets a row per cell."""
    with tidy(members.sparkSession):
        counted = (
            members.select("text")
            .mapInArrow(_cell_counts(words), "cell int, n bigint")
            .groupBy("cell")
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
    often = np.zeros(CELLS, dtype=np.int64)
    often[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return often


def _cell(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(20)).astype(np.int64) & (CELLS - 1)


def _cell_counts(words: int):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for _, _, sets in _sets(batch.column("text"), words):
                total += np.bincount(_cell(np.concatenate(sets)), minlength=CELLS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["cell", "n"])

    return counts


def _rare_shingles(words: int, percent: int, held: Broadcast[np.ndarray]):
    """Each set's rarest shingles, as many as two linking sets cannot both do without.

    Those that it cannot do without as the smaller of the two are early.
    """

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, sets in _sets(batch.column("text"), words):
                firsts, early = [], []
                for items in sets:
                    n = len(items)
                    order = np.lexsort((items, held.value[_cell(items)]))
                    firsts.append(items[order[: n - -(-n * percent // 100) + 1]])
                    early.append(np.arange(len(firsts[-1])) <= n - -(-n * 2 * percent // (100 + percent)))
                owner = pa.array(np.repeat(np.arange(low, high), [len(own) for own in firsts]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("region").take(owner),
                        batch.column("place").take(owner),
                        pa.array(np.concatenate(firsts).view(np.int64)),
                        pa.array(np.concatenate(early)),
                    ],
                    ["region", "place", "item", "early"],
                )

    return rare


def _join(one: DataFrame | None, other: DataFrame) -> DataFrame:
    return other if one is None else one.unionByName(other)


def _blocks(members: DataFrame, region_sets: int, percent: int) -> DataFrame:
    """Regions that pivots do not cut: pairs of blocks of their sets, a region each.

    A block has sets of one shell of sizes, and goes with the blocks of its own and
    the neighbouring shells: sets of others cannot link. So two sets that may
    link meet exactly once and no region is larger than two blocks.
    """
    half = BLOCK * region_sets
    shell = F.floor(F.log("n_shingles") / F.lit(_shell_width(percent))).cast("int")
    members = members.withColumn("shell", shell)
    needed = F.greatest(
        F.ceil(F.count(F.lit(1)) / half), F.ceil(2 * F.sum("n_shingles") / REGION_SHINGLES)
    ).cast("int")
    # One short row for each region.
    shells = written(
        members.groupBy("region", "shell")
        .agg(needed.alias("blocks"))
        .groupBy("region")
        .agg(F.map_from_entries(F.collect_list(F.struct("shell", "blocks"))).alias("blocks")),
        "jaccard-shells",
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")[F.col("shell")]).cast("int")
    met = F.explode(F.sequence(F.col("shell") - 1, F.col("shell") + 1))
    dealt = (
        members.join(shells, "region")
        .withColumn("own", F.struct("shell", own.alias("block")))
        .withColumn("met", met)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.try_element_at("blocks", "met") - 1)))
        .withColumn("with", F.struct(F.col("met").alias("shell"), "block"))
    )
    first, second = F.least("own", "with"), F.greatest("own", "with")
    pair = [end.getField(name) for end in (first, second) for name in ("shell", "block")]
    return dealt.select(
        F.concat_ws("/", "region", F.lit("pair"), *pair).alias("region"),
        "node",
        "home",
        "text",
        F.when(F.col("own") == F.col("with"), 2)
        .otherwise((F.col("own") > F.col("with")).cast("int"))
        .alias("side"),
    )


def _compared(members: DataFrame, words: int, percent: int, blocked: bool = False) -> DataFrame:
    """Each region joined in one task."""
    side = F.col("side") if blocked else F.lit(0)
    return (
        members.select("region", "node", "home", "text", side.alias("side"))
        .groupBy("region")
        .applyInArrow(_links(words, percent, blocked), "one string, other string, links bigint")
    )


@lru_cache(maxsize=4096)
def _shell(size: int, percent: int) -> int:
    """Sets that may link are in the same shell of sizes or in neighbouring ones."""
    return int(math.log(size) / _shell_width(percent))


def _shell_width(percent: int) -> float:
    return math.log(100 / percent) * (1 + 1e-9)


@lru_cache(maxsize=4096)
def _classes(shell: int, percent: int) -> tuple[int, int]:
    """Classes of the shingles of sets that meet in a shell, and how many of a set's may be empty.

    Two sets that link, the larger of them in the shell, differ in at most k
    shingles, so they agree in all but k classes.
    """
    largest = (100 / percent) ** ((shell + 1) * (1 + 1e-9))
    k = int(2 * largest * (100 - percent) / (100 + percent) + 1e-6)
    if k == 0:
        return 0, 0
    # The fewer classes the larger they are, and the fewer sets share one by
    # chance; about one set in a hundred may have more empty ones than are spare.
    least, spare = largest * (percent / 100) ** 2, 0
    for _ in range(8):
        n = k + 1 + spare
        empty = n * math.exp(-least / n)
        spare = min(math.ceil(empty + 2.3 * math.sqrt(empty)) if empty > 0.01 else 0, k)
    return k + 1 + spare, spare


def class_keys(items: np.ndarray, percent: int) -> np.ndarray:
    """Keys of which two linking, different sets share at least one.

    In the own shell of sizes and the next the shingles are dealt into classes
    by their hash. There are ``spare`` more than differing shingles can spoil and
    one, so sets that link agree on a class that is not empty, if one of them
    has at most ``spare`` empty ones: its key is the hash of the class's
    shingles. Sets with more empty classes also have the keys of their
    ``n - ceil(n * percent / 100) + 1`` least shingles, of which two linking
    sets share one.
    """
    n, keys, sparse = len(items), [], False
    spread = mix(items * _SALT)
    high, low = (spread >> np.uint64(32)).astype(np.float64), (spread & np.uint64(0xFFFFFFFF)).astype(np.float64)
    own = _shell(n, percent)
    for shell in (own, own + 1):
        classes, spare = _classes(shell, percent)
        if classes == 0:
            continue
        place = ((items >> np.uint64(16)) % np.uint64(classes)).astype(np.int64)
        held = np.flatnonzero(np.bincount(place, minlength=classes))
        # Sums of halves of hashes: exact in floats for a class of under two million.
        highs = np.bincount(place, high, classes)[held].astype(np.uint64)
        lows = np.bincount(place, low, classes)[held].astype(np.uint64)
        name = held.astype(np.uint64) + np.uint64((shell + 1) * 0x2545F4914F6CDD1D % (1 << 64))
        keys.append(mix(mix((highs << np.uint64(32)) + lows) + mix(name)))
        sparse |= classes - len(held) > spare
    if sparse:
        keys.append(mix(np.sort(items)[: n - -(-n * percent // 100) + 1] ^ _SALT))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """The texts in slices: first row, end row, each one's distinct shingles in order."""
    for low, high, data, offsets in text_slices(column):
        items, places = shingles(*word_hashes(data, offsets), words)
        yield low, high, [np.unique(items[a:b]) for a, b in zip(places[:-1], places[1:])]


def sketch(items: np.ndarray) -> bytes:
    """Whether an odd number of a set's items fall into each of a power of two of cells, as bits.

    Every bit in which two sketches differ has an item that only one of the sets has:
    they differ in no more bits than the sets in items. The longer of two is folded to
    the other's length, half onto half. One and a half bits an item or more, so sets
    that have little in common differ in far more bits than linking ones may.
    """
    bits = min(SKETCH_BITS, max(64, 1 << (3 * len(items) // 2 - 1).bit_length()))
    odd = np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


class _Sketches:
    """Sets of some groups with their sketches, to be compared many pairs at a time."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent = percent
        self.sizes = table.column("n_shingles").to_numpy()
        column = table.column("sketch").combine_chunks()
        _, places, values = column.buffers()
        ends = np.frombuffer(places, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(values, dtype=np.uint8)
        self.words = np.diff(ends) // 8
        self.at, self.rows = {}, {}
        for size in np.unique(self.words):
            own = np.flatnonzero(self.words == size)
            found = data[ends[own][:, None] + np.arange(8 * size)].view(np.uint64)
            while size:  # also folded for the sets of shorter sketches that they may link with
                at = self.at.setdefault(size, np.zeros(len(table), np.int64))
                before = self.rows.get(size, np.zeros((0, size), np.uint64))
                at[own] = np.arange(len(before), len(before) + len(own))
                self.rows[size] = np.concatenate([before, found])
                size //= 2
                if size * 64 * 100 < self.sizes[own].min() * percent:
                    break
                found = found[:, :size] ^ found[:, size:]

    def close(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether sets may link, by sizes and sketches: never false for two that do."""
        a, b = self.sizes[one], self.sizes[other]
        found = 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)
        words = np.minimum(self.words[one], self.words[other])
        for size in np.unique(words[found]):
            own = np.flatnonzero(found & (words == size))
            at, rows = self.at[size], self.rows[size]
            step = max(1, PAIRS * 16 // int(size))
            for low in range(0, len(own), step):
                part = own[low : low + step]
                apart = np.bitwise_count(rows[at[one[part]]] ^ rows[at[other[part]]]).sum(axis=1, dtype=np.int64)
                found[part] = (100 + self.percent) * apart <= (100 - self.percent) * (a[part] + b[part])
        return found

    def all_pairs(self, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of groups of n sets each, every set that close pairs lead to an earlier one from, and the first such."""
        x, y = np.triu_indices(n, 1)
        near = np.zeros((len(starts), n, n), dtype=bool)
        near[:, x, y] = self.close((starts[:, None] + x).ravel(), (starts[:, None] + y).ravel()).reshape(len(starts), -1)
        near |= near.transpose(0, 2, 1) | np.eye(n, dtype=bool)
        before, least = None, np.broadcast_to(np.arange(n), (len(starts), n))
        while before is None or (least != before).any():
            before, least = least, np.where(near, least[:, None, :], n).min(axis=2)
        nr, own = np.nonzero(least < np.arange(n))
        return starts[nr] + own, starts[nr] + least[nr, own]

    def spread(self, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Close pairs of one group, in order of size, that connect what any connect: each set is reached once."""
        todo: list[int] = []
        while len(left):
            if not todo:
                todo, left = [int(left[0])], left[1:]
            x = todo.pop()
            sizes, own = self.sizes[left], int(self.sizes[x])
            low = np.searchsorted(sizes, -(-own * self.percent // 100))
            high = np.searchsorted(sizes, own * 100 // self.percent, side="right")
            some = left[low:high]
            near = self.close(np.full(len(some), x), some)
            if near.any():
                yield np.full(np.count_nonzero(near), x), some[near]
                todo.extend(some[near].tolist())
                left = np.concatenate([left[:low], some[~near], left[high:]])


def _close_pairs(percent: int):
    """Of sets sorted by group, pairs that connect those that may link; a group that is too large is joined whole."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        group, nodes = table.column("group").to_numpy(), table.column("set_a").to_numpy()
        known = _Sketches(table, percent)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
        sizes = np.diff(np.append(starts, len(group)))
        found = [known.all_pairs(starts[sizes == n], n) for n in range(2, FEW_SETS + 1) if (sizes == n).any()]
        for start, n in zip(starts[sizes > FEW_SETS], sizes[sizes > FEW_SETS]):
            found.extend(known.spread(np.arange(start, start + n)))
        none = np.zeros(0, np.int64)
        one = nodes[np.concatenate([none, *[x for x, _ in found]])]
        other = nodes[np.concatenate([none, *[y for _, y in found]])]
        met = np.unique(np.stack([np.minimum(one, other), np.maximum(one, other)], axis=1), axis=0)
        return _pair_rows(met[:, 0], met[:, 1])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, whole, hub = None, None, None  # rows of the last group; the one joined whole, and its first set
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if whole is not None:
                rest = int(np.searchsorted(table.column("group").to_numpy(), whole, side="right"))
                nodes = table.column("set_a").to_numpy()[:rest]
                yield _pair_rows(np.full(rest, hub), nodes)
                table = table.slice(rest)
                if not len(table):
                    continue
                whole = None
            held = table if held is None else pa.concat_tables([held, table])
            group = held.column("group").to_numpy()
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield pairs(held.slice(0, cut))
                held = held.slice(cut)
            if len(held) > GROUP_SETS or held.nbytes > GROUP_BYTES:
                nodes = held.column("set_a").to_numpy()
                whole, hub, held = group[-1], nodes[0], None
                yield _pair_rows(np.full(len(nodes), hub), nodes)
        if held is not None:
            yield pairs(held)

    return close


def _pair_rows(one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], ["one", "other"])


def _keys(words: int, percent: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, sets in _sets(batch.column("text"), words):
                found = [class_keys(own, percent) for own in sets if len(own)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(found).view(np.int64))], ["key"]
                    )

    return keys


def _describe(words: int, percent: int, held: Broadcast[np.ndarray]):
    """Each text's set, its keys as far as they may be in the filter ``held``, and its sketch if it has such."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, sets in _sets(batch.column("text"), words):
                first, second, keys = [], [], []
                for own in sets:
                    first.append(np.add.reduce(mix(own), dtype=np.uint64))
                    second.append(np.add.reduce(mix(own ^ _SALT), dtype=np.uint64))
                    keys.append(class_keys(own, percent) if len(own) else own)
                owner = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
                flat = np.concatenate(keys)
                stays = possible(held.value, flat)
                met = np.bincount(owner[stays], minlength=len(keys)) > 0
                ends = np.searchsorted(owner[stays], np.arange(len(keys) + 1)).astype(np.int32)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("text_hash"),
                        pa.array([len(own) for own in sets], pa.int64()),
                        pa.array(np.array(first, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(second, dtype=np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[stays].view(np.int64))),
                        pa.array([sketch(own) if some else None for own, some in zip(sets, met)], pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "keys", "sketch"],
                )

    return describe


def _distance(one: np.ndarray, other: np.ndarray) -> float:
    """1 - Jaccard of two sorted arrays of distinct numbers."""
    if len(one) > len(other):
        one, other = other, one
    at = np.minimum(np.searchsorted(other, one), len(other) - 1)
    both = int(np.count_nonzero(other[at] == one))
    return 1 - both / (len(one) + len(other) - both)


def _voronoi(words: int, reach: float):
    """Sends each set to its nearest pivot's cell, and as a guest to the cells whose window has it."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pivots = None, []
        for batch in batches:
            rows, names, homes = [], [], []
            regions, parts, turns, home = (batch.column(c).to_pylist() for c in ("region", "part", "turn", "home"))
            for low, _, sets in _sets(batch.column("text"), words):
                for i, items in enumerate(sets, low):
                    if turns[i] == 0:
                        if (regions[i], parts[i]) != known:
                            known, pivots = (regions[i], parts[i]), []
                        pivots.append(items)
                        continue
                    far = [_distance(items, pivot) for pivot in pivots]
                    near = int(np.argmin(far))
                    for nr, d in enumerate(far):
                        if nr == near or d <= far[near] + 2 * reach + SLACK:
                            rows.append(i)
                            names.append(f"{regions[i]}/{nr}")
                            homes.append(home[i] and nr == near)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column("region"),
                    pa.array(names, pa.string()),
                    taken.column("node"),
                    pa.array(homes, pa.bool_()),
                    taken.column("n_shingles"),
                    taken.column("text"),
                ],
                ["parent", "region", "node", "home", "n_shingles", "text"],
            )

    return cells


def _links(words: int, percent: int, blocked: bool):
    def links(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_pylist()
        home = np.array(table.column("home").to_pylist(), dtype=bool)
        side = table.column("side").to_numpy()
        sets = [own for chunk in table.column("text").chunks for _, _, part in _sets(chunk, words) for own in part]
        sizes = np.array([len(own) for own in sets])
        order = np.argsort(sizes, kind="stable")
        tiles = [order[low : low + TILE] for low in range(0, len(order), TILE)]
        items = [np.unique(np.concatenate([sets[i] for i in tile])) for tile in tiles]
        one, other, counts = [], [], []
        degrees = np.zeros(len(nodes), dtype=np.int64)
        parent = list(range(len(nodes)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for t, a in enumerate(tiles):
            for u, b in enumerate(tiles[t:], t):
                if 100 * sizes[a[-1]] < percent * sizes[b[0]]:
                    break  # and the sets of later tiles are larger still
                shared = np.intersect1d(items[t], items[u], assume_unique=True)
                both = _overlaps([sets[i] for i in a], [sets[i] for i in b], shared)
                linked = 100 * both >= percent * (sizes[a][:, None] + sizes[b][None, :] - both)
                if t == u:
                    linked = np.triu(linked, 1)
                linked &= home[a][:, None] | home[b][None, :]
                if blocked:  # sets of one of two different blocks meet elsewhere
                    linked &= (side[a][:, None] != side[b][None, :]) | (side[a][:, None] == 2)
                degrees[a] += linked.sum(axis=1)
                degrees[b] += linked.sum(axis=0)
                for x, y in zip(*np.nonzero(linked)):
                    rx, ry = root(int(a[x])), root(int(b[y]))
                    if rx != ry:
                        parent[ry] = rx
                        one.append(nodes[a[x]])
                        other.append(nodes[b[y]])
                        counts.append(None)
        for i in np.flatnonzero((degrees > 0) & home):
            one.append(nodes[i])
            other.append(None)
            counts.append(int(degrees[i]))
        return pa.table(
            {
                "one": pa.array(one, pa.string()),
                "other": pa.array(other, pa.string()),
                "links": pa.array(counts, pa.int64()),
            }
        )

    return links


def _overlaps(one: list[np.ndarray], other: list[np.ndarray], shared: np.ndarray) -> np.ndarray:
    """How many items each set of ``one`` has in common with each of ``other``; ``shared`` holds what both sides have."""
    both = np.zeros((len(one), len(other)), dtype=np.int64)
    step = max(1, 8_000_000 // max(len(one), len(other)))  # columns of a part of the matrices of sets by items

    def placed(sets: list[np.ndarray], items: np.ndarray) -> np.ndarray:
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(own) for own in sets])
        at = np.minimum(np.searchsorted(items, flat), len(items) - 1)
        met = items[at] == flat
        has = np.zeros((len(sets), len(items)), dtype=np.float32)
        has[owner[met], at[met]] = 1
        return has

    for low in range(0, len(shared), step):
        items = shared[low : low + step]
        both += np.rint(placed(one, items) @ placed(other, items).T).astype(np.int64)
    return both
