"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity.

A document's set holds its distinct shingles of five words. Two permutations make all
coordinates of a signature: sigma shuffles the universe of 2^32 hashes once, and coordinate
k is the smallest pi(sigma(shingle) + k), that is pi shifted in a circle by k. With 32
bands of 4 coordinates a pair of similarity 0.75 is missed with probability 5e-6.

1. Documents with equal sets are one class, a node.
2. In a bucket, the node that shares most buckets with most others is the pivot: of a group
   of edited copies that is mostly the text they were made from. Every node is compared with
   the pivots of its buckets, and components are merged.
3. What a pivot's group still leaves open are pairs of different components. All of them are
   compared, inside tasks: a task holds a bounded block of the nodes that are outside the
   pivot's component, the other nodes of the group stream past it, and one pass over the
   block gives all shared counts of a node. Only a link between two components leaves the
   task, so a group is never written as pairs.

Comparisons are on full sets of 64-bit shingle hashes: 100 * shared >= 75 * union. No pair of
a bucket is left out by a rule that may err. Nothing is collected but two yes/no answers for
each round.

Edge cases: null, empty and blank texts have an empty set and are linked with nothing. Rows
that repeat a doc_id each get the component of their own text. A row with a null doc_id gets
its component like others, and is kept if no row of its component has an id. When copies are
dropped, exactly one row of each component stays, the one with the smallest id (null last),
of equal ids the first by file and row; rows with empty sets all stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.llm.common import BATCH_ROWS, stored
from cardflow.llm.exact_dedup import LOCATOR, located

WORDS = 5
BANDS = 32
BAND_ROWS = 4
# A link: 100 * shared >= PERCENT * union.
PERCENT = 75

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
# Bytes hashed at a time, and coordinates of shingles made at a time.
SEGMENT = 1 << 20
CELLS = 1 << 16
# Shingles of the sets that a task holds, and of those that stream past them, about.
HELD = 1 << 18
STREAMED = 1 << 21


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHasher:
    """Hashes of the words of a text, by a polynomial over their bytes modulo 2^64."""

    FACTOR = 0x9E3779B97F4A7C15

    def __init__(self):
        self._grow(1 << 12)

    def _grow(self, size: int) -> None:
        # Powers of the factor and of its inverse.
        self.up, self.down = (np.full(size, f, np.uint64) for f in (self.FACTOR, pow(self.FACTOR, -1, 1 << 64)))
        for powers in (self.up, self.down):
            powers[0] = 1
            np.cumprod(powers, out=powers)

    def __call__(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode().lower(), np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]]).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        out, first = [np.empty(0, np.uint64)], 0
        while first < len(starts):
            origin = starts[first]
            last = max(first + 1, int(np.searchsorted(ends, origin + SEGMENT, "right")))
            block = data[origin : ends[last - 1]].astype(np.uint64)
            if len(block) > len(self.up):
                self._grow(2 * len(block))
            block += np.uint64(1)
            block *= self.up[: len(block)]
            total = np.concatenate([np.zeros(1, np.uint64), block.cumsum()])
            begin = starts[first:last] - origin
            out.append(_mix((total[ends[first:last] - origin] - total[begin]) * self.down[begin]))
            first = last
        return np.concatenate(out)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of the whole text if it has fewer."""
    n = len(words)
    if not n:
        return words
    width = min(n, WORDS)
    total = np.full(n - width + 1, width, np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    for k in range(width):
        total = total * factor + words[k : n - width + 1 + k]
    return np.unique(_mix(total))


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """``size`` circulant MinHash coordinates of a non-empty set."""
    # sigma: a fixed bijection of the universe. The hashes are mixed already.
    start = (hashes.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ np.uint32(0x5BD1E995)
    shift = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    columns = max(1, CELLS // size)
    for at in range(0, len(start), columns):
        x = start[None, at : at + columns] + shift
        # pi: a bijection again, the same for all coordinates.
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different for different bands."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T.astype(np.uint64):
        key = _mix(key + column)
    return key.view(np.int64)


def _over_texts(rows: DataFrame, function, outputs: str) -> DataFrame:
    """Columns of ``rows`` but the last, a text, and what ``function`` makes of the sets of texts."""
    columns = rows.columns[:-1]
    schema = T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL(outputs).fields])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in source:
            sets = [shingles(hasher(t.as_py())) for t in batch.column(len(columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *function(sets)], schema.names)

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return rows.mapInArrow(batches, schema)


def sketches(rows: DataFrame) -> DataFrame:
    """doc_id, locator, n_shingles, set_digest, bands of every row; the last two null for empty sets."""

    def sketch(sets: list[np.ndarray]) -> list[pa.Array]:
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        keys = [bands(signature(s, BANDS * BAND_ROWS)) if len(s) else None for s in sets]
        sizes = pa.array([len(s) for s in sets], pa.int64())
        return [sizes, pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]

    outputs = "n_shingles long, set_digest binary, bands array<long>"
    return _over_texts(rows.select("doc_id", *LOCATOR, "text"), sketch, outputs)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node and its whole set as sorted 64-bit hashes in binary, of (node, text)."""
    return _over_texts(texts, lambda sets: [pa.array([s.tobytes() for s in sets], pa.binary())], "hashes binary")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pivot, node, size (of the node's set), distance (1 - similarity of whole sets), linked."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            size, distance, link = [], [], []
            for one, other in zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True):
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                union = len(a) + len(b) - shared
                size.append(len(b))
                distance.append(1 - shared / union)
                link.append(100 * shared >= PERCENT * union)
            found = [pa.array(size, pa.int64()), pa.array(distance, pa.float64()), pa.array(link, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *found], ["pivot", "node", "size", "distance", "linked"])

    one, other = (sets.select(F.col("node").alias(x), F.col("hashes").alias(f"of_{x}")) for x in ("pivot", "node"))
    both = pairs.join(one, "pivot").join(other, "node").select("pivot", "node", "of_pivot", "of_node")
    return both.mapInArrow(batches, "pivot long, node long, size long, distance double, linked boolean")


class Block:
    """Sets held in a task, and the links between their components and those of others."""

    def __init__(self, nodes: list[int], roots: list[int], distances: list[float], sets: list[np.ndarray]):
        self.nodes, self.distances = np.array(nodes), np.array(distances)
        self.sizes = np.array([len(s) for s in sets])
        self.starts = np.append(0, self.sizes.cumsum()[:-1])
        self.values, self.place = np.unique(np.concatenate(sets), return_inverse=True)
        self.marked = np.zeros(len(self.values) + 1, bool)
        self.roots = roots
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (above := self.parent.get(x, x)) != x:
            x = above
        return x

    def links(self, node: int, root: int, outside: bool, distance: float, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs of roots that ``node`` links, none of them linked in this block before."""
        # Jaccard distance is a metric; a link's is at most 1 - PERCENT / 100.
        fits = np.abs(self.distances - distance) <= 1 - PERCENT / 100 + 1e-9
        fits &= 100 * np.minimum(self.sizes, len(hashes)) >= PERCENT * np.maximum(self.sizes, len(hashes))
        if outside:  # such a pair meets twice
            fits &= self.nodes > node
        which = np.flatnonzero(fits)
        own = self.root(root)
        if all(self.root(self.roots[k]) == own for k in which.tolist()):
            return
        at = np.searchsorted(self.values, hashes)
        at = at[self.values[np.minimum(at, len(self.values) - 1)] == hashes]
        self.marked[at] = True
        shared = np.add.reduceat(self.marked[self.place], self.starts, dtype=np.int64)
        self.marked[at] = False
        union = self.sizes + len(hashes) - shared
        for k in np.flatnonzero(fits & (100 * shared >= PERCENT * union)).tolist():
            other, own = self.root(self.roots[k]), self.root(root)
            if other != own:
                low, high = min(own, other), max(own, other)
                self.parent[high] = low
                yield low, high


def cross_links(met: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (low, high) between roots, from all pairs of a pivot's group that are still open."""
    rows = _with_root(_with_root(met.select("pivot", "node", "size", "distance"), roots, "node", "root"), roots, "pivot", "core")
    rows = stored(rows.withColumn("outside", F.col("root") != F.col("core")), "rooted")
    groups = rows.groupBy("pivot").agg(
        F.count_if("outside").alias("outsiders"),
        F.count(F.lit(1)).alias("members"),
        F.sum(F.when(F.col("outside"), F.col("size"))).alias("held"),
        F.sum("size").alias("streamed"),
    )
    parts = lambda size, part: F.ceil(F.col(size) / part).cast("int")
    groups = groups.filter("outsiders >= 1 and members >= 2")
    groups = stored(groups.select("pivot", parts("held", HELD).alias("blocks"), parts("streamed", STREAMED).alias("chunks")), "groups")
    rows = rows.join(groups, "pivot")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int")
    seat = lambda b, c, held, streamed: F.struct(
        b.alias("block"), c.alias("chunk"), held.alias("held"), streamed.alias("streamed")
    )
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    yes, no = F.lit(True), F.lit(False)
    # An outsider is held in its block for all chunks, and streams past the other blocks.
    held = F.transform(upto("chunks"), lambda c: seat(block, c, yes, c == chunk))
    past = F.transform(upto("blocks"), lambda b: seat(b, chunk, no, yes))
    seats = F.when(F.col("outside"), F.concat(held, F.filter(past, lambda x: x["block"] != block))).otherwise(past)
    seated = rows.select("pivot", "node", "root", "outside", "distance", F.explode(seats).alias("s"))
    seated = seated.select("pivot", "s.block", "s.chunk", "s.held", "s.streamed", "node", "root", "outside", "distance")
    seated = seated.join(sets, "node").select(*seated.columns, "hashes")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seats, block = None, [], None
        for batch in source:
            found = []
            for *key, is_held, streams, node, root, outside, distance, hashes in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if key != at:
                    found += settle(seats)
                    at, seats, block = key, [], None
                values = np.frombuffer(hashes, np.uint64)
                if is_held:
                    seats.append((node, root, distance, values, streams))
                    continue
                if block is None:
                    block = Block(*(list(c) for c in list(zip(*seats, strict=True))[:4])) if seats else None
                    found += settle(seats, block)
                    seats = []
                if block is not None:
                    found += block.links(node, root, outside, distance, values)
            if found:
                low, high = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["low", "high"])
        if last := settle(seats):
            low, high = zip(*last, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["low", "high"])

    def settle(seats: list[tuple], block: Block | None = None) -> list[tuple[int, int]]:
        """Links among the held ones that stream, too."""
        if not seats:
            return []
        block = block or Block(*(list(c) for c in list(zip(*seats, strict=True))[:4]))
        return [x for node, root, distance, values, streams in seats if streams for x in block.links(node, root, True, distance, values)]

    ordered = seated.repartition("pivot", "block", "chunk").sortWithinPartitions("pivot", "block", "chunk", F.col("held").desc())
    return ordered.mapInArrow(batches, "low long, high long")


def _flat(parents: DataFrame) -> DataFrame:
    """Roots of a forest: (node, root) from (node, parent), by pointer jumping."""
    at = stored(parents.select("node", F.col("parent").alias("root")), "parents")
    while True:
        over = at.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = stored(at.join(over, "root", "left").select("node", "root", "above"), "parents")
        at = jumped.select("node", F.coalesce("above", "root").alias("root"))
        if jumped.filter(F.col("above").isNotNull()).isEmpty():
            return at


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component for each node that isn't it.

    Every node hooks to its smallest smaller neighbour, the trees are flattened, the links
    between trees are links of their roots, and so on until none is left.
    """
    edges = stored(links.select("low", "high").distinct(), "links")
    roots = None
    while not edges.isEmpty():
        hooked = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("parent"))
        flat = stored(_flat(hooked), "roots")
        edges = stored(_ends_at_roots(edges, flat).distinct(), "links")
        roots = flat if roots is None else stored(_combined(roots, flat), "roots")
    return links.select(F.col("high").alias("node"), F.col("low").alias("root")).limit(0) if roots is None else roots


def _combined(roots: DataFrame, later: DataFrame) -> DataFrame:
    """Roots after ``later`` gave some of them a root in turn."""
    over = later.select(F.col("node").alias("root"), F.col("root").alias("above"))
    moved = roots.join(over, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return moved.unionByName(later.join(roots, "node", "left_anti"))


def _ends_at_roots(edges: DataFrame, flat: DataFrame) -> DataFrame:
    edges = edges.select("low", "high")
    for end in ("low", "high"):
        over = flat.select(F.col("node").alias(end), F.col("root").alias("above"))
        edges = edges.join(over, end, "left").withColumn(end, F.coalesce("above", end)).drop("above")
    ends = F.array_sort(F.array("low", "high"))
    return edges.filter("low <> high").select(ends[0].alias("low"), ends[1].alias("high"))


def _with_root(rows: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    over = roots.select(F.col("node").alias(node), F.col("root").alias(name))
    return rows.join(over, node, "left").withColumn(name, F.coalesce(name, node))


def resolve(rows: DataFrame) -> DataFrame:
    """doc_id, locator, n_shingles, root, component_id of rows of doc_id, locator and text.

    ``root`` stands for the component and is null for empty sets; ``component_id`` is its
    smallest doc_id.
    """
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    sketched = stored(sketches(rows), "sketches")
    # All rows of a class have the same bands and size.
    classes = sketched.filter("set_digest is not null").groupBy("set_digest").agg(
        F.min("doc_id").alias("label"),
        F.min(F.struct(*LOCATOR)).alias("at"),
        F.any_value("bands").alias("bands"),
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    # Written tables, so that Spark shuffles both sides of a join for the join and can
    # split a bucket, a pivot or a class that many rows have.
    keyed = classes.select("node", F.explode("bands").alias("key"))
    buckets = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "buckets")
    members = stored(keyed.join(buckets, "key"), "members")
    # The more others a node meets, the better a pivot it is.
    weights = stored(members.groupBy("node").agg(F.sum("rows").alias("weight")), "weights")
    members = members.join(weights, "node").select("key", "node", "weight")
    pivots = members.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("best"))
    pivots = stored(pivots.select("key", F.col("best.node").alias("pivot")), "pivots")
    pairs = members.join(pivots, "key").filter("pivot <> node").select("pivot", "node").distinct()
    chosen = classes.join(weights, "node").select("node", "at.*")
    texts = rows.select(*LOCATOR, "text").join(chosen, LOCATOR).select("node", "text")
    sets = stored(shingle_sets(texts), "sets")

    met = stored(compared(stored(pairs, "pairs"), sets), "met")
    ends = lambda a, b: (F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    roots = components(met.filter("linked").select(*ends("pivot", "node")))
    roots = _combined(roots, components(cross_links(met, roots, sets)))

    at = stored(_with_root(classes.select("set_digest", "node", "label"), roots, "node", "root"), "class-roots")
    least = stored(at.groupBy("root").agg(F.min("label").alias("component_id")), "component-ids")
    at = stored(at.join(least, "root").select("set_digest", "root", "component_id"), "class-components")
    return sketched.drop("bands").join(at, "set_digest", "left").drop("set_digest")


def label(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    found = resolve(located(docs, ["doc_id", "text"]))
    # An empty set is a component of its own.
    found = found.withColumn("component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each component, all columns as they were."""
    names = LOCATOR
    while set(names) & set(docs.columns):
        names = [f"{n}_" for n in names]
    placed = located(docs, docs.columns, names)
    here = [F.col(own).alias(name) for own, name in zip(names, LOCATOR, strict=True)]
    found = stored(resolve(placed.select("doc_id", "text", *here)).filter("root is not null"), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", *LOCATOR)).alias("first")
    groups = found.groupBy("root").agg(first, F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    groups = stored(groups.select("root", *[F.col(f"first.{n}").alias(f"first_{n}") for n in LOCATOR]), "first-rows")
    stays = F.lit(True)
    for name in LOCATOR:
        stays &= F.col(name) == F.col(f"first_{name}")
    dropped = found.join(groups, "root").filter(~stays).select(*LOCATOR)
    same = [placed[own] == dropped[name] for own, name in zip(names, LOCATOR, strict=True)]
    return placed.join(dropped, same, "left_anti").drop(*names)
