"""Hard negatives by exact search in a GNAT-style multiway hyperplane tree.

For each anchor its nearest rows of the same label are positives, and for each positive the
best rows of other labels whose score lies in a window below the positive's are negatives.
A score is the inner product of whole numbers.

1. A tree is grown from a bounded sample. A node has several split points; a row goes to the
   nearest one (the bisecting hyperplanes part the children). All rows are dealt to leaves.
2. One pass over all rows finds, for each split point and each sibling, the range of the
   distances between the point and the sibling's rows, and the range of their norms.
3. A window of scores is an annulus of distances around an anchor, given the norms of a
   subtree. A sibling is left out if the annulus can't meet its range from any one of the
   split points. The lower end of a window is first raised to the k-th best score in the
   sample, which are rows like all others, so the true k-th best is no lower.
4. Leaves are packed into blocks of bounded size, and a leaf with more rows than that (equal
   vectors, say) into several. Anchors travel in packs to the blocks that are left, where
   every score is computed, so nothing is approximate. A block is held once, and the packs
   stream past it. Only each block's best rows go on.

Blocks get longer with the table up to a limit, so that up to some ten million rows no more
anchors travel than there are rows.

Edge cases: rows with a null id, label or vector or with a null or non-finite component take
no part. Shorter vectors have zeros at the end. An id that several rows have: each of them is
a row of its own, as anchor too. Anchors without positives, and positives without negatives,
give no rows; neither does an empty table. A negative positive score has an empty window.
Scores must fit 62 bits; the task fails otherwise. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardflow.llm.common import BATCH_ROWS, stored

POSITIVES = 5
NEGATIVES = 10
# A negative's score in percent of its positive's.
WINDOW_PERCENT = (30, 90)

# The sample the tree is grown from and bounds are taken from.
SAMPLE_ROWS = 4096
FANOUT = 16
LEAF_SAMPLE = 32
LEAST_BLOCK, MOST_BLOCK = 4096, 131_072
# Scores computed at a time.
CELLS = 1 << 22

_ROW = "n long, id long, label long, vec binary"


def matrix(vectors: list[bytes], width: int = 0) -> np.ndarray:
    """Packed vectors as rows, shorter ones with zeros at the end."""
    lengths = {len(v) for v in vectors}
    wide = max(lengths | {8 * width}) // 8
    if lengths == {8 * wide}:
        return np.frombuffer(b"".join(vectors)).reshape(len(vectors), wide)
    return np.frombuffer(b"".join(v.ljust(8 * wide, b"\0") for v in vectors)).reshape(len(vectors), wide)


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, max(0, width - rows.shape[1]))))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    width = max(a.shape[1], b.shape[1])
    a, b = widened(a, width), widened(b, width)
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    if largest < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if largest >= 2.0**62:
        raise OverflowError("scores don't fit 62 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], b.shape[1])
    a, b = widened(a, width), widened(b, width)
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0.0)


@dataclass
class Node:
    points: np.ndarray
    # For each split point a node (from 0 on) or a leaf (~leaf, below 0).
    children: list[int] = field(default_factory=list)
    # Ranges of distances from split point i to the rows of child j, and of squared norms.
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    norm_low: np.ndarray | None = None
    norm_high: np.ndarray | None = None


class Tree:
    def __init__(self, sample: np.ndarray):
        self.nodes: list[Node] = []
        self.leaves = 0
        self.root = self._grow(sample)

    def _grow(self, rows: np.ndarray) -> int:
        points = self._split_points(rows) if len(rows) > LEAF_SAMPLE else rows[:0]
        if len(points) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        at = len(self.nodes)
        node = Node(points)
        self.nodes.append(node)
        nearest = squared_distances(rows, points).argmin(1)
        node.children = [self._grow(rows[nearest == k]) for k in range(len(points))]
        return at

    @staticmethod
    def _split_points(rows: np.ndarray) -> np.ndarray:
        """Points far from each other: each is the farthest from those before it."""
        apart = squared_distances(rows, rows[:1])[:, 0]
        chosen = [0]
        while len(chosen) < FANOUT and apart.max() > 0:
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, squared_distances(rows, rows[chosen[-1:]])[:, 0])
        return rows[chosen]

    def paths(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each node that rows reach: node, the rows, their children, their squared distances."""
        waiting = [(self.root, np.arange(len(rows)))]
        while waiting:
            at, which = waiting.pop()
            if at < 0 or not len(which):
                continue
            distance = squared_distances(rows[which], self.nodes[at].points)
            child = distance.argmin(1)
            yield at, which, child, distance
            waiting += [(to, which[child == k]) for k, to in enumerate(self.nodes[at].children)]

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        found = np.zeros(len(rows), np.int64)
        for at, which, child, _ in self.paths(rows):
            found[which] = ~np.array(self.nodes[at].children)[child]
        return found

    def set_ranges(self, ranges: list) -> None:
        for node in self.nodes:
            m = len(node.points)
            node.low, node.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
            node.norm_low, node.norm_high = np.full(m, np.inf), np.full(m, -np.inf)
        for at, i, j, low, high in ranges:
            node = self.nodes[at]
            if i < 0:
                node.norm_low[j], node.norm_high[j] = low, high
            else:
                node.low[i, j], node.high[i, j] = np.sqrt(low), np.sqrt(high)

    def survivors(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether a leaf may hold a row with a score from ``least`` to ``most``, by anchor and leaf."""
        found = np.zeros((len(anchors), self.leaves), bool)
        own = (anchors * anchors).sum(1)
        waiting = [(self.root, np.flatnonzero(least <= most))]
        while waiting:
            at, which = waiting.pop()
            if not len(which):
                continue
            if at < 0:
                found[which, ~at] = True
                continue
            node = self.nodes[at]
            distance = np.sqrt(squared_distances(anchors[which], node.points))
            for j, child in enumerate(node.children):
                if not np.isfinite(node.norm_low[j]):
                    continue
                # score = (|a|^2 + |x|^2 - distance^2) / 2, so scores in the window are in this annulus.
                outer = np.sqrt(np.maximum(own[which] + node.norm_high[j] - 2 * least[which], 0))
                inner = np.sqrt(np.maximum(own[which] + node.norm_low[j] - 2 * most[which], 0))
                slack = 1e-6 * (1 + np.sqrt(own[which]) + np.sqrt(node.norm_high[j]))
                outer, inner = outer + slack, inner - slack
                low, high = node.low[:, j], node.high[:, j]
                meets = (distance - outer[:, None] <= high) & (distance + outer[:, None] >= low)
                meets &= distance + high >= inner[:, None]
                possible = own[which] + node.norm_high[j] - 2 * least[which] >= -slack
                waiting.append((child, which[meets.all(1) & possible]))
        return found


@dataclass
class Index:
    """What a search needs besides the rows; its size doesn't follow the table's."""

    tree: Tree
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # row numbers, labels, vectors
    first_block: np.ndarray  # of each leaf
    parts: np.ndarray  # blocks of a leaf that has several

    def blocks(self, leaves: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks that hold one of an anchor's leaves, and the anchors."""
        for first in np.unique(self.first_block).tolist():
            inside = self.first_block == first
            which = np.flatnonzero(leaves[:, inside].any(1))
            if len(which):
                for part in range(int(self.parts[inside].max())):
                    yield first + part, which


def prepared(rows: DataFrame, vector: str, scale: float) -> DataFrame:
    """n (a number of the row), id, label, vec: rows that take part, floor(scale * x) packed."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    part = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & whole)
    part = part.select(F.monotonically_increasing_id().alias("n"), "id", "label", F.col(vector).cast("array<double>").alias("x"))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            lists = batch.column(3)
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            # Zero has one form.
            flat = flat + 0.0
            bounds = np.append(0, lists.value_lengths().to_numpy(zero_copy_only=False).cumsum())
            packed = [flat[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], ["n", "id", "label", "vec"])

    return part.mapInArrow(batches, _ROW)


def fit(rows: DataFrame) -> tuple[Index, DataFrame]:
    """The index, and the rows with their ``block``."""
    sample = rows.orderBy(F.xxhash64("n"), "n").limit(SAMPLE_ROWS).collect()
    vectors = matrix([bytes(r.vec) for r in sample]) if sample else np.zeros((0, 0))
    tree = Tree(vectors)

    def assigned(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            leaf = tree.leaf_of(matrix(batch.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["n", "id", "label", "vec", "leaf"])

    def ranges(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int, int], tuple[float, float]] = {}

        def widen(key: tuple[int, int, int], values: np.ndarray) -> None:
            low, high = float(values.min()), float(values.max())
            before = seen.get(key, (low, high))
            seen[key] = min(before[0], low), max(before[1], high)

        for batch in source:
            part = matrix(batch.column(3).to_pylist())
            norms = (part * part).sum(1)
            for at, which, child, distance in tree.paths(part):
                for j in np.unique(child).tolist():
                    here = child == j
                    widen((at, -1, j), norms[which[here]])
                    for i in range(distance.shape[1]):
                        widen((at, i, j), distance[here, i])
        columns = list(zip(*((*key, *span) for key, span in seen.items()), strict=True)) or [()] * 5
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["node", "point", "child", "low", "high"])

    placed = stored(rows.mapInArrow(assigned, f"{_ROW}, leaf long"), "leaves")
    found = placed.drop("leaf").mapInArrow(ranges, "node long, point long, child long, low double, high double")
    found = found.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    tree.set_ranges([tuple(r) for r in found.collect()])

    counts = dict.fromkeys(range(tree.leaves), 0) | {r.leaf: r.rows for r in placed.groupBy("leaf").agg(F.count("*").alias("rows")).collect()}
    block_rows = min(MOST_BLOCK, max(LEAST_BLOCK, sum(counts.values()) // 100))
    first, parts, block, held = [], [], 0, 0
    for leaf in range(tree.leaves):
        if held and held + counts[leaf] > block_rows:
            block, held = block + 1, 0
        first.append(block)
        parts.append(max(1, -(-counts[leaf] // block_rows)))
        held += counts[leaf]
        if parts[-1] > 1:
            block, held = block + parts[-1], 0
    index = Index(tree, (np.array([r.n for r in sample], np.int64), np.array([r.label for r in sample], np.int64), vectors), np.array(first), np.array(parts))
    known = F.array(*[F.struct(F.lit(f).alias("first"), F.lit(p).alias("parts")) for f, p in zip(first, parts, strict=True)])
    place = rows.sparkSession.range(1).select(known.alias("places"))
    at = F.get(stored(place, "places").scalar(), F.col("leaf").cast("int"))
    block_of = at["first"] + F.pmod(F.xxhash64("n"), at["parts"]).cast("int")
    return index, placed.select("n", "id", "label", "vec", block_of.alias("block"))


def _kth_best(values: np.ndarray, allowed: np.ndarray, k: int, otherwise: np.ndarray) -> np.ndarray:
    """The k-th largest allowed value of each row, or ``otherwise`` where there are fewer."""
    if values.shape[1] < k:
        return otherwise
    lowest = np.iinfo(np.int64).min
    best = np.partition(np.where(allowed, values, lowest), values.shape[1] - k, axis=1)[:, -k]
    return np.maximum(otherwise, best)


def _search(rows: DataFrame, anchors: DataFrame, packs, best: int, same_label: bool, outputs: str) -> DataFrame:
    """Meet the packs of anchors with the blocks they go to.

    ``packs`` makes (block, pack) of an Arrow batch of anchors. A pack has the anchors' row
    numbers, labels, vectors, and for each window: its ends, and the columns that go with it.
    """

    def packed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if not batch.num_rows:
                continue
            for block, pack in packs(batch):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([pickle.dumps(pack)], pa.binary())], ["block", "pack"])

    def met(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for batch in source:
            for number, n, label_id, label, vec, pack in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != at:
                    at, held, block = number, [], None
                if pack is None:
                    held.append((label_id, n, label, vec))
                    continue
                if not held:
                    continue
                if block is None:
                    # By id, as of equal scores the smaller id comes first.
                    held.sort(key=lambda row: row[:2])
                    ids, ns, labels = (np.array(c, np.int64) for c in list(zip(*held, strict=True))[:3])
                    block = ids, ns, labels, matrix([r[3] for r in held])
                for columns in scored(pickle.loads(pack), *block):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def scored(pack: tuple, ids: np.ndarray, ns: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        own_n, own_label, own, wins = pack
        step = max(1, CELLS // len(ids))
        for start in range(0, len(own_n), step):
            part = slice(start, start + step)
            found = scores(own[part], vectors)
            allowed = own_label[part, None] == labels
            allowed = allowed & (own_n[part, None] != ns) if same_label else ~allowed
            for least, most, extra in wins:
                fits = allowed & (found >= least[part, None]) & (found <= most[part, None])
                row, column = np.nonzero(fits)
                value = found[row, column]
                order = np.lexsort((column, -value, row))
                row, column, value = row[order], column[order], value[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                take = place < best
                row, column, value = row[take], column[take], value[take]
                if len(row):
                    yield [own_n[part][row], *(e[part][row] for e in extra), ids[column], value]

    names = [f.split()[0] for f in outputs.split(", ")]
    sent = anchors.mapInArrow(packed, "block int, pack binary")
    columns = "block int, n long, id long, label long, vec binary, pack binary"
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in columns.split(", ")[1:5])]
    both = rows.select("block", "n", "id", "label", "vec", F.lit(None).cast("binary").alias("pack"))
    both = both.unionByName(sent.select("block", *nothing, "pack"))
    # A block's rows come before its packs.
    ordered = both.repartition("block").sortWithinPartitions("block", F.col("pack").isNotNull())
    return ordered.mapInArrow(met, outputs)


def positives(rows: DataFrame, anchors: DataFrame, index: Index, k: int = POSITIVES) -> DataFrame:
    """n, anchor_id, positive_id, positive_score: the best other rows of the same label."""

    def packs(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple]]:
        n, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        own = matrix(batch.column(3).to_pylist(), index.sample[2].shape[1])
        sample_n, sample_label, sample = index.sample
        like = scores(own, sample)
        allowed = (labels[:, None] == sample_label) & (n[:, None] != sample_n)
        bound = float(np.iinfo(np.int64).max // 4)
        least = _kth_best(like, allowed, k, np.full(len(n), int(-bound), np.int64))
        most = np.full(len(n), int(bound), np.int64)
        for block, which in index.blocks(index.tree.survivors(own, least, most)):
            yield block, (n[which], labels[which], own[which], [(least[which], most[which], [ids[which]])])

    outputs = "n long, anchor_id long, positive_id long, positive_score long"
    found = _search(rows, anchors, packs, k, True, outputs)
    order = W.partitionBy("n").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def negatives(rows: DataFrame, anchors: DataFrame, index: Index, k: int = NEGATIVES) -> DataFrame:
    """Of anchors with their positives (array of place, id, score): the best rows in the windows."""
    low, high = WINDOW_PERCENT

    def packs(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple]]:
        n, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        own = matrix(batch.column(3).to_pylist(), index.sample[2].shape[1])
        like = scores(own, index.sample[2])
        other = labels[:, None] != index.sample[1]
        given = [sorted((p["place"], p["id"], p["score"]) for p in x) for x in batch.column(4).to_pylist()]
        wins, leaves = [], np.zeros((len(n), index.tree.leaves), bool)
        for slot in range(max(map(len, given))):
            mine = [x[slot] if slot < len(x) else (slot + 1, 0, -1) for x in given]
            place, positive, score = (np.array(c, np.int64) for c in zip(*mine, strict=True))
            # Whole scores s with low * score <= 100 * s <= high * score.
            least, most = -((-low * score) // 100), (high * score) // 100
            inside = other & (like >= least[:, None]) & (like <= most[:, None])
            least = _kth_best(like, inside, k, least)
            leaves |= index.tree.survivors(own, least, most)
            wins.append((least, most, [ids, place, positive, score]))
        for block, which in index.blocks(leaves):
            part = [(least[which], most[which], [e[which] for e in extra]) for least, most, extra in wins]
            yield block, (n[which], labels[which], own[which], part)

    outputs = "n long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _search(rows, anchors, packs, k, False, outputs)
    order = W.partitionBy("n", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(table: DataFrame, anchor: Column, vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``table`` has vec_id, label and ``vector``; ``anchor`` says which rows are anchors, by
    ``vec_id`` as ``id``.
    """
    table.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    given = table.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), vector)
    index, rows = fit(stored(prepared(given, vector, scale), "vectors"))
    rows = stored(rows, "blocks")
    anchors = rows.filter(anchor).drop("block")
    found = stored(positives(rows, anchors, index), "positives")
    each = F.struct("place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    with_positives = anchors.join(found.groupBy("n").agg(F.collect_list(each).alias("positives")), "n")
    best = negatives(rows, with_positives.select("n", "id", "label", "vec", "positives"), index)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
