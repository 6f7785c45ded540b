"""Boosted trees on binned columns, grown for many settings in the same passes over the rows.

The trees are those of MLlib's ``GBTClassifier`` (logistic loss, variance, whole rows and all
columns, bins as categories), and the result is its model. What differs is the way to them: rows are kept as blocks
of one byte per bin, a pass counts one level of a tree of every setting, only the smaller child
of a split is counted (its sibling is the rest of the parent).

Rows that no split has told apart yet share their gradients in every setting. As long as such
classes are few, sums over rows are made from counts of the classes' bins, and rows are read only
when a split parts a class. From the tree on where they would be too many, each level is a pass.
"""

from __future__ import annotations

import json
import math
import sys
import time
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.cloudpickle import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows counted at once, rows that keep a task busy, and most rows of a task.
BLOCK_ROWS = 32_768
ROWS_A_TASK = 50_000
MOST_ROWS_A_TASK = 4_000_000
# Cells of a table of several columns, whose counts are made at once, and rows that make a
# cell worth it. Cells fit 16 bits.
JOINT_CELLS = 1_200
ROWS_A_CELL = 3
# Most classes of rows that trees are grown from, and rows that make a class worth its counts.
MOST_CLASSES = 1_024
ROWS_A_CLASS = 800
# Trees after which margins are made anew from the blocks, so that lineage stays short.
TREES_A_CHAIN = 25
# Bytes of counts that the driver adds up itself; more are added up by tasks first.
DRIVER_BYTES = 32 << 20
# A gain below this share of a node's mean square is rounding.
ROUNDING = 1e-12


@dataclass(frozen=True)
class Blocks:
    """Labels (ones first) and bins, one row of bytes per column, in blocks of rows."""

    rdd: RDD
    # Number of bins of each column, and of rows.
    bins: tuple[int, ...]
    rows: int

    def unpersist(self) -> None:
        self.rdd.unpersist()


def pack(df: DataFrame, label: str, binned: Sequence[str], bins: Sequence[int]) -> Blocks:
    """Blocks of ``df``, kept. Bins are whole numbers below those of ``bins``, at most 255."""
    known = F.when(F.col(label).isin(0, 1), F.col(label).cast("tinyint")).otherwise(
        F.raise_error(F.lit("a label to learn from must be 0 or 1"))
    )
    narrow = df.select(known.alias("_label"), *[F.col(c).cast("smallint") for c in binned])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.asarray(c).astype(np.uint8).tobytes() for c in batch.columns]
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [b"".join(columns)]})

    height = len(binned) + 1

    def merged(rows: Iterable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, n = [], 0
        for row in rows:
            held.append(np.frombuffer(row["bytes"], np.uint8).reshape(height, row["n"]))
            n += row["n"]
            if n >= BLOCK_ROWS:
                yield _block(held)
                held, n = [], 0
        if n:
            yield _block(held)

    packs = narrow.mapInArrow(packed, "n bigint, bytes binary").filter("n > 0").persist(StorageLevel.MEMORY_AND_DISK)
    n = packs.agg(F.sum("n")).first()[0]
    if not n:
        packs.unpersist()
        raise ValueError("no rows to learn from")
    cores = df.sparkSession.sparkContext.defaultParallelism
    # Each core has the same number of tasks, as a pass waits for the last one.
    tasks = min(math.ceil(n / ROWS_A_TASK), cores * math.ceil(n / (cores * MOST_ROWS_A_TASK)))
    rdd = packs.repartition(tasks).rdd.mapPartitions(merged).persist(StorageLevel.MEMORY_AND_DISK)
    rdd.count()
    packs.unpersist()
    return Blocks(rdd, tuple(bins), n)


def _block(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.concatenate(held, axis=1)
    rows = rows[:, np.argsort(1 - rows[0], kind="stable")]
    return np.ascontiguousarray(rows[0]), np.ascontiguousarray(rows[1:])


@dataclass
class Tree:
    """Nodes as columns: the column asked, 1 for each of its bins that leads right, and the
    children, left and right of each node. A leaf leads to itself."""

    width: int
    column: list[int] = field(default_factory=list)
    right: list[np.ndarray] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    stats: list[tuple[float, float, float, int]] = field(default_factory=list)

    def add(self, weight: float, total: float, square: float, count: int) -> int:
        node = len(self.column)
        self.column.append(0)
        self.right.append(np.zeros(self.width, np.uint8))
        self.child += [node, node]
        self.value.append(total / weight if weight > 0 else 0.0)
        self.gain.append(-1.0)
        self.stats.append((weight, total, square, count))
        return node

    def split(self, node: int, column: int, bins: np.ndarray, gain: float, left: int, right: int) -> None:
        """Rows with one of ``bins`` go left."""
        self.column[node], self.gain[node] = column, gain
        self.right[node][:] = 1
        self.right[node][bins] = 0
        self.child[2 * node : 2 * node + 2] = [left, right]

    def asked(self) -> set[int]:
        """The columns that splits ask."""
        return {column for node, column in enumerate(self.column) if self.child[2 * node] != node}

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.column), np.array(self.right, np.uint8).reshape(-1), np.array(self.child), np.array(self.value)


def _reached(bins: np.ndarray, tree: tuple, levels: int) -> np.ndarray:
    """The node of each row after ``levels`` steps from the root."""
    column, right, child, _ = tree
    n = bins.shape[1]
    if not levels:
        return np.zeros(n, np.int64)
    node = child.take(right.take(bins[column[0]]))
    flat, at = bins.reshape(-1), np.arange(n)
    starts, width = column * n, right.size // column.size
    for _ in range(levels - 1):
        node = child.take(2 * node + right.take(node * width + flat.take(starts.take(node) + at)))
    return node


def _added(parts: Iterable, steps: Sequence[tuple], keep: Sequence[int] | None) -> Iterator[tuple]:
    """Blocks with the margins of ``keep``, grown by trees: (margin, tree, levels, rate)."""
    for label, bins, *margins in parts:
        found = margins[0] if margins else np.zeros((1 + max(k for k, *_ in steps), label.size))
        for k, tree, levels, rate in steps:
            found[k] += rate * tree[3].take(_reached(bins, tree, levels))
        yield label, bins, found if keep is None else np.ascontiguousarray(found[keep])


def _groups(bins: Sequence[int]) -> list[tuple[int, ...]]:
    """Columns next to each other that are counted as one, as long as their cells are few."""
    groups, cells = [], JOINT_CELLS + 1
    for column, own in enumerate(bins):
        cells *= own + 1
        if cells > JOINT_CELLS:
            groups.append(())
            cells = own + 1
        groups[-1] += (column,)
    return groups


def _cell(rows: Sequence[np.ndarray], sizes: Sequence[int]) -> np.ndarray:
    """The cell of each row in the table of several columns of so many bins."""
    cell = rows[0]
    for row, size in zip(rows[1:], sizes[1:]):
        cell = np.multiply(cell, size, dtype=np.uint16)
        cell += row
    return cell


def _counts(at: np.ndarray, weighted: np.ndarray, ones: int, size: int, root: bool) -> Iterator[np.ndarray]:
    """Sums, zeros and ones of each cell. Those of the root are sums only, as its rows stay the same."""
    yield np.bincount(at, weighted, size)
    if not root:
        yield np.bincount(at[ones:], minlength=size)
        yield np.bincount(at[:ones], minlength=size)


def _counted(parts: Iterable, jobs: Sequence[tuple], numbers: Sequence[int], width: int) -> Iterator[list[np.ndarray]]:
    """Per job and slot of a node: totals, and for each bin of each column sum, zeros and ones.

    A table of several columns takes one count where each column would take its own. It is
    used where there are some rows for each of its cells, and added up by column at the end.
    """
    columns, sizes, groups = len(numbers), [n + 1 for n in numbers], _groups(numbers)
    bins_of = [np.zeros((3, columns, job[4] * width)) for job in jobs]
    totals = [np.zeros((2, job[4])) for job in jobs]
    tables: list[dict[tuple[int, ...], np.ndarray]] = [{} for _ in jobs]
    for label, bins, *margins in parts:
        sign = 2.0 * label - 1
        cells = [_cell([bins[c] for c in group], [sizes[c] for c in group]) for group in groups]
        for (k, heavy, tree, slot_of, slots, levels, root), sums, total, table in zip(jobs, bins_of, totals, tables):
            target = sign
            if margins:
                with np.errstate(over="ignore"):
                    target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margins[0][k]))
            ones, chosen = int(label.sum()), None
            if levels:
                slot = slot_of.take(_reached(bins, tree, levels))
                chosen = np.flatnonzero(slot >= 0)
                ones = int(np.searchsorted(chosen, ones))
                slot, target = slot.take(chosen), target.take(chosen)
            weighted = target.copy()
            weighted[:ones] *= heavy
            starts: dict[int, np.ndarray] = {}

            def counted(row: np.ndarray, size: int) -> Iterator[np.ndarray]:
                at = row
                if chosen is not None:
                    if size not in starts:
                        starts[size] = slot * size
                    at = starts[size] + row.take(chosen)
                return _counts(at, weighted, ones, slots * size, root)

            if chosen is None:
                total[0] += weighted.sum()
                total[1] += weighted.dot(target)
            else:
                total[0] += np.bincount(slot, weighted, slots)
                total[1] += np.bincount(slot, weighted * target, slots)
            for group, cell in zip(groups, cells):
                size = math.prod(sizes[c] for c in group)
                if len(group) > 1 and ROWS_A_CELL * slots * size <= target.size:
                    found = table.setdefault(group, np.zeros((3, slots * size)))
                    for which, part in enumerate(counted(cell, size)):
                        found[which] += part
                else:
                    for c in group:
                        for which, part in enumerate(counted(bins[c], width)):
                            sums[which, c] += part
    for job, sums, table in zip(jobs, bins_of, tables):
        for group, found in table.items():
            found = found.reshape(3, job[4], *[sizes[c] for c in group])
            for k, c in enumerate(group):
                others = tuple(2 + i for i in range(len(group)) if i != k)
                sums[:, c].reshape(3, job[4], width)[..., : sizes[c]] += found.sum(axis=others)
    yield [x for pair in zip(bins_of, totals) for x in pair]


def _sum(rdd: RDD, jobs: Sequence[tuple], numbers: Sequence[int], width: int) -> list[np.ndarray]:
    size = 24 * len(numbers) * width * sum(job[4] for job in jobs) * rdd.getNumPartitions()
    counted = rdd.mapPartitions(lambda parts: _counted(parts, jobs, numbers, width))
    return counted.treeReduce(lambda a, b: [x + y for x, y in zip(a, b)], 1 if size <= DRIVER_BYTES else 2)


class _Growing:
    """One tree of one setting, level by level."""

    def __init__(
        self, margin: int, depth: int, heavy: float, columns: int, width: int, root: np.ndarray | None = None
    ):
        self.margin, self.depth, self.heavy = margin, depth, heavy
        # Zeros and ones of the root, once a tree has counted them.
        self.root = root
        self.columns, self.width = columns, width
        self.tree, self.levels = Tree(width), 0
        # Splits whose smaller child is to be counted: it, its sibling, the parent and its counts.
        self.asked: list[tuple[int, int, int, np.ndarray]] = []

    def open(self) -> bool:
        return bool(self.levels == 0 or self.asked)

    def job(self) -> tuple:
        nodes = np.full(max(1, len(self.tree.column)), -1)
        nodes[[smaller for smaller, *_ in self.asked]] = np.arange(len(self.asked))
        known = self.levels == 0 and self.root is not None
        return self.margin, self.heavy, self.tree.arrays(), nodes, max(1, len(self.asked)), self.levels, known

    def take(self, sums: np.ndarray, totals: np.ndarray) -> None:
        found = sums.reshape(3, self.columns, -1, self.width).transpose(2, 0, 1, 3)
        nodes: list[tuple[int, np.ndarray]] = []
        if self.levels == 0:
            if self.root is None:
                self.root = found[0, 1:].copy()
            found[0, 1:] = self.root
            zeros, ones = found[0, 1:, 0].sum(axis=1)
            weight = float(zeros + self.heavy * ones)
            self.tree.add(weight, float(totals[0, 0]), float(totals[1, 0]), int(zeros + ones))
            nodes.append((0, found[0]))
        stats = self.tree.stats
        for (smaller, sibling, parent, whole), counts, square in zip(self.asked, found, totals[1].tolist()):
            for node, share in ((smaller, square), (sibling, max(0.0, stats[parent][2] - square))):
                stats[node] = *stats[node][:2], share, stats[node][3]
            nodes += [(smaller, counts), (sibling, whole - counts)]
        self.asked, self.levels = [], self.levels + 1
        if self.levels <= self.depth and nodes:
            self._split(nodes)

    def _split(self, nodes: list[tuple[int, np.ndarray]]) -> None:
        found = np.stack([counts for _, counts in nodes])
        weigh = lambda side: side[:, 1] + self.heavy * side[:, 2]
        # The best set of bins is a beginning of those in the order of their means.
        with np.errstate(divide="ignore", invalid="ignore"):
            means = np.where(weigh(found) > 0, found[:, 0] / weigh(found), np.inf)
        order = np.argsort(means, axis=2, kind="stable")
        left = np.cumsum(np.take_along_axis(found, order[:, None], axis=3), axis=3)[..., :-1]
        whole = np.stack([counts[:, 0].sum(axis=1) for _, counts in nodes])[:, :, None, None]
        right = whole - left
        wl, wr, w = weigh(left), weigh(right), weigh(whole)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = (left[:, 0] ** 2 / wl + right[:, 0] ** 2 / wr - whole[:, 0] ** 2 / w) / w
        gains[~((wl > 0) & (wr > 0))] = -1.0
        for k, (node, counts) in enumerate(nodes):
            column, cut = np.unravel_index(np.argmax(gains[k]), gains[k].shape)
            gain, (weight, _, square, _) = gains[k, column, cut], self.tree.stats[node]
            if not gain > ROUNDING * square / max(weight, sys.float_info.min):
                continue
            pair = []
            for side, heft in ((left, wl), (right, wr)):
                total, zeros, ones = (float(x) for x in side[k, :, column, cut])
                # Squares are known when a node is counted, which the last ones need not be.
                pair.append(self.tree.add(float(heft[k, column, cut]), total, math.nan, int(zeros + ones)))
            self.tree.split(node, int(column), order[k, column, : cut + 1], float(gain), *pair)
            if self.levels < self.depth:
                small = sorted(pair, key=lambda child: self.tree.stats[child][3])
                self.asked.append((*small, node, counts))


def _class_nodes(label: np.ndarray, bins: np.ndarray, tree: tuple) -> np.ndarray:
    """The leaf of each row in the tree of classes, whose first two nodes are zeros and ones."""
    column, right, child, _ = tree
    n, width, flat = label.size, right.size // column.size, bins.reshape(-1)
    node, at = label.astype(np.int64), np.arange(label.size)
    while True:
        here = node.take(at)
        on = np.flatnonzero(child.take(2 * here) != here)
        if not on.size:
            return node
        here, at = here.take(on), at.take(on)
        node[at] = child.take(2 * here + right.take(here * width + flat.take(column.take(here) * n + at)))


def _class_counts(blocks: Blocks, tree: Tree, leaves: Sequence[int]) -> np.ndarray:
    """Rows of each bin of each column in some leaves of the tree of classes."""
    columns, width, slots, arrays = len(blocks.bins), tree.width, len(leaves), tree.arrays()
    slot_of = np.full(len(tree.column), -1)
    slot_of[list(leaves)] = np.arange(slots)

    def counted(parts: Iterable) -> Iterator[np.ndarray]:
        found = np.zeros((columns, slots * width), np.int64)
        for label, bins in parts:
            slot = slot_of.take(_class_nodes(label, bins, arrays))
            chosen = np.flatnonzero(slot >= 0)
            starts = slot.take(chosen) * width
            for row, sums in zip(bins, found):
                sums += np.bincount(starts + row.take(chosen), minlength=slots * width)
        yield found

    size = 8 * columns * slots * width * blocks.rdd.getNumPartitions()
    found = blocks.rdd.mapPartitions(counted).treeReduce(lambda a, b: a + b, 1 if size <= DRIVER_BYTES else 2)
    return found.reshape(columns, slots, width).transpose(1, 0, 2).astype(float)


class _Classes:
    """Classes of rows: of one label, and sent the same way by every split so far of every setting."""

    def __init__(self, blocks: Blocks, settings: int, most: int):
        self.blocks, self.most = blocks, most
        # How a row finds its class, which is a leaf of this tree.
        self.tree = Tree(max(blocks.bins) + 1)
        self.leaves = np.array([self._leaf(), self._leaf()])
        self.ones = np.array([False, True])
        self.margins = np.zeros((settings, 2))
        # Rows by class, column and bin.
        self.bins = _class_counts(blocks, self.tree, self.leaves)

    def _leaf(self) -> int:
        return self.tree.add(0.0, 0.0, 0.0, 0)

    def _sent(self, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        """The node that each class reaches, and whether the split there parts it."""
        node, parted = np.zeros(len(self.leaves), np.int64), np.zeros(len(self.leaves), bool)
        if not tree.column:
            return node, parted
        column, right, child, _ = tree.arrays()
        right, at = right.reshape(-1, tree.width), np.arange(len(self.leaves))
        while True:
            at = at[child[2 * node[at]] != node[at]]
            if not at.size:
                return node, parted
            here = node[at]
            rows = self.bins[at, column[here]]
            rightwards, whole = (rows * right[here]).sum(axis=1), rows.sum(axis=1)
            parted[at] = (rightwards > 0) & (rightwards < whole)
            at, here, rightwards = (x[~parted[at]] for x in (at, here, rightwards))
            node[at] = child[2 * here + (rightwards > 0)]

    def settle(self, trees: Sequence[Tree]) -> list[np.ndarray] | None:
        """The node of each class in each tree, with classes parted until no split parts one.

        None where they would be too many.
        """
        while True:
            sent = [self._sent(tree) for tree in trees]
            # A class is parted by one split at a time; others may not part what is left of it.
            asked: dict[int, tuple[int, np.ndarray]] = {}
            for tree, (node, parted) in zip(trees, sent):
                for k in np.flatnonzero(parted).tolist():
                    asked.setdefault(k, (tree.column[node[k]], tree.right[node[k]]))
            if not asked:
                return [node for node, _ in sent]
            if len(self.leaves) + len(asked) > self.most:
                return None
            self._part(asked)

    def _part(self, asked: dict[int, tuple[int, np.ndarray]]) -> None:
        old, smaller, larger = list(asked), [], []
        for k, (column, right) in asked.items():
            pair = self._leaf(), self._leaf()
            self.tree.split(self.leaves[k], column, np.flatnonzero(right == 0), 0.0, *pair)
            rows = self.bins[k, column]
            small = int(2 * rows.dot(right) <= rows.sum())
            smaller.append(pair[small])
            larger.append(pair[1 - small])
        counts = _class_counts(self.blocks, self.tree, smaller)
        self.bins[old] -= counts
        self.bins = np.concatenate([self.bins, counts])
        self.leaves[old] = larger
        self.leaves = np.concatenate([self.leaves, smaller])
        self.ones = np.concatenate([self.ones, self.ones[old]])
        self.margins = np.concatenate([self.margins, self.margins[:, old]], axis=1)

    def counted(self, job: tuple, node: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """What ``_counted`` finds for the job, given the node of each class."""
        k, heavy, _, slot_of, slots, levels, _ = job
        sign = 2.0 * self.ones - 1
        target = sign
        if not first:
            with np.errstate(over="ignore"):
                target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * self.margins[k]))
        slot = slot_of.take(node) if levels else node
        chosen = np.flatnonzero(slot >= 0)
        within = np.zeros((slots, len(slot)))
        within[slot[chosen], chosen] = 1.0
        weighted = np.where(self.ones, heavy, 1.0) * target
        shares = np.stack([within * weighted, within * ~self.ones, within * self.ones])
        sums = (shares @ self.bins.reshape(len(slot), -1)).reshape(3, slots, *self.bins.shape[1:])
        rows = self.bins[:, 0].sum(axis=1)
        totals = np.stack([within @ (weighted * rows), within @ (weighted * target * rows)])
        return sums.transpose(0, 2, 1, 3).reshape(3, self.bins.shape[1], -1), totals


def _by_classes(blocks: Blocks, settings: Sequence) -> list[list[Tree]]:
    """The first trees of each setting, as long as classes of rows are few."""
    done: list[list[Tree]] = [[] for _ in settings]
    most = min(MOST_CLASSES, blocks.rows // ROWS_A_CLASS)
    if most < 2:
        return done
    classes = _Classes(blocks, len(settings), most)
    for t in range(max(s.trees for s in settings)):
        growing = [
            _Growing(k, s.max_depth, s.positive_weight, len(blocks.bins), classes.tree.width)
            for k, s in enumerate(settings)
            if s.trees > t
        ]
        while asked := [g for g in growing if g.open()]:
            nodes = classes.settle([g.tree for g in asked])
            if nodes is None:
                return done
            for g, node in zip(asked, nodes):
                g.take(*classes.counted(g.job(), node, t == 0))
        for g in growing:
            done[g.margin].append(g.tree)
        more = [g for g in growing if settings[g.margin].trees > t + 1]
        nodes = classes.settle([g.tree for g in more])
        if nodes is None:
            return done
        for g, node in zip(more, nodes):
            rate = settings[g.margin].learning_rate if t else 1.0
            classes.margins[g.margin] += rate * np.array(g.tree.value)[node]
    return done


def grow(blocks: Blocks, settings: Sequence) -> list[list[Tree]]:
    """The trees of each setting (``max_depth``, ``learning_rate``, ``trees``, ``positive_weight``).

    The first tree learns the labels as -1 and 1, each later one the gradient of the loss.
    """
    done = _by_classes(blocks, settings)
    begun = max(map(len, done))
    # A value without a bin, which Bucketizer may keep, is one more.
    columns, width, root = len(blocks.bins), max(blocks.bins) + 1, None
    state, kept, chained = blocks.rdd, list(range(len(settings))), 0

    def step(margin: int, k: int, t: int) -> tuple:
        rate = 1.0 if t == 0 else settings[k].learning_rate
        return margin, done[k][t].arrays(), settings[k].max_depth, rate

    try:
        for t in range(begun, max(s.trees for s in settings)):
            live = [k for k in kept if settings[k].trees > t]
            old = state
            if t:
                steps = [step(i, k, t - 1) for i, k in enumerate(kept) if k in live]
                keep = [i for i, k in enumerate(kept) if k in live]
                chained += 1
                if chained == TREES_A_CHAIN or t == begun:
                    chained, keep = 0, None
                    steps = [step(i, k, before) for before in range(t) for i, k in enumerate(live)]
                source = blocks.rdd if t == 1 or keep is None else state
                adding = lambda parts, steps=steps, keep=keep: _added(parts, steps, keep)
                state, kept = source.mapPartitions(adding).persist(StorageLevel.MEMORY_AND_DISK), live
            growing = [
                _Growing(i, settings[k].max_depth, settings[k].positive_weight, columns, width, root)
                for i, k in enumerate(kept)
            ]
            while asked := [g for g in growing if g.open()]:
                found = _sum(state, [g.job() for g in asked], blocks.bins, width)
                for g, sums, totals in zip(asked, found[::2], found[1::2]):
                    g.take(sums, totals)
                if old is not state and old is not blocks.rdd:
                    old.unpersist()
                    old = state
            for k, g in zip(kept, growing):
                done[k].append(g.tree)
            root = growing[0].root
    finally:
        if state is not blocks.rdd:
            state.unpersist()
    return done


_NODE = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>,"
    " rawCount bigint, gain double, leftChild int, rightChild int,"
    " split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def _nodes(tree: Tree, bins: Sequence[int]) -> Iterator[tuple]:
    """Nodes as MLlib stores them: numbered before their children, left before right."""
    order, stack = [], [0]
    while stack:
        node = stack.pop()
        order.append(node)
        left, right = tree.child[2 * node : 2 * node + 2]
        if left != node:
            stack += [right, left]
    number = {node: k for k, node in enumerate(order)}
    for node in order:
        left, right = tree.child[2 * node : 2 * node + 2]
        weight, total, square, count = tree.stats[node]
        impurity = (square - total * total / weight) / weight if weight > 0 else 0.0
        ends, split = (-1, -1), (-1, [], -1)
        if left != node:
            column = tree.column[node]
            lefts = np.flatnonzero(tree.right[node] == 0).astype(float).tolist()
            ends, split = (number[left], number[right]), (column, lefts, bins[column])
        yield number[node], tree.value[node], impurity, [weight, total, square], count, tree.gain[node], *ends, split


def to_model(
    spark: SparkSession, path: str, trees: Sequence[Tree], estimator: GBTClassifier, bins: Sequence[int]
) -> GBTClassificationModel:
    """The trees as MLlib's model, by way of its stored form under ``path``."""
    set_params = {p.name: v for p, v in estimator._paramMap.items()}
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items()}
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    whole = {
        **about,
        "class": "org.apache.spark.ml.classification.GBTClassificationModel",
        "uid": estimator.uid,
        "paramMap": set_params,
        "defaultParamMap": defaults,
        "numFeatures": len(bins),
        "numTrees": len(trees),
    }
    one = {
        **about,
        "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel",
        "paramMap": {k: set_params[k] for k in ("featuresCol", "labelCol", "maxDepth")},
        "defaultParamMap": {},
    }
    rates = [1.0, *[estimator.getStepSize()] * (len(trees) - 1)]
    each = [(k, json.dumps({**one, "uid": f"{estimator.uid}_{k}"}), rate) for k, rate in enumerate(rates)]
    nodes = [(k, node) for k, tree in enumerate(trees) for node in _nodes(tree, bins)]
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, _NODE).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
