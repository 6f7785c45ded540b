"""Token counts of documents that are edited, without counting them anew.

A document keeps its pre-tokens as leaves of a segment tree, each with its number of
characters and of tokens; inner nodes have the sums. An edit replaces characters
[start, end) by a text. It finds the first leaf it touches by the sums of characters, takes
a few leaves before and after as boundary context, splits that stretch into pre-tokens
again, and looks for the place where old and new boundaries agree again; the stretch is
widened until they do. Only its leaves are encoded, and only the sums above them change.

Leaves are kept in blocks of about ``BLOCK`` (numpy arrays), and the tree stands on the
blocks, so that a leaf costs some bytes and an edit touches one or two blocks. Merges never
cross pre-tokens, so the sum of the leaves is the count of the text.

Edge cases: a null text counts as empty and has no tokens. Edits apply in order, each to the
text that the one before left; positions beyond the end mean the end, and start after end
means an insertion at start. An edit with a null text deletes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import arrow_map

BLOCK = 256
# Pre-tokens taken on either side of an edit. Look-ahead of the pattern reads one character
# beyond white space, so two are enough to agree again in nearly all cases.
CONTEXT = 2
KNOWN = 500_000


class Counter:
    """Counts the tokens of pre-tokens; those met before in a task are looked up."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def count(self, parts: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        for part in set(parts):
            if part not in known:
                known[part] = len(self.encoding._core_bpe.encode_single_piece(part.encode()))
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))


class Tree:
    """A document's pre-tokens with their characters and tokens, and the sums above them."""

    def __init__(self, text: str, counter: Counter):
        self.text = text
        self.counter = counter
        self.encoded = 0
        parts = counter.split(text)
        chars, tokens = self._leaves(parts)
        starts = range(0, len(parts), BLOCK)
        self.blocks = [(chars[i : i + BLOCK], tokens[i : i + BLOCK]) for i in starts] or [(chars, tokens)]
        self._build()
        self.encoded = 0

    def _leaves(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        self.encoded += len(parts)
        return np.fromiter(map(len, parts), np.int64, len(parts)), self.counter.count(parts)

    def _build(self) -> None:
        """Sums over the blocks: node n has the children 2n and 2n + 1."""
        self.width = 1 << max(0, len(self.blocks) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for n, block in enumerate(self.blocks):
            self.sums[self.width + n] = block[0].sum(), block[1].sum()
        for n in range(self.width - 1, 0, -1):
            self.sums[n] = self.sums[2 * n] + self.sums[2 * n + 1]

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    def _find(self, position: int) -> tuple[int, int, int]:
        """Block, leaf in it and start of the leaf that holds a character (the last at the end)."""
        position = min(position, int(self.sums[1, 0]) - 1)
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.sums[node, 0] <= position:
                before += int(self.sums[node, 0])
                node += 1
        block = node - self.width
        ends = before + np.cumsum(self.blocks[block][0])
        leaf = int(np.searchsorted(ends, position, "right"))
        return block, leaf, int(ends[leaf] - self.blocks[block][0][leaf])

    def _back(self, block: int, leaf: int, start: int, steps: int) -> tuple[int, int, int]:
        for _ in range(steps):
            if leaf == 0:
                block -= 1
                while block >= 0 and not len(self.blocks[block][0]):
                    block -= 1
                if block < 0:
                    return 0, 0, 0
                leaf = len(self.blocks[block][0])
            leaf -= 1
            start -= int(self.blocks[block][0][leaf])
        return block, leaf, start

    def edit(self, start: int, end: int, new: str | None) -> None:
        """Replace characters [start, end) by ``new``."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        text = self.text[:start] + (new or "") + self.text[end:]
        grown = len(text) - len(self.text)
        if not len(self.text) or not text:
            self.text = text
            parts = self.counter.split(text)
            self._replace(0, 0, len(self.blocks) - 1, len(self.blocks[-1][0]), parts)
            return
        block, leaf, first = self._back(*self._find(start), CONTEXT)
        reach = max(end, start + 1)
        context = 64
        while True:
            # Old boundaries after the edit, and new ones over the same stretch.
            last_block, last_leaf, last = self._find(min(reach + context, len(self.text)) - 1)
            last += int(self.blocks[last_block][0][last_leaf])
            whole = last == len(self.text)
            parts = self.counter.split(text[first : last + grown + (0 if whole else 64)])
            if whole:
                self.text = text
                self._replace(block, leaf, last_block, last_leaf + 1, parts)
                return
            ends = first + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            olds = self._ends(block, leaf, first, last_block, last_leaf)
            # Two ends in a row that agree: what follows is split as before.
            same = np.intersect1d(ends[ends >= start + len(new or "")], olds[olds >= end] + grown)
            pair = self._meeting(ends, olds + grown, same)
            if pair is not None:
                n, place = pair
                self.text = text
                b, x = self._place(block, leaf, place)
                self._replace(block, leaf, b, x, parts[: n + 1])
                return
            context *= 4

    def _ends(self, block: int, leaf: int, first: int, last_block: int, last_leaf: int) -> np.ndarray:
        lengths = [self.blocks[b][0] for b in range(block, last_block + 1)]
        lengths[-1] = lengths[-1][: last_leaf + 1]
        lengths[0] = lengths[0][leaf:]
        return first + np.cumsum(np.concatenate(lengths))

    @staticmethod
    def _meeting(ends: np.ndarray, olds: np.ndarray, same: np.ndarray) -> tuple[int, int] | None:
        """The first common end whose next two ends are common too, as places in both."""
        common = set(same.tolist())
        place = {e: n for n, e in enumerate(olds.tolist())}
        new = ends.tolist()
        for n in range(len(new) - CONTEXT):
            run = new[n : n + CONTEXT + 1]
            if all(e in common for e in run):
                at = place[run[0]]
                if olds[at : at + CONTEXT + 1].tolist() == run:
                    return n, at
        return None

    def _place(self, block: int, leaf: int, steps: int) -> tuple[int, int]:
        """The end of the leaf that is ``steps`` after the given one."""
        leaf += steps
        while leaf >= len(self.blocks[block][0]):
            leaf -= len(self.blocks[block][0])
            block += 1
        return block, leaf + 1

    def _replace(self, block: int, leaf: int, last_block: int, last_leaf: int, parts: list[str]) -> None:
        """Put leaves of ``parts`` in the place of a stretch, and change the sums above."""
        chars, tokens = self._leaves(parts)
        head, tail = self.blocks[block], self.blocks[last_block]
        made = tuple(np.concatenate([head[k][:leaf], (chars, tokens)[k], tail[k][last_leaf:]]) for k in (0, 1))
        self.blocks[block] = made
        for b in range(block + 1, last_block + 1):
            self.blocks[b] = (made[0][:0], made[1][:0])
        if len(made[0]) > 2 * BLOCK:
            cut = range(0, len(made[0]), BLOCK)
            self.blocks[block : block + 1] = [(made[0][i : i + BLOCK], made[1][i : i + BLOCK]) for i in cut]
            self._build()
            return
        for b in range(block, last_block + 1):
            node = self.width + b
            self.sums[node] = self.blocks[b][0].sum(), self.blocks[b][1].sum()
            while node > 1:
                node //= 2
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]


def count_edits(docs: DataFrame, edits: Column, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_after, n_pretokens, n_encoded, n_chars_after of each row.

    ``edits`` is an array of (start long, end long, text string). ``n_tokens`` and
    ``n_after`` count the text before and after all edits; ``n_encoded`` is the number of
    pre-tokens encoded for the edits. ``ranks_path`` must exist on every executor.
    """
    outputs = "n_tokens long, n_edits long, n_after long, n_pretokens long, n_encoded long, n_chars_after long"

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks_path, pattern)
        for batch in source:
            out = []
            for text, changes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tree = Tree(text or "", counter)
                before, leaves = tree.total, sum(len(b[0]) for b in tree.blocks)
                for e in changes or []:
                    tree.edit(e["start"] or 0, e["end"] or 0, e["text"])
                out.append((before, len(changes or []), tree.total, leaves, tree.encoded, len(tree.text)))
            columns = [pa.array([row[k] for row in out], pa.int64()) for k in range(6)]
            names = [x.split()[0] for x in outputs.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    rows = docs.select("doc_id", "text", edits.alias("edits"))
    return arrow_map(rows, ["doc_id", "text", "edits"], batches, outputs)


def own_edits(text: str = "text", id_column: str = "doc_id") -> Column:
    """Edits that follow from a document itself: an insertion, a replacement and a deletion.

    The places come from a hash of the id; the new text is taken from another place of the
    text, so words are cut and joined in the middle.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    size = F.length(given)
    place = lambda n: F.pmod(F.xxhash64(id_column, F.lit(n)), size + 1)
    piece = lambda n: F.substr(given, (place(n) + 1).cast("int"), F.lit(12))
    change = lambda start, length, new: F.struct(
        start.cast("long").alias("start"), (start + length).cast("long").alias("end"), new.alias("text")
    )
    return F.array(
        change(place(1), F.lit(0), piece(2)),
        change(place(3), F.lit(20), piece(4)),
        change(place(5), F.lit(7), F.lit("")),
    )
