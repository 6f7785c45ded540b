"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is split into pre-tokens by a pattern. The bytes of a pre-token form a linked list.
A bucket for each merge rank holds the positions whose pair has that rank, and a bitmap has
a bit for each bucket that isn't empty; a second bitmap has a bit for each word of the first
that isn't zero, and so on up to one word. Find-first-set from the top down gives the lowest
rank in as many steps as there are levels (three for 50,000 ranks), whatever the length of
the pre-token. The leftmost position of that bucket is merged, and the pairs of the new
symbol with its neighbours enter their buckets. Entries whose pair has changed since are
skipped when met, so nothing is ever searched for in a bucket. A pre-token of n bytes makes
at most 3n entries: megabytes without a space take time in proportion, but for the order
within buckets.

Short pre-tokens share one queue, side by side in one linked list that is cut between them:
the lowest rank is taken from many of them at once, the leftmost position of each. Pre-tokens
met before in a task are looked up; the memory for that is bounded in bytes, and long ones
aren't remembered. Tokens never cross pre-tokens, so neither changes a result.

Edge cases: a null text counts as empty and has no ids; its decoded text is empty. Repeated
and null ids are kept as they are, one row each. Other columns are ignored. A vocabulary
without one of the 256 bytes is refused.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cardflow.llm.common import arrow_map

WORD = 64
# Longer pre-tokens have a queue of their own and aren't remembered.
SHORT = 200
# Bytes of short pre-tokens that share a queue at a time.
TOGETHER = 4 << 20
# Characters of documents that are encoded together.
CHUNK = 4 << 20
# Buckets of fewer entries are emptied one by one.
FEW = 12
# Bytes of pre-tokens remembered in a task, and what one takes besides its own, roughly.
KNOWN_BYTES = 128 << 20
KNOWN_COST = 300

OUTPUTS = "n_tokens long, ids array<int>, decoded string"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Positions in buckets by rank; the lowest rank is found through levels of bitmaps."""

    def __init__(self, size: int):
        self.buckets: list[list[int]] = [[] for _ in range(size)]
        self.levels: list[list[int]] = []
        while True:
            size = -(-size // WORD)
            self.levels.append([0] * size)
            if size <= 1:
                break

    def _mark(self, rank: int) -> None:
        at = rank
        for level in self.levels:
            at, bit = divmod(at, WORD)
            before = level[at]
            level[at] = before | (1 << bit)
            if before:
                break

    def _clear(self, rank: int) -> None:
        at = rank
        for level in self.levels:
            at, bit = divmod(at, WORD)
            level[at] &= ~(1 << bit)
            if level[at]:
                break

    def first(self) -> int:
        """The lowest rank with a position, or -1."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = at * WORD + (word & -word).bit_length() - 1
        return at

    def push(self, rank: int, position: int) -> None:
        """Enter a position into a bucket that is a heap."""
        bucket = self.buckets[rank]
        if not bucket:
            self._mark(rank)
        heappush(bucket, position)

    def pop(self, rank: int) -> int:
        """The leftmost position of a bucket that is a heap."""
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            self._clear(rank)
        return position

    def extend(self, rank: int, positions: list[int]) -> None:
        """Enter positions in any order."""
        bucket = self.buckets[rank]
        if not bucket:
            self._mark(rank)
        bucket += positions

    def take(self, rank: int) -> list[int]:
        """All positions of a bucket, which is empty afterwards."""
        found, self.buckets[rank] = self.buckets[rank], []
        self._clear(rank)
        return found


class Vocabulary:
    """Tokens by rank, with the encoder and the decoder."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(size)
        # Rank of the merge of two ranks, by left * size + right.
        self.size = size
        self.joins = {
            left * size + right: rank
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None
            and (right := self.ranks.get(token[cut:])) is not None
        }
        keys = np.fromiter(self.joins, np.int64, len(self.joins))
        ranks = np.fromiter(self.joins.values(), np.int64, len(self.joins))
        order = keys.argsort()
        self.join_keys, self.join_ranks = np.append(keys[order], -1), np.append(ranks[order], -1)
        self.known: dict[str, list[int]] = {}
        self.known_bytes = 0

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of pairs of ids, -1 where there is none."""
        keys = left * self.size + right
        place = np.searchsorted(self.join_keys[:-1], keys)
        return np.where(self.join_keys[place] == keys, self.join_ranks[place], -1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token of any length, by a queue of its own."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The rank of the pair that starts at a position: entries of another rank are stale.
        rank_at = [-1] * n
        queue, joins, size = self.queue, self.joins.get, self.size

        def enter(left: int, right: int) -> None:
            rank = joins(ids[left] * size + ids[right], -1)
            rank_at[left] = rank
            if rank >= 0:
                queue.push(rank, left)

        for i in range(n - 1):
            enter(i, i + 1)
        while (rank := queue.first()) >= 0:
            left = queue.pop(rank)
            if rank_at[left] != rank:
                continue
            gone = after[left]
            ids[left] = rank
            ids[gone] = rank_at[gone] = -1
            following = after[left] = after[gone]
            if following < n:
                before[following] = left
                enter(left, following)
            else:
                rank_at[left] = -1
            if before[left] >= 0:
                enter(before[left], left)
        return [x for x in ids if x >= 0]

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of short pre-tokens, which share a queue."""
        if not pieces:
            return []
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = lengths.cumsum()
        n = int(ends[-1])
        owner = np.repeat(np.arange(len(pieces)), lengths)
        # Position n stands for none on either side.
        ids = np.append(self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n
        before[ends - lengths] = n
        rank_at = np.full(n + 1, -1)
        rank_at[:n] = np.where(after[:n] < n, self._joined(ids[:n], ids[after[:n]]), -1)
        queue, joins, size = self.queue, self.joins.get, self.size
        order = rank_at[:n].argsort(kind="stable")
        order = order[np.searchsorted(rank_at[order], 0) :]
        cuts = np.flatnonzero(np.diff(rank_at[order])) + 1
        for positions in np.split(order, cuts) if len(order) else []:
            queue.extend(int(rank_at[positions[0]]), positions.tolist())

        # The same memory, faster for single numbers.
        id_at, after_at, before_at, ranks = map(memoryview, (ids, after, before, rank_at))
        while (rank := queue.first()) >= 0:
            entries = queue.take(rank)
            if len(entries) < FEW:
                entries.sort()
                for k, p in enumerate(entries):
                    if ranks[p] != rank:
                        continue
                    gone = after_at[p]
                    following, previous = after_at[gone], before_at[p]
                    id_at[p] = rank
                    id_at[gone] = ranks[gone] = -1
                    after_at[p] = following
                    before_at[following] = p
                    lowest = rank
                    for left, right in ((p, following), (previous, p)):
                        if left < n:
                            ranks[left] = new = joins(id_at[left] * size + id_at[right], -1) if right < n else -1
                            if new >= 0:
                                queue.extend(new, [left])
                                lowest = min(lowest, new)
                    if lowest < rank:
                        if rest := entries[k + 1 :]:
                            queue.extend(rank, rest)
                        break
                continue
            # A position enters a bucket once, as symbols only grow.
            at = np.array(entries)
            at = at[rank_at[at] == rank]
            at.sort()
            if not len(at):
                continue
            # The leftmost of each pre-token; the next must wait, as a lower rank may arise.
            leftmost = np.append(True, owner[at[1:]] != owner[at[:-1]])
            if not leftmost.all():
                queue.extend(rank, at[~leftmost].tolist())
                at = at[leftmost]
            gone = after[at]
            following, previous = after[gone], before[at]
            ids[at] = rank
            ids[gone] = rank_at[gone] = -1
            after[at] = following
            before[following] = at
            has = previous < n
            left, right = np.concatenate([at, previous[has]]), np.concatenate([following, at[has]])
            new = np.where(right < n, self._joined(ids[left], ids[right]), -1)
            rank_at[left] = new
            enters = new >= 0
            for rank, p in zip(new[enters].tolist(), left[enters].tolist(), strict=True):
                queue.extend(rank, [p])
        stays = ids[:n] >= 0
        counts = np.bincount(owner[stays], minlength=len(pieces)).cumsum().tolist()
        flat = ids[:n][stays].tolist()
        return [flat[i:j] for i, j in zip([0, *counts], counts, strict=False)]

    def learn(self, parts: set[str]) -> dict[str, list[int]]:
        """Ids of pre-tokens, those not met before encoded together."""
        if self.known_bytes > KNOWN_BYTES:
            self.known.clear()
            self.known_bytes = 0
        known, found = self.known, {}
        group, group_bytes = [], 0

        def flush() -> None:
            merged = self.merge_many([p.encode() for p in group])
            known.update(zip(group, merged, strict=True))

        for part in parts:
            if part in known:
                continue
            raw = part.encode()
            if raw in self.ranks:
                known[part] = [self.ranks[raw]]
            elif len(raw) > SHORT:
                found[part] = self.merge(raw)
                continue
            else:
                group.append(part)
                group_bytes += len(raw)
                if group_bytes > TOGETHER:
                    flush()
                    group, group_bytes = [], 0
            self.known_bytes += KNOWN_COST + len(raw)
        flush()
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts."""
        parts = [self.split(t) for t in texts]
        long = self.learn(set().union(*parts))
        ids = self.known.__getitem__
        if long:
            ids = lambda part: self.known[part] if part in self.known else long[part]
        return [list(itertools.chain.from_iterable(map(ids, p))) for p in parts]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def chunks(texts: Iterator[str]) -> Iterator[list[str]]:
    """Texts in order, up to ``CHUNK`` characters together."""
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > CHUNK:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of every document, one row each.

    With ``digests`` the ids (decimal, joined by a space) and the decoded bytes are given as
    lowercase SHA-256, which keeps rows narrow. ``ranks_path`` must exist on every executor.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Nothing here makes cycles, and the collector would walk all remembered ids again and again.
        gc.disable()
        try:
            yield from encoded(source, Vocabulary(ranks_path, pattern))
        finally:
            gc.enable()

    def encoded(source: Iterator[pa.RecordBatch], words: Vocabulary) -> Iterator[pa.RecordBatch]:
        decimal = [str(k) for k in range(len(words.tokens))].__getitem__
        kinds = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
        for batch in source:
            counts, ids_out, decoded_out = [], [], []
            for texts in chunks(t.as_py() or "" for t in batch.column(1)):
                for ids in words.encode(texts):
                    decoded = words.decode(ids)
                    counts.append(len(ids))
                    if digests:
                        ids_out.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                        decoded_out.append(hashlib.sha256(decoded).hexdigest())
                    else:
                        ids_out.append(ids)
                        decoded_out.append(decoded.decode())
            kind = pa.string() if digests else pa.list_(pa.int32())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_out, kind)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(decoded_out, pa.string())], ["doc_id", "n_tokens", *kinds])

    return arrow_map(docs, ["doc_id", "text"], batches, DIGESTS if digests else OUTPUTS)
