"""SentencePiece encoding and decoding for vocabularies of the merge (BPE) type.

A text is turned into symbols, one per character. An agenda holds the adjacent pairs whose
concatenation is a piece. The pair with the highest score is merged, the leftmost of equal
ones first, and the pairs that the new symbol forms with its neighbours enter the agenda.
Short parts of a batch are merged side by side, an agenda in each row of a matrix; a long
part has a heap.
What no piece covers becomes byte pieces, or the unknown id without byte fallback.

No merge crosses a place that no piece spans: before a word mark (a space), between letters
and other characters, and around characters that occur in no longer piece. Texts are cut
there, and a part met before in a task is looked up, which changes no result. Which cuts a
vocabulary allows is found when it is loaded.

Each Arrow batch is checked against the sentencepiece library: the ids of every part that is
new to the task, and every decoded text that isn't the text itself; a difference fails the
task. Supported are models with identity normalisation.

Edge cases: a null text counts as empty. An empty text has the begin and end id only.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from cardflow.llm.common import arrow_map

MARK = "▁"
# Parts remembered between the batches of a task.
KNOWN_PARTS = 300_000
# Parts of up to so many symbols are merged together, so many at a time.
ROW_SYMBOLS = 40
ROWS = 4096
# The library gets so many parts in a line.
LINE_PARTS = 50
# Symbols are piece ids and, after them, characters.
SPAN = 1 << 21
NEVER = 1 << 62

OUTPUTS = "n_tokens long, ids array<int>, decoded string"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _one_mark_a_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


class Vocabulary:
    """Pieces, scores and byte ids of a model, with the encoder and decoder."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.size = size = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        self.special = {i for i in range(size) if lib.is_control(i) or lib.is_unknown(i)}
        self.bytes_of = {i: int(self.pieces[i][1:-1], 16) for i in range(size) if lib.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.bytes_of.items()}
        reserved = self.special | self.bytes_of.keys()
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in reserved}
        # The smaller, the earlier a pair is merged.
        self.rank = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.bos, self.eos, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        longer = [p for p in self.ids if len(p) > 1]
        joined = {c for p in longer for c in p}
        self.parts = re.compile("(?s).+")
        if not any(MARK in p.lstrip(MARK) for p in longer):
            inner = joined - {MARK}
            letters = {c for c in inner if c.isalpha()}
            if any((a in letters) != (b in letters) for p in longer for a, b in itertools.pairwise(p.lstrip(MARK))):
                letters = inner
            classes = ["".join(re.escape(c) for c in sorted(x)) for x in (letters, inner - letters) if x]
            self.parts = re.compile("|".join([f"{MARK}*[{c}]+" for c in classes] + [f"{MARK}+", f"[^{MARK}{''.join(classes)}]+"]))
        # A character of no longer piece keeps a part apart from the mark the library puts first.
        self.apart = next((c for c in "\n\t\x00" if c not in joined), None)
        surface = [p.replace(MARK, " ") for p in self.pieces]
        # Bytes of ASCII stand for themselves; others are joined to characters in decode().
        surface = [chr(b) if (b := self.bytes_of.get(i)) is not None and b < 128 else x for i, x in enumerate(surface)]
        self.surface: list[str | None] = [
            None if self.bytes_of.get(i, 0) > 127 else "" if i in self.special else x for i, x in enumerate(surface)
        ]
        self.surface[self.unknown] = " ⁇ "
        self.known: dict[str, tuple[int, ...]] = {}
        codecs.register_error("one_mark_a_byte", _one_mark_a_byte)
        self.pair_keys, self.pair_joins = self._pair_table(longer)
        if [lib.encode(" a  B.\n ")] != [x[1:-1] for x in self.encode([" a  B.\n "])]:
            raise ValueError("the model's normalisation isn't supported")

    def merge(self, parts: list[str]) -> list[list[int]]:
        """The symbols of parts: piece ids, and from ``self.size`` on characters of no piece."""
        out: list[list[int]] = [[]] * len(parts)
        order = sorted((k for k, p in enumerate(parts) if len(p) <= ROW_SYMBOLS), key=lambda k: len(parts[k]))
        for start in range(0, len(order), ROWS):
            rows = order[start : start + ROWS]
            for k, ids in zip(rows, self._merge_rows([parts[k] for k in rows]), strict=True):
                out[k] = ids
        for k, part in enumerate(parts):
            if len(part) > ROW_SYMBOLS:
                out[k] = [self._symbol(x) for x in self._merge_long(list(part))]
        return out

    def _symbol(self, text: str) -> int:
        return self.ids[text] if text in self.ids else self.size + ord(text)

    def _pair_table(self, longer: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pairs that a piece joins, sorted, and for each its rank and its piece."""
        level = {r: n for n, r in enumerate(sorted({self.rank[p] for p in longer}))}
        pairs = {}
        for p in longer:
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if (a in self.ids or len(a) == 1) and (b in self.ids or len(b) == 1):
                    pairs[self._symbol(a) * SPAN + self._symbol(b)] = (level[self.rank[p]] << 21) | self.ids[p]
        keys = np.array(sorted(pairs), np.int64)
        return np.append(keys, np.iinfo(np.int64).max), np.array([*(pairs[k] for k in keys.tolist()), NEVER])

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * SPAN + right
        place = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[place] == keys, self.pair_joins[place], NEVER)

    def _merge_rows(self, parts: list[str]) -> list[list[int]]:
        """Short parts, one in a row: each round merges the first best pair of every row's agenda."""
        length = np.array([len(p) for p in parts])
        width = int(length.max())
        points = np.frombuffer("".join(p.ljust(width, "\0") for p in parts).encode("utf-32-le"), "<u4")
        different, at = np.unique(points, return_inverse=True)
        symbols = np.array([self._symbol(chr(c)) for c in different.tolist()])[at].reshape(-1, width)
        agenda = self._joins(symbols[:, :-1], symbols[:, 1:])
        agenda[np.arange(1, width) >= length[:, None]] = NEVER
        done = np.zeros((len(parts), width), np.int64)
        left_of = length.copy()
        live = np.arange(len(parts))
        columns = np.arange(width)
        while True:
            going = agenda.min(1, initial=NEVER) < NEVER
            done[live[~going]] = symbols[~going]
            live, symbols, agenda = live[going], symbols[going], agenda[going]
            if not len(live):
                break
            row = np.arange(len(live))
            best = (agenda >> 21).argmin(1)
            symbols[row, best] = agenda[row, best] & ((1 << 21) - 1)
            moved = np.minimum(columns + (columns > best[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, moved, 1)
            agenda = np.take_along_axis(np.pad(agenda, ((0, 0), (0, 1)), constant_values=NEVER), moved, 1)[:, :-1]
            left_of[live] -= 1
            ends = left_of[live]
            # A shifted agenda still has the merged pair's entry, and old ones beside it.
            before = row[best > 0]
            agenda[before, best[before] - 1] = self._joins(symbols[before, best[before] - 1], symbols[before, best[before]])
            behind = row[best < width - 1]
            place = best[behind]
            right = self._joins(symbols[behind, place], symbols[behind, np.minimum(place + 1, width - 1)])
            agenda[behind, place] = np.where(place + 1 < ends[behind], right, NEVER)
        return [ids[:n] for ids, n in zip(done.tolist(), left_of.tolist(), strict=True)]

    def _merge_long(self, symbols: list[str]) -> list[str]:
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (pair := symbols[left] + symbols[right]) in self.rank:
                heapq.heappush(agenda, (self.rank[pair], left, right, len(pair)))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, length = heapq.heappop(agenda)
            # An entry is stale if either symbol has been merged since.
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != length:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s]

    def _ids(self, symbols: list[int]) -> tuple[int, ...]:
        if not symbols or max(symbols) < self.size:
            return tuple(symbols)
        found: list[int] = []
        for x in symbols:
            if x < self.size:
                found.append(x)
            elif self.byte_ids:
                found.extend(self.byte_ids[b] for b in chr(x - self.size).encode())
            elif not found or found[-1] != self.unknown:  # a run of unknown characters is one id
                found.append(self.unknown)
        return tuple(found)

    def learn(self, parts: set[str]) -> None:
        """Encode parts not met before and compare all of them with the library."""
        new = [p for p in parts if p not in self.known]
        ids = [self._ids(x) for x in self.merge(new)]
        self.known.update(zip(new, ids, strict=True))
        if self.apart is not None and new:
            ahead = self.library.encode(self.apart)
            starts = range(0, len(new), LINE_PARTS)
            lines = [self.apart.join(["", *new[i : i + LINE_PARTS]]) for i in starts]
            for i, given in zip(starts, self.library.encode(lines, num_threads=1), strict=True):
                own = [x for part in ids[i : i + LINE_PARTS] for x in (*ahead[1:], *part)]
                if given != ahead[:1] + own:
                    raise RuntimeError(f"ids of some of {new[i : i + LINE_PARTS]} differ from the library's")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, each with begin and end."""
        parts = [self.parts.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > KNOWN_PARTS:
            self.known.clear()
        self.learn(set().union(*parts))
        known = self.known.__getitem__
        return [[self.bos, *itertools.chain.from_iterable(map(known, p)), self.eos] for p in parts]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces joined to characters, the first mark dropped."""
        try:
            text = "".join(map(self.surface.__getitem__, ids))
        except TypeError:
            text = "".join(self._joined(ids))
        first = next((i for i in ids if i not in self.special or i == self.unknown), self.unknown)
        return text[1:] if self.pieces[first].startswith(MARK) else text

    def _joined(self, ids: list[int]) -> Iterator[str]:
        for is_byte, run in itertools.groupby(ids, self.bytes_of.__contains__):
            if is_byte:
                yield bytes(map(self.bytes_of.__getitem__, run)).decode(errors="one_mark_a_byte")
            else:
                yield from map(self.surface.__getitem__, run)

    def check(self, texts: list[str], ids: list[list[int]], decoded: list[str]) -> None:
        """Fail unless the library gives the same.

        The parts of the texts were compared in learn(); whole texts only where parts could
        not be. Texts that come back as they were are right, others are compared.
        """
        if self.apart is None and ids != self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1):
            raise RuntimeError("ids differ from the library's")
        odd = [k for k, (t, d) in enumerate(zip(texts, decoded, strict=True)) if t.replace(MARK, " ") != d]
        if odd and [decoded[k] for k in odd] != self.library.decode([ids[k] for k in odd], num_threads=1):
            raise RuntimeError("decoded texts differ from the library's")


def encode_documents(docs: DataFrame, model_path: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of every document; one row each, other columns are ignored.

    With ``digests`` the ids (little-endian unsigned 32-bit) and the decoded text are given
    as lowercase SHA-256, which keeps rows narrow. ``model_path`` must exist on every executor.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(model_path)
        kinds = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
        names = ["doc_id", "n_tokens", *kinds]
        for batch in source:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = words.encode(texts)
            decoded = [words.decode(x) for x in ids]
            words.check(texts, ids, decoded)
            columns = [batch.column(0), pa.array(map(len, ids), pa.int64())]
            if digests:
                columns += [
                    pa.array([hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                ]
            else:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return arrow_map(docs, ["doc_id", "text"], batches, DIGESTS if digests else OUTPUTS)
