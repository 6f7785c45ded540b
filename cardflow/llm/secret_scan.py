"""Secrets in texts, also inside nested encodings.

The worklist starts with the text. Each layer is scanned with the patterns, then searched
for encoded regions: URL escapes, Unicode escapes (backslash and character references),
base64, and compressed bytes (gzip, zlib, bzip2, xz, zstandard) inside any of them. Base64
may have line breaks, and other letters before it: all four alignments of a run are decoded.
Bytes that are no text keep their place among those that are. Every region that decodes to a
stretch of text that can hold a secret is a new layer, until no layer gives another.

Each layer knows for every character the span of the original text that it comes from. A
layer with a text and places that were met before in the document isn't opened again, so
work grows with the number of different layers, not of the ways that lead to them; nor is
one whose text a layer around it has, so cycles end (an archive can contain itself).
Layers are opened depth first, and only the chain to the layer at work is held. The spans of
a decoded layer are added; those of the text itself stay.

Spans are whole matches in code points, end exclusive, and leftmost without overlap for
each kind; matches that are too short are dropped afterwards.

Edge cases: a null text counts as empty. Several layers may lead to one span, which is
listed once. Compressed content longer than ``PIECE`` is unpacked and scanned in pieces that
overlap by ``OVERLAP``, each a layer of its own, so memory stays bounded and nothing is
skipped. Compressed content inside it is unpacked from its pieces as they come, so
``n_unopened`` is 0. Texts of any length are scanned whole.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import arrow_map

# The patterns, the group that is measured, and its least length.
KINDS = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        6,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
ORDER = {kind: n for n, kind in enumerate(KINDS)}
# The same matches of hex, found faster: a run starts where no hex digit is before it.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

# Compressed content is unpacked at once up to so many bytes, and else in such pieces. An
# encoded region inside pieces is found if it isn't longer than the overlap.
PIECE = 16 << 20
OVERLAP = 1 << 20
# Compressed bytes that are unpacked at a time, and bytes of blocks of them.
STEP = 64
BLOCK_STEP = 1 << 10
_URL = re.compile(r"%[0-9A-Fa-f]{2}")
_URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&[A-Za-z]{2,8};"
)
# Bytes in string literals also have short escapes.
_BYTE = re.compile(_ESCAPE.pattern + r"|\\[abfnrtv\\'\"/]")
_SHORT = dict(zip("abfnrtv", "\a\b\f\n\r\t\v", strict=True))
# Line breaks, also as written in string literals, may split base64.
_BREAK = re.compile(r"\r?\n|(?:\\r)?\\n")
# A run of 16 letters and the lines after it, and a run of lines of four letters or more that
# starts with a shorter one. The second is tried only at line breaks between such letters.
_BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{16,}}(?:(?:{_BREAK.pattern})[A-Za-z0-9+/_-]+)*={{0,2}}")
_BASE64_LINES = re.compile(
    rf"[A-Za-z0-9+/_-]{{4,15}}(?:(?:{_BREAK.pattern})[A-Za-z0-9+/_-]{{4,}})+(?:(?:{_BREAK.pattern})[A-Za-z0-9+/_-]+)?={{0,2}}"
)
# Patterns that start with a fixed letter are searched for much faster.
_BASE64_BREAKS = [re.compile(r"\n(?=[A-Za-z0-9+/_-]{4})"), re.compile(r"\\n(?=[A-Za-z0-9+/_-]{4})")]
_BASE64_END = re.compile(r"[A-Za-z0-9+/_-]{4,16}\Z")
LEAST_LETTERS = 16
# What may stand around URL escapes.
_URL_TOKEN = re.compile(r"[^\s\"'<>&?#]*%[0-9A-Fa-f]{2}[^\s\"'<>&?#]*")
_URL_BYTE = re.compile(r"%([0-9A-Fa-f]{2})")
_MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")
_PACKED = re.compile(b"|".join(map(re.escape, _MAGIC)))
# The shortest match of a pattern has 12 characters, and no encoding of it is shorter.
_STRETCH = re.compile(r"[^\x00-\x08\x0b\x0c\x0e-\x1f\ud800-\udfff]{12}")

Span = tuple[int, int, str]


class Layer:
    """A decoded text, and for each of its characters the span it has in the original text."""

    def __init__(self, text: str, parent: Layer | None = None, pieces: list | None = None):
        self.text = text
        self.parent = parent
        self.digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        self.low = self.high = None
        if parent is None:
            return
        # (start here, start there, length here, length there), in order.
        start, there, own, outer = np.array(pieces, np.int64).reshape(-1, 4).T
        same = np.repeat(own == outer, own)
        first = np.repeat(there, own)
        low = np.where(same, first + np.arange(len(first)) - np.repeat(start, own), first)
        high = np.where(same, low, first + np.repeat(outer, own) - 1)
        self.low = low if parent.low is None else parent.low[low]
        self.high = high if parent.high is None else parent.high[high]

    def seen_before(self) -> bool:
        around = self.parent
        while around is not None:
            if around.digest == self.digest:
                return True
            around = around.parent
        return False

    def key(self) -> bytes:
        """Equal for layers of one text from the same places."""
        places = hashlib.blake2b(self.digest, digest_size=16)
        places.update(self.low.tobytes())
        places.update(self.high.tobytes())
        return places.digest()

    def original(self, start: int, end: int) -> tuple[int, int]:
        """The span of the original text that holds the span of this layer."""
        return int(self.low[start]), int(self.high[end - 1]) + 1


def scan(text: str) -> list[Span]:
    """(start, end, kind) of the matches in one text, by start, then kind."""
    found = []
    for kind, (pattern, group, least) in KINDS.items():
        quick = _LONG_HEX if kind == "hex" else pattern
        for m in quick.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]], s[1]))


_DECODERS = {
    b"\x1f\x8b": lambda: zlib.decompressobj(31),
    b"\x78": zlib.decompressobj,
    b"BZ": bz2.BZ2Decompressor,
    b"\xfd7": lzma.LZMADecompressor,
    b"\x28\xb5": lambda: zstandard.ZstdDecompressor(max_window_size=1 << 27).decompressobj(),
}
_BAD = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)


class _Part:
    """How much of its bytes a compressed part took, and whether it has a fault."""

    def __init__(self):
        self.used, self.fault = 0, False


def _unpacked(source: Iterator[bytes], part: _Part) -> Iterator[bytes]:
    """The content of compressed bytes, in pieces of ``PIECE``, the last one shorter.

    What follows the compressed part is ignored, and so is what follows a fault. The bytes
    go in ``STEP`` at a time, so what is kept before a fault doesn't depend on any length.
    """
    opened, waiting, size = None, [], 0
    for data in source:
        opened = opened or next((make for head, make in _DECODERS.items() if data.startswith(head)))()
        limit = (BLOCK_STEP,) if hasattr(opened, "needs_input") else ()
        for at in range(0, len(data), STEP):
            step = data[at : at + STEP]
            part.used += len(step)
            while not part.fault:
                try:
                    waiting.append(opened.decompress(step, *limit))
                except _BAD:
                    part.fault = True
                    break
                size += len(waiting[-1])
                while size >= PIECE:
                    held = b"".join(waiting)
                    yield held[:PIECE]
                    waiting, size = [held[PIECE:]], size - PIECE
                if opened.eof or getattr(opened, "needs_input", True):
                    break
                step = b""
            if opened.eof:
                part.used -= len(opened.unused_data)
            if opened.eof or part.fault:
                break
        else:
            continue
        break
    if size:
        yield b"".join(waiting)


def _content(data: bytes, depth: int, outer: _Part) -> Iterator[bytes]:
    """Bytes in pieces, unpacked ``depth`` times; ``outer`` tells of the first time."""
    pieces = iter((data,))
    for k in range(depth):
        pieces = _unpacked(pieces, _Part() if k else outer)
    return pieces


def _digest(pieces: Iterable[bytes]) -> bytes:
    digest = hashlib.blake2b(digest_size=16)
    for piece in pieces:
        digest.update(piece)
    return digest.digest()


def _readable(data: bytes) -> str | None:
    """Bytes as text with a lone surrogate for each bad byte; None where no secret has room."""
    text = data.decode(errors="surrogateescape")
    return text if _STRETCH.search(text) else None


def _texts_of(data: bytes) -> Iterator[tuple[str, int, bool]]:
    """Compressed bytes as texts, unpacked as often as they are compressed; their length, and
    whether that is without a fault.

    Contents of all lengths go the same way: each time in pieces, so memory stays bounded. What
    is compressed again is scanned too, as it may only begin like compressed bytes.
    """
    first = outer = _Part()
    # What is unpacked next is ``whole``, unpacked ``depth`` times.
    whole, depth, head, ended, seen = data, 0, data, True, {}
    while head.startswith(_MAGIC):
        alike = seen.setdefault((_digest((head,)), ended), [])
        if alike and (ended or _digest(_content(whole, depth, _Part())) in {_digest(_content(*a, _Part())) for a in alike}):
            break
        alike.append((b"", 0) if ended else (whole, depth))
        pieces = _content(whole, depth + 1, outer)
        if (inner := next(pieces, None)) is None:
            break
        head, depth = inner, depth + 1
        if ended := next(pieces, None) is None:
            # All of it is held, so the next time starts here.
            whole, depth, outer = inner, 0, _Part()
        elif whole is data and depth == 1:
            # The end of a long part is known when all of it was unpacked.
            first = _Part()
            for _ in _content(data, 1, first):
                pass
        tail, met = b"", set()
        for piece in _content(whole, depth, _Part()):
            digest = _digest((tail, piece))
            if digest not in met and (text := _readable(tail + piece)):
                yield text, first.used, not first.fault
            met.add(digest)
            tail = piece[-OVERLAP:]


def _packed_parts(data: bytes) -> Iterator[tuple[str, int, int]]:
    """Text, start and end of the compressed parts anywhere in ``data``.

    After a part with a fault the search goes on inside it.
    """
    done = 0
    for m in _PACKED.finditer(data):
        if m.start() < done:
            continue
        for text, used, sound in _texts_of(data[m.start() :]):
            if sound:
                done = m.start() + used
            yield text, m.start(), m.start() + used


def _replaced(layer: Layer, regions: list[tuple[int, int, str]]) -> Layer | None:
    """The whole layer with regions replaced by what they stand for."""
    if not regions:
        return None
    text, pieces, at, size = [], [], 0, 0
    for start, end, value in regions:
        if start > at:
            text.append(layer.text[at:start])
            pieces.append((size, at, start - at, start - at))
            size += start - at
        if value:
            text.append(value)
            pieces.append((size, start, len(value), end - start))
            size += len(value)
        at = end
    if at < len(layer.text):
        text.append(layer.text[at:])
        pieces.append((size, at, len(layer.text) - at, len(layer.text) - at))
    return Layer("".join(text), layer, pieces) if text else None


def _url_layers(layer: Layer) -> Iterator[Layer | None]:
    if "%" not in layer.text:
        return
    regions = []
    for m in _URL_RUN.finditer(layer.text):
        # Character by character, so that spans stay exact. Bytes of no character stay escaped.
        at = m.start()
        for c in bytes.fromhex(m.group().replace("%", "")).decode(errors="surrogateescape"):
            bad = "\ud800" <= c <= "\udfff"
            width = 3 if bad else 3 * len(c.encode())
            if not bad:
                regions.append((at, at + width, c))
            at += width
    for m in _URL_TOKEN.finditer(layer.text) if regions or _URL_BYTE.search(layer.text) else ():
        yield from _url_packed(layer, m.start(), m.group())
    yield _replaced(layer, regions)


def _url_packed(layer: Layer, origin: int, token: str) -> Iterator[Layer]:
    """Compressed bytes in a word with URL escapes; its plain letters stand for themselves."""
    data = _URL_BYTE.sub(lambda m: chr(int(m[1], 16)), token)
    if not data.isascii() and not all(ord(c) < 256 for c in data):
        return
    raw = data.encode("latin-1")
    if not _PACKED.search(raw):
        return
    starts, at = [], 0
    for m in _URL_BYTE.finditer(token):
        starts.extend(range(at, m.start() + 1))
        at = m.end()
    starts.extend(range(at, len(token) + 1))
    for text, start, end in _packed_parts(raw):
        first, last = starts[start], starts[end] if end < len(starts) else len(token)
        yield Layer(text, layer, [(0, origin + first, len(text), last - first)])


def _escaped_bytes(layer: Layer) -> Iterator[Layer]:
    """Compressed bytes that are written with escapes; plain letters stand for themselves."""
    values, starts, ends, at = [], [], [], 0

    def plain(until: int) -> None:
        values.extend(layer.text[at:until])
        starts.extend(range(at, until))
        ends.extend(range(at + 1, until + 1))

    for m in _BYTE.finditer(layer.text):
        found = m.group()
        if found[0] == "&":
            # The numbers themselves: html.unescape reads some of them as Windows letters.
            if found[1] != "#":
                value = html.unescape(found)
            else:
                point = int(found[3:-1], 16) if found[2] in "xX" else int(found[2:-1])
                value = chr(min(point, 0x10FFFF))
            if len(value) != 1:
                continue
        elif len(found) == 2:
            value = _SHORT.get(found[1], found[1])
        else:
            value = chr(min(int(found[2:].strip("{}"), 16), 0x10FFFF))
        plain(m.start())
        values.append(value)
        starts.append(m.start())
        ends.append(m.end())
        at = m.end()
    plain(len(layer.text))
    for run in re.finditer(r"[\x00-\xff]{8,}", "".join(values)):
        first = run.start()
        for text, start, end in _packed_parts(run.group().encode("latin-1")):
            start, end = starts[first + start], ends[first + end - 1]
            yield Layer(text, layer, [(0, start, len(text), end - start)])


def _escape_layers(layer: Layer) -> Iterator[Layer | None]:
    if "\\" not in layer.text and "&" not in layer.text:
        return
    regions: list[tuple[int, int, str]] = []
    for m in _ESCAPE.finditer(layer.text):
        found = m.group()
        if found[0] == "&":
            value = html.unescape(found)
            if value == found:
                continue
        else:
            point = int(found[2:].strip("{}"), 16)
            if point > 0x10FFFF:
                continue
            value = chr(point)
            # Two halves of a surrogate pair are one character.
            if 0xDC00 <= point <= 0xDFFF:
                if regions and regions[-1][1] == m.start() and 0xD800 <= ord(regions[-1][2][-1]) <= 0xDBFF:
                    start, _, high = regions.pop()
                    both = (ord(high) - 0xD800 << 10) + point - 0xDC00 + 0x10000
                    regions.append((start, m.end(), chr(both)))
                continue
        regions.append((m.start(), m.end(), value))
    if regions:
        yield from _escaped_bytes(layer)
    # Half a pair alone is no character.
    yield _replaced(layer, [r for r in regions if not any(0xD800 <= ord(c) <= 0xDFFF for c in r[2])])


def _base64_runs(text: str) -> Iterator[tuple[int, int]]:
    """Spans that may be base64, leftmost and without overlap."""
    runs = [m.span() for m in _BASE64.finditer(text)]
    for pattern, before in zip(_BASE64_BREAKS, ("\r", "\\r"), strict=True):
        for m in pattern.finditer(text):
            gap = m.start() - len(before) if text.endswith(before, 0, m.start()) else m.start()
            line = _BASE64_END.search(text[max(0, gap - 16) : gap])
            # A line of 16 letters or more starts a run of the first kind.
            if line and len(line.group()) < 16 and (run := _BASE64_LINES.match(text, gap - len(line.group()))):
                runs.append(run.span())
    end = 0
    for start, stop in sorted(runs):
        if start >= end:
            yield start, stop
            end = stop


def _base64_layers(layer: Layer) -> Iterator[Layer | None]:
    for begin, stop in _base64_runs(layer.text):
        # Places of the code letters in the text.
        at, letters = begin, []
        for gap in _BREAK.finditer(layer.text, begin, stop):
            letters.extend(range(at, gap.start()))
            at = gap.end()
        letters.extend(range(at, stop))
        if len(letters) < LEAST_LETTERS:
            continue
        code = _BREAK.sub("", layer.text[begin:stop]).rstrip("=").replace("-", "+").replace("_", "/")
        # A path or other letters may stand before the encoded part without a space.
        for shift in range(4):
            part = code[shift:]
            part = part[: len(part) - (len(part) % 4 == 1)]
            data = base64.b64decode(part + "=" * (-len(part) % 4))

            def place(start: int, end: int, shift: int = shift, letters: list = letters) -> tuple[int, int]:
                """Bytes of n bits come from the code letters that hold them."""
                start, end = letters[shift + start * 8 // 6], letters[shift - (-end * 8 // 6) - 1] + 1
                return start, end - start

            for text, start, end in _packed_parts(data):
                there, outer = place(start, end)
                yield Layer(text, layer, [(0, there, len(text), outer)])
            text = _readable(data)
            if not text:
                continue
            pieces, at = [], 0
            for n, c in enumerate(text):
                width = 1 if "\ud800" <= c <= "\udfff" else len(c.encode())
                there, outer = place(at, at + width)
                pieces.append((n, there, 1, outer))
                at += width
            yield Layer(text, layer, pieces)


def _inner(layer: Layer) -> Iterator[Layer | None]:
    yield from _url_layers(layer)
    yield from _escape_layers(layer)
    yield from _base64_layers(layer)


def find(text: str | None) -> tuple[list[Span], list[Span], int]:
    """Spans of the text itself, spans of all layers, and how many layers weren't opened: none."""
    base = scan(text or "")
    spans, met = set(base), set()
    work = [_inner(Layer(text or ""))]
    while work:
        try:
            inner = next(work[-1])
        except StopIteration:
            work.pop()
            continue
        if inner is None or inner.seen_before() or (key := inner.key()) in met:
            continue
        met.add(key)
        spans.update((*inner.original(start, end), kind) for start, end, kind in scan(inner.text))
        work.append(_inner(inner))
    return base, sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1])), 0


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, base, spans, n_unopened of every document.

    ``base`` and ``spans`` are arrays of (start, end, kind) by start, then kind.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [find(t) for t in batch.column(1).to_pylist()]
            lists = [
                pa.array([[dict(zip(("start", "end", "kind"), s, strict=True)) for s in f[k]] for f in found], kind)
                for k in (0, 1)
            ]
            columns = [batch.column(0), *lists, pa.array([f[2] for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "spans", "n_unopened"])

    span = "array<struct<start:long,end:long,kind:string>>"
    return arrow_map(docs, ["doc_id", "text"], batches, f"base {span}, spans {span}, n_unopened long")


def digests(found: DataFrame) -> DataFrame:
    """Counts, digest and text of the spans from ``scan_documents``."""
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base = F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, text(F.col("spans")).alias("spans"), "n_unopened")
