"""Collocations: phrases that occur together more often than their parts suggest.

Only the longest windows are counted. A word and the words that follow it in its piece, as
lead columns padded with the empty string, make a window; no shorter n-gram is ever made.

1. Tasks read texts in Arrow batches, cut them into words by their bytes, and count the
   windows of half a million words together. So a window that is very common reaches the shuffle
   once for so many words.
2. Windows are shuffled in bundles by their first word, and added up in tasks. The last word
   of a rare window, and the last two of a rare prefix, are replaced by the padding: their
   count goes on as part of the shorter prefix, which is all that a sum of prefixes needs.
   The windows of a common first word are dealt by the second word, too, those of a common
   first pair by the third. Which ones are common is found in a sample and has no influence
   on results. A bundle too large for a task's memory is added up in parts.
3. ROLLUP sums the collapsed windows over ever shorter prefixes, down to the language: the
   counts of all phrases up to the longest that occur often enough, and of all words.
4. Candidates meet the counts of their parts by joins of these short tables. Scores are
   decimal and exact; products may pass 64 bits.

The results of each language are ranked in slices first, so that no task sorts all of them.

Edge cases: null and empty texts have no words. A null language is ``und``, together with
rows of that name. Rows count as often as they occur, ids aren't used, other columns are
ignored. Without a phrase that is common enough there are no rows. Counts past 10^13 would
need wider decimals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardflow.llm.common import BATCH_ROWS, stored

LONGEST = 3
LEAST = 10
TOP = 2000
# A phrase goes if a longer one around it has at least this share of its occurrences.
SHARE_PERCENT = 50
SCALE = 1_000_000
UNKNOWN = "und"

# Words counted together in a task, and bytes of texts taken together.
WORDS_TOGETHER = 1 << 19
# Bytes of bundles that are added up together in a task.
BYTES_TOGETHER = 6 << 20
# Texts (about) from which common first words are learned, their share of all windows (one
# of so many), and over how many places their windows are dealt.
SAMPLE_ROWS = 2000
COMMON = 2000
PLACES = 64
# Slices of a language that are ranked first.
SLICES = 64

WORD, BLANK, BREAK = 0, 1, 2
# Kinds of bytes, and bytes with A-Z in lower case. All separators are ASCII.
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = BLANK
KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _codes(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 on, equal where the values are."""
    return np.unique(values, return_inverse=True)[1]


def _groups(columns: list[np.ndarray], size: int) -> np.ndarray:
    """Numbers from 0 on of rows, equal where all columns are, which are below ``size``."""
    key = columns[0].astype(np.int64)
    bound = int(key.max()) + 1
    for column in columns[1:]:
        if bound * size >= 1 << 62:
            key = _codes(key)
            bound = int(key.max()) + 1
        key = key * size + column
        bound *= size
    return _codes(key)


@dataclass
class Windows:
    """Distinct padded windows of some texts as numbers of languages and words, and their counts."""

    langs: pa.Array
    lang: np.ndarray
    words: pa.Array  # the last one is the padding
    leads: list[np.ndarray]
    counts: np.ndarray


def windows(texts: pa.StringArray, langs: pa.StringArray, longest: int) -> Iterator[Windows]:
    """All windows of texts, counted many words at a time."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    kind = KINDS[data]
    changes = np.append(True, kind[1:] != kind[:-1])
    # A text's first byte starts a word, whatever the text before it ends with.
    changes[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    edge = np.flatnonzero(changes)
    ends = np.append(edge[1:], len(data))
    is_word = kind[edge] == WORD
    starts, ends = edge[is_word], ends[is_word]
    if not len(starts):
        return
    text = np.searchsorted(bounds, starts, "right") - 1
    breaks = np.append(0, (kind == BREAK).cumsum())[starts]
    fresh = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
    piece = np.append(0, fresh.cumsum())
    lengths = ends - starts
    chars = LOWER[data[kind == WORD]]
    places = np.append(0, lengths.cumsum())
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(chars))
    spoken = langs.fill_null(UNKNOWN).dictionary_encode()
    lang = spoken.indices.to_numpy().astype(np.int64)[text]
    del data, kind, edge, changes, chars, breaks, fresh

    for first in range(0, len(starts), WORDS_TOGETHER):
        last = min(first + WORDS_TOGETHER, len(starts))
        here = words[first : last + longest - 1].dictionary_encode()
        n = last - first
        pad = len(here.dictionary)
        word = here.indices.to_numpy().astype(np.int64)
        leads = []
        for ahead in range(longest):
            lead = np.full(n, pad)
            rest = word[ahead : ahead + n]
            same = piece[first + ahead : first + ahead + len(rest)] == piece[first : first + len(rest)]
            lead[: len(rest)] = np.where(same, rest, pad)
            leads.append(lead)
        code = _groups([lang[first:last], *leads], pad + 1)
        counts = np.bincount(code)
        one = np.empty(len(counts), np.int64)
        one[code] = np.arange(n)
        named = pa.concat_arrays([here.dictionary.cast(pa.string()), pa.array([""])])
        yield Windows(spoken.dictionary, lang[first:last][one], named, [lead[one] for lead in leads], counts)


def _place(number: int) -> str:
    """Empty for most; the place by the second word, and after a plus that by the third."""
    second, third = divmod(number, PLACES + 1)
    return f"{second}+{third}" if third else f"{second}" if second else ""


def bundles(found: Windows, common: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Windows by first word: (first word, place, language) as one string, and a line for each
    window with the other words and the count."""
    size = len(found.words)
    pairs, first = np.unique(found.lang * size + found.leads[0], return_inverse=True)
    word, lang = found.words.take(pa.array(pairs % size)), found.langs.take(pa.array(pairs // size))
    place = np.zeros(len(first), np.int64)
    if len(common):
        is_common = pc.is_in(pc.binary_join_element_wise(word, lang, " "), common).to_numpy(zero_copy_only=False)
        spread = np.array([1 + zlib.crc32(w.encode()) % PLACES for w in found.words.to_pylist()])
        at = np.flatnonzero(is_common[first])
        place[at] = spread[found.leads[1][at]] * (PLACES + 1)
        if len(found.leads) > 2:
            named = (found.words.take(pa.array(lead[at])) for lead in found.leads[:2])
            pair = pc.binary_join_element_wise(*named, found.langs.take(pa.array(found.lang[at])), " ")
            at = at[pc.is_in(pair, common).to_numpy(zero_copy_only=False)]
            place[at] += spread[found.leads[2][at]]
    bundle = first * (PLACES + 1) ** 2 + place
    # Windows that begin alike follow each other, which compresses them well.
    order = (bundle * size + found.leads[1]).argsort()
    bundle = bundle[order]
    starts = np.flatnonzero(np.append(True, bundle[1:] != bundle[:-1]))
    others = [found.words.take(pa.array(lead[order])) for lead in found.leads[1:]]
    lines = pc.binary_join_element_wise(*others, pa.array(found.counts[order]).cast(pa.string()), " ")
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(bundle)), pa.int32()), lines)
    at, where = first[order][starts], place[order][starts]
    named = pc.binary_join_element_wise(
        word.take(pa.array(at)), pa.array([_place(p) for p in where.tolist()], pa.string()), lang.take(pa.array(at)), " "
    )
    return named, pc.binary_join(lists, "\n")


def counted_windows(docs: DataFrame, longest: int, common: frozenset[str] = frozenset()) -> DataFrame:
    """first, lines: windows as counted in the tasks, bundled by their first words.

    A bundle takes far fewer bytes in the shuffle than its windows as rows. The windows of a
    common first word are dealt over ``PLACES`` bundles by their second word, those of a
    common first pair over as many again by their third.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(sorted(common), pa.string())
        for batch in gathered(source):
            for found in windows(batch.column(1), batch.column(0), longest):
                yield pa.RecordBatch.from_arrays(list(bundles(found, listed)), ["first", "lines"])

    def gathered(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches put together, up to about as many bytes as words that are counted together."""
        held, size = [], 0
        for batch in source:
            held.append(batch)
            size += batch.nbytes
            if size >= 6 * WORDS_TOGETHER:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    texts = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    return texts.mapInArrow(batches, "first string, lines string")


def _windows_of(bundled: DataFrame) -> DataFrame:
    """first, others (the other words, joined by spaces), n of each window."""
    lines = bundled.select("first", F.explode(F.split("lines", "\n")).alias("line"))
    count = F.substring_index("line", " ", -1)
    others = F.substring("line", F.lit(1), F.length("line") - F.length(count) - 1)
    return lines.select("first", others.alias("others"), count.cast("long").alias("n"))


def common_beginnings(docs: DataFrame, longest: int) -> frozenset[str]:
    """First words and first pairs with very many windows in a sample, with their language.

    There are ``2 * COMMON`` at most.
    """
    every = max(1, docs.count() // SAMPLE_ROWS)
    sample = counted_windows(docs.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0), longest)
    head = F.split("first", " ", 3)
    word, lang = F.get(head, F.lit(0)).alias("word"), F.get(head, F.lit(2)).alias("lang")
    counts = _windows_of(sample).groupBy(word, F.substring_index("others", " ", 1).alias("next"), lang).agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "beginnings")
    least = max(LEAST, (counts.agg(F.sum("n")).first()[0] or 0) // COMMON + 1)
    words = counts.groupBy("word", "lang").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    pairs = counts.filter((F.col("n") >= least) & (F.col("next") != ""))
    names = words.select(F.concat_ws(" ", "word", "lang")).union(pairs.select(F.concat_ws(" ", "word", "next", "lang")))
    return frozenset(row[0] for row in names.collect())


def _counted(firsts: pa.Array, lines: pa.Array, longest: int, least: int, cut: bool) -> list:
    """Columns lang, words, n of the windows in bundles, added up.

    Where ``cut``, the bundles hold all windows of their first words and places: the last
    word of a rare window and the last two of a rare prefix are replaced by the padding.
    """
    split = pc.split_pattern(lines, "\n")
    # Each line has the other words and the count.
    parts = pc.split_pattern(split.flatten(), " ").flatten()
    n = pc.take(parts, pa.array(np.arange(longest - 1, len(parts), longest))).cast(pa.int64()).to_numpy()
    coded = parts.dictionary_encode()
    words = coded.dictionary
    empty = pc.index(words, "").as_py()
    if empty < 0:
        empty, words = len(words), pa.concat_arrays([words, pa.array([""], words.type)])
    code = coded.indices.to_numpy().reshape(-1, longest)
    named = firsts.dictionary_encode()
    bundle = np.repeat(named.indices.to_numpy(), pc.list_value_length(split).to_numpy())

    def grouped(columns: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group of each row, the sum of each group, and one row of each."""
        key = _groups(columns, len(words) + 1)
        one = np.empty(key.max() + 1, np.int64)
        one[key] = np.arange(len(key))
        return key, np.bincount(key, weights=n).astype(np.int64), one

    columns = [bundle, *(code[:, k].astype(np.int64) for k in range(longest - 1))]
    _, n, one = grouped(columns, n)
    columns = [c[one] for c in columns]
    if cut:
        prefix, total, _ = grouped(columns[:-1], n)
        columns[-1] = np.where(n >= least, columns[-1], empty)
        if longest > 2:
            # A common pair, dealt by its third word, may be rare in one of its places only.
            plus = np.array(["+" in x.split(" ", 2)[1] for x in named.dictionary.to_pylist()])
            known = (total[prefix] >= least) | plus[columns[0]]
            columns[-2] = np.where(known, columns[-2], empty)
        _, n, one = grouped(columns, n)
        columns = [c[one] for c in columns]
    heads = [x.split(" ", 2) for x in named.dictionary.to_pylist()]
    at = pa.array(columns[0])
    first, lang = (pa.array([h[k] for h in heads], pa.string()).take(at) for k in (0, 2))
    return [lang, first, *(words.take(pa.array(c)).cast(pa.string()) for c in columns[1:]), pa.array(n)]


def collapsed_windows(bundled: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, w1 and so on, n: windows added up and cut where they are rare, from bundles.

    A task has all bundles of a first word and place after each other, and takes as many
    first words together as make ``BYTES_TOGETHER``. One that has more alone is passed on
    uncut, part by part; its parts are added up afterwards, like all rows.
    """
    names = ["lang", *(f"w{k + 1}" for k in range(longest)), "n"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, parted = [], 0, None

        def rows(firsts: pa.Array, lines: pa.Array, cut: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(_counted(firsts, lines, longest, least, cut), names)

        for batch in source:
            held.append(batch)
            size += batch.nbytes
            if size < BYTES_TOGETHER:
                continue
            firsts, lines = (pa.chunked_array([b.column(k) for b in held]).combine_chunks() for k in (0, 1))
            # The last first word may go on in the next batch.
            end = int(pc.index(firsts, firsts[-1]).as_py())
            start = 0
            if parted is not None:
                same = pc.sum(pc.equal(firsts, parted)).as_py() or 0
                if same:
                    yield rows(firsts[:same], lines[:same], False)
                start = same
            if start == len(firsts):
                held, size = [], 0
                continue
            if end > start:
                yield rows(firsts[start:end], lines[start:end], True)
                parted = None
            if end <= start or lines[end:].nbytes > BYTES_TOGETHER // 2:
                # One first word fills the batch.
                end, parted = max(end, start), firsts[-1]
                yield rows(firsts[end:], lines[end:], False)
                held, size = [], 0
            else:
                held = [pa.RecordBatch.from_arrays([firsts[end:], lines[end:]], ["first", "lines"])]
                size = held[0].nbytes
        if held:
            firsts, lines = (pa.chunked_array([b.column(k) for b in held]).combine_chunks() for k in (0, 1))
            same = 0 if parted is None else pc.sum(pc.equal(firsts, parted)).as_py() or 0
            if same:
                yield rows(firsts[:same], lines[:same], False)
            if same < len(firsts):
                yield rows(firsts[same:], lines[same:], True)

    ordered = bundled.repartition("first").sortWithinPartitions("first")
    return ordered.mapInArrow(batches, ", ".join(f"{x} long" if x == "n" else f"{x} string" for x in names))


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, words (array), n of all phrases that occur often enough; of no words: of all words."""
    bundled = counted_windows(docs, longest, common_beginnings(docs, longest))
    collapsed = collapsed_windows(bundled, longest, least)
    names = [f"w{k + 1}" for k in range(longest)]
    collapsed = collapsed.groupBy("lang", *names).agg(F.sum("n").alias("n"))

    rolled = collapsed.rollup("lang", *names).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    # A grouping id has a bit for each column that is summed over, the last column's the lowest.
    words = F.array(*names)
    size = F.lit(None)
    for k in range(longest + 1):
        size = F.when(F.col("level") == (1 << (longest - k)) - 1, F.lit(k)).otherwise(size)
    rolled = rolled.select("lang", F.slice(words, F.lit(1), size).alias("words"), size.alias("size"), "n")
    whole = (F.col("size") == 0) | ((F.col("n") >= least) & (F.element_at("words", -1) != ""))
    return rolled.filter(F.col("size").isNotNull() & whole).select("lang", "words", "n")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(13,0)")


def _best_first(*partition: str) -> W:
    return W.partitionBy(*partition).orderBy(F.desc("score"), F.desc("a"), "phrase")


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best collocations of each language."""
    counts = stored(phrase_counts(docs, longest, least), "phrase-counts")
    phrase = F.concat_ws(" ", "words").alias("phrase")
    known = counts.filter(F.size("words") > 0).select("lang", phrase, "n")
    candidates = counts.filter(F.size("words") > 1).select("lang", phrase, "words", F.col("n").alias("a"))

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    part = lambda start, length: F.concat_ws(" ", F.slice("words", start, length))
    left, right = part(F.lit(1), F.col("cut")), part(F.col("cut") + 1, F.size("words") - F.col("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", left.alias("left"), right.alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("n").alias(count)), ["lang", side])
    exact = {x: _exact(x) for x in "alr"}
    scored = cuts.withColumns({f"{x}_": column for x, column in exact.items()})
    scored = scored.withColumn("score", F.expr(f"(cast({SCALE} as decimal(7,0)) * (a_ * a_)) div (l_ * r_)"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    best = best.select("lang", "phrase", "a", "b.score", "b.l", "b.r")

    # Phrases inside longer candidates, with the largest count of those.
    size = F.size("words")
    inside = [
        F.concat_ws(" ", F.slice("words", F.lit(at + 1), F.lit(length)))
        for length in range(2, longest)
        for at in range(longest - length + 1)
    ]
    spans = [(length, at) for length in range(2, longest) for at in range(longest - length + 1)]
    within = [F.when((size > n) & (size >= at + n), text) for (n, at), text in zip(spans, inside, strict=True)]
    if within:
        found = candidates.select("lang", F.explode(F.array_compact(F.array(*within))).alias("phrase"), "a")
        around = found.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
        best = best.join(around, ["lang", "phrase"], "left")
        best = best.filter(F.coalesce(100 * F.col("around") < SHARE_PERCENT * F.col("a"), F.lit(True))).drop("around")

    sliced = best.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    sliced = sliced.withColumn("rank", F.row_number().over(_best_first("lang", "slice"))).filter(F.col("rank") <= top)
    ranked = sliced.withColumn("rank", F.row_number().over(_best_first("lang"))).filter(F.col("rank") <= top)
    totals = counts.filter(F.size("words") == 0).select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
