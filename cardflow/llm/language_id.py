"""Language of a text by sparse multinomial logistic regression on character n-grams.

A text's features are its character n-grams of one to four letters, inside words with a
mark on both sides, hashed into ``BUCKETS``; values are TF-IDF with logarithmic counts, of
unit length. Document frequencies come from all documents that may be learned from. The
weights are trained on a bounded sample with follow-the-regularised-leader (proximal) and
elastic-net penalties, which leaves most of them at zero. A temperature, fitted on a part of
the sample that training has not seen, calibrates the probabilities.

Edge cases: a null text and one without a letter are ``und`` with score 0. Rows without a
language teach nothing. Rows that repeat an id and a text are drawn at most once. With fewer
than 20 texts to learn from the temperature is 1. Without any language to learn every text is ``und``; with one only,
that one has score 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.common import arrow_map

BUCKETS = 1 << 16
LENGTHS = (1, 2, 3, 4)
# Bound of the sample: rows, shared evenly by the languages.
SAMPLE_ROWS = 4000
# Rows of each language, so that the bound grows with more than 200 of them.
LEAST_ROWS = 20
# Languages up to which the table of their shares is broadcast.
BROADCAST_ROWS = 10_000
EPOCHS = 3
ALPHA, BETA = 0.5, 1.0
L1, L2 = 0.02, 0.02
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray  # of each bucket
    rows: np.ndarray  # bucket of each row of weights; buckets without weights are left out
    weights: np.ndarray  # one column for each language, bias in the last row
    temperature: float


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter, by the rule that its n-grams follow."""
    return bool(text) and bool(_letters(_points(text)).any())


def _points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a whole text, and how often each occurs.

    Characters other than letters end words; words are in lower case.
    """
    points = _points(text)
    letter = _letters(points)
    # One blank between words: n-grams don't cross it.
    code = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    code = np.concatenate([[np.uint64(32)], code, [np.uint64(32)]])
    solid = code != 32
    keep = solid | np.concatenate([[True], solid[:-1]])
    code, solid = code[keep], solid[keep]
    found = []
    value = np.zeros(len(code), np.uint64)
    inside = np.ones(len(code), bool)
    for n in range(1, max(LENGTHS) + 1):
        if len(code) < n:
            break
        value = (value[: len(code) - n + 1] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :]
        # Blanks only at the ends of an n-gram.
        inside = inside[: len(code) - n + 1]
        if n > 2:
            inside = inside & solid[n - 2 : len(code) - 1]
        if n in LENGTHS:
            good = inside & (solid[: len(value)] if n == 1 else solid[: len(value)] | solid[n - 1 :])
            x = value[good]
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append((x ^ (x >> np.uint64(29))) & np.uint64(BUCKETS - 1))
    buckets = np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)
    if len(buckets) < BUCKETS:
        return np.unique(buckets, return_counts=True)
    counts = np.bincount(buckets, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    out = ((points | 32) >= 97) & ((points | 32) <= 122)
    if (points > 127).any():
        other, at = np.unique(points[points > 127], return_inverse=True)
        out[points > 127] = np.array([chr(c).isalpha() for c in other.tolist()])[at]
    return out


def values(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length."""
    x = (1 + np.log(counts)) * idf[buckets]
    return x / (np.sqrt((x * x).sum()) or 1.0)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], idf: np.ndarray) -> Model:
    """Weights from (buckets, counts, language) in a fixed random order."""
    k = len(languages)
    data = [(np.append(b, BUCKETS), np.append(values(b, c, idf), 1.0), y) for b, c, y in rows]
    # A few rows are all learned from, and the temperature stays 1.
    held = data[::5] if len(data) >= 20 else []
    learned = [d for n, d in enumerate(data) if n % 5] if held else data
    z = np.zeros((BUCKETS + 1, k))
    n = np.zeros((BUCKETS + 1, k))

    def weights_of(at: np.ndarray) -> np.ndarray:
        """The leader: zero where |z| is within the L1 penalty. The bias has no penalty."""
        zs, ns = z[at], n[at]
        l1 = np.where(at == BUCKETS, 0.0, L1)[:, None]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, y in learned:
            w = weights_of(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights_of(np.arange(BUCKETS + 1))
    logits = np.array([x @ w[at] for at, x, _ in held]).reshape(len(held), k)
    truth = np.array([y for *_, y in held], int)
    rows_used = np.flatnonzero(w[:BUCKETS].any(axis=1))
    return Model(languages, idf, rows_used, np.vstack([w[rows_used], w[BUCKETS:]]), _temperature(logits, truth))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden-section search on its log."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / math.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean())

    low, high, ratio = -3.0, 3.0, (math.sqrt(5) - 1) / 2
    while high - low > 1e-4:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def predict(text: str | None, model: Model, place: np.ndarray) -> tuple[str, float]:
    """Language and its probability; ``place`` is the row of weights of each bucket, or -1."""
    if not model.languages or not has_letter(text):
        return UNKNOWN, 0.0
    buckets, counts = gram_counts(text)
    x = values(buckets, counts, model.idf)
    at = place[buckets]
    logits = x[at >= 0] @ model.weights[at[at >= 0]] + model.weights[-1]
    p = _softmax(logits / model.temperature)
    best = int(p.argmax())
    return model.languages[best], min(1.0, float(p[best]))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and of each bucket the number that has it; summed up by Spark.

    Each task sends its sums, not its rows, and they are added before they reach the driver.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, df = 0, np.zeros(BUCKETS, np.int64)
        for batch in source:
            for text in batch.column(0).to_pylist():
                df[gram_counts(text)[0]] += 1
                total += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, BUCKETS), pa.int32()), pa.array(np.append(df[at], total), pa.int64())], ["bucket", "n"]
        )

    partial = docs.select("text").mapInArrow(batches, "bucket int, n long")
    summed = partial.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 1, np.int64)
    df[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return int(df[BUCKETS]), df[:BUCKETS]


def fit(docs: DataFrame, usable: Column) -> Model:
    """A model of the documents that satisfy ``usable`` and have a text and a language."""
    known = docs.filter(usable & F.col("text").isNotNull() & F.col("lang").isNotNull())
    known = known.select("doc_id", "text", "lang")
    total, df = document_frequencies(known)
    idf = np.log((1 + total) / (1 + df)) + 1
    # Rows equal in id and text have one seed and are drawn as one, whatever their number.
    known = known.withColumn("seed", F.xxhash64("doc_id", "text", F.lit(4)))
    common = known.groupBy("lang").agg(F.approx_count_distinct("seed", 0.02).alias("texts")).collect()
    languages = sorted(r["lang"] for r in common)
    if not languages:
        return Model([], idf, np.empty(0, np.int64), np.zeros((1, 0)), 1.0)
    most = max(LEAST_ROWS, SAMPLE_ROWS // len(languages))
    # For each language a share by seed that gives about twice the texts wanted; of these the
    # first by seed.
    shares = []
    for r in common:
        share = min(1.0, (2 * most + 40) / (0.9 * r["texts"]))
        shares.append((r["lang"], min(2**63 - 1, int(share * 2**64) - 2**63)))
    bounds = docs.sparkSession.createDataFrame(shares, "lang string, bound long")
    if len(shares) <= BROADCAST_ROWS:
        # Texts aren't shuffled before they are drawn.
        bounds = F.broadcast(bounds)
    drawn = known.join(bounds, "lang").filter("seed <= bound").dropDuplicates(["lang", "seed"])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("seed")) <= most
    found = _counted(drawn.withColumn("first", first).filter("first")).collect()
    found.sort(key=lambda r: (r.seed, r.lang, r.buckets))
    rows = [
        (np.frombuffer(r.buckets, "<i4").astype(np.int64), np.frombuffer(r.counts, "<i4"), languages.index(r.lang))
        for r in found
    ]
    return train(rows, languages, idf)


def _counted(rows: DataFrame) -> DataFrame:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [gram_counts(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("seed"), batch.column("lang")]
            columns += [pa.array([f[k].astype("<i4").tobytes() for f in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "seed", "lang", "buckets", "counts"])

    outputs = "seed long, lang string, buckets binary, counts binary"
    return arrow_map(rows, ["doc_id", "seed", "lang", "text"], batches, outputs)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every document."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1)
        place[model.rows] = np.arange(len(model.rows))
        for batch in source:
            found = [predict(t, model, place) for t in batch.column(1).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "lang_pred", "score"])

    return arrow_map(docs, ["doc_id", "text"], batches, "lang_pred string, score double")
