"""Quality of a text from how well dictionaries of good and of bad text compress it.

Two zstandard dictionaries are trained, one on labelled good text and one on bad. A text
is cut into blocks, so that a dictionary helps the last block as much as the first, and
each block is compressed with either dictionary. The feature is

    (bytes with the bad dictionary - bytes with the good one) / (bytes of the text + 1)

over the whole text. A logistic curve, fitted on labelled texts that the dictionaries have
not seen, turns it into the probability of label 1.

Edge cases: a null text counts as empty, an empty text has feature 0. Labels other than 0
and 1, null ids and ids without a document teach nothing. Without both labels there is no
model: every score is then the share of label 1 seen (0.5 if none was).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the labelled sample: rows of either label, and characters of one text.
# Longer texts are not learned from; they are scored like all others.
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 40_000
BLOCK_BYTES = 1024
DICTIONARY_BYTES = 65_536
DICTIONARY_BLOCKS = 8_000
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float


def _blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    data = zstandard.ZstdCompressionDict(dictionary)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)


def difference(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """The normalised difference of the two compressed sizes of a whole text."""
    gained = total = 0
    for block in _blocks(text):
        gained += len(bad.compress(block)) - len(good.compress(block))
        total += len(block)
    return gained / (total + 1)


def _logistic(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def fit_curve(feature: np.ndarray, label: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, with a small ridge.

    The feature is standardised first, so the ridge means the same at every scale.
    """
    mean, scale = feature.mean(), feature.std() or 1.0
    x = np.stack([(feature - mean) / scale, np.ones_like(feature)], axis=1)
    weights = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - label) + 1e-2 * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1] - weights[0] * mean / scale)


def _dictionary(texts: list[str]) -> bytes | None:
    blocks = [block for text in texts for block in _blocks(text)]
    # Evenly over all texts, so that a few long ones don't fill the dictionary.
    step = max(1, len(blocks) // DICTIONARY_BLOCKS)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks[::step], level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its bytes are the dictionary
        joined = b"".join(blocks)[-DICTIONARY_BYTES:]
        return joined if len(joined) >= 8 else None


def train(good: list[str], bad: list[str]) -> Model:
    """A model of labelled texts: the first half for the dictionaries, the rest for the curve."""
    share = len(good) / (len(good) + len(bad)) if good or bad else 0.5
    prior = Model(b"", b"", 0.0, math.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    if not good or not bad:
        return prior
    halves = [(t[: (len(t) + 1) // 2], t[(len(t) + 1) // 2 :] or t) for t in (good, bad)]
    words = [_dictionary(first) for first, _ in halves]
    if None in words:
        return prior
    compressors = [_compressor(w) for w in words]
    feature = [[difference(t, *compressors) for t in rest] for _, rest in halves]
    label = np.repeat([1.0, 0.0], [len(f) for f in feature])
    return Model(*words, *fit_curve(np.array(feature[0] + feature[1]), label))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column) -> tuple[list[str], list[str]]:
    """Texts of label 1 and of label 0, in a fixed random order.

    At most ``SAMPLE_ROWS`` of each label whose id satisfies ``usable``. The order comes
    from the labels alone; the documents are then filtered by id in one scan.
    """
    seed = F.xxhash64(F.col("doc_id"), F.lit(10)).alias("seed")
    known = labels.filter(F.col("doc_id").isNotNull() & usable).select("doc_id", "quality", seed)
    good, bad = (
        known.filter(F.col("quality") == value).distinct().orderBy("seed", "doc_id").limit(SAMPLE_ROWS)
        for value in (1, 0)
    )
    # Broadcast: two limits bound it, whatever the size of the tables.
    sample = docs.select("doc_id", "text").join(F.broadcast(good.union(bad)), "doc_id")
    rows = sample.filter(F.length("text") <= SAMPLE_CHARS).collect()
    rows.sort(key=lambda r: (r.seed, r.doc_id, r.text))
    return [r.text for r in rows if r.quality == 1], [r.text for r in rows if r.quality == 0]


def score(text: str | Column, model: Model) -> Column:
    """Score of a text column: the probability of label 1."""
    good, bad, slope, offset = model.good, model.bad, model.slope, model.offset

    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pair = good and (_compressor(good), _compressor(bad))
        for batch in texts:
            if pair:
                found = [_logistic(slope * difference(t, *pair) + offset) for t in batch.to_pylist()]
            else:
                found = [_logistic(offset)] * len(batch)
            yield pa.array(found, pa.float64())

    # Spark reads the types themselves, and annotations of this module are strings.
    batches.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, "double")(text)


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted: one row per document, whatever its other columns are called."""
    return docs.select("doc_id", score("text", model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
