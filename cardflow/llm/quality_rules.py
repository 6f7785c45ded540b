"""Quality rules: fixed checks of a text, and a log-likelihood ratio of hashed n-grams.

The ratio compares two multinomials over buckets of hashed words and word pairs: one of
trusted text (all documents labelled good), one of all documents. A document's ratio is the sum over its
n-grams of log(trusted share / raw share) divided by their number. Documents below a
threshold go. The threshold is a quantile of the ratios of the trusted documents, so it is
the same in every run and nearly all text like the trusted one stays.

Only DataFrame functions are used. Repeated windows of a text are found inside its row: the
hashes of its windows are sorted and equal neighbours are runs. Counts of n-grams are
combined before the shuffle, so no bucket or word is a hot key.

Edge cases: null, empty and blank texts have no words and fail the base rules. A text of one
word has one n-gram. Without trusted documents (or without raw ones) the ratio is 0 for all
and drops nothing. Labels of unknown or null ids and other labels than 1 don't count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardflow.llm.common import stored

# Fixed values of the base rules.
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

BUCKETS = 1 << 16
# The filter of the trusted ids: one megabyte. With very many ids it lets more texts through
# to the join, which decides.
FILTER_BITS = 1 << 23
FILTER_HASHES = 4
# Share of the trusted documents that may fall below the threshold.
TRUSTED_LOSS = 0.002


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, also where ``body`` has lambdas of its own."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows_of(words: Column) -> Column:
    """Hashes of all runs of eight words, in order; null for texts with fewer than nine words."""
    last = F.size(words) - WINDOW
    window = lambda hashes: lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
    found = _bound(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window(hashes)),
    )
    return F.when(last >= 1, found)


def repeated_words(windows: Column) -> Column:
    """Number of words covered by windows that occur twice or more."""
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    beside = lambda rows, i: F.get(rows, i)["w"]
    again = lambda rows: F.transform(
        rows,
        lambda x, i: F.when(x["w"].eqNullSafe(beside(rows, i - 1)) | x["w"].eqNullSafe(beside(rows, i + 1)), x["i"]),
    )
    starts = F.sort_array(F.filter(_bound(placed, again), lambda i: i.isNotNull()))
    # Of the words in repeated windows each window adds those that the next doesn't have.
    added = lambda at: F.transform(
        at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))
    )
    covered = F.aggregate(_bound(starts, added), F.lit(0).cast("long"), lambda a, b: a + b)
    # Sorting is only for texts that have a window twice.
    twice = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.coalesce(F.when(twice, covered), F.lit(0)).cast("long")


def base_columns(docs: DataFrame) -> DataFrame:
    """doc_id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", text, words_of(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.withColumns({"lines": lines, "windows": windows_of(F.col("words"))})
    return rows.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).alias("n_repeat_words"),
    )


def grams(words: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours, in lower case."""
    bucket = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")
    rest = lambda low: F.slice(low, F.lit(2), F.greatest(F.size(low) - 1, F.lit(0)))
    pairs = lambda low: F.transform(rest(low), lambda w, i: bucket(F.get(low, i), w))
    return _bound(F.transform(words, F.lower), lambda low: F.concat(F.transform(low, lambda w: bucket(w)), pairs(low)))


def _places(key: Column) -> list[Column]:
    """Bits of the filter that stand for a key."""
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(FILTER_BITS)) for k in range(FILTER_HASHES)]


def bloom_filter(ids: DataFrame) -> DataFrame:
    """One row, ``bits``: a Bloom filter of the column ``doc_id``, of a fixed size."""
    place = ids.select(F.explode(F.array(*_places(F.col("doc_id")))).alias("at"))
    at = F.col("at")
    words = place.groupBy(F.shiftright(at, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63L as int))")).alias("bits")
    )
    every = ids.sparkSession.range(FILTER_BITS // 64).select(F.col("id").cast("int").alias("word"))
    filled = every.join(words, "word", "left").na.fill(0)
    sorted_words = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(sorted_words, lambda w: w["bits"]).alias("bits"))


def may_hold(bits: Column, key: Column) -> Column:
    """Whether the filter may hold a key; certainly for those it was made of."""
    hit = F.lit(True)
    for at in _places(key):
        word = F.get(bits, F.shiftright(at, 6).cast("int"))
        hit &= F.call_function("getbit", word, at.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1
    return hit


def ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row, ``ratio``: log(trusted share / raw share) of every bucket, add-one smoothed.

    The row is as large as the number of buckets, whatever the size of the tables. Counting
    all documents moves no text. Of texts that the filter may hold, a join finds the trusted
    ones, and always in the same way.
    """
    count = lambda rows, name: (
        rows.select(F.explode(grams(words_of(F.col("text")))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias(name))
    )
    ids = trusted.select("doc_id").distinct()
    bits = stored(bloom_filter(ids), "filter").scalar()
    likely = docs.select("doc_id", "text").filter(may_hold(bits, F.col("doc_id")))
    counted = count(docs, "raw").join(count(likely.join(ids.hint("merge"), "doc_id", "left_semi"), "good"), "bucket", "full")
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counted, "bucket", "left").na.fill(0)
    found = filled.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "good", "raw"))).alias("counts"),
        F.sum("good").alias("good"),
        F.sum("raw").alias("raw"),
    )
    share = lambda part, total: (part + 1) / (F.col(total) + BUCKETS)
    ratio = F.transform("counts", lambda c: F.log(share(c["good"], "good") / share(c["raw"], "raw")))
    # No trusted text: nothing is known, and nothing differs.
    return found.select(F.when(F.col("good") > 0, ratio).otherwise(F.array_repeat(F.lit(0.0), BUCKETS)).alias("ratio"))


def lowest(values: DataFrame, share: float) -> DataFrame:
    """One row, ``t``: the smallest value that at least ``share`` of the column ``ratio`` doesn't exceed.

    Exact: the value lies between two bounds with a known number of values below them, which
    are drawn together by counts of ever narrower parts, so nothing is sorted as a whole.
    Null without values.
    """
    ratio = F.col("ratio")
    wanted = max(1, math.ceil(values.count() * share))
    inside = values
    # Products with powers of two are exact; a part has at most 1,024 parts at the next step.
    for scale in (4, 14, 24, 34, 44):
        part = F.floor(ratio * float(1 << scale))
        counts = inside.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("part")))
        found = upto.filter(F.col("upto") >= wanted).orderBy("part").limit(1).first()
        if found is None:
            break
        wanted -= found["upto"] - found["n"]
        inside = inside.filter(part == found["part"])
    # What is left are values that agree to 44 bits: counted, they are a few numbers.
    counts = inside.groupBy("ratio").agg(F.count(F.lit(1)).alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("ratio")))
    return upto.filter(F.col("upto") >= wanted).agg(F.min("ratio").alias("t"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base columns, base_failed, ratio, kept of every document."""
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    table = stored(ratios(docs, good), "ratios")
    rows = base_columns(docs)
    ratio_of = lambda b: F.get("table", b)
    buckets = grams(F.col("words"))
    total = F.aggregate(buckets, F.lit(0.0), lambda a, b: a + ratio_of(b))
    rows = rows.withColumn("table", table.scalar())
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    rows = rows.withColumns({"ratio": total / n_grams, "base_failed": failed}).drop("words", "table")
    rows = stored(rows, "rules")
    # Of trusted documents that pass the base rules.
    passed = rows.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    threshold = stored(lowest(stored(passed.select("ratio"), "passed"), TRUSTED_LOSS), "threshold")
    enough = F.col("ratio") >= F.coalesce(threshold.scalar(), F.lit(float("-inf")))
    return rows.withColumn("kept", ~F.col("base_failed") & enough)
