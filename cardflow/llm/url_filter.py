"""URL verdicts from rules, and from a cascade of Bloom filters.

A cascade gives exact membership in a list without a join. The first filter holds the
listed keys; the second the keys of the universe that pass the first without being listed;
the third the listed keys that pass the second; and so on, until a filter lets nothing
through that it shouldn't. A key's answer is told by the first filter that doesn't hold it.
Exact for every key of the universe that the cascade was built over, here the hosts with
paths of all pages.

Keys are split into shards by a hash, as many as keep a shard's filters small, and every
shard has its own cascade, built inside one group of keys. The cascades are read as one
table. Up to ``BROADCAST_BYTES`` it goes to every task; beyond that, the rows of pages meet
the cascade of their shard, and rows of one shard are spread over many tasks.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and
is judged by its (empty) key like any other. Repeated rows are judged alike. An empty list
blocks nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import stored

# The rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SHARD_KEYS = 512
BROADCAST_BYTES = 8 << 20
# Bits for a key: about 2 % false positives in the first filter, 50 % in later ones.
FIRST_BITS, LATER_BITS = 8, 2
SPREAD = 64


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """From after the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last condition put around the others is the first that counts: longest last.
    for kind, of_host, of_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        name = F.when(fits, F.lit(of_host + of_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


class Bloom:
    """A Bloom filter over 64-bit hashes; ``salt`` makes those of one cascade independent."""

    def __init__(self, salt: int, probes: int, bits: np.ndarray):
        self.salt, self.probes, self.bits = salt, probes, bits

    @classmethod
    def of(cls, keys: np.ndarray, salt: int, bits_a_key: int) -> Bloom:
        size = max(64, -(-len(keys) * bits_a_key // 8) * 8)
        made = cls(salt, max(1, round(bits_a_key * math.log(2))), np.zeros(size // 8, np.uint8))
        for at in made._places(keys):
            np.bitwise_or.at(made.bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        return made

    def _places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        x = keys ^ np.uint64(self.salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
        low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32) | np.uint64(1)
        for k in range(self.probes):
            yield ((low + np.uint64(k) * high) % np.uint64(len(self.bits) * 8)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for at in self._places(keys):
            found &= (self.bits[at >> 3] >> (at & 7) & 1).astype(bool)
        return found


def build(listed: np.ndarray, others: np.ndarray) -> list[Bloom]:
    """The cascade of a shard: exact for both sets of hashes."""
    levels: list[Bloom] = []
    while len(listed):
        level = Bloom.of(listed, len(levels) + 1, LATER_BITS if levels else FIRST_BITS)
        levels.append(level)
        # Now the keys that wrongly pass are the ones to hold, against those just held.
        listed, others = others[level.holds(others)], listed
    return levels


def member(levels: list[Bloom], keys: np.ndarray) -> np.ndarray:
    """Whether each hash is listed: by the first filter that doesn't hold it."""
    answer = np.full(len(keys), len(levels) % 2 == 1)
    open_ = np.arange(len(keys))
    for n, level in enumerate(levels):
        held = level.holds(keys[open_])
        answer[open_[~held]] = n % 2 == 1
        open_ = open_[held]
    return answer


def pack(levels: list[Bloom]) -> bytes:
    """Filters one after the other: number of bytes, number of probes, bytes."""
    return b"".join(np.array([len(x.bits), x.probes], "<u4").tobytes() + x.bits.tobytes() for x in levels)


def unpack(data: bytes) -> list[Bloom]:
    levels, at = [], 0
    while at < len(data):
        size, probes = np.frombuffer(data, "<u4", 2, at).tolist()
        levels.append(Bloom(len(levels) + 1, probes, np.frombuffer(data, np.uint8, size, at + 8)))
        at += 8 + size
    return levels


def cascades(universe: DataFrame) -> DataFrame:
    """shard, n_shards, filters from the distinct keys of a table (key, listed).

    Two keys of one 64-bit hash, one listed and one not, can't be told apart by any filter;
    building fails then, rather than answer wrongly.
    """
    keys = stored(universe.select(F.xxhash64("key").alias("hash"), "listed").distinct(), "filter-keys")
    shards = max(1, -(-keys.count() // SHARD_KEYS))

    def filters_of(shard: pa.Table) -> pa.Table:
        hashes = shard["hash"].to_numpy().view(np.uint64)
        is_listed = shard["listed"].to_numpy(zero_copy_only=False)
        if len(np.unique(hashes)) != len(hashes):
            raise RuntimeError("a listed key and another have the same hash")
        packed = pack(build(hashes[is_listed], hashes[~is_listed]))
        return pa.table({"shard": shard["shard"][:1], "n_shards": pa.array([shards], pa.int64()), "filters": pa.array([packed], pa.binary())})

    # Spark reads the types themselves, and annotations of this module are strings.
    filters_of.__annotations__ = {"shard": pa.Table, "return": pa.Table}
    # A group has about SHARD_KEYS distinct hashes: hash values are even.
    by_shard = keys.withColumn("shard", F.pmod("hash", F.lit(shards))).groupBy("shard")
    return stored(by_shard.applyInArrow(filters_of, "shard long, n_shards long, filters binary"), "cascades")


def listed_among(rows: DataFrame, key: str, table: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean column: whether the key is listed, by the cascades alone."""
    size = table.agg(F.coalesce(F.sum(F.length("filters")), F.lit(0)), F.max("n_shards")).first()
    hashed = F.xxhash64(key)
    if size[0] <= BROADCAST_BYTES:
        shards = size[1] or 1
        filters = {r.shard: r.filters for r in table.collect()}
        return rows.withColumn(name, _probe(filters, shards)(hashed))
    # Rows of a shard are spread by their content; each part meets a copy of the filters.
    spread = F.pmod(F.xxhash64(*rows.columns, F.lit(1)), F.lit(SPREAD))
    copies = table.select("shard", "filters", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_part"))
    keyed = rows.withColumns({"_shard": F.pmod(hashed, F.lit(size[1])), "_part": spread.cast("int")})
    met = keyed.join(copies.withColumnRenamed("shard", "_shard"), ["_shard", "_part"], "left")
    return met.withColumn(name, _probe_each()(hashed, "filters")).drop("_shard", "_part", "filters")


def _probe(filters: dict[int, bytes], shards: int):
    def test(hashes: Iterator[pa.Array]) -> Iterator[pa.Array]:
        opened = {s: unpack(f) for s, f in filters.items()}
        for batch in hashes:
            signed = batch.to_numpy(zero_copy_only=False)
            found = np.zeros(len(signed), bool)
            shard = np.mod(signed, shards)
            for s in np.unique(shard).tolist():
                at = shard == s
                found[at] = member(opened.get(s, []), signed[at].view(np.uint64))
            yield pa.array(found)

    test.__annotations__ = {"hashes": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(test, "boolean")


def _probe_each():
    def test(hashes: pa.Array, filters: pa.Array) -> pa.Array:
        signed = hashes.to_numpy(zero_copy_only=False)
        packed = filters.dictionary_encode()
        which = packed.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        found = np.zeros(len(signed), bool)
        for n, data in enumerate(packed.dictionary.to_pylist()):
            found[which == n] = member(unpack(data), signed[which == n].view(np.uint64))
        return pa.array(found)

    test.__annotations__ = {"hashes": pa.Array, "filters": pa.Array, "return": pa.Array}
    return F.arrow_udf(test, "boolean")


def judge(pages: DataFrame, flagged: Column, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, listed, verdict of every page.

    A key (host and path) is listed if ``flagged`` holds for one of its pages; that is found
    once for each distinct key, when the cascades are built. A page that no rule fits is
    blocked if its key is listed.
    """
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.coalesce(flagged, F.lit(False)).alias("flag"))
    parsed = parsed.withColumn("key", F.concat("host", "path"))
    table = cascades(parsed.groupBy("key").agg(F.max("flag").alias("listed")))
    rows = listed_among(parsed.drop("flag"), "key", table, "listed")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    other = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), "listed", F.coalesce(verdict, other).alias("verdict"))
