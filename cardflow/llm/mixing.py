"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

1. Targets. Weights go round over the sources in the order of their code points, null last.
   A target stops at ``MAX_REPEATS`` times its source's size; the excess goes to the other
   sources by weight until none is above (in closed form: sources in the order of size by
   weight, with running totals).
2. Apportionment. All sources share N blocks of ``BLOCK_WORDS`` words: N seats, won by the
   highest quotients target / (2k - 1). Each source's blocks are then apportioned in the
   same way to its shards, by their sizes. Seats below the highest quotients that can be in
   doubt are given at once, so only about two rows for each party are ranked.
3. Selection. A shard is the documents of a source that fall together by a seeded hash, in
   seeded order, cut into equal blocks. Whole rounds take every block; the rest is a run of
   blocks from a seeded start, around the end. All documents but those at the run's ends are
   thus taken whole, and a document's share follows from its place by arithmetic.

Only DataFrame functions are used. Nothing but rows of sources and shards is grouped; words
are counted in one pass, and a hot source has more shards, not larger ones.

Edge cases: null and blank texts have size 0 and are not taken. A null source is a source of
its own, different from an empty one. Repeated ids are documents of their own. A source
without words has target 0. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.common import stored

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 8
SHARD_WORDS = 1 << 21
SEED = 6


def size_of(text: str) -> Column:
    """Number of words: maximal runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target from source, source_size."""
    cycle = F.array(*map(F.lit, weights))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    rows = sizes.withColumn("weight", F.element_at(cycle, place.cast("int")).cast("double"))
    # The smaller its capacity for its weight, the sooner a source is full.
    rows = rows.withColumn("fill", repeats * F.col("source_size") / F.col("weight"))
    ranked = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    onward = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy(F.lit(1))
    rows = rows.withColumns(
        {
            "left": F.sum("source_size").over(everyone)
            - repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
            "weights": F.sum("weight").over(onward),
        }
    )
    # The level of the first source that doesn't fill up holds for all after it.
    open_level = F.when(F.col("left") / F.col("weights") <= F.col("fill"), F.col("left") / F.col("weights"))
    rows = rows.withColumn("level", F.first(open_level, ignorenulls=True).over(ranked.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("level").isNull(), (repeats * F.col("source_size")).cast("double"))
    target = target.otherwise(F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", F.least(target, repeats * F.col("source_size")).alias("target"))


def apportion(rows: DataFrame, within: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """``rows`` with ``won``: how many of ``seats`` each row gets in its group ``within``.

    Sainte-Lague: seats go to the highest quotients votes / (2k - 1), equal ones in the
    order of ``party``. With n parties, S seats and V votes a seat with a quotient above
    V / (S - n/2) / 2 is surely won and one below V / (S + n/2) / 2 surely lost.
    """
    group = Window.partitionBy(*[F.col(c) for c in within] or [F.lit(1)])
    rows = rows.withColumns(
        {"_votes": F.sum(votes).over(group), "_half": F.count(F.lit(1)).over(group) / 2}
    )
    share = lambda seats: F.when(F.col("_votes") > 0, F.col(votes) * seats / F.col("_votes")).otherwise(0)
    # One seat more on both sides makes up for rounding of the quotients.
    surely = F.floor(share(F.greatest(F.col(seats) - F.col("_half"), F.lit(0))) + 0.5) - 1
    at_most = F.floor(share(F.col(seats) + F.col("_half")) + 0.5) + 1
    rows = rows.withColumns({"_sure": F.greatest(surely, F.lit(0)), "_most": at_most})
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_sure").over(group))
    tried = rows.withColumn("_k", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))))
    best = group.orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), F.col(party).asc_nulls_last(), "_k")
    won = (F.row_number().over(best) <= F.col("_open")) & (F.col(votes) > 0)
    tried = tried.withColumn("_won", won.cast("long"))
    own = [c for c in rows.columns if not c.startswith("_")]
    return tried.groupBy(*own).agg((F.first("_sure") + F.sum("_won")).alias("won"))


def mix(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, and ``carried`` columns.

    ``taken`` words are ``rounds`` times the whole text and a rest: the words from ``first``
    (counted from 0) up to ``last``, or where ``around``, those before ``last`` and those
    from ``first`` on.
    """
    carried = tuple(c for c in carried if c != "doc_id")
    sized = docs.select("doc_id", "source", *carried, size_of("text").alias("size"))
    sized = stored(sized, "sizes")
    everyone = Window.partitionBy(F.lit(1))
    seats = F.round(F.sum("source_size").over(everyone) / BLOCK_WORDS).cast("long")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = apportion(sources.withColumn("seats", seats), [], "source", "target", "seats")
    shards = F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)).alias("shards")
    sources = sources.select("source", "source_size", "target", F.col("won").alias("blocks"), shards)
    # Written, so that Spark shuffles both sides of a join for the join and can split a hot
    # source.
    sources = stored(sources, "sources")

    same = sized["source"].eqNullSafe(sources["source"])
    order = F.xxhash64("doc_id", F.lit(SEED))
    rows = sized.join(sources, same, "left").drop(sources["source"]).withColumns(
        {"order": order, "shard": F.pmod(F.xxhash64(order, F.lit(SEED)), F.col("shards"))}
    )
    sizes = rows.groupBy("source", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(sizes, ["source"], "shard", "shard_size", "blocks")
    cuts = F.greatest(F.round(F.col("shard_size") / BLOCK_WORDS), F.lit(1)).cast("long")
    quotas = quotas.withColumn("cuts", cuts).select(
        F.coalesce("source", F.lit("")).alias("_source"),
        F.col("source").isNull().alias("_null"),
        F.col("shard").alias("_shard"),
        "shard_size",
        "cuts",
        F.least("won", F.col("cuts") * MAX_REPEATS).alias("won"),
        F.pmod(F.xxhash64("source", "shard", F.lit(SEED)), F.col("cuts")).alias("start"),
    )
    quotas = stored(quotas, "quotas")

    in_order = Window.partitionBy("source", "shard").orderBy("order", "doc_id", "size", *carried)
    until = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    keys = (
        (F.coalesce(F.col("source"), F.lit("")) == F.col("_source"))
        & (F.col("source").isNull() == F.col("_null"))
        & (F.col("shard") == F.col("_shard"))
    )
    rows = rows.withColumn("begin", until - F.col("size")).join(quotas, keys, "left")
    word_of = lambda block: F.floor(block * F.col("shard_size") / F.col("cuts"))
    inside = lambda word: F.greatest(F.lit(0), F.least(word - F.col("begin"), F.col("size")))
    rest = F.col("won") % F.col("cuts")
    stop = F.col("start") + rest
    rows = rows.withColumns(
        {
            "rounds": F.floor(F.col("won") / F.col("cuts")),
            "around": stop > F.col("cuts"),
            "first": inside(word_of(F.col("start"))),
            "last": inside(word_of(F.when(stop > F.col("cuts"), stop - F.col("cuts")).otherwise(stop))),
        }
    )
    more = F.when(F.col("around"), F.col("last") + F.col("size") - F.col("first")).otherwise(F.col("last") - F.col("first"))
    rows = rows.withColumn("taken", F.col("rounds") * F.col("size") + more)
    return rows.select("doc_id", "size", "source_size", "target", "taken", "rounds", "around", "first", "last", *carried)


def mixed_documents(docs: DataFrame, id_columns: tuple[str, ...]) -> DataFrame:
    """The mix as documents: a row for each time a text is taken, cut ones with the words taken.

    ``id_columns`` tell rows apart. ``n_chars`` follows the text; other columns stay.
    """
    # Names that no column of the documents has.
    prefix = "_mix_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    own = lambda name: F.col(f"{prefix}{name}")
    carried = (*id_columns, "size", "taken", "rounds", "around", "first", "last")
    found = mix(docs.select("doc_id", "source", "text", *[c for c in id_columns if c != "doc_id"]), id_columns)
    found = found.filter("taken > 0").select(*[F.col(c).alias(f"{prefix}{c}") for c in carried])
    same = [docs[c] == found[f"{prefix}{c}"] for c in id_columns]
    size, first, last = own("size"), own("first"), own("last")
    rows = docs.join(found, same).withColumn(f"{prefix}rest", own("taken") - own("rounds") * size)
    whole = F.when(own("rest") == size, own("rounds") + 1).otherwise(own("rounds"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.when(
        own("around"), F.concat(F.slice(words, F.lit(1), last), F.slice(words, first + 1, size - first))
    ).otherwise(F.slice(words, first + 1, F.greatest(last - first, F.lit(0))))
    part = F.when((own("rest") > 0) & (own("rest") < size), F.array_join(cut, " "))
    texts = F.concat(F.array_repeat("text", whole.cast("int")), F.filter(F.array(part), lambda t: t.isNotNull()))
    kept = [c for c in docs.columns if c != "text"]
    out = rows.select(*[docs[c] for c in kept], F.explode(texts).alias("text"))
    if "n_chars" in kept:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
