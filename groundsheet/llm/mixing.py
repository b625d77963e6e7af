"""Mixing sources to target weights, by blocks; built-in functions only.

The words of each source, document after document, are cut into blocks of a fixed length.  The mix
is a sequence of slots, cut into output shards.  Every source fills a fixed number of slots; which
ones is drawn by a pseudorandom permutation of all slots.  So a shard's counts are multinomial
draws given the totals of the corpus, which keeps every source at its target and within its limit,
where free draws would leave both.  A source's slots run through pseudorandom permutations of its
block numbers, one after the other, and are joined to its blocks by number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundsheet.operators.lineage import materialize

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated so often at most.
LIMIT = 3
BLOCK_WORDS, SHARD_SLOTS, ROUNDS = 64, 4096, 12
PRIME = 2**31 - 1
#: Rows that one chunk of a source should hold, and slots made from one row.
CHUNK_ROWS, RUN_SLOTS = 2_000, 16_384


def permutation_keys(seed: Column) -> Column:
    """Keys of each round of a permutation, from the md5 of seed and round."""

    def number(text: Column, first: int, digits: int) -> Column:
        return F.conv(F.substring(text, first, digits), 16, 10).cast("long")

    digests = F.transform(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda k: F.md5(F.concat_ws("/", seed.cast("string"), k.cast("string")))
    )
    return F.transform(
        digests,
        lambda d: F.struct((number(d, 1, 7) + 1).alias("a"), number(d, 8, 7).alias("b"), number(d, 15, 15).alias("mirror")),
    )


def permuted(x: Column, n: Column, keys: Column) -> Column:
    """Where a pseudorandom permutation of 0 .. n - 1 puts x.

    Swap-or-not: each round pairs a place with its mirror image around a keyed number and swaps the
    two if a bit of the pair, hashed by a keyed line over a prime field, says so.  A round is its
    own inverse, so every n has its permutation.
    """

    def round_(at: Column, key: Column) -> Column:
        mirror = F.pmod(key["mirror"] % n + n - at, n)
        hashed = (F.greatest(at, mirror) % PRIME * key["a"] + key["b"]) % PRIME
        return F.when(F.floor(hashed / 1024) % 2 == 1, mirror).otherwise(at)

    return F.aggregate(keys, x.cast("long"), round_)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, source_size, docs, target, seq and weight of every source of ``sizes`` (source, size).

    Sources stand in code point order, null last.  Targets share the sum of all sizes by weight and
    stop at ``limit`` times a source's size, the excess reshared by weight: all targets are
    ``min(limit * size, level * weight)``, with the level found by going through the sources in
    the order in which they reach their limit.  Windows run over one row per source.
    """
    all_ = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    seq = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    named = all_.withColumn("seq", seq.cast("long")).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("seq") - 1) % len(weights) + 1).cast("int"))
    )
    capped = named.withColumn("cap", F.lit(limit) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "seq")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    found = capped.withColumn("level", level).withColumn(
        "open", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    )
    water = F.min_by("open", F.when(F.col("open").isNotNull(), F.col("cap") / F.col("weight"))).over(Window.partitionBy(F.lit(1)))
    return found.withColumn("water", water).select(
        "source", "source_size", "docs", "seq", "weight",
        F.least(F.col("cap").cast("double"), F.coalesce("water", F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def block_rows(documents: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pieces of documents in blocks: doc_id, source number, block, words of the document in it.

    Where a document starts in its source is a sum in two steps, over chunks of documents by a hash
    of their ids and within a chunk, so that no window holds a whole source.
    """
    docs = documents.join(sources.select("source", "seq", "docs"), documents.source.eqNullSafe(sources.source)).select(
        "row", "size", "seq", F.pmod(F.xxhash64("row"), F.ceil(F.col("docs") / CHUNK_ROWS)).alias("chunk")
    )
    totals = docs.groupBy("seq", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("seq").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("base", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    inside = Window.partitionBy("seq", "chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, ["seq", "chunk"])
    start = F.col("base") + F.col("ahead")
    first, last = F.floor(start / block_words), F.floor((start + F.col("size") - 1) / block_words)
    cut = placed.where("size > 0").select("row", "seq", "size", start.alias("start"), F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.select("row", "seq", "block", (low - F.col("start")).alias("offset"), (high - low).alias("words"))


def slots(sources: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, place, source number and block of every slot of the mix.

    A source of n blocks and target t fills ``round(t * n / size)`` slots, n times the limit at
    most.  Slots are made in runs, so that one source is many tasks' work.
    """
    counted = sources.where("source_size > 0").select(
        "seq", F.ceil(F.col("source_size") / block_words).alias("blocks"), "target", "source_size"
    )
    counted = counted.withColumn("slots", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))
    counted = counted.withColumn(
        "base", F.coalesce(F.sum("slots").over(Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("total", F.sum("slots").over(Window.partitionBy(F.lit(1))))
    epochs = counted.where("slots > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / F.col("blocks"))))
    )
    done = F.col("epoch") * F.col("blocks")
    epochs = epochs.select(
        "seq", "blocks", "total", (F.col("base") + done).alias("base"), F.least("blocks", F.col("slots") - done).alias("n"),
        permutation_keys(F.concat_ws("/", F.lit(str(seed)), "seq", "epoch")).alias("keys"),
        permutation_keys(F.lit(str(seed))).alias("all_keys"),
    )
    runs = epochs.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN_SLOTS).cast("long"))))
    last = F.least(F.col("first") + RUN_SLOTS, F.col("n")) - 1
    total = sources.agg(F.sum("target")).first()[0] or 0
    tasks = max(sources.sparkSession.sparkContext.defaultParallelism, math.ceil(total / block_words / (8 * RUN_SLOTS)))
    made = runs.repartition(tasks, "base", "first").withColumn("j", F.explode(F.sequence("first", last)))
    place = permuted(F.col("base") + F.col("j"), F.col("total"), F.col("all_keys"))
    return made.select(
        F.floor(place / shard_slots).alias("shard"), (place % shard_slots).alias("place"), "seq",
        permuted(F.col("j"), F.col("blocks"), F.col("keys")).alias("block"),
    )


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source and size of every row, with ``row``, a text that orders and names rows alike in every run."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
    )
    counted = docs.groupBy("doc_id", "source", "size").agg(F.count("*").alias("times"))
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    name = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), source, "size", "copy")
    return copies.withColumn("row", name)


def mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, seed: int = 0,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and first_shard of every row of ``documents`` (doc_id, source, text).

    ``taken`` counts the words of the document in the mix, repeats included: those of its pieces
    times how often their block was drawn.  A source's blocks are drawn equally often but for one,
    so no document is taken more than ``limit`` times its size.  ``first_shard`` is the first output
    shard that holds some of it.  The same rows give the same mix.

    Null texts and texts without a word have size 0 and are never taken; a null source is a source
    of its own, last in order; a null doc_id keeps its row; repeated rows are documents of their
    own; an empty table gives no rows.  Other columns are not read.
    """
    docs = materialize(sized(documents), "sized")
    sources = materialize(source_targets(docs.select("source", "size"), weights, limit), "sources")
    pieces = block_rows(docs, sources, block_words)
    drawn = slots(sources, seed, block_words).groupBy("seq", "block").agg(
        F.count("*").alias("times"), F.min("shard").alias("shard")
    )
    # Spark takes exploded slots for as small as the sources they came from, and would broadcast them.
    taken = pieces.join(drawn.hint("merge"), ["seq", "block"]).groupBy("row").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"), F.min("shard").alias("first_shard")
    )
    told = sources.select(F.col("source").alias("s"), "source_size", "target")
    named = docs.join(told, docs.source.eqNullSafe(F.col("s")))
    return named.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_shard"
    )
