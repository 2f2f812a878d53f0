"""Mixing sources to target weights with a splitting tree over block quotas.

The documents of a source are laid out in a random order as one stream of
words, which is cut into blocks.  The blocks of a source are put in random
order, those of a second and third time through the stream behind the first;
as many as its target needs are its quota, the last of them in part.

The quotas of all sources start at the root of a tree over the output shards.
A node puts the units of its quotas in random order and cuts that order exactly
in proportion to the shards on either side, so what a child gets of each source
is a multivariate hypergeometric draw from the quotas of its parent, and quotas
are used up exactly.  The quotas that reach the leaves say what is drawn: the
shards take consecutive runs of each source's random order of blocks, which are
therefore disjoint.  Inside a shard the drawn documents are shuffled.

All random choices are hashes of ids and a seed, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import word_count
from tideline.operators.running import row_numbers, running_totals
from tideline.session import materialize

#: Weights of the sources in code point order, repeating; a missing source comes last.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BLOCK_WORDS = 4096
SHARD_WORDS = 1 << 21
#: Documents that are laid out by one window.
LAYOUT_ROWS = 2000


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: its position, size and target, from rows with source and size.

    Targets share the size of all rows by weight.  A target stops at ``epochs``
    times its source's size; what that leaves over is shared again by weight
    among the others, until none is above.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    ordered = totals.withColumns({"__none": F.col("source").isNull(), "__name": F.coalesce("source", F.lit(""))})
    numbered = row_numbers(ordered, ["__none", "__name"], "pos")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = materialize(
        numbered.select(
            "source", "source_size", "source_rows", "pos",
            F.get(turn, ((F.col("pos") - 1) % len(weights)).cast("int")).alias("weight"),
        ),
        "sources",
    )
    cap = F.col("source_size") * F.lit(float(epochs))
    level = 0.0
    while True:
        full = cap < F.col("weight") * F.lit(level)
        total, capped, weight = sources.agg(
            F.sum("source_size"), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        raised = (float(total or 0) - float(capped or 0.0)) / float(weight) if weight else level
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def draws(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Lay out and draw documents with doc_id, text and source.

    Returns the rows laid out (doc_id, text_hash, copy, size, source,
    source_size, target, pos, start) and the draws (pos, start, epoch, shard, place): one draw for
    each time a row is taken, always whole.  The last row that a source needs
    of its last block is taken if at least half of it lies within the target.  Rows without words
    are never drawn.  Rows that share doc_id, source and text are told apart by
    ``copy``; they are counted, not ranked, so a missing or frequent id is not
    one task's work.
    """
    sized = materialize(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64("text").alias("text_hash"),
        ),
        "sizes",
    )
    counted = sized.groupBy("doc_id", "source", "text_hash", "size").agg(F.count(F.lit(1)).alias("__copies"))
    keyed = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    targets = source_targets(sized, weights, epochs)
    with_target = keyed.join(targets, keyed["source"].eqNullSafe(targets["source"])).select(
        "doc_id", "text_hash", "copy", "size", keyed["source"], "source_size", "source_rows", "target", "pos"
    )
    groups = F.ceil(F.col("source_rows") / LAYOUT_ROWS)
    order = F.xxhash64("doc_id", "source", "text_hash", "copy", F.lit(seed))
    spread = materialize(
        with_target.withColumns({"__order": order, "__group": F.pmod(F.xxhash64(order), groups)}).drop("source_rows"),
        "spread",
    )
    before = running_totals(
        spread.groupBy("pos", "__group").agg(F.sum("size").alias("__words")), ["__group"], {"__upto": "__words"}, ["pos"]
    ).select("pos", "__group", (F.col("__upto") - F.col("__words")).alias("__before"))
    inside = Window.partitionBy("pos", "__group").orderBy("__order", "doc_id", "text_hash", "copy").rowsBetween(Window.unboundedPreceding, -1)
    laid = materialize(
        spread.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(before, ["pos", "__group"])
        .select(
            "doc_id", "text_hash", "copy", "size", "source", "source_size", "target", "pos",
            (F.col("__before") + F.col("__in")).alias("start"),
        ),
        "laid",
    )
    full = laid.where(F.col("size") > 0).withColumn("block", F.floor(F.col("start") / block_words))
    quotas = materialize(block_quotas(full, epochs, seed), "block-quotas")
    dealt = deal(quotas, split(quotas.select("pos", F.col("rank").alias("unit"), "words"), shard_words, seed))
    # Of the last block of a source, what still fits its target.
    inside = F.col("start") - F.col("first") + F.col("size") / 2 <= F.col("room")
    taken = full.join(dealt, ["pos", "block"]).where(inside).select("pos", "start", "epoch", "shard")
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64("pos", "start", "epoch", F.lit(seed)), "pos", "start", "epoch")
    return laid, taken.withColumn("place", F.row_number().over(shuffled))


def block_quotas(full: DataFrame, epochs: int = MAX_EPOCHS, seed: int = 42) -> DataFrame:
    """(pos, epoch, block, words, first, rank, room): the blocks that the sources need, in the random order of each.

    ``full`` has rows with words: pos, block, start, size and target.  A
    source's quota is its largest rank.  ``room`` is how many words the target
    leaves for the block and all after it; it is below the block's words only
    for the last one.
    """
    blocks = full.groupBy("pos", "block").agg(
        F.sum("size").alias("words"), F.min("start").alias("first"), F.max("target").alias("target")
    )
    passes = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    keyed = passes.withColumn("__key", F.xxhash64("pos", "block", "epoch", F.lit(seed)))
    one = F.lit(1).cast("long")
    ordered = running_totals(keyed, ["epoch", "__key", "block"], {"upto": "words", "rank": one}, ["pos"])
    room = F.col("target") - (F.col("upto") - F.col("words"))
    return ordered.withColumn("room", room).where(F.col("room") > 0).select("pos", "epoch", "block", "words", "first", "rank", "room")


def deal(quotas: DataFrame, units: DataFrame) -> DataFrame:
    """The blocks with their shard: each shard takes as many of a source as quota units (pos, unit, shard) reached it."""
    numbered = row_numbers(units, ["shard", "unit"], "rank", ["pos"]).select("pos", "rank", "shard")
    return quotas.join(numbered, ["pos", "rank"])


def split(units: DataFrame, shard_words: int = SHARD_WORDS, seed: int = 42) -> DataFrame:
    """Assign each unit of the quotas (pos, unit, words) to a shard: a tree that halves the shards at every level.

    ``units`` is read twice, so it should be a written table.
    """
    words, count = units.agg(F.sum("words"), F.count(F.lit(1))).first()
    shards = max(1, min(count, -(-(words or 0) // shard_words)))
    # A node is the range of shards below it, with the number of units that reached it.
    facts = {"first": 0, "shards": shards, "size": count}
    root = units.select("pos", "unit", *[F.lit(n).cast("long").alias(name) for name, n in facts.items()])
    nodes = materialize(root, "split")
    level = 0
    while (1 << level) < shards:
        key = F.xxhash64("pos", "unit", F.lit(level), F.lit(seed))
        left_shards = F.floor((F.col("shards") + 1) / 2)
        placed = row_numbers(nodes.withColumn("__key", key), ["__key", "pos", "unit"], "__rank", ["first", "shards"])
        # The quota of the left child: its part of the units, to the nearest whole one.
        quota = F.floor((F.col("size") * left_shards * 2 + F.col("shards")) / (F.col("shards") * 2))
        left = F.col("__rank") <= quota
        nodes = placed.select(
            "pos", "unit",
            F.when(left, F.col("first")).otherwise(F.col("first") + left_shards).alias("first"),
            F.when(left, left_shards).otherwise(F.col("shards") - left_shards).alias("shards"),
            F.when(left, quota).otherwise(F.col("size") - quota).alias("size"),
        )
        level += 1
    return nodes.select("pos", "unit", F.col("first").alias("shard"))


def taken_words(laid: DataFrame, drawn: DataFrame) -> DataFrame:
    """The rows laid out, with the words the mix takes of each, repeats counted; how often, and into which first shard."""
    times = drawn.groupBy("pos", "start").agg(F.count(F.lit(1)).alias("times"), F.min("shard").alias("shard"))
    counted = laid.join(times, ["pos", "start"], "left")
    # Rows without words share the start of the row that follows them.
    held = F.col("size") > 0
    times, shard = F.when(held, F.coalesce("times", F.lit(0))).otherwise(0).cast("long"), F.when(held, F.col("shard"))
    return counted.withColumns({"draws": times, "first_shard": shard}).drop("times", "shard").withColumn("taken", F.col("size") * F.col("draws"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is drawn, with epoch, shard and place.

    A null text has no words and is never drawn; a null source is a source.
    Rows that repeat a doc_id are drawn each for itself.  Every column of
    ``docs`` comes back unchanged, except that columns named epoch, shard or
    place are replaced.  An empty table gives an empty mix.
    """
    laid, drawn = draws(docs, **options)
    full = laid.where(F.col("size") > 0)
    where = full.join(drawn, ["pos", "start"]).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__from"), F.col("text_hash").alias("__text"),
        F.col("copy").alias("__copy"), "epoch", "shard", "place",
    )
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c not in ("epoch", "shard", "place")]).alias("__row"),
        F.col("doc_id").alias("__own"),
        F.col("source").alias("__source"),
        F.xxhash64("text").alias("__hash"),
        F.xxhash64(*docs.columns).alias("__whole"),
    )
    same: Column = F.col("__own").eqNullSafe(F.col("__id")) & F.col("__source").eqNullSafe(F.col("__from")) & (F.col("__hash") == F.col("__text"))
    # Few rows share all of doc_id, source and text; only those are numbered.
    second = full.where(F.col("copy") == 2)
    several = materialize(
        second.select(F.col("doc_id").alias("__id"), F.col("source").alias("__from"), F.col("text_hash").alias("__text")), "several"
    )
    numbered = rows.withColumn("__number", F.lit(1).cast("long"))
    if not several.isEmpty():
        numbered = numbered.join(several, same, "left_anti").unionByName(_numbered(rows.join(several, same, "left_semi")))
    return numbered.join(where, same & (F.col("__number") == F.col("__copy"))).select("__row.*", "epoch", "shard", "place")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows that share a key, numbered in the order of their hash: in parts, as many of them may be one row repeated."""
    key = [F.col("__own"), F.col("__source"), F.col("__hash")]
    part = [*key, F.col("__whole"), F.col("__part")]
    parted = materialize(rows.withColumn("__part", F.spark_partition_id()), "repeats")
    upto = Window.partitionBy(*key).orderBy("__whole", "__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy(*part).agg(F.count(F.lit(1)).alias("__size"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(upto), F.lit(0)))
    a, b = parted.withColumn("__in", F.row_number().over(Window.partitionBy(*part).orderBy("__whole"))).alias("a"), sizes.alias("b")
    met = F.lit(True)
    for name in ("__own", "__source", "__hash", "__whole", "__part"):
        met = met & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    return a.join(b, met).select("a.*", (F.col("b.__before") + F.col("a.__in")).alias("__number")).drop("__part", "__in")
