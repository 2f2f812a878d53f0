"""Reproducible splits, folds, exact-size samples and bootstrap weights.

Randomness comes from the md5 of the row's key and a seed, so the result does
not depend on partitioning, task retries or the engine.  Keys must be unique.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.hashing import hash_number, hash_unit, key_hash
from tideline.operators.joins import union_all

BUCKET_DIGITS = 4  # 65,536 buckets


def split_flag(key: str, test_ratio: float, seed: int) -> Column:
    """True for the share of keys that belongs to the test set."""
    return hash_unit(key_hash(F.col(key), str(seed))) < test_ratio


def train_test(df: DataFrame, key: str, test_ratio: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; a ratio of zero or less gives all rows twice."""
    if test_ratio <= 0:
        return df, df
    test = split_flag(key, test_ratio, seed)
    return df.where(~test), df.where(test)


def hash_positions(df: DataFrame, key: str, seed: int | str, group: str, out: str = "position") -> DataFrame:
    """Position 1..n of every row within its group, in hash order.

    Rows are numbered inside evenly filled hash buckets, and each bucket is
    shifted by the sizes of the buckets before it: no task sorts a whole group.
    """
    tagged = df.withColumn("__h", key_hash(F.col(key), str(seed))).withColumn(
        "__b", F.substring("__h", 1, BUCKET_DIGITS)
    )
    sizes = tagged.groupBy(F.col(group).alias("__g"), F.col("__b").alias("__bb")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__g").orderBy("__bb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__g", "__bb", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = tagged.withColumn(
        "__rn", F.row_number().over(Window.partitionBy(group, "__b").orderBy("__h", key))
    )
    same = (inside[group] == offsets["__g"]) & (inside["__b"] == offsets["__bb"])
    return inside.join(offsets, same).select(*df.columns, (F.col("__rn") + F.col("__before")).alias(out))


def sample_exactly(df: DataFrame, key: str, group: str, sizes: Mapping, seed: int | str) -> DataFrame:
    """Exactly ``sizes[g]`` rows of each listed group (all, if it has fewer).

    The bucket in which a group reaches its size is found from bucket counts;
    everything below it is a plain filter, only that one bucket is ranked.
    """
    tagged = df.withColumn("__h", key_hash(F.col(key), str(seed))).withColumn(
        "__b", F.substring("__h", 1, BUCKET_DIGITS)
    )
    wanted = tagged.where(F.col(group).isin(list(sizes)))
    counts = wanted.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(group).orderBy("__b"))
    need = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, int(n))])[F.col(group)]
    cuts = (
        counts.withColumn("upto", upto)
        .where((F.col("upto") >= need) & (F.col("upto") - F.col("n") < need))
        .select(group, "__b", (need - (F.col("upto") - F.col("n"))).alias("rest"))
    )
    # At most one cut row per group comes back.
    cut = {r[group]: (r["__b"], r["rest"]) for r in cuts.collect()}
    whole, edge, rest = F.lit(False), F.lit(False), F.lit(0)
    for g, n in sizes.items():
        mine = F.col(group) == g
        if n <= 0:
            continue
        if g not in cut:
            whole = whole | mine
            continue
        bucket, left = cut[g]
        whole = whole | (mine & (F.col("__b") < bucket))
        edge = edge | (mine & (F.col("__b") == bucket))
        rest = F.when(mine, left).otherwise(rest)
    ranked = wanted.where(edge).withColumn(
        "__rn", F.row_number().over(Window.partitionBy(group).orderBy("__h", key))
    )
    parts = [wanted.where(whole).select(*df.columns), ranked.where(F.col("__rn") <= rest).select(*df.columns)]
    return union_all(parts)


def class_sizes(df: DataFrame, label: str) -> dict:
    """Rows per class; the label has few values by definition."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect() if r[label] is not None}


def balanced_subset(small: DataFrame, big: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Rows of ``big`` with the size and class mix of ``small``."""
    return sample_exactly(big, key, label, class_sizes(small, label), seed)


def fold_hash(df: DataFrame, key: str, folds: int, seed: int, out: str = "fold") -> DataFrame:
    """Fold number from the key alone: no shuffle, balanced in expectation."""
    h = hash_number(key_hash(F.col(key), str(seed)))
    return df.withColumn(out, F.pmod(h, F.lit(folds)).cast("int"))


def fold_stratified(df: DataFrame, key: str, label: str, folds: int, seed: int, out: str = "fold") -> DataFrame:
    """Folds whose class counts differ by at most one."""
    numbered = hash_positions(df, key, seed, label, "__p")
    return numbered.withColumn(out, F.pmod(F.col("__p") - 1, F.lit(folds)).cast("int")).drop("__p")


def _two_classes(df: DataFrame, label: str) -> tuple[object, int, object, int]:
    sizes = sorted(class_sizes(df, label).items(), key=lambda kv: (kv[1], -kv[0]))
    (minority, n_min), (majority, n_maj) = sizes[0], sizes[-1]
    return minority, n_min, majority, n_maj


def under_sample(df: DataFrame, key: str, label: str, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """As many rows of the largest class as give smallest/largest = ``ratio``; all other rows stay."""
    _, n_min, majority, n_maj = _two_classes(df, label)
    keep = min(n_maj, math.floor(n_min / ratio + 1e-9))
    rest = df.where(~F.col(label).eqNullSafe(F.lit(majority)))
    return rest.unionByName(sample_exactly(df, key, label, {majority: keep}, seed))


def over_sample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Repeat minority rows until both classes are equal; ``copy`` numbers the repeats.

    Every row is repeated equally often, and the remainder goes to the first
    rows in hash order.
    """
    minority, n_min, _, n_maj = _two_classes(df, label)
    base, extra = divmod(n_maj, n_min)
    small = hash_positions(df.where(F.col(label) == minority), key, seed, label, "__p")
    # One number per repeat, dealt to the rows by position: a rare row is not multiplied inside one task.
    repeats = df.sparkSession.range(n_min * base + extra).select(
        (F.col("id") % n_min + 1).alias("__at"), (F.floor(F.col("id") / n_min) + 1).cast("int").alias("copy")
    )
    repeated = small.join(repeats, F.col("__p") == F.col("__at")).drop("__p", "__at")
    rest = df.where(~F.col(label).eqNullSafe(F.lit(minority))).withColumn("copy", F.lit(1))
    return repeated.unionByName(rest)


def poisson_draw(u: Column, mean: float) -> Column:
    """Poisson count from a uniform number by inversion.

    The steps go on until what is left is below the resolution of a double, so
    no count is cut off; a mean above 100 is refused.
    """
    if not 0 <= mean <= 100:
        raise ValueError("the mean must lie between 0 and 100")
    chain, total, term, count = None, 0.0, math.exp(-mean), 0
    while count <= mean or term > 2.0**-60:
        total += term
        chain = F.when(u < total, count) if chain is None else chain.when(u < total, count)
        count += 1
        term *= mean / count
    return chain.otherwise(count)


def bag_weights(df: DataFrame, key: str, bag: Column | int, seed: int = 42) -> DataFrame:
    """Rows of one bootstrap replicate with their draw count in ``weight``.

    A projection and a filter: every bag is derived from the rows when it is
    read, so no replicate is ever stored.
    """
    number = bag if isinstance(bag, Column) else F.lit(bag)
    tagged = df.withColumn("__u", hash_unit(key_hash(F.col(key), number, str(seed))))
    return tagged.withColumn("weight", poisson_draw(F.col("__u"), 1.0)).drop("__u").where(F.col("weight") > 0)


def bag_sizes(sizes: Mapping, strategy: str = "not minority") -> dict:
    """How often each class of a bag is drawn from.

    The classes that the strategy names come down to the size of the smallest
    one; the others are drawn as often as they have rows.
    """
    if strategy not in ("majority", "not majority", "not minority", "all"):
        raise ValueError(f"unknown strategy {strategy!r}")
    order = sorted(sizes, key=lambda c: (sizes[c], str(c)))
    smallest, largest = order[0], order[-1]
    named = {"majority": {largest}, "not majority": set(order) - {largest}, "not minority": set(order) - {smallest}, "all": set(order)}
    return {c: sizes[smallest] if c in named[strategy] else n for c, n in sizes.items()}


def split_draws(counts: np.ndarray, draws: int, random: np.random.Generator) -> np.ndarray:
    """Deal ``draws`` out over places in proportion to ``counts``: a tree that halves the places at every level.

    What goes to the left half of a node is binomial in its share of the
    counts, so the draws add up exactly and each is independent of the others.
    """
    width = 1 << max(0, int(np.ceil(np.log2(max(1, len(counts))))))
    levels = [np.concatenate([counts, np.zeros(width - len(counts), dtype=np.int64)]).astype(np.int64)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
    dealt = np.array([draws], dtype=np.int64)
    for below in reversed(levels[:-1]):
        pairs = below.reshape(-1, 2)
        share = pairs[:, 0] / np.maximum(1, pairs.sum(axis=1))
        left = random.binomial(dealt, share)
        dealt = np.stack([left, dealt - left], axis=1).ravel()
    return dealt[: len(counts)]


#: Rows of a class that one task draws from, about.
BAG_ROWS = 200_000


def exact_bags(df: DataFrame, key: str, label: str, bags: int, strategy: str = "not minority", seed: int = 42) -> DataFrame:
    """(key, weights): how often each row is drawn into each bag, with replacement.

    Every class of every bag has exactly the size that the strategy asks for,
    whatever the number of classes.  The draws of a class are split over hash
    buckets of its keys, and inside each bucket over its rows; keys are unique,
    and rows without key or label are left out.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(key, F.col(label).alias("__class"))
    sizes = class_sizes(rows, "__class")
    wanted = bag_sizes(sizes, strategy) if sizes else {}
    bits = max(0, math.ceil(math.log2(max(1, max(sizes.values(), default=1) / BAG_ROWS))))
    h = key_hash(F.col(key), str(seed))
    spread = rows.withColumns({"__h": h, "__bucket": F.shiftright(hash_number(h), 32 - bits) if bits else F.lit(0).cast("long")})
    # One row for each class and bucket.
    counts = spread.groupBy("__class", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    kind, own = rows.schema["__class"].dataType.simpleString(), rows.schema[key].dataType.simpleString()

    def random(*parts) -> np.random.Generator:
        return np.random.Generator(np.random.Philox(key=int.from_bytes(hashlib.md5("|".join(map(str, (seed, *parts))).encode()).digest()[:8], "big")))

    def over_buckets(group: tuple, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("__bucket")
        n, draws = table["__n"].to_numpy(), wanted[group[0]]
        dealt = [split_draws(n, draws, random(group[0], b)) for b in range(bags)]
        return table[["__class", "__bucket"]].assign(__draws=list(np.stack(dealt, axis=1)))

    split = counts.groupBy("__class").applyInPandas(over_buckets, f"__class {kind}, __bucket long, __draws array<long>")

    def over_rows(group: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["__h", key])
        ones = np.ones(len(left), dtype=np.int64)
        draws = right["__draws"].iloc[0]
        dealt = [split_draws(ones, draws[b], random(*group, b)) for b in range(bags)]
        return pd.DataFrame({key: left[key], "weights": list(np.stack(dealt, axis=1).astype("int32"))})

    by = ["__class", "__bucket"]
    return spread.groupBy(*by).cogroup(split.groupBy(*by)).applyInPandas(over_rows, f"`{key}` {own}, weights array<int>")


def bootstrap(
    df: DataFrame, key: str, bags: int, seed: int = 42, label: str | None = None, strategy: str = "not minority"
) -> DataFrame:
    """Rows of ``bags`` bootstrap replicates, numbered in ``bag``, with their draw count in ``weight``.

    Without ``label`` every row is drawn by a Poisson count of mean one, which
    needs no shuffle.  With it the draws of every class are exact, as
    ``strategy`` asks for.
    """
    if label is None:
        bagged = df.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(bags - 1))))
        return bag_weights(bagged, key, F.col("bag"), seed)
    weights = exact_bags(df, key, label, bags, strategy, seed).withColumnRenamed(key, "__key")
    drawn = df.join(weights, df[key] == weights["__key"]).select(*df.columns, F.posexplode("weights").alias("bag", "weight"))
    return drawn.where(F.col("weight") > 0)
