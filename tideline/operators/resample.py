"""Neighbour-based resampling of a two-class table.

All methods are built on the exact neighbour table.  Synthetic rows are drawn
by hash, so they are the same on every run.  Sources: Chawla 2002 (SMOTE,
SMOTE-NC), He 2008 (ADASYN), Han 2005 (borderline), Tomek 1976 (links, all
k-NN), Laurikkala 2001 (neighbourhood cleaning), Kubat 1997 (one-sided
selection), Mani 2003 (NearMiss).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.hashing import hash_number, hash_unit, key_hash
from tideline.operators import sampling
from tideline.operators.encode import category
from tideline.operators.neighbours import nearest_neighbours
from tideline.operators.running import row_numbers
from tideline.session import materialize


def _points(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    return df.select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.col(label).alias("label"),
    )


def labelled_neighbours(df: DataFrame, key: str, vector: str, label: str, k: int, **search) -> DataFrame:
    """Neighbour table with the label of the row and of the neighbour."""
    points = _points(df, key, vector, label)
    near = nearest_neighbours(points, "id", "vector", k, **search)
    mine = points.select("id", "label")
    theirs = points.select(F.col("id").alias("neighbour"), F.col("label").alias("neighbour_label"))
    return near.join(mine, "id").join(theirs, "neighbour")


# -- synthetic rows ----------------------------------------------------------


def _between(a: Column, b: Column, share: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + share * (y - x))


#: Draws of one row that are made in one place.
LOT = 1_000


def _draws(copies: DataFrame) -> DataFrame:
    """(id, draw) with draws 1..n of every (id, n).

    The draws of all rows are one running total; it is dealt out in lots, so a
    row that gets nearly all draws is not the work of one task.
    """
    wanted = copies.where(F.col("n") > 0).select("id", F.col("n").cast("long").alias("n"))
    lots = wanted.select("id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / LOT))).alias("lot"))
    last = F.least(F.col("n"), (F.col("lot") + 1) * LOT)
    dealt = lots.repartition("id", "lot")
    return dealt.select("id", F.explode(F.sequence((F.col("lot") * LOT + 1).cast("int"), last.cast("int"))).alias("draw"))


def _synthesize(minority: DataFrame, copies: DataFrame, near: DataFrame, k: int, seed: int) -> DataFrame:
    """(id, draw, neighbour, vector): ``copies`` holds (id, n) synthetic rows per minority row."""
    draws = _draws(copies)
    h = key_hash(F.col("id"), F.col("draw"), str(seed))
    draws = draws.select(
        "id",
        "draw",
        (F.pmod(hash_number(h, 1), F.lit(k)) + 1).cast("int").alias("rank"),
        hash_unit(h, 9).alias("share"),
    )
    ends = minority.select(F.col("id").alias("neighbour"), F.col("vector").alias("end"))
    picked = draws.join(near.select("id", "rank", "neighbour"), ["id", "rank"])
    return (
        picked.join(ends, "neighbour")
        .join(minority.select("id", "vector"), "id")
        .select("id", "draw", "neighbour", _between(F.col("vector"), F.col("end"), F.col("share")).alias("vector"))
    )


def _even_copies(rows: DataFrame, need: int, n_rows: int, seed: int) -> DataFrame:
    """``need`` copies over ``n_rows`` rows: equal shares, the rest by hash order."""
    base, extra = divmod(need, n_rows)
    placed = sampling.hash_positions(rows.select("id", F.lit(0).alias("one")), "id", seed, "one", "p")
    return placed.select("id", (F.lit(base) + F.when(F.col("p") <= extra, 1).otherwise(0)).alias("n"))


def _gap(points: DataFrame) -> tuple[object, int, object, int]:
    return sampling._two_classes(points, "label")


def smote(df: DataFrame, key: str, vector: str, label: str, k: int = 5, seed: int = 42, **search) -> DataFrame:
    """Synthetic minority rows that make both classes equal in size."""
    points = _points(df, key, vector, label)
    minority, n_min, _, n_maj = _gap(points)
    small = materialize(points.where(F.col("label") == minority), "minority")
    k = min(k, n_min - 1)
    near = nearest_neighbours(small, "id", "vector", k, **search)
    copies = _even_copies(small, n_maj - n_min, n_min, seed)
    return _synthesize(small, copies, near, k, seed).withColumn("label", F.lit(minority))


def borderline_smote(
    df: DataFrame, key: str, vector: str, label: str, k: int = 5, m: int = 10, seed: int = 42, **search
) -> DataFrame:
    """SMOTE from the minority rows in danger: half or more, but not all, of ``m`` neighbours are majority."""
    points = _points(df, key, vector, label)
    minority, n_min, _, n_maj = _gap(points)
    small = materialize(points.where(F.col("label") == minority), "minority")
    around = nearest_neighbours(points, "id", "vector", m, **search)
    labels = points.select(F.col("id").alias("neighbour"), F.col("label").alias("theirs"))
    votes = (
        around.join(small.select("id"), "id", "left_semi")
        .join(labels, "neighbour")
        .groupBy("id")
        .agg(F.count_if(F.col("theirs") != minority).alias("against"), F.count(F.lit(1)).alias("all"))
    )
    danger = materialize(
        votes.where((2 * F.col("against") >= F.col("all")) & (F.col("against") < F.col("all"))).select("id"), "danger"
    )
    n_danger = danger.count()
    k = min(k, n_min - 1)
    near = nearest_neighbours(small, "id", "vector", k, **search)
    if n_danger == 0:
        copies = danger.withColumn("n", F.lit(0))
    else:
        copies = _even_copies(danger, n_maj - n_min, n_danger, seed)
    return _synthesize(small, copies, near, k, seed).withColumn("label", F.lit(minority))


def adasyn(df: DataFrame, key: str, vector: str, label: str, k: int = 5, seed: int = 42, **search) -> DataFrame:
    """SMOTE with more copies where more of the neighbours are majority rows."""
    points = _points(df, key, vector, label)
    minority, n_min, _, n_maj = _gap(points)
    small = materialize(points.where(F.col("label") == minority), "minority")
    around = nearest_neighbours(points, "id", "vector", k, **search)
    labels = points.select(F.col("id").alias("neighbour"), F.col("label").alias("theirs"))
    hard = materialize(
        around.join(small.select("id"), "id", "left_semi")
        .join(labels, "neighbour")
        .groupBy("id")
        .agg(F.avg((F.col("theirs") != minority).cast("double")).alias("r")),
        "hardness",
    )
    total = hard.agg(F.sum("r")).first()[0] or 0.0
    share = F.col("r") / F.lit(total) if total else F.lit(0.0)
    copies = hard.select("id", F.round(share * F.lit(n_maj - n_min)).cast("long").alias("n"))
    k = min(k, n_min - 1)
    near = nearest_neighbours(small, "id", "vector", k, **search)
    return _synthesize(small, copies, near, k, seed).withColumn("label", F.lit(minority))


def smote_nc(
    df: DataFrame,
    key: str,
    vector: str,
    label: str,
    categorical: Sequence[str],
    k: int = 5,
    seed: int = 42,
    **search,
) -> DataFrame:
    """SMOTE for mixed columns.

    A differing category adds the square of the median of the numeric deviations
    (of the minority class) to the squared distance; a synthetic row takes the
    most frequent category of the k neighbours, the smallest of equals.  Without
    categories this is SMOTE.
    """
    if not categorical:
        return smote(df, key, vector, label, k, seed, **search)
    rows = df.select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.col(label).alias("label"),
        *[category(F.col(c)).alias(c) for c in categorical],
    )
    minority, n_min, _, n_maj = _gap(rows)
    small = materialize(rows.where(F.col("label") == minority), "minority")
    width = small.select(F.max(F.size("vector"))).first()[0]
    if not width:
        raise ValueError("mixed sampling needs a numeric column to measure categories by")
    devs = sorted(small.agg(*[F.stddev_samp(F.col("vector")[i]) for i in range(width)]).first())
    half = len(devs) // 2
    median = devs[half] if len(devs) % 2 else (devs[half - 1] + devs[half]) / 2
    k = min(k, n_min - 1)
    near = materialize(nearest_neighbours(small, "id", "vector", k, categorical=categorical, penalty=median, **search), "near")
    copies = _even_copies(small, n_maj - n_min, n_min, seed)
    numeric = _synthesize(small, copies, near, k, seed)
    theirs = small.select(F.col("id").alias("neighbour"), *categorical)
    modes = near.join(theirs, "neighbour").groupBy("id").agg(
        *[F.mode(c, deterministic=True).alias(c) for c in categorical]
    )
    return numeric.join(modes, "id").withColumn("label", F.lit(minority))


# -- removal -----------------------------------------------------------------


def tomek_links(df: DataFrame, key: str, vector: str, label: str, **search) -> DataFrame:
    """Pairs of rows with different labels that are each other's nearest neighbour."""
    near = labelled_neighbours(df, key, vector, label, 1, **search)
    other = near.where(F.col("label") != F.col("neighbour_label")).select("id", "neighbour", "label")
    back = other.select(F.col("neighbour").alias("id"), F.col("id").alias("neighbour"))
    return other.join(back, ["id", "neighbour"], "left_semi")


def without(df: DataFrame, key: str, removed: DataFrame) -> DataFrame:
    gone = removed.select(F.col(removed.columns[0]).alias("__id")).distinct()
    return df.join(gone, df[key].cast("long") == gone["__id"], "left_anti")


def remove_tomek(df: DataFrame, key: str, vector: str, label: str, both: bool = False, **search) -> DataFrame:
    """Drop the majority row of every link, or both rows."""
    _, _, majority, _ = sampling._two_classes(df, label)
    links = tomek_links(df, key, vector, label, **search)
    return without(df, key, links if both else links.where(F.col("label") == majority))


def smote_tomek(df: DataFrame, key: str, vector: str, label: str, k: int = 5, seed: int = 42, **search) -> DataFrame:
    """SMOTE, then both rows of every Tomek link removed.

    Rows are numbered ``(id, draw)``; original rows have draw 0.
    """
    points = _points(df, key, vector, label).withColumn("draw", F.lit(0))
    made = smote(df, key, vector, label, k, seed, **search).select("id", "vector", "label", "draw")
    both = points.select("id", "vector", "label", "draw").unionByName(made)
    numbered = materialize(row_numbers(both, ["draw", "id"], "row"), "balanced")
    return remove_tomek(numbered, "row", "vector", "label", both=True, **search).drop("row")


def outvoted(
    df: DataFrame, key: str, vector: str, label: str, k: int, kind: str = "mode", **search
) -> DataFrame:
    """(id, label) of rows whose neighbours contradict their label.

    ``kind='mode'``: more than half of the neighbours differ.  ``kind='all'``:
    any neighbour differs.
    """
    near = labelled_neighbours(df, key, vector, label, k, **search)
    differ = F.count_if(F.col("neighbour_label") != F.col("label"))
    votes = near.groupBy("id", "label").agg(differ.alias("differ"), F.count(F.lit(1)).alias("n"))
    bad = F.col("differ") > 0 if kind == "all" else 2 * F.col("differ") > F.col("n")
    return votes.where(bad).select("id", "label")


def edited_neighbours(
    df: DataFrame, key: str, vector: str, label: str, k: int = 3, kind: str = "all", **search
) -> DataFrame:
    """Drop majority rows contradicted by their k neighbours."""
    _, _, majority, _ = sampling._two_classes(df, label)
    bad = outvoted(df, key, vector, label, k, kind, **search)
    return without(df, key, bad.where(F.col("label") == majority))


def all_knn(df: DataFrame, key: str, vector: str, label: str, k: int = 3, kind: str = "all", **search) -> DataFrame:
    """Drop majority rows contradicted at any neighbourhood size from 1 to ``k``.

    One neighbour table serves all sizes.
    """
    _, _, majority, _ = sampling._two_classes(df, label)
    near = labelled_neighbours(df, key, vector, label, k, **search)
    differs = F.col("neighbour_label") != F.col("label")
    counts = near.where(F.col("label") == majority).groupBy("id").agg(
        *[F.count_if(differs & (F.col("rank") <= i)).alias(f"d{i}") for i in range(1, k + 1)]
    )
    bad = F.lit(False)
    for i in range(1, k + 1):
        bad = bad | ((F.col(f"d{i}") > 0) if kind == "all" else (2 * F.col(f"d{i}") > i))
    return without(df, key, counts.where(bad).select("id"))


def neighbourhood_cleaning(df: DataFrame, key: str, vector: str, label: str, k: int = 11, **search) -> DataFrame:
    """Drop outvoted majority rows, and majority neighbours of outvoted minority rows."""
    _, _, majority, _ = sampling._two_classes(df, label)
    near = materialize(labelled_neighbours(df, key, vector, label, k, **search), "near")
    differ = F.count_if(F.col("neighbour_label") != F.col("label"))
    votes = near.groupBy("id", "label").agg(differ.alias("differ"), F.count(F.lit(1)).alias("n"))
    bad = votes.where(2 * F.col("differ") > F.col("n"))
    own = bad.where(F.col("label") == majority).select("id")
    lost = bad.where(F.col("label") != majority).select("id")
    around = near.where(F.col("neighbour_label") == majority).join(lost, "id", "left_semi").select(
        F.col("neighbour").alias("id")
    )
    return without(df, key, own.unionByName(around))


def one_sided_selection(df: DataFrame, key: str, vector: str, label: str, seed: int = 42, **search) -> DataFrame:
    """Keep the minority, one seed majority row and the majority rows that 1-NN on
    those misclassifies; then drop the majority rows of the Tomek links."""
    points = _points(df, key, vector, label)
    minority, n_min, majority, _ = _gap(points)
    small = points.where(F.col("label") == minority)
    large = points.where(F.col("label") == majority)
    start = sampling.sample_exactly(points, "id", "label", {majority: 1}, seed)
    kernel = materialize(small.unionByName(start), "kernel")
    near = nearest_neighbours(kernel, "id", "vector", 1, queries=large, **search)
    theirs = kernel.select(F.col("id").alias("neighbour"), F.col("label").alias("theirs"))
    wrong = near.join(theirs, "neighbour").where(F.col("theirs") != majority).select("id")
    kept = kernel.select("id").unionByName(wrong).distinct()
    chosen = df.join(kept, df[key].cast("long") == kept["id"], "left_semi")
    return remove_tomek(materialize(chosen, "selected"), key, vector, label, **search)


def near_miss(df: DataFrame, key: str, vector: str, label: str, k: int = 3, **search) -> DataFrame:
    """Keep the minority and as many majority rows, those closest on average to it (version 1)."""
    points = _points(df, key, vector, label)
    minority, n_min, majority, _ = _gap(points)
    small = points.where(F.col("label") == minority)
    large = points.where(F.col("label") == majority)
    near = nearest_neighbours(small, "id", "vector", min(k, n_min), queries=large, **search)
    mean = near.groupBy("id").agg(F.avg("distance").alias("away"))
    kept = row_numbers(mean, ["away", "id"], "place").where(F.col("place") <= n_min).select("id")
    wanted = small.select("id").unionByName(kept)
    return df.join(wanted, df[key].cast("long") == wanted["id"], "left_semi")


# -- dispatch by name --------------------------------------------------------


def _balanced(made: Callable) -> Callable:
    """The original rows followed by the synthetic ones, as (id, draw, vector, label)."""

    def run(df: DataFrame, key: str, vector: str, label: str, **options) -> DataFrame:
        points = _points(df, key, vector, label).withColumn("draw", F.lit(0))
        rows = made(df, key, vector, label, **options).withColumn("draw", F.col("draw").cast("int"))
        return points.unionByName(rows, allowMissingColumns=True).drop("neighbour")

    return run


METHODS: dict[str, Callable] = {
    "RandomUnderSampler": lambda df, key, vector, label, **o: sampling.under_sample(df, key, label, **o),
    "RandomOverSampler": lambda df, key, vector, label, **o: sampling.over_sample(df, key, label, **o),
    "SMOTE": _balanced(smote),
    "ADASYN": _balanced(adasyn),
    "BorderlineSMOTE": _balanced(borderline_smote),
    "SMOTENC": _balanced(smote_nc),
    "SMOTETomek": smote_tomek,
    "TomekLinks": remove_tomek,
    "EditedNearestNeighbours": edited_neighbours,
    "AllKNN": all_knn,
    "NeighbourhoodCleaningRule": neighbourhood_cleaning,
    "OneSidedSelection": one_sided_selection,
    "NearMiss": near_miss,
}


def resample(df: DataFrame, method: str, key: str, vector: str, label: str, **options) -> DataFrame:
    """Resample by method name."""
    if method not in METHODS:
        raise ValueError(f"unknown sampling method {method!r}, known: {sorted(METHODS)}")
    return METHODS[method](df, key, vector, label, **options)

