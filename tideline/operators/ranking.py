"""Sorting, top-k, rank bands and comparisons with a baseline row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.running import row_numbers


def sort_rows(df: DataFrame, *columns: str, descending: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() if c in descending else F.col(c).asc() for c in columns])


def top_n(df: DataFrame, score: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n best rows; each task keeps its own n before one merge."""
    return df.orderBy(F.col(score).desc(), *ties).limit(n)


def bottom_n(df: DataFrame, score: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(score).asc(), *[F.col(t).desc() for t in ties]).limit(n)


def rank_by_score(df: DataFrame, score: str, ties: Sequence[str], out: str = "position") -> DataFrame:
    """Positions 1..n by falling score over the whole table, distributed; rows without a score come last."""
    keyed = df.withColumns({"__none": F.col(score).isNull(), "__down": -F.col(score)})
    return row_numbers(keyed, ["__none", "__down", *ties], out).drop("__none", "__down")


def rank_band(
    df: DataFrame, score: str, ties: Sequence[str], low: float = 0.1, high: float = 0.9
) -> DataFrame:
    """Rows between two shares of the ranking by falling score."""
    ranked = rank_by_score(df, score, ties)
    n = df.select(F.count(F.lit(1))).scalar()
    before = F.col("position") - 1
    return ranked.where((before >= F.floor(n * F.lit(low))) & (before < F.floor(n * F.lit(high))))


def leaderboard(df: DataFrame, name: str, score: str, top: int = 10, maximize: bool = True) -> DataFrame:
    """The ``top`` names by mean score with the population deviation and a rank."""
    means = df.groupBy(name).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))
    best = F.col("mean_score").desc() if maximize else F.col("mean_score").asc()
    short = means.orderBy(best, name).limit(top)
    # The window runs over at most ``top`` rows.
    return short.withColumn("rank", F.row_number().over(Window.orderBy(best, name)))


def percent_change(
    df: DataFrame, order: str, metrics: Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Add every metric's change in percent against the row that is first by ``order``."""
    names = metrics if isinstance(metrics, Mapping) else {m: f"{m}_diff_pct" for m in metrics}
    added = {}
    for metric, out in names.items():
        base = df.select(F.min_by(metric, order)).scalar()
        added[out] = F.try_divide(F.col(metric) - base, base) * 100
    return df.withColumns(added)


def head(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def row_ids(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Unique, not dense, and without a shuffle.  Use a business key where one exists."""
    return df.withColumn(out, F.monotonically_increasing_id())
