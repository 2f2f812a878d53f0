"""Latest rows, ties, and nearest-in-time matching of snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_snapshot(df: DataFrame, stamp: str | Column = "dumpdate") -> DataFrame:
    """Rows of the newest snapshot.  The maximum is a scalar subquery, not a join."""
    col = F.col(stamp) if isinstance(stamp, str) else stamp
    return df.where(col == df.select(F.max(col)).scalar())


def latest_with_ties(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """All rows that share the newest stamp of their key; null stamps never win.

    Each task keeps the rows of its newest stamp of a key before the shuffle,
    so a hot key shrinks there and the table is shuffled once.
    """
    inside = Window.partitionBy(key).orderBy(F.col(stamp).desc())
    known = df.where(F.col(key).isNotNull() & F.col(stamp).isNotNull())
    return known.withColumn("__place", F.rank().over(inside)).where(F.col("__place") == 1).drop("__place")


def latest_per_key(df: DataFrame, keys: Sequence[str], stamp: str, ties: Sequence[str]) -> DataFrame:
    """One row per key: newest stamp, then largest tie columns.  Null stamps come last.

    Each task keeps its first row of a key before the shuffle, so a hot key
    shrinks to one row per task and wide rows are shuffled at most once.
    """
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in (stamp, *ties)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key along ``order``."""
    inside = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(inside)).where(F.col("__place") == 1).drop("__place")


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same on every run: the largest by all its other columns, in their order."""
    unordered = (T.MapType, T.VariantType)
    rest = [f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, unordered)]
    return first_per_key(df, keys, [F.desc_nulls_last(F.col(f"`{c}`")) for c in rest] or [F.lit(0)])


WEEK = 7 * 86_400
LONG_AGO = -(10**15)  # epoch seconds that stand for a missing anchor


def nearest_times(
    anchors: DataFrame,
    history: DataFrame,
    key: str,
    anchor_time: str,
    snapshot_time: str,
    width: int = WEEK,
) -> DataFrame:
    """For every distinct (key, anchor) the snapshot time closest to it.

    Times are whole numbers (epoch seconds).  Of two equally distant snapshots
    the earlier one is taken; keys without a snapshot are absent.

    Works on distinct times only, and looks at the previous and the next
    snapshot of each anchor instead of pairing anchors with all snapshots.  The
    lookup inside a time bucket of ``width`` is a window; neighbours in other
    buckets come from one summary row per bucket.  A key that holds a third of
    the data is therefore spread over its buckets, and a bucket holds at most
    ``width`` distinct times.  Looking ahead is a second window in falling
    order, because a frame that runs to the end of its partition would be
    evaluated anew for every row.
    """
    a = anchors.where(F.col(key).isNotNull() & F.col(anchor_time).isNotNull()).select(
        key, F.col(anchor_time).cast("long").alias("t")
    )
    s = (
        history.where(F.col(key).isNotNull() & F.col(snapshot_time).isNotNull())
        .select(key, F.col(snapshot_time).cast("long").alias("t"))
        .join(a.select(key), key, "left_semi")
    )
    # One row per (key, time): whether it is an anchor, a snapshot, or both.
    points = (
        a.withColumn("kind", F.lit(1))
        .unionByName(s.withColumn("kind", F.lit(2)))
        .groupBy(key, "t")
        .agg(F.bit_or("kind").alias("kind"))
        .select(
            key,
            F.floor(F.col("t") / width).alias("b"),
            "t",
            (F.col("kind") != 2).alias("asked"),
            F.when(F.col("kind") >= 2, F.col("t")).alias("snap"),
        )
        .where(F.col("b").isNotNull())  # stated here, so that both uses below share one exchange
    )
    so_far = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(key, "b")
    seen = points.withColumns(
        {
            "prev": F.max("snap").over(inside.orderBy("t").rowsBetween(*so_far)),
            "next": F.min("snap").over(inside.orderBy(F.col("t").desc()).rowsBetween(*so_far)),
        }
    ).where("asked")
    per_bucket = points.groupBy(key, "b").agg(F.max("snap").alias("last"), F.min("snap").alias("first"))
    buckets = Window.partitionBy(key)
    earlier = (Window.unboundedPreceding, -1)
    around = per_bucket.select(
        key,
        "b",
        F.max("last").over(buckets.orderBy("b").rowsBetween(*earlier)).alias("before"),
        F.min("first").over(buckets.orderBy(F.col("b").desc()).rowsBetween(*earlier)).alias("after"),
    )
    joined = seen.join(around, [key, "b"])
    prev, nxt = F.coalesce("prev", "before"), F.coalesce("next", "after")
    nearest = F.when(nxt.isNull() | (F.col("t") - prev <= nxt - F.col("t")), prev).otherwise(nxt)
    return joined.select(key, F.col("t").alias(anchor_time), nearest.alias(snapshot_time)).where(
        F.col(snapshot_time).isNotNull()
    )


def nearest_snapshot(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    anchor_time: str,
    snapshot_time: str,
    per: str = "row",
    ties: Sequence[str] = (),
    width: int = WEEK,
) -> DataFrame:
    """Add the nearest snapshot time to every row; rows without any are dropped.

    ``per='row'`` keeps each row.  ``per='key'`` keeps one row per key, the one
    closest to its snapshot (then by snapshot time and ``ties``).  A missing
    anchor matches the earliest snapshot of the key.
    """
    placed = rows.withColumn("__at", F.coalesce(F.col(anchor_time).cast("long"), F.lit(LONG_AGO)))
    near = nearest_times(placed, history, key, "__at", snapshot_time, width)
    matched = placed.join(near, [key, "__at"]).select(*rows.columns, snapshot_time)
    if per == "row":
        return matched
    distance = F.abs(F.col(anchor_time) - F.col(snapshot_time))
    order = [F.asc_nulls_last("__distance"), *[F.asc_nulls_first(c) for c in (snapshot_time, *ties)]]
    return first_per_key(matched.withColumn("__distance", distance), [key], order).drop("__distance")
