"""Comparing two tables, two models' features or two models' predictions.

Two tables are compared by a tree of digests first: order-free sums of row
hashes for each key bucket.  Equal tables shuffle those and their keys, not
their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.snapshots import first_per_key
from tideline.session import materialize


#: Leaves of the digest tree: that many digests of either table are compared first.
BUCKETS = 4_096


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by all its columns, in their order."""
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c != key]
    return first_per_key(df.where(F.col(key).isNotNull()), [key], rest or [F.lit(0)])


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, a, b): the number of rows of each key bucket and two sums of hashes of whole rows, whatever their order."""
    # A null leaves a hash as it was, so every cell also says whether it is one.
    cells = [e for c in [key, *columns] for e in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    rows = df.where(F.col(key).isNotNull())
    total = lambda *more: F.sum(F.xxhash64(*more, *cells).cast("decimal(20,0)"))
    return rows.groupBy(_bucket(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), total().alias("a"), total(F.lit(1)).alias("b")
    )


def differing_buckets(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket) of the key buckets whose rows are not the same in both tables; a small written table."""
    a, b = (bucket_digests(d, key, columns, buckets) for d in (left, right))
    b = b.toDF(*[f"__r_{c}" for c in b.columns])
    same = F.lit(True)
    for c in ("n", "a", "b"):
        same = same & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    joined = a.join(b, a["bucket"] == b["__r_bucket"], "full_outer")
    return materialize(joined.where(~same).select(F.coalesce("bucket", "__r_bucket").alias("bucket")), "differing")


def _changed(left: DataFrame, right: DataFrame, key: str, buckets: int) -> tuple[list[str], DataFrame, DataFrame]:
    """Common columns, the rows of differing buckets, one per key and side by side, and the keys of the other buckets."""
    common = [c for c in left.columns if c in set(right.columns) and c != key]
    left, right = left.select(key, *common), right.select(key, *common)
    differing = differing_buckets(left, right, key, common, buckets)
    # At most as many rows as buckets, so this side of the join stays small.
    inside = lambda d: d.join(differing, _bucket(key, buckets) == differing["bucket"], "left_semi")
    a = one_per_key(inside(left), key)
    b = one_per_key(inside(right), key).withColumnsRenamed({c: f"__r_{c}" for c in common})
    rest = left.where(F.col(key).isNotNull()).join(differing, _bucket(key, buckets) == differing["bucket"], "left_anti")
    return common, a.join(b, key), rest.select(key).distinct()


def column_differences(left: DataFrame, right: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Per common column: compared keys, differing cells and one differing key.

    Duplicate keys are reduced first; a null equals a null.  Digests of key
    buckets are compared before any rows: of buckets that agree only the keys
    are counted, and only rows of the others are joined, in one join and one
    wide aggregate, whatever the number of columns.
    """
    common, joined, rest = _changed(left, right, key, buckets)
    parts = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(common):
        other = ~F.col(f"`{c}`").eqNullSafe(F.col(f"`__r_{c}`"))
        parts += [F.count_if(other).alias(f"d{i}"), F.min(F.when(other, F.col(key))).alias(f"k{i}")]
    wide = joined.agg(*parts).withColumn("__n", F.col("__n") + rest.select(F.count(F.lit(1))).scalar())
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("__n").alias("compared"),
            F.col(f"d{i}").alias("different"),
            F.col(f"k{i}").alias("first_key"),
        )
        for i, c in enumerate(common)
    ]
    return wide.select(F.inline(F.array(*entries)))


def cell_differences(left: DataFrame, right: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, column, left value, right value) of every differing cell, values as text."""
    common, joined, _ = _changed(left, right, key, buckets)
    cells = [
        F.when(
            ~F.col(f"`{c}`").eqNullSafe(F.col(f"`__r_{c}`")),
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"`{c}`").cast("string").alias("left_value"),
                F.col(f"`__r_{c}`").cast("string").alias("right_value"),
            ),
        )
        for c in common
    ]
    return joined.select(key, F.inline(F.array_compact(F.array(*cells))))


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys in both tables, and on one side only."""
    from tideline.operators.joins import compare_keys

    side = F.col("side")
    return compare_keys(left, right, key).agg(
        F.count_if(side == "both").alias("common"),
        F.count_if(side == "left").alias("left_only"),
        F.count_if(side == "right").alias("right_only"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-independent fingerprint: row count and sum of row hashes."""
    names = sorted(columns or df.columns)
    h = F.xxhash64(*[F.col(f"`{c}`") for c in names]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).alias("hash_sum"))


def same_order(left: DataFrame, right: DataFrame, key: str, position: str) -> DataFrame:
    """One row: how many keys sit at different positions in the two tables."""
    b = right.select(F.col(key).alias("__key"), F.col(position).alias("__pos"))
    joined = left.join(b, left[position] == b["__pos"], "full_outer")
    return joined.agg(F.count_if(~F.col(key).eqNullSafe(F.col("__key"))).alias("moved"))


def importance_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Features of two models side by side with the absolute importance gap."""
    a = left.select("feature", F.col("importance").alias("left_importance"))
    b = right.select("feature", F.col("importance").alias("right_importance"))
    return a.join(b, "feature", "full_outer").withColumn(
        "gap", F.abs(F.col("left_importance") - F.col("right_importance"))
    )


def agreement(left: DataFrame, right: DataFrame, row: str, predicted: str) -> DataFrame:
    """Share of rows for which two models predict the same."""
    b = right.select(row, F.col(predicted).alias("__other"))
    return left.join(b, row).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(predicted).eqNullSafe(F.col("__other")).cast("int")).alias("match_ratio"),
    )


def probe_rows(spark: SparkSession, schema: T.StructType, n: int = 5) -> DataFrame:
    """Constant rows of a schema: ``unknown`` for text, 0 for numbers."""
    return spark.range(n).select(
        *[
            (F.lit("unknown") if isinstance(f.dataType, T.StringType) else F.lit(0)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
