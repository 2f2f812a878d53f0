"""Totals over a global order, without a single-task window.

Rows are range-partitioned on the order, the slice each row landed in is
written down with it, and only one total per slice is carried over to the next
slices.  A value that holds a third of all rows is split as long as the order
has a unique last column, or the rows were grouped by value before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import materialize


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: Mapping[str, Column | str],
    group: Sequence[str] = (),
) -> DataFrame:
    """Add running sums (current row included) along ``order`` within ``group``.

    ``order`` must be unique within ``group`` and the group columns not null.
    """
    group = list(group)
    sums = {f"__v{i}": (F.col(e) if isinstance(e, str) else e) for i, e in enumerate(totals.values())}
    sliced = materialize(
        df.withColumns(sums).repartitionByRange(*group, *order).withColumn("__slice", F.spark_partition_id()),
        "slices",
    )
    # One row per slice and group: slices are as many as tasks, so this is small.
    per_slice = sliced.groupBy(*group, "__slice").agg(*[F.sum(v).alias(f"{v}_all") for v in sums])
    earlier = (
        Window.partitionBy(*(group or [F.lit(0)])).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_slice.select(
        *[F.col(g).alias(f"__g_{g}") for g in group],
        F.col("__slice").alias("__slice_of"),
        *[F.coalesce(F.sum(f"{v}_all").over(earlier), F.lit(0)).alias(f"{v}_before") for v in sums],
    )
    within = (
        Window.partitionBy("__slice", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = sliced.withColumns({f"{v}_in": F.sum(v).over(within) for v in sums})
    same = inside["__slice"] == offsets["__slice_of"]
    for g in group:
        same = same & (inside[g] == offsets[f"__g_{g}"])
    joined = inside.join(offsets, same)
    return joined.select(
        *df.columns, *[(F.col(f"{v}_in") + F.col(f"{v}_before")).alias(out) for v, out in zip(sums, totals)]
    )


def row_numbers(df: DataFrame, order: Sequence[str], out: str = "row_number", group: Sequence[str] = ()) -> DataFrame:
    """Dense positions 1..n along a unique order, per group if given."""
    return running_totals(df, order, {out: F.lit(1).cast("long")}, group)


#: Distinct values that a bracket holds, about, at most: one task orders them.
BRACKET_ROWS = 1_000_000


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], group: Sequence[str] = ()
) -> DataFrame:
    """Interpolated quantiles per group, exact and without ordering the rows.

    A mergeable sketch gives a bracket around each wanted position; it is the
    tighter, the more rows there are.  One pass then counts the values below,
    inside and above the brackets, those inside by value, and the positions
    are read off the counts: partial aggregates are all that is shuffled.
    ``probs`` maps output names to probabilities; not-a-number counts as
    infinity.
    """
    keys = list(group) or ["__all"]
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).withColumn("__v", F.when(F.isnan(v), float("inf")).otherwise(v))
    rows = rows.select(*group, "__v") if group else rows.select(F.lit(0).alias("__all"), "__v")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    largest = sizes.agg(F.max("__size")).first()[0] or 0
    accuracy = max(1_000, 4 * largest // BRACKET_ROWS)
    margin = 2 / accuracy
    wanted = list(probs.values())
    ends = [max(0.0, p - margin) for p in wanted] + [min(1.0, p + margin) for p in wanted]
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__size"), F.percentile_approx("__v", ends, accuracy).alias("__ends")
    )
    # Written, so that its size is known: a column of a wide table looks small to Spark, and all rows would be broadcast.
    sketch = materialize(sketch.select(*[F.col(k).alias(f"__g_{k}") for k in keys], "__size", "__ends"), "sketch")
    same = F.lit(True)
    for k in keys:
        same = same & (rows[k] == sketch[f"__g_{k}"])
    sides = []
    for i in range(len(wanted)):
        low, high = F.col("__ends")[i], F.col("__ends")[len(wanted) + i]
        side = F.when(F.col("__v") < low, -1).when(F.col("__v") > high, 1).otherwise(0)
        sides.append(F.struct(F.lit(i).alias("i"), side.alias("side"), F.when(side == 0, F.col("__v")).alias("at")))
    placed = rows.join(sketch, same).select(*keys, "__size", "__v", F.inline(F.array(*sides)))
    counts = placed.groupBy(*keys, "__size", "i", "side", "at").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max")
    )
    upto = F.sum("__n").over(Window.partitionBy(*keys, "i").orderBy("side", "at"))
    counts = counts.withColumn("__upto", upto)
    place = (F.col("__size") - 1) * F.get(F.array(*[F.lit(float(p)) for p in wanted]), F.col("i"))

    def at(position: Column) -> Column:
        inside = (F.col("__upto") - F.col("__n") <= position) & (position < F.col("__upto"))
        # Next to the bracket only the nearest value is known; a sketch is not farther off.
        known = F.when(F.col("side") == 0, F.col("at"))
        known = known.when((F.col("side") < 0) & (position == F.col("__upto") - 1), F.col("__max"))
        known = known.when((F.col("side") > 0) & (position == F.col("__upto") - F.col("__n")), F.col("__min"))
        return F.max(F.when(inside, known.otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))))

    found = counts.groupBy(*keys, "i").agg(
        at(F.floor(place)).alias("__low"), at(F.ceil(place)).alias("__high"), F.max(place - F.floor(place)).alias("__share")
    )
    between = F.col("__low") + (F.col("__high") - F.col("__low")) * F.col("__share")
    one = F.when(F.col("__low") == F.col("__high"), F.col("__low")).otherwise(between)
    picked = [F.max(F.when(F.col("i") == i, one)).alias(name) for i, name in enumerate(probs)]
    return found.groupBy(*group).agg(*picked) if group else found.agg(*picked)
