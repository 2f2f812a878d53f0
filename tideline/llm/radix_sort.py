"""A distributed LSD radix sort of slim rows by a composite key of whole numbers.

The key is cut into digits of eleven bits.  From the least significant digit
on, every pass is a stable counting sort: rows lie in blocks of consecutive
positions; the rows of each digit are counted per block; prefix sums over
(digit, block) say where the rows of a digit in a block begin; each block then
gives its rows their destinations in the order in which they lie.  After the
last pass the positions are the final ranks.

A block is a bounded number of rows and is placed by itself, so no task holds
a key, however often it occurs.  The counts are at most the number of digits
for each block.  A digit that is the same on all rows would move nothing and is
passed over.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import shuffle_width
from tideline.session import materialize

DIGIT_BITS = 11
#: Rows that one task places at a time, at most.
BLOCK_ROWS = 1 << 18


def unsigned_digits(column: str, bits: int = 64) -> list[Column]:
    """The digits of a long, the least significant first, so that they sort as the signed number does; zero for null."""
    # The sign bit counts the other way round.
    top = F.coalesce(F.col(column).cast("long"), F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))
    return [F.shiftrightunsigned(top, at).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int") for at in range(0, bits, DIGIT_BITS)]


def digits(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """All digits of the composite key, least significant first; ``order`` lists (column, descending), nulls last."""
    out: list[Column] = []
    for column, descending in reversed(order):
        own = unsigned_digits(column)
        out += [F.lit((1 << DIGIT_BITS) - 1) - d if descending else d for d in own] + [F.col(column).isNull().cast("int")]
    return out


def _place(rows: pa.Table, starts: pa.Table) -> pa.Table:
    """A block's rows with their destinations: stable within each digit."""
    pos, digit = rows["pos"].to_numpy(), rows["digit"].to_numpy()
    # Positions of a block are consecutive, so a row's place in it is known without comparing.
    lying = np.empty(len(pos), dtype=np.int64)
    lying[pos - pos.min()] = np.arange(len(pos))
    inside = digit[lying].astype(np.uint16)
    begin = np.zeros(1 << DIGIT_BITS, dtype=np.int64)
    begin[starts["digit"].to_numpy()] = starts["start"].to_numpy()
    counts = np.bincount(inside, minlength=1 << DIGIT_BITS)
    by_digit = np.argsort(inside, kind="stable")  # a counting sort for numbers of 16 bits
    nth = np.empty(len(pos), dtype=np.int64)
    nth[by_digit] = np.arange(len(pos)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = rows.take(pa.array(lying)).drop_columns(["pos", "digit", "block"])
    return out.append_column("pos", pa.array(begin[inside] + nth))


def first_positions(rows: DataFrame) -> DataFrame:
    """Number the rows of a written table 0, 1, 2 ... in the order they lie in."""
    lying = materialize(rows.withColumns({"__slice": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "lying-rows")
    # One row per slice: as many as tasks.
    sizes = lying.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__low"))
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__slice", "__low", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return lying.join(offsets, "__slice").select(*rows.columns, (F.col("__before") + F.col("__at") - F.col("__low")).alias("pos"))


def radix_ranks(rows: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... in ``order``, a list of (whole-number column, descending).

    Nulls come last in every column.  Rows with equal keys keep the order they
    lie in.  Each row's columns travel once per pass, so pass slim rows with a
    key to look the others up by.  Columns named pos, digit or block would be
    overwritten and are refused.  An empty table gives an empty result.
    """
    if clash := {"pos", "digit", "block", "rank"} & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} are taken")
    spark = rows.sparkSession
    state = materialize(first_positions(rows), "radix-0")
    keys = digits(order)
    ends = state.agg(
        F.count(F.lit(1)).alias("n"), *[F.min(k).alias(f"a{i}") for i, k in enumerate(keys)], *[F.max(k).alias(f"b{i}") for i, k in enumerate(keys)]
    ).first()
    block_rows = max(1, min(BLOCK_ROWS, -(-ends["n"] // shuffle_width(spark))))
    moving = [k for i, k in enumerate(keys) if ends[f"a{i}"] != ends[f"b{i}"]]
    for number, key in enumerate(moving):
        lying = state.withColumns({"digit": key, "block": F.floor(F.col("pos") / block_rows)})
        counts = lying.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(counts, "digit-counts")
        # As many rows as digits.
        smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        firsts = counts.groupBy("digit").agg(F.sum("n").alias("all")).select("digit", F.coalesce(F.sum("all").over(smaller), F.lit(0)).alias("first"))
        earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        starts = (
            counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .join(firsts, "digit")
            .select("block", "digit", (F.col("first") + F.col("before")).alias("start"))
        )
        placed = lying.groupBy("block").cogroup(starts.groupBy("block")).applyInArrow(_place, state.schema)
        state = materialize(placed, f"radix-{number + 1}")
    return state.select(*rows.columns, (F.col("pos") + 1).alias("rank"))
