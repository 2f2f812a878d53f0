"""Per-key aggregates, conditional distinct counts and pivots."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_unique(df: DataFrame, key: str, value: str, out: str, where: str | Column | None = None) -> DataFrame:
    """Distinct non-null values per non-null key, after an optional filter."""
    rows = df if where is None else df.where(where)
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(value).alias(out))


def conditional_unique(
    df: DataFrame,
    key: str,
    value: str,
    conditions: Mapping[str, Column],
    measures: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Distinct counts under several conditions plus sums and means, in one pass.

    Rows are first reduced to one per (key, value) with a flag per condition,
    so a count is a plain sum of flags: no row multiplication as with several
    ``count_distinct``, and a hot key is already reduced before it is shuffled.
    A combination that never occurs is null, not 0.  ``measures`` maps an
    output name to (``sum`` | ``avg``, column); the sum over nulls only is 0.
    """
    measures = measures or {}
    present = F.col(value).isNotNull()
    flags = [
        F.max((F.coalesce(test, F.lit(False)) & present).cast("int")).alias(f"__f{i}")
        for i, test in enumerate(conditions.values())
    ]
    sources = sorted({c for _, c in measures.values()})
    parts = [a for c in sources for a in (F.sum(c).alias(f"__s_{c}"), F.count(c).alias(f"__n_{c}"))]
    per_value = df.where(F.col(key).isNotNull()).groupBy(key, value).agg(*flags, *parts)

    outputs = [
        F.nullif(F.sum(f"__f{i}"), F.lit(0).cast("long")).alias(name) for i, name in enumerate(conditions)
    ]
    for name, (kind, c) in measures.items():
        total, n = F.sum(f"__s_{c}"), F.sum(f"__n_{c}")
        if kind == "sum":
            outputs.append(F.coalesce(total, F.lit(0)).alias(name))
        else:
            outputs.append(F.try_divide(total, n).alias(name))
    return per_value.groupBy(key).agg(*outputs)


def pivot_unique(
    df: DataFrame,
    key: str,
    pivot: str,
    value: str,
    names: Mapping[str, str],
    always: Sequence[str] = (),
    reduce: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One column per listed pivot value; empty cells are 0.

    The default cell is the number of distinct values.  ``reduce`` builds
    another aggregate from the value column.  Columns in ``always`` that no
    pivot value produces are added as 0.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(pivot).isNotNull())
    if reduce is None:
        cells = rows.where(F.col(value).isNotNull()).select(key, pivot, value).distinct()
        aggregates = [
            F.count_if(F.col(pivot) == old).alias(new) for old, new in names.items()
        ]
    else:
        cells = rows
        aggregates = [
            F.coalesce(reduce(F.when(F.col(pivot) == old, F.col(value))), F.lit(0)).alias(new)
            for old, new in names.items()
        ]
    wide = cells.groupBy(key).agg(*aggregates)
    missing = [c for c in always if c not in wide.columns]
    return wide.withColumns({c: F.lit(0).cast("long") for c in missing}) if missing else wide


def relative_frequency(
    df: DataFrame, column: str, out: str, where: Column | None = None
) -> DataFrame:
    """Share of every non-null value among the rows that pass ``where``."""
    rows = df.where(F.col(column).isNotNull())
    rows = rows if where is None else rows.where(where)
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    total = rows.select(F.count(F.lit(1))).scalar()
    return counts.select(column, (F.col("__n") / total).alias(out))


def add_frequency(df: DataFrame, column: str, out: str, where: Column | None = None) -> DataFrame:
    """Join :func:`relative_frequency` back to the rows; unseen values give null."""
    table = relative_frequency(df, column, out, where).withColumnRenamed(column, "__value")
    return df.join(table, df[column] == table["__value"], "left").drop("__value")


def contingency(df: DataFrame, column: str, label: str, labels: Sequence = (0, 1)) -> DataFrame:
    """Row count per category and label value, one column per label."""
    rows = df.where(F.col(column).isNotNull() & F.col(label).isNotNull())
    cells = [F.count_if(F.col(label) == v).alias(f"n_{v}") for v in labels]
    return rows.groupBy(column).agg(*cells)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: counts per class, positive share, positives per negative."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        neg.alias("negatives"),
        pos.alias("positives"),
        F.try_divide(pos, F.count(F.col(label))).alias("positive_share"),
        F.try_divide(pos, neg).alias("imbalance_ratio"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """One row: rows in duplicate groups and the number of such keys."""
    return duplicate_keys(df, key).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("duplicate_rows"),
        F.count(F.lit(1)).alias("duplicate_keys"),
    )
