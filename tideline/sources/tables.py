"""Reading warehouse tables: naming, column choice, filters, renames."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.dates import to_ms


def resolve_name(database: str, table: str, stage: str = "dev", from_prod: bool = False) -> str:
    """``database.table`` for an environment.

    A development run that reads production data uses the unversioned table
    (``deals_v3`` is read as ``deals``) of the ``prod_`` database.
    """
    if stage == "dev" and from_prod:
        return f"prod_{database}.{re.sub(r'_v[0-9]+.*$', '', table)}"
    return f"{database}.{table}"


def existing(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    """The requested columns that the table really has, in the requested order."""
    if columns is None:
        return df.columns
    known = set(df.columns)
    return [c for c in columns if c in known]


def timestamps_to_ms(df: DataFrame) -> DataFrame:
    """Cut every timestamp column to milliseconds."""
    temporal = (T.TimestampType, T.TimestampNTZType)
    cut = {f.name: to_ms(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, temporal)}
    return df.withColumns(cut) if cut else df


def key_filter(df: DataFrame, key: str, values: DataFrame | Iterable) -> DataFrame:
    """Rows whose key is among ``values``.

    A Python list of any length becomes an ``IN`` filter, which compares like
    any other condition and reaches the scan; a DataFrame of keys, of any
    size, becomes a left semi join.
    """
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(key)).distinct()
        return df.join(keys, key, "left_semi")
    return df.where(F.col(key).isin(list(values)))


def read_table(
    source: DataFrame | SparkSession,
    database: str | None = None,
    table: str | None = None,
    stage: str = "dev",
    columns: Iterable[str] | None = None,
    filter_key: str | None = None,
    filter_values: DataFrame | Iterable | None = None,
    where: str | Column | None = None,
    rename: Mapping[str, str] | None = None,
    from_prod: bool = False,
    limit: int | None = None,
    cut_timestamps: bool | None = None,
) -> DataFrame:
    """One table with column choice, an optional filter and renames.

    ``source`` is a session (the table comes from the catalog) or an already
    opened DataFrame.  A key list and a free condition exclude each other.
    Everything stays declarative, so the column list and the filter are
    pushed into the scan.
    """
    if filter_key and filter_values is not None and where is not None:
        raise ValueError("give either filter_key/filter_values or where, not both")
    if isinstance(source, DataFrame):
        df = source
    else:
        df = source.table(resolve_name(database, table, stage, from_prod))
    if filter_key and filter_values is not None:
        df = key_filter(df, filter_key, filter_values)
    if where is not None:
        condition = re.sub(r"(?i)^\s*where\s+", "", where) if isinstance(where, str) else where
        df = df.where(condition)
    df = df.select(*existing(df, columns))
    if cut_timestamps if cut_timestamps is not None else database == "refined":
        df = timestamps_to_ms(df)
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    return df.limit(limit) if limit is not None else df


def from_warehouse_or_file(
    spark: SparkSession, retrieve: Callable[[], DataFrame], saved_path: str | None = None
) -> DataFrame:
    """The saved stage table when a path is given, else a fresh retrieval."""
    return spark.read.parquet(saved_path) if saved_path else retrieve()
