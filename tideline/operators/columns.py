"""Projections, recodes and schema-level column operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.numeric import ms_to_days, null_if_zero
from tideline.functions.text import human_duration, sanitize_name

NUMERIC = (T.NumericType,)
TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)


def transform_columns(df: DataFrame, columns: Iterable[str], change: Callable[[Column], Column]) -> DataFrame:
    """Apply one column expression to several columns in a single projection."""
    return df.withColumns({c: change(F.col(c)) for c in columns})


def label_from_stage(df: DataFrame, stage: str, positive: Sequence[str], out: str = "target") -> DataFrame:
    """1 when the stage is one of ``positive``, else 0 (also for null); kept if present."""
    if out in df.columns:
        return df
    return df.withColumn(out, F.coalesce(F.col(stage).isin(list(positive)), F.lit(False)).cast("int"))


def recode(col: Column, cases: Mapping[str, str], default: str = "Unknown") -> Column:
    """Nested conditional recode with a default that also covers null."""
    chain = None
    for old, new in cases.items():
        chain = F.when(col == old, new) if chain is None else chain.when(col == old, new)
    return chain.otherwise(default)


def member_flag(col: Column, members: Sequence) -> Column:
    return F.coalesce(col.isin(list(members)), F.lit(False)).cast("int")


def integers_only(df: DataFrame, column: str) -> DataFrame:
    """Cast to long and keep the rows where that worked."""
    return df.withColumn(column, F.col(column).try_cast("long")).where(F.col(column).isNotNull())


def select_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns the table has, in the given order."""
    known = set(df.columns)
    return df.select(*[n for n in names if n in known])


def drop_sparse(df: DataFrame, threshold: int = 0, drop: Iterable[str] = ()) -> DataFrame:
    """Drop listed columns, duplicate names and columns with fewer than ``threshold`` values.

    All columns are counted in one aggregate; one row reaches the driver.
    """
    df = first_of_duplicate_names(df)
    df = df.drop(*[c for c in drop if c in df.columns])
    if threshold <= 0:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[f"`{c}`" for i, c in enumerate(df.columns) if counts[i] >= threshold])


def first_of_duplicate_names(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with one name."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    first = {n: i for i, n in reversed(list(enumerate(names)))}
    return numbered.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if first[n] == i])


def without_null_columns(df: DataFrame) -> DataFrame:
    """Only the columns that have no null at all."""
    holes = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[f"`{c}`" for i, c in enumerate(df.columns) if holes[i] == 0])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TEMPORAL)]


def only_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def ensure_columns(df: DataFrame, names: Iterable[str], value=0) -> DataFrame:
    """Add the missing ones as a constant."""
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(value) for n in missing}) if missing else df


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types; missing ones are 0."""
    known = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in known else F.lit(0)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def sanitize_names(df: DataFrame) -> DataFrame:
    """Letters, digits and ``_`` only; names that collide get a numeric suffix."""
    taken: set[str] = set()
    names = []
    for name in map(sanitize_name, df.columns):
        unique, n = name, 1
        while unique in taken:
            unique, n = f"{name}_{n}", n + 1
        taken.add(unique)
        names.append(unique)
    return df.toDF(*names)


def move_last(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Put the named columns at the end, in the given order."""
    tail = [n for n in names if n in df.columns]
    return df.select(*[c for c in df.columns if c not in tail], *tail)


def change_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Convert listed columns; values that do not convert become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def booleans_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column as 1 / 0, null as 0."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("int"), F.lit(0)) for c in flags}) if flags else df


# Pipelines in the order their columns are preferred, deal stages,
# column prefixes with the suffix they become, and derived columns not kept.
PIPELINES = ["learn", "online_sales", "corporate_transformation", "work"]
DEAL_STAGES = [
    "marketing_qualified",
    "first_contact",
    "sales_qualified",
    "sales_negotiation",
    "in_purchasing",
    "closed_won",
    "closed_won_so_netsuite",
    "closed_lost",
]
STAGE_PREFIXES = {"hs_date_entered_": "entered", "hs_date_exited_": "exited", "hs_time_in_": "time_in"}
UNUSED_STAGE_COLUMNS = [
    "closed_lost_exited",
    "closed_won_so_netsuite_exited",
    "closed_won_exited",
    "closed_won_so_netsuite_time_in_days",
]


def stage_column_names(columns: Sequence[str], stages: Iterable[tuple[str, str | None, str | None]]) -> dict[str, str]:
    """Old to new names for per-stage columns.

    ``stages`` holds (stage id, stage name, pipeline label).  The column of a
    stage is ``prefix + id`` exactly, or the first one that starts with it.
    """

    def clean(text: str | None, missing: str) -> str:
        if text is None:
            return missing
        return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip().replace(" ", "_")

    renames = {}
    for stage_id, stage_name, pipeline in stages:
        stem = stage_id.replace("-", "_")
        label = f"{clean(stage_name, 'none')}_{clean(pipeline, 'no_pipeline')}"
        for prefix, suffix in STAGE_PREFIXES.items():
            wanted = prefix + stem
            match = wanted if wanted in columns else next((c for c in columns if c.startswith(wanted)), None)
            if match:
                renames[match] = f"{label}_{suffix}"
    return renames


def merge_stage_columns(df: DataFrame, stages: DataFrame) -> DataFrame:
    """Rename per-stage columns and merge the pipelines of each stage.

    ``stages`` is the stage lookup (one row per stage).  For every stage
    the first non-null pipeline column wins; times in stage also get a day
    count and a readable form, with zero read as missing.
    """
    stems = [c.removeprefix(p) for p in STAGE_PREFIXES for c in df.columns if c.startswith(p)]
    # Only stages that have a column in the table are fetched, so the lookup may have any size.
    stem = F.translate("stage_id", "-", "_")
    used = F.exists(F.array(*[F.lit(s) for s in stems]).cast("array<string>"), lambda s: s.startswith(stem))
    wanted = stages.select("stage_id", "stage_name", "pipeline_label").where(used).distinct()
    rows = [tuple(r) for r in wanted.orderBy("stage_id", "stage_name", "pipeline_label").collect()]
    df = df.withColumnsRenamed(stage_column_names(df.columns, rows))
    known = set(df.columns)
    merged: dict[str, Column] = {}
    for stage in DEAL_STAGES:
        for suffix in STAGE_PREFIXES.values():
            parts = [F.col(f"{stage}_{p}_{suffix}") for p in PIPELINES if f"{stage}_{p}_{suffix}" in known]
            name = f"{stage}_{suffix}"
            if suffix != "time_in":
                merged[name] = F.coalesce(*parts) if parts else F.lit(None).cast("timestamp")
            elif not parts:
                merged[name] = F.lit(None).cast("double")
            else:
                ms = F.coalesce(*[null_if_zero(p.try_cast("double")) for p in parts])
                merged[name] = ms
                merged[f"{name}_days"] = ms_to_days(ms)
                merged[f"{name}_days_string"] = human_duration(ms)
    kept = {n: c for n, c in merged.items() if n not in UNUSED_STAGE_COLUMNS}
    return df.select(*[c for c in df.columns if c not in kept], *[c.alias(n) for n, c in kept.items()])

