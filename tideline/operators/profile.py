"""Column profiles: one output row per column of the profiled table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.columns import move_last, numeric_columns

ANNOTATIONS = ["stage", "class", "In use"]


def feature_class(field: T.StructField, one_hot: Iterable[str] = (), multi: Iterable[str] = ()) -> str:
    if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        return "numerical"
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    if field.name in set(one_hot):
        return "categorical(onehot)"
    if field.name in set(multi):
        return "categorical(multiple_onehot)"
    return "categorical"


def long_values(df: DataFrame, columns: Sequence[str], kind: str, extra: Sequence[str] = ()) -> DataFrame:
    """(i, value, extra...): one row per non-null cell, ``i`` the position in ``columns``.

    One array per row and a generator; an unpivot would copy the row once per
    column, which is much slower with hundreds of columns.
    """
    cells = ", ".join(f"cast(`{c}` AS {kind})" for c in columns)
    return df.selectExpr(*[f"`{e}`" for e in extra], f"posexplode(array({cells})) AS (i, value)").where(
        F.col("value").isNotNull()
    )


def name_at(columns: Sequence[str]) -> Column:
    """Column name of position ``i``; looked up after the rows were aggregated."""
    return F.array(*[F.lit(c) for c in columns])[F.col("i")].alias("column")


#: Columns from which on a stored table is counted by kind of value.
WIDE = 100


def _stored(df: DataFrame) -> bool:
    """Whether reading the table once more costs its columns only: its plan is a scan and projections."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    return plan.nodeName() == "LogicalRelation"


def _cell(field: T.StructField) -> tuple[str, str]:
    """Kind of a column's values and an expression of that kind; equal exactly where the texts of the values are."""
    quoted, kind = f"`{field.name}`", field.dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double", f"cast({quoted} AS double)"
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "bigint", f"cast({quoted} AS bigint)"
    if isinstance(kind, T.TimestampType):
        return "bigint", f"unix_micros({quoted})"
    if isinstance(kind, T.DateType):
        return "bigint", f"cast(unix_date({quoted}) AS bigint)"
    return "string", f"cast({quoted} AS string)"


def _counted(cells: DataFrame) -> DataFrame:
    """Rows, values and distinct values of every position ``i`` of cells (i, value)."""
    counts = cells.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    n, known = F.col("n"), F.col("value").isNotNull()
    # A position below zero holds the negative zeros, which would fall together with the others.
    place = F.when(F.col("i") < 0, -1 - F.col("i")).otherwise(F.col("i"))
    return counts.groupBy(place.alias("i")).agg(
        F.sum(n).alias("rows"), F.sum(F.when(known, n).otherwise(0)).alias("count"), F.count("value").alias("distinct")
    )


def _cell_counts(df: DataFrame, facts: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Per column ``rows``, ``count`` and ``distinct`` with its fixed texts, in one pass over the table.

    A wide stored table is read once per kind of value, each column once:
    numbers are counted as such, which is several times quicker than as texts.
    """
    kinds = {f.name: f for f in df.schema.fields}
    parts: dict[str, list[tuple[int, str]]] = {}
    by_kind = len(facts) > WIDE and _stored(df)
    for i, c in enumerate(facts):
        kind, cell = _cell(kinds[c]) if by_kind else ("string", f"cast(`{c}` AS string)")
        parts.setdefault(kind, []).append((i, cell))
    counted = []
    for kind, cells in parts.items():
        # The values become an array of their own first, so the generator reads one column and runs as compiled code.
        rows = df.selectExpr(f"array({', '.join(e for _, e in cells)}) AS cells").selectExpr("posexplode(cells) AS (i, value)")
        if kind == "double":
            rows = rows.selectExpr("if(value = 0D AND pow(value, -1D) < 0D, -1 - i, i) AS i", "value")
        numbers = F.array(*[F.lit(i) for i, _ in cells])
        counted.append(_counted(rows).withColumn("i", numbers[F.col("i")]))
    told = reduce(DataFrame.unionByName, counted)
    names = [f"struct({i} AS __i, {_text(c)} AS column, " + ", ".join(f"{_text(v)} AS {k}" for k, v in facts[c].items()) + ")" for i, c in enumerate(facts)]
    listed = df.sparkSession.range(1).selectExpr(f"inline(array({', '.join(names)}))")
    joined = listed.join(told, listed["__i"] == told["i"], "left")
    return joined.select("column", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("rows", "count", "distinct")], "type", "feature_class")


def value_counts(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(column, value as text, extra..., n) for all columns in one shuffle."""
    counts = long_values(df, columns, "string", extra).groupBy("i", "value", *extra).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(name_at(columns), "value", *extra, "n")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _per_column(df: DataFrame, stats: Mapping[str, Mapping[str, str]], notes: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One wide aggregate over the table, turned into a row per column.

    ``stats`` maps a column to named aggregate expressions, ``notes`` to fixed
    texts.  Written as SQL text: with hundreds of columns that is much cheaper
    to build than nested column objects.
    """
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.expr(e).alias(f"{s}__{i}") for i, c in enumerate(stats) for s, e in stats[c].items()],
    )
    entries = []
    for i, c in enumerate(stats):
        fields = [f"{_text(c)} AS column", "__rows AS rows"]
        fields += [f"{s}__{i} AS {s}" for s in stats[c]]
        fields += [f"{_text(v)} AS {n}" for n, v in notes[c].items()]
        entries.append(f"struct({', '.join(fields)})")
    return wide.selectExpr(f"inline(array({', '.join(entries)}))")


MOMENTS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    one_hot: Iterable[str] = (),
    multi: Iterable[str] = (),
    extended: bool = False,
) -> DataFrame:
    """Missing count and share, value count, type, distinct count and feature class.

    One pass over the table: the cells of all columns are counted in a single
    shuffle.  ``extended`` adds the most frequent value (smallest of equals),
    mean, sample deviation, minimum and maximum, and with them a second pass,
    one wide aggregate.
    """
    columns = list(columns or df.columns)
    numeric = set(numeric_columns(df))
    one_hot, multi = set(one_hot), set(multi)
    kinds = {f.name: f for f in df.schema.fields}
    notes = {
        c: {"type": kinds[c].dataType.simpleString(), "feature_class": feature_class(kinds[c], one_hot, multi)} for c in columns
    }
    if not extended:
        joined = _cell_counts(df, notes)
    else:
        stats = {}
        for c in columns:
            quoted = f"`{c}`"
            stats[c] = {"count": f"count({quoted})"}
            for s, fn in MOMENTS.items():
                stats[c][s] = f"{fn}(cast({quoted} AS double))" if c in numeric else "cast(any_value(NULL) AS double)"
        base = _per_column(df, stats, notes)
        counts = value_counts(df, columns)
        as_number = F.when(F.col("column").isin([c for c in columns if c in numeric]), F.col("value").try_cast("double"))
        distinct = counts.groupBy(F.col("column").alias("__column")).agg(
            F.count(F.lit(1)).alias("distinct"),
            F.min_by("value", F.struct(-F.col("n"), as_number, F.col("value"))).alias("most_popular"),
        )
        joined = base.join(distinct, base["column"] == distinct["__column"], "left")
    missing = F.col("rows") - F.col("count")
    out = [
        F.col("column"),
        missing.alias("missing"),
        F.round(F.try_divide(missing, F.col("rows")), 2).alias("missing_share"),
        F.col("count"),
        F.col("type"),
        F.coalesce("distinct", F.lit(0).cast("long")).alias("distinct"),
        F.col("feature_class"),
    ]
    if extended:
        out += [F.col(c) for c in ("most_popular", *MOMENTS)]
    return joined.select(*out)


def with_tests(profiled: DataFrame, t_tests: DataFrame, chi_tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Join test results into the profile.

    A column is marked significant when its p-value is **below** ``alpha``; the
    p-value itself is always shown.
    """
    t = t_tests.select(
        F.col("column"), F.col("t_statistic"), F.col("p_value").alias("__p_t")
    )
    chi = chi_tests.select(
        F.col("column"), F.col("chi_square"), F.col("dof").alias("degrees_of_freedom"), F.col("p_value").alias("__p_chi")
    )
    joined = profiled.join(t, "column", "left").join(chi, "column", "left")
    p = F.coalesce("__p_t", "__p_chi")
    return joined.withColumn("p_value", p).withColumn(
        "significance", F.when(p < alpha, "Yes").when(p.isNotNull(), "No")
    ).drop("__p_t", "__p_chi")


def merge_profiles(new: DataFrame, old: DataFrame | None, annotations: Sequence[str] = ANNOTATIONS) -> DataFrame:
    """Fresh statistics with the annotations carried over from the old profile.

    Columns that only the old profile has stay, with their old statistics.
    Without an old profile the new one is returned with empty annotations.
    """
    key = "column"
    if old is None:
        return move_last(
            new.withColumns({a: F.lit(None).cast("string") for a in annotations if a not in new.columns}), annotations
        )
    carried = [a for a in annotations if a in old.columns]
    stats = [c for c in new.columns if c != key and c not in carried]
    n = new.select(F.col(key).alias("__n"), *stats)
    o = old.select(F.col(key).alias("__o"), *[F.col(c).alias(f"__old_{c}") for c in old.columns if c != key])
    joined = n.join(o, F.col("__n") == F.col("__o"), "full_outer")
    is_new = F.col("__n").isNotNull()
    select = [F.coalesce("__n", "__o").alias(key)]
    for c in stats:
        previous = F.col(f"__old_{c}") if c in old.columns else F.lit(None)
        select.append(F.when(is_new, F.col(c)).otherwise(previous).alias(c))
    return joined.select(*select, *[F.col(f"__old_{a}").alias(a) for a in carried])


def _layers(parents: Sequence[str]) -> list[list[str]]:
    """Parents in order, split so that no name in a layer is a prefix of another."""
    layers: list[list[str]] = []
    for p in parents:
        if layers and not any(p.startswith(q) or q.startswith(p) for q in layers[-1]):
            layers[-1].append(p)
        else:
            layers.append([p])
    return layers


def inherit_annotations(
    merged: DataFrame, parents: Sequence[str], annotations: Sequence[str] = ANNOTATIONS
) -> DataFrame:
    """Children of an encoded column inherit an annotation the family agrees on.

    A family is every column whose name starts with the parent's name.  When
    its non-null annotations hold exactly one value, the empty ones get it.
    Families that do not overlap are handled in one aggregate and one join;
    overlapping ones in the order of their parents.
    """
    present = [a for a in annotations if a in merged.columns]
    for layer in _layers(parents):
        parent = F.lit(None).cast("string")
        for p in layer:
            parent = F.when(F.startswith(F.col("column"), F.lit(p)), p).otherwise(parent)
        tagged = merged.withColumn("__parent", parent)
        agreed = tagged.where(F.col("__parent").isNotNull()).groupBy(F.col("__parent").alias("__family"))
        values = [F.col(f"`{a}`") for a in present]
        fills = agreed.agg(
            *[F.when(F.min(v) == F.max(v), F.min(v)).alias(f"__fill_{i}") for i, v in enumerate(values)]
        )
        joined = tagged.join(fills, tagged["__parent"] == fills["__family"], "left")
        merged = joined.select(
            *[
                F.coalesce(F.col(f"`{c}`"), F.col(f"__fill_{present.index(c)}")).alias(c)
                if c in present
                else F.col(f"`{c}`")
                for c in merged.columns
            ]
        )
    return merged


def profile_sides(new: DataFrame, old: DataFrame) -> DataFrame:
    """Columns found only in the old or only in the new profile."""
    gone = old.join(new, "column", "left_anti").select("column", F.lit("old").alias("only_in"))
    added = new.join(old, "column", "left_anti").select("column", F.lit("new").alias("only_in"))
    return gone.unionByName(added)


def empty_annotations(merged: DataFrame, annotations: Sequence[str] = ("stage", "In use")) -> DataFrame:
    """(column, annotation) pairs that still have to be filled in."""
    entries = [F.when(F.col(f"`{a}`").isNull(), F.lit(a)) for a in annotations if a in merged.columns]
    return merged.select("column", F.explode(F.array_compact(F.array(*entries))).alias("annotation"))


# Lifecycle stages with the highest stage number they may use.
STAGE_LIMITS = {"init_stage": 1, "mid_stage": 2, "final_stage": 3}


def stage_features(merged: DataFrame, stage: str, excluded_type: str = "timestamp") -> DataFrame:
    """Profile rows of the features a model of this stage may use.

    The final stage leaves out the ``feat_init`` columns.
    """
    if stage not in STAGE_LIMITS:
        raise ValueError(f"stage must be one of {sorted(STAGE_LIMITS)}")
    number = F.col("stage").try_cast("double")
    usable = (
        (number > 0)
        & (number <= STAGE_LIMITS[stage])
        & (F.col("type") != excluded_type)
        & F.coalesce(F.col("`In use`").cast("boolean"), F.lit(False))
    )
    if stage == "final_stage":
        usable = usable & ~F.startswith(F.col("column"), F.lit("feat_init"))
    return merged.where(usable)


def categorical_positions(schema: T.StructType, one_hot: Iterable[str] = (), multi: Iterable[str] = ()) -> list[int]:
    """Positions of the plain categorical columns."""
    return [i for i, f in enumerate(schema.fields) if feature_class(f, one_hot, multi) == "categorical"]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and distinct values of numeric columns."""
    numeric = [c for c in (columns or df.columns) if c in set(numeric_columns(df))]
    return profile(df.select(*numeric), extended=True).select(
        "column", "count", "mean", "std", "min", "max", "distinct"
    )
