"""Two-sample tests per column, between the rows labelled 0 and 1.

Nulls are left out per column, and the number of used rows is reported.  Each
test reduces the table with aggregates; only the one-row-per-column result is
turned into p-values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import pvalues
from tideline.operators.columns import numeric_columns
from tideline.operators.profile import long_values, name_at, value_counts
from tideline.operators.running import exact_quantiles, running_totals

_chi_p = F.udf(pvalues.chi_square_p, T.DoubleType())
_t_p = F.udf(pvalues.student_t_p, T.DoubleType())
_f_p = F.udf(pvalues.f_p, T.DoubleType())
_ks_p = F.udf(pvalues.kolmogorov_p, T.DoubleType())


def text_columns(df: DataFrame, label: str) -> list[str]:
    skip = {label, *numeric_columns(df)}
    return [c for c in df.columns if c not in skip]


def chi_square(df: DataFrame, label: str, columns: Sequence[str] | None = None, p_values: bool = True) -> DataFrame:
    """Independence of each categorical column from the binary label.

    The statistic comes from sums over the category counts,
    ``N (sum O0^2/(R C0) + sum O1^2/(R C1) - 1)``, so a column with very many
    categories is a plain aggregate.  With one degree of freedom Yates'
    continuity correction applies.
    """
    columns = list(columns or text_columns(df, label))
    counts = value_counts(df.where(F.col(label).isNotNull()), columns, [label])
    return chi_square_of_counts(counts, label, p_values)


def chi_square_of_counts(counts: DataFrame, label: str, p_values: bool = True) -> DataFrame:
    """The same from counted rows (column, value, label, n)."""
    per_value = counts.groupBy("column", "value").agg(
        F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("n"))), F.lit(0)).alias("o0"),
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("n"))), F.lit(0)).alias("o1"),
    )
    r = F.col("o0") + F.col("o1")
    sums = per_value.where(r > 0).groupBy("column").agg(
        F.sum("o0").alias("c0"),
        F.sum("o1").alias("c1"),
        F.count(F.lit(1)).alias("k"),
        # Divided first: the square of a large count does not fit a long.
        F.sum(F.col("o0") * (F.col("o0") / r)).alias("s0"),
        F.sum(F.col("o1") * (F.col("o1") / r)).alias("s1"),
        F.sum(1 / r).alias("inv_rows"),
    )
    n = F.col("c0") + F.col("c1")
    two_labels = (F.col("c0") > 0) & (F.col("c1") > 0)
    dof = F.when(two_labels, F.col("k") - 1).otherwise(0)
    plain = n * (F.col("s0") / F.col("c0") + F.col("s1") / F.col("c1") - 1)
    spread = n * F.col("inv_rows") * (1 / F.col("c0") + 1 / F.col("c1"))
    gap = F.sqrt(F.greatest(plain, F.lit(0.0)) / spread)
    yates = F.pow(gap - F.least(F.lit(0.5), gap), 2) * spread
    stat = F.when(dof == 0, 0.0).when(dof == 1, yates).otherwise(plain)
    out = sums.select("column", stat.alias("chi_square"), dof.cast("long").alias("dof"), n.alias("n_used"))
    if not p_values:
        return out
    return out.withColumn("p_value", F.when(F.col("dof") == 0, 1.0).otherwise(_chi_p("chi_square", "dof")))


def _by_label(df: DataFrame, label: str, columns: Sequence[str], stats: dict) -> DataFrame:
    """Row per column with each statistic for label 0 and label 1, in one pass."""
    parts = []
    for i, c in enumerate(columns):
        for v in (0, 1):
            x = F.when(F.col(label) == v, F.col(f"`{c}`").cast("double"))
            parts += [fn(x).alias(f"{s}{v}_{i}") for s, fn in stats.items()]
    wide = df.agg(*parts)
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}{v}_{i}").alias(f"{s}{v}") for v in (0, 1) for s in stats])
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def _numeric(df: DataFrame, label: str, columns: Sequence[str] | None) -> list[str]:
    return list(columns or [c for c in numeric_columns(df) if c != label])


def t_test(df: DataFrame, label: str, columns: Sequence[str] | None = None, p_values: bool = True) -> DataFrame:
    """Student's t with pooled variance; groups of fewer than two rows give 0 and 0."""
    columns = _numeric(df, label, columns)
    m = _by_label(df, label, columns, {"n": F.count, "mean": F.avg, "var": F.var_samp})
    dof = F.col("n0") + F.col("n1") - 2
    pooled = ((F.col("n0") - 1) * F.col("var0") + (F.col("n1") - 1) * F.col("var1")) / dof
    t = F.try_divide(F.col("mean0") - F.col("mean1"), F.sqrt(pooled * (1 / F.col("n0") + 1 / F.col("n1"))))
    enough = (F.col("n0") > 1) & (F.col("n1") > 1)
    out = m.select(
        "column",
        F.when(enough, t).otherwise(0.0).alias("t_statistic"),
        F.when(enough, dof).otherwise(0).alias("dof"),
        (F.col("n0") + F.col("n1")).alias("n_used"),
    )
    if not p_values:
        return out
    return out.withColumn("p_value", F.when(F.col("dof") == 0, 0.0).otherwise(_t_p("t_statistic", F.col("dof").cast("double"))))


def ks_test(df: DataFrame, label: str, columns: Sequence[str] | None = None, p_values: bool = True) -> DataFrame:
    """Largest gap between the two empirical distributions.

    Values are counted per label first; the running counts follow a global
    order over (column, value), so no column ends up in one task.
    """
    columns = _numeric(df, label, columns)
    long = long_values(df.where(F.col(label).isin(0, 1)), columns, "double", [label])
    counts = long.groupBy("i", "value").agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    ).select(name_at(columns), "value", "n0", "n1")
    cum = running_totals(counts, ["value"], {"upto0": "n0", "upto1": "n1"}, ["column"])
    sizes = _by_label(df, label, columns, {"all": F.count})
    gap = F.abs(F.try_divide("upto0", "all0") - F.try_divide("upto1", "all1"))
    out = cum.join(sizes, "column").groupBy("column").agg(
        F.max(gap).alias("ks_statistic"), F.max("all0").alias("n0"), F.max("all1").alias("n1")
    )
    if not p_values:
        return out
    return out.withColumn("p_value", _ks_p("ks_statistic", "n0", "n1"))


def levene_test(df: DataFrame, label: str, columns: Sequence[str] | None = None, p_values: bool = True) -> DataFrame:
    """Equality of variances, deviations taken from the group medians."""
    columns = _numeric(df, label, columns)
    rows = df.where(F.col(label).isin(0, 1))
    long = long_values(rows, columns, "double", [label]).select(name_at(columns), label, "value")
    # Two medians per column come back and enter the next pass as literals.
    medians = {
        (r["column"], r[label]): r["median"]
        for r in exact_quantiles(long, "value", {"median": 0.5}, ["column", label]).collect()
    }
    centred = rows.select(
        label,
        *[
            F.abs(
                F.col(f"`{c}`").cast("double")
                - F.when(F.col(label) == 0, F.lit(medians.get((c, 0)))).otherwise(F.lit(medians.get((c, 1))))
            ).alias(c)
            for c in columns
        ],
    )
    m = _by_label(centred, label, columns, {"n": F.count, "mean": F.avg, "var": F.var_pop})
    n = F.col("n0") + F.col("n1")
    grand = (F.col("n0") * F.col("mean0") + F.col("n1") * F.col("mean1")) / n
    between = F.col("n0") * F.pow(F.col("mean0") - grand, 2) + F.col("n1") * F.pow(F.col("mean1") - grand, 2)
    within = F.col("n0") * F.col("var0") + F.col("n1") * F.col("var1")
    out = m.select(
        "column", F.try_divide((n - 2) * between, within).alias("levene_statistic"), n.alias("n_used")
    )
    if not p_values:
        return out
    return out.withColumn("p_value", _f_p("levene_statistic", F.lit(1.0), (F.col("n_used") - 2).cast("double")))


def gated_t_test(
    df: DataFrame,
    label: str,
    columns: Sequence[str] | None = None,
    gated: bool = False,
    explain: bool = False,
    alpha: float = 0.05,
) -> DataFrame:
    """t-test that may be withheld by the two preconditions.

    With ``gated`` the t-test is shown only if the distribution test and then
    the variance test keep their null hypothesis; a withheld result is 0 / 0,
    or a text that says why when ``explain`` is set.
    """
    columns = _numeric(df, label, columns)
    t = t_test(df, label, columns)
    if not gated:
        result = t.select("column", "t_statistic", "p_value")
        if not explain:
            return result
        return result.select("column", *[F.col(c).cast("string").alias(c) for c in ("t_statistic", "p_value")])
    ks = ks_test(df, label, columns).select("column", F.col("p_value").alias("p_ks"))
    levene = levene_test(df, label, columns).select("column", F.col("p_value").alias("p_levene"))
    joined = t.join(ks, "column", "left").join(levene, "column", "left")
    differs, unequal = ~(F.col("p_ks") > alpha), ~(F.col("p_levene") > alpha)

    def shown(c: str) -> Column:
        if explain:
            return (
                F.when(differs, "N/A (different distributions)")
                .when(unequal, "N/A (unequal variances)")
                .otherwise(F.col(c).cast("string"))
                .alias(c)
            )
        return F.when(differs | unequal, 0.0).otherwise(F.col(c)).alias(c)

    return joined.select("column", shown("t_statistic"), shown("p_value"))
