"""Model evaluation tables: confusion counts, curves, rank scores, contributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.ranking import rank_by_score
from tideline.operators.running import exact_quantiles, running_totals

# Thresholds tried, 0.20 to 0.80 in steps of 0.05.
THRESHOLDS = [i / 20 for i in range(4, 17)]


def hard_label(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = F.col(label), F.col(predicted)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and the area under the hard-label curve."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    zero = F.lit(0.0)
    return counts.withColumns(
        {
            "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
            "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
            "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
            "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
            "roc_auc": (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2,
        }
    )


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Report of hard predictions at a threshold, one row."""
    scored = df.select(label, hard_label(F.col(score), threshold).alias("__p"))
    return rates(confusion(scored, label, "__p"))


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    cells = df.groupBy(F.col(label).alias("y"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"), F.lit(0).cast("long").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit")
    )
    zero = F.lit(0.0)
    return per.select(
        "class",
        F.coalesce(F.try_divide("hit", "called"), zero).alias("precision"),
        F.coalesce(F.try_divide("hit", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hit"), F.col("called") + F.col("support")), zero).alias("f1"),
        "support",
    )


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, with the score negated for falling order."""
    rows = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    return rows.groupBy((-F.col(score).cast("double")).alias("down")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the curve with ties counted half; null if a class is absent.

    Scores are counted per distinct value and accumulated over slices of the
    score range, so neither a tied score nor the whole table meets in one task.
    """
    cum = running_totals(_by_score(df, label, score), ["down"], {"pos_upto": "pos"})
    above = F.col("pos_upto") - F.col("pos")
    wins = F.sum(F.col("neg") * (above + F.col("pos") / 2))
    return cum.agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def curve_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC and precision-recall points, one per distinct score as threshold."""
    grouped = _by_score(df, label, score)
    cum = running_totals(grouped, ["down"], {"tp": "pos", "fp": "neg"})
    known = df.where(F.col(score).isNotNull())
    all_pos = known.select(F.count_if(F.col(label) == 1)).scalar()
    all_neg = known.select(F.count_if(F.col(label) == 0)).scalar()
    return cum.select(
        (-F.col("down")).alias("threshold"),
        "tp",
        "fp",
        F.try_divide(F.col("fp"), all_neg).alias("fpr"),
        F.try_divide(F.col("tp"), all_pos).alias("tpr"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), all_pos).alias("recall"),
    )


def mean_curves(points: DataFrame, run: str, steps: int = 100) -> DataFrame:
    """Curves of several runs averaged on a fixed grid of false-positive rates.

    The value of a run at a grid point is its highest rate reached by then.
    """
    cell = F.ceil(F.col("fpr") * steps).cast("int")
    reached = points.select(run, cell.alias("g"), "tpr").groupBy(run, "g").agg(F.max("tpr").alias("tpr"))
    grid = reached.select(run, F.explode(F.sequence(F.col("g"), F.lit(steps))).alias("g"), "tpr")
    best = grid.groupBy(run, "g").agg(F.max("tpr").alias("tpr"))
    return best.groupBy("g").agg(F.avg("tpr").alias("tpr"), F.count(F.lit(1)).alias("runs")).select(
        (F.col("g") / steps).alias("fpr"), "tpr", "runs"
    )


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Counts and rates at each threshold, all from one pass without multiplying rows.

    ``best`` marks the threshold with the largest area, the lowest of equals.
    """
    y, s = F.col(label), F.col(score)
    parts = [F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("n")]
    for i, t in enumerate(thresholds):
        parts += [F.count_if((y == 1) & (s >= t)).alias(f"tp{i}"), F.count_if((y == 0) & (s >= t)).alias(f"fp{i}")]
    wide = df.agg(*parts)
    entries = [
        F.struct(
            F.lit(t).alias("threshold"),
            (F.col("n") - F.col(f"fp{i}")).alias("tn"),
            F.col(f"fp{i}").alias("fp"),
            (F.col("p") - F.col(f"tp{i}")).alias("fn"),
            F.col(f"tp{i}").alias("tp"),
        )
        for i, t in enumerate(thresholds)
    ]
    swept = rates(wide.select(F.inline(F.array(*entries))))
    winner = swept.select(F.max_by("threshold", F.struct(F.col("roc_auc"), -F.col("threshold")))).scalar()
    return swept.withColumn("best", (F.col("threshold") == winner).cast("int"))


def top_bottom(
    df: DataFrame, label: str, score: str, key: str, top: int | None = 200, bottom: int | None = None
) -> DataFrame:
    """How well the best and worst scored rows separate the classes, one row.

    ``top`` and ``bottom`` default to a fifth of the rows when not given.
    """
    ranked = rank_by_score(df.select(key, label, score), score, [key])
    n = df.select(F.count(F.lit(1))).scalar()
    fifth = F.floor(n * F.lit(0.2))
    top_n = F.least(F.lit(top).cast("long"), n) if top is not None else fifth
    bottom_n = F.least(F.lit(bottom).cast("long"), n) if bottom is not None else fifth
    y, pos = F.col(label), F.col("position")
    sums = ranked.agg(
        F.max(top_n).alias("top_rows"),
        F.max(bottom_n).alias("bottom_rows"),
        F.sum(y).alias("positives"),
        F.coalesce(F.sum(F.when(pos <= top_n, y)), F.lit(0)).alias("top_hits"),
        F.coalesce(F.sum(F.when(pos > n - bottom_n, y)), F.lit(0)).alias("bottom_hits"),
        F.coalesce(
            F.sum(F.when((pos > F.floor(n * F.lit(0.1))) & (pos <= F.floor(n * F.lit(0.9))), y)), F.lit(0)
        ).alias("middle_hits"),
    )
    pls = F.try_divide("top_hits", "top_rows")
    pds = F.try_divide(F.col("bottom_rows") - F.col("bottom_hits"), F.col("bottom_rows"))
    best_pls = F.try_divide("positives", "top_rows")
    worst_pds = F.try_divide(F.col("bottom_rows") - F.col("positives"), F.col("bottom_rows"))
    normal = 0.7 * F.try_divide(pls, best_pls) + 0.3 * F.try_divide(pds - worst_pds, 1 - worst_pds)
    return sums.withColumns({"score": F.round(0.7 * pls + 0.3 * pds, 6), "normalized_score": normal})


def score_histogram(df: DataFrame, label: str, score: str, bins: int = 20) -> DataFrame:
    """Share and density of the scores 0..1 per label and bin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(F.col(label).alias("__l")).agg(F.sum("n").alias("__all"))
    joined = counts.join(sizes, counts[label] == sizes["__l"])
    share = F.col("n") / F.col("__all")
    return joined.select(
        label, "bin", (F.col("bin") / bins).alias("low"), "n", share.alias("share"), (share * bins).alias("density")
    )


def score_boxes(df: DataFrame, name: str, score: str) -> DataFrame:
    """Box statistics of the scores of each model."""
    quartiles = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    boxes = exact_quantiles(df, score, quartiles, [name])
    means = df.groupBy(name).agg(F.avg(score).alias("mean"), F.count(score).alias("n"))
    return boxes.join(means, name)


# -- contributions: long tables (row, feature, contribution) -----------------


def prediction_and_error(contributions: DataFrame, outcomes: DataFrame, row: str, label: str, predicted: str) -> DataFrame:
    """Per feature: mean absolute contribution, and how much it adds to the error."""
    y, p, s = F.col(label), F.col(predicted), F.col("contribution")
    joined = contributions.join(outcomes.select(row, label, predicted), row)
    return joined.groupBy("feature").agg(
        F.avg(F.abs(s)).alias("prediction_contribution"),
        F.avg(F.abs(y - p) - F.abs(y - (p - s))).alias("error_contribution"),
    )


def importance_table(contributions: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Mean and mean absolute contribution, with the split count, gain and cover of the trees.

    ``splits`` holds (feature, gain, cover), one row per inner node.
    """
    table = contributions.groupBy("feature").agg(
        F.avg("contribution").alias("mean_contribution"), F.avg(F.abs("contribution")).alias("mean_abs_contribution")
    )
    if splits is None:
        return table
    nodes = splits.groupBy("feature").agg(
        F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover")
    )
    joined = table.join(nodes, "feature", "left")
    return joined.fillna({"weight": 0, "gain": 0.0, "cover": 0.0})


def parent_of(feature: Column, parents: Sequence[str]) -> Column:
    """The first listed column whose name the feature starts with, else the feature itself."""
    chain = None
    for p in parents:
        hit = F.startswith(feature, F.lit(p))
        chain = F.when(hit, p) if chain is None else chain.when(hit, p)
    return feature if chain is None else chain.otherwise(feature)


def roll_up(contributions: DataFrame, row: str, parents: Sequence[str]) -> DataFrame:
    """Contributions of encoded children summed to their parent column, per row."""
    return contributions.groupBy(row, parent_of(F.col("feature"), parents).alias("feature")).agg(
        F.sum("contribution").alias("contribution")
    )


def roll_up_classes(contributions: DataFrame, row: str, classes: DataFrame) -> DataFrame:
    """Contributions summed per feature class; ``classes`` holds (column, class)."""
    named = classes.select(F.col(classes.columns[0]).alias("feature"), F.col(classes.columns[1]).alias("class"))
    return (
        contributions.join(named.where(F.col("class").isNotNull()), "feature")
        .groupBy(row, "class")
        .agg(F.sum("contribution").alias("contribution"))
    )


def contribution_values(contributions: DataFrame, rows: DataFrame, row: str, features: Sequence[str]) -> DataFrame:
    """Contribution next to the feature's value, for the chosen features."""
    listed = [f for f in features if f in rows.columns]
    values = rows.select(row, *[F.col(f"`{f}`").cast("string").alias(f) for f in listed]).unpivot(
        [row], listed, "feature", "value"
    )
    return contributions.where(F.col("feature").isin(listed)).join(values, [row, "feature"])


def average_metrics(runs: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of each metric over repeated runs."""
    means = [F.avg(m).alias(m) for m in metrics]
    return runs.groupBy(*by).agg(*means) if by else runs.agg(*means)
