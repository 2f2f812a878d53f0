"""Logistic regression whose coefficients are a table, so that there may be any number of places.

The optimiser is preconditioned conjugate gradients (Polak-Ribiere, restarted
where a direction does not lead down).  Its vectors are columns of a table with
a row per place; the driver holds the intercept and the dot products.  Margins
are linear in the step, so the line search only reads one table with a row per
row.  A place that only one row has needs no iteration: given the margin of the
row's other places its best coefficient is that of the row alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import forget, materialize

#: The intercept is searched in units that give its curvature the bound one, as those of all places.
INTERCEPT_UNIT = 2.0


@dataclass
class TableLogisticModel:
    """A fitted model: (place, coefficient) as a written table; places that are not in it have the coefficient zero."""

    coefficients: DataFrame
    intercept: float
    numFeatures: int
    features: str
    iterations: int = 0
    #: Length of the gradient where the search ended, in the units of the search.
    gradient: float = 0.0

    def margins(self, rows: DataFrame, key: str) -> DataFrame:
        """(key, margin) of the rows that have a known place."""
        hit = _entries(rows, self.features, key).join(self.coefficients, "place")
        return hit.groupBy(key).agg(F.sum(F.col("x") * F.col("coefficient")).alias("margin"))


def vector_size(features: str) -> Column:
    """The width of a vector column."""
    v = F.unwrap_udt(F.col(features))
    return F.coalesce(v["size"], F.size(v["values"]))


def _entries(rows: DataFrame, features: str, *kept: str) -> DataFrame:
    """(kept columns, place, x) of the components that are not zero."""
    v = F.unwrap_udt(F.col(features))
    dense = F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1))
    parts = rows.select(*kept, F.when(v["type"] == 0, v["indices"]).otherwise(dense).alias("place"), v["values"].alias("x"))
    pairs = parts.select(*kept, F.explode(F.arrays_zip("place", "x")).alias("e"))
    return pairs.select(*kept, F.col("e.place").cast("long").alias("place"), F.col("e.x").alias("x")).where("x <> 0")


def _checked(value: Column, right: Column, message: str) -> Column:
    """The value, or an error where it cannot be learned from, as of the learner of ``pyspark.ml``."""
    return F.when(F.coalesce(right, F.lit(False)), value).otherwise(F.raise_error(F.lit(message)))


def settle(z: np.ndarray, own: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Margins with the best coefficients of a row's own places: the root of e - z + own * (sigmoid(e) - y)."""
    low, high, e = z - own * (1 - y), z + own * y, z.copy()
    for _ in range(200):
        s = 1 / (1 + np.exp(-np.clip(e, -700, 700)))
        f = e - z + own * (s - y)
        low, high = np.where(f < 0, e, low), np.where(f > 0, e, high)
        step = e - f / (1 + own * s * (1 - s))
        step = np.where((step < low) | (step > high), (low + high) / 2, step)
        done = np.abs(step - e) <= 1e-14 * (1 + np.abs(e))
        e = step
        if done.all():
            break
    return e


def _settled(rows: DataFrame, step: float) -> DataFrame:
    """(row, zd, r, curve): residual and curvature of every row after a step."""

    def run(z: pd.Series, own: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(settle(z.to_numpy(), own.to_numpy(), y.to_numpy()))

    margin = F.pandas_udf(run, "double")
    at = rows.withColumn("e", margin(F.col("z") + F.lit(step) * F.col("zd"), "own", "y"))
    at = at.withColumn("s", 1 / (1 + F.exp(-F.col("e"))))
    bend = F.col("s") * (1 - F.col("s"))
    curve = F.col("weight") * bend / (1 + F.col("own") * bend)
    return at.select("row", "zd", (F.col("weight") * (F.col("s") - F.col("y"))).alias("r"), curve.alias("curve"))


def _slopes(rows: DataFrame, step: float) -> tuple[float, float, float]:
    """First and second derivative of the loss along the direction, and the sum of the residuals, after a step."""
    at = _settled(rows, step)
    return tuple(at.agg(F.sum(F.col("r") * F.col("zd")), F.sum(F.col("curve") * F.col("zd") * F.col("zd")), F.sum("r")).first())


def _line_search(rows: DataFrame, slope: float, ridge: tuple[float, float]) -> tuple[float, float]:
    """The step to a tenth of the slope or less, and the sum of the residuals there: Newton's method between two borders."""
    along, bend = ridge
    low, high, step = 0.0, math.inf, 0.0
    for _ in range(40):
        first, second, residual = _slopes(rows, step)
        first, second = first + along + step * bend, second + bend
        if step and abs(first) <= 0.1 * abs(slope):
            break
        if first < 0:
            low = step
        else:
            high = step
        step = step - first / second if second > 0 else math.inf
        if not low < step < high:
            step = (low + high) / 2 if high < math.inf else 2 * low + 1
    return step, residual


def fit(
    df: DataFrame, label: str, features: str, weight: str | None, max_iter: int, regularization: float, tolerance: float = 1e-6
) -> TableLogisticModel:
    """L2 logistic regression with an intercept that is not drawn to zero, on a vector column of any width.

    The loss is the weighted mean over the rows.  Ends when the gradient, in
    units that bound every curvature by one, is shorter than ``tolerance``.
    """
    share = F.col(weight) if weight else F.lit(1.0)
    y, share = F.col(label).cast("double"), share.cast("double")
    finite = F.forall(F.unwrap_udt(F.col(features))["values"], lambda x: F.abs(x) < math.inf)
    numbered = df.select(
        F.monotonically_increasing_id().alias("row"),
        _checked(y, y.isin(0.0, 1.0), "labels must be 0 or 1").alias("y"),
        _checked(share, (share >= 0) & (share < math.inf), "weights must be numbers from zero").alias("weight"),
        _checked(F.col(features), finite, "vectors must hold finite numbers").alias("features"),
    )
    numbered = materialize(numbered, "numbered")
    total, positive, width = numbered.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("y")), F.max(vector_size("features"))).first()
    if not 0 < positive < total:
        none = df.sparkSession.createDataFrame([], "place long, coefficient double")
        return TableLogisticModel(none, math.inf if positive else -math.inf, width, features)

    entries = materialize(_entries(numbered, "features", "row", "weight"), "entries")
    counted = entries.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("weight") * F.col("x") * F.col("x")).alias("square"))
    bound = F.lit(regularization) + F.col("square") / (4 * total)
    shared = counted.where(F.col("n") > (1 if regularization else 0)).select("place", F.when(bound > 0, bound).otherwise(1.0).alias("h"))
    shared = materialize(shared, "shared")
    scaled = materialize(entries.join(shared, "place").select("row", "place", (F.col("x") / F.sqrt("h")).alias("x")), "scaled")
    alone = materialize(entries.join(shared, "place", "left_anti").select("row", "place", "x"), "alone")
    forget(entries)
    own = alone.groupBy("row").agg(F.sum(F.col("x") * F.col("x")).alias("own"))
    part = F.col("weight") / total
    start = math.log(positive / (total - positive))
    rows = numbered.select("row", "y", "weight").join(own, "row", "left").select(
        "row", "y", part.alias("weight"), (F.coalesce("own", F.lit(0.0)) * part / (regularization or 1.0)).alias("own"),
        F.lit(start).alias("z"), F.lit(0.0).alias("zd"),
    )
    rows = materialize(rows, "margins")

    ridge = F.lit(regularization) / F.col("h")
    zero = F.lit(0.0)
    vectors = shared.select("place", "h", zero.alias("u"), zero.alias("d"), zero.alias("g"))
    step, intercept, turn, last, length = 0.0, 0.0, 0.0, 0.0, 0.0
    residual = _slopes(rows, 0.0)[2]
    old = None
    for round_ in range(max_iter + 1):
        # The gradient where the step ended.
        sums = _settled(rows, step).join(scaled, "row").groupBy("place").agg(F.sum(F.col("r") * F.col("x")).alias("sum"))
        moved = (F.col("u") + F.lit(step) * F.col("d")).alias("u")
        vectors = vectors.join(sums, "place", "left").select("place", "h", moved, "d", F.col("g").alias("before"), F.coalesce("sum", zero).alias("sum"))
        vectors = materialize(vectors.select("place", "h", "u", "d", "before", (F.col("sum") + ridge * F.col("u")).alias("g")), "places")
        if old is not None:
            forget(old)
        old = vectors
        intercept, steep = intercept + step * turn, INTERCEPT_UNIT * residual
        pair = lambda a, b, of=F.lit(1.0): F.coalesce(F.sum(of * F.col(a) * F.col(b)), zero)
        gg, gb, gd, ug, ud, rgg, rgd, rdd = vectors.agg(
            pair("g", "g"), pair("g", "before"), pair("g", "d"), pair("u", "g", ridge), pair("u", "d", ridge),
            pair("g", "g", ridge), pair("g", "d", ridge), pair("d", "d", ridge),
        ).first()
        now = gg + steep * steep
        if math.sqrt(now) <= tolerance or round_ == max_iter:
            break
        beta = max(0.0, (now - gb - steep * last) / length) if length else 0.0
        if beta * (gd + steep * turn) >= now:
            beta = 0.0
        slope = -now + beta * (gd + steep * turn)
        turn, last, length = -steep + beta * turn, steep, now
        vectors = vectors.select("place", "h", "u", (-F.col("g") + F.lit(beta) * F.col("d")).alias("d"), "g")
        along = scaled.join(vectors.select("place", "d"), "place").groupBy("row").agg(F.sum(F.col("x") * F.col("d")).alias("along"))
        ahead = rows.select("row", "y", "weight", "own", (F.col("z") + F.lit(step) * F.col("zd")).alias("z")).join(along, "row", "left")
        turned = (F.coalesce("along", zero) + F.lit(INTERCEPT_UNIT * turn)).alias("zd")
        ahead = materialize(ahead.select("row", "y", "weight", "own", "z", turned), "margins")
        forget(rows)
        rows = ahead
        step, residual = _line_search(rows, slope, (beta * ud - ug, rgg - 2 * beta * rgd + beta * beta * rdd))

    coefficients = vectors.select("place", (F.col("u") / F.sqrt("h")).alias("coefficient"))
    if regularization:
        left = alone.join(_settled(rows, step).select("row", "r"), "row")
        coefficients = coefficients.unionByName(left.select("place", (-F.col("r") * F.col("x") / regularization).alias("coefficient")))
    coefficients = materialize(coefficients, "coefficients")
    for table in (numbered, scaled, alone, rows, vectors):
        forget(table)
    return TableLogisticModel(coefficients, start + INTERCEPT_UNIT * intercept, width, features, round_, math.sqrt(now))
