"""Training, tuning, feature elimination, scoring and tree contributions.

The learners are those of ``pyspark.ml``; the loops around them run on the
driver and only ever hold models, feature names and metric rows.
"""

from __future__ import annotations

import itertools
import json
import math
import random
import sys
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Imputer, ImputerModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import evaluate, linear, sampling
from tideline.operators.columns import align_to_schema
from tideline.operators.encode import apply_shares, category, fit_shares
from tideline.operators.joins import union_all
from tideline.session import materialize, work_dir

MISSING_NUMBER = -sys.float_info.max  # below every other value, so trees can split it off
HASH_DIGITS = 12
#: Coefficients that a learner may keep on the driver, with the vectors of its optimiser.
DRIVER_PLACES = 1 << 18


@dataclass
class FeatureSet:
    """Feature columns split by type, and how to turn them into one vector."""

    numeric: list[str]
    text: list[str] = field(default_factory=list)
    #: Text columns that are turned into a number by hash instead of being listed: for any number of categories.
    hashed: list[str] = field(default_factory=list)
    #: Text columns read as the share of positives among the training rows of their category: also for any number.
    shared: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, df: DataFrame, names: Sequence[str], hashed: Sequence[str] = (), shared: Sequence[str] = ()) -> "FeatureSet":
        kinds = {f.name: f.dataType for f in df.schema.fields}
        known = [n for n in names if n in kinds]
        text = [n for n in known if isinstance(kinds[n], T.StringType)]
        numeric = [n for n in known if n not in text]
        listed = [n for n in text if n not in hashed and n not in shared]
        return cls(numeric, listed, [n for n in text if n in hashed], [n for n in text if n in shared and n not in hashed])

    @property
    def names(self) -> list[str]:
        return self.numeric + self.hashed + self.shared + self.text

    def typed(self, df: DataFrame) -> DataFrame:
        """Numbers as doubles, listed texts with null as a category, hashed texts as their place in hash order."""
        place = lambda c: F.conv(F.substring(F.md5(category(F.col(c))), 1, HASH_DIGITS), 16, 10).cast("double")
        return df.withColumns(
            {c: F.col(c).cast("double") for c in self.numeric}
            | {f"{c}__hash": place(c) for c in self.hashed}
            | {c: category(F.col(c)) for c in self.text}
        )

    def clean(self, df: DataFrame) -> DataFrame:
        """As trees read it: missing numbers are marked by a number below all others."""
        return self.typed(df).withColumns({c: F.coalesce(F.col(c), F.lit(MISSING_NUMBER)) for c in self.numeric})

    def with_presence(self, df: DataFrame) -> DataFrame:
        """As linear models read it: missing numbers stay null, and a flag tells whether there is one."""
        return self.typed(df).withColumns({f"{c}__known": F.col(c).isNotNull().cast("double") for c in self.numeric})

    def linear_stages(self) -> list:
        """Fill missing numbers with the fitted median, then list categories and assemble."""
        filled = [f"{c}__filled" for c in self.numeric]
        fill = [Imputer(strategy="median", inputCols=self.numeric, outputCols=filled)] if self.numeric else []
        *index, assemble = self.stages()
        known = [f"{c}__known" for c in self.numeric]
        rest = assemble.getInputCols()[len(self.numeric) :]
        return [*fill, *index, VectorAssembler(inputCols=[*filled, *known, *rest], outputCol="features")]

    def stages(self, shares: str | None = None) -> list:
        """Stages that turn the cleaned columns into one vector; ``shares`` is the folder of the share table."""
        coded = [f"{c}__code" for c in self.text]
        stages = [ShareModel(columns=self.shared, path=shares)] if self.shared else []
        if self.text:
            stages.append(
                StringIndexer(inputCols=self.text, outputCols=coded, handleInvalid="keep", stringOrderType="alphabetAsc")
            )
        stages.append(VectorAssembler(inputCols=[*self.numeric, *[f"{c}__hash" for c in self.hashed], *[f"{c}__share" for c in self.shared], *coded], outputCol="features"))
        return stages


class ShareModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the fitted share of every listed column's category, read from a table that may be of any size.

    A category that was not seen gets the number of a missing value.
    """

    @keyword_only
    def __init__(self, columns: Sequence[str] | None = None, path: str | None = None):
        super().__init__()
        self.columns = Param(self, "columns", "text columns", TypeConverters.toListString)
        self.path = Param(self, "path", "folder of the share table", TypeConverters.toString)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = self.getOrDefault(self.columns)
        shares = dataset.sparkSession.read.schema("column string, value string, share double").parquet(self.getOrDefault(self.path))
        added = apply_shares(dataset, shares, columns)
        return added.withColumns({f"{c}__share": F.coalesce(F.col(f"{c}__share"), F.lit(MISSING_NUMBER)) for c in columns})

    def moved(self, path: str) -> "ShareModel":
        """The same stage with its table copied to ``path``."""
        spark = SparkSession.getActiveSession()
        spark.read.parquet(self.getOrDefault(self.path)).write.mode("overwrite").parquet(path)
        return self.copy({self.path: path})


def _weighted(df: DataFrame, label: str, positive_weight: float | None) -> DataFrame:
    if positive_weight is None:
        return df
    return df.withColumn("__weight", F.when(F.col(label) == 1, float(positive_weight)).otherwise(1.0))


def prepare_boosted(
    df: DataFrame, features: Sequence[str], label: str, hashed: Sequence[str] = (), shared: Sequence[str] = (), prior: float = 1.0
) -> tuple[FeatureSet, PipelineModel, int]:
    """What boosted trees need to know of the features: how to assemble them, and the most values a listed column has."""
    fs = FeatureSet.of(df, features, hashed, shared)
    path = None
    if fs.shared:
        path = "/".join([work_dir(df.sparkSession), "tideline", df.sparkSession.sparkContext.applicationId, f"shares-{uuid.uuid4().hex}"])
        fit_shares(df, fs.shared, label, prior).write.parquet(path)
    rows = fs.clean(df.select(*{*fs.names, label}))
    prepared = Pipeline(stages=fs.stages(path)).fit(rows)
    arities = [len(a) + 1 for stage in prepared.stages if isinstance(stage, StringIndexerModel) for a in stage.labelsArray]
    return fs, prepared, max(32, *arities, 0)


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    max_iter: int = 20,
    max_depth: int = 3,
    step: float = 0.1,
    subsample: float = 1.0,
    min_child: int = 1,
    positive_weight: float | None = None,
    weight: str | None = None,
    seed: int = 42,
    min_gain: float = 0.0,
    column_sample: str = "all",
    hashed: Sequence[str] = (),
    shared: Sequence[str] = (),
    prior: float = 1.0,
    prepared: tuple[FeatureSet, PipelineModel, int] | None = None,
) -> PipelineModel:
    """Boosted trees on the given columns; text columns are split as categories.

    The values of a category column are listed on the driver.  Columns named
    in ``shared`` or ``hashed`` are not, whatever their number of values: they
    are ordered by their share of positives (drawn towards the overall share by
    ``prior`` rows), or by hash.  ``prepared`` reuses a preparation.
    """
    fs, stages, bins = prepared or prepare_boosted(df, features, label, hashed, shared, prior)
    rows = _weighted(fs.clean(df.select(*{*fs.names, label, *([weight] if weight else [])})), label, positive_weight)
    learner = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step,
        subsamplingRate=subsample,
        minInstancesPerNode=min_child,
        minInfoGain=min_gain,
        featureSubsetStrategy=column_sample,
        maxBins=bins,
        seed=seed,
    )
    if weight or positive_weight is not None:
        learner = learner.setWeightCol(weight or "__weight")
    model = learner.fit(stages.transform(rows))
    return PipelineModel(stages=[*stages.stages, model])


def model_features(model: PipelineModel) -> FeatureSet:
    """The columns a fitted model reads."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    inputs = assembler.getInputCols()
    ending = lambda mark: [c.removesuffix(mark) for c in inputs if c.endswith(mark)]
    marked = ("__code", "__hash", "__share", "__known", "__filled")
    numeric = ending("__filled") or [c for c in inputs if not c.endswith(marked)]
    return FeatureSet(numeric, ending("__code"), ending("__hash"), ending("__share"))


def _as_read(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All columns of ``df`` under other names, and the model's own as it reads them."""
    fs = model_features(model)
    kept = [F.col(f"`{c}`").alias(f"__keep_{c}") for c in df.columns]
    wide = df.select(*kept, *[F.col(f"`{c}`") for c in fs.names])
    linear = any(isinstance(s, ImputerModel) for s in model.stages)
    return fs.with_presence(wide) if linear else fs.clean(wide)


def score(model: PipelineModel, df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Add the positive probability; the input columns stay as they are."""
    scored = model.transform(_as_read(model, df))
    return scored.select(
        *[F.col(f"`__keep_{c}`").alias(c) for c in df.columns], vector_to_array("probability")[1].alias(out)
    )


def score_batch(
    model: PipelineModel | Sequence[PipelineModel],
    df: DataFrame,
    schema: T.StructType,
    row: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Align rows to the saved feature schema, score them, and write them if asked.

    Several models are the bags of one ensemble.
    """
    models = [model] if isinstance(model, PipelineModel) else list(model)
    kept = df if row is None else df.withColumnRenamed(row, "__row")
    wanted = schema if row is None else T.StructType([*schema.fields, T.StructField("__row", df.schema[row].dataType)])
    result = score_bags(models, align_to_schema(kept, wanted), "probabilities")
    result = result.select(*([F.col("__row").alias(row)] if row else []), "probabilities")
    if path:
        result.write.mode("overwrite").option("header", True).csv(path)
    return result


def fit_logistic(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    max_iter: int = 10,
    regularization: float = 1e-3,
) -> tuple[PipelineModel, DataFrame]:
    """L2 logistic regression with optional row weights, and its area on both sets.

    Missing numbers are filled with the median of the training rows and flagged;
    a column without any number in them is left out.
    """
    fs = FeatureSet.of(train, features)
    held = train.agg(F.lit(0), *[F.count(F.col(c).cast("double")) for c in fs.numeric]).first()[1:]
    fs.numeric = [c for c, n in zip(fs.numeric, held) if n]
    learner = LogisticRegression(
        labelCol=label, featuresCol="features", maxIter=max_iter, regParam=regularization, elasticNetParam=0.0
    )
    if weight:
        learner = learner.setWeightCol(weight)
    model = Pipeline(stages=[*fs.linear_stages(), learner]).fit(fs.with_presence(train))
    areas = [
        evaluate.roc_auc(score(model, part), label, "probability_1").select(F.lit(name).alias("part"), "roc_auc")
        for name, part in (("train", train), ("test", test))
    ]
    return model, union_all(areas)


def fit_sparse_logistic(
    df: DataFrame,
    label: str,
    features: str = "features",
    weight: str | None = None,
    max_iter: int = 50,
    regularization: float = 1e-3,
    driver_places: int = DRIVER_PLACES,
) -> LogisticRegressionModel | linear.TableLogisticModel:
    """L2 logistic regression on a vector column, which may be sparse and of any width.

    Up to ``driver_places`` places the learner is that of ``pyspark.ml``, whose
    optimiser keeps some 25 vectors on the driver; of wider vectors the
    coefficients are a table.
    """
    if (df.agg(F.max(linear.vector_size(features))).first()[0] or 0) > driver_places:
        return linear.fit(df, label, features, weight, max_iter, regularization)
    learner = LogisticRegression(
        labelCol=label, featuresCol=features, maxIter=max_iter, regParam=regularization, elasticNetParam=0.0, standardization=False
    )
    return (learner.setWeightCol(weight) if weight else learner).fit(df)


def score_vectors(model: LogisticRegressionModel | linear.TableLogisticModel, df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Add the positive probability of rows that carry the model's vector column."""
    if isinstance(model, linear.TableLogisticModel):
        numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "to-score")
        margin = F.coalesce("margin", F.lit(0.0)) + F.lit(model.intercept)
        scored = numbered.join(model.margins(numbered, "__row"), "__row", "left")
        return scored.select(*[F.col(f"`{c}`") for c in df.columns], (1 / (1 + F.exp(-margin))).alias(out))
    scored = model.transform(df)
    return scored.select(*[f"`{c}`" for c in df.columns], vector_to_array("probability")[1].alias(out))


# -- search ------------------------------------------------------------------

#: Independent fits that run at the same time; each is a chain of small jobs that leaves executors idle.
AT_ONCE = 4


def several(run: Callable, tasks: Sequence) -> list:
    """Results of independent fits in the order of the tasks."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.getActiveSession())(run), tasks))


def candidates(grid: Mapping[str, Sequence], draws: int | None = None, seed: int = 1042) -> list[dict]:
    """All combinations, or a seeded draw of them without repetition."""
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    if draws is None or draws >= len(combos):
        return combos
    return random.Random(seed).sample(combos, draws)


def accuracy(model: PipelineModel, df: DataFrame, label: str) -> float:
    """Share of right hard predictions (micro F1 of a single-label task)."""
    hit = (F.col("probability_1") >= 0.5).cast("int") == F.col(label)
    return score(model, df).agg(F.avg(hit.cast("double"))).first()[0]


def search(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    grid: Mapping[str, Sequence],
    folds: int = 3,
    draws: int | None = 5,
    seed: int = 42,
    fit: Callable[..., PipelineModel] = fit_boosted,
) -> tuple[dict, DataFrame]:
    """Best parameters by mean accuracy over stratified folds, and all results.

    When the positive weight is searched, the class ratio of the data joins
    its candidates.
    """
    grid = {k: list(v) for k, v in grid.items()}
    if "positive_weight" in grid:
        grid["positive_weight"].append(evaluate_ratio(df, label))
    folded = materialize(
        sampling.fold_stratified(df.select(*{key, label, *features}), key, label, folds, 1000 + seed), "folds"
    )

    def run(task: tuple[int, dict, int]) -> tuple:
        number, params, f = task
        model = fit(folded.where(F.col("fold") != f), features, label, **params)
        return number, json.dumps(params), f, accuracy(model, folded.where(F.col("fold") == f), label)

    drawn = enumerate(candidates(grid, draws, 1000 + seed))
    rows = several(run, [(number, params, f) for number, params in drawn for f in range(folds)])
    table = df.sparkSession.createDataFrame(rows, "candidate int, params string, fold int, score double")
    means: dict[int, list[float]] = {}
    for number, _, _, value in rows:
        means.setdefault(number, []).append(value)
    best = max(means, key=lambda c: (sum(means[c]) / len(means[c]), -c))
    return json.loads(next(r[1] for r in rows if r[0] == best)), table


def evaluate_ratio(df: DataFrame, label: str) -> float:
    """Positives per negative."""
    row = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    return row["p"] / row["n"]


def compare_models(
    df: DataFrame, key: str, label: str, models: Mapping[str, Callable[[DataFrame], PipelineModel]], folds: int = 3, seed: int = 42
) -> DataFrame:
    """(model, fold, score) by cross-validation, one row per fit."""
    folded = materialize(sampling.fold_stratified(df, key, label, folds, seed), "folds")

    def run(task: tuple[str, int]) -> tuple:
        name, f = task
        model = models[name](folded.where(F.col("fold") != f).drop("fold"))
        return name, f, accuracy(model, folded.where(F.col("fold") == f), label)

    rows = several(run, [(name, f) for name in models for f in range(folds)])
    return df.sparkSession.createDataFrame(rows, "model string, fold int, score double")


def repeat_evaluation(
    df: DataFrame,
    key: str,
    label: str,
    fit: Callable[[DataFrame], PipelineModel],
    seeds: Sequence[int],
    test_ratio: float = 0.2,
) -> DataFrame:
    """Hold-out metrics of one learner for several split seeds, one row per seed."""
    parts = []
    for seed in seeds:
        train, test = sampling.train_test(df, key, test_ratio, seed)
        scored = materialize(score(fit(train), test).select(key, label, "probability_1"), "scored")
        parts.append(evaluate.classification_metrics(scored, label, "probability_1").withColumn("seed", F.lit(seed)))
    return union_all(parts)


# -- contributions -----------------------------------------------------------


def tree_nodes(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes of all trees: tree, weight, node, value, children, split."""
    booster = model.stages[-1]
    path = "/".join([work_dir(spark), "tideline", spark.sparkContext.applicationId, f"model-{uuid.uuid4().hex}"])
    booster.save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").select("tree", "weight")
    return nodes.join(weights, "tree").select(
        "tree",
        "weight",
        F.col("id").alias("node"),
        F.col("prediction").alias("value"),
        "gain",
        F.col("rawCount").alias("cover"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("rule"),
        F.col("split.numCategories").alias("categories"),
    )


def split_table(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(feature, gain, cover) of every inner node."""
    names = F.array(*[F.lit(n) for n in model_features(model).names])
    inner = tree_nodes(model, spark).where(F.col("left") >= 0)
    return inner.select(names[F.col("feature")].alias("feature"), "gain", F.col("cover").cast("double").alias("cover"))


def contributions(model: PipelineModel, df: DataFrame, row: str) -> DataFrame:
    """(row, feature, contribution, bias): the change of value along each tree's path.

    Per row, bias plus contributions is the raw score of the ensemble.  The
    trees are small (depth times count), so their node arrays travel with the
    task; rows are processed in Arrow batches.
    """
    fs = model_features(model)
    spark = df.sparkSession
    trees = []
    for _, part in itertools.groupby(
        sorted(tree_nodes(model, spark).collect(), key=lambda r: (r["tree"], r["node"])), key=lambda r: r["tree"]
    ):
        nodes = list(part)
        trees.append(
            (
                nodes[0]["weight"],
                np.array([n["value"] for n in nodes]),
                np.array([n["left"] for n in nodes]),
                np.array([n["right"] for n in nodes]),
                np.array([n["feature"] for n in nodes]),
                [(n["categories"], list(n["rule"])) for n in nodes],
            )
        )
    width = len(fs.names)
    bias = float(sum(w * values[0] for w, values, *_ in trees))

    def walk(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), width))
        for weight, values, left, right, feature, rules in trees:
            at = np.zeros(len(x), dtype=int)
            while True:
                inner = np.unique(at[left[at] >= 0])
                if not len(inner):
                    break
                for node in inner:
                    here = np.nonzero(at == node)[0]
                    arity, rule = rules[node]
                    v = x[here, feature[node]]
                    goes_left = v <= rule[0] if arity < 0 else np.isin(v, rule)
                    child = np.where(goes_left, left[node], right[node])
                    out[here, feature[node]] += weight * (values[child] - values[node])
                    at[here] = child
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                found = walk(np.array(b["x"].tolist(), dtype=float))
                yield pd.DataFrame({row: b[row], "c": list(found)})

    prepared = PipelineModel(stages=model.stages[:-1]).transform(
        fs.clean(df.select(F.col(row), *[F.col(c) for c in fs.names if c != row]))
    )
    x = prepared.select(row, vector_to_array("features").alias("x"))
    kind = df.schema[row].dataType.simpleString()
    per_row = x.mapInPandas(run, f"`{row}` {kind}, c array<double>")
    names = F.array(*[F.lit(n) for n in fs.names])
    long = per_row.select(row, F.posexplode("c").alias("i", "contribution"))
    return long.select(row, names[F.col("i")].alias("feature"), "contribution", F.lit(bias).alias("bias"))


def importances(long: DataFrame) -> DataFrame:
    """Sum of absolute contributions per feature."""
    return long.groupBy("feature").agg(F.sum(F.abs("contribution")).alias("importance"))


# -- elimination -------------------------------------------------------------


def eliminate_features(
    train: DataFrame,
    test: DataFrame,
    row: str,
    features: Sequence[str],
    label: str,
    metric: str = "f1",
    threshold: float = 0.05,
    step: float | int = 0.1,
    min_features: int = 20,
    fit: Callable[..., PipelineModel] = fit_boosted,
    **params,
) -> tuple[list[str], DataFrame]:
    """Drop the least important features while the metric holds.

    First every feature without any contribution goes, then in each round the
    lowest ``step`` (a share, or a number) but at least one.  A round counts
    when the metric stays within ``threshold`` of the best so far; threshold 0
    runs to the end and returns the best-scoring set.  Also returns the rounds.
    """

    def measure(names: list[str]) -> tuple[PipelineModel, float]:
        model = fit(train, names, label, **params)
        return model, evaluate.classification_metrics(score(model, test), label, "probability_1").first()[metric]

    def ranked(model: PipelineModel) -> list[tuple[str, float]]:
        table = importances(contributions(model, test, row)).collect()
        return sorted(((r["feature"], r["importance"]) for r in table), key=lambda p: (p[1], p[0]))

    current = list(features)
    model, best = measure(current)
    rounds = [(0, len(current), float(best), True)]
    chosen = top = current
    order = ranked(model)
    candidate = [f for f, importance in order if importance != 0] or current
    number = 0
    while candidate and len(candidate) < len(current) + (number == 0):
        number += 1
        model, value = measure(candidate)
        accepted = threshold == 0 or value >= best * (1 - threshold)
        rounds.append((number, len(candidate), float(value), bool(accepted)))
        if not accepted:
            break
        chosen = current = candidate
        if value > best:
            best, top = value, candidate
        order = ranked(model)
        drop = step if isinstance(step, int) else math.floor(step * len(order))
        candidate = [f for f, _ in order[max(1, drop):]]
        if len(candidate) < min_features:
            break
    table = train.sparkSession.createDataFrame(rounds, f"round int, n_features int, {metric} double, accepted boolean")
    return (top if threshold == 0 else chosen), table


# -- bagging, persistence ----------------------------------------------------


def fit_bags(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    bags: int = 40,
    seed: int = 42,
    strategy: str = "not minority",
    hashed: Sequence[str] = (),
    shared: Sequence[str] = (),
    prior: float = 1.0,
    **params,
) -> list[PipelineModel]:
    """One model per bootstrap replicate; the classes of every replicate have exactly the sizes that ``strategy`` asks for.

    The features are prepared once for all bags, and the rows are written once
    with their draws for every bag, so a bag is a filter.
    """
    rows = df.select(*dict.fromkeys([key, label, *features]))
    weights = sampling.exact_bags(rows, key, label, bags, strategy, seed).withColumnRenamed(key, "__key")
    drawn = materialize(rows.join(weights, rows[key] == weights["__key"]).drop("__key"), "bags")
    prepared = prepare_boosted(rows, features, label, hashed, shared, prior)

    def run(b: int) -> PipelineModel:
        bag = drawn.withColumn("weight", F.get("weights", F.lit(b)).cast("double")).where(F.col("weight") > 0)
        return fit_boosted(bag, features, label, weight="weight", prepared=prepared, **params)

    return several(run, range(bags))


@dataclass
class Forest:
    """All trees of all boosted models in one table of nodes, a model's sum of trees being one score.

    A node has a feature, a threshold or the list of the categories that go
    left, its children, and a value; a leaf is its own child.
    """

    root: np.ndarray
    weight: np.ndarray
    model: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    #: Categories that go left, by node; empty for numeric splits.
    listed: np.ndarray
    by_list: np.ndarray

    @classmethod
    def of(cls, models: Sequence[PipelineModel]) -> "Forest":
        nodes: list[list] = []
        lists: list[list[int]] = []
        roots, weights, owner = [], [], []

        def add(node) -> int:
            at = len(nodes)
            nodes.append([0, np.inf, at, at, float(node.prediction())])
            lists.append([])
            if node.subtreeDepth() > 0:
                split = node.split()
                nodes[at][0] = split.featureIndex()
                if split.getClass().getSimpleName() == "CategoricalSplit":
                    lists[at] = [int(c) for c in split.leftCategories()]
                else:
                    nodes[at][1] = float(split.threshold())
                nodes[at][2], nodes[at][3] = add(node.leftChild()), add(node.rightChild())
            return at

        for m, model in enumerate(models):
            booster = model.stages[-1]
            for tree, w in zip(booster._java_obj.trees(), booster.treeWeights):
                roots.append(add(tree.rootNode()))
                weights.append(w)
                owner.append(m)
        feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
        width = 1 + max((max(x) for x in lists if x), default=0)
        listed = np.zeros((len(nodes), width), dtype=bool)
        for at, x in enumerate(lists):
            listed[at, x] = True
        by_list = np.array([bool(x) for x in lists])
        return cls(np.array(roots), np.array(weights), np.array(owner), feature.astype(int), threshold, left.astype(int), right.astype(int), value, listed, by_list)

    def mean_probability(self, x: np.ndarray) -> np.ndarray:
        """Mean over the models of the positive probability, all trees walked together."""
        out = np.empty(len(x))
        for start in range(0, len(x), 1_000):
            part = x[start : start + 1_000]
            row = np.arange(len(part))[:, None]
            at = np.broadcast_to(self.root, (len(part), len(self.root))).copy()
            while True:
                v = part[row, self.feature[at]]
                goes_left = v <= self.threshold[at]
                lists = self.by_list[at]
                if lists.any():
                    c = v[lists].astype(int)
                    known = c < self.listed.shape[1]
                    goes_left[lists] = known & self.listed[at[lists], np.where(known, c, 0)]
                child = np.where(goes_left, self.left[at], self.right[at])
                if (child == at).all():
                    break
                at = child
            values = self.value[at] * self.weight
            raw = np.stack([values[:, self.model == m].sum(axis=1) for m in range(self.model.max() + 1)], axis=1)
            out[start : start + 1_000] = (1 / (1 + np.exp(-2 * raw))).mean(axis=1)
        return out


def _prepared_alike(models: Sequence[PipelineModel]) -> bool:
    uids = [[s.uid for s in m.stages[:-1]] for m in models]
    return all(u == uids[0] for u in uids) and all(isinstance(m.stages[-1], GBTClassificationModel) for m in models)


def score_bags(models: Sequence[PipelineModel], df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Mean probability over the bags.

    Bags that share their preparation are one forest: the features are
    assembled once and every batch of rows walks all trees at once.  Models
    of other kinds are scored one after the other in one pass.
    """
    if _prepared_alike(models):
        forest = Forest.of(models)

        @F.pandas_udf("double")
        def walk(x: pd.Series) -> pd.Series:
            return pd.Series(forest.mean_probability(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        features = PipelineModel(stages=models[0].stages[:-1]).transform(_as_read(models[0], df))
        kept = [F.col(f"`__keep_{c}`").alias(c) for c in df.columns if c != out]
        return features.select(*kept, walk(vector_to_array("features")).alias(out))
    scored, parts = df, []
    for i, model in enumerate(models):
        parts.append(f"__bag_{i}")
        scored = score(model, scored, parts[-1])
    total = F.lit(0.0)
    for p in parts:
        total = total + F.col(p)
    return scored.withColumn(out, total / len(parts)).drop(*parts)


def save_model(model: PipelineModel, folder: str, stage: str, name: str, settings: Mapping | None = None) -> str:
    """Store a model under ``folder/stage/name`` with a copy of its settings."""
    path = f"{folder}/{stage}/{name}"
    # The share table belongs to the model and moves with it.
    stages = [s.moved(f"{path}-shares") if isinstance(s, ShareModel) else s for s in model.stages]
    PipelineModel(stages=stages).write().overwrite().save(path)
    if settings is not None:
        spark = SparkSession.getActiveSession()
        text = spark.createDataFrame([(json.dumps(dict(settings), sort_keys=True),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}-settings")
    return path


def load_settings(folder: str, stage: str, name: str) -> dict:
    spark = SparkSession.getActiveSession()
    return json.loads(spark.read.text(f"{folder}/{stage}/{name}-settings", wholetext=True).first().value)


def load_model(folder: str, stage: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{stage}/{name}")
