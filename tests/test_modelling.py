import math
import random

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tideline.operators import evaluate, learn
from tideline.plans import train
from tideline.sources.files import load_schema, save_schema

SCORES = [(1, 0.9, 1), (2, 0.8, 0), (3, 0.8, 1), (4, 0.3, 0), (5, 0.1, 0), (6, 0.3, 1)]


def test_confusion_and_rates(rows):
    df = rows(SCORES, "k long, p double, y int")
    r = evaluate.classification_metrics(df, "y", "p").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 1, 1, 2)
    assert r.precision == r.recall == r.f1 == pytest.approx(2 / 3) and r.roc_auc == pytest.approx(2 / 3)
    none = evaluate.classification_metrics(rows([(0.1, 1), (0.2, 0)], "p double, y int"), "y", "p").first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    edge = evaluate.classification_metrics(rows([(0.5, 1)], "p double, y int"), "y", "p").first()
    assert edge.tp == 1  # a half counts as positive


def test_auc_with_ties_one_class_and_constant_scores(rows):
    df = rows(SCORES, "k long, p double, y int")
    pairs = [(a, b) for _, a, y in SCORES if y for _, b, z in SCORES if not z]
    want = sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs)
    assert evaluate.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(want)
    assert evaluate.roc_auc(df.where("y = 1"), "y", "p").first().roc_auc is None
    assert evaluate.roc_auc(df.withColumn("p", F.lit(0.4)), "y", "p").first().roc_auc == 0.5


def test_curve_points_and_report(rows):
    df = rows(SCORES, "k long, p double, y int")
    points = {r.threshold: (r.tp, r.fp) for r in evaluate.curve_points(df, "y", "p").collect()}
    assert points == {0.9: (1, 0), 0.8: (2, 1), 0.3: (3, 2), 0.1: (3, 3)}
    called = df.withColumn("q", evaluate.hard_label(F.col("p")))
    report = {r["class"]: (r.precision, r.recall, r.support) for r in evaluate.class_report(called, "y", "q").collect()}
    assert report == {0: (2 / 3, 2 / 3, 3), 1: (2 / 3, 2 / 3, 3)}


def test_sweep_has_thirteen_steps_and_marks_the_best(rows):
    swept = evaluate.threshold_sweep(rows(SCORES, "k long, p double, y int"), "y", "p").collect()
    assert sorted(r.threshold for r in swept) == [i / 20 for i in range(4, 17)]
    best = [r for r in swept if r.best]
    assert len(best) == 1 and best[0].roc_auc == max(r.roc_auc for r in swept)
    assert best[0].threshold == min(r.threshold for r in swept if r.roc_auc == best[0].roc_auc)


def test_top_bottom(rows):
    rng = random.Random(2)
    data = [(i, round(rng.random(), 1), int(rng.random() < 0.3)) for i in range(100)]
    ranked = sorted(data, key=lambda r: (-r[1], r[0]))
    hits = [r[2] for r in ranked]
    r = evaluate.top_bottom(rows(data, "k long, p double, y int"), "y", "p", "k", top=10).first()
    assert (r.top_hits, r.bottom_hits, r.middle_hits) == (sum(hits[:10]), sum(hits[-20:]), sum(hits[10:90]))
    assert r.score == pytest.approx(0.7 * sum(hits[:10]) / 10 + 0.3 * (20 - sum(hits[-20:])) / 20, abs=1e-6)
    fifth = evaluate.top_bottom(rows(data, "k long, p double, y int"), "y", "p", "k", top=None, bottom=5).first()
    assert (fifth.top_rows, fifth.bottom_rows) == (20, 5)


def test_histogram_and_boxes(rows):
    df = rows([("a", 0.0, 1), ("a", 1.0, 1), ("a", 0.5, 0), ("b", 0.25, 0)], "m string, p double, y int")
    bins = {(r.y, r.bin): r.n for r in evaluate.score_histogram(df, "y", "p", 4).collect()}
    assert bins == {(1, 0): 1, (1, 3): 1, (0, 2): 1, (0, 1): 1}
    boxes = {r.m: (r.minimum, r.median, r.maximum) for r in evaluate.score_boxes(df, "m", "p").collect()}
    assert boxes == {"a": (0.0, 0.5, 1.0), "b": (0.25, 0.25, 0.25)}


def test_contribution_tables(rows):
    long = rows([(1, "a_x", 0.2), (1, "a_y", -0.1), (1, "b", 0.4), (2, "a_x", 0.0), (2, "a_y", 0.3), (2, "b", -0.4)], "row long, feature string, contribution double")
    outcomes = rows([(1, 1, 0.5), (2, 0, -0.1)], "row long, y int, p double")
    got = {r.feature: (r.prediction_contribution, r.error_contribution) for r in evaluate.prediction_and_error(long, outcomes, "row", "y", "p").collect()}
    assert got["b"] == pytest.approx((0.4, ((0.5 - 0.9) + (0.1 - 0.3)) / 2))
    rolled = {(r.row, r.feature): r.contribution for r in evaluate.roll_up(long, "row", ["a"]).collect()}
    assert rolled == pytest.approx({(1, "a"): 0.1, (1, "b"): 0.4, (2, "a"): 0.3, (2, "b"): -0.4})
    classes = rows([("a_x", "one"), ("a_y", "one"), ("b", None)], "column string, class string")
    assert {(r.row, r["class"]): round(r.contribution, 6) for r in evaluate.roll_up_classes(long, "row", classes).collect()} == {(1, "one"): 0.1, (2, "one"): 0.3}
    splits = rows([("b", 2.0, 10.0), ("b", 4.0, 20.0)], "feature string, gain double, cover double")
    table = {r.feature: (r.weight, r.gain, r.cover) for r in evaluate.importance_table(long, splits).collect()}
    assert table == {"a_x": (0, 0.0, 0.0), "a_y": (0, 0.0, 0.0), "b": (2, 3.0, 15.0)}
    values = evaluate.contribution_values(long, rows([(1, "v")], "row long, b string"), "row", ["b"])
    assert as_set(values.select("row", "feature", "value", "contribution")) == {(1, "b", "v", 0.4)}


# -- learning ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    data = []
    for i in range(600):
        x, z, c = rng.random(), rng.random(), rng.choice("abc")
        y = int(x + (0.3 if c == "a" else 0.0) + rng.gauss(0, 0.1) > 0.8)
        data.append((i, x, z, None if rng.random() < 0.1 else c, None if rng.random() < 0.1 else 1.0, y))
    return spark.createDataFrame(data, "id long, x double, z double, c string, one double, y int").cache()


NAMES = ["x", "z", "c", "one"]


@pytest.fixture(scope="module")
def model(table):
    return learn.fit_boosted(table, NAMES, "y", max_iter=4, max_depth=3)


def test_scores_and_contributions_agree(table, model):
    scored = learn.score(model, table)
    assert scored.columns == [*table.columns, "probability_1"]
    assert evaluate.roc_auc(scored, "y", "probability_1").first().roc_auc > 0.9
    long = learn.contributions(model, table, "id")
    raw = long.groupBy("id").agg((F.sum("contribution") + F.max("bias")).alias("raw"))
    for r in scored.join(raw, "id").collect():
        assert r.probability_1 == pytest.approx(1 / (1 + math.exp(-2 * r.raw)), abs=1e-9)
    ranked = sorted(learn.importances(long).collect(), key=lambda r: -r.importance)
    assert ranked[0].feature == "x"


def test_an_unseen_category_is_scored(table, model):
    odd = table.limit(3).withColumn("c", F.lit("never seen"))
    assert learn.score(model, odd).count() == 3


def test_batch_scoring_from_store(spark, table, model, tmp_path):
    learn.save_model(model, str(tmp_path), "init_stage", "Model", {"a": 1})
    save_schema(table, str(tmp_path / "features"), NAMES)
    stored = learn.load_model(str(tmp_path), "init_stage", "Model")
    schema = load_schema(spark, str(tmp_path / "features"))
    path = str(tmp_path / "out")
    batch = learn.score_batch(stored, table.drop("one").withColumn("x", F.col("x").cast("string")), schema, "id", path)
    assert batch.columns == ["id", "probabilities"] and batch.count() == 600
    assert spark.read.option("header", True).csv(path).count() == 600
    with pytest.raises(Exception):
        learn.load_model(str(tmp_path), "init_stage", "Other")


def test_elimination_keeps_the_signal(table):
    fit, hold = table.where("id % 5 <> 0"), table.where("id % 5 = 0")
    kept, rounds = learn.eliminate_features(fit, hold, "id", NAMES, "y", min_features=1, max_iter=3, max_depth=2)
    assert "x" in kept and rounds.count() >= 2
    counts = [r.n_features for r in rounds.orderBy("round").collect()]
    assert counts == sorted(counts, reverse=True)


def test_search_adds_the_class_ratio(table):
    grid = {"max_depth": [2], "max_iter": [2], "positive_weight": [1.0]}
    best, results = learn.search(table, "id", NAMES, "y", grid, folds=2, draws=None)
    assert results.count() == 4 and best["positive_weight"] in (1.0, learn.evaluate_ratio(table, "y"))
    assert learn.candidates({"a": [1, 2], "b": [3, 4]}, 3, 1) == learn.candidates({"a": [1, 2], "b": [3, 4]}, 3, 1)


def test_bags_and_logistic(table):
    bags = learn.fit_bags(table, "id", NAMES, "y", 2, max_iter=2, max_depth=2)
    scored = learn.score_bags(bags, table)
    assert scored.columns[-1] == "probability_1" and scored.where("probability_1 between 0 and 1").count() == 600
    fit, hold = table.where("id % 5 <> 0"), table.where("id % 5 = 0")
    _, areas = learn.fit_logistic(fit.fillna(0), hold.fillna(0), ["x", "z"], "y")
    assert {r.part: r.roc_auc > 0.8 for r in areas.collect()} == {"train": True, "test": True}


def test_stage_training_with_options(spark, table, tmp_path):
    settings = train.TrainingSettings(
        outlier_column=True, sampling="RandomUnderSampler", tune=False, eliminate=False, bags=2, fixed={"max_iter": 2, "max_depth": 2}
    )
    stage = train.fit_stage(table.select("id", "y", "x", "z", "c"), "id", "y", "init_stage", ["x", "z", "c"], settings)
    assert stage.features[-1] == "LOF" and len(stage.models) == 2
    new = table.select("id", "y", "x", "z", "c").where("id % 7 = 0")
    train.save_stage(stage, table, str(tmp_path), settings, "id", "y")
    again = train.predict(spark, new, str(tmp_path), "init_stage", row="id")
    scored = train.add_outlier_column(stage.outlier_rows, new, "id", "y", stage.outlier_numeric, settings)
    expected = {r.id: r.probability_1 for r in stage.score(scored).collect()}
    assert {r.id: r.probabilities for r in again.collect()} == pytest.approx(expected)
    plain = train.TrainingSettings(tune=False, eliminate=False, fixed={"max_iter": 2, "max_depth": 2})
    simple = train.fit_stage(table, "id", "y", "init_stage", ["x", "z"], plain)
    train.save_stage(simple, table, str(tmp_path / "plain"), plain, "id", "y")
    got = train.predict(spark, table, str(tmp_path / "plain"), "init_stage", row="id")
    want = {r.id: r.probability_1 for r in simple.score(table).collect()}
    assert {r.id: r.probabilities for r in got.collect()} == pytest.approx(want)


@pytest.mark.parametrize("method", ["SMOTE", "SMOTENC", "NearMiss", "RandomOverSampler"])
def test_training_rows_after_resampling(table, method):
    names = ["x", "z", "c"] if method == "SMOTENC" else ["x", "z"]
    out = train.resampled(table.select("id", "y", *names), method, "id", "y", names, 1)
    assert set(out.columns) == {"id", "y", *names}
    sizes = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert sizes[0] == sizes[1]
