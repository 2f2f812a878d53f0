"""Neighbour search in rounds, models without a vocabulary, exact draws, digests and buckets."""

import itertools
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from helpers import as_set
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tideline.operators import diff, encode, learn, linear, neighbours, resample, running, sampling
from tideline.operators.profile import long_values, name_at
from tideline.plans import train
from tideline.session import materialize
from tideline.sources import files

POINTS = "id long, v array<double>"


def nearest(data, asked, k, own):
    """Ids of the k nearest of every asked point, ties to the smaller id."""
    x, ids = np.array([v for _, v in data]), np.array([i for i, _ in data])
    out = {}
    for i, v in asked:
        far = np.sqrt(((x - np.array(v)) ** 2).sum(axis=1))
        order = [int(ids[j]) for j in np.lexsort((ids, far)) if not (own and ids[j] == i)]
        out[i] = order[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["id"], r["rank"])):
        out.setdefault(r["id"], []).append(r["neighbour"])
    return out


def clusters(n, seed, spread=0.05):
    """Points in small groups of about twenty, as many groups as n asks for."""
    draw = np.random.default_rng(seed)
    centres = draw.uniform(0, 100, (max(1, n // 20), 2))
    return [(i, [float(x) for x in centres[i % len(centres)] + spread * draw.normal(size=2)]) for i in range(n)]


# -- neighbours ------------------------------------------------------------------


def test_large_path_with_default_settings_is_exact(rows):
    draw = np.random.default_rng(1)
    data = [(i, [float(x) for x in draw.normal(size=3)]) for i in range(5000)]
    assert len(data) > 2 * neighbours.BLOCK_ROWS
    asked = data[::25]
    got = found(neighbours.nearest_neighbours(rows(data, POINTS), "id", "v", 3).where("id % 25 = 0"))
    assert got == nearest(data, asked, 3, True)
    other = [(10_000 + i, [float(x) for x in draw.normal(size=3)]) for i in range(40)]
    assert found(neighbours.nearest_neighbours(rows(data, POINTS), "id", "v", 4, rows(other, POINTS))) == nearest(data, other, 4, False)


@pytest.mark.parametrize("k, block_rows, pivots", [(1, 8, 3), (4, 16, 40), (30, 10, 7)])
def test_rings_and_rounds_of_any_size_are_exact(rows, k, block_rows, pivots):
    data = clusters(260, 2) + [(1000 + i, [50.0, 50.0]) for i in range(40)] + [(2000, [1e6, -1e6])]
    got = found(neighbours.nearest_neighbours(rows(data, POINTS), "id", "v", k, block_rows=block_rows, pivots=pivots))
    assert got == nearest(data, data, k, True)


def test_visits_of_round_two_grow_with_the_rows_only(rows):
    visits = {}
    for n in (1500, 6000):
        data = clusters(n, 3)
        base = materialize(neighbours._distinct_vectors(neighbours._rows(rows(data, POINTS), "id", "v", ()), 5), "vectors")
        _, rings = neighbours._rings(base, math.ceil(n / 100), 50, 0.0)
        points = neighbours.Points(np.array([v for _, v in data]), np.zeros((n, 0), dtype=np.int64))
        x = points.x
        kth = np.array([np.partition(((x - p) ** 2).sum(axis=1), 4)[4] ** 0.5 for p in x])
        row, _ = rings.visited(points, kth)
        visits[n] = len(row)
    assert visits[6000] < 6 * visits[1500]
    assert visits[6000] < 6000 * 10  # of about 120 rings


def test_mixed_rows_have_a_metric_of_their_own(rows):
    draw = random.Random(5)
    data = [(i, [draw.gauss(0, 1), draw.gauss(0, 1)], draw.choice("abc"), draw.choice(["x", None])) for i in range(150)]
    penalty = 0.7

    def far(a, b):
        return math.sqrt(math.dist(a[1], b[1]) ** 2 + penalty**2 * ((a[2] != b[2]) + (a[3] != b[3])))

    want = {a[0]: [b[0] for b in sorted((b for b in data if b is not a), key=lambda b: (far(a, b), b[0]))[:4]] for a in data}
    df = rows(data, POINTS + ", c string, d string")
    for search in ({}, {"block_rows": 16, "pivots": 6}):
        assert found(neighbours.nearest_neighbours(df, "id", "v", 4, categorical=["c", "d"], penalty=penalty, **search)) == want


def test_random_projections_find_most_and_crowded_buckets_are_whole(rows):
    data = clusters(900, 6)
    df = rows(data, POINTS)
    exact = neighbours.nearest_neighbours(df, "id", "v", 5)
    assert neighbours.recall(neighbours.lsh_neighbours(df, "id", "v", 5, tables=12, bits=5), exact).first()["recall"] >= 0.9
    # One bucket for half of all rows: every block of it meets every lot, so nothing is lost.
    whole = neighbours.lsh_neighbours(df, "id", "v", 5, tables=24, bits=1, block_rows=64)
    assert neighbours.recall(whole, exact).first()["recall"] >= 0.99
    copies = rows([(i, [1.0, 1.0]) for i in range(30)], POINTS)
    assert found(neighbours.lsh_neighbours(copies, "id", "v", 2, block_rows=4)) == nearest([(i, [1.0, 1.0]) for i in range(30)], [(i, [1.0, 1.0]) for i in range(30)], 2, True)
    asked = rows(data[:9], POINTS)
    assert set(found(neighbours.lsh_neighbours(df, "id", "v", 3, asked))) == set(range(9))
    assert neighbours.lsh_neighbours(df.limit(0), "id", "v", 3).count() == 0


def test_degree_of_unlabelled_rows(rows):
    known = rows([(i, [float(i // 10), 0.1 * (i % 10)], int(i >= 30)) for i in range(60)], POINTS + ", y int")
    new = rows([(100, [0.0, 0.5]), (101, [2.5, 0.5]), (102, [5.0, 0.5])], POINTS)
    got = {r["id"]: (r["positives"], r["degree"]) for r in neighbours.voted_degree(known, new, "id", "v", "y").collect()}
    assert got[100] == (0, 1.0) and got[102] == (5, 1.0) and got[101][1] in (0.6, 0.8)


# -- resampling -----------------------------------------------------------------


def test_a_row_that_gets_all_copies_is_dealt_out(spark, rows):
    copies = rows([(1, 200_000), (2, 0), (3, 7)], "id long, n long")
    # As on a table too large for partitions to be merged.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spread = resample._draws(copies).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in spread.groupBy("part").count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 200_007 and max(sizes) < 100_000 and len(sizes) >= 3
    for i, n in ((1, 200_000), (3, 7)):
        r = spread.where(F.col("id") == i).agg(F.min("draw"), F.max("draw"), F.count_distinct("draw"), F.count("draw")).first()
        assert tuple(r) == (1, n, n, n)


def _holed(spark):
    return spark.range(120).select(
        F.col("id").alias("k"), (F.col("id") % 6 == 0).cast("int").alias("y"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 13 + F.col("id") / 1000).alias("b"),
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("c"),
    )


@pytest.mark.parametrize("method", ["SMOTE", "ADASYN", "BorderlineSMOTE", "SMOTETomek", "SMOTENC"])
@pytest.mark.parametrize("text", [False, True])
def test_resamplers_keep_missing_values(spark, method, text):
    names = ["a", "b", "c"] if text else ["a", "b"]
    data = _holed(spark).select("k", "y", *names)
    if text and method != "SMOTENC":
        with pytest.raises(ValueError):
            train.resampled(data, method, "k", "y", names, 1)
        return
    out = train.resampled(data, method, "k", "y", names, 1)
    own = out.join(data.select("k"), "k", "left_semi")
    assert as_set(own.select("k", "y", *names)) <= as_set(data)
    if method != "SMOTETomek":
        assert own.count() == data.count() and own.where("a is null").count() == data.where("a is null").count()
    made = out.join(data.select("k"), "k", "left_anti")
    minority_holes = data.where("y = 1 and a is null").count()
    assert minority_holes > 0 and made.count() > 20
    if method in ("SMOTE", "SMOTENC"):  # every minority row is drawn from alike
        assert made.where("a is null").count() > 0
    assert made.where("b is null").count() == 0


def test_mixed_sampling_needs_a_number(rows):
    df = rows([(i, [], int(i < 3), "ab"[i % 2]) for i in range(20)], POINTS + ", y int, c string")
    with pytest.raises(ValueError):
        resample.smote_nc(df, "id", "v", "y", ["c"])


# -- draws -----------------------------------------------------------------------


@pytest.mark.parametrize("strategy, want", [
    ("not majority", {"a": 300, "b": 20, "c": 20}), ("majority", {"a": 20, "b": 50, "c": 20}),
    ("not minority", {"a": 20, "b": 20, "c": 20}), ("all", {"a": 20, "b": 20, "c": 20}),
])
def test_bags_have_exact_sizes(rows, monkeypatch, strategy, want):
    monkeypatch.setattr(sampling, "BAG_ROWS", 40)
    data = [(i, "a" if i < 300 else "b" if i < 350 else "c" if i < 370 else None) for i in range(380)]
    df = rows(data, "k long, y string")
    drawn = sampling.bootstrap(df, "k", 6, 3, "y", strategy)
    sizes = {(r["bag"], r["y"]): r["n"] for r in drawn.groupBy("bag", "y").agg(F.sum("weight").alias("n")).collect()}
    assert sizes == {(b, y): n for b in range(6) for y, n in want.items()}
    again = sampling.bootstrap(df.repartition(7), "k", 6, 3, "y", strategy)
    assert as_set(again.select("k", "bag", "weight")) == as_set(drawn.select("k", "bag", "weight"))
    with pytest.raises(ValueError):
        sampling.bag_sizes({1: 2}, "some")


def test_draws_are_split_in_proportion():
    random_ = np.random.default_rng(3)
    counts = np.array([5, 0, 10, 0, 0, 25, 1])
    total = np.zeros(7)
    for _ in range(400):
        dealt = sampling.split_draws(counts, 41, random_)
        assert dealt.sum() == 41 and (dealt[counts == 0] == 0).all()
        total += dealt
    assert np.abs(total / 400 - counts).max() < 0.6
    assert sampling.split_draws(np.array([3]), 9, random_).tolist() == [9]


# -- selection by counting -----------------------------------------------------------


def test_quantiles_by_counting(rows):
    draw = random.Random(9)
    groups = {
        "one": [3.5], "two": [1.0, 2.0], "tied": [1.0] * 500 + [2.0] * 3, "wide": [draw.lognormvariate(0, 9) * draw.choice([-1, 1]) for _ in range(4001)],
        "ends": [-math.inf, -1.0, 0.0, math.inf], "even": [float(i) for i in range(1000)],
    }
    probs = {"p0": 0.0, "p1": 0.01, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p999": 0.999, "p100": 1.0}
    df = rows([(g, v) for g, vs in groups.items() for v in vs] + [("one", None)], "g string, v double").repartition(5)
    out = running.exact_quantiles(df, "v", probs, ["g"])
    for r in out.collect():
        for name, p in probs.items():
            values = sorted(groups[r["g"]])
            place = (len(values) - 1) * p
            low, high = values[math.floor(place)], values[math.ceil(place)]
            want = low if low == high else low + (high - low) * (place - math.floor(place))
            assert r[name] == want or r[name] == pytest.approx(want, rel=1e-12) or (math.isnan(r[name]) and math.isnan(want)), (r["g"], name)
    plan = out._jdf.queryExecution().toString().lower()
    assert "rangepartitioning" not in plan
    whole = running.exact_quantiles(df.where("g = 'even'"), "v", {"m": 0.5}).first()
    assert whole["m"] == 499.5
    assert running.exact_quantiles(df.limit(0), "v", {"m": 0.5}).first()["m"] is None


# -- comparing tables --------------------------------------------------------------------


def test_digests_find_the_changed_buckets_only(spark, rows):
    left = spark.range(2000).select("id", (F.col("id") % 9).alias("a"), F.when(F.col("id") % 3 == 0, "x").alias("b"), F.lit(None).cast("string").alias("c"))
    same = left.repartition(5).sort(F.desc("id"))
    assert diff.differing_buckets(left, same, "id", ["a", "b", "c"]).count() == 0
    # A value that moves to another column beside nulls changes no plain hash of the row.
    right = left.select("id", "a", F.when(F.col("id") == 6, None).otherwise(F.col("b")).alias("b"), F.when(F.col("id") == 6, "x").alias("c"))
    assert diff.differing_buckets(left, right, "id", ["a", "b", "c"]).count() == 1
    got = {r["column"]: (r["compared"], r["different"], r["first_key"]) for r in diff.column_differences(left, right, "id").collect()}
    assert got == {"a": (2000, 0, None), "b": (2000, 1, 6), "c": (2000, 1, 6)}
    assert as_set(diff.cell_differences(left, right, "id")) == {(6, "b", "x", None), (6, "c", None, "x")}
    # Missing keys, repeated keys, and a key of another type.
    ragged = left.where("id <> 10").unionByName(left.where("id = 11")).withColumn("id", F.col("id").cast("int"))
    got = {r["column"]: (r["compared"], r["different"]) for r in diff.column_differences(left, ragged, "id").collect()}
    assert got == {"a": (1999, 0), "b": (1999, 0), "c": (1999, 0)}


def test_equal_tables_shuffle_no_wide_row(spark):
    left = spark.range(500).select("id", F.repeat(F.lit("w"), 50).alias("wide"))
    plan = diff.column_differences(left, left.repartition(3), "id")
    assert plan.first()["different"] == 0
    joined = [line for line in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "SortMergeJoin" in line or "BroadcastHashJoin" in line]
    assert joined  # what is joined are the rows of no bucket


# -- buckets ---------------------------------------------------------------------------------


def test_bucketed_stages_join_without_an_exchange(spark, tmp_path):
    a = spark.range(300).select(F.col("id").alias("deal"), (F.col("id") % 7).alias("x"))
    b = spark.range(900).select((F.col("id") % 300).alias("deal"), F.col("id").alias("call"))
    left = files.write_buckets(a, "stage_left", str(tmp_path / "left"), ["deal"], 4)
    right = files.write_buckets(b, "stage_right", str(tmp_path / "right"), ["deal"], 4)
    joined = left.hint("merge").join(right, "deal").groupBy("deal").agg(F.count("call").alias("n"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = left.hint("merge").join(right, "deal").groupBy("deal").agg(F.count("call").alias("n"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert as_set(joined) == {(i, 3) for i in range(300)}
    spark.sql("DROP TABLE stage_left")
    spark.sql("DROP TABLE stage_right")


# -- models without a vocabulary ----------------------------------------------------------------


@pytest.fixture(scope="module")
def texts(spark):
    return spark.range(400).select(
        "id", (F.col("id") % 4 == 0).cast("int").alias("y"), F.concat(F.lit("own"), "id").alias("own"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), (F.col("id") % 4).cast("string"))).alias("kind"), (F.col("id") % 17).cast("double").alias("x"),
        F.when(F.col("id") % 3 > 0, F.concat_ws(";", F.lit("p"), F.concat(F.lit("q"), (F.col("id") % 2).cast("string")))).alias("items"),
    ).cache()


def test_shares_of_categories(texts):
    shares = {(r["column"], r["value"]): r["share"] for r in encode.fit_shares(texts, ["kind", "own"], "y", 2.0).collect()}
    kinds = Counter((r["kind"] or "<NA>", r["y"]) for r in texts.collect())
    for kind in ("g0", "g1", "<NA>"):
        n = kinds[kind, 0] + kinds[kind, 1]
        assert shares["kind", kind] == pytest.approx((kinds[kind, 1] + 2 * 0.25) / (n + 2))
    assert shares["own", "own0"] == pytest.approx(1.5 / 3) and shares["own", "own1"] == pytest.approx(0.5 / 3)
    assert len(shares) == 400 + 5


def test_a_share_model_is_stored_with_its_table_and_takes_unseen_texts(spark, texts, tmp_path):
    model = learn.fit_boosted(texts, ["kind", "x"], "y", shared=["kind"], max_iter=3, max_depth=2)
    assert learn.model_features(model).shared == ["kind"] and not learn.model_features(model).text
    want = {r["id"]: r["probability_1"] for r in learn.score(model, texts).collect()}
    learn.save_model(model, str(tmp_path), "final_stage", "Model")
    stored = learn.load_model(str(tmp_path), "final_stage", "Model")
    assert {r["id"]: r["probability_1"] for r in learn.score(stored, texts).collect()} == pytest.approx(want)
    assert str(tmp_path) in stored.stages[0].getOrDefault("path")
    odd = texts.limit(5).withColumn("kind", F.lit("never seen"))
    assert learn.score(stored, odd).where("probability_1 between 0 and 1").count() == 5
    long = learn.contributions(model, texts, "id")
    raw = long.groupBy("id").agg((F.sum("contribution") + F.max("bias")).alias("raw")).collect()
    assert {r["id"]: 1 / (1 + math.exp(-2 * r["raw"])) for r in raw} == pytest.approx(want)


@pytest.mark.parametrize("text", ["share", "hash", "listed"])
def test_stage_models_read_texts_as_asked(texts, text):
    settings = train.TrainingSettings(text=text, tune=True, eliminate=True, min_features=1, folds=2, draws=None, grid={"max_depth": [1, 2]}, fixed={"max_iter": 2}, test_ratio=0.3)
    stage = train.fit_stage(texts, "id", "y", "init_stage", ["kind", "x"], settings)
    fs = learn.model_features(stage.models[0])
    assert {"share": fs.shared, "hash": fs.hashed, "listed": fs.text}[text] == ["kind"]
    assert stage.searched.count() == 4 and stage.rounds.count() >= 1
    with pytest.raises(ValueError):
        train.text_options(texts, ["kind"], train.TrainingSettings(text="letters"))


def test_neighbour_columns_and_bag_strategy_in_the_plan(spark, texts, tmp_path):
    settings = train.TrainingSettings(
        outlier_column=True, degree_column=True, bags=2, bag_strategy="not majority", tune=False, eliminate=False, fixed={"max_iter": 2, "max_depth": 2}
    )
    data = texts.select("id", "y", "x", "kind", (F.col("id") % 23).cast("double").alias("z"))
    stage = train.fit_stage(data, "id", "y", "mid_stage", ["x", "z", "kind"], settings)
    assert stage.features[-2:] == ["LOF", "Degree"] and len(stage.models) == 2
    train.save_stage(stage, data, str(tmp_path), settings, "id", "y")
    new = data.where("id % 9 = 0")
    got = {r["id"]: r["probabilities"] for r in train.predict(spark, new, str(tmp_path), "mid_stage", row="id").collect()}
    added = train.add_outlier_column(stage.outlier_rows, new, "id", "y", stage.outlier_numeric, settings)
    added = train.add_degree_column(stage.outlier_rows, added, "id", "y", stage.outlier_numeric)
    assert got == pytest.approx({r["id"]: r["probability_1"] for r in stage.score(added).collect()})


def test_the_forest_is_the_mean_of_its_models(texts):
    models = learn.fit_bags(texts, "id", ["x", "kind"], "y", 5, max_iter=3, max_depth=3)
    assert learn._prepared_alike(models) and len({id(m) for m in models}) == 5
    at_once = {r["id"]: r["probability_1"] for r in learn.score_bags(models, texts).collect()}
    apart = [{r["id"]: r["probability_1"] for r in learn.score(m, texts).collect()} for m in models]
    assert at_once == pytest.approx({i: sum(p[i] for p in apart) / 5 for i in at_once})
    mixed = [*models, learn.fit_boosted(texts, ["x"], "y", max_iter=1, max_depth=1)]
    assert not learn._prepared_alike(mixed) and learn.score_bags(mixed, texts).where("probability_1 between 0 and 1").count() == 400
    odd = texts.limit(3).withColumn("kind", F.lit("never seen"))
    assert learn.score_bags(models, odd).count() == 3


def test_sparse_vectors_hold_numbers_then_ones(spark, texts):
    vocabulary = encode.vocabularies(texts, ["own", "kind"]).unionByName(encode.list_vocabularies(texts, ["items"]))
    places = encode.fit_places(vocabulary)
    at = {(r["column"], r["value"]): r["place"] for r in places.collect()}
    data = texts.withColumn("x", F.when(F.col("id") > 2, F.col("x")))
    out = encode.sparse_vectors(data, "id", ["x"], places, ["own", "kind"], ["items"])
    for r in out.where("id < 12").collect():
        v = r["features"]
        assert v.size == 1 + len(at)
        ones = {at["own", r["own"]], at["kind", r["kind"] or "<NA>"]} | {at["items", i] for i in (r["items"] or "").split(";") if i}
        assert set(v.indices[v.values == 1.0]) - {0} >= {1 + p for p in ones}
        assert v[0] == (r["x"] or 0.0) and v.numNonzeros() <= len(ones) + 1
        assert list(v.indices) == sorted(v.indices)
    one = encode.sparse_vectors(texts.limit(1), "id", [], places.where("place = 0"), ["own"], out="v").first()["v"]
    assert one.size == 1
    model = learn.fit_sparse_logistic(out, "y")
    scored = learn.score_vectors(model, out)
    assert scored.columns == [*out.columns, "probability_1"] and abs(scored.agg(F.avg("probability_1")).first()[0] - 0.25) < 0.01


def test_coefficients_in_a_table_are_those_of_the_learner(spark):
    """A number, a category of some rows, one of two rows and one of every row's own, weighted; and a dense vector."""
    rng = random.Random(3)
    data = [(i, rng.random(), f"k{i % 5}", f"pair{i // 2}", f"own{i}", int(rng.random() < 0.2 + 0.1 * (i % 5)), 1.0 + i % 3) for i in range(300)]
    df = spark.createDataFrame(data, "id long, x double, kind string, pair string, own string, y int, w double")
    columns = ["kind", "pair", "own"]
    vectors = materialize(encode.sparse_vectors(df, "id", ["x"], encode.fit_places(encode.vocabularies(df, columns)), columns), "vectors")
    options = {"weight": "w", "regularization": 0.02, "max_iter": 200}
    there, here = learn.fit_sparse_logistic(vectors, "y", **options), learn.fit_sparse_logistic(vectors, "y", driver_places=10, **options)
    assert isinstance(here, linear.TableLogisticModel) and here.numFeatures == there.numFeatures and here.iterations < 60
    assert here.intercept == pytest.approx(there.intercept, abs=2e-3)
    table = {r["place"]: r["coefficient"] for r in here.coefficients.collect()}
    assert max(abs(table.get(i, 0.0) - c) for i, c in enumerate(there.coefficients.toArray())) < 2e-3
    scored = learn.score_vectors(here, vectors)
    assert scored.columns == [*vectors.columns, "probability_1"]
    expected = {r["id"]: r["probability_1"] for r in learn.score_vectors(there, vectors).collect()}
    assert {r["id"]: r["probability_1"] for r in scored.collect()} == pytest.approx(expected, abs=1e-3)
    dense = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    there, here = learn.fit_sparse_logistic(dense, "y"), learn.fit_sparse_logistic(dense, "y", driver_places=0)
    assert here.coefficients.first()["coefficient"] == pytest.approx(there.coefficients[0], abs=1e-3)
    one = learn.fit_sparse_logistic(vectors.where("y = 1"), "y", driver_places=10)
    assert learn.score_vectors(one, vectors).where("probability_1 = 1").count() == 300
    unknown = vectors.withColumn("y", F.when(F.col("id") > 1, F.col("y")))
    for places in (10, learn.DRIVER_PLACES):
        with pytest.raises(Exception, match="(?i)labels must"):
            learn.fit_sparse_logistic(unknown, "y", driver_places=places)


def test_a_query_travels_once_per_pack(rows, monkeypatch):
    """Rows without structure meet all others, but are not sent out once for every block."""
    rng = np.random.default_rng(5)
    df = rows([(i, [float(x) for x in rng.normal(size=12)]) for i in range(400)], POINTS)
    sent, group = [], type(df).groupBy

    def counted(frame, *by):
        if {"qid", "vec"} <= set(frame.columns) and len(by) > 1:
            sent.append(frame.count())
        return group(frame, *by)

    monkeypatch.setattr(type(df), "groupBy", counted)
    near = neighbours.nearest_neighbours(df, "id", "v", 3, block_rows=8, pivots=4)
    assert near.count() == 1200 and len(sent) == 2 and max(sent) <= 400 * 17


def test_rows_go_to_their_buckets_a_few_at_a_time(rows, monkeypatch):
    rng = np.random.default_rng(6)
    df = rows([(i, [float(x) for x in rng.normal(size=4)]) for i in range(1500)], POINTS).coalesce(1)
    send = type(df).mapInPandas

    def limited(frame, fn, schema):
        def run(batches):
            for out in fn(batches):
                assert len(out) <= 20_000
                yield out

        return send(frame, run, schema)

    monkeypatch.setattr(type(df), "mapInPandas", limited)
    assert neighbours.lsh_neighbours(df, "id", "v", 2, tables=64, bits=2).count() == 3000


def test_prefixes_of_words_do_not_meet(rows):
    """Categories that differ in case or blanks are different ones."""
    df = rows([(i, c, int(i % 2)) for i, c in enumerate(itertools.chain(["a", "A", " a", None]))], "id long, c string, y int")
    assert encode.fit_shares(df, ["c"], "y").count() == 4


def test_label_codes_do_not_carry_every_column_through_every_join(rows):
    """A wide row is copied whole by the joins of its codes, also where a column of it is not read later."""
    names = [f"t{i}" for i in range(5)]
    data = [(1, *["b"] * 5, 7), (1, *["b"] * 5, 7), (2, "a", None, "a", "c", "z", None), (None, *[None] * 5, 3)]
    df = rows(data, "id int, " + ", ".join(f"{n} string" for n in names) + ", other int")
    codes = materialize(encode.fit_codes(df.where("id = 1 or id is null"), names), "codes")
    out = encode.apply_codes(df.withColumns({f"c{i}": F.lit(i) + F.col("other") for i in range(12)}), codes, names, strict=False).drop("other")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("c0#") <= 4
    assert out.columns == ["id", *names, *[f"c{i}" for i in range(12)]]
    found = sorted([tuple(r) for r in out.select("id", *names, "c11").collect()], key=str)
    assert found == sorted([(1, 0, 0, 0, 0, 0, 18)] * 2 + [(2, *[None] * 5, None), (None, *[None] * 5, 14)], key=str)
    alone = encode.apply_codes(df.select("t0"), codes, ["t0"], strict=False)
    assert sorted([r[0] for r in alone.collect()], key=str) == [0, 0, None, None]


def test_quantiles_of_a_narrow_column_do_not_broadcast_its_rows(spark):
    """One column of a wide written table is joined with its few brackets, not sent out itself."""
    wide = spark.range(20_000).select("id", (F.col("id") % 100).cast("double").alias("x"), *[F.lit("a").alias(f"c{i}") for i in range(40)])
    long = long_values(materialize(wide, "wide"), ["x"], "double").select(name_at(["x"]), "value")
    out = running.exact_quantiles(long, "value", {"m": 0.5}, ["column"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan
    assert [tuple(r) for r in out.collect()] == [("x", 49.5)]


def test_candidates_are_found_in_single_precision_and_measured_exactly():
    """Rows whose distances differ by less than a float shows, far from the origin; a block needs half the memory of doubles."""
    rng = np.random.default_rng(8)
    x = 1e6 + rng.normal(size=(2048, 16))
    x[1000:1500] = x[:500] + 1e-9
    q = x[:1024] + 1e-5 * rng.normal(size=(1024, 16))
    none = np.zeros((2048, 0), dtype=np.int64)
    ids = rng.permutation(2048)
    data, asked = neighbours.Points(x, none), neighbours.Points(q, none[:1024])
    far = np.array([np.sqrt(((x - v) ** 2).sum(axis=1)) for v in q])
    order = np.array([np.lexsort((ids, row))[:5] for row in far])
    bound = np.take_along_axis(far, order, axis=1)[:, -1]
    for limit in (None, bound):
        qi, di, dist = neighbours._block_best(asked, data, ids, 5, 0.0, limit)
        assert (qi == np.repeat(np.arange(1024), 5)).all() and (di.reshape(-1, 5) == order).all()
        assert (dist == far[qi, di]).all()
    tracemalloc.start()
    neighbours._block_best(asked, data, ids, 5, 0.0, bound)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 << 20
