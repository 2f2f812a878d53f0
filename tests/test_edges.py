"""Missing values, many categories, large counts, rare classes and keys of synthetic rows."""

import pytest
from helpers import as_dicts, as_set
from pyspark.sql import functions as F

from tideline.operators import columns, encode, joins, learn, ranking, sampling, snapshots, stats
from tideline.plans import train
from tideline.sources import tables


def test_rows_without_a_score_rank_last(rows):
    df = rows([(1, None), (2, 5.0), (3, 9.0), (4, None), (5, 5.0)], "k long, p double")
    assert as_set(ranking.rank_by_score(df, "p", ["k"]).select("k", "position")) == {(3, 1), (2, 2), (5, 3), (1, 4), (4, 5)}


def test_chi_square_of_counts_beyond_a_long_square(rows):
    big = 5_000_000_000
    counts = [("c", "a", 0, big), ("c", "a", 1, big), ("c", "b", 0, big), ("c", "b", 1, 2 * big), ("c", "d", 0, big), ("c", "d", 1, big)]
    got = as_dicts(stats.chi_square_of_counts(rows(counts, "column string, value string, y int, n long"), "y"))[0]
    small = [(c, v, y, n // 1_000_000_000) for c, v, y, n in counts]
    want = as_dicts(stats.chi_square_of_counts(rows(small, "column string, value string, y int, n long"), "y"))[0]
    assert got["chi_square"] == pytest.approx(want["chi_square"] * 1_000_000_000)
    assert got["dof"] == 2 and got["n_used"] == 7 * big and got["p_value"] == 0.0


@pytest.mark.parametrize("keys", [[1, 2], list(range(1, 1501)), []])
def test_key_lists_of_any_length_filter_alike(spark, keys):
    df = spark.range(3000).select(F.col("id").cast("double").alias("k"))
    got = {int(r["k"]) for r in tables.key_filter(df, "k", keys).collect()}
    assert got == set(keys)
    if keys:
        table = spark.createDataFrame([(k,) for k in keys], "k long")
        assert got == {int(r["k"]) for r in tables.key_filter(df, "k", table).collect()}


def test_stage_lookup_of_any_size(spark):
    stages = spark.range(12_000).select(
        F.concat(F.lit("s-"), "id").alias("stage_id"), F.lit("Closed Won").alias("stage_name"), F.lit("Learn").alias("pipeline_label")
    )
    df = spark.createDataFrame([("2024-01-01",)], "hs_date_entered_s_11999 string").withColumn(
        "hs_date_entered_s_11999", F.col("hs_date_entered_s_11999").cast("timestamp")
    )
    out = columns.merge_stage_columns(df, stages)
    assert out.select(F.to_date("closed_won_entered").cast("string")).first()[0] == "2024-01-01"


def test_any_row_per_key_is_the_same_every_time(spark):
    df = spark.createDataFrame([(i % 5, i, f"v{i % 3}") for i in range(200)], "k int, a int, b string")
    want = as_set(snapshots.any_per_key(df, ["k"]))
    assert want == {(k, 195 + k, f"v{(195 + k) % 3}") for k in range(5)}
    assert as_set(snapshots.any_per_key(df.repartition(7, "b"), ["k"])) == want


def test_sampling_keeps_every_class(spark):
    df = spark.createDataFrame([(i, 0 if i < 100 else 1 if i < 120 else 2 if i < 130 else None) for i in range(135)], "k long, y int")
    under = sampling.under_sample(df, "k", "y", 0.5)
    assert {r["y"]: r["count"] for r in under.groupBy("y").count().collect()} == {0: 20, 1: 20, 2: 10, None: 5}
    over = sampling.over_sample(df, "k", "y")
    assert {r["y"]: r["count"] for r in over.groupBy("y").count().collect()} == {0: 100, 1: 20, 2: 100, None: 5}
    copies = over.where("y = 2").groupBy("k").agg(F.collect_set("copy").alias("c")).collect()
    assert {tuple(sorted(r["c"])) for r in copies} == {tuple(range(1, 11))}
    small = df.where("k % 10 = 0")
    picked = sampling.balanced_subset(small, df, "k", "y")
    assert {r["y"]: r["count"] for r in picked.groupBy("y").count().collect()} == {0: 10, 1: 2, 2: 1}


@pytest.mark.parametrize("mean", [0.0, 0.3, 1.0, 8.0])
def test_poisson_draws_have_their_mean(spark, mean):
    n = 20_000
    df = spark.range(n).select(sampling.poisson_draw((F.col("id") + 0.5) / n, mean).alias("d"))
    row = df.agg(F.avg("d").alias("m"), F.var_pop("d").alias("v"), F.max("d").alias("top")).first()
    assert row["m"] == pytest.approx(mean, abs=0.01) and row["v"] == pytest.approx(mean, rel=0.02, abs=0.01)
    with pytest.raises(ValueError):
        sampling.poisson_draw(F.col("id"), 101)


def test_row_differences_count_repeats(rows):
    left, right = rows([(1, "a"), (1, "a"), (2, None)], "k int, v string"), rows([("a", 1), (None, 2), ("z", 3)], "v string, k int")
    assert as_set(joins.row_differences(left, right)) == {(1, "a", "left"), (3, "z", "right")}


def test_many_categories_are_encoded_and_trained_on(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("c"), "id").alias("c"), (F.col("id") % 2).cast("int").alias("y"), F.rand(1).alias("x"))
    fitted = encode.fit_one_hot(df.limit(20_000), ["c"])
    assert len(fitted["c"]) == 20_000
    places = encode.fit_places(encode.vocabularies(df, ["c"]))
    out = encode.encode_sparse(df, "id", places, ["c"])
    assert out.select(F.get("encoded", F.lit(0))).distinct().count() == 20_000
    model = learn.fit_boosted(df, ["c", "x"], "y", hashed=["c"], max_iter=1, max_depth=2)
    assert learn.model_features(model).hashed == ["c"]
    assert learn.score(model, df).where("probability_1 between 0 and 1").count() == 20_000


def test_sparse_places_of_unknown_missing_and_listed_values(rows):
    fit = rows([(1, "a", "x;y"), (2, None, None)], "k long, c string, l string")
    vocabulary = encode.vocabularies(fit, ["c"]).unionByName(encode.list_vocabularies(fit, ["l"]))
    places = encode.fit_places(vocabulary)
    assert as_set(places) == {("c", "<NA>", 0), ("c", "a", 1), ("l", "x", 2), ("l", "y", 3)}
    new = rows([(5, "a", "y;x;q"), (6, None, None), (7, "other", "")], "k long, c string, l string")
    got = {r["k"]: r["encoded"] for r in encode.encode_sparse(new, "k", places, ["c"], ["l"]).collect()}
    assert got == {5: [1, 2, 3], 6: [0], 7: []}


def test_logistic_regression_with_holes(spark):
    df = spark.range(4000).select(
        "id", (F.col("id") % 100 / 100.0).alias("x"), F.when(F.col("id") % 10 > 0, F.col("id") % 100 / 100.0).alias("holed"), F.lit(None).cast("double").alias("none")
    ).withColumn("y", (F.col("x") + (F.rand(3) - 0.5) * 0.4 > 0.5).cast("int"))
    _, whole = learn.fit_logistic(df, df, ["x"], "y")
    model, areas = learn.fit_logistic(df, df, ["holed", "none"], "y")
    assert whole.first()["roc_auc"] > 0.95
    assert areas.first()["roc_auc"] > 0.88
    coefficients = dict(zip(["holed", "known"], model.stages[-1].coefficients))
    assert coefficients["holed"] > 3
    assert learn.score(model, df).where("probability_1 is null").count() == 0


def _training_rows(spark):
    return spark.range(120).select(
        F.col("id").alias("k"), (F.col("id") % 6 == 0).cast("int").alias("y"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 13).cast("double").alias("b"),
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("c"),
    )


@pytest.mark.parametrize("method", ["TomekLinks", "AllKNN", "NeighbourhoodCleaningRule", "OneSidedSelection", "NearMiss"])
def test_row_choosing_methods_return_rows_as_they_were(spark, method):
    rows = _training_rows(spark)
    kept = train.resampled(rows, method, "k", "y", ["a", "b", "c"], 1)
    assert kept.columns == rows.columns
    assert as_set(kept) <= as_set(rows)
    assert kept.where("a is null").count() > 0


@pytest.mark.parametrize("method, features", [("SMOTE", ["a", "b"]), ("SMOTENC", ["a", "b", "c"])])
def test_synthetic_rows_have_keys_of_their_own(spark, method, features):
    rows = _training_rows(spark)
    made = train.resampled(rows, method, "k", "y", features, 1)
    assert made.count() == 200
    assert made.select("k").distinct().count() == 200 and made.where("k is null").count() == 0


def test_career_popularity_is_that_of_the_fitted_rows(rows):
    schema = (
        "current_company_industry string, feat_final_education_field string, previous_position string, "
        "feat_final_current_job string, current_company_size int, target int"
    )
    fit = rows([(" IT ", "Law", "a", "b", 5, 1), ("it", "Art", "a", "a", 5, 0), ("Media", "Law", None, "b", 5, 1)], schema)
    texts = ["current_company_industry", "feat_final_education_field", "previous_position", "feat_final_current_job"]
    fitted = encode.fit_career(fit, texts)
    new = rows([("IT", "law", "x", "x", 5, -1), ("Unseen", None, "x", "y", 5, -1)], schema)
    got = {r["current_company_industry"]: r for r in encode.apply_career(new, texts, fitted).collect()}
    assert got["it"]["industry_popularity"] == 0.5 and got["it"]["industry_popularity_all"] == pytest.approx(2 / 3)
    assert got["it"]["field_of_study_popularity"] == 1.0 and got["unseen"]["industry_popularity"] is None
