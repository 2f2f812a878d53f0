import datetime as dt
import random
import statistics

import pytest
from helpers import as_dicts, as_set
from pyspark.sql import functions as F

from tideline.operators import encode, profile, running, sampling, stats


def test_running_totals_over_ties_groups_and_skew(rows):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.7 else rng.choice("abc"), i, rng.randrange(10)) for i in range(500)]
    out = running.running_totals(rows(data, "g string, i long, v int"), ["i"], {"upto": "v"}, ["g"]).collect()
    assert len(out) == 500
    for r in out:
        assert r.upto == sum(v for g, i, v in data if g == r.g and i <= r.i)


def test_row_numbers_are_dense(rows):
    out = running.row_numbers(rows([(x % 3, x) for x in range(100)], "a int, b int"), ["a", "b"], "n").collect()
    ordered = sorted(out, key=lambda r: r.n)
    assert [r.n for r in ordered] == list(range(1, 101))
    assert [(r.a, r.b) for r in ordered] == sorted((x % 3, x) for x in range(100))


def test_exact_quantiles(rows):
    data = [("a", float(v)) for v in [5, 1, 1, 1, 9, 2]] + [("b", 7.0), ("c", None)]
    out = running.exact_quantiles(rows(data, "g string, v double"), "v", {"q": 0.5, "lo": 0.0, "hi": 1.0, "p": 0.9}, ["g"])
    assert {tuple(r) for r in out.collect()} == {("a", 1.5, 1.0, 9.0, 7.0), ("b", 7.0, 7.0, 7.0, 7.0)}


# -- encoders -------------------------------------------------------------------------


def test_fill_is_fitted_once_and_adds_missing_columns(rows):
    train = rows([(1.0, "x"), (3.0, None), (None, "y"), (5.0, "y")], "n double, s string")
    fitted = encode.fit_fill(train, {"n": encode.MEDIAN, "s": "none", "late": 0})
    assert fitted == {"n": 3.0, "s": "none", "late": 0}
    other = encode.apply_fill(rows([(None, None), (100.0, "z")], "n double, s string"), fitted)
    assert as_set(other) == {(3.0, "none", 0), (100.0, "z", 0)}
    empty = encode.fit_fill(rows([(None,)], "n double"), {"n": encode.MEDIAN})
    assert empty == {"n": None} and as_set(encode.apply_fill(rows([(None,)], "n double"), empty)) == {(None,)}


def test_range_scaling(rows):
    fitted = encode.fit_range(rows([(0.0, 4.0), (10.0, 4.0)], "a double, b double"), ["a", "b"])
    assert as_set(encode.apply_range(rows([(5.0, 4.0), (20.0, 9.0), (None, None)], "a double, b double"), fitted)) == {
        (0.5, 0.0), (2.0, 0.0), (None, None),
    }


def test_one_hot_null_category_and_unseen(rows):
    fitted = encode.fit_one_hot(rows([("b",), ("a",), (None,), ("[x]",)], "c string"), ["c"])
    assert fitted == {"c": ["<NA>", "[x]", "a", "b"]}
    out = encode.apply_one_hot(rows([("a",), (None,), ("new",)], "c string"), fitted)
    assert out.columns == ["c__NA>", "c__x_", "c_a", "c_b"]
    assert [tuple(r) for r in out.collect()] == [(0, 0, 1, 0), (1, 0, 0, 0), (0, 0, 0, 0)]
    with pytest.raises(encode.VocabularyTooLarge):
        encode.fit_one_hot(rows([(str(i),) for i in range(5)], "c string"), ["c"], cap=4)


def test_multi_hot(rows):
    train = rows([("a;b (add notes)",), ("b (add notes);",), (None,)], "c string")
    fitted = encode.fit_multi_hot(train, ["c"])
    assert fitted == {"c": ["", "a", "b (add notes)"]}
    out = encode.apply_multi_hot(rows([("a",), ("ab",), (None,), ("b (add notes);a",)], "c string"), fitted)
    assert out.columns == ["c_", "c_a", "c_b"]
    assert [tuple(r) for r in out.collect()] == [(0, 1, 0), (0, 0, 0), (1, 0, 0), (0, 1, 1)]


def test_label_codes_unseen_is_an_error(rows):
    codes = encode.fit_codes(rows([("b", "x"), ("a", "x"), (None, "y")], "c string, d string"), ["c", "d"])
    out = encode.apply_codes(rows([("a", "y"), (None, "x")], "c string, d string"), codes, ["c", "d"])
    assert as_set(out) == {(0, 1), (None, 0)}
    unseen = rows([("z", "x")], "c string, d string")
    with pytest.raises(Exception, match="unseen category"):
        encode.apply_codes(unseen, codes, ["c", "d"]).collect()
    assert as_set(encode.apply_codes(unseen, codes, ["c", "d"], strict=False)) == {(None, 0)}


def test_enrich_pairs(rows):
    df = rows([("e", "a"), ("e", None), (None, None)], "enr string, act string")
    out = encode.enrich_pairs(df, [("enr", "act")])
    assert as_dicts(out) == [
        {"feat_init_act": "e", "feat_final_act": "a", "enr_boolean": True},
        {"feat_init_act": "e", "feat_final_act": "e", "enr_boolean": True},
        {"feat_init_act": None, "feat_final_act": None, "enr_boolean": False},
    ]


def test_recency_uses_each_rows_own_anchor(rows):
    day = dt.datetime(2024, 6, 1)
    df = rows([(day, day - dt.timedelta(days=3), None), (day - dt.timedelta(days=100), None, day)], "at timestamp, a timestamp, b timestamp")
    out = encode.recency_scores(df, ["a", "b"], "at").collect()
    assert [(r.time_since_a, r.time_since_b, r.average_recency_score) for r in out] == [(5, None, 5), (None, 0, 0)]


def test_country_and_synonyms_and_state(rows):
    countries = rows([("IT", "Italy"), ("FR", "France")], "code string, name string")
    df = rows([("IT",), ("XX",), (None,)], "country_code string")
    assert [r.country_name for r in encode.country_name(df, countries).collect()] == ["italy", "unknown", None]
    table = rows([(1, "Seller", "account manager"), (0, "Developer", "coder"), (2, "Sales", "account manager")], "p int, g string, s string")
    jobs = rows([(" Account Manager ",), ("coder",), ("poet",), (None,)], "j string")
    assert [r.g for r in encode.group_synonyms(jobs, "j", table, "g").collect()] == ["Seller", "Developer", None, None]
    states = rows([("Hot Lead",), ("New",), (None,)], "s string")
    assert [r[0] for r in states.select(encode.deal_state(F.col("s"))).collect()] == ["2", "New", "<NA>"]


def test_combined_profile(rows):
    out = encode.combined_profile(rows([(1.0, 2.0), (1.0, None)], "professional_profile double, personal_profile double"))
    assert as_set(out) == {(3.0, True), (0.0, False)}


# -- profile ------------------------------------------------------------------------------


def test_profile(rows):
    df = rows([(2, "b", None), (10, "a", None), (10, "a", None), (2, "b", None)], "n int, s string, e double")
    out = {r["column"]: r for r in profile.profile(df, one_hot=["s"], extended=True).collect()}
    assert (out["n"].distinct, out["n"].most_popular, out["n"]["mean"], out["n"]["max"]) == (2, "2", 6.0, 10.0)
    assert (out["s"].feature_class, out["s"].most_popular, out["s"]["mean"]) == ("categorical(onehot)", "a", None)
    assert (out["e"].missing, out["e"].missing_share, out["e"].distinct, out["e"].most_popular) == (4, 1.0, 0, None)
    odd = profile.profile(rows([(1, 2)], "`it's` int, `a.b` int"))
    assert {r["column"] for r in odd.collect()} == {"it's", "a.b"}


def test_plain_profile_reads_its_table_once(rows):
    df = rows([(1, "a"), (None, "b"), (1, None)], "n int, s string").repartition(3)
    out = profile.profile(df)
    assert out._jdf.queryExecution().executedPlan().toString().count("RoundRobinPartitioning") == 1
    assert {(r["column"], r["missing"], r["missing_share"], r["count"], r["distinct"]) for r in out.collect()} == {("n", 1, 0.33, 2, 1), ("s", 1, 0.33, 2, 2)}
    empty = profile.profile(df.where("n > 1")).collect()
    assert {(r["column"], r["missing"], r["missing_share"], r["count"], r["distinct"]) for r in empty} == {("n", 0, None, 0, 0), ("s", 0, None, 0, 0)}


def test_first_profile_has_no_previous(rows):
    new = profile.profile(rows([(1,)], "a int"))
    merged = profile.merge_profiles(new, None)
    assert merged.columns[-3:] == ["stage", "class", "In use"] and merged.count() == 1


def test_new_statistics_win_and_annotations_stay(rows):
    old = profile.profile(rows([(1, 1)], "a int, gone int")).withColumns({"stage": F.lit(2), "In use": F.lit(True)})
    new = profile.profile(rows([(1, "x"), (None, "y")], "a int, fresh string"))
    merged = {r["column"]: r for r in profile.merge_profiles(new, old).collect()}
    assert merged["a"].missing == 1 and merged["a"].stage == 2 and merged["a"]["In use"] is True
    assert merged["gone"]["count"] == 1 and merged["fresh"].stage is None
    assert as_set(profile.profile_sides(new, old)) == {("gone", "old"), ("fresh", "new")}


def test_inheritance_only_if_the_family_agrees(rows):
    data = [("a_1", "1"), ("a_2", None), ("a", "1"), ("b_1", "1"), ("b_2", "2"), ("b_3", None), ("c", None)]
    out = profile.inherit_annotations(rows(data, "column string, stage string"), ["a", "b", "c"], ["stage"])
    got = {r["column"]: r.stage for r in out.collect()}
    assert got == {"a_1": "1", "a_2": "1", "a": "1", "b_1": "1", "b_2": "2", "b_3": None, "c": None}
    nested = rows([("ab_1", "1"), ("ab_2", None), ("a_1", None)], "column string, stage string")
    got = {r["column"]: r.stage for r in profile.inherit_annotations(nested, ["a", "ab"], ["stage"]).collect()}
    assert got == {"ab_1": "1", "ab_2": "1", "a_1": "1"}
    blanks = profile.empty_annotations(rows([("x", None), ("y", "1")], "column string, stage string"), ["stage"])
    assert as_set(blanks) == {("x", "stage")}


def test_stage_features(rows):
    data = [("a", "1", "int", True), ("feat_init_b", "1", "int", True), ("c", "3", "int", True), ("d", "0", "int", True), ("e", "1", "timestamp", True), ("f", "1", "int", None)]
    table = rows(data, "column string, stage string, type string, `In use` boolean")
    names = {s: {r["column"] for r in profile.stage_features(table, s).collect()} for s in profile.STAGE_LIMITS}
    assert names == {"init_stage": {"a", "feat_init_b"}, "mid_stage": {"a", "feat_init_b"}, "final_stage": {"a", "c"}}
    with pytest.raises(ValueError):
        profile.stage_features(table, "other")


def test_categorical_positions(rows):
    df = rows([(1, "x", "y", dt.datetime(2024, 1, 1))], "n int, s string, h string, t timestamp")
    assert profile.categorical_positions(df.schema, one_hot=["h"]) == [1]


# -- tests ---------------------------------------------------------------------------------


def test_chi_square_with_and_without_correction(rows):
    table = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 15
    got = stats.chi_square(rows(table, "c string, y int"), "y").first()
    # 2 x 2 with Yates: N (|ad - bc| - N/2)^2 / (row and column totals)
    want = 75 * (abs(10 * 15 - 20 * 30) - 37.5) ** 2 / (30 * 45 * 40 * 35)
    assert got.chi_square == pytest.approx(want) and got.dof == 1 and 0 < got.p_value < 0.05
    three = [("a", 0)] * 5 + [("b", 1)] * 5 + [("c", 0)] * 5 + [("c", 1)] * 5 + [(None, 1)]
    got = stats.chi_square(rows(three, "c string, y int"), "y").first()
    assert got.chi_square == pytest.approx(10.0) and got.dof == 2 and got.n_used == 20
    single = stats.chi_square(rows([("a", 0), ("a", 1)], "c string, y int"), "y").first()
    assert (single.chi_square, single.dof, single.p_value) == (0.0, 0, 1.0)


def test_t_test_and_small_groups(rows):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 9.0, 9.0]
    df = rows([(v, 0) for v in a] + [(v, 1) for v in b] + [(None, 1)], "x double, y int")
    got = stats.t_test(df, "y").first()
    pooled = (3 * statistics.variance(a) + 4 * statistics.variance(b)) / 7
    want = (statistics.mean(a) - statistics.mean(b)) / (pooled * (1 / 4 + 1 / 5)) ** 0.5
    assert got.t_statistic == pytest.approx(want) and got.n_used == 9
    lone = stats.t_test(rows([(1.0, 0), (2.0, 1), (3.0, 1)], "x double, y int"), "y").first()
    assert (lone.t_statistic, lone.p_value) == (0.0, 0.0)


def test_ks_and_levene(rows):
    rng = random.Random(3)
    a, b = [rng.randrange(20) / 1.0 for _ in range(60)], [rng.randrange(30) / 1.0 for _ in range(80)]
    df = rows([(v, 0) for v in a] + [(v, 1) for v in b], "x double, y int")
    gap = max(abs(sum(v <= t for v in a) / 60 - sum(v <= t for v in b) / 80) for t in a + b)
    assert stats.ks_test(df, "y").first().ks_statistic == pytest.approx(gap)
    za = [abs(v - statistics.median(a)) for v in a]
    zb = [abs(v - statistics.median(b)) for v in b]
    ma, mb, m = statistics.mean(za), statistics.mean(zb), statistics.mean(za + zb)
    w = 138 * (60 * (ma - m) ** 2 + 80 * (mb - m) ** 2) / (sum((z - ma) ** 2 for z in za) + sum((z - mb) ** 2 for z in zb))
    got = stats.levene_test(df, "y").first()
    assert got.levene_statistic == pytest.approx(w) and 0 <= got.p_value <= 1


def test_gates_and_texts(rows):
    same = [(float(v), v % 2, float(v % 2) * 100 + v) for v in range(200)]
    df = rows(same, "x double, y int, shifted double")
    out = {r["column"]: r for r in stats.gated_t_test(df, "y", gated=True, explain=True).collect()}
    assert out["shifted"].t_statistic == "N/A (different distributions)"
    assert float(out["x"].p_value) > 0.05
    plain = {r["column"]: r for r in stats.gated_t_test(df, "y", gated=True).collect()}
    assert (plain["shifted"].t_statistic, plain["shifted"].p_value) == (0.0, 0.0)
    scored = profile.with_tests(profile.profile(df), stats.t_test(df, "y"), stats.chi_square(df.withColumn("c", F.lit("k")), "y", ["c"]))
    marks = {r["column"]: r.significance for r in scored.collect()}
    assert marks["shifted"] == "Yes" and marks["x"] == "No" and marks["y"] is None


# -- sampling --------------------------------------------------------------------------------


def test_split_is_a_partition_and_ratio_zero_gives_all(rows):
    df = rows([(i,) for i in range(2000)], "k long")
    train, test = sampling.train_test(df, "k", 0.2, 1)
    assert as_set(train).isdisjoint(as_set(test)) and train.count() + test.count() == 2000
    assert 330 < test.count() < 470
    again = sampling.train_test(df.repartition(7), "k", 0.2, 1)[1]
    assert as_set(again) == as_set(test) != as_set(sampling.train_test(df, "k", 0.2, 2)[1])
    both = sampling.train_test(df, "k", 0, 1)
    assert both[0].count() == both[1].count() == 2000


def test_exact_sizes(rows):
    df = rows([(i, int(i % 10 == 0)) for i in range(1000)], "k long, y int")
    got = sampling.sample_exactly(df, "k", "y", {0: 37, 1: 500}, 9)
    assert sampling.class_sizes(got, "y") == {0: 37, 1: 100}
    assert sampling.sample_exactly(df, "k", "y", {0: 0, 1: 3}, 9).count() == 3
    small = rows([(i, int(i < 7)) for i in range(20)], "k long, y int")
    assert sampling.class_sizes(sampling.balanced_subset(small, df, "k", "y"), "y") == {0: 13, 1: 7}


def test_under_over_and_folds(rows):
    df = rows([(i, int(i % 50 == 0)) for i in range(1000)], "k long, y int")
    assert sampling.class_sizes(sampling.under_sample(df, "k", "y", 0.1), "y") == {0: 200, 1: 20}
    over = sampling.over_sample(df, "k", "y")
    assert sampling.class_sizes(over, "y") == {0: 980, 1: 980}
    repeats = over.where("y = 1").groupBy("k").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(repeats) == (49, 49)
    folds = sampling.fold_stratified(df, "k", "y", 3, 5)
    sizes = {(r.y, r.fold): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    assert sorted(v for (y, _), v in sizes.items() if y == 1) == [6, 7, 7]
    assert sorted(v for (y, _), v in sizes.items() if y == 0) == [326, 327, 327]
    assert {r.fold for r in sampling.fold_hash(df, "k", 4, 1).collect()} == {0, 1, 2, 3}


def test_bootstrap_weights(rows):
    df = rows([(i, int(i < 100)) for i in range(1000)], "k long, y int")
    drawn = sampling.bootstrap(df, "k", 10)
    total = drawn.agg(F.sum("weight")).first()[0]
    assert 9500 < total < 10500
    even = {r.y: r.w for r in sampling.bootstrap(df, "k", 10, label="y").groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    assert 800 < even[0] < 1200 and 800 < even[1] < 1200
