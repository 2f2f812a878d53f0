import datetime as dt

import pytest
from helpers import as_dicts, as_set
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import aggregates, columns, diff, joins, ranking, snapshots
from tideline.sources import files, tables


# -- sources -------------------------------------------------------------------


def test_work_folder_is_the_configured_one(spark, rows):
    from tideline.session import materialize, work_dir

    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(rows([(1, None)], "a int, b string"), "probe")
    assert as_set(df) == {(1, None)} and work_dir(spark) in df.inputFiles()[0]


def test_resolve_name():
    assert tables.resolve_name("refined", "deals_v12", "dev", True) == "prod_refined.deals"
    assert tables.resolve_name("refined", "deals", "dev", True) == "prod_refined.deals"
    assert tables.resolve_name("refined", "deals_v12", "prod", True) == "refined.deals_v12"
    assert tables.resolve_name("refined", "deals_v12") == "refined.deals_v12"


def test_read_table_from_catalog_and_its_rules(spark, rows):
    rows([(1, "a"), (2, None), (3, "c")], "id long, s string").createOrReplaceTempView("small_table")
    df = tables.read_table(spark.table("small_table"), where="WHERE s <> 'a'", columns=["s", "id", "nope"], rename={"id": "k"})
    assert df.columns == ["s", "k"] and as_set(df) == {("c", 3)}  # <> drops null
    with pytest.raises(ValueError):
        tables.read_table(df, filter_key="k", filter_values=[1], where="k = 1")
    assert tables.read_table(spark.table("small_table"), limit=1).count() == 1


def test_key_filter_forms_agree(spark, rows):
    df = rows([(i, i) for i in range(50)] + [(None, 0)], "k long, v int")
    keys = [1, 5, 7, 7]
    as_list = tables.key_filter(df, "k", keys)
    as_frame = tables.key_filter(df, "k", rows([(k,) for k in keys], "x long"))
    many = tables.key_filter(df, "k", keys + list(range(1000, 2500)))
    assert as_set(as_list) == as_set(as_frame) == as_set(many) == {(1, 1), (5, 5), (7, 7)}


def test_scan_prunes_and_pushes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows([(i, str(i), i * 2) for i in range(10)], "a long, b string, c long").write.parquet(path)
    df = tables.read_table(spark.read.parquet(path), columns=["a"], filter_key="a", filter_values=[3, 4])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint>" in plan and "PushedFilters: [In(a" in plan


def test_timestamps_are_cut(rows):
    df = rows([(dt.datetime(2024, 1, 1, 0, 0, 0, 123999),)], "t timestamp")
    assert tables.timestamps_to_ms(df).first()[0] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_files_round_trip(spark, rows, tmp_path):
    df = rows([(1, "a,b", None), (2, 'q"q', 1.5)], "id long, s string, x double")
    files.write_csv(df, str(tmp_path / "csv"))
    assert as_set(files.read_csv(spark, str(tmp_path / "csv"), df.schema)) == as_set(df)
    assert as_set(files.write_stage(df, str(tmp_path / "stage"))) == as_set(df)
    files.save_schema(df, str(tmp_path / "schema"), ["x", "id"])
    assert [f.name for f in files.load_schema(spark, str(tmp_path / "schema")).fields] == ["x", "id"]


def test_record_files(spark, tmp_path):
    folder = tmp_path / "requests"
    folder.mkdir()
    (folder / "a.json").write_text('{"data": [\n {"id": 1, "v": "x"},\n {"id": 2}\n]}')
    schema = T.StructType.fromDDL("id long, v string")
    assert as_set(files.read_record_files(spark, str(folder), schema, one_per_file=True)) == {(1, "x"), (2, None)}
    assert as_set(files.records_table(spark, [{"id": 1}, {"v": "y", "id": 2}], schema)) == {(1, None), (2, "y")}


# -- columns ---------------------------------------------------------------------


def test_label_keeps_an_existing_target(rows):
    df = rows([("Closed Won",), ("Open",), (None,)], "s string")
    labelled = columns.label_from_stage(df, "s", ["Closed Won"])
    assert [r.target for r in labelled.collect()] == [1, 0, 0]
    assert columns.label_from_stage(labelled.withColumn("target", F.lit(9)), "s", []).first().target == 9


def test_recode_covers_null(rows):
    df = rows([("a",), ("b",), (None,)], "s string")
    assert [r[0] for r in df.select(columns.recode(F.col("s"), {"a": "A"})).collect()] == ["A", "Unknown", "Unknown"]


def test_integers_only_drops_what_does_not_convert(rows):
    df = rows([("1",), ("x",), (None,), ("7",)], "o string")
    assert as_set(columns.integers_only(df, "o")) == {(1,), (7,)}


def test_drop_sparse_and_duplicate_names(rows):
    df = rows([(1, None, 1, "x"), (2, None, None, "y")], "a int, b int, c int, d string")
    doubled = df.select("*", F.col("a"))
    kept = columns.drop_sparse(doubled, threshold=2, drop=["d", "zz"])
    assert kept.columns == ["a"]
    assert columns.drop_sparse(doubled).columns == ["a", "b", "c", "d"]
    assert columns.without_null_columns(df).columns == ["a", "d"]


def test_align_to_schema_adds_zero_and_reorders(rows):
    df = rows([("7", "x", 1)], "a string, s string, extra int")
    schema = T.StructType.fromDDL("n int, a double, s string")
    assert as_set(columns.align_to_schema(df, schema)) == {(0, 7.0, "x")}
    bad = rows([("seven", "x")], "a string, s string")
    assert as_set(columns.align_to_schema(bad, schema)) == {(0, None, "x")}


def test_names_that_collide_after_cleaning(rows):
    df = rows([(1, 2, 3)], "`a b` int, `a-b` int, `a_b_1` int")
    names = columns.sanitize_names(df).columns
    assert names[0] == "a_b" and len(set(names)) == 3


def test_booleans_become_their_value(rows):
    df = rows([(True,), (False,), (None,)], "b boolean")
    assert [r.b for r in columns.booleans_to_int(df).collect()] == [1, 0, 0]


def test_stage_columns_prefer_exact_then_first_prefix():
    names = ["hs_date_entered_1", "hs_date_entered_12", "hs_time_in_ab_c_99"]
    stages = [("1", "Closed Won", "Learn"), ("ab-c", "First Contact", None), ("12", "Closed Lost", "Work")]
    got = columns.stage_column_names(names, stages)
    assert got == {
        "hs_date_entered_1": "closed_won_learn_entered",
        "hs_time_in_ab_c_99": "first_contact_no_pipeline_time_in",
        "hs_date_entered_12": "closed_lost_work_entered",
    }


def test_merge_stage_columns_reads_zero_as_missing(rows):
    df = rows([(1, 0, 90_061_000), (2, 60_000, 5)], "id long, hs_time_in_1 long, hs_time_in_2 long")
    stages = rows([("1", "In purchasing", "Learn"), ("2", "In purchasing", "Work")], "stage_id string, stage_name string, pipeline_label string")
    out = {r.id: r for r in columns.merge_stage_columns(df, stages).collect()}
    assert out[1].in_purchasing_time_in == 90_061_000 and out[1].in_purchasing_time_in_days_string == "1 days 1 hours"
    assert out[2].in_purchasing_time_in == 60_000
    assert "closed_lost_exited" not in columns.merge_stage_columns(df, stages).columns


# -- joins --------------------------------------------------------------------------


def test_anti_join_keeps_null_keys(rows):
    df = rows([(1,), (2,), (None,)], "k long")
    excluded = rows([(2,), (None,)], "x long")
    assert as_set(joins.drop_keys(df, "k", excluded)) == {(1,), (None,)}


def test_semi_join_on_two_columns(rows):
    df = rows([(1, 10), (1, 11), (2, 10), (None, 10)], "a long, b long")
    keys = rows([(1, 10), (2, 99), (None, 10)], "x long, y long")
    assert as_set(joins.keep_keys(df, keys, ["a", "b"])) == {(1, 10)}


def test_join_with_suffix(rows):
    left = rows([(1, "a"), (2, "b")], "id long, v string")
    right = rows([(1, "x", 5)], "id long, v string, n int")
    same = joins.join_with_suffix(left, right, "id", suffixes=("", "_r"))
    assert same.columns == ["id", "v", "v_r", "n"] and as_set(same) == {(1, "a", "x", 5), (2, "b", None, None)}
    other = joins.join_with_suffix(left, right.withColumnRenamed("id", "key"), "id", "key", suffixes=("_l", "_r"))
    assert other.columns == ["id", "v_l", "key", "v_r", "n"]


def test_lookup_unknown_default_and_duplicate_keys(rows):
    df = rows([(1,), (2,), (None,)], "k long")
    table = rows([(1, "a"), (1, "b")], "i long, name string")
    assert as_set(joins.lookup(df, table, "k", "i", "name", "n")) == {(1, "b"), (2, None), (None, None)}
    assert as_set(joins.lookup(df, table, "k", "i", "name", "n", "?")) == {(1, "b"), (2, "?"), (None, "?")}


def test_split_ids_drops_malformed(rows):
    df = rows([("12:1600000000;34",), ("x:1",), (None,), ("",), ("12:5;",)], "s string")
    assert as_set(joins.split_ids(df, "s")) == {(12,), (34,)}
    assert as_set(joins.split_ids(rows([("3;4",)], "s string"), "s", part=None)) == {(3,), (4,)}


def test_scale_listed_uses_the_ids_once(rows):
    df = rows([(1, 10.0), (2, 10.0), (None, 10.0)], "id long, amount double")
    out = joins.scale_listed(df, "id", "amount", rows([(1,), (1,)], "d long"), 0.5)
    assert as_set(out) == {(1, 5.0), (2, 10.0), (None, 10.0)}


def test_key_sides_and_column_sets(rows):
    a, b = rows([(1,), (2,), (2,), (None,)], "k long"), rows([(2,), (3,)], "k long")
    assert as_set(joins.compare_keys(a, b, "k")) == {(1, "left"), (2, "both"), (3, "right")}
    assert as_set(joins.common_keys(a, b, "k")) == {(2,)}
    sets = joins.column_sets(rows([(1, 2)], "x int, y int"), rows([(1, 2)], "y int, z int"))
    assert sets == {"left_only": ["x"], "right_only": ["z"], "common": ["y"], "exactly_one": ["x", "z"]}


# -- snapshots --------------------------------------------------------------------------


def test_latest_with_ties_keeps_all_tied(rows):
    df = rows([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (2, 1, "e"), (None, 9, "f")], "k long, t long, v string")
    assert as_set(snapshots.latest_with_ties(df, "k", "t")) == {(1, 5, "a"), (1, 5, "b"), (2, 1, "e")}


def test_latest_with_ties_shuffles_its_table_once(rows):
    df = snapshots.latest_with_ties(rows([(1, 5), (1, 5), (2, 1)], "k long, t long"), "k", "t")
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert df.count() == 3


def test_latest_per_key_tie_column_and_null_stamp(rows):
    df = rows([(1, 5, 10), (1, 5, 11), (2, None, 12), (2, 3, 1)], "k long, t long, c long")
    assert as_set(snapshots.latest_per_key(df, ["k"], "t", ["c"])) == {(1, 5, 11), (2, 3, 1)}


def test_latest_snapshot(rows):
    df = rows([(1, 5), (2, 6), (3, 6), (4, None)], "k long, dumpdate long")
    assert as_set(snapshots.latest_snapshot(df)) == {(2, 6), (3, 6)}


NEAR = "k long, id long, at long"


def test_nearest_exact_both_sides_none_and_missing_anchor(rows):
    anchors = rows([(1, 1, 100), (1, 2, 150), (1, 3, 10**9), (1, 4, None), (2, 5, 100), (None, 6, 1), (3, 7, 0)], NEAR)
    history = rows([(1, 100), (1, 200), (1, 200), (3, 5), (3, -5), (None, 1), (2, None)], "k long, seen long")
    got = as_set(snapshots.nearest_snapshot(anchors, history, "k", "at", "seen").select("id", "seen"))
    assert got == {(1, 100), (2, 100), (3, 200), (4, 100), (7, -5)}
    per_key = as_set(snapshots.nearest_snapshot(anchors, history, "k", "at", "seen", per="key", ties=["id"]).select("k", "id", "seen"))
    assert per_key == {(1, 1, 100), (3, 7, -5)}


def test_nearest_against_brute_force_over_buckets(rows):
    import random

    rng = random.Random(5)
    # One key holds most rows, and times spread over many buckets.
    anchors = [(0 if rng.random() < 0.6 else rng.randrange(1, 9), i, rng.randrange(0, 5000)) for i in range(400)]
    history = [(0 if rng.random() < 0.6 else rng.randrange(1, 9), rng.randrange(0, 5000)) for _ in range(300)]
    got = {
        r.id: r.seen
        for r in snapshots.nearest_snapshot(rows(anchors, NEAR), rows(history, "k long, seen long"), "k", "at", "seen", width=100).collect()
    }
    for k, i, at in anchors:
        mine = sorted(t for h, t in history if h == k)
        want = min(mine, key=lambda t: (abs(at - t), t)) if mine else None
        assert got.get(i) == want


# -- aggregates ----------------------------------------------------------------------------


def test_conditional_unique_null_not_zero(rows):
    df = rows(
        [(1, 7, "IN", None), (1, 7, "OUT", 4.0), (1, 8, "IN", 2.0), (2, 9, None, None), (2, None, "IN", 5.0), (None, 1, "IN", 1.0)],
        "d long, c long, dir string, dur double",
    )
    out = aggregates.conditional_unique(
        df, "d", "c", {"n": F.lit(True), "n_in": F.col("dir") == "IN", "n_out": F.col("dir") == "OUT"},
        {"mean": ("avg", "dur"), "total": ("sum", "dur")},
    )
    assert as_set(out) == {(1, 2, 2, 1, 3.0, 6.0), (2, 1, None, None, 5.0, 5.0)}


def test_sum_of_nulls_is_zero_and_mean_null(rows):
    df = rows([(1, 1, None)], "d long, c long, dur double")
    out = aggregates.conditional_unique(df, "d", "c", {"n": F.lit(True)}, {"mean": ("avg", "dur"), "total": ("sum", "dur")})
    assert as_set(out) == {(1, 1, None, 0.0)}


def test_pivot_unique_fills_and_keeps_both_spellings(rows):
    df = rows([(1, "CANCELED", 5), (1, "CANCELED", 5), (1, "CANCELED", 6), (2, "DONE", None), (3, None, 1)], "d long, o string, m long")
    out = aggregates.pivot_unique(df, "d", "o", "m", {"CANCELED": "x_canceled", "DONE": "x_done"}, ["x_cancelled"])
    assert as_dicts(out) == [{"d": 1, "x_canceled": 2, "x_done": 0, "x_cancelled": 0}]


def test_relative_frequency_and_unseen(rows):
    df = rows([("a", 1), ("a", 0), ("b", 0), (None, 1)], "c string, y int")
    out = aggregates.add_frequency(df, "c", "f", F.col("y") == 1)
    assert {(r.c, r.f) for r in out.collect()} == {("a", 1.0), ("b", None), (None, None)}
    assert {tuple(r) for r in aggregates.relative_frequency(df, "c", "f").collect()} == {("a", 2 / 3), ("b", 1 / 3)}


def test_duplicates_and_balance(rows):
    df = rows([(1, 1), (1, 0), (2, 0), (3, 0), (3, 0), (3, 0)], "k long, y int")
    assert as_set(aggregates.duplicate_report(df, "k")) == {(5, 2)}
    assert as_set(aggregates.class_balance(df, "y")) == {(5, 1, 1 / 6, 0.2)}


# -- diff, ranking ------------------------------------------------------------------------------


def test_frame_diff(rows):
    a = rows([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (3, "z", 4.0)], "k long, s string, n double")
    b = rows([(1, "x", 1.0), (2, "Y", None), (3, "z", 3.5), (4, "w", 0.0)], "k long, s string, n double")
    assert as_set(diff.column_differences(a, b, "k")) == {("s", 3, 1, 2), ("n", 3, 1, 3)}
    assert as_set(diff.cell_differences(a, b, "k")) == {(2, "s", "y", "Y"), (3, "n", "3.0", "3.5")}
    assert as_set(diff.key_overlap(a, b, "k")) == {(3, 0, 1)}


def test_fingerprint_sees_changes_not_order(rows):
    a = rows([(1, "x"), (2, "y")], "k long, s string")
    b = rows([("y", 2), ("x", 1)], "s string, k long")
    c = rows([(1, "x"), (2, "z")], "k long, s string")
    assert as_set(diff.fingerprint(a)) == as_set(diff.fingerprint(b)) != as_set(diff.fingerprint(c))


def test_same_order(rows):
    a = rows([(0, "x"), (1, "y"), (2, "z")], "p long, k string")
    b = rows([(0, "x"), (1, "z"), (2, "y")], "p long, k string")
    assert diff.same_order(a, a, "k", "p").first().moved == 0
    assert diff.same_order(a, b, "k", "p").first().moved == 2


def test_probe_rows_and_agreement(spark, rows):
    probe = diff.probe_rows(spark, T.StructType.fromDDL("s string, i int, d double"), 3)
    assert [tuple(r) for r in probe.collect()] == [("unknown", 0, 0.0)] * 3
    a, b = rows([(1, 0), (2, 1)], "k long, p int"), rows([(1, 0), (2, 0), (3, 1)], "k long, p int")
    assert as_set(diff.agreement(a, b, "k", "p")) == {(2, 0.5)}


def test_percent_change_and_leaderboard(rows):
    df = rows([(0, 10.0, 0.0), (1, 15.0, 1.0)], "o int, m double, z double")
    out = {r.o: r for r in ranking.percent_change(df, "o", ["m", "z"]).collect()}
    assert out[1].m_diff_pct == 50.0 and out[1].z_diff_pct is None and out[0].m_diff_pct == 0.0
    scores = rows([("a", 1.0), ("a", 3.0), ("b", 2.5), ("c", 0.0)], "n string, s double")
    board = ranking.leaderboard(scores, "n", "s", 2).orderBy("rank").collect()
    assert [(r.n, r.mean_score, r.std_score, r["rank"]) for r in board] == [("b", 2.5, 0.0, 1), ("a", 2.0, 1.0, 2)]
    worst = ranking.leaderboard(scores, "n", "s", 1, maximize=False).first()
    assert worst.n == "c"
    assert [r.n for r in ranking.sort_rows(scores, "n", "s", descending=["s"]).collect()] == ["a", "a", "b", "c"]
    assert ranking.head(scores, 2).count() == 2
