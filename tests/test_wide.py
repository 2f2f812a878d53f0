"""Wide tables: how they are written, counted and encoded."""

import datetime
import math

from pyspark.sql import functions as F

from tideline.checks import scale, workload
from tideline.checks.registry import QUERIES
from tideline.operators import encode, profile
from tideline.plans import prepare, train
from tideline.session import materialize


def _wide(df, n=110):
    return df.withColumns({f"w{i}": (F.col("id") % (i + 1)).cast("double") for i in range(n)})


def _odd(spark):
    when = [datetime.datetime(1500, 3, 1, 2, 3, 4, 5), datetime.datetime(1969, 12, 31, 23, 59, 59, 999_999), None, datetime.datetime(2024, 3, 31, 2, 30)]
    days = [datetime.date(1, 1, 1), None, datetime.date(1582, 10, 15), datetime.date(9999, 12, 31)]
    numbers = [0.0, -0.0, math.nan, None]
    rows = [(i, when[i % 4], days[i % 4], numbers[i % 4], numbers[i // 2 % 4], i % 3 == 0, ["", "ä", None, "x;y"][i % 4], [i, None]) for i in range(8)]
    kinds = "id long, at timestamp, on date, x double, y float, flag boolean, `a.b €` string, items array<bigint>"
    return spark.createDataFrame(rows, kinds)


def test_a_wide_table_is_written_as_orc_and_read_back_as_it_was(spark):
    narrow, wide = _odd(spark), _wide(_odd(spark))
    stored = materialize(wide, "wide")
    assert stored.inputFiles()[0].endswith(".orc") and materialize(narrow, "n").inputFiles()[0].endswith(".parquet")
    assert stored.schema == wide.schema
    told = lambda df: sorted(repr(r).replace("-0.0", "0.0") for r in df.collect())
    assert told(stored.select("id", "at", "on", "x", "y", "flag", "`a.b €`", "items", "w7")) == told(wide.select("id", "at", "on", "x", "y", "flag", "`a.b €`", "items", "w7"))
    assert materialize(wide.where("id < 0"), "none").count() == 0


def test_a_wide_stored_profile_counts_by_kind_what_texts_tell(spark, monkeypatch, tmp_path):
    _wide(_odd(spark)).drop("items").write.parquet(f"{tmp_path}/wide")
    stored = spark.read.parquet(f"{tmp_path}/wide")
    seen = []
    counted = profile._counted
    monkeypatch.setattr(profile, "_counted", lambda cells: seen.append(dict(cells.dtypes)["value"]) or counted(cells))
    by_kind = {r["column"]: r for r in profile.profile(stored).collect()}
    assert sorted(seen) == ["bigint", "double", "string"]
    seen.clear()
    monkeypatch.setattr(profile, "_stored", lambda df: False)
    as_text = {r["column"]: r for r in profile.profile(stored).collect()}
    assert seen == ["string"] and by_kind == as_text
    # Negative zero and NaN are values of their own, as their texts are.
    assert by_kind["x"]["distinct"] == 3 and by_kind["at"]["distinct"] == 3 and by_kind["flag"]["distinct"] == 2


def test_a_computed_wide_table_is_counted_in_one_pass(spark):
    wide = _wide(spark.range(6))
    assert not profile._stored(wide.groupBy("id").agg(F.max("w3").alias("w3"))) and profile._stored(materialize(wide, "w").drop("w1"))


def test_places_that_travel_with_the_tasks_are_those_of_the_joins(spark, monkeypatch):
    data = [(1, "a", "x;y"), (2, None, ""), (3, "b", None), (4, "<NA>", "y;y;z"), (5, "c", "q")]
    df = spark.createDataFrame(data, "id long, c string, l string")
    places = materialize(
        encode.fit_places(encode.vocabularies(df, ["c"]).unionByName(encode.list_vocabularies(df, ["l"])).where("value <> 'q'")), "places"
    )
    near = encode.encode_sparse(df, "id", places, ["c"], ["l"])
    assert not near._jdf.queryExecution().optimizedPlan().toString().count("Join")
    monkeypatch.setattr(encode, "NEAR", 3)
    mixed = encode.encode_sparse(df, "id", places, ["c"], ["l"])
    monkeypatch.setattr(encode, "NEAR", 0)
    far = encode.encode_sparse(df, "id", places, ["c"], ["l"])
    assert near.dtypes == far.dtypes == mixed.dtypes
    assert sorted(near.collect()) == sorted(far.collect()) == sorted(mixed.collect())
    # A separator that is a pattern splits as Spark does.
    pattern = encode.encode_sparse(df, "id", places, [], ["l"], "[;]")
    assert [r["encoded"] for r in pattern.sort("id").collect()] == [
        r["encoded"] for r in encode.encode_sparse(df, "id", places, [], ["l"]).sort("id").collect()
    ]


def test_fitting_writes_only_the_columns_that_the_steps_read(spark, monkeypatch):
    class Stop(Exception):
        pass

    def stop(df, label):
        raise Stop(label, df.columns)

    monkeypatch.setattr(prepare, "materialize", stop)
    names = ["amount", "class_size", "intake", "reason_to_buy_short", "target", "max_education_school", "unread"]
    monkeypatch.setattr(prepare, "_cleaned", lambda df, countries: df)
    df = spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"{n} string" for n in names))
    found = []
    for career in (False, True):
        try:
            prepare.fit(df, None, wide=False, career=career)
        except Stop as e:
            found.append(e.args)
    assert found == [("cleaned", names[:4]), ("cleaned", names[:6])]


def test_the_category_model_retrieves_once(monkeypatch):
    class Stop(Exception):
        pass

    asked = []
    monkeypatch.setattr(workload, "crm_tables", lambda t: {})
    monkeypatch.setattr(workload.retrieve, "retrieve", lambda tables, per: asked.append(per))
    monkeypatch.setattr(workload.retrieve, "labelled", lambda base: base)
    monkeypatch.setattr(workload, "materialize", lambda df, label: "base")

    def prepared(t, key, base):
        assert base == "base" and key == ["deal_id", "course_id"]
        raise Stop

    monkeypatch.setattr(scale, "_prepared", prepared)
    try:
        QUERIES["category_per_row_model"](_Session(), "/nowhere")
    except Stop:
        pass
    assert asked == ["row"]


class _Session:
    class conf:
        set = staticmethod(lambda *a: None)
