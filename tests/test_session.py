import os
from concurrent.futures import ThreadPoolExecutor

from tideline import session


def test_release_deletes_only_the_tables_of_this_application(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda _: str(tmp_path))
    (tmp_path / "tideline" / "other").mkdir(parents=True)
    assert session.materialize(spark.range(5), "kept").count() == 5
    assert len(os.listdir(tmp_path / "tideline")) == 2
    session.release(spark)
    assert os.listdir(tmp_path / "tideline") == ["other"]


def test_a_written_table_leaves_the_settings_as_they_were(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    assert session.materialize(spark.range(9).distinct(), "d").count() == 9
    assert spark.conf.get(name) == before


def test_tables_written_by_several_threads_leave_the_settings_too(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda n: session.materialize(spark.range(n).distinct(), "d").count(), [3, 5, 7, 9]))
    assert counts == [3, 5, 7, 9] and spark.conf.get(name) == before
