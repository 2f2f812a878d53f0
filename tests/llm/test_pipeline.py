import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark, prose, edited):
    rows = []
    for i in range(40):
        rows.append((i, "\n".join(prose(100 * i + k, 12) for k in range(6)), ["en", "fr"][i % 2], f"s{i % 3}"))
    rows += [(100 + i, edited(rows[i][1].replace("\n", " "), i, 1), "en", "s0") for i in range(10)]
    rows += [(200, rows[0][1], "en", "s1"), (201, None, "en", "s0"), (202, "", None, "s0"), (203, "12 34", None, None), (204, "alone", None, None)]
    rows += [(205, rows[5][1] + "\nwith one more line of its own words", "en", None)]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)


def test_stages_keep_the_columns_and_work_on_what_is_left(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language id", "line dedup", "n-gram jaccard join", "source mixing", "best-fit packing"
    ]
    left, seen = docs, []
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        left = stage(spark, left, "unused")
        if place < 4:
            assert left.columns == docs.columns and left.dtypes == docs.dtypes
            left = spark.createDataFrame(left.collect(), DOCS)
            seen.append({r["doc_id"]: r for r in left.collect()})
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(seen[0]) == {i for i, t in texts.items() if t and re.search("[a-z]", t)}
    # The copy and the document with a line more lose the lines that were there before.
    assert seen[1][200]["text"] == "" and seen[1][205]["text"] == "with one more line of its own words"
    assert seen[1][3]["text"] == texts[3] and seen[1][205]["n_chars"] == len(seen[1][205]["text"])
    assert set(seen[2]) <= set(seen[1]) and set(range(40)) <= set(seen[2])
    assert set(seen[3]) <= set(seen[2])
    pieces = left.collect()
    assert {r["doc_id"] for r in pieces} == set(seen[3])
    fill = {}
    for r in pieces:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 1024


def test_near_copies_go(spark, docs):
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, "unused").collect()}
    assert not kept & set(range(100, 110)) and 200 not in kept
    assert set(range(40)) | {201, 202, 203, 204} <= kept


def test_run_over_a_folder_and_an_empty_table(spark, docs, tmp_path):
    for name, table in (("some", docs), ("none", docs.where(F.lit(False)))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert bool(rows) == (name == "some")


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if re.match(rf"op{n}_", q)]) == 1
    assert "pipeline" in names and {"op3_chat_formatting", "op6_nearest_vectors", "op11_importance_resampling", "op12_vector_codes", "op13_exact_dedup"} <= set(entry.oracle_sql())
