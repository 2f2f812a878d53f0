import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tideline.llm import exact_dedup

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def normal(text):
    return (text or "").translate(SMALL)


def brute(rows, keep=max):
    """Every row's marks, repeated rows of one id counted as one kept row."""
    groups = {}
    for i, text in rows:
        groups.setdefault(normal(text), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        sha, left = hashlib.sha256(text.encode()).hexdigest(), 1
        for i in sorted(ids, key=lambda x: (x is None, x)):
            stays = i == best and left > 0
            left -= stays
            out.append((i, best, len(ids), stays, sha))
    return sorted(out, key=repr)


def marks(df, **options):
    return sorted((tuple(r) for r in exact_dedup.mark(df, **options).collect()), key=repr)


def corpus():
    draw = random.Random(3)
    rows = []
    for i in range(300):
        text = draw.choice(["Same text", "same TEXT", "other", "Élan", "élan", "", None, " ", "X" * 50_000, f"own {i}"])
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("keep, best", [("largest", max), ("smallest", min)])
def test_equal_texts_are_found(make_docs, keep, best):
    rows = corpus()
    assert marks(make_docs(rows).repartition(5), keep=keep) == brute(rows, best)


def test_missing_and_repeated_ids(make_docs):
    rows = [(None, "a"), (None, "A"), (1, "b"), (None, "b"), (2, "c"), (2, "c"), (2, "C"), (2, "d"), (7, None), (7, ""), (None, None)]
    got = marks(make_docs(rows).repartition(4), keep="largest")
    assert got == brute(rows)
    assert sum(kept for *_, kept, _ in got) == 5


def test_hashes_that_several_texts_share_are_told_apart(make_docs):
    rows = corpus()
    weak = lambda text: F.unhex(F.substring(F.md5(text.cast("binary")), 1, 1).cast("string"))
    assert marks(make_docs(rows), keep="largest", hashed=weak) == brute(rows)


def test_a_hot_text_is_dealt_out(make_docs, spark):
    df = make_docs([(i, "hot" if i % 3 else f"t{i}") for i in range(600)])
    rows = exact_dedup.classes(df)
    assert rows.select("row").distinct().count() == 600
    got = exact_dedup.mark(df, keep="largest").where("group_size > 1")
    assert got.count() == 400 and [r.doc_id for r in got.where("kept").collect()] == [599]


def test_dedup_keeps_whole_rows_with_their_columns(make_docs):
    rows = [(1, "A"), (2, "a"), (3, "b"), (3, "b"), (None, "c"), (None, None)]
    df = make_docs(rows).withColumns({"hash": F.lit("mine"), "row": F.lit(5), "spread": F.lit(0), "keep_id": F.lit(1), "content": F.lit("z")})
    left = exact_dedup.dedup(df)
    assert left.columns == df.columns and left.dtypes == df.dtypes
    assert sorted(((r.doc_id, r.text, r.hash) for r in left.collect()), key=repr) == [(1, "A", "mine"), (3, "b", "mine"), (None, "c", "mine"), (None, None, "mine")]
    assert marks(df, keep="smallest") == brute(rows, min)


def test_empty_table_and_unknown_choice(make_docs):
    assert exact_dedup.mark(make_docs([])).collect() == [] and exact_dedup.dedup(make_docs([])).collect() == []
    with pytest.raises(ValueError):
        exact_dedup.mark(make_docs([]), keep="first")
