import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm import jaccard_join, shingles
from tideline.llm.graph import components

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets, group = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return sorted((rows[i][0], len(sets[i]), low[root(i)]) for i in range(len(rows)))


def found(df):
    return sorted(tuple(r) for r in jaccard_join.join(df).select("doc_id", "n_shingles", "component_id").collect())


def corpus(prose, edited):
    rows = []
    for family in range(12):
        base = prose(family, 30 + 25 * family)
        rows += [base, base.upper(), edited(base, family, 1), edited(base, 100 + family, 2), edited(base, 200 + family, 6)]
    chain = prose(99, 200)
    for step in range(8):  # each links to the next only
        rows.append(chain)
        chain = edited(chain, 300 + step, 2)
    passage = prose(500, 60)
    rows += [f"{prose(600 + i, 100)} {passage}" for i in range(30)]
    rows += [" ".join(random.Random(i).choices("abc", k=random.Random(i).randrange(0, 9))) for i in range(120)]
    rows += ["", "   \n", "One", "one ", "a b c d", "A B  C D", "a b c d e", "é É", None, "x" * 50_000, "y " * 30_000]
    random.Random(5).shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("least", [10**9, 2])
def test_components_equal_all_pairs(make_docs, prose, edited, monkeypatch, least):
    """With every shared token frequent (least 2) and with none."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", least)
    rows = corpus(prose, edited)
    assert found(make_docs(rows)) == brute(rows)


def test_large_group_of_near_copies(make_docs, prose, edited):
    base = prose(7, 120)
    rows = [(i, edited(base, i, 1)) for i in range(300)] + [(1000 + i, prose(900 + i, 60)) for i in range(20)]
    assert found(make_docs(rows)) == brute(rows)


def test_rows_that_repeat_an_id_and_missing_ids(spark, prose):
    text = prose(1, 40)
    rows = spark.createDataFrame([(1, text), (1, text), (2, text), (1, prose(2, 40)), (None, prose(3, 40)), (None, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard_join.join(rows).collect()), key=str)
    assert got == sorted([(1, 36, 1), (1, 36, 1), (2, 36, 1), (1, 36, 1), (None, 36, None), (None, 0, None)], key=str)


def test_empty_table(make_docs):
    assert found(make_docs([])) == []
    assert jaccard_join.keep_first(make_docs([])).collect() == []


def test_keep_first_leaves_columns_and_clean_documents(spark, prose, edited):
    base = prose(3, 80)
    rows = [(4, base, "x", 1), (2, edited(base, 1, 1), "y", 2), (9, prose(8, 50), None, 3), (10, None, "z", 4), (11, "", "z", 5), (None, base, "n", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token string, component_id int")
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    # The copy without an id goes with its group.
    assert sorted((r["component_id"] for r in kept.collect())) == [2, 3, 4, 5]


def test_keep_first_decides_every_row_by_its_own_text(spark, prose, edited):
    base, other = prose(3, 80), prose(40, 80)
    near = edited(other, 5, 1)
    rows = [(1, base, 0), (7, edited(base, 1, 1), 1)]  # 7 links to 1, and its other rows are clean
    rows += [(7, prose(20 + i, 60), 2 + i) for i in range(5)]
    rows += [(5, other, 10), (5, other, 10), (5, other, 11), (5, near, 12), (5, near, 12)]  # one of all these
    rows += [(None, prose(50, 70), 20), (None, prose(50, 70), 20), (None, edited(prose(50, 70), 6, 1), 21), (None, prose(51, 70), 22)]
    rows += [(8, "", 30), (8, "", 30), (None, None, 31), (None, None, 31)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = [tuple(r) for r in jaccard_join.keep_first(docs).collect()]
    assert not set(kept) - set(rows)
    numbers = sorted(n for _, _, n in kept)
    assert [n for n in numbers if n < 10] == [0, 2, 3, 4, 5, 6]
    assert len([n for n in numbers if 10 <= n < 20]) == 1
    assert len([n for n in numbers if n in (20, 21)]) == 1 and numbers.count(22) == 1
    assert [n for n in numbers if n >= 30] == [30, 30, 31, 31]
    again = [tuple(r) for r in jaccard_join.keep_first(docs.repartition(7, "n")).collect()]
    assert sorted(map(str, again)) == sorted(map(str, kept))


def test_shingle_sets_in_blocks_of_any_size(monkeypatch):
    draw = random.Random(2)
    texts = ["".join(draw.choices("aAbé \n\t", k=draw.randrange(60))) for _ in range(400)] + ["q" * 9000 + " a b c d"]
    names = {}
    for block in (1, 100, 1 << 20):
        monkeypatch.setattr(shingles, "BLOCK_BYTES", block)
        seen = 0
        for first, sizes, tokens in shingles.shingle_sets(pa.array(texts), 5):
            ends = np.cumsum(sizes)
            for i, (begin, end) in enumerate(zip(ends - sizes, ends)):
                want = frozenset(shingle_set(texts[first + i]))
                assert len(want) == end - begin
                assert names.setdefault(want, tuple(tokens[begin:end])) == tuple(tokens[begin:end])
                seen += 1
        assert seen == len(texts)
    assert len(set(names.values())) == len(names)


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (5, 6), (6, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {1000 + i: 1000 for i in range(200)} | {5: 5, 6: 5}
