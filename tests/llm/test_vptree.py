import numpy as np
import pytest

from tideline.llm import vptree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, step=50):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and len(v)]
    good = [(i, np.array([np.nan if x is None else x for x in v], dtype=np.float64)) for i, v in good]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for q, a in good:
        if q % step == 0:
            near = [(-(a @ b) / np.sqrt(a @ a) / np.sqrt(b @ b), i) for i, b in good if i != q and len(b) == len(a)]
            near = sorted((round(s, 12), i) for s, i in near)[:k]
            out[q] = near
    return out


def run(spark, rows, k=5, factor=1.0, shard_rows=100):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    vectors = vptree.usable(df)
    index = vptree.build(vectors, k, shard_rows)
    out = {}
    for r in vptree.search(index, vectors.where("id % 50 = 0"), k, factor, query_rows=7).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((round(-r["score"], 12), r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def clustered(n, dim, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim))
    return [(i, [float(x) for x in (centres[i % 12] + 0.2 * draw.normal(size=dim)).astype(np.float32)]) for i in range(n)]


def test_factor_one_is_exact(spark):
    rows = clustered(700, 16)
    assert run(spark, rows) == brute(rows, 5)


def test_smaller_factor_keeps_recall(spark):
    rows = clustered(900, 24, seed=3)
    want, got = brute(rows, 5), run(spark, rows, factor=0.85)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_unusable_vectors_copies_and_ties(spark):
    rows = clustered(150, 8, seed=5)
    same = [1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0, 0.5]
    rows += [(200 + i, same) for i in range(120)] + [(1000 + i, [-x for x in same]) for i in range(3)]
    rows += [(2000, None), (2050, []), (2100, [0.0] * 8), (2150, [float("nan")] + same[1:]), (2200, [float("inf")] + same[1:])]
    rows += [(2250, [None] + same[1:]), (2300, [1.0, 2.0]), (2350, [2.0, 1.0]), (None, same), (2400, [5.0])]
    want = {q: near for q, near in brute(rows, 5).items() if near}
    assert run(spark, rows) == want
    assert [i for _, i in want[250]] == [200, 201, 202, 203, 204]


def test_ties_beyond_any_list_go_to_the_smaller_ids(spark):
    direction = [0.3, -1.7, 0.11, 2.5]
    for scale in (lambda i: 2.0 ** (i % 37), lambda i: 1.0 + i):  # the same direction, exactly and but for rounding
        rows = [(0, [0.31, -1.69, 0.12, 2.5])] + [(i, [x * scale(i) for x in direction]) for i in range(1, 130)] + [(500, [1.0, 0.0, 0.0, 0.0])]
        df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
        vectors = vptree.usable(df)
        scores = {i: float(vptree.cosine(np.array([rows[0][1]]), np.array([v]))[0]) for i, v in rows}
        want = sorted((i for i in scores if i), key=lambda i: (-scores[i], i))[:5]
        for factor in (1.0, 0.85):
            got = vptree.search(vptree.build(vectors, 5, 64), vectors.where("id = 0"), 5, factor).orderBy("rank").collect()
            assert [r["vec_id"] for r in got] == want
            assert [r["score"] for r in got] == [scores[i] for i in want]


def test_regions_out_of_reach_are_not_visited(spark):
    draw = np.random.default_rng(8)
    centres = np.eye(16)[:12]
    rows = [(i, [float(x) for x in centres[i % 12] + 0.02 * draw.normal(size=16)]) for i in range(1200)]
    vectors = vptree.usable(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    index = vptree.build(vectors, 5, 60)
    broken = vptree.Index(index.trees, index.centres, index.radius, index.parts)
    # A tree that no query of region 0 may need: its bytes are gone, and the search does not notice.
    asked = vectors.where("id = 600")
    home = vptree.regions(asked, index.centres).first()
    far = np.sqrt(np.maximum(0, 2 - 2 * index.centres[16] @ (np.array(home["vector"]) / np.linalg.norm(home["vector"]))))
    keep = [int(r) for r in np.flatnonzero(far < 1.0)]
    broken.trees = index.trees.where(index.trees["region"].isin(keep))
    want = [r["vec_id"] for r in vptree.search(index, asked, 5).orderBy("rank").collect()]
    assert len(keep) < len(far)
    assert [r["vec_id"] for r in vptree.search(broken, asked, 5).orderBy("rank").collect()] == want
    assert want == [i for _, i in brute(rows, 5)[600]]


def test_fewer_candidates_than_asked_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0])]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, []) == {}


def test_numbers_at_the_ends_of_the_range(spark):
    df = spark.createDataFrame([(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1e300, 0.0])], "vec_id long, embedding array<double>")
    vectors = vptree.usable(df)
    index = vptree.build(vectors, 5)
    got = [(r["vec_id"], r["score"]) for r in vptree.search(index, vectors.where("id = 0"), 5).orderBy("rank").collect()]
    assert [i for i, _ in got] == [1, 2]
    assert got[0][1] == pytest.approx(1.0) and got[1][1] == pytest.approx(np.sqrt(0.5))
