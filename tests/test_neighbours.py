import math
import random
from collections import Counter

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tideline.operators import neighbours, resample, sampling

SCHEMA = "id long, v array<double>, y int"


def cloud(n, seed, copies=0, grid=None):
    """Random points; the first ``copies`` rows share one vector, a grid forces ties."""
    rng = random.Random(seed)
    make = (lambda: float(rng.randrange(grid))) if grid else (lambda: rng.gauss(0, 1))
    points = [(i, [make() for _ in range(3)], int(rng.random() < 0.3)) for i in range(n)]
    return [(i, points[0][1] if i < copies else v, y) for i, v, y in points]


def brute(data, k, asked=None, own=True):
    out = {}
    for i, v, _ in asked if asked is not None else data:
        ranked = sorted((math.dist(v, w), j) for j, w, _ in data if not (own and j == i))
        out[i] = [j for _, j in ranked[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.id, r["rank"])):
        out.setdefault(r.id, []).append(r.neighbour)
    return out


@pytest.mark.parametrize(
    "data, k, search",
    [
        (cloud(60, 1), 4, {}),
        (cloud(200, 2), 5, {"block_rows": 16, "pivots": 9}),
        (cloud(150, 3, copies=60), 5, {"block_rows": 16, "pivots": 5}),  # a third are copies
        (cloud(150, 4, grid=3), 6, {"block_rows": 32, "pivots": 4}),  # ties and copies everywhere
        (cloud(50, 5, copies=50), 3, {"pivots": 3}),  # one vector only
        (cloud(4, 6), 9, {}),  # fewer rows than neighbours asked for
    ],
)
def test_nearest_neighbours_are_exact(rows, data, k, search):
    assert found(neighbours.nearest_neighbours(rows(data, SCHEMA), "id", "v", k, **search)) == brute(data, k)


def test_neighbours_of_other_rows(rows):
    data, asked = cloud(120, 7, copies=30), [(1000 + i, v, y) for i, v, y in cloud(40, 8)]
    asked[3] = (1003, data[0][1], 0)  # equal to a known vector
    got = neighbours.nearest_neighbours(rows(data, SCHEMA), "id", "v", 4, rows(asked, SCHEMA), block_rows=16, pivots=6)
    assert found(got) == brute(data, 4, asked, own=False)


def test_rows_without_a_vector_are_left_out(rows):
    df = rows([(1, [0.0], 0), (2, None, 0), (3, [1.0], 1)], SCHEMA)
    assert found(neighbours.nearest_neighbours(df, "id", "v", 1)) == {1: [3], 3: [1]}
    assert neighbours.nearest_neighbours(df.where("id = 2"), "id", "v", 1).count() == 0


def test_spread_scaling_ignores_constant_positions(rows):
    df = rows([(1, [0.0, 5.0], 0), (2, [2.0, 5.0], 0)], SCHEMA)
    assert [r.v for r in neighbours.spread_scaled(df, "v").orderBy("id").collect()] == [[0.0, 0.0], [0.5, 0.0]]


def test_label_degree(rows):
    data = cloud(80, 9)
    got = {r.id: r.degree for r in neighbours.label_degree(rows(data, SCHEMA), "id", "v", "y").collect()}
    spread = [4 * math.sqrt(sum((v[d] - sum(w[d] for _, w, _ in data) / 80) ** 2 for _, v, _ in data) / 80) for d in range(3)]
    scaled = [(i, [x / s for x, s in zip(v, spread)], y) for i, v, y in data]
    label = {i: y for i, _, y in data}
    table = {5: 0.1, 4: 0.25, 3: 0.4, 2: 0.6, 1: 0.8, 0: 1.0}
    for i, near in brute(scaled, 5).items():
        assert got[i] == table[abs(5 * label[i] - sum(label[j] for j in near))]


def lof_by_hand(data, k):
    near = brute(data, k)
    at = {i: v for i, v, _ in data}
    reach = {i: math.dist(at[i], at[near[i][-1]]) for i in near}
    dense = {i: 1 / (sum(max(reach[j], math.dist(at[i], at[j])) for j in n) / len(n) + 1e-10) for i, n in near.items()}
    return {i: -sum(dense[j] for j in n) / len(n) / dense[i] for i, n in near.items()}


def test_outlier_factor_and_activations(rows):
    data = cloud(70, 10)
    want = lof_by_hand(data, 5)
    got = {r.id: r.lof for r in neighbours.outlier_factor(rows(data, SCHEMA), "id", "v", 5).collect()}
    assert got == pytest.approx(want)
    squashed = {r.id: r.lof for r in neighbours.outlier_factor(rows(data, SCHEMA), "id", "v", 5, "sigmoid").collect()}
    assert squashed[3] == pytest.approx(1 - 1 / (1 + math.exp(-want[3])))


def test_novelty_marks_far_rows(rows):
    data = cloud(80, 11)
    new = rows([(500, [0.0, 0.0, 0.0], 0), (501, [50.0, 50.0, 50.0], 0)], SCHEMA)
    got = {r.id: r.lof for r in neighbours.novelty_factor(rows(data, SCHEMA), new, "id", "v", 5).collect()}
    assert got[500] > 0 > got[501]


# -- resampling --------------------------------------------------------------------


def test_smote_balances_and_stays_between(rows):
    data = cloud(100, 12)
    df = rows(data, SCHEMA)
    at = {i: v for i, v, _ in data}
    label = {i: y for i, _, y in data}
    minority = [i for i in at if label[i] == 1]
    made = resample.smote(df, "id", "v", "y", k=4).collect()
    assert len(made) == 100 - 2 * len(minority)
    near = brute([p for p in data if p[2] == 1], 4)
    for r in made:
        a, b = at[r.id], at[r.neighbour]
        assert r.neighbour in near[r.id] and label[r.id] == 1
        step = [(x - p) / (q - p) for x, p, q in zip(r.vector, a, b)]
        assert max(step) - min(step) < 1e-6 and -1e-9 <= step[0] <= 1
    again = {(r.id, r.draw, tuple(r.vector)) for r in resample.smote(df.repartition(5), "id", "v", "y", k=4).collect()}
    assert again == {(r.id, r.draw, tuple(r.vector)) for r in made}


def test_borderline_and_adasyn_pick_the_right_rows(rows):
    data = cloud(120, 13)
    df = rows(data, SCHEMA)
    label = {i: y for i, _, y in data}
    against = {i: sum(label[j] == 0 for j in n) for i, n in brute(data, 10).items() if label[i] == 1}
    danger = {i for i, a in against.items() if 5 <= a < 10}
    made = resample.borderline_smote(df, "id", "v", "y").collect()
    assert {r.id for r in made} <= danger and len(made) == sum(y == 0 for y in label.values()) - len(against)
    hard = {i: sum(label[j] == 0 for j in n) / 5 for i, n in brute(data, 5).items() if label[i] == 1}
    gap = sum(y == 0 for y in label.values()) - len(hard)
    copies = Counter(r.id for r in resample.adasyn(df, "id", "v", "y").collect())
    for i, h in hard.items():
        assert copies[i] == math.floor(h / sum(hard.values()) * gap + 0.5)


def test_smote_nc_takes_the_neighbours_category(rows):
    data = [(i, v, y, "ab"[i % 2]) for i, v, y in cloud(80, 14)]
    df = rows(data, SCHEMA + ", c string")
    made = resample.smote_nc(df, "id", "v", "y", ["c"], k=3).collect()
    kinds = {i: c for i, _, _, c in data}
    assert made and all(r.c in "ab" and kinds[r.id] in "ab" for r in made)


def test_links_and_removals(rows):
    data = cloud(120, 15)
    df = rows(data, SCHEMA)
    label = {i: y for i, _, y in data}
    one = {i: n[0] for i, n in brute(data, 1).items()}
    links = {(i, j) for i, j in one.items() if one[j] == i and label[i] != label[j]}
    assert {(r.id, r.neighbour) for r in resample.tomek_links(df, "id", "v", "y").collect()} == links
    left = {r.id for r in resample.remove_tomek(df, "id", "v", "y").collect()}
    assert left == set(label) - {i for i, _ in links if label[i] == 0}

    three = brute(data, 3)
    differ = {i: [label[j] != label[i] for j in n] for i, n in three.items()}
    enn = {r.id for r in resample.edited_neighbours(df, "id", "v", "y").collect()}
    assert enn == {i for i in label if label[i] == 1 or not any(differ[i])}
    knn = {r.id for r in resample.all_knn(df, "id", "v", "y", kind="mode").collect()}
    out = {i for i in label if label[i] == 0 and any(2 * sum(differ[i][:m]) > m for m in (1, 2, 3))}
    assert knn == set(label) - out
    assert {r.id for r in resample.all_knn(df, "id", "v", "y").collect()} == enn


def test_near_miss_and_one_sided(rows):
    data = cloud(90, 16)
    df = rows(data, SCHEMA)
    label = {i: y for i, _, y in data}
    small = [p for p in data if p[2] == 1]
    at = {i: v for i, v, _ in data}
    large = [p for p in data if p[2] == 0]
    near = brute(small, 3, large, own=False)
    mean = sorted((sum(math.dist(at[i], at[j]) for j in n) / 3, i) for i, n in near.items())
    want = {i for _, i in mean[: len(small)]} | {i for i, _, _ in small}
    assert {r.id for r in resample.near_miss(df, "id", "v", "y").collect()} == want
    kept = {r.id for r in resample.one_sided_selection(df, "id", "v", "y").collect()}
    assert {i for i in label if label[i] == 1} <= kept < set(label)


def test_dispatch_by_name(rows):
    df = rows(cloud(60, 17), SCHEMA)
    both = resample.resample(df, "SMOTE", "id", "v", "y")
    assert both.groupBy("label").count().agg(F.count_distinct("count")).first()[0] == 1
    assert both.where("draw = 0").count() == 60
    tomek = resample.resample(df, "SMOTETomek", "id", "v", "y")
    assert tomek.count() <= both.count()
    assert sampling.class_sizes(resample.resample(df, "RandomUnderSampler", "id", "v", "y", ratio=1.0), "y")
    with pytest.raises(ValueError):
        resample.resample(df, "Nothing", "id", "v", "y")
    assert as_set(resample.resample(df, "NeighbourhoodCleaningRule", "id", "v", "y", k=3).select("id")) <= as_set(df.select("id"))
