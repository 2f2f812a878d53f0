import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    good = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    good.sort(key=order)
    lengths = Counter(len(v) for _, v, _ in good if v and len(v) % parts == 0)
    size = min(lengths, key=lambda n: (-lengths[n], n)) if lengths else 0
    good = [r for r in good if size and len(r[1]) == size]
    if not good:
        return []
    width = size // parts
    points = [[math.floor(4096 * x) for x in v] for _, v, _ in good]
    cut = lambda p, k: points[p][k * width : (k + 1) * width]
    books = [[cut(p, k) for p in range(min(entries, len(points)))] for k in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            groups = {}
            for p in range(len(points)):
                groups.setdefault(nearest(cut(p, k), books[k])[1], []).append(cut(p, k))
            for e, members in groups.items():
                books[k][e] = [sum(c) // len(members) for c in zip(*members)]
    sha = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    out = []
    for p, (i, _, label) in enumerate(good):
        found = [nearest(cut(p, k), books[k]) for k in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    return sorted(((i, code, error, total[label], sha) for i, code, error, label in out), key=repr)


def run(df, **options):
    rows = vector_codes.compress(df, **options).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def vectors(n, dim, seed=0, labels=4):
    draw = np.random.default_rng(seed)
    return [(i, draw.normal(size=dim).tolist(), int(draw.integers(labels))) for i in range(n)]


def test_codes_equal_a_plain_computation(spark):
    rows = vectors(150, 24)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_ties_copies_nulls_and_unusable_vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) / 4096 for x in draw.integers(-2, 3, 16)], [None, 1, 2][i % 3]) for i in range(120)]
    same = rows[0][1]
    rows += [(i, same, 1) for i in range(200, 260)] + [(300, same, None), (300, same, None), (None, rows[5][1], 1), (None, same, 7)]
    rows += [(400, None, 1), (401, [float("nan")] * 16, 1), (402, [float("-inf")] * 16, 1), (403, [None] * 16, 1), (404, [], 1), (405, [1.0] * 8, 1), (-9, [], 1), (-8, [2.0] * 5, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"code": F.lit("x"), "spread": F.lit(3), "point": F.lit(0)})
    assert run(df) == brute(rows)


def test_few_rows_and_other_sizes(spark):
    rows = vectors(5, 16, 3)
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    rows = vectors(80, 12, 4)
    assert run(spark.createDataFrame(rows, SCHEMA), parts=4, entries=5, rounds=2) == brute(rows, 4, 5, 2)
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame(vectors(9, 12), SCHEMA)) == []  # twelve components have no eight equal parts
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame(rows, SCHEMA), entries=300)


def test_very_large_components_are_limited(spark):
    rows = [(i, [1e300 * (-1) ** i] * 16, 0) for i in range(40)]
    got = run(spark.createDataFrame(rows, SCHEMA))
    assert len(got) == 40 and all(error == 0 for _, _, error, _, _ in got)


def test_nearest_visits_only_what_the_bound_leaves(monkeypatch):
    draw = np.random.default_rng(5)
    points, book = draw.integers(-4000, 4000, (500, 8)), draw.integers(-4000, 4000, (16, 8))
    full = ((points[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    found, best = vector_codes.nearest(points, book)
    assert (best == full.min(axis=1)).all() and (found == full.argmin(axis=1)).all()
    seen = []
    monkeypatch.setattr(np, "einsum", lambda s, a, b, real=np.einsum: (seen.append(len(a)), real(s, a, b))[1])
    vector_codes.nearest(points, book)
    assert sum(seen) < points.shape[0] * len(book) * 0.9
