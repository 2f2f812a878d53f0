import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import importance, radix_sort

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def brute(rows, target, percent=10, min_words=20, buckets=10_000):
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for w in words(text):
            s[bucket(w)] += 1
    for text in target:
        for w in words(text):
            t[bucket(w)] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        found = words(text)
        weight = sum(gain[bucket(w)] for w in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r) for r in out), key=repr)


def corpus(prose):
    draw = random.Random(1)
    rows = [(i, prose(i, draw.randrange(5, 80), 300)) for i in range(250)]
    rows += [(-5, "Übung macht den Meister, 42 Mal. " * 9), (2**60, "naïve café " * 15), (500, None), (501, ""), (502, "\n\t .,;"), (503, "A" * 70_000)]
    rows += [(504, "word " * 40_000), (505, ("y" * 5_000 + "-") * 600), (None, "no id at all " * 8)]
    return rows


def run(spark, make_docs, rows, target, **options):
    targets = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    out = importance.resample(make_docs(rows).repartition(7), targets, **options)
    return sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_scores_and_draw_equal_a_plain_computation(spark, make_docs, prose):
    rows, target = corpus(prose), [prose(1, 60, 300), prose(3, 60, 300), None, "Übung 42"]
    got = run(spark, make_docs, rows, target)
    assert got == brute(rows, target)
    assert sum(r[4] is not None for r in got) == sum(r[1] >= 20 for r in got) // 10


def test_few_buckets_many_ties_and_extra_columns(spark, make_docs):
    rows = [(i, "one two three four " * 5) for i in range(120)] + [(7, "one two three four " * 5)]
    target = ["one two"]
    assert run(spark, make_docs, rows, target, buckets=3, percent=50) == brute(rows, target, 50, buckets=3)
    extra = make_docs(rows).withColumns({"score": F.lit("x"), "row": F.lit(1), "rank": F.lit(0), "pos": F.lit(2)})
    assert importance.resample(extra, make_docs([(1, "one")])).count() == 121


def test_empty_tables(spark, make_docs, prose):
    assert run(spark, make_docs, [], ["a"]) == []
    rows = [(i, prose(i, 30)) for i in range(20)]
    assert run(spark, make_docs, rows, []) == brute(rows, [])


def test_words_across_pass_borders(monkeypatch):
    monkeypatch.setattr(importance, "PASS_BYTES", 16)
    texts = ["alpha beta gamma delta epsilon", None, "", "x" * 100 + " tail", "é" * 30, "ab", "cd ef", "A,B;c"]
    found = [[] for _ in texts]
    for owner, buckets in importance.word_buckets(pa.array(texts, pa.string()), 1 << 31):
        for o, b in zip(owner.tolist(), buckets.tolist()):
            found[o].append(b)
    assert found == [[zlib.crc32(w.encode()) % (1 << 31) for w in words(t)] for t in texts]


def test_crc_of_random_bytes():
    draw = np.random.default_rng(0)
    raw = draw.integers(0, 256, 5_000, dtype=np.uint8)
    starts = draw.integers(0, 4_900, 200)
    lengths = draw.integers(1, 100, 200)
    want = [zlib.crc32(raw[s : s + n].tobytes()) for s, n in zip(starts, lengths)]
    assert importance.crc32_of(raw, starts, lengths).tolist() == want


@pytest.mark.parametrize("block", [1 << 18, 7])
def test_radix_ranks_equal_a_sort(spark, monkeypatch, block):
    monkeypatch.setattr(radix_sort, "BLOCK_ROWS", block)
    draw = random.Random(4)
    rows = [(i, draw.choice([None, -(2**63), 2**63 - 1, -1, 0, 1, draw.randrange(-10**6, 10**6)]), draw.choice([None, 5, -5, 2**40 + i])) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, a long, b long").repartition(3)
    got = {r.k: r["rank"] for r in radix_sort.radix_ranks(df, [("a", True), ("b", False)]).collect()}
    key = {i: (a is None, -(a or 0), b is None, b or 0) for i, a, b in rows}
    assert sorted(got.values()) == list(range(1, 301))
    order = sorted(got, key=got.get)
    assert all(key[x] <= key[y] for x, y in zip(order, order[1:]))
    assert radix_sort.radix_ranks(df.limit(0), [("a", True)]).count() == 0
    with pytest.raises(ValueError):
        radix_sort.radix_ranks(df.withColumn("pos", F.lit(1)), [("a", True)])
