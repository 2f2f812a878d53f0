import random
import re
from collections import Counter

import pytest

from tideline.llm import mixing


def want_targets(sizes, epochs=3):
    """Targets by the stated rule: share by weight, stop at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, total, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        part = {s: (total - sum(target.values())) * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if part[s] > epochs * sizes[s]}
        if not over:
            target |= part
            break
        target |= {s: epochs * sizes[s] for s in over}
        open_ -= over
    return target


def corpus(prose, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(600):
        source = draw.choice(["hot"] * 12 + ["a", "B", "é", "tiny", None, "z1", "z2"])
        rows.append((i, prose(i, 3 if source == "tiny" else draw.randrange(0, 80)) or None, "en", source, 0))
    return rows + [(9000, "one", "en", "single", 0), (9001, "", "en", "blank", 0), (9002, prose(3, 4000), "en", "hot", 0)]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_targets_and_taken_words(spark, prose):
    rows = corpus(prose)
    docs = spark.createDataFrame(rows, DOCS)
    laid, drawn = mixing.draws(docs, block_words=50, shard_words=2000)
    got = mixing.taken_words(laid, drawn).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    source = {r[0]: r[3] for r in rows}
    sizes = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    target = want_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["size"] == size[r["doc_id"]]
        assert r["source_size"] == sizes[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    largest = {s: max(size[i] for i in size if source[i] == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]
    again = mixing.taken_words(*mixing.draws(docs.repartition(3), block_words=50, shard_words=2000)).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}


def test_shards_are_even_and_blocks_are_drawn_once(spark, prose):
    docs = spark.createDataFrame(corpus(prose, 2), DOCS)
    laid, drawn = mixing.draws(docs, block_words=50, shard_words=1500)
    blocks = (
        drawn.join(laid.where("size > 0"), ["pos", "start"])
        .selectExpr("pos", "struct(epoch, floor(start / 50)) AS block", "shard", "start", "epoch", "place")
        .collect()
    )
    assert len({(r["pos"], r["start"], r["epoch"]) for r in blocks}) == len(blocks)
    shard_of = {}
    for r in blocks:
        assert shard_of.setdefault((r["pos"], r["block"]), r["shard"]) == r["shard"]
    counts = {}
    for shard in shard_of.values():
        counts[shard] = counts.get(shard, 0) + 1
    assert sorted(counts) == list(range(len(counts))) and len(counts) > 8
    # Every level rounds its quota to whole blocks.
    assert max(counts.values()) - min(counts.values()) <= 4
    for shard in counts:
        places = sorted(r["place"] for r in blocks if r["shard"] == shard)
        assert places == list(range(1, len(places) + 1))


def test_what_is_taken_follows_the_quotas_of_the_tree(spark, prose, monkeypatch):
    docs = spark.createDataFrame(corpus(prose, 3), DOCS)
    options = dict(block_words=50, shard_words=1500)
    words = lambda: {r["source"]: r["w"] for r in mixing.taken_words(*mixing.draws(docs, **options)).groupBy("source").sum("taken").toDF("source", "w").collect()}
    whole, real = words(), mixing.split
    # A tree that loses every unit of its last shard loses those words.
    def lossy(units, *args):
        dealt = real(units, *args)
        return dealt.where(dealt["shard"] < dealt.agg({"shard": "max"}).first()[0])

    monkeypatch.setattr(mixing, "split", lossy)
    less = words()
    assert sum(less.values()) < sum(whole.values()) and all(less[s] <= whole[s] for s in whole)


def test_quotas_are_dealt_as_runs_of_the_random_order(spark, prose):
    docs = spark.createDataFrame(corpus(prose, 4), DOCS)
    laid, _ = mixing.draws(docs, block_words=50, shard_words=1500)
    full = laid.where("size > 0").selectExpr("*", "floor(start / 50) AS block")
    quotas = mixing.block_quotas(full)
    units = mixing.split(quotas.selectExpr("pos", "rank AS unit", "words"), 1500)
    asked = {(r["pos"], r["shard"]): r["count"] for r in units.groupBy("pos", "shard").count().collect()}
    runs = {}
    for r in mixing.deal(quotas, units).collect():
        runs.setdefault((r["pos"], r["shard"]), []).append(r["rank"])
    assert {k: len(v) for k, v in runs.items()} == asked
    for ranks in runs.values():
        assert sorted(ranks) == list(range(min(ranks), max(ranks) + 1))
    last = {r["pos"]: r["rank"] for r in quotas.groupBy("pos").max("rank").toDF("pos", "rank").collect()}
    partial = {(r["pos"], r["rank"]) for r in quotas.where("room < words").collect()}
    assert partial <= set(last.items())


def test_mix_repeats_rows_and_keeps_their_columns(spark, prose):
    rows = [(1, "a b c", "s", 5), (1, "a b c", "s", 6), (1, "d e", "s", 7), (None, "f g", None, 8), (2, None, "s", 9), (3, "", "t", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int").withColumnRenamed("epoch", "copy")
    mixed = mixing.mix(docs.selectExpr("*", "copy AS place"))
    assert mixed.columns == ["doc_id", "text", "source", "copy", "epoch", "shard", "place"]
    got = mixed.collect()
    assert {r["copy"] for r in got} <= {5, 6, 7, 8}
    laid, drawn = mixing.draws(docs)
    taken = sum(r["taken"] for r in mixing.taken_words(laid, drawn).collect())
    assert taken == sum(len(r["text"].split()) for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mixing.taken_words(*mixing.draws(docs)).collect() == []
    assert mixing.mix(docs).collect() == []


def test_missing_and_repeated_ids_are_not_ranked_in_one_task(spark, prose):
    rows = [(None, prose(i, 30), "a", "en") for i in range(60)] + [(7, prose(100, 20), None, lang) for lang in ["en", "en", "fr"] * 20]
    rows += [(7, prose(200 + i, 20), "b", "de") for i in range(20)] + [(None, None, None, None), (7, "", "b", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(5)
    options = dict(epochs=1, block_words=64, shard_words=500, weights=(1.0,))
    laid, drawn = mixing.draws(docs, **options)
    # Rows without an id lie in an order of their own text, and only exact repeats are copies.
    assert {r["copy"] for r in laid.where("doc_id is null").collect()} == {1}
    assert laid.count() == len(rows) and laid.select("pos", "start", "size").where("size > 0").distinct().count() == len(rows) - 2
    mixed = mixing.mix(docs, **options)
    assert mixed.count() == drawn.count() > 0
    took = Counter(tuple(r)[:4] for r in mixed.collect())
    have = Counter(rows)
    assert all(n <= have[row] for row, n in took.items())
    assert sum(took.values()) > 100
