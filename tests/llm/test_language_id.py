import random
import zlib

import numpy as np

from tideline.llm import language_id

DOCS = "doc_id long, text string, lang string, score string"
SOUNDS = {"aa": ["ka", "lo", "mi", "tar"], "bb": ["sch", "ung", "ein", "ßö"], "cc": ["eau", "oix", "é", "que"]}


def corpus(n=240):
    draw = random.Random(6)
    rows = []
    for i in range(n):
        lang = draw.choice(["aa"] * 8 + ["bb", "cc"])
        words = ["".join(draw.choices(SOUNDS[lang], k=draw.randrange(1, 4))) for _ in range(draw.randrange(5, 60))]
        rows.append((i, " ".join(words), lang, "x"))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(docs.where(~language_id.held_out(docs["doc_id"])))
    assert model.languages == ("aa", "bb", "cc")
    out = language_id.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    held = out.where(language_id.held_out(out["doc_id"])).collect()
    assert len(held) > 40
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.collect())


def test_score_equals_the_kernel_expansion(spark):
    """The table of n-gram weights gives what the kernel with the landmarks gives."""
    rows = corpus(60)
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(docs, landmarks_per_language=4)
    texts = [t for _, t, _, _ in rows[:10]] + ["k", "ka lo " * 3000]
    for text, row in zip(texts, model.score(texts)):
        grams = language_id.present(text)
        total = model.table[-1].astype(float).copy()
        for n, places in enumerate(grams):
            for place in places:
                total += model.table[n * language_id.SLOTS + place] / np.sqrt(len(places))
        assert np.allclose(total, row, atol=1e-4)


def test_scores_equal_a_plain_kernel_machine(spark):
    """Kernel, landmarks, root and ridge regression written out on sets of n-grams, without the model's table or hashing."""
    rows = corpus(120)
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(docs, per_language=12, landmarks_per_language=5, ridge=0.05)
    chosen = sorted(language_id.sample(docs, "text", "lang", 12, max_rows=9600).collect(), key=lambda r: (r["label"], r["h"]))
    grams = lambda t: [{t.lower()[i : i + n] for i in range(len(t) - n + 1)} for n in (1, 2, 3)]

    def kernel(a, b):
        parts = zip(grams(a), grams(b))
        return sum(len(x & y) / np.sqrt(len(x) * len(y)) if x and y else 0.0 for x, y in parts) / 3

    langs = sorted({r["label"] for r in chosen})
    landmarks = [r["text"] for lang in langs for r in [x for x in chosen if x["label"] == lang][:5]]
    between = np.array([[kernel(a, b) for b in landmarks] for a in landmarks])
    # The root of the inverse by its singular values; the ridge problem as a stacked least squares problem.
    u, values, _ = np.linalg.svd(between)
    root = u / np.sqrt(values)
    phi = np.hstack([np.array([[kernel(r["text"], m) for m in landmarks] for r in chosen]) @ root, np.ones((len(chosen), 1))])
    target = np.array([[float(r["label"] == lang) for lang in langs] for r in chosen])
    weight = np.array([1 / sum(x["label"] == r["label"] for x in chosen) for r in chosen])
    strength = np.sqrt(0.05 * weight.sum() / len(langs)) * np.eye(phi.shape[1])
    strength[-1, -1] = 0.0
    a = np.vstack([phi * np.sqrt(weight)[:, None], strength])
    b = np.vstack([target * np.sqrt(weight)[:, None], np.zeros((phi.shape[1], len(langs)))])
    solved = np.linalg.lstsq(a, b, rcond=None)[0]
    texts = [t for _, t, _, _ in rows[:30]] + ["k", "ka lo " * 200, "schung é", "zzz"]
    want = np.array([np.append(np.array([kernel(t, m) for m in landmarks]) @ root, 1.0) @ solved for t in texts])
    got = model.score(texts)
    # Different n-grams may share a hashed place.
    assert model.languages == tuple(langs) and np.abs(got - want).max() < 0.03
    assert (got.argmax(axis=1) == want.argmax(axis=1))[:30].all()


def test_null_empty_letterless_and_long_texts(spark):
    model = language_id.fit(spark.createDataFrame(corpus(60), DOCS))
    rows = [(1, None), (2, ""), (3, "12 34 $$$"), (4, "eau que " * 40_000), (None, "x"), (4, "é"), (5, "1" * 90_000 + "ß")]
    got = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert [r["lang_pred"] == "und" for r in got] == [True, True, True, False, False, False, False]
    assert got[3]["lang_pred"] == "cc" and [r["score"] for r in got[:3]] == [0.0] * 3


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc", None, "")], DOCS)
    model = language_id.fit(docs)
    assert [r["lang_pred"] for r in language_id.predict(docs, model).collect()] == ["und"]
    empty = spark.createDataFrame([], DOCS)
    assert language_id.predict(empty, language_id.fit(empty)).collect() == []
    assert language_id.keep_identified(empty).collect() == []


def test_sample_is_bounded_and_skips_copies(spark):
    rows = [(i, "same text here", "aa", "") for i in range(500)] + [(1000 + i, f"text {i}", "aa", "") for i in range(300)]
    rows += [(2000 + i, f"other {i}", f"l{i % 40:02}", "") for i in range(200)]
    got = language_id.sample(spark.createDataFrame(rows, DOCS), "text", "lang", per_language=20, max_languages=8).collect()
    per = {}
    for r in got:
        per[r["label"]] = per.get(r["label"], 0) + 1
    assert len(per) == 8 and per["aa"] == 20 and max(per.values()) <= 20
    assert len({(r["label"], r["text"]) for r in got}) == len(got)


def test_keep_identified_keeps_columns_and_clean_documents(spark):
    rows = corpus(80) + [(900, None, "aa", "s"), (901, "123", None, "s"), (902, "", "bb", "s")]
    docs = spark.createDataFrame(rows, DOCS)
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(80))


def test_texts_of_scripts_that_were_not_learned_go(spark):
    rows = corpus(150)
    strange = [(1000, "今天天气很好我们去公园散步吧", None, "s"), (1001, "Καλημέρα σε όλους τους φίλους", None, "s"), (1002, "привет как дела сегодня", "ru", "s")]
    docs = spark.createDataFrame(rows + strange[:2], DOCS)
    model = language_id.fit(docs.where(~language_id.held_out(docs["doc_id"])))
    limit = language_id.least_score(docs, model)
    assert 1 / 3 < limit < 0.5
    kept = {r["doc_id"] for r in language_id.keep_identified(docs).collect()}
    assert kept == {i for i, *_ in rows}
    # What is learned stays, also where it is rare.
    more = spark.createDataFrame(rows + [(2000 + i, f"привет как дела {i} сегодня друг", "ru", "s") for i in range(40)], DOCS)
    assert language_id.keep_identified(more).count() == len(rows) + 40


def test_keep_identified_keeps_texts_when_no_language_was_learned(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    for lang, ids in ((None, range(20)), ("aa", held)):
        rows = [(i, f"ka lo {i}", lang, "x") for i in ids] + [(900, None, None, "s"), (901, "123", None, "s"), (902, "", None, "s")]
        docs = spark.createDataFrame(rows, DOCS)
        assert sorted(r["doc_id"] for r in language_id.keep_identified(docs).collect()) == list(ids)


def test_every_label_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + 50 * (i % 40))}{chr(0x4E01 + 50 * (i % 40))}" * 4 + str(i), f"l{i % 40:02}", "") for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(docs, max_rows=80, max_landmarks=60)
    assert len(model.languages) == 40
    assert language_id.sample(docs, "text", "lang", 300, max_rows=80).count() == 80
    assert all(r["lang"] == r["lang_pred"] for r in language_id.predict(docs, model).collect())
