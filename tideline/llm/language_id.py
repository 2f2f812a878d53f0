"""Language identification with a string kernel.

The kernel of two texts blends, for n = 1, 2, 3, the presence of character
n-grams: ``|G_n(x) & G_n(y)| / sqrt(|G_n(x)| |G_n(y)|)``, averaged over n.
N-grams are hashed to ``SLOTS`` places of each order, so in long texts of
large scripts different ones can share a place.  A bounded sample of labelled rows
gives the landmarks (Nystroem) and the training rows of a one-versus-rest
kernel ridge regression.

The score of a text is ``k(x, landmarks) A W``.  The landmark matrix, the
Nystroem root ``A`` and the ridge weights ``W`` do not depend on ``x``, so
they are multiplied once into a table of one row per n-gram place; a batch of
texts is then scored by the product of its presence matrix with that table.
The matrix is sparse and only holds ones, so the product gathers the rows of
the table and adds them up for each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import materialize

ORDERS = (1, 2, 3)
SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
#: The prediction for null texts and texts without a letter.
UNKNOWN = "und"
#: Arrow batches of this many texts are scored by one product.
BATCH = 256


def present(text: str) -> list[np.ndarray]:
    """Per order: the sorted places of the n-grams of a whole text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out, rolled = [], np.zeros(len(points), dtype=np.uint32)
    for n in ORDERS:
        if len(points) < n:
            out.append(np.zeros(0, dtype=np.int64))
            continue
        rolled = rolled[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :] + np.uint32(n)
        places = (rolled * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)
        seen = np.zeros(SLOTS, dtype=bool)
        seen[places] = True
        out.append(np.flatnonzero(seen))
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class LanguageModel:
    """``table`` has a row for each order and place, then one of constants, and a column for each language."""

    languages: tuple[str, ...]
    table: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        """One row of one-versus-rest scores per text."""
        total = np.repeat(self.table[-1:].astype(np.float64), len(texts), axis=0)
        grams = [present(t) for t in texts]
        for i in range(len(ORDERS)):
            places = [g[i] for g in grams]
            counts = np.array([len(p) for p in places])
            full = counts > 0
            if not full.any():
                continue
            rows = self.table[i * SLOTS + np.concatenate(places)]
            starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
            total[full] += np.add.reduceat(rows, starts, axis=0) / np.sqrt(counts[full])[:, None]
        return total


def sample(labelled: DataFrame, text: str, label: str, per_language: int, max_languages: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Up to ``per_language`` distinct texts of each label, or of the ``max_languages`` most frequent ones.

    Where that can be more than ``max_rows``, every label gives fewer, but one at least.

    The texts with the smallest hashes are taken, so reruns agree and copies
    of a text count once.
    """
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.col(text) != "")).select(
        F.col(label).cast("string").alias("label"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("texts"))
    if max_languages is not None:
        sizes = sizes.orderBy(F.desc("n"), "label").limit(max_languages)
    if max_rows is not None:
        sizes = materialize(sizes, "labels")
        per_language = max(1, min(per_language, max_rows // max(1, sizes.count())))
    # Only the lowest hashes are ranked: about four times as many as are taken, however large the label is.
    share = F.col("h") / F.lit(2.0**64) + 0.5
    by_hash = Window.partitionBy("label").orderBy("h")
    kept = (
        rows.join(F.broadcast(sizes), "label")
        .where(share * F.col("texts") <= 4 * per_language + 100)
        .select("label", "h")
        .distinct()
        .withColumn("place", F.row_number().over(by_hash))
        .where(F.col("place") <= per_language)
        .select("label", "h")
    )
    # At most per_language pairs of numbers for each label, so the texts are not shuffled.
    return rows.join(F.broadcast(kept), ["label", "h"]).dropDuplicates(["label", "h"])


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    per_language: int = 300,
    landmarks_per_language: int = 32,
    max_rows: int = 9600,
    max_landmarks: int = 1024,
    ridge: float = 1e-2,
) -> LanguageModel:
    """Fit on every label that has a text, with at most ``max_rows`` rows, or one of each label if that is more.

    What the driver gets is bounded by that number of rows and ``3 * SLOTS``
    places for each, whatever the size of the table or of a text; the model
    has ``3 * SLOTS`` weights for each label.
    """

    @F.arrow_udf("array<array<int>>")
    def places(texts: pa.Array) -> pa.Array:
        found = [[p.astype(np.int32) for p in present(t.as_py())] for t in texts]
        return pa.array(found, pa.list_(pa.list_(pa.int32())))

    chosen = sample(labelled, text, label, per_language, max_rows=max_rows)
    got = sorted(chosen.select("label", "h", places("text").alias("places")).collect(), key=lambda r: (r["label"], r["h"]))
    languages = tuple(sorted({r["label"] for r in got}))
    if not languages:
        return LanguageModel((), np.zeros((len(ORDERS) * SLOTS + 1, 0), dtype=np.float32))

    def matrix(rows) -> np.ndarray:
        """Presence rows, scaled so that the product of two matrices is the kernel."""
        out = np.zeros((len(rows), len(ORDERS) * SLOTS), dtype=np.float32)
        for i, r in enumerate(rows):
            for n, found in enumerate(r["places"]):
                if found:
                    out[i, n * SLOTS + np.asarray(found)] = 1.0 / np.sqrt(len(found) * len(ORDERS))
        return out

    landmarks_per_language = max(1, min(landmarks_per_language, max_landmarks // len(languages)))
    landmarks = matrix([r for lang in languages for r in [x for x in got if x["label"] == lang][:landmarks_per_language]])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    root = vectors * (1.0 / np.sqrt(np.maximum(values, 1e-9)))
    kernel = np.concatenate([matrix(got[i : i + 64]) @ landmarks.T for i in range(0, len(got), 64)]).astype(np.float64)
    phi = np.hstack([kernel @ root, np.ones((len(got), 1))])
    target = np.array([[float(r["label"] == lang) for lang in languages] for r in got])
    # Every language weighs the same, however many rows it has.
    weight = (1.0 / target.sum(axis=0))[target.argmax(axis=1)][:, None]
    penalty = ridge * np.eye(phi.shape[1]) * weight.sum() / len(languages)
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(phi.T @ (phi * weight) + penalty, phi.T @ (target * weight))
    table = (landmarks.T @ (root @ solved[:-1])).astype(np.float32) / np.float32(np.sqrt(len(ORDERS)))
    return LanguageModel(languages, np.vstack([table, solved[-1:].astype(np.float32)]))


def predict(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) from the whole text.

    A null text, a text without a letter and any text under a model without
    languages is ``und`` with score 0.  Scores that tie go to the language
    first in order.  Rows are neither dropped nor merged; input columns named
    lang_pred or score are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for texts in batches:
            langs, scores = [], []
            # A few texts at a time are Python strings; the rest stay as they came.
            for start in range(0, len(texts), BATCH):
                part = texts.slice(start, BATCH).to_pylist()
                known = [i for i, t in enumerate(part) if fitted.languages and has_letter(t)]
                lang, score = [UNKNOWN] * len(part), [0.0] * len(part)
                if known:
                    found = fitted.score([part[i] for i in known])
                    for i, best, row in zip(known, found.argmax(axis=1), found):
                        lang[i], score[i] = fitted.languages[best], float(min(1.0, max(0.0, row[best])))
                langs += lang
                scores += score
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    return df.withColumn("__found", label(F.col(text))).select(*kept, "__found.lang_pred", "__found.score")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: How far above chance a score must be, as a share of the way to the low scores of known languages.
ABOVE_CHANCE = 0.1


def least_score(docs: DataFrame, model: LanguageModel, share: float = ABOVE_CHANCE) -> float:
    """The score below which no language can be told, from all held-out rows that the model gets right.

    The scores of a text add up to one, so the best of them is at least chance,
    which is what a text gets of which nothing is known.  The score of one
    right answer in a hundred lies below ``low``; the limit is ``share`` of the
    way from chance to it.
    """
    if len(model.languages) < 2:
        return 0.0
    held = docs.where(held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("lang", "text")
    right = predict(held, model).where(F.col("lang") == F.col("lang_pred"))
    low = right.agg(F.percentile_approx("score", 0.01, 10_000)).first()[0]
    chance = 1 / len(model.languages)
    return chance + share * max(0.0, low - chance) if low is not None else 0.0


def keep_identified(docs: DataFrame, share: float = ABOVE_CHANCE) -> DataFrame:
    """The documents whose language is identified, with the columns they came with.

    The model is fitted on the rows of ``docs`` that have a language and are
    not held out; the held-out ones say which scores count (``least_score``).
    Null texts, texts without a letter and texts of which no language can be
    told, as of a script that was not learned, go.  If no language could be
    learned, all texts with a letter stay.  An empty table gives no rows.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    whole = docs.select(F.struct(*docs.columns).alias("__row"), F.col("text").alias("__text"))
    if not model.languages:

        @F.arrow_udf("boolean")
        def lettered(texts: pa.Array) -> pa.Array:
            return pa.array([has_letter(t.as_py()) for t in texts], pa.bool_())

        return whole.where(lettered("__text")).select("__row.*")
    limit = least_score(docs, model, share)
    kept = predict(whole, model, "__text").where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= limit))
    return kept.select("__row.*")
