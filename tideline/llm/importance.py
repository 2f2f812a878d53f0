"""Importance resampling towards a target distribution.

Texts are seen as bags of words hashed into buckets.  The counts of each
bucket over all documents and over all target texts give a gain per bucket:
how much likelier the target makes it, in thousandths of a nat.  A document's
weight is the mean gain of its words.  With Gumbel noise from a hash of its id
added to the weight, the highest scores are a draw without replacement in
proportion to exp(weight).

Words are found, hashed and scored by passes over arrays of the raw UTF-8
bytes: word bytes are ASCII digits, letters and everything from 0x80 on.  The
driver and each task hold one number per bucket.  Ranks come from the
distributed radix sort, on slim rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.radix_sort import radix_ranks
from tideline.llm.shingles import text_blocks
from tideline.session import materialize

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

#: Bytes of a text that one pass over arrays works on; a cut never falls into a word.
PASS_BYTES = 1 << 20
#: Words up to this many bytes are hashed together, byte by byte of all words at once.
TOGETHER = 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()
WORD_BYTE = np.zeros(256, dtype=bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    WORD_BYTE[_low : _high + 1] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[0x41:0x5B] += 0x20


def crc32_of(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The crc32 of each word (start and length in ``raw``)."""
    state = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    short = np.flatnonzero(lengths <= TOGETHER)
    going, at = short, 0
    while len(going):
        now = state[going]
        state[going] = CRC[(now ^ raw[starts[going] + at]) & 0xFF] ^ (now >> np.uint32(8))
        at += 1
        going = going[lengths[going] > at]
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > TOGETHER):
        state[i] = zlib.crc32(raw[starts[i] : starts[i] + lengths[i]].tobytes())
    return state


def _passes(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut ``raw`` into passes that end where a word cannot go on."""
    begin = 0
    while begin < len(raw):
        end = min(begin + PASS_BYTES, len(raw))
        while end < len(raw) and WORD_BYTE[raw[end]]:
            # A long stretch without a break is looked through in strides.
            stop = min(end + PASS_BYTES, len(raw))
            breaks = np.flatnonzero(~WORD_BYTE[raw[end:stop]])
            end = end + int(breaks[0]) if len(breaks) else stop
        yield begin, end
        begin = end


def word_buckets(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of every word, a pass over arrays at a time."""
    for first, raw, at in text_blocks(column):
        raw = SMALL[raw]
        inner = at[1:-1]
        for begin, end in _passes(raw):
            word = WORD_BYTE[raw[begin:end]]
            opens = word.copy()
            opens[1:] &= ~word[:-1]
            # A word ends with its text.
            edges = inner[(inner > begin) & (inner < end)] - begin
            opens[edges] = word[edges]
            starts = np.flatnonzero(opens)
            if not len(starts):
                continue
            total = np.append(np.cumsum(word), 0)  # the last one is what lies before the first byte
            stops = np.append(starts[1:], len(word))
            lengths = total[stops - 1] - total[starts - 1]
            texts = first + np.searchsorted(at, starts + begin, side="right") - 1
            yield texts, (crc32_of(raw[begin:end], starts, lengths) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many words of all texts fall into each bucket that occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, found in word_buckets(batch.column(0), buckets):
                total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    partial = texts.select(F.col(column).cast("string")).mapInArrow(count, "bucket int, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, as an array that the driver holds: one number per bucket."""
    # At most one row per bucket of either table reaches the driver.
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, texts in ((s, docs), (t, target)):
        for row in bucket_counts(texts, buckets=buckets).collect():
            counts[row["bucket"]] = row["n"]
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight) of every row: the number of words and the floored mean of their gains."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            total = np.zeros(batch.num_rows, dtype=np.int64)
            for texts, found in word_buckets(batch.column(1), len(gain)):
                begins = np.flatnonzero(np.diff(texts, prepend=-1))
                n[texts[begins]] += np.diff(np.append(begins, len(texts)))
                total[texts[begins]] += np.add.reduceat(gain[found], begins)
            mean = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(mean)], names=["doc_id", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(score, "doc_id long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Every document's n_features, weight, score, and rank if it is drawn.

    ``docs`` has doc_id and text, ``target`` text.  Of the documents with at
    least ``min_words`` words, ``percent`` in a hundred are drawn (rounded
    down), the highest scores first, ties to the smaller doc_id.  A null or
    empty text has no words, weight 0 and no rank.  A null doc_id is hashed as
    an empty one and loses ties; rows that repeat a doc_id are ranked each for
    itself, and if they tie, in either order.  Other columns play no part and do not come
    back.  Without target texts all documents are weighed against even
    buckets; an empty table of documents gives an empty result.
    """
    scored = weights(docs, gains(docs, target, buckets)).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_features") >= min_words)
    ranked = radix_ranks(able.select("row", "score", "doc_id"), [("score", True), ("doc_id", False)])
    quota = able.count() * percent // 100
    drawn = ranked.where(F.col("rank") <= quota).select("row", "rank")
    return scored.join(drawn, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
