"""Compressing vectors to product codes, with equal-average search for the nearest entry.

Vectors are cut into equal parts; each part position has a small codebook,
refined in rounds: every part goes to its nearest entry, and every entry
becomes the mean of its parts.

The nearest entry is found by component sums.  For vectors of w components the
squared distance is at least the squared gap of their sums over w.  A codebook
is sorted by sum; from where a part's own sum would lie the search goes outward
to the entry with the smaller gap, until that bound is strictly greater than
the best distance.  It is exact, ties included, and runs on all parts of a
batch at once.

All numbers are whole, so results do not depend on the order of additions.  A
round reads the vectors once and brings one sum per entry component to the
driver, however many vectors there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import spread_key, with_group_facts
from tideline.session import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is there and holds finite numbers only."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return embeddings.where(x.isNotNull() & finite)


def whole_numbers(x: np.ndarray, scale: int, width: int) -> np.ndarray:
    """``floor(scale * x)``, limited so that all squared distances and bounds stay exact in 64 bits."""
    limit = float((1 << 30) // width)
    return np.clip(np.floor(scale * x.astype(np.float64)), -limit, limit).astype(np.int64)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of each point's nearest entry, ties to the lower one, and the squared distance."""
    width, k = points.shape[1], len(book)
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, entries = sums[order], book[order]
    own = points.sum(axis=1)
    high = np.searchsorted(sums, own)
    low = high - 1
    best = np.full(len(points), np.iinfo(np.int64).max)
    found = np.full(len(points), k)
    going = np.arange(len(points))
    first = True
    while len(going):
        lo, hi, s = low[going], high[going], own[going]
        far = np.iinfo(np.int64).max
        gap_lo = np.where(lo >= 0, s - sums[np.maximum(lo, 0)], far)
        gap_hi = np.where(hi < k, sums[np.minimum(hi, k - 1)] - s, far)
        down = gap_lo <= gap_hi
        gap = np.where(down, gap_lo, gap_hi)
        on = gap < far
        if not first:
            # The bound: gap^2 / width > best ends the search.
            reach = np.where(on, gap, 0)
            on &= reach * reach <= best[going] * width
        going, down = going[on], down[on]
        if not len(going):
            break
        at = np.where(down, low[going], high[going])
        low[going] -= down
        high[going] += ~down
        difference = points[going] - entries[at]
        distance = np.einsum("ij,ij->i", difference, difference)
        index = order[at]
        better = (distance < best[going]) | ((distance == best[going]) & (index < found[going]))
        best[going[better]], found[going[better]] = distance[better], index[better]
        first = False
    return found, best


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS) -> tuple[DataFrame, int]:
    """(vec_id, label, point): the usable rows with their whole-number components, written; and how many components.

    Vectors compare only if they are equally long: of the lengths that can be
    cut into the parts the one that most rows have counts (the smallest of
    equals), and rows of another length are left out.
    """
    rows = usable(embeddings, vector).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col(vector).cast("array<double>").alias("point")
    )
    fits = rows.select(F.size("point").alias("size")).where((F.col("size") > 0) & (F.col("size") % parts == 0))
    common = fits.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    size = common["size"] if common else 0
    width = max(1, size // parts)

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = whole_numbers(_matrix(batch.column(2), size).ravel(), scale, width)
            offsets = pa.array(np.arange(0, len(values) + 1, size), pa.int32())
            point = pa.ListArray.from_arrays(offsets, pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), point], names=["vec_id", "label", "point"])

    kept = rows.where((F.size("point") == size) & F.lit(size > 0))
    label = rows.schema["label"].dataType.simpleString()
    return materialize(kept.mapInArrow(floor, f"vec_id long, label {label}, point array<long>"), "whole-vectors"), size


def first_books(points: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """A codebook per part position: that part of the rows with the smallest vec_ids, nulls last."""
    rows = points.orderBy(F.col("vec_id").asc_nulls_last(), "point").select("point").limit(entries).collect()
    seeds = np.array([r["point"] for r in rows], dtype=np.int64).reshape(len(rows), size)
    return [part.copy() for part in np.split(seeds, parts, axis=1)]


def refine(points: DataFrame, books: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; an entry that no part is nearest to stays."""
    size = sum(book.shape[1] for book in books)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(book), dtype=np.int64) for book in books]
        sums = [np.zeros(book.shape, dtype=np.int64) for book in books]
        for batch in batches:
            for p, part in enumerate(np.split(_matrix(batch.column(0), size), len(books), axis=1)):
                found, _ = nearest(part, books[p])
                counts[p] += np.bincount(found, minlength=len(books[p]))
                np.add.at(sums[p], found, part)
        rows = [(p, e, n, sums[p][e].tolist()) for p, c in enumerate(counts) for e, n in enumerate(c.tolist()) if n]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "entry", "n", "sums"])

    told = points.select("point").mapInArrow(total, "part int, entry int, n long, sums array<long>")
    places = told.select("part", "entry", "n", F.posexplode("sums").alias("place", "total"))
    # A row per component of each entry.
    merged = places.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    fresh = [book.copy() for book in books]
    for row in merged.collect():
        fresh[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return fresh


def codes(points: DataFrame, books: Sequence[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every row: the nearest entries in part order, and their squared distances summed."""
    size = sum(book.shape[1] for book in books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = np.split(_matrix(batch.column(2), size), len(books), axis=1)
            answers = [nearest(part, book) for part, book in zip(split, books)]
            indexes = np.stack([found for found, _ in answers], axis=1).astype(np.uint8)
            error = np.sum([distance for _, distance in answers], axis=0, dtype=np.int64)
            text = [row.tobytes().hex() for row in indexes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    label = points.schema["label"].dataType.simpleString()
    return points.mapInArrow(encode, f"vec_id long, label {label}, code string, error long")


def books_sha256(books: Sequence[np.ndarray]) -> str:
    """The sha256 of all entries' components as decimal numbers, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(
    embeddings: DataFrame,
    vector: str = "embedding",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every usable row's code and error, the error of its label, and the hash of the codebooks.

    Rows whose vector is null or holds null or non-finite components are left
    out, also vectors of another length than most (of those that can be cut
    into ``parts``).  Components beyond
    2^30 over the part's width (2^27 at eight components, after scaling) count as
    that, so that distances stay exact.  Null ids come last, null labels are a
    label, repeated rows are coded each for itself, extra columns do not come
    back, and an empty table gives an empty result.  With fewer rows than
    ``entries`` the codebooks are as small as the table.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: between 1 and 256 entries")
    points, size = whole_vectors(embeddings, vector, scale, parts)
    books = first_books(points, size, parts, entries)
    for _ in range(rounds):
        books = refine(points, books)
    coded = materialize(codes(points, books), "coded-vectors").withColumn("spread", spread_key(points.sparkSession, "vec_id"))
    sums = coded.groupBy("label", "spread").agg(F.sum("error").alias("error"))
    told = with_group_facts(coded, sums, ["label"], {"label_error": F.sum("error")})
    return told.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
