"""Packing documents into token sequences by best-two-fit.

Lengths are whole numbers up to the capacity, so the packing is planned on
the count of pieces of each length: the driver holds one number per length
and a list of bin patterns, never the pieces.  A pattern is filled greedily
with the longest pieces that fit; then its smallest piece is replaced by two
unpacked ones that fill the gap it leaves without a rest, of all such pairs the
one that is easiest to spare: a pair that leaves a rest would use up short
pieces and still waste the bin.  As nothing changes until a length runs out, a
pattern is repeated as often as the counts allow.
The pieces, numbered within their length by a distributed count, then look up
their place in the plan.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import shuffle_width
from tideline.session import materialize

CAPACITY = 1024
END_ID = 2

_ENCODERS: dict[str, ByteBpe] = {}


class ByteBpe:
    """The ids that ``tokenizers`` gives for a byte-level BPE file, without added special tokens.

    ``tiktoken`` applies the same merges several times faster.  It needs ids in
    the order of the merges, which is checked; a file that differs is encoded
    by ``tokenizers`` itself.  A special token written out in a text is one id.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
        self.fast = None
        if plain and len(self.special) <= 1 and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)):
            import tiktoken
            from public_tokenizers import PATTERN

            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(path)

    def ids(self, text: str) -> list[int]:
        if self.fast is None:
            return self.slow.encode(text, add_special_tokens=False).ids
        for special, number in self.special.items():
            if special in text:
                out: list[int] = []
                for i, part in enumerate(text.split(special)):
                    out += [number] * (i > 0) + self.fast.encode_ordinary(part)
                return out
        return self.fast.encode_ordinary(text)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable ones for themselves, the rest from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str) -> ByteBpe:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """The pieces of each document: its ids and ``end_id``, cut only where they exceed ``capacity``.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked, the ids as
    little-endian unsigned 32-bit numbers.  A null text counts as empty and
    gives one piece with the end id alone.  When a document is cut, the first
    piece takes the odd rest and all others are full.  ``tokenizer`` is a path
    that every executor can read.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    schema = T.StructType.fromDDL(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[] for _ in schema.fields]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.asarray([*bpe.ids(text.as_py() or ""), end_id], dtype="<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for number, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    data = ids[start:end].tobytes()
                    for column, value in zip(rows, (doc_id, number, start, end - start, zlib.crc32(data), data)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds)], names=[f.name for f in schema.fields]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bin patterns and how often each is used; together they take every piece exactly once."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit a sequence of {capacity}")
        left[length] = count
    patterns: list[tuple[list[int], int]] = []
    while (open_lengths := np.flatnonzero(left)).size:
        free = left.copy()
        held = [int(open_lengths[-1])]
        free[held[0]] -= 1
        gap = capacity - held[0]
        while gap and (fits := np.flatnonzero(free[1 : gap + 1])).size:
            length = int(fits[-1]) + 1
            held.append(length)
            free[length] -= 1
            gap -= length
        if gap and len(held) > 1:
            smallest = min(held)
            pair = _closing_pair(free, smallest + gap)
            if pair:
                held.remove(smallest)
                held += pair
        used = np.bincount(held, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= used * times
        patterns.append((sorted(held, reverse=True), times))
    return patterns


def _closing_pair(free: np.ndarray, room: int) -> list[int] | None:
    """Two free pieces that fill ``room`` exactly; of all pairs the one whose scarcer length has most pieces, then the most equal.

    The last piece of a length is not given away: it may be the one that fills a later bin.
    """
    small = np.arange(1, room // 2 + 1)
    spare = np.minimum(free[small], free[room - small])
    if room % 2 == 0 and len(small):
        spare[-1] = free[room // 2] // 2
    if not len(spare) or spare.max() < 2:
        return None
    a = int(small[len(spare) - 1 - spare[::-1].argmax()])
    return [a, room - a]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with doc_id, piece and length.

    Every row is placed, repeated rows too.  An empty table gives an empty
    result.  ``pieces`` is read twice, so it should be a written table.
    Input columns named sequence_id or offset are replaced.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places, first_bin, taken = [], 0, dict.fromkeys(counts, 0)
    for held, times in plan(counts, capacity):
        offset = 0
        for length in held:
            places.append((length, taken[length], taken[length] + times, first_bin - taken[length], offset))
            taken[length] += times
            offset += length
        first_bin += times
    table = spark.createDataFrame(places, "__p_length long, __p_from long, __p_to long, __p_shift long, __p_offset long")

    # Number the pieces of a length. A frequent length is spread over many counting groups.
    groups = max(4 * shuffle_width(spark), sum(counts.values()) // 50_000)
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    spread = pieces.select(*kept, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).alias("__group"))
    sizes = spread.groupBy("length", "__group").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "__group", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__group").orderBy("doc_id", "piece")
    numbered = (
        spread.withColumn("__in", F.row_number().over(inside))
        .join(offsets, ["length", "__group"])
        .withColumn("__rank", F.col("__before") + F.col("__in") - 1)
    )
    found = (F.col("length") == F.col("__p_length")) & (F.col("__rank") >= F.col("__p_from")) & (F.col("__rank") < F.col("__p_to"))
    # The plan has a few rows for each length up to the capacity, however many pieces there are.
    return numbered.join(F.broadcast(table), found).select(
        *kept, (F.col("__rank") + F.col("__p_shift")).alias("sequence_id"), F.col("__p_offset").alias("offset")
    )


def assemble(placed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from packed pieces that kept their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece."""
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id, keep_ids), "pieces")
    return pack(pieces, capacity)
