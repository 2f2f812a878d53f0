"""N-gram Jaccard join with prefix filters under several token orders.

Two sets with a Jaccard similarity of at least t share a token among the first
``n - ceil(t n) + 1`` of both, under any order of all tokens.  Three orders are
used: by rarity (the document frequency, counted over the whole corpus) and two
random ones.  Rarity proposes candidates; only those that also share a prefix
token under both random orders are verified exactly.

1. Equal sets become one class, named by a hash of the set.
2. Tokens go to hash buckets in packed blocks; a bucket counts how many
   classes hold each token and sends the tokens that at least two hold back to
   the classes.  A token that no other class holds cannot link, so a class with
   enough of them is finished.  Very frequent tokens are found before by a
   count that is combined in each task; they come last in the rarity order and
   need no counting, so no bucket is larger than the others.
3. All members of a prefix token are first compared with one of them, which
   links groups of near copies in as many comparisons as they have members.
4. What is left are candidates between different components; these are all
   compared.  So every component is found, and no group is turned into all of
   its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.graph import components
from tideline.llm.shingles import mix, set_hashes, shingle_sets
from tideline.session import materialize

SHINGLE = 5
PERCENT = 80
#: A token is frequent if at least one of so many classes holds it. With a mean of m tokens there are
#: at most ``FREQUENT_SHARE * m`` frequent tokens, whatever the size of the corpus.
FREQUENT_SHARE = 2000
FREQUENT_LEAST = 64
#: Tokens that a task holds before it sends them on, and tokens of a bucket.
WINDOW_TOKENS = 1_000_000
BUCKET_TOKENS = 1_000_000
#: What makes the two random orders differ.
ORDERS = (0x243F6A8885A308D3, 0x13198A2E03707344)

U64 = np.uint64


def prefix_length(n, percent: int = PERCENT):
    """How many first tokens of a set of ``n`` can decide whether it links."""
    return n - (percent * n + 99) // 100 + 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))


class _Window:
    """The sets of a task's next documents, each class once."""

    def __init__(self):
        self.refs, self.sizes, self.tokens, self.held = [], [], [], 0

    def add(self, sizes: np.ndarray, tokens: np.ndarray) -> None:
        self.refs.append(set_hashes(sizes, tokens))
        self.sizes.append(sizes)
        self.tokens.append(tokens)
        self.held += len(tokens)

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        refs, sizes = np.concatenate(self.refs), np.concatenate(self.sizes)
        tokens = np.concatenate(self.tokens)
        first = np.zeros(len(refs), dtype=bool)
        first[np.unique(refs, return_index=True)[1]] = True
        first &= sizes > 0
        tokens = tokens[np.repeat(first, sizes)]
        self.__init__()
        return refs[first], sizes[first], tokens


def _scan(batch: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    yield from shingle_sets(batch.column(batch.schema.get_field_index("text")), shingle)


def describe(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per document its id, text hash, class (``ref``, null for an empty set) and set size; beside them, in
    rows with a token, how many classes of a task's window hold a token that is locally frequent."""
    fields = [(name, pa.int64()) for name in ("doc_id", "text_hash", "ref", "n", "token", "held")]

    def rows(columns: dict) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [columns.get(name, pa.nulls(size, kind)) for name, kind in fields], names=[name for name, _ in fields]
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = _Window()

        def frequent() -> pa.RecordBatch:
            refs, _, tokens = window.take()
            found, count = np.unique(tokens, return_counts=True)
            often = count >= max(2, len(refs) // FREQUENT_SHARE)
            return rows({"token": pa.array(found[often].view(np.int64)), "held": pa.array(count[often])})

        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            for first, sizes, tokens in _scan(batch, shingle):
                refs = set_hashes(sizes, tokens).view(np.int64)
                yield rows(
                    {
                        "doc_id": ids.slice(first, len(sizes)),
                        "text_hash": hashes.slice(first, len(sizes)),
                        "ref": pa.array(refs, mask=sizes == 0),
                        "n": pa.array(sizes.astype(np.int64)),
                    }
                )
                window.add(sizes, tokens)
                if window.held >= WINDOW_TOKENS:
                    yield frequent()
        if window.refs:
            yield frequent()

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    return texts.mapInArrow(scan, ", ".join(f"{name} long" for name, _ in fields))


def frequent_tokens(described: DataFrame) -> np.ndarray:
    """Tokens that one of ``FREQUENT_SHARE`` classes holds, sorted.

    A token is reported by every window in which that share holds it, so the
    sum misses at most as much again.  The list is bounded, see ``FREQUENT_SHARE``.
    """
    classes = described.where(F.col("ref").isNotNull()).agg(F.approx_count_distinct("ref")).first()[0]
    least = max(FREQUENT_LEAST, classes // FREQUENT_SHARE)
    often = described.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("held").alias("held")).where(F.col("held") >= least)
    return np.sort(np.array([r[0] for r in often.select("token").collect()], dtype=np.int64).view(U64))


PACKED = "bucket long, kind int, refs binary, counts binary, tokens binary, extra binary"
_KINDS = [("bucket", pa.int64()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("refs", "counts", "tokens", "extra"))]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, _KINDS)], names=[n for n, _ in _KINDS])


def _runs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal neighbours start, and how long they are."""
    starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else np.zeros(0, dtype=np.int64)
    return starts, np.diff(np.append(starts, len(numbers)))


def _in(tokens: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(tokens), dtype=bool)
    at = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
    return listed[at] == tokens


def _bucket_of(numbers: np.ndarray, buckets: int) -> np.ndarray:
    return ((numbers >> U64(33)) % U64(buckets)).astype(np.int64)


def pack_tokens(docs: DataFrame, frequent: np.ndarray, buckets: int, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Blocks of tokens for the buckets (kind 0), and of what is known of the classes (kind 1).

    Of a class that is its size, its frequent tokens, and for each random order
    the last place of its prefix.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = _Window()

        def flush() -> pa.RecordBatch:
            refs, sizes, tokens = window.take()
            ends = np.cumsum(sizes)
            limits = np.zeros((len(refs), len(ORDERS)), dtype=U64)
            for k, order in enumerate(ORDERS):
                placed = mix(tokens ^ U64(order))
                for i, (begin, end) in enumerate(zip(ends - sizes, ends)):
                    last = int(prefix_length(end - begin, percent)) - 1
                    limits[i, k] = np.partition(placed[begin:end], last)[last]
            owner = np.repeat(np.arange(len(refs)), sizes)
            often = _in(tokens, shared.value)
            rows = []
            # Classes, by the bucket of their name.
            many = np.bincount(owner[often], minlength=len(refs))
            home = _bucket_of(mix(refs), buckets)
            order = np.argsort(home, kind="stable")
            spread = np.argsort(home[owner[often]], kind="stable")
            hot = tokens[often][spread]
            taken = 0
            for begin, count in zip(*_runs(home[order])):
                at = order[begin : begin + count]
                held = int(many[at].sum())
                extra = np.column_stack([sizes[at].astype(U64), limits[at]])
                rows.append(
                    (
                        int(home[at[0]]), 1, refs[at].tobytes(), many[at].astype("<u4").tobytes(),
                        hot[taken : taken + held].tobytes(), extra.tobytes(),
                    )
                )
                taken += held
            # All other tokens, by their own bucket.
            rest, whose = tokens[~often], owner[~often]
            bucket = _bucket_of(rest, buckets)
            order = np.argsort(bucket, kind="stable")
            for begin, count in zip(*_runs(bucket[order])):
                at = order[begin : begin + count]
                starts, lengths = _runs(whose[at])
                rows.append(
                    (
                        int(bucket[at[0]]), 0, refs[whose[at][starts]].tobytes(), lengths.astype("<u4").tobytes(),
                        rest[at].tobytes(), None,
                    )
                )
            return _packed(rows)

        for batch in batches:
            for _, sizes, tokens in _scan(batch, shingle):
                window.add(sizes, tokens)
                if window.held >= WINDOW_TOKENS:
                    yield flush()
        if window.held:
            yield flush()

    return _texts(docs).mapInArrow(send, PACKED)


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=kind)] + [np.frombuffer(b.as_py(), dtype=kind) for b in table.column(name)])


def count_tokens(packed: DataFrame, buckets: int) -> DataFrame:
    """The tokens that at least two classes hold, with their number, sent to the buckets of the classes."""

    def count(key: tuple, table: pa.Table) -> pa.Table:
        kinds = np.asarray(table.column("kind"))
        known = table.filter(pa.array(kinds == 1)).select([n for n, _ in _KINDS])
        sent = table.filter(pa.array(kinds == 0))
        tokens = _column(sent, "tokens", U64)
        refs = np.repeat(_column(sent, "refs", U64), _column(sent, "counts", "<u4"))
        order = np.argsort(tokens, kind="stable")
        tokens, refs = tokens[order], refs[order]
        starts, lengths = _runs(tokens)
        several = np.repeat(lengths > 1, lengths)
        tokens, refs = tokens[several], refs[several]
        # A class may have come from several windows.
        order = np.lexsort((refs, tokens))
        tokens, refs = tokens[order], refs[order]
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (refs[1:] != refs[:-1])
        tokens, refs = tokens[new], refs[new]
        starts, lengths = _runs(tokens)
        held = np.repeat(lengths, lengths)
        tokens, refs, held = tokens[held > 1], refs[held > 1], held[held > 1]
        home = _bucket_of(mix(refs), buckets)
        order = np.argsort(home, kind="stable")
        rows = []
        for begin, size in zip(*_runs(home[order])):
            at = order[begin : begin + size]
            rows.append((int(home[at[0]]), 0, refs[at].tobytes(), held[at].astype("<u4").tobytes(), tokens[at].tobytes(), None))
        return pa.concat_tables([known, pa.Table.from_batches([_packed(rows)])])

    return packed.groupBy("bucket").applyInArrow(count, PACKED)


SIGNATURE = "ref long, n long, spare long, tokens array<long>, prefix array<long>, second array<long>, third array<long>"


def signatures(counted: DataFrame, percent: int = PERCENT) -> DataFrame:
    """What can link of each class that can link at all.

    ``tokens`` are those that other classes hold too, ``prefix`` the part of
    the rarity prefix that is among them, in order; ``spare`` tokens come before
    it.  ``second`` and ``third`` are the prefixes of the random orders.
    """
    lists = pa.list_(pa.int64())
    schema = pa.schema(
        [("ref", pa.int64()), ("n", pa.int64()), ("spare", pa.int64())] + [(c, lists) for c in ("tokens", "prefix", "second", "third")]
    )

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        kinds = np.asarray(table.column("kind"))
        known, sent = table.filter(pa.array(kinds == 1)), table.filter(pa.array(kinds == 0))
        names = _column(known, "refs", U64)
        many = _column(known, "counts", "<u4").astype(np.int64)
        hot = _column(known, "tokens", U64)
        facts = _column(known, "extra", U64).reshape(-1, 1 + len(ORDERS))
        hot_at = np.cumsum(many) - many
        refs, tokens, held = _column(sent, "refs", U64), _column(sent, "tokens", U64), _column(sent, "counts", "<u4")
        order = np.lexsort((tokens, held, refs))
        refs, tokens = refs[order], tokens[order]
        names, first = np.unique(names, return_index=True)
        begin = np.searchsorted(refs, names)
        end = np.searchsorted(refs, names, side="right")
        n = facts[first, 0].astype(np.int64)
        spare = n - many[first] - (end - begin)
        reach = prefix_length(n, percent) - spare
        out: list[list] = [[] for _ in schema]
        for i in np.flatnonzero((reach > 0) & (n > spare)):
            own = hot[hot_at[first[i]] : hot_at[first[i]] + many[first[i]]]
            ordered = np.concatenate([tokens[begin[i] : end[i]], np.sort(own)])
            ways = [ordered[mix(ordered ^ U64(o)) <= limit] for o, limit in zip(ORDERS, facts[first[i], 1:])]
            values = [names[i : i + 1].view(np.int64)[0], n[i], spare[i], ordered, ordered[: reach[i]], *ways]
            for column, value in zip(out, values):
                column.append(value.view(np.int64) if isinstance(value, np.ndarray) else int(value))
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return counted.groupBy("bucket").applyInArrow(gather, SIGNATURE)


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return (F.lit(percent) * a <= 100 * b) & (F.lit(percent) * b <= 100 * a)


def verify(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that share a prefix token under the random orders and reach the similarity."""

    def side(name: str, *columns: str) -> DataFrame:
        return classes.select(F.col("ref").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    share = pairs.join(side("a", "second", "third"), "a").join(side("b", "second", "third"), "b")
    share = share.where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b")).select("a", "b")
    both = share.join(side("a", "n", "tokens"), "a").join(side("b", "n", "tokens"), "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    # 100 * common >= percent * (all - common), in whole numbers.
    enough = (100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b"))
    return both.where(enough).select("a", "b")


def star_pairs(prefixes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One candidate per class: of the centres of its prefix tokens the one it shares most of them with.

    The centre of a token is the member with the smallest part of tokens of its own.
    """
    rank = F.struct((F.col("spare") / F.col("n")).alias("own"), F.col("ref").alias("ref"), F.col("n").alias("n"))
    centres = prefixes.groupBy("token").agg(F.min(rank).alias("c"), F.count(F.lit(1)).alias("members")).where("members > 1")
    votes = (
        prefixes.join(centres, "token")
        .where((F.col("ref") != F.col("c.ref")) & _near_sizes(F.col("n"), F.col("c.n"), percent))
        .groupBy(F.col("ref").alias("a"), F.col("c.ref").alias("b"))
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    return votes.groupBy("a").agg(F.max(F.struct("votes", "b")).alias("v")).select("a", F.col("v.b").alias("b"))


def cross_pairs(prefixes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All candidates whose classes are in different components, by tokens that such classes share.

    In each token's group one side leaves out the largest component, so a
    group of near copies is not paired with itself.
    """
    sizes = prefixes.groupBy("token", "component").agg(F.count(F.lit(1)).alias("members"))
    mixed = (
        sizes.groupBy("token")
        .agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("members", "component")).alias("largest"))
        .where("parts > 1")
        .select("token", F.col("largest.component").alias("main"))
    )
    inside = prefixes.join(mixed, "token")
    few = inside.where(F.col("component") != F.col("main")).select(
        "token", F.col("ref").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("component").alias("c_a")
    )
    rest_a, rest_b = F.col("n_a") - F.col("at_a"), F.col("n") - F.col("at")
    # If this is the first token they share, at most what follows it on the shorter side is common.
    reach = (100 + percent) * F.least(rest_a, rest_b) >= percent * (F.col("n_a") + F.col("n"))
    once = (F.col("component") == F.col("main")) | (F.col("a") < F.col("ref"))
    return (
        few.join(inside, "token")
        .where((F.col("c_a") != F.col("component")) & once & _near_sizes(F.col("n_a"), F.col("n"), percent) & reach)
        .select(F.least("a", "ref").alias("a"), F.greatest("a", "ref").alias("b"))
        .distinct()
    )


def linked_classes(docs: DataFrame, described: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(node, component) of all classes that link to another class."""
    frequent = frequent_tokens(described)
    total = described.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_TOKENS))
    counted = count_tokens(pack_tokens(docs, frequent, buckets, shingle, percent), buckets)
    classes = materialize(signatures(counted, percent), "signatures")
    prefixes = classes.select("ref", "n", "spare", F.posexplode("prefix").alias("i", "token")).withColumn("at", F.col("spare") + F.col("i"))
    crowded = prefixes.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token")
    prefixes = materialize(prefixes.join(crowded, "token").drop("i"), "prefixes")
    near = materialize(verify(star_pairs(prefixes, percent), classes, percent), "near")
    parts = materialize(components(near), "parts")
    placed = (
        prefixes.join(parts, F.col("ref") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "ref"))
        .drop("node")
    )
    far = verify(cross_pairs(materialize(placed, "placed"), percent), classes, percent)
    return components(near.unionByName(far))


def grouped_rows(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n, ref, and ``class``, which linked rows share; null for an empty set."""
    described = materialize(describe(docs, shingle), "described")
    linked = materialize(linked_classes(docs, described, shingle, percent), "linked")
    rows = described.where(F.col("token").isNull()).select("doc_id", "text_hash", "n", "ref")
    full = rows.where(F.col("ref").isNotNull())
    named = full.join(linked, F.col("ref") == F.col("node"), "left").withColumn("class", F.coalesce("component", "ref"))
    empty = rows.where(F.col("ref").isNull()).withColumn("class", F.lit(None).cast("long"))
    return named.select(*empty.columns).unionByName(empty)


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles and component_id, the smallest doc_id it can reach.

    Words are runs of other than white space, A-Z lower-cased; a set holds the
    distinct shingles, of a text with fewer words the whole sequence.  A null
    text counts as empty; a text without words has an empty set, links with
    nothing and keeps its own id.  Equal texts link.  Rows that share a doc_id
    are each compared by their own text.  An empty table gives no rows.
    """
    rows = grouped_rows(docs, shingle, percent)
    named, empty = rows.where(F.col("class").isNotNull()), rows.where(F.col("class").isNull())
    lowest = named.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    grouped = named.join(lowest, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return grouped.unionByName(empty.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group stays, the one with the smallest (doc_id, text hash), rows without doc_id last; the columns of ``docs`` are unchanged.

    Rows are decided one by one, by their own text: a row stays or goes
    whatever other rows with its doc_id do, and of rows that repeat both doc_id
    and text one stays.  Rows without words are not duplicates of each other
    and stay.  An empty table gives no rows.
    """
    rows = grouped_rows(docs, shingle, percent).where(F.col("class").isNotNull())
    texts = rows.groupBy("class", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = texts.groupBy("class").agg(F.min(place).alias("first"))
    stays = place.eqNullSafe(F.col("first"))
    # What is not simply kept: texts that go (once false) and texts of which one row stays (once true).
    decided = texts.join(first, "class").where(~stays | (F.col("copies") > 1))
    decided = materialize(
        decided.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"), stays.alias("__once")), "decided"
    )
    own = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text"))
    rest = docs.join(decided, own, "left_anti")
    # An aggregate, so that many copies are few before they are dealt out.
    repeated = docs.join(decided.where("__once"), own, "left_semi")
    row = F.struct(*docs.columns)
    once = repeated.groupBy(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text")).agg(
        F.min_by(row, F.xxhash64(*docs.columns)).alias("__row")
    )
    return rest.unionByName(once.select("__row.*"))
