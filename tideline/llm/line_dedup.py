"""Line deduplication by an exact set-similarity join.

A line is removed if an earlier line is like it: the Jaccard similarity of
their sets of five-word shingles is 0.8 or more.  Equal lines are collapsed
first; everything after works on first occurrences.

Under any order of all tokens two similar lines share one of their first
``n - ceil(0.8 n) + 1``, and ``s + 1`` of the first ``s`` more.  The filter is
applied twice.  In hash order it needs no counts beforehand: a line that has
too few first tokens in common with other lines is finished, and that is most
of them.  For the lines left all tokens are counted, put in the order of
rarity, and the filter is applied again, now with the tokens that many lines
share at the end.  Lines that still share a token, fit in
length and leave enough room behind the shared position are candidates and are
verified exactly.

A line is first compared with the earliest line of each of its tokens.  Only
lines that this does not remove are compared with all their earlier
candidates, so a group of similar lines is not turned into all of its pairs.

Everything is a DataFrame operation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import BLANKS, let
from tideline.session import materialize

SHINGLE = 5
PERCENT = 80
NOT_BLANK = r"[^\x20\x09-\x0D]"

ORDER = ("doc_id", "text_hash", "line_no")


def shingles(line: Column, size: int = SHINGLE) -> Column:
    """The distinct shingle hashes of the lower-cased words in ascending order.

    A line with fewer words is one shingle; a line without words has none.
    """

    def of(words: Column) -> Column:
        count = F.greatest(F.size(words) - (size - 1), F.lit(0))
        rolled = F.transform(F.arrays_zip(*[F.slice(words, k + 1, count) for k in range(size)]), lambda shingle: F.xxhash64(shingle))
        return (
            F.when(F.size(words) >= size, F.array_distinct(F.sort_array(rolled)))
            .when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " "))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(F.array_remove(F.split(F.lower(line), BLANKS), ""), of)


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line), one row per line feed plus one; a null text has no lines."""
    return docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


def reach(n: Column, percent: int = PERCENT) -> Column:
    """How many first tokens of a line with ``n`` decide."""
    return n - F.floor((percent * n + 99) / 100).cast("int") + 1


def slack(n: Column, percent: int = PERCENT) -> Column:
    """How many more are taken in hash order: half as many, if there are."""
    return F.least(F.ceil(reach(n, percent) / 2).cast("int"), n - reach(n, percent))


def needed(n: Column, percent: int = PERCENT) -> Column:
    """How many of them a similar line has in its own, at least.

    The line whose last taken hash is lower has all that it shares among the
    other's, which is its slack and one; it may be the shorter one.
    """
    return slack(F.floor((percent * n + 99) / 100).cast("int"), percent) + 1


def first_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct lines with words: key, the earliest place, the number of tokens, and the first in hash order."""
    # Asked of the line: a condition on the shingles would be pushed below them and hash every line twice.
    worded = split_lines(docs).where(F.col("line").rlike(NOT_BLANK))
    lines = worded.select(*ORDER, F.xxhash64(F.lower("line")).alias("key"), shingles(F.col("line")).alias("tokens"))
    n = F.size("tokens")
    head = F.slice("tokens", F.lit(1), reach(n, percent) + slack(n, percent)).alias("head")
    kept = lines.select("key", F.struct(*ORDER, n.alias("n"), head).alias("first"))
    return kept.groupBy("key").agg(F.min("first").alias("first")).select("key", "first.*")


def sharing_lines(firsts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Keys of the lines that share as many of their first tokens in hash order as a similar line would."""
    rows = firsts.select(F.explode("head").alias("token"), "key")
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("token")
    common = rows.join(shared, "token", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("common"))
    return common.join(firsts.select("key", "n"), "key").where(F.col("common") >= needed(F.col("n"), percent)).select("key")


def token_sets(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, place, tokens): the whole shingle sets of the asked lines (key and place), cut from their documents."""
    by_doc = asked.groupBy("place.doc_id", "place.text_hash").agg(F.collect_list(F.struct("place", "key")).alias("asked"))
    held = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))

    def cut(lines: Column) -> Column:
        tokens = lambda a: shingles(F.get(lines, a["place"]["line_no"]))
        return F.transform("asked", lambda a: F.struct(a["key"].alias("key"), a["place"].alias("place"), tokens(a).alias("tokens")))

    sets = let(F.split("text", "\n"), cut)
    return held.join(by_doc, same).select(F.explode(sets).alias("s")).select("s.*").dropDuplicates(["key"])


def rare_prefixes(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, key, n, at, place) for the tokens of the rarity prefix that several lines have; ``at`` is the position."""
    rows = sets.select(F.explode("tokens").alias("token"), "key")
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1")
    shared = materialize(rows.join(counts, "token"), "shared-tokens")
    rarity = Window.partitionBy("key").orderBy("lines", "token")
    # Tokens of this line alone come first and take part in nothing.
    own = F.count(F.lit(1)).over(Window.partitionBy("key"))
    facts = sets.select("key", F.size("tokens").alias("n"), "place")
    ranked = shared.withColumns({"__own": own, "__rank": F.row_number().over(rarity)}).join(facts, "key")
    at = (F.col("n") - F.col("__own") + F.col("__rank") - 1).cast("int")
    return ranked.withColumn("at", at).where(F.col("at") < reach(F.col("n"), percent)).select("token", "key", "n", "at", "place")


def _fits(a: Column, b: Column, percent: int) -> Column:
    return (percent * a <= 100 * b) & (percent * b <= 100 * a)


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The keys of later lines (key, other) whose shingle sets reach the similarity with the earlier one."""
    both = pairs.join(sets.withColumnRenamed("tokens", "a"), "key").join(
        sets.select(F.col("key").alias("other"), F.col("tokens").alias("b")), "other"
    )
    common = F.size(F.array_intersect("a", "b")).cast("long")
    return both.where((100 + percent) * common >= percent * (F.size("a") + F.size("b"))).select("key").distinct()


def similar_to_earlier(docs: DataFrame, firsts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Keys of distinct lines to which an earlier line is similar."""
    sharing = materialize(sharing_lines(firsts, percent), "sharing-lines")
    asked = firsts.join(sharing, "key").select("key", F.struct(*ORDER).alias("place"))
    sets = materialize(token_sets(asked, docs), "line-sets")
    prefixes = materialize(rare_prefixes(sets, percent), "line-prefixes")
    groups = prefixes.groupBy("token").agg(F.min(F.struct("place", "key", "n")).alias("e"), F.count(F.lit(1)).alias("m"))
    prefixes = materialize(prefixes.join(groups.where("m > 1").drop("m"), "token"), "line-groups")
    stars = (
        prefixes.where((F.col("key") != F.col("e.key")) & _fits(F.col("n"), F.col("e.n"), percent))
        .select("key", F.col("e.key").alias("other"))
        .distinct()
    )
    stars = materialize(stars, "line-stars")
    found = materialize(verify(stars, sets, percent), "line-found")
    left = prefixes.join(found, "key", "left_anti").drop("e")
    earlier = prefixes.select("token", *[F.col(c).alias(f"{c}_b") for c in ("key", "n", "at", "place")])
    earlier = earlier.withColumnRenamed("key_b", "other")
    # If this is the first token they share, at most what follows it in either line is common.
    room = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
    enough = (100 + percent) * room >= percent * (F.col("n") + F.col("n_b"))
    rest = (
        left.join(earlier, "token")
        .where((F.col("place_b") < F.col("place")) & _fits(F.col("n"), F.col("n_b"), percent) & enough)
        .select("key", "other")
        .distinct()
        .join(stars, ["key", "other"], "left_anti")
    )
    return found.unionByName(verify(materialize(rest, "line-rest"), sets, percent))


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, removed): the numbers (from 0) of the lines to remove, for documents that have some."""
    firsts = materialize(first_lines(docs, percent), "first-lines")
    similar = materialize(similar_to_earlier(docs, firsts, percent), "similar-lines")
    classes = firsts.select("key", F.struct(*ORDER).alias("first")).join(similar.withColumn("similar", F.lit(True)), "key", "left")
    lines = split_lines(docs).select(*ORDER, F.xxhash64(F.lower("line")).alias("key"))
    later = F.struct(*ORDER) > F.col("first")
    return (
        lines.join(classes, "key")
        .where(later | F.col("similar"))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("line_no")).alias("removed"))
    )


def dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with later similar lines taken out of the text, and how many lines it had and lost.

    Lines are the parts of a text between line feeds, in the order of doc_id,
    text and position; A-Z and other capitals count as small letters.  Lines
    without words are never removed.  Every row is kept: a null text stays
    null, an empty one empty, and a text that loses all its lines becomes
    empty.  Rows that repeat both doc_id and text are one document and lose the
    same lines.  Extra columns pass through; n_lines and n_removed are added and
    replace input columns of that name.
    """
    removed = removed_lines(docs, percent).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__removed")
    )
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*kept, F.xxhash64("text").alias("__own"))
    joined = rows.join(removed, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left")
    lines = F.split("text", "\n")
    numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__removed")
    short = let(lines, lambda all_lines: F.array_join(F.transform(numbers, lambda i: F.get(all_lines, i)), "\n"))
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(short)
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in kept],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__removed"), F.lit(0)).cast("long").alias("n_removed"),
    )
