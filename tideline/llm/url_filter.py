"""URL rules by a blocked Bloom filter and an exact hash join.

A rule names a host and a path prefix and applies to the host and all of its
subdomains.  The canonical form of a rule is ``host + path``.  A url can only
be ruled by keys cut from itself (a host suffix followed by a path prefix), so
those keys are probed in a blocked Bloom filter of the rules; pages without a
possible hit are judged in place and never shuffle.  Possible hits go to an
exact join with the rules, which removes the false positives, and the longest
rule wins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import ascii_lower

BLOCK_BITS = 256
BITS_PER_KEY = 8
WORDS_PER_BLOCK = BLOCK_BITS // 64
#: The filter has 16 bits for a rule, and never more blocks than these (2 MB): beyond it only gets less selective.
MAX_BLOCKS = 65_536


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) as (key, rule_verdict); null parts count as empty.

    A key listed with both verdicts blocks.
    """
    key = F.concat(ascii_lower(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit("")))
    return (
        rules.where(F.col("verdict").isNotNull())
        .groupBy(key.alias("rule_key"))
        .agg(F.max("verdict").alias("rule_verdict"))
    )


def build_filter(keys: DataFrame, blocks: int) -> np.ndarray:
    """The filter over ``rule_key`` as 64-bit words, four to a block.

    The bits of a word are put together on the executors; the driver gets at
    most ``blocks`` times 32 bytes, which ``MAX_BLOCKS`` bounds at 2 MB.
    """
    at = F.explode(
        F.array(*[F.struct(w.alias("word"), m.alias("mask")) for w, m in _word_and_mask(F.col("rule_key"), blocks)])
    )
    bits = keys.select(at.alias("b")).groupBy(F.col("b.word").alias("word")).agg(F.bit_or("b.mask").alias("mask"))
    words = np.zeros(blocks * WORDS_PER_BLOCK, dtype=np.int64)
    for word, mask in bits.toLocalIterator():
        words[word] = mask
    return words


def _word_and_mask(key: Column, blocks: int) -> list[tuple[Column, Column]]:
    """For each bit of a key: the word of the filter, and the bit in it."""
    base = F.pmod(F.xxhash64(key), F.lit(blocks)) * WORDS_PER_BLOCK
    spread = F.xxhash64(key, F.lit("bits"))
    places = [F.shiftrightunsigned(spread, 8 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(BITS_PER_KEY)]
    one = F.lit(1).cast("long")
    return [
        (base + F.shiftright(p, 6), F.call_function("shiftleft", one, p.bitwiseAND(F.lit(63)).cast("int")))
        for p in places
    ]


def tester(spark: SparkSession, words: np.ndarray):
    """A function of (hash, spread) arrays that flags the probes that may be listed."""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("array<boolean>")
    def may_be_listed(hashes: pd.Series, spreads: pd.Series) -> pd.Series:
        lengths = hashes.map(len).to_numpy()
        if not lengths.sum():
            return pd.Series([np.zeros(0, dtype=bool)] * len(hashes))
        h, s = np.concatenate(hashes.to_numpy()), np.concatenate(spreads.to_numpy()).view(np.uint64)
        base = np.mod(h, len(shared.value) // WORDS_PER_BLOCK) * WORDS_PER_BLOCK
        found = np.ones(len(h), dtype=bool)
        for i in range(BITS_PER_KEY):
            place = (s >> np.uint64(8 * i)) & np.uint64(BLOCK_BITS - 1)
            word = shared.value[base + (place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
            found &= (word >> (place & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(np.split(found, np.cumsum(lengths)[:-1]))

    return may_be_listed


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to each row of ``pages``.

    Every row is kept, repeated rows too.  Null urls and urls without ``://``
    have an empty host and path, no rule and the default verdict; so has every
    url that no rule fits.  A path rule fits a path that starts with it.  Of
    the rules that fit, the longest key wins; of equally long ones the one
    with the longer host, which is the only one of its length there can be.
    An input column named host, path, rule or verdict is replaced.  An empty
    rule table leaves every verdict at the default.
    """
    listed = canonical_rules(rules)
    # A few numbers: how many labels and how long a path a rule can have. Both are bounded by the length of a url.
    shape = listed.select(
        F.size(F.split(F.substring_index("rule_key", "/", 1), r"\.")).alias("labels"),
        F.when(F.instr("rule_key", "/") > 0, F.length("rule_key") - F.instr("rule_key", "/") + 1).otherwise(0).alias("cut"),
    ).agg(F.count(F.lit(1)), F.collect_set("labels"), F.collect_set("cut"))
    count, labels, cuts = shape.first()
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    named = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if not count:
        return named.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    blocks = 1
    while blocks < min(MAX_BLOCKS, count * 16 / BLOCK_BITS):
        blocks *= 2
    may_be_listed = tester(pages.sparkSession, build_filter(listed, blocks))
    suffixes = [
        F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)) for n in sorted(labels)
    ]
    probes = F.array_compact(
        F.array(
            *[
                F.when(F.length("path") >= cut, F.concat(suffix, F.substring("path", 1, cut)))
                for suffix in suffixes
                for cut in sorted(cuts)
            ]
        )
    )
    flags = may_be_listed(
        F.transform("__probes", lambda k: F.xxhash64(k)), F.transform("__probes", lambda k: F.xxhash64(k, F.lit("bits")))
    )
    probed = (
        named.withColumn("__probes", probes)
        .withColumn("__flags", flags)
        .withColumn("__hits", F.filter("__probes", lambda k, i: F.get("__flags", i)))
        .drop("__probes", "__flags")
    )
    without = probed.where(F.size("__hits") == 0).drop("__hits")
    within = probed.where(F.size("__hits") > 0)
    # One row for each url, however many pages have it; then the exact join.
    asked = within.select(F.col(url).alias("__url"), F.explode("__hits").alias("rule_key")).distinct()
    best = (
        asked.join(listed, "rule_key")
        .groupBy("__url")
        .agg(F.max(F.struct(F.length("rule_key").alias("n"), F.length(F.substring_index("rule_key", "/", 1)).alias("h"), "rule_key", "rule_verdict")).alias("best"))
        .select("__url", F.col("best.rule_key").alias("rule"), F.col("best.rule_verdict").alias("__verdict"))
    )
    ruled = (
        within.drop("__hits")
        .join(best, F.col(url) == F.col("__url"), "left")
        .select(*named.columns, "rule", F.coalesce("__verdict", F.lit(default)).alias("verdict"))
    )
    return without.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")).unionByName(ruled)
