"""Column expressions and small helpers shared by the corpus operators."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other scripts stay as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text as an array, empty for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_key(spark: SparkSession, *parts: str) -> Column:
    """A number below the shuffle width from a row's own columns: it deals the rows of a hot group out."""
    return F.pmod(F.xxhash64(*parts), F.lit(shuffle_width(spark))).cast("int")


def with_group_facts(rows: DataFrame, parts: DataFrame, keys: Sequence[str], facts: Mapping[str, Column], spread: str = "spread") -> DataFrame:
    """Add facts about a row's group, null keys being a group too, without bringing a hot group together.

    ``parts`` holds one row for each group and spread key that occurs, so a
    group has no more of them than the shuffle is wide; ``facts`` are
    aggregates over those.  The rows then meet the facts by group and spread
    key.
    """
    whole = Window.partitionBy(*keys)
    told = parts.select(
        *[F.col(k).alias(f"__of_{k}") for k in (*keys, spread)], *[fact.over(whole).alias(name) for name, fact in facts.items()]
    )
    same = F.lit(True)
    for k in (*keys, spread):
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return rows.join(told, same).select(*rows.columns, *facts)
