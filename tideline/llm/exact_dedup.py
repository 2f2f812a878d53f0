"""Exact deduplication by a 128-bit content hash.

Rows are grouped by the md5 of their normalised text; one id of each group
stays.  That a hash stands for one text only is not assumed: texts are grouped
by (hash, text) as well, which compares their bytes, and copies are collapsed
before the shuffle, so a text that a third of all rows hold crosses the network
once per task.  Where a hash stands for several texts, its rows are told apart
by their texts.

After that only ids and hashes travel.  Rows of a hot group are dealt out by
their ids: each part of the group finds its best id, the parts' results are
merged, and every row looks up its group.

Everything is a DataFrame operation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import ascii_lower, spread_key, with_group_facts
from tideline.session import materialize


def content(text: Column) -> Column:
    """What two rows must share to be equal: the text with A-Z lower-cased; null counts as empty."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def digest(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text.cast("binary")))


def _hashed(docs: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    text = content(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("content")).withColumn(
        "hash", hashed(F.col("content"))
    )


def classes(docs: DataFrame, hashed: Callable[[Column], Column] = digest) -> DataFrame:
    """(row, doc_id, hash, variant, text_sha256) of every row; rows are equal if hash and variant are.

    ``row`` numbers the rows of the written result.  ``variant`` is 1 but for
    hashes that several texts share.
    """
    rows = _hashed(docs, hashed)
    texts = rows.groupBy("hash", "content").agg(F.lit(1).alias("one"))
    several = texts.groupBy("hash").agg(F.count("one").alias("texts")).where("texts > 1").select("hash")
    several = materialize(several, "shared-hashes")
    named = rows.withColumns({"text_sha256": F.sha2("content", 256), "variant": F.lit(1).cast("long")})
    slim = ["doc_id", "hash", "variant", "text_sha256"]
    if several.isEmpty():
        out = named.select(*slim)
    else:
        # A hash of several texts: number its texts, and let their rows look the number up by the text itself.
        shared = texts.join(several, "hash", "left_semi")
        number = F.row_number().over(Window.partitionBy("hash").orderBy("content")).cast("long")
        numbered = shared.select(F.col("hash").alias("h"), F.col("content").alias("c"), number.alias("variant"))
        apart = rows.join(several, "hash", "left_semi").join(numbered, (F.col("hash") == F.col("h")) & (F.col("content") == F.col("c")))
        apart = apart.withColumn("text_sha256", F.sha2("content", 256)).select(*slim)
        out = named.join(several, "hash", "left_anti").select(*slim).unionByName(apart)
    return materialize(out.withColumn("row", F.monotonically_increasing_id()), "hashed-rows")


def mark(docs: DataFrame, keep: str = "smallest", hashed: Callable[[Column], Column] = digest) -> DataFrame:
    """Every row's doc_id, keep_id, group_size, kept and text_sha256.

    ``keep`` says whether the smallest or the largest doc_id of equal texts
    stays.  A row without doc_id stays only if no equal row has one; keep_id is
    null then.  Of rows that repeat both doc_id and text exactly one stays.
    Texts of any length are compared whole; null counts as empty.  Columns of
    ``docs`` other than doc_id and text play no part and do not come back.  An
    empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep!r}")
    best, best_row = (F.min, F.min_by) if keep == "smallest" else (F.max, F.max_by)
    rows = classes(docs, hashed).withColumn("spread", spread_key(docs.sparkSession, "doc_id"))
    parts = rows.groupBy("hash", "variant", "spread").agg(
        F.count(F.lit(1)).alias("n"),
        best("doc_id").alias("best_id"),
        # Of rows that repeat an id any may stay, so the choice is written down.
        F.coalesce(best_row("row", "doc_id"), F.min("row")).alias("best_row"),
    )
    facts = {
        "group_size": F.sum("n"),
        "keep_id": best("best_id"),
        "__named": best_row("best_row", "best_id"),
        "__unnamed": F.min("best_row"),
    }
    told = with_group_facts(rows, materialize(parts, "group-parts"), ["hash", "variant"], facts)
    kept = F.col("row") == F.coalesce("__named", "__unnamed")
    return told.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def dedup(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat doc_id and text any one."""
    stays = mark(docs, keep).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    rows = docs.withColumns({"__own": F.col("doc_id").cast("long"), "__hash": F.sha2(content(F.col("text").cast("string")), 256)})
    same = F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__sha"))
    return rows.join(stays, same, "left_semi").dropDuplicates(["__own", "__hash"]).select(*docs.columns)
