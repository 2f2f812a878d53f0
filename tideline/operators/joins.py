"""Equi joins, semi and anti joins, lookups.

No join carries a broadcast hint: Catalyst broadcasts a side when its known
size is below ``spark.sql.autoBroadcastJoinThreshold``, AQE decides again from
the measured size, and everything else is a sort-merge join whose skewed
partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_with_suffix(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str] | str,
    right_on: Sequence[str] | str | None = None,
    how: str = "left",
    suffixes: tuple[str, str] = ("", "_right"),
) -> DataFrame:
    """Equi join in which clashing non-key names get a suffix.

    Equal key names appear once; different key names are both kept.
    """
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = lk if right_on is None else [right_on] if isinstance(right_on, str) else list(right_on)
    shared = {a for a, b in zip(lk, rk) if a == b}
    clash = (set(left.columns) & set(right.columns)) - shared
    l_names = {c: c + suffixes[0] for c in clash if suffixes[0]}
    r_names = {c: c + suffixes[1] for c in clash if suffixes[1]}
    left, right = left.withColumnsRenamed(l_names), right.withColumnsRenamed(r_names)
    hidden = {b: f"__{b}" for b in shared}
    right = right.withColumnsRenamed(hidden)
    pairs = [(l_names.get(a, a), hidden.get(b, r_names.get(b, b))) for a, b in zip(lk, rk)]
    condition: Column | None = None
    for a, b in pairs:
        test = left[a] == right[b]
        condition = test if condition is None else condition & test
    joined = left.join(right, condition, how)
    return joined.drop(*hidden.values())


def keep_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str], key_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key occurs in ``keys`` (left semi join, on one or several columns)."""
    names = [on] if isinstance(on, str) else list(on)
    source = key_columns or keys.columns[: len(names)]
    wanted = keys.select(*[F.col(s).alias(n) for s, n in zip(source, names)])
    return df.join(wanted, names, "left_semi")


def drop_keys(df: DataFrame, on: str, *exclusions: DataFrame) -> DataFrame:
    """Rows whose key is in none of the exclusion sets; a null key is kept.

    The sets (first column each) are united first, so the table is joined once.
    """
    union = None
    for keys in exclusions:
        part = keys.select(F.col(keys.columns[0]).alias(on))
        union = part if union is None else union.unionByName(part)
    return df.join(union.distinct(), on, "left_anti")


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    table_value: str,
    out: str,
    default: str | int | float | None = None,
) -> DataFrame:
    """Add ``out`` from a lookup table; unknown keys give null, or ``default``.

    Of several rows with one key the largest value is used, so the join never
    multiplies rows.
    """
    pairs = table.groupBy(F.col(table_key).alias("__key")).agg(F.max(table_value).alias("__value"))
    joined = df.join(pairs, df[key] == pairs["__key"], "left")
    value = F.col("__value") if default is None else F.coalesce(F.col("__value"), F.lit(default))
    return joined.withColumn(out, value).drop("__key", "__value")


def scale_listed(df: DataFrame, key: str, amount: str, keys: DataFrame, factor: float) -> DataFrame:
    """Multiply ``amount`` on the rows whose key is in ``keys``."""
    listed = keys.select(F.col(keys.columns[0]).alias(key)).distinct().withColumn("__hit", F.lit(True))
    joined = df.join(listed, key, "left")
    scaled = F.when(F.col("__hit"), F.col(amount) * factor).otherwise(F.col(amount))
    return joined.withColumn(amount, scaled).drop("__hit").select(*df.columns)


def compare_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys with the side they occur on: ``both``, ``left`` or ``right``."""
    sides = left.select(F.col(key), F.lit(1).alias("s")).unionByName(right.select(F.col(key), F.lit(2).alias("s")))
    merged = sides.where(F.col(key).isNotNull()).groupBy(key).agg(F.bit_or("s").alias("s"))
    return merged.select(key, F.when(F.col("s") == 3, "both").when(F.col("s") == 1, "left").otherwise("right").alias("side"))


def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with that ``side``, each as often as it is missing on the other."""
    names = left.columns
    more = lambda a, b, side: a.exceptAll(b.select(*names)).withColumn("side", F.lit(side))
    return more(left, right, "left").unionByName(more(right.select(*names), left, "right"))


def column_sets(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Column names on one side only, on both, and on exactly one of the two."""
    a, b = left.columns, right.columns
    return {
        "left_only": [c for c in a if c not in b],
        "right_only": [c for c in b if c not in a],
        "common": [c for c in a if c in b],
        "exactly_one": [c for c in [*a, *b] if (c in a) != (c in b)],
    }


def split_ids(df: DataFrame, column: str, out: str = "id", item: str = ";", part: str | None = ":") -> DataFrame:
    """Distinct ids from a delimited text column such as ``12:1600;34``.

    Items are exploded, cut at ``part``, cast to long; what is not a number is dropped.
    """
    from tideline.functions.text import before

    items = df.where(F.col(column).isNotNull()).select(F.explode(F.split(column, item, -1)).alias("__item"))
    number = F.col("__item") if part is None else before(F.col("__item"), part)
    return items.select(number.try_cast("long").alias(out)).where(F.col(out).isNotNull()).distinct()


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    merged = None
    for frame in frames:
        merged = frame if merged is None else merged.unionByName(frame)
    return merged
