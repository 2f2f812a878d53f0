"""Feature operators: fitted once, applied to any table of the same shape.

``fit_*`` functions read a table and return a small plain Python value (a
vocabulary, a range, a median).  The matching apply functions are pure
projections, so scoring uses exactly what training saw.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import dates, numeric, text
from tideline.operators.aggregates import relative_frequency
from tideline.operators.profile import long_values, name_at
from tideline.operators.running import exact_quantiles

MISSING_CATEGORY = "<NA>"
MEDIAN = "median()"


class VocabularyTooLarge(ValueError):
    """A column has more categories than a wide encoding should create."""


#: Categories that the preparation makes columns of, unless another number is given; ``None`` lifts the limit.
WIDE_LIMIT = 10_000


# -- filling -----------------------------------------------------------------


def fit_fill(df: DataFrame, values: Mapping[str, object]) -> dict[str, object]:
    """Resolve ``median()`` entries; the others are taken as they are."""
    wanted = [c for c, value in values.items() if value == MEDIAN]
    medians = {}
    if wanted:
        # All columns in one pass; a column without a value has no median.
        long = long_values(df, wanted, "double").select(name_at(wanted), "value")
        medians = {r["column"]: r["m"] for r in exact_quantiles(long, "value", {"m": 0.5}, ["column"]).collect()}
    return {c: medians.get(c) if value == MEDIAN else value for c, value in values.items()}


def apply_fill(df: DataFrame, fitted: Mapping[str, object]) -> DataFrame:
    """Fill nulls; a listed column that is missing is added with its fill value."""
    changes = {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for c, value in fitted.items():
        if value is None:
            continue
        if c not in kinds:
            changes[c] = F.lit(value)
        else:
            changes[c] = F.coalesce(F.col(c), F.lit(value).try_cast(kinds[c]))
    return df.withColumns(changes)


def presence_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_boolean": F.col(c).isNotNull() for c in columns})


# -- text and lookups --------------------------------------------------------


def packed(df: DataFrame, used: Sequence[str]) -> DataFrame:
    """The ``used`` columns, and all others as one value: joins one after the other copy it whole instead of column by column.

    The value is an array of one struct, as a plain struct would be taken
    apart again below the joins as soon as a field of it is not read.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in used]
    rest = [F.array(F.struct(*others)).alias("__rest")] if others else []
    return df.select(*[F.col(f"`{c}`") for c in used], *rest)


def unpacked(df: DataFrame, names: Sequence[str], used: Sequence[str]) -> DataFrame:
    """The columns ``names`` of a table whose columns other than ``used`` were packed."""
    return df.select(*[F.col(f"`{c}`") if c in used else F.element_at("__rest", 1).getField(c).alias(c) for c in names])


def replace_in(df: DataFrame, mappings: Mapping[str, Mapping]) -> DataFrame:
    changes = {}
    for c, mapping in mappings.items():
        textual = isinstance(df.schema[c].dataType, T.StringType)
        changes[c] = text.replace_values(F.col(c), dict(mapping), textual)
    return df.withColumns(changes)


def country_name(df: DataFrame, countries: DataFrame, code: str = "country_code", out: str = "country_name") -> DataFrame:
    """Alpha-2 code to lower-case country name.

    ``countries`` holds (code, name).  An unknown code gives ``unknown``, a
    null code stays null.
    """
    table = countries.select(F.col(countries.columns[0]).alias("__code"), F.col(countries.columns[1]).alias("__name"))
    joined = df.join(table.dropDuplicates(["__code"]), df[code] == F.col("__code"), "left")
    name = F.when(F.col(code).isNotNull(), F.lower(F.coalesce("__name", F.lit("Unknown"))))
    return joined.withColumn(out, name).drop("__code", "__name")


def group_synonyms(df: DataFrame, column: str, synonyms: DataFrame, out: str) -> DataFrame:
    """Canonical group of a free text; unlisted texts give null.

    ``synonyms`` holds (position, group, synonym); when a synonym is listed
    twice the group with the smallest position wins.
    """
    position, group, synonym = synonyms.columns[:3]
    table = synonyms.groupBy(text.lower_trim(F.col(synonym)).alias("__synonym")).agg(
        F.min_by(group, position).alias(out)
    )
    return df.join(table, text.lower_trim(df[column]) == F.col("__synonym"), "left").drop("__synonym")


def enrich_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Merge declared values with their enrichment.

    For each (enrichment, declared) pair: the enrichment as ``feat_init_*``,
    declared-else-enrichment as ``feat_final_*``, and whether the enrichment
    was present.  The two inputs are dropped.
    """
    added, used = {}, []
    for enrichment, declared in pairs:
        added[f"feat_init_{declared}"] = F.col(enrichment)
        kind = df.schema[declared].dataType
        fallback = F.col(enrichment)
        if kind != df.schema[enrichment].dataType:
            fallback = fallback.try_cast(kind)
        added[f"feat_final_{declared}"] = F.coalesce(F.col(declared), fallback)
        added[f"{enrichment}_boolean"] = F.col(enrichment).isNotNull()
        used += [enrichment, declared]
    return df.withColumns(added).drop(*used)


def location(df: DataFrame) -> DataFrame:
    key = text.location_key(F.col("italian_region"), F.col("region_enrichment"), F.col("country_name"))
    region = F.coalesce(F.lower("italian_region"), F.lower("region_enrichment"), F.lit(""))
    return df.withColumns({"location": key, "italian_region": region}).drop("country_code", "region_enrichment")


# Sales state of a deal as an ordinal; unlisted states stay.
DEAL_STATE_ORDINAL = {
    "Hot Lead": "2",
    "Cold Deal (MQL)": "3",
    "Cold Deal": "3",
    "Hot Deal (MQL)": "4",
    "Closed_Lost_Edition": "1",
    "Closed_Lost_Background": "1",
    "Closed_Lost_Format": "1",
    "Closed_Lost_Other": "1",
    "Closed_Lost_Price": "1",
    "Closed_Lost_Location": "1",
    "Closed_Lost_No_TAG": "1",
}


def deal_state(col: Column) -> Column:
    """Ordinal text of the deal state; null becomes its own category."""
    known = F.coalesce(col.cast("string"), F.lit(MISSING_CATEGORY))
    return text.map_values(known, DEAL_STATE_ORDINAL, known)


def combined_profile(df: DataFrame) -> DataFrame:
    total = F.col("professional_profile") + F.col("personal_profile")
    return df.withColumns(
        {"combined_profile": F.coalesce(total, F.lit(0.0)), "combined_profile_boolean": total.isNotNull()}
    ).drop("professional_profile", "personal_profile")


# -- scaling -----------------------------------------------------------------


def fit_range(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Minimum and maximum per column.

    Robust scaling followed by min-max scaling is min-max scaling: the first
    is an increasing affine map, which the second undoes.
    """
    row = df.agg(*[fn(F.col(c).cast("double")) for c in columns for fn in (F.min, F.max)]).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}


def apply_range(df: DataFrame, fitted: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    changes = {}
    for c, (low, high) in fitted.items():
        if low is None or high == low:
            changes[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            changes[c] = (F.col(c).cast("double") - low) / (high - low)
    return df.withColumns(changes)


# -- one-hot, multi-hot, label codes ----------------------------------------


def category(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(MISSING_CATEGORY))


def vocabularies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) of every category, null as ``<NA>``, in one shuffle."""
    texts = df.select(*[category(F.col(c)).alias(c) for c in columns])
    return long_values(texts, columns, "string").distinct().select(name_at(columns), "value")


def _collect_vocabulary(table: DataFrame, columns: Sequence[str], cap: int | None) -> dict[str, list[str]]:
    """Fetch the values, which become columns of their own.

    With ``cap``, more values than that for a column are an error and not a
    cut.  For columns of any number of values there is the sparse form.
    """
    found: dict[str, list[str]] = {c: [] for c in columns}
    if cap is not None:
        over = table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap).select("column").collect()
        if over:
            raise VocabularyTooLarge(f"{over[0][0]} has more than {cap} categories; the sparse encoding takes any number")
    for r in table.collect():
        found[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in found.items()}


def fit_one_hot(df: DataFrame, columns: Sequence[str], cap: int | None = None) -> dict[str, list[str]]:
    return _collect_vocabulary(vocabularies(df, columns), columns, cap)


def encoded_name(column: str, value: str) -> str:
    return re.sub(r"[\[\]<]", "_", f"{column}_{value}")


def apply_one_hot(df: DataFrame, fitted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by a 0.0 / 1.0 column per known category."""
    added = [
        (category(F.col(c)) == v).cast("double").alias(encoded_name(c, v)) for c, values in fitted.items() for v in values
    ]
    kept = [re.sub(r"[\[\]<]", "_", c) for c in df.columns if c not in fitted]
    sources = [c for c in df.columns if c not in fitted]
    return df.select(*[F.col(f"`{s}`").alias(k) for s, k in zip(sources, kept)], *added)


def list_vocabularies(df: DataFrame, columns: Sequence[str], separator: str = ";") -> DataFrame:
    """(column, value) of every item of delimited lists; rows without a list add none."""
    lists = long_values(df, columns, "string").distinct()
    items = lists.select("i", F.explode(F.split("value", separator, -1)).alias("value")).distinct()
    return items.select(name_at(columns), "value")


def fit_multi_hot(df: DataFrame, columns: Sequence[str], cap: int | None = None, separator: str = ";") -> dict[str, list[str]]:
    """Items that occur in delimited lists; rows without a list add none."""
    return _collect_vocabulary(list_vocabularies(df, columns, separator), columns, cap)


# -- sparse encoding ----------------------------------------------------------


def fit_places(vocabulary: DataFrame) -> DataFrame:
    """(column, value, place): a place of its own for each value of a vocabulary, from 0, by column and value.

    The vocabulary stays a table, so a column may have any number of values.
    """
    from tideline.operators.running import row_numbers

    numbered = row_numbers(vocabulary.select("column", "value").distinct(), ["column", "value"], "__n")
    return numbered.select("column", "value", (F.col("__n") - 1).alias("place"))


#: Values of a column up to which the tasks carry its places, so that no row has to move.
NEAR = 4096


def _near_places(places: DataFrame, names: Sequence[str]) -> dict[str, dict[str, list[int]]]:
    """Value to places of those of the columns ``names`` that have at most ``NEAR`` places."""
    asked = places.where(F.col("column").isin(list(dict.fromkeys(names))))
    counts = {r["column"]: r["n"] for r in asked.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    near: dict[str, dict[str, list[int]]] = {c: {} for c in names if counts.get(c, 0) <= NEAR}
    for r in asked.where(F.col("column").isin(list(near))).collect():
        near[r["column"]].setdefault(r["value"], []).append(r["place"])
    return near


def _look_up(known: Sequence[Mapping[str, list[int]]], separators: Sequence[str | None]) -> Callable[..., Column]:
    """A function of one text column for each of ``known``: the places of the texts, or of their items if it has a separator."""

    def places_of(text: str | None, at: int) -> list[int]:
        if text is None:
            return []
        items = [text] if separators[at] is None else text.split(separators[at])
        return [p for item in dict.fromkeys(items) for p in known[at].get(item, ())]

    def run(*texts: pa.Array) -> pa.Array:
        found = []
        for at, column in enumerate(texts):
            coded = column.dictionary_encode("encode")
            lists = [places_of(text, at) for text in coded.dictionary.to_pylist()]
            codes = coded.indices.to_numpy(zero_copy_only=False)
            counts = np.array([len(x) for x in lists], dtype=np.int64)
            found.append((codes, counts, np.cumsum(counts) - counts, np.array([p for x in lists for p in x], dtype=np.int64)))
        rows = sum(counts[codes] for codes, counts, _, _ in found)
        offsets = np.concatenate([[0], np.cumsum(rows)])
        out, at = np.empty(offsets[-1], dtype=np.int64), offsets[:-1].copy()
        for codes, counts, starts, values in found:
            # The places of a row follow each other: its place in ``out`` plus 0, 1, ... of its text's places.
            n = counts[codes]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(at, n) + step] = values[np.repeat(starts[codes], n) + step]
            at += n
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out))

    return F.arrow_udf(run, "array<bigint>")


def _places_far(df: DataFrame, key: str, places: DataFrame, columns: Sequence[str], lists: Sequence[str], separator: str) -> DataFrame:
    """(__key, __far): the places of each row's categories and items, with one row per item on the way."""
    items = [F.array(category(F.col(c))) for c in columns]
    items += [F.coalesce(F.split(F.col(c), separator, -1), F.array().cast("array<string>")) for c in lists]

    def named(column: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(column).alias("column"), v.alias("value")))

    pairs = [named(c, i) for c, i in zip([*columns, *lists], items)]
    long = df.select(F.col(key).alias("__key"), F.explode(F.concat(*pairs)).alias("p")).select("__key", "p.*")
    return long.join(places, ["column", "value"]).groupBy("__key").agg(F.collect_set("place").alias("__far"))


def encode_sparse(
    df: DataFrame, key: str, places: DataFrame, columns: Sequence[str], lists: Sequence[str] = (), separator: str = ";", out: str = "encoded"
) -> DataFrame:
    """Add the places of a row's categories and list items: a sorted array ``out`` of the ones of a 0/1 vector.

    ``columns`` hold one category each (null is one of its own), ``lists``
    delimited items.  Unknown values have no place.  ``key`` must be unique.

    The places of columns with few of them travel with the tasks and the rows
    stay where they are; columns with more are joined, with a row per item.
    """
    # A separator that is a pattern is left to Spark.
    plain = separator and not set(separator) & set("\\.^$*+?()[]{}|")
    near = _near_places(places, [*columns, *(lists if plain else [])])
    read = [(c, None) for c in columns if c in near] + [(c, separator) for c in lists if plain and c in near]
    far_columns, far_lists = [c for c in columns if c not in near], [c for c in lists if not plain or c not in near]
    ones = F.array().cast("array<bigint>")
    if read:
        texts = [F.col(f"`{c}`").cast("string") if by else category(F.col(f"`{c}`")) for c, by in read]
        ones = _look_up([near[c] for c, _ in read], [by for _, by in read])(*texts)
    rows = df
    if far_columns or far_lists:
        found = _places_far(df, key, places, far_columns, far_lists, separator)
        rows = df.join(found, df[key] == found["__key"], "left")
        ones = F.concat(ones, F.coalesce("__far", F.array().cast("array<bigint>")))
    return rows.withColumn(out, F.array_sort(F.array_distinct(ones))).drop("__key", "__far")


def sparse_vectors(
    df: DataFrame,
    key: str,
    numeric: Sequence[str],
    places: DataFrame,
    columns: Sequence[str],
    lists: Sequence[str] = (),
    separator: str = ";",
    out: str = "features",
) -> DataFrame:
    """Add a sparse vector: the numeric columns, then a one for each of the row's categories and list items.

    The places are joined as a table; only their number is known to the
    driver, so columns may have any number of values.  A null number is zero,
    unknown values have no place.  ``key`` must be unique.
    """
    last = places.agg(F.max("place")).first()[0]
    width = len(numeric) + (0 if last is None else last + 1)
    encoded = encode_sparse(df, key, places, columns, lists, separator, "__places")
    numbers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric]).cast("array<double>")
    rows = encoded.withColumn("__numbers", numbers)
    kept = [c for c in df.columns if c != out]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ones, numbers = batch.column("__places"), batch.column("__numbers")
            counts = np.diff(ones.offsets.to_numpy())
            wide = len(numeric)
            starts = np.concatenate([[0], np.cumsum(counts + wide)])
            indices, values = np.empty(starts[-1], dtype=np.int32), np.ones(starts[-1])
            head = (starts[:-1, None] + np.arange(wide)).ravel()
            indices[head], values[head] = np.tile(np.arange(wide), len(counts)), numbers.flatten().to_numpy(zero_copy_only=False)
            tail = np.ones(starts[-1], dtype=bool)
            tail[head] = False
            indices[tail] = ones.flatten().to_numpy(zero_copy_only=False) + wide
            offsets = pa.array(starts.astype(np.int32))
            vector = pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(len(counts), dtype=np.int8)),
                    pa.array(np.full(len(counts), width, dtype=np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(indices)),
                    pa.ListArray.from_arrays(offsets, pa.array(values)),
                ],
                ["type", "size", "indices", "values"],
            )
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], vector], names=[*kept, out])

    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(out, VectorUDT())])
    return rows.select(*kept, "__places", "__numbers").mapInArrow(build, schema)


# -- positive shares: categories of any number as one number -------------------


def fit_shares(df: DataFrame, columns: Sequence[str], label: str, prior: float = 1.0) -> DataFrame:
    """(column, value, share): how often the rows of a category are positive, drawn towards the overall share by ``prior`` rows.

    Null is a category.  One split of a tree on the share is the best split of
    the categories themselves, whatever their number; the table is never collected.
    """
    known = df.where(F.col(label).isNotNull())
    overall = known.select(F.coalesce(F.avg(F.col(label).cast("double")), F.lit(0.0))).scalar()
    texts = known.select(F.col(label).cast("double").alias("__y"), *[category(F.col(c)).alias(c) for c in columns])
    long = long_values(texts, columns, "string", ["__y"])
    counts = long.groupBy("i", "value").agg(F.sum("__y").alias("__p"), F.count(F.lit(1)).alias("__n"))
    share = (F.col("__p") + prior * overall) / (F.col("__n") + prior)
    return counts.select(name_at(columns), "value", share.alias("share"))


def apply_shares(df: DataFrame, shares: DataFrame, columns: Sequence[str], ending: str = "__share") -> DataFrame:
    """Add each column's share as ``<column>__share``, null for categories that were not seen."""
    for c in columns:
        table = shares.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("share").alias(f"{c}{ending}"))
        df = df.join(table, category(F.col(f"`{c}`")) == F.col("__value"), "left").drop("__value")
    return df


def item_name(column: str, item: str) -> str:
    return f"{column}_{item.replace(' (add notes)', '')}"


def apply_multi_hot(df: DataFrame, fitted: Mapping[str, Sequence[str]], separator: str = ";") -> DataFrame:
    """Replace each list column by a 0 / 1 column per known item."""
    added = [
        F.array_contains(text.list_items(F.col(c), separator), v).cast("int").alias(item_name(c, v))
        for c, values in fitted.items()
        for v in values
    ]
    return df.select(*[f"`{c}`" for c in df.columns if c not in fitted], *added)


def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Label codes as a table (column, value, code): position in sorted order.

    Kept as a table because code columns may have very many categories.
    """
    from tideline.operators.running import row_numbers

    values = long_values(df, columns, "string").distinct().select(name_at(columns), "value")
    numbered = row_numbers(values, ["value"], "__n", ["column"])
    return numbered.select("column", "value", (F.col("__n") - 1).alias("code"))


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Replace values by their code.  An unseen value is an error, or null if not strict."""
    out = packed(df, columns)
    for c in columns:
        table = codes.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        out = out.join(table, out[c].cast("string") == table["__value"], "left")
        code = F.col("__code")
        if strict:
            unseen = F.col(c).isNotNull() & F.col("__value").isNull()
            message = F.concat(F.lit(f"unseen category in {c}: "), F.col(c).cast("string"))
            code = F.when(unseen, F.raise_error(message).cast("long")).otherwise(code)
        out = out.withColumn(c, code).drop("__value", "__code")
    return unpacked(out, df.columns, columns)


# -- recency and career ------------------------------------------------------


def recency_scores(
    df: DataFrame, fields: Sequence[str], anchor: str | Column, total: str = "average_recency_score"
) -> DataFrame:
    """Points for the age of each date at the row's own anchor, and their sum."""
    at = F.col(anchor) if isinstance(anchor, str) else anchor
    scores = {f"time_since_{c}": dates.recency_points(dates.whole_days_between(at, F.col(c))) for c in fields}
    scores[total] = numeric.sum_ignoring_nulls(list(scores.values()))
    return df.withColumns(scores)


def _career_texts(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    clean = {c: text.lower_trim(F.col(c)) for c in texts}
    for c in ("previous_position", "feat_final_current_job", "feat_final_education_field"):
        clean[c] = F.coalesce(clean.get(c, F.col(c)), F.lit(""))
    return df.withColumns(clean)


def fit_career(df: DataFrame, texts: Sequence[str], target: str = "target") -> dict[str, DataFrame]:
    """Popularity tables (value, share) of the training rows: among the positives, and of industries among all rows."""
    df = _career_texts(df, texts)
    won = F.col(target) == 1
    industry, field_of_study = "current_company_industry", "feat_final_education_field"
    tables = {
        "industry_popularity": relative_frequency(df, industry, "share", won & (F.col(industry) != "")),
        "industry_popularity_all": relative_frequency(df, industry, "share"),
        "field_of_study_popularity": relative_frequency(df, field_of_study, "share", won),
    }
    return {name: t.select(F.col(t.columns[0]).alias("value"), "share") for name, t in tables.items()}


def apply_career(df: DataFrame, texts: Sequence[str], fitted: Mapping[str, DataFrame]) -> DataFrame:
    """Cleaned career texts, size band, fitted popularities (null for unseen values) and progression."""
    df = _career_texts(df, texts).withColumn("company_size_category", numeric.company_size_band(F.col("current_company_size")))
    for name, table in fitted.items():
        column = "feat_final_education_field" if name.startswith("field") else "current_company_industry"
        known = table.select(F.col("value").alias("__value"), F.col("share").alias(name))
        df = df.join(known, F.col(column) == F.col("__value"), "left").drop("__value")
    return df.withColumn(
        "career_progression", numeric.changed_flag(F.col("previous_position"), F.col("feat_final_current_job"))
    )


def career_features(df: DataFrame, texts: Sequence[str], target: str = "target") -> DataFrame:
    """Career features of the rows that the popularities are fitted on."""
    return apply_career(df, texts, fit_career(df, texts, target))
