"""CSV, JSON-record, stage hand-off and schema files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line; without a schema every column is text."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Hand a stage's table to the next one as parquet, and return it read back."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_buckets(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int = 200) -> DataFrame:
    """Hand a stage's table on in buckets of its keys, sorted by them, and return it read back.

    Tables with the same keys and number of buckets join and aggregate on them
    without an exchange.  ``table`` is entered in the catalog, the files lie
    under ``path``.
    """
    # One task per bucket, so that a bucket is one sorted file.
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def records_table(spark: SparkSession, records: Iterable[Mapping], schema: T.StructType | None = None) -> DataFrame:
    """A short request (list of dicts) as a table."""
    rows = [dict(r) for r in records]
    if schema is None:
        return spark.createDataFrame(rows)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def read_record_files(
    spark: SparkSession, path: str, record_schema: T.StructType, one_per_file: bool = False
) -> DataFrame:
    """Requests of the form ``{"data": [{...}, ...]}``, one output row per record.

    A file holds one request per line (and can then be split over tasks), or a
    single pretty-printed one.
    """
    envelope = T.StructType([T.StructField("data", T.ArrayType(record_schema))])
    files = spark.read.schema(envelope).option("multiLine", one_per_file).json(path)
    return files.select(F.inline("data"))


def save_schema(df: DataFrame, path: str, columns: Iterable[str] | None = None) -> None:
    """Store the schema of the model's features as JSON in the shared file system."""
    wanted = df.select(*columns) if columns is not None else df
    spark = df.sparkSession
    spark.createDataFrame([(wanted.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first().value))
