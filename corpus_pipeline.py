"""The corpus pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import jaccard_join, language_id, line_dedup, mixing, packing
from tideline.llm.queries import TOKENIZER
from tideline.session import materialize


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts, texts without a letter and texts unlike any learned language go."""
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that an earlier line is like; n_chars counts what is left."""
    short = line_dedup.dedup(docs).withColumn("n_chars", F.length("text").cast("long"))
    return short.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return jaccard_join.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the weights of their sources: a document that is drawn again is there again."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences; repeats of a document are pieces of their own."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language id", identify),
    ("line dedup", dedup_lines),
    ("n-gram jaccard join", one_of_each),
    ("source mixing", mix),
    ("best-fit packing", pack),
]

#: The stages fit, draw and pack; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{place}-{name.replace(' ', '-')}")
    return docs
