"""A training-corpus pipeline from the operators of zonewright.llm.

Each stage works on all that its predecessor kept, written as Parquet and read again. Documents whose language the
evidence does not decide go; one document of each group of near-duplicates stays; personal data is replaced; sources are
mixed to their weights, small ones repeated and none cut; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonewright.llm import jaccard_join, language, mixing, packing, pii
from zonewright.llm.common import discard, materialize
from zonewright.sources.staging import collected, remove


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_entities(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # executors that have run the stages before hold a full heap; the memory beside it is scarcer here than time
    return packing.pack(docs, packing.tokenizer_path(), texts_at_once=250, remembered=100_000)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources", mixture),
    ("packing", packed),
]

#: Text models, chosen paths and differencing have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with collected() as scratch:
            out = stage(spark, docs, sf_dir)
        docs = materialize(out, name.replace(" ", "-"))
        # what the stage read and staged is not needed once its result is written
        remove(spark, scratch)
        if written is not None:
            discard(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
