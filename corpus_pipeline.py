"""Stages that turn the ``documents`` table into training text.

Every stage takes the rows and columns of the one before, clashing names included, and
handles null ids, texts and hosts, repeated rows, very long texts and empty tables as the
operator it calls says; ties between equal documents go to the smallest id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, host_rules, pieces, pii, simhash
from tidemark.llm.queries import PIECE_MODEL, pseudonym_key
from tidemark.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; null and empty texts fail, repeated rows are judged alike."""
    return host_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within three bits stays."""
    return simhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go; null texts hold none and stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms; null texts stay null."""
    return pii.pseudonymize(docs, key=pseudonym_key(spark)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SentencePiece ids of what is left, a row per row."""
    return pieces.encode_documents(docs, pieces.read_model(PIECE_MODEL))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("personal data", personal_data),
    ("sentencepiece", encode),
]

# Fingerprints, edit distances, keyed permutations and token lattices are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
