"""Corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import mixing, ngram_join, packing, pii, toxicity
from sievework.shared import stored, table

#: The classifier is fitted, personal data is permuted by key and packing is a search: no SQL.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; similar from 0.51 on."""
    return ngram_join.one_of_each_group(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets pseudonyms of its own format; n_chars follows the text."""
    return pii.pseudonymise(docs, pii.session_key(spark)).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, by the weights of the tree; a document comes once for each epoch that selects it."""
    out, epoch = mixing.mix(docs)
    return out.drop(epoch)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    return packing.sequences(docs)


STAGES: list = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", pseudonymise),
    ("mixture", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
