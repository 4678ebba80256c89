"""From raw documents to packed sequences: five stages, each over all that the one before it kept.

run() writes every stage's rows as Parquet under the shared checkpoint folder and reads them again, so a
lost executor costs at most the running stage. ORACLE_SQL is None: trained scores, sketches and a linear
program have no SQL; tests/llm holds the stages against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import mixing, omh, packing, suffix, toxicity
from claimloom.session import checkpoint_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier calls toxic go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return omh.keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they first occur."""
    return suffix.without_repeats(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the expected tokens of the domains meet their targets."""
    return mixing.mix(docs, table(spark, sf_dir, "labels").select("doc_id", mixing.label_domains().alias("domain")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
