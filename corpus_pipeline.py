"""A training corpus in five stages, each over all rows that the one before kept.

Toxic documents go, one document of each group of near copies stays, repeated strings
are removed, secrets are written as ``<secret>``, and what is left is packed into
sequences of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.llm.packing import encode, pack
from garimpo.llm.queries import BYTE_BPE
from garimpo.llm.secret_tags import learn, redact
from garimpo.llm.shared import written
from garimpo.llm.shingle_join import keep_one
from garimpo.llm.suffix_dedup import drop_repeats
from garimpo.llm.toxicity import keep_clean

#: No stage can be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the strings of 200 bytes that occur elsewhere; every document stays."""
    return _counted(drop_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values written as <secret>."""
    return _counted(redact(docs.select(*COLUMNS), learn(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids."""
    return pack(encode(docs, BYTE_BPE))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


STAGES = [
    ("toxicity", toxic),
    ("near copies", near_copies),
    ("repeated strings", repeats),
    ("secrets", secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
