"""Training-corpus pipeline over ``documents``.

Five stages, each an operator of ``tarn.llm``; a stage works on all that
its predecessor kept. Every stage but the last returns the columns of
``documents``: toxic documents go, of each group of near copies one
document stays, documents with a benchmark passage go, sources are mixed
to target weights (a document is repeated as often as the mix takes it),
and what is left is put into shards.

Near copies are documents linked by 80 % of their five-word shingles.
Every stage takes any documents: a null or empty text is never toxic,
copies nothing, holds no passage and is taken as often as the whole part of
its source's rate says (its size is 0); rows are known by id and text, so ids may be null or repeat with other texts, and of equal rows one
stays at the second stage; texts are read whole, however long; an empty
table gives no rows; extra columns are carried up to the last stage, which
returns the digest of the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarn.llm.common import Scratch, read_table
from tarn.llm.decontaminate import drop_contaminated
from tarn.llm.hilbert import document_shards, shard_digest
from tarn.llm.jaccard import drop_near_copies
from tarn.llm.mixing import document_mix
from tarn.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return document_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_digest(document_shards(docs))


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: None: learned scores and random rounding are no SQL; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{number}_{name}")
        if number > 1:
            scratch.drop(f"{number - 2}_{STAGES[number - 2][0]}")
    return docs
