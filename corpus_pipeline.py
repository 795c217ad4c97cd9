"""A training corpus from `documents`, stage by stage.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents:

- toxicity: the noisy-or model is trained on the labels and on the documents given; what it
  predicts toxic goes.
- exact_dedup: of equal texts the smallest doc_id stays.
- near_dedup: of each group of near-duplicates one document stays.
- mixing: documents are drawn by probabilities raked to source, language and topic.
- packing: pieces of documents placed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconlake.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from beaconlake.llm.common import documents, labels, saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, toxicity.train(docs, labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.kept_documents(docs)


def draw(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sampled_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
    ("mixing", draw), ("packing", pack),
]

# Training, hashing and tokenizing are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
