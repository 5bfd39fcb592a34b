"""From documents to packed sequences: toxicity, near copies, secrets, mixing, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import mixing, near, packing, secrets, toxicity
from pulsegrid.llm.common import table, whole_rows
from pulsegrid.llm.queries import VOCABULARY
from pulsegrid.runtime import use_checkpoint_dir

# What the stage links: sets of five-word shingles of a Jaccard similarity of 0.8 or more, each link checked on both texts.
SIMILAR = near.Similarity(shingle=5, least=0.8)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(whole_rows(docs, "text"), model).where("predicted = 0").select("_doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.keep_one(docs, SIMILAR)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    clean = secrets.redact(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths with their token ids."""
    return packing.pack(docs, VOCABULARY, keep=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

# Toxicity scores, fingerprints and random ranks have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in turn to `documents`; each one's rows are written below the checkpoint folder and read again."""
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
