"""From documents to packed sequences, stage by stage; each reads what the last one wrote."""

from __future__ import annotations

import sys
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from obs_engine.llm import exact_dedup, packing, quality, simhash, toxicity  # noqa: E402
from obs_engine.session import scratch_path  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the labelled ones.

    Documents without labels of both kinds raise, as all of them would be kept.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if model is None and not docs.isEmpty():
        raise ValueError("no documents with both labels to learn toxicity from")
    return toxicity.drop_toxic(docs, model)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their ids and the checksum of these."""
    return packing.with_checksum(packing.pack(docs), keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("packing", pack),
]

# Scores of a trained model and linked fingerprints are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:6]}")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
