"""One query for each operator, over its whole table and with production parameters.

The thin queries derive their digest columns from what the operators return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.llm import (
    attention_lm,
    centroids,
    exact_dedup,
    merkle,
    minhash,
    packing,
    quality,
    sentencepieces,
    simhash,
    token_counts,
    tool_calls,
    toxicity,
    training_order,
)
from obs_engine.llm.common import bucket_of
from obs_engine.llm.oracles import ORACLES  # noqa: F401  (read by the entry module)

ORDER_KEY = 20_240_229

# Tools of the derived calls.
SCHEMAS = {
    "search": {
        "type": "object",
        "required": ["query", "limit"],
        "properties": {
            "query": {"type": "string"},
            "limit": {"type": ["integer", "null"], "minimum": 1, "maximum": 40},
        },
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "required": ["text", "to"],
        "properties": {"text": {"type": "string", "minLength": 1}, "to": {"enum": ["en", "fr", "de"]}},
    },
    "summarise": {
        "type": "object",
        "required": ["text"],
        "properties": {"text": {"type": "string"}, "words": {"type": "number"}},
    },
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = training_order.write_training_order(docs, ORDER_KEY)
    kind = docs.schema["doc_id"].dataType
    shards = training_order.read_training_order(spark, path, kind, ordered=False)
    return shards.select(
        F.col("id").alias("doc_id"),
        "sequence_no",
        "slot",
        "shard",
        "place",
        "n_tokens",
        F.octet_length("ids").cast("long").alias("stride"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_checksum(packing.pack(documents(spark, sf_dir)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "row.doc_id",
        (bucket_of(F.col("row.doc_id"), toxicity.FOLDS) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, sf_dir))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode(documents(spark, sf_dir).select("doc_id", "text"))
    return encoded.select(
        "row.doc_id",
        "n_pieces",
        "n_bytes",
        F.crc32("piece_ids").alias("ids_crc32"),
        F.round("log_score", 3).alias("log_score"),
        "round_trip",
    )


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made of turns: a user's turn calls, the assistant's next turn answers.

    The hash of a text chooses the tool, leaves out or breaks an argument, and lets a call wait
    for the ones two and six turns before.
    """
    number = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    arguments = F.when(
        number % 3 == 0,
        F.to_json(F.struct(F.col("text").alias("query"), (number % 47).alias("limit"))),
    ).when(
        number % 3 == 1,
        F.to_json(
            F.struct("text", F.element_at(F.array(*map(F.lit, ("en", "fr", "de", "es"))), (number % 4 + 1).cast("int")).alias("to"))
        ),
    )
    broken = F.to_json(F.struct(F.length("text").cast("string").alias("words")))
    usual = F.to_json(F.struct("text", F.length("text").alias("words")))
    calls = conversations.where("role = 'user'").select(
        "conv_id",
        "turn",
        F.concat(F.lit("call-"), "turn").alias("call_id"),
        F.element_at(F.array(*map(F.lit, SCHEMAS)), (number % 3 + 1).cast("int")).alias("name"),
        F.coalesce(arguments, F.when(number % 7 == 0, broken).otherwise(usual)).alias("arguments"),
        F.filter(
            F.array(
                F.when((F.col("turn") >= 2) & (number % 2 == 0), F.concat(F.lit("call-"), F.col("turn") - 2)),
                F.when((F.col("turn") >= 6) & (number % 5 < 2), F.concat(F.lit("call-"), F.col("turn") - 6)),
            ),
            lambda need: need.isNotNull(),
        ).alias("needs"),
    )
    results = conversations.where("role = 'assistant'").select(
        "conv_id",
        "turn",
        F.concat(F.lit("call-"), F.col("turn") - 1).alias("call_id"),
        F.to_json(F.struct(F.col("text").alias("answer"))).alias("content"),
    )
    return calls, results


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = derived_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return tool_calls.link_calls(calls, results, SCHEMAS)


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(documents(spark, sf_dir))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir)).drop("copies")


QUERIES = {
    f.__name__: f
    for f in (
        op1_training_order,
        op2_simhash,
        op3_packing,
        op4_quality,
        op5_token_counts,
        op6_toxicity,
        op7_exact_dedup,
        op8_sentencepiece,
        op9_tool_calls,
        op10_attention_lm,
        op11_centroids,
        op12_minhash,
        op13_merkle,
    )
}
