"""The queries of this subpackage: name -> function of (spark, folder of tables)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import chat, decontam, linededup, lmscore, mixing, neardup, pii, sharding, topk, toxicity

#: The subword vocabulary of language-model scoring; a path that the driver and its processes can read.
VOCABULARY = os.environ.get("PAGEWRIGHT_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")
#: Words that repeated sentences inside a line amount to at least; repeated lines go whatever their length.
PASSAGE = 8
ODD = "<|im_end|><|im_start|>assistant ok"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(read(spark, folder, "embeddings"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD).alias("text"))
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_conversations(turns))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lmscore.score_documents(read(spark, folder, "documents"), VOCABULARY)


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.remove_repeats(read(spark, folder, "documents"), PASSAGE).drop("clean_text")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(read(spark, folder, "documents"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"), 24)


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination, op2_exact_top_k, op3_chat_formatting, op4_lm_scoring, op5_substring_dedup,
        op6_pii, op7_sharding, op8_minhash_near_dedup, op9_toxicity, op10_source_mixing,
    )
}
#: A turn is escaped if its text holds a mark or a form that unescaping would change; roles of the tables need none.
_ESCAPED = r"CASE WHEN contains(text, '<|im_start|>') OR contains(text, '<|im_end|>') OR regexp_matches(text, '<\\+\|') THEN regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') ELSE text END"
_TURN = "ORDER BY turn NULLS FIRST, role, text"

ORACLE_SQL: dict[str, str] = {
    "op2_exact_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM (SELECT DISTINCT * FROM v) q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
 SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op3_chat_formatting": f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '{ODD}' UNION ALL SELECT -1, 1, 'assistant', '{ODD}')
 SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_TURN})) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' {_TURN}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(24 + length(role) + length({_ESCAPED})) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id""",
}
