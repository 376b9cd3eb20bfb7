"""The registered queries of the training-data operators: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm import chat, media, mixing, sharding, simhash, suffix_dedup, toxicity, winnowing
from foliary.llm.bpe import bpe_decode, bpe_encode
from foliary.llm.common import fresh_dir, table
from foliary.llm.token_counts import token_counts


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    decoded = bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.store_and_read(table(spark, sf_dir, "documents"), fresh_dir(spark, "media"))
    return read.select(
        F.col("key").cast("bigint").alias("doc_id"),
        "n_bytes",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        "media_bytes",
        F.sha2("data", 256).alias("media_sha256"),
        "feature",
        "error",
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, radius=2)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), left.alias("text"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=1024)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_control_conversation(table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_chats(rows))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.with_successor(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_media, op3_simhash, op4_shards, op5_suffix_dedup, op6_token_counts, op7_mix, op8_chat, op9_winnowing, op10_toxicity)}

#: DuckDB SQL, where SQL can express the operator.
ORACLE_SQL = {
    "op8_chat": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, v.turn, v.role, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) as v(turn, role)
), marked as (
  select *, role || chr(10) || text || chr(10) as told,
         '<|im_start|>' || regexp_replace(replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), '<(\\*)\|', '<\\\1|', 'g') || chr(10)
           || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) as written
  from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(told, '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(written)) as bigint) as formatted_chars,
       regexp_matches(string_agg(role || ';', '' order by turn, role, text), '^(system;)?user;assistant;((user;|(tool;)+)assistant;)*$') as valid
from marked group by conv_id
""",
}
