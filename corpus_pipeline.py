"""Corpus pipeline: documents to token ids in five stages, each written as Parquet and read again.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame. All but the last return the columns of documents, extra ones too.

Null texts count as empty. Rows with a null id have no name by which a stage
could keep one and drop another, so they pass all stages that choose by id.
Rows of equal id are one document from the second stage on. Empty tables give
empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm import mixing, near_copies, suffix_dedup, toxicity
from foliary.llm.bpe import bpe_decode, bpe_encode
from foliary.llm.common import fresh_dir, table
from foliary.llm.queries import vocabulary
from foliary.llm.token_counts import with_token_counts

#: Parameters of the stages.
TOXIC_FROM = 0.3
WORDS, SIMILARITY = 5, 0.8
REPEAT_BYTES = 250
TOKEN_BUDGET = 0.9


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the chosen ids, and those without an id."""
    return docs.where("doc_id is not null").join(ids, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The model is fitted on labelled rows of the corpus (operator 10)."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.toxic_filter(docs, model, TOXIC_FROM)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies (five words, similarity 0.8) the document of the smallest id stays (operator 3)."""
    groups = near_copies.near_copy_groups(docs, WORDS, SIMILARITY)
    keep = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = _chosen(docs, keep)
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 250 bytes or more that repeat anywhere are cut out (operator 5); documents of which nothing is left go.

    250 bytes are less than 51 words of this corpus in most places, not in all:
    1.4% of the windows of 51 words in sf0.1 are shorter (the least has 101
    bytes), and such a repeat stays unless it goes on. Cuts keep to whole
    characters: a character of which only some bytes are covered goes as well.
    """
    cut = suffix_dedup.remove_repeats(docs, REPEAT_BYTES).where("n_removed > 0")
    kept = suffix_dedup.kept_texts(cut)
    joined = docs.join(kept, "doc_id", "left")
    text = F.coalesce("kept_text", "text")
    return joined.where((F.col("kept_text").isNull()) | (F.trim("kept_text") != "")).select(*[text.alias("text") if c == "text" else F.length(text).cast("bigint").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by probabilities raked to tempered source, language and topic shares of tokens (operators 7 and 6)."""
    slim = docs.select("doc_id", "text", *[c for c in ("source", "lang", "topic") if c in docs.columns])
    counted = with_token_counts(slim, vocabulary("byte_bpe_50k.json"))
    chosen = mixing.mix(counted, TOKEN_BUDGET, tokens_col="n_tokens").where("kept").select("doc_id").distinct()
    return _chosen(docs, chosen)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the hash of what they decode to (operator 1)."""
    path = vocabulary("word_bpe_49k.json")
    decoded = bpe_decode(bpe_encode(docs, path), path)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: SQL expresses none of the stages; the tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
