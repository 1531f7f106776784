"""The operators as queries on the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm import (
    binary,
    bpe,
    exact,
    hosts,
    language,
    nearest,
    packing,
    phrases,
    sharding,
    simhash,
    substrings,
    toxicity,
    trie,
)
from starkit.llm.oracles import ORACLES
from starkit.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

BYTE_TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again; digests of both."""
    path = public_tokenizers.path(BYTE_TOKENIZER)
    encoded = bpe.encode(_read(spark, sf_dir, "documents"), path)
    decoded = bpe.decode(encoded, path)
    decimals = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(decimals, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that an earlier document has are removed."""
    return substrings.remove_repeats(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in as few sequences of 4096 tokens as the islands find."""
    docs = _read(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every text, learned from the labels of four folds of five."""
    docs = _read(spark, sf_dir, "documents")
    rows = toxicity.labelled_rows(docs, _read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, toxicity.train(rows))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near-duplicates of every document."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from three folds of four."""
    docs = _read(spark, sf_dir, "documents")
    model = language.train_on_rest(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix rows with their segments, written to files; digests of the three byte columns
    as the files hold them."""
    docs = _read(spark, sf_dir, "documents")
    path = scratch_path(spark, "matrices")
    made = binary.matrices(docs, public_tokenizers.path(WORD_TOKENIZER))
    binary.write_matrices(made, path)
    rows = spark.read.schema(made.schema).parquet(path)
    return rows.select(
        "sequence_id",
        "n_tokens",
        "n_segments",
        "doc_ids",
        "pieces",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("cu_seqlens").alias("cu_seqlens_crc32"),
        F.crc32("position_ids").alias("position_ids_crc32"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot under a permutation of row numbers."""
    placed = sharding.shard_documents(_read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every text, and whether its own rules and its host's keep it."""
    return hosts.judged(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of each query among all others."""
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    queries = vectors.filter(F.pmod("vec_id", F.lit(nearest.QUERY_STEP)) == 0)
    return nearest.nearest(vectors, queries).select("query_id", "rank", "vec_id", "score")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(_read(spark, sf_dir, "conversations"))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts, white space apart, and whether it stays."""
    return exact.duplicates(_read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("text_digest")).alias("text_sha256")
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best collocations."""
    return phrases.collocations(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_substrings": op2_substrings,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op6_language": op6_language,
    "op7_binary": op7_binary,
    "op8_sharding": op8_sharding,
    "op9_hosts": op9_hosts,
    "op10_nearest": op10_nearest,
    "op11_trie": op11_trie,
    "op12_exact": op12_exact,
    "op13_phrases": op13_phrases,
}
