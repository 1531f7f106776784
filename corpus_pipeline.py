"""The corpus pipeline: from raw documents to packed training sequences.

Each stage gets the documents that the one before kept, written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm import hosts, language, packing, simhash, substrings
from starkit.llm.common import fresh_name, stored

# A document is rejected if its language is less likely than this, or cannot be told.
MIN_LANGUAGE_SCORE = 0.5
# Near-duplicates: words of a shingle, and bits in which linked fingerprints may differ.
NEAR_WORDS, NEAR_DISTANCE = 4, 4
TOKENIZER = "word_bpe_49k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    Null texts and texts without a letter go. Whole texts are read, however long; repeated
    rows and rows without id are judged each. A table without labelled texts keeps nothing.
    """
    names = fresh_name(docs, "_lang_pred"), fresh_name(docs, "_lang_score")
    found = language.identify(docs, language.train_on_rest(docs), names)
    sure = (F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= MIN_LANGUAGE_SCORE)
    return found.filter(sure).drop(*names)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither their own rules nor their host's reject.

    Null and empty texts have no words and go; a row without host is judged by its text;
    repeated rows count each.
    """
    return hosts.keep_good(docs)


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Texts without a word are one group; of repeated rows one stays; a row without id stays
    only if no other of its group has one.
    """
    return simhash.keep_first(docs, NEAR_DISTANCE, NEAR_WORDS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay only where they come first.

    Every row stays, null and empty texts as they are; a row without id comes after all
    others. ``n_chars``, where it is a column, is that of the text that is left.
    """
    cut = substrings.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each in a sequence of at most 4096 tokens.

    A null or empty text is one piece of one id; repeated rows are pieces of their own;
    long texts are cut and nothing is lost.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", first_of_near_duplicates),
    ("substrings", without_repeated_passages),
    ("packing", packed_sequences),
]

# Fingerprints, trained models and packing cannot be told in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
