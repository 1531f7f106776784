"""Shards by a pseudo-random permutation of global row numbers.

Rows are numbered 0..n-1. A Feistel network permutes the smallest power of four that
holds n; a number that lands outside is permuted again until it lands inside (cycle
walking), which makes a permutation of 0..n-1. The permuted number says shard and slot:
both can be computed for any row, and the row for any slot, without a table or a sort.
Numbers depend on the rows alone, so the shuffle is the same however they are stored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import documents, stored
from starkit.llm.windows import mixed
from starkit.operators.keys import dense_row_key

SHARDS = 40
SEED = 20_240_229
ROUNDS = 6
# Added to a text's bytes, for what a record costs besides.
RECORD_BYTES = 16


def _half_bits(count: int) -> int:
    return max(1, -(-max(0, count - 1).bit_length() // 2))


def _round_keys(seed: int) -> np.ndarray:
    return mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _network(numbers: np.ndarray, half: int, keys: np.ndarray, back: bool) -> np.ndarray:
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = numbers >> bits, numbers & mask
    if back:
        left, right = right, left
    for key in keys[::-1] if back else keys:
        left, right = right, left ^ (mixed(right ^ key) & mask)
    if back:
        left, right = right, left
    return left << bits | right


def permuted(numbers: np.ndarray, count: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """Each of ``numbers`` (below ``count``) under the permutation, or under its inverse."""
    half, keys = _half_bits(count), _round_keys(seed)
    found = _network(np.asarray(numbers, np.uint64), half, keys, back)
    outside = np.flatnonzero(found >= count)
    while len(outside):
        found[outside] = _network(found[outside], half, keys, back)
        outside = outside[found[outside] >= count]
    return found.astype(np.int64)


def place_of(rows: np.ndarray, count: int, shards: int = SHARDS, seed: int = SEED):
    """Shard and slot of row numbers."""
    place = permuted(rows, count, seed)
    return place % shards, place // shards


def row_at(shard: np.ndarray, slot: np.ndarray, count: int, shards: int = SHARDS, seed: int = SEED):
    """The row number in a slot of a shard."""
    return permuted(np.asarray(slot) * shards + np.asarray(shard), count, seed, back=True)


def assign(numbered: DataFrame, count: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``numbered`` with ``shard`` and ``slot`` for its column ``row_number`` (from 0)."""

    @F.pandas_udf("bigint")
    def place(rows):
        import pandas as pd

        return pd.Series(permuted(rows.to_numpy(), count, seed))

    return (
        numbered.withColumn("_place", place("row_number"))
        .withColumn("shard", F.pmod("_place", F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"_place div {shards}L"))
        .drop("_place")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, size, text_crc32, row_number, shard, slot)`` of every row.

    Shards differ by one row at most and slots are gapless from 0. Size is the UTF-8 bytes
    of the text, none for null, plus a record's overhead. Equal rows, of which a third of
    the table may consist, are counted before they are numbered and are interchangeable.
    Rows without id are numbered like any other; an empty table gives no rows.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(docs).select(
        "doc_id",
        (F.octet_length(data) + RECORD_BYTES).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    numbered = stored(dense_row_key(rows, "row_number"), "numbered")
    numbered = numbered.withColumn("row_number", F.col("row_number") - 1)
    return assign(numbered, numbered.count(), shards, seed)
