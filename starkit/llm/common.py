"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.session import scratch_path

# Words are separated by space, tab, line feed, vertical tab, form feed and carriage return.
WORD_BYTES = rb"[^\x20\x09-\x0D]+"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
WORD_SPACES = " \t\n\x0b\x0c\r"

# What Python code turns into objects at a time; an Arrow batch may hold much more.
SLICE_ROWS = 1024
SLICE_BYTES = 8 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later plans start from the
    files, so that a lost executor repeats a read and not the work before it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` alone, so that no other column of ``df`` can clash."""
    return df.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``SLICE_BYTES``; a longer row is one of its own."""
    for batch in batches:
        width = batch.nbytes // max(1, batch.num_rows) + 1
        rows = min(SLICE_ROWS, max(1, SLICE_BYTES // width))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
