"""Documents as token pieces of at most one sequence's length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starkit.llm.bpe import loaded, vocabulary
from starkit.llm.common import documents, slices

CAPACITY = 4096
# The id that ends every document.
END_ID = 1


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of every whole document.

    A document is the ids of its text followed by ``end_id``, so an empty or null text is
    one id. Only a document longer than ``capacity`` is cut: ``start`` is the number of its
    ids before the piece. ``ids_crc32`` is over unsigned 32-bit little-endian ids; ``ids``
    are packed in 16 bits each if the vocabulary allows.
    Repeated rows and null ids are cut like any other; other columns are not read.
    """
    source = vocabulary(docs.sparkSession, tokenizer_path)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source.value)
        ending = np.array([end_id], "<u4")
        for batch in slices(batches):
            texts = [text or "" for text in batch["text"].to_pylist()]
            rows: list[tuple] = []
            for doc_id, packed in zip(batch["doc_id"].to_pylist(), bpe.encode_all(texts)):
                ids = np.concatenate([np.frombuffer(packed, bpe.dtype).astype("<u4"), ending])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    row = (doc_id, piece, start, len(part), zlib.crc32(part))
                    rows.append((*row, part.astype(bpe.dtype).tobytes()) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            if with_ids:
                names, types = [*names, "ids"], [*types, pa.binary()]
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types)], names=names
            )

    return documents(docs).mapInArrow(run, f"{schema}, ids binary" if with_ids else schema)
