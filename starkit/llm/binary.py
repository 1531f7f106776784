"""Token ids as packed matrices for training, with segment lengths and position resets.

Pieces are packed by best-fit decreasing. The open sequences of a group are counted by
the room they have left, and a segment tree over the rooms 0..capacity finds the smallest
room that is large enough in a number of steps that grows with the logarithm of the
capacity alone. Groups are dealt by hash and hold some megabytes of text each, so each is
a task's small work, and about a sequence is all that a group can lose.

A shard is one row: an id matrix (rows x capacity), the cumulative segment lengths of
each row, and the position of each id in its segment, all little-endian bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.bpe import loaded, vocabulary
from starkit.llm.pieces import CAPACITY, cut_documents

# Text of one group, on average.
GROUP_BYTES = 8 << 20
# Of the written files; bounds what a reader of whole rows holds at a time.
ROW_GROUP_BYTES = 8 << 20
# Fills the matrix behind a sequence's last id; never inside a segment.
PAD_ID = 0

_BIN_BITS = 24


class RoomTree:
    """How many open sequences have each amount of room, as a segment tree of counts."""

    def __init__(self, capacity: int) -> None:
        self._leaves = 1 << capacity.bit_length()
        self._counts = [0] * (2 * self._leaves)

    def change(self, room: int, by: int) -> None:
        node = room + self._leaves
        while node:
            self._counts[node] += by
            node >>= 1

    def smallest_from(self, room: int) -> int:
        """The smallest room of at least ``room`` that a sequence has, or -1."""
        counts, node = self._counts, room + self._leaves
        if counts[node]:
            return room
        while node > 1:
            if not node & 1 and counts[node + 1]:
                node += 1
                while node < self._leaves:
                    node = 2 * node if counts[2 * node] else 2 * node + 1
                return node - self._leaves
            node >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each piece, by capacity search in a segment tree."""
    tree = RoomTree(capacity)
    having: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequences, opened = np.empty(len(lengths), np.int64), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        room = tree.smallest_from(length)
        if room < 0:
            sequence, room, opened = opened, capacity, opened + 1
        else:
            sequence = having[room].pop()
            tree.change(room, -1)
        sequences[piece] = sequence
        having[room - length].append(sequence)
        tree.change(room - length, 1)
    return sequences


def laid_out(
    frame: pd.DataFrame, group: int, capacity: int, pad_id: int, id_type: np.dtype
) -> pd.DataFrame:
    """The pieces ``(item, doc_id, no_id, piece, length, ids)`` of a group, packed into rows."""
    frame = frame.sort_values("item", ignore_index=True)
    sequences = best_fit_decreasing(frame["length"].to_numpy(np.int64), capacity)
    position = np.dtype("<u2" if capacity <= 1 << 16 else "<u4")
    ids_of = frame["doc_id"].astype(object).where(~frame["no_id"], None)
    doc_ids, pieces = ids_of.tolist(), frame["piece"].tolist()
    data, rows = frame["ids"].tolist(), []
    order = np.argsort(sequences, kind="stable")
    cuts = np.flatnonzero(np.diff(sequences[order])) + 1
    for number, members in enumerate(np.split(order, cuts)):
        members = members.tolist()
        ids = np.frombuffer(b"".join(data[m] for m in members), id_type)
        sizes = [len(data[m]) // id_type.itemsize for m in members]
        ends = np.cumsum([0, *sizes]).astype("<i4")
        sizes.append(capacity - len(ids))
        row = np.full(capacity, pad_id, id_type)
        row[: len(ids)] = ids
        rows.append(
            (
                group << _BIN_BITS | number,
                len(ids),
                len(members),
                [doc_ids[m] for m in members],
                [pieces[m] for m in members],
                row.tobytes(),
                ends.tobytes(),
                np.concatenate([np.arange(size, dtype=position) for size in sizes]).tobytes(),
            )
        )
    return pd.DataFrame(rows, columns=_NAMES)


_NAMES = ["sequence_id", "n_tokens", "n_segments", "doc_ids", "pieces"]
_NAMES += ["ids", "cu_seqlens", "position_ids"]
_SCHEMA = (
    "sequence_id bigint, n_tokens bigint, n_segments bigint, doc_ids array<bigint>, "
    "pieces array<int>, ids binary, cu_seqlens binary, position_ids binary"
)


def matrices(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    pad_id: int = PAD_ID,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """One row per sequence, ready to be laid under one another as a matrix.

    ``(sequence_id, n_tokens, n_segments, doc_ids array<bigint>, pieces array<int>, ids,
    cu_seqlens, position_ids)``. ``ids`` is a matrix row of ``capacity`` unsigned ids,
    16 bits wide where the vocabulary allows and else 32, padded with ``pad_id``;
    ``cu_seqlens`` are 0 and the signed 32-bit ends of the segments; ``position_ids`` are
    unsigned 16-bit (32-bit for a longer capacity) and start again from 0 with every
    segment, padding included. Nothing is lost: a long document is cut into pieces, each a
    segment with its document and number. An empty or null text is one segment of the end
    id; repeated rows are segments of their own; an empty table gives no rows.

    Ids are shuffled once: the pieces of a group are packed and laid where they meet.
    """
    id_type = loaded(vocabulary(docs.sparkSession, tokenizer_path).value).dtype
    # A document without text counts as well, since it is an id.
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + 8
    total = docs.agg(F.sum(size)).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    pieces = cut_documents(docs, tokenizer_path, capacity, with_ids=True).select(
        F.monotonically_increasing_id().alias("item"),
        # pandas has no missing integers, only floats that round large ids.
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"),
        "piece",
        "length",
        "ids",
    )
    dealt = pieces.withColumn("group_id", F.pmod(F.xxhash64("item"), F.lit(groups)))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return laid_out(frame, int(key[0]), capacity, pad_id, id_type)

    return dealt.groupBy("group_id").applyInPandas(run, _SCHEMA)


def write_matrices(rows: DataFrame, path: str) -> None:
    """The matrix rows as Parquet, one file per task; binary columns are written as they
    are, so that a reader lays them under one another without a copy per row."""
    rows.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)

