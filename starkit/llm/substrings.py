"""Exact removal of passages that an earlier document has, behind a count-min prefilter.

1. Every partition makes a sketch of how many documents hold each window, the sketches
   are merged, and cells of two or more are marked. A window is counted under its anchor,
   the least hash of the 8-word runs inside it. Equal windows have equal anchors and
   neighbouring windows mostly share one, so a sketch has a twentieth of the load, and a
   cell still never holds less than the number of documents with the window.
2. A second pass keeps the windows whose cells are all marked. Only they are grouped,
   by 128 independent bits of hash, and the smallest document of each group owns the
   window. They are shuffled once, by their anchor: neighbouring windows with one anchor
   travel as one row.
   Rows of an anchor that the sketch finds in ``HOT_DOCUMENTS`` or more are salted, so that
   they meet in ``SALTS`` tasks. All but the smallest document of a salt are later ones
   already; only these winners, at most one a salt, meet again.

The estimate only ever errs upwards, so no repeated window is lost; what it lets through
wrongly is found to have one document. The marks are two bitmaps of ``ROWS`` times the
cells, at most ``MAX_CELLS`` each (128 MB in all), and are all that is broadcast. A corpus
that outgrows them makes the prefilter coarser, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import documents, fresh_name, slices, stored
from starkit.llm.windows import (
    WINDOW_BASES,
    mixed,
    rolling,
    sliding_minimum,
    window_starts,
    word_hashes,
    words_of,
)

WINDOW = 50
ANCHOR_WORDS = 8
ROWS = 4
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 27
HOT_DOCUMENTS = 1000
# Tasks that share the rows of a hot anchor.
SALTS = 16
# Windows of one anchor that travel together; bounds a row.
ROW_WINDOWS = 1024
# Cells of one block of a sketch; a cell's place in it takes 16 bits.
_BLOCK_BITS = 16
# Anchors that a task holds before it hands on a sketch; bounds its memory.
FLUSH_ANCHORS = 1 << 20
# A sketch's counts stop here.
_MOST = 65_535
_ROW_SALTS = np.array(
    [0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165], np.uint64
)


def cells_for(text_bytes: int, window: int = WINDOW) -> int:
    """Cells of a sketch row: four per anchor of a corpus of six-byte words, within bounds."""
    anchors = text_bytes // 6 * 2 // max(1, window - ANCHOR_WORDS + 2)
    wanted = 1 << max(0, 4 * anchors - 1).bit_length()
    return min(MAX_CELLS, max(MIN_CELLS, wanted))


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mixed(anchors ^ _ROW_SALTS[row]) >> np.uint64(64 - bits)


def _anchors(hashes: np.ndarray, window: int, starts: np.ndarray) -> np.ndarray:
    width = min(ANCHOR_WORDS, window)
    runs = rolling(hashes, width, WINDOW_BASES[0])
    return sliding_minimum(runs, window - width + 1)[starts]


def partition_sketches(docs: DataFrame, cells: int, window: int) -> DataFrame:
    """``(row, block, once, more, counts)``: places in the block of cells that one document
    of a task's share counts in, of those that more do, and how many."""
    bits = cells.bit_length() - 1

    def emitted(anchors: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(anchors)
        rows, blocks, once, more, many = [], [], [], [], []
        for row in range(ROWS):
            found, counts = np.unique(_cells(values, row, bits), return_counts=True)
            block = (found >> np.uint64(_BLOCK_BITS)).astype(np.int64)
            place = (found & np.uint64((1 << _BLOCK_BITS) - 1)).astype("<u2")
            cuts = np.flatnonzero(np.diff(block)) + 1
            for first, last in zip([0, *cuts], [*cuts, len(block)]):
                single = counts[first:last] == 1
                rows.append(row)
                blocks.append(block[first])
                once.append(place[first:last][single].tobytes())
                more.append(place[first:last][~single].tobytes())
                many.append(np.minimum(counts[first:last][~single], _MOST).astype("<u2").tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int32()),
                pa.array(blocks, pa.int64()),
                *(pa.array(column, pa.binary()) for column in (once, more, many)),
            ],
            names=["row", "block", "once", "more", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in slices(batches):
            words = words_of(batch["text"])
            starts, text = window_starts(words, window)
            if not len(starts):
                continue
            anchors = _anchors(word_hashes(words)[0], window, starts)
            # Once per document: neighbouring windows share most anchors.
            change = np.ones(len(anchors), bool)
            change[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])
            anchors, text = anchors[change], text[change]
            order = np.lexsort([anchors, text])
            anchors, text = anchors[order], text[order]
            change = np.ones(len(anchors), bool)
            change[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])
            held.append(anchors[change])
            count += len(held[-1])
            if count >= FLUSH_ANCHORS:
                yield emitted(held)
                held, count = [], 0
        if held:
            yield emitted(held)

    return docs.select("text").mapInArrow(
        run, "row int, block bigint, once binary, more binary, counts binary"
    )


def merged_marks(sketches: DataFrame) -> DataFrame:
    """``(row, block, marks, hot)``: a bit for every cell that two or more documents count
    in, and one for every cell of a hot number. Counts stop at 65,535."""

    def merge(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(1 << _BLOCK_BITS, np.int64)
        for frame in parts:
            for once, more, counts in zip(frame["once"], frame["more"], frame["counts"]):
                sums[np.frombuffer(once, "<u2")] += 1  # each place once in a sketch
                sums[np.frombuffer(more, "<u2")] += np.frombuffer(counts, "<u2")
        bits = [np.packbits(sums >= n, bitorder="little").tobytes() for n in (2, HOT_DOCUMENTS)]
        yield pd.DataFrame(
            {"row": [key[0]], "block": [key[1]], "marks": [bits[0]], "hot": [bits[1]]}
        )

    return sketches.groupBy("row", "block").applyInPandas(
        merge, "row int, block bigint, marks binary, hot binary"
    )


def marked_cells(docs: DataFrame, window: int, cells: int | None = None) -> np.ndarray:
    """The merged sketch as two bitmaps for each row, of repeated and of hot cells; their
    size is bounded by ``MAX_CELLS``."""
    if cells is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
        cells = cells_for(size or 0, window)
    marks = np.zeros((2, ROWS, cells // 8), np.uint8)
    block_bytes = 1 << (_BLOCK_BITS - 3)
    found = merged_marks(partition_sketches(docs, cells, window))
    for part in found.toLocalIterator():
        span = slice(part["block"] * block_bytes, (part["block"] + 1) * block_bytes)
        marks[0, part["row"], span] = np.frombuffer(part["marks"], np.uint8)
        marks[1, part["row"], span] = np.frombuffer(part["hot"], np.uint8)
    return marks


def candidate_windows(docs: DataFrame, marks: np.ndarray, window: int) -> DataFrame:
    """``(anchor, hot, doc_id, key, other_key, first, h1, h2)``: neighbouring windows that are
    estimated to repeat and have one anchor. ``first`` is the position of the first one's
    first word, ``h1`` and ``h2`` are arrays of both hashes of each."""
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sketch.value
        bits = (8 * marks.shape[2]).bit_length() - 1
        for batch in slices(batches):
            words = words_of(batch["text"])
            starts, text = window_starts(words, window)
            if not len(starts):
                continue
            hashes = word_hashes(words)
            anchors = _anchors(hashes[0], window, starts)
            kept, hot = np.arange(len(anchors)), np.ones(len(anchors), bool)
            for row in range(ROWS):
                cell = _cells(anchors[kept], row, bits)
                byte, bit = (cell >> np.uint64(3)).astype(np.int64), cell & np.uint64(7)
                marked = (marks[0, row, byte] >> bit.astype(np.uint8) & 1).astype(bool)
                hot &= (marks[1, row, byte] >> bit.astype(np.uint8) & 1).astype(bool)
                kept, hot = kept[marked], hot[marked]
            if not len(kept):
                continue
            starts, text, anchors = starts[kept], text[kept], anchors[kept]
            # A row ends where the anchor, the text or the neighbourhood does.
            new = np.ones(len(kept), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]) | (np.diff(starts) != 1)
            begin = np.flatnonzero(new)
            place = np.arange(len(kept)) - np.repeat(begin, np.diff(np.append(begin, len(kept))))
            begin = np.flatnonzero(place % ROW_WINDOWS == 0)
            ends = pa.array(np.append(begin, len(kept)), pa.int32())
            taken = pa.array(text[begin])
            first = starts[begin] - words.first[:-1][text[begin]]
            columns = [pa.array(anchors[begin].view(np.int64)), pa.array(hot[begin])]
            columns += [batch[name].take(taken) for name in ("doc_id", "key", "other_key")]
            columns.append(pa.array(first, pa.int32()))
            for found, base in zip(hashes, WINDOW_BASES):
                values = pa.array(rolling(found, window, base)[starts].view(np.int64))
                columns.append(pa.ListArray.from_arrays(ends, values))
            yield pa.RecordBatch.from_arrays(columns, names=_CANDIDATE)

    return docs.select("doc_id", "key", "other_key", "text").mapInArrow(
        run,
        "anchor bigint, hot boolean, doc_id bigint, key bigint, other_key bigint, first int, "
        "h1 array<bigint>, h2 array<bigint>",
    )


_CANDIDATE = ["anchor", "hot", "doc_id", "key", "other_key", "first", "h1", "h2"]
_ROW = ["doc_id", "key", "other_key"]


def text_keys(text: Column) -> list[Column]:
    """128 bits that stand for a text where rows share an id, or have none."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with two numbers of their text. Removal depends on id and text alone, so
    rows that share an id but not the text are told apart."""
    key, other = text_keys(F.col("text"))
    return documents(docs).withColumns({"key": key, "other_key": other})


def repeated_windows(docs: DataFrame, window: int = WINDOW, cells: int | None = None) -> DataFrame:
    """``(doc_id, key, other_key, starts array<int>)`` for documents with windows that also
    start in a document of a smaller id; ``starts`` are word positions from 0.

    A document without id comes after all others and owns nothing. Rows that share an
    id do not own each other's windows. Null, empty and short texts have no window.
    """
    rows = keyed(docs)
    marks = marked_cells(rows, window, cells)
    candidates = candidate_windows(rows, marks, window)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(*_ROW), F.lit(SALTS))).otherwise(0)
    dealt = candidates.withColumn("salt", salt).repartition(tasks, "anchor", "salt")
    owner = F.min("doc_id").over(Window.partitionBy("anchor", "salt", "h1", "h2"))
    seen = _each_window(dealt).withColumn("owner", owner).withColumn("later", _owned_by_other())
    if not marks[1].any():
        removed = seen.filter("later").select(*_ROW, "start")
    else:
        seen = seen.filter("later OR hot").select(*_ROW, "start", "h1", "h2", "later")
        seen = stored(seen, "repeats-and-winners")
        winners = seen.filter("NOT later")
        removed = seen.filter("later").select(*_ROW, "start").union(_later_winners(winners))
    return removed.groupBy(*_ROW).agg(F.collect_set("start").alias("starts"))


def _each_window(candidates: DataFrame) -> DataFrame:
    """One row for each window, with its first word as ``start``."""
    kept = ["anchor", "salt", "hot", *_ROW, "first"]
    each = candidates.select(*kept, F.posexplode(F.arrays_zip("h1", "h2")).alias("place", "pair"))
    start = (F.col("first") + F.col("place")).alias("start")
    return each.select("anchor", "salt", "hot", *_ROW, start, "pair.h1", "pair.h2")


def _owned_by_other() -> Column:
    """A row without id comes after all others."""
    owner, doc_id = F.col("owner"), F.col("doc_id")
    return owner.isNotNull() & (doc_id.isNull() | (owner < doc_id))


def _later_winners(winners: DataFrame) -> DataFrame:
    """Rows and ``start`` of hot windows that came first in their salt and not in all. Rows
    without id, which may be many to a window, ask whether it has any document with one."""
    named = winners.filter(F.col("doc_id").isNotNull())
    owner = F.min("doc_id").over(Window.partitionBy("h1", "h2"))
    later = named.withColumn("owner", owner).filter(_owned_by_other())
    owned = stored(named.select("h1", "h2").distinct(), "owned-windows")
    nameless = winners.filter(F.col("doc_id").isNull()).join(owned, ["h1", "h2"], "left_semi")
    return later.select(*_ROW, "start").union(nameless.select(*_ROW, "start"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, cells: int | None = None) -> DataFrame:
    """``(doc_id, kept_text, n_words, n_removed, changed_text)`` of every row.

    ``kept_text`` is the kept words joined by one space; ``changed_text`` is the text
    without the removed words and the white space behind them, and the text itself where
    nothing is removed (null stays null). See ``repeated_windows`` for ids and edges.
    """
    found = repeated_windows(docs, window, cells)
    rows = keyed(docs)
    same = rows["doc_id"].eqNullSafe(found["doc_id"])
    same &= (rows["key"] == found["key"]) & (rows["other_key"] == found["other_key"])
    joined = rows.join(found, same, "left").select(rows["doc_id"], rows["text"], found["starts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept_texts, changed, sizes, removed = [], [], [], []
            for text, starts in zip(batch["text"].to_pylist(), batch["starts"].to_pylist()):
                words = (text or "").encode().split()  # at the same six bytes
                sizes.append(len(words))
                if starts:
                    keep = kept_words(len(words), starts, window)
                    changed.append(_without(text, keep))
                    words = list(compress(words, keep.tolist()))
                else:
                    changed.append(text)
                removed.append(sizes[-1] - len(words))
                kept_texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(kept_texts, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(changed, pa.string()),
                ],
                names=["doc_id", "kept_text", "n_words", "n_removed", "changed_text"],
            )

    return joined.mapInArrow(
        run,
        "doc_id bigint, kept_text string, n_words bigint, n_removed bigint, changed_text string",
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with all their columns, repeated passages cut out of ``text``: the rest keeps
    its white space. Rows without such a passage stay as they are."""
    found = repeated_windows(docs, window)
    names = {name: fresh_name(docs, f"_{name}") for name in found.columns}
    found = found.withColumnsRenamed(names)
    own = {name: fresh_name(docs, f"_own_{name}") for name in ("key", "other_key")}
    rows = docs.withColumns(dict(zip(own.values(), text_keys(F.col("text").cast("string")))))
    same = rows["doc_id"].cast("bigint").eqNullSafe(found[names["doc_id"]])
    for name, column in own.items():
        same &= rows[column] == found[names[name]]
    joined = rows.join(found, same, "left")

    @F.pandas_udf("string")
    def cut(texts, starts):
        import pandas as pd

        result = []
        for text, begins in zip(texts, starts):
            if begins is None or not len(begins):
                result.append(text)
            else:
                keep = kept_words(len(text.encode().split()), begins, window)
                result.append(_without(text, keep))
        return pd.Series(result, dtype=object)

    starts = F.col(names["starts"])
    text = F.when(starts.isNull(), F.col("text")).otherwise(
        cut(F.when(starts.isNotNull(), F.col("text").cast("string")), starts)
    )
    return joined.withColumn("text", text).select(*docs.columns)


def kept_words(count: int, starts, window: int) -> np.ndarray:
    """Whether each word is outside of all windows that begin at ``starts``."""
    cover = np.zeros(count + 1, np.int32)
    np.add.at(cover, np.array(starts), 1)
    np.add.at(cover, np.array(starts) + window, -1)
    return np.cumsum(cover[:-1]) == 0


def _without(text: str, keep: np.ndarray) -> str:
    """The text without the words that are not kept and the white space behind them."""
    words = words_of(pa.array([text]))
    data = words.data.tobytes()
    ends = np.append(words.starts[1:], len(data))
    parts = [data[: words.starts[0]]] if len(ends) else [data]
    parts += [data[s:e] for s, e, k in zip(words.starts, ends, keep) if k]
    return b"".join(parts).decode()
