"""Frequent phrases and their collocation scores, exactly, behind Misra-Gries summaries.

A text is cut into pieces at punctuation and line ends, and pieces into words. A phrase is
a run of words of one piece; all counts are per language.

1. Summaries. Tasks count the phrases of their share by hash, and what they count meets by
   hash partition. A partition merges it into one Misra-Gries summary: counters beyond the
   capacity make all counters fall by the next largest one. The capacity exceeds the mass
   of the partition divided by the threshold, and no counter ever falls by the threshold in
   all. So every phrase that is frequent enough survives in its partition's summary, and a
   phrase that does not survive is not frequent.
2. Only a phrase whose words survive can be frequent, and from three words on only one whose
   neighbouring pairs survive. So words are summarised first, then pairs, then the longer
   phrases together. What survives is marked by hash in a bitmap of fixed size, which
   is all that is broadcast; a wrong mark costs work and nothing else.
3. A last pass counts the marked phrases exactly, by their words and not by hash. Parts of a
   frequent phrase are frequent, so every count that a score needs is among them; of single
   words, only those in a marked pair are counted. Counts travel in blocks, one for each task
   and hash partition, and a partition adds up no more phrases than its summary kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import slices, stored
from starkit.llm.windows import WINDOW_BASES, Words, mixed, text_bytes, word_hashes, words_in

LONGEST = 5
THRESHOLD = 100
TOP = 2000
UNKNOWN = "und"
# Counters that a summary holds at least.
CAPACITY = 1 << 20
# Counters for each ``threshold`` of mass. More than one leaves room for a partition whose
# mass comes late, so that counters need not fall by the whole threshold.
CAPACITY_FACTOR = 4
# Bits of a bitmap of survivors (16 MB), and of one block of it.
MARK_BITS, _BLOCK_BITS = 27, 16
# Counted rows that a summary takes at a time, at least.
_MERGED_ROWS = 1 << 18
# Phrases that a task counts before it hands them on; bounds its memory.
FLUSH_PHRASES = 1 << 20

# Fixed values of the contract: bytes between words, and bytes between pieces.
_BETWEEN_WORDS, _BETWEEN_PIECES = b" \t", b".,;:!?\n\x0b\x0c\r"
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(_BETWEEN_WORDS)] = 1
_KINDS[list(_BETWEEN_PIECES)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Cut:
    """The words of a batch of texts, and how far each word's piece goes on."""

    def __init__(self, texts: pa.Array, langs: list[str]) -> None:
        data, offsets = text_bytes(texts)
        data = _LOWER[data]
        kinds = _KINDS[data]
        words: Words = words_in(data, offsets, kinds == 0)
        self.words = words
        self.langs = langs
        self.text = np.repeat(np.arange(len(langs)), words.counts())
        breaks = np.concatenate([[0], np.cumsum(kinds == 2)])
        # Whether the next word goes on in the same piece of the same text.
        joined = np.zeros(len(words.starts), bool)
        joined[:-1] = (breaks[words.starts[1:]] == breaks[words.ends[:-1]]) & (self.text[1:] == self.text[:-1])
        last = np.flatnonzero(~joined)
        ends = last[np.searchsorted(last, np.arange(len(joined)))] if len(joined) else last
        #: Words from each one to the end of its piece, itself included.
        self.room = ends - np.arange(len(joined)) + 1
        self._words = word_hashes(words)
        self._seeds = [
            np.array([xxhash.xxh64_intdigest(lang.encode(), seed) for lang in langs], np.uint64)[self.text]
            for seed in (1, 2)
        ]

    def hashes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the phrase of ``size`` words that begins at each word that has
        so many behind it, pieces or not."""
        found = []
        for own, seeds, base in zip(self._words, self._seeds, WINDOW_BASES):
            count = max(0, len(own) - size + 1)
            value = mixed(seeds[:count] ^ np.uint64(size))
            for k in range(size):
                value = mixed(value * np.uint64(base) + own[k : k + count])
            found.append(value)
        return found[0], found[1]

    def phrase(self, first: int, size: int) -> bytes:
        w = self.words
        return b" ".join(
            w.data[a:b].tobytes()
            for a, b in zip(w.starts[first : first + size].tolist(), w.ends[first : first + size].tolist())
        )


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cells = hashes >> np.uint64(64 - MARK_BITS)
    byte, bit = (cells >> np.uint64(3)).astype(np.int64), (cells & np.uint64(7)).astype(np.uint8)
    return (marks[byte] >> bit & 1).astype(bool)


def _runs(size: int, cut: Cut, part: int, marks: np.ndarray) -> np.ndarray:
    """Whether all runs of ``part`` words of each phrase of ``size`` are marked."""
    marked = _marked(marks, cut.hashes(part)[0])
    count = max(0, len(cut.room) - size + 1)
    found = cut.room[:count] >= size
    for k in range(size - part + 1):
        found &= marked[k : k + count]
    return found


class Summary:
    """A Misra-Gries summary of counted hashes from which whatever occurs ``threshold``
    times or more survives."""

    def __init__(self, threshold: int, capacity: int = CAPACITY) -> None:
        self._threshold, self._least = threshold, capacity
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.mass = self.fallen = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.mass += int(counts.sum())
        codes, self.keys = pd.factorize(np.concatenate([self.keys, keys]))
        sums = np.zeros(len(self.keys), np.int64)
        np.add.at(sums, codes, np.concatenate([self.counts, counts]))
        self.counts = sums
        capacity = max(self._least, CAPACITY_FACTOR * self.mass // self._threshold + 1)
        if len(self.keys) > capacity:
            place = len(self.keys) - capacity - 1
            fall = int(np.partition(self.counts, place)[place])
            # Else what is frequent could be lost: the summary is left to grow.
            if self.fallen + fall < self._threshold:
                kept = self.counts > fall
                self.keys, self.counts = self.keys[kept], self.counts[kept] - fall
                self.fallen += fall

    def survivors(self) -> np.ndarray:
        """Every key of the threshold and more, and others."""
        return self.keys[self.counts + self.fallen >= self._threshold]


def _spoken(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(lang.alias("lang"), text.alias("text"))


def _counted(texts: DataFrame, sizes: range, part: int, marks) -> DataFrame:
    """``(hash, count, wanted)`` of the phrases of ``sizes`` words whose runs of ``part`` words are
    marked, counted by task as far as ``FLUSH_PHRASES`` go. A hash depends on the number of
    words and the language, too. With pairs as ``part``, the words of marked pairs come as
    well, as ``wanted``."""

    def rows_of(hashes: np.ndarray, counts: np.ndarray, wanted: bool) -> pa.RecordBatch:
        columns = [pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))]
        flags = pa.array(np.full(len(hashes), wanted))
        return pa.RecordBatch.from_arrays([*columns, flags], names=["hash", "count", "wanted"])

    def emitted(held: list[np.ndarray], words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes, keys = pd.factorize(np.concatenate([np.empty(0, np.uint64), *held]))
        yield rows_of(keys, np.bincount(codes, minlength=len(keys)), False)
        unique = np.unique(np.concatenate([np.empty(0, np.uint64), *words]))
        yield rows_of(unique, np.zeros(len(unique)), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, count = [], [], 0
        for batch in slices(batches):
            cut = Cut(batch["text"], batch["lang"].to_pylist())
            for size in sizes:
                whole = cut.room[: max(0, len(cut.room) - size + 1)] >= size
                found = whole if marks is None else _runs(size, cut, part, marks.value)
                held.append(cut.hashes(size)[0][found])
                count += len(held[-1])
            if part == 2:
                pairs = np.flatnonzero(_runs(2, cut, 2, marks.value))
                words.append(np.unique(cut.hashes(1)[0][np.concatenate([pairs, pairs + 1])]))
                count += len(words[-1])
            if count >= FLUSH_PHRASES:
                yield from emitted(held, words)
                held, words, count = [], [], 0
        yield from emitted(held, words)

    return texts.mapInArrow(run, "hash bigint, count bigint, wanted boolean")


def _survivors(counted: DataFrame, threshold: int, capacity: int) -> DataFrame:
    """``(hash, wanted)`` of all frequent phrases of ``counted``, and of others; and the wanted
    words, once each."""
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows_of(hashes: np.ndarray, wanted: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes), pa.array(np.full(len(hashes), wanted))], names=["hash", "wanted"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, held, rows = Summary(threshold, capacity), [], 0
        words = np.empty(0, np.int64)
        for batch in batches:
            hashes, counts = batch["hash"].to_numpy(), batch["count"].to_numpy()
            wanted = batch["wanted"].to_numpy(zero_copy_only=False)
            if wanted.any():
                words = np.union1d(words, hashes[wanted])
            held.append((hashes[~wanted], counts[~wanted]))
            rows += batch.num_rows
            # Merging costs as much as the summary is long.
            if rows >= max(_MERGED_ROWS, len(summary.keys) // 2):
                summary.merge(*map(np.concatenate, zip(*held)))
                held, rows = [], 0
        if held:
            summary.merge(*map(np.concatenate, zip(*held)))
        yield rows_of(summary.survivors(), False)
        yield rows_of(words, True)

    return counted.repartition(tasks, "hash").mapInArrow(run, "hash bigint, wanted boolean")


def _mark(marks: np.ndarray, survivors: DataFrame) -> None:
    """Set the bit of each survivor's beginning of a hash. The bits reach the driver in
    blocks of 8 kB, 16 MB in all whatever the corpus."""
    cell = F.shiftrightunsigned("hash", 64 - MARK_BITS)
    cells = survivors.select(
        F.shiftright(cell, _BLOCK_BITS).alias("block"),
        cell.bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int").alias("place"),
    )

    def run(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(1 << _BLOCK_BITS, bool)
        for frame in frames:
            bits[frame["place"].to_numpy()] = True
        yield pd.DataFrame({"block": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    width = 1 << (_BLOCK_BITS - 3)
    found = cells.distinct().groupBy("block").applyInPandas(run, "block bigint, bits binary")
    for row in found.toLocalIterator():
        span = slice(row["block"] * width, (row["block"] + 1) * width)
        marks[span] |= np.frombuffer(row["bits"], np.uint8)


def _exactly_counted(texts: DataFrame, marks, words, longest: int, threshold: int) -> DataFrame:
    """``(lang, size, phrase, count)`` of marked phrases of the threshold and more, and the number
    of a language's words as size 0. Single words are those marked in ``words``."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["langs", "sizes", "phrases", "counts"]

    def blocks(held: dict[tuple[str, int, bytes], int]) -> pa.RecordBatch:
        keys, counts = list(held), np.fromiter(held.values(), np.int64, len(held))
        place = [xxhash.xxh64_intdigest(phrase, size) % tasks for _, size, phrase in keys]
        place = np.array(place, np.int64)
        order = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[order], np.arange(tasks + 1)).astype(np.int32)
        langs, sizes, found = zip(*[keys[k] for k in order.tolist()]) if keys else ((), (), ())
        columns = [pa.array(langs, pa.string()), pa.array(sizes, pa.int32())]
        columns += [pa.array(found, pa.binary()).cast(pa.string()), pa.array(counts[order])]
        ends = pa.array(bounds)
        lists = [pa.ListArray.from_arrays(ends, column) for column in columns]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(tasks, dtype=np.int32)), *lists], names=["part", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, bytes], int] = {}
        for batch in slices(batches):
            cut = Cut(batch["text"], batch["lang"].to_pylist())
            for text, count in enumerate(cut.words.counts().tolist()):
                held[cut.langs[text], 0, b""] = held.get((cut.langs[text], 0, b""), 0) + count
            for size in range(1, longest + 1):
                hashes, checks = cut.hashes(size)
                marked = _marked((words if size == 1 else marks).value, hashes)
                places = np.flatnonzero((cut.room[: len(hashes)] >= size) & marked)
                codes, unique = pd.factorize(hashes[places])
                first = np.empty(len(unique), np.int64)
                first[codes[::-1]] = places[::-1]
                same = checks[first][codes] == checks[places]
                counts = np.bincount(codes[same], minlength=len(unique))
                for place, count in zip(first.tolist(), counts.tolist()):
                    key = (cut.langs[cut.text[place]], size, cut.phrase(place, size))
                    held[key] = held.get(key, 0) + count
                for place in places[~same].tolist():  # another phrase with the same hash
                    key = (cut.langs[cut.text[place]], size, cut.phrase(place, size))
                    held[key] = held.get(key, 0) + 1
            if len(held) >= FLUSH_PHRASES // 2:
                yield blocks(held)
                held.clear()
        yield blocks(held)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int, str], int] = {}
        for batch in batches:
            lists = [batch[name].flatten().to_pylist() for name in names]
            for lang, size, phrase, count in zip(*lists):
                key = (lang, size, phrase)
                total[key] = total.get(key, 0) + count
        found = [(*key, count) for key, count in total.items() if count >= threshold or not key[1]]
        columns = zip(*found) if found else [[]] * 4
        types = [pa.string(), pa.int32(), pa.string(), pa.int64()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "size", "phrase", "count"])

    schema = "part int, langs array<string>, sizes array<int>, phrases array<string>, counts array<bigint>"
    dealt = texts.mapInArrow(run, schema).repartition(tasks, "part")
    return dealt.mapInArrow(add_up, "lang string, size int, phrase string, count bigint")


def frequent_phrases(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    text_col: str = "text",
    lang_col: str = "lang",
    capacity: int = CAPACITY,
    all_words: bool = True,
) -> DataFrame:
    """``(lang, size, phrase, count)``: every phrase of up to ``longest`` words that occurs
    ``threshold`` times or more in a language, overlaps included, and as size 0 with an empty
    phrase the number of the language's words. Without ``all_words``, single words are only
    those of frequent pairs, and perhaps a few others.

    A null language is ``und``; a null, empty or blank text has no word; repeated rows count
    each; other columns, ids among them, are not read. An empty table gives no rows.
    """
    texts = _spoken(docs, text_col, lang_col)
    context = docs.sparkSession.sparkContext
    marks, sent = np.zeros(1 << (MARK_BITS - 3), np.uint8), None
    for sizes, part in ((range(1, 2), 0), (range(2, 3), 1), (range(3, longest + 1), 2)):
        counted = _counted(texts, sizes, part, sent)
        survivors = stored(_survivors(counted, threshold, capacity), "survivors")
        _mark(marks, survivors.filter(~F.col("wanted")))
        sent = context.broadcast(marks)
    words = sent
    if not all_words:
        wanted = np.zeros(1 << (MARK_BITS - 3), np.uint8)
        _mark(wanted, survivors.filter("wanted"))
        words = context.broadcast(wanted)
    return _exactly_counted(texts, sent, words, longest, threshold)


def _part(words: Column, start: int, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _within_longer(candidates: DataFrame) -> DataFrame:
    """``(lang, phrase)`` of candidates that lie in a longer candidate as often as alone."""
    words = F.split("phrase", " ")
    places = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), s -> named_struct('s', s, 'n', n))))"
    )
    inside = (
        candidates.filter("size > 2")
        .select("lang", "count", words.alias("words"), F.explode(places).alias("place"))
        .select("lang", F.expr("array_join(slice(words, place.s, place.n), ' ')").alias("phrase"), "count")
        .groupBy("lang", "phrase")
        .agg(F.max("count").alias("most"))
    )
    return candidates.join(inside, ["lang", "phrase"]).filter("most >= count").select("lang", "phrase")


def collocations(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    capacity: int = CAPACITY,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of two and
    more words by score, then ``a``, both descending, then phrase in byte order.

    ``a`` is the phrase's count, ``n`` the language's words. Cut after its first k words, ``l``
    and ``r`` are the counts of both parts and the score is the floor of 1000 * a * n / (l * r);
    the cut with the lowest score counts, and of equals the one with the smallest k. A phrase
    inside a longer frequent one of the same count is left out. See ``frequent_phrases`` for
    edges; ranking keeps ``top`` rows of a language in each task before they meet.
    """
    found = frequent_phrases(docs, threshold, longest, text_col, lang_col, capacity, all_words=False)
    counts = stored(found, "phrase-counts")
    totals = counts.filter("size = 0").select("lang", F.col("count").alias("n"))
    candidates = counts.filter("size > 1")
    parts = counts.filter("size > 0").select(
        F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("count").alias("part_count")
    )
    left = candidates.join(stored(_within_longer(candidates), "within-longer"), ["lang", "phrase"], "left_anti")
    cuts = (
        left.withColumn("words", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("head", _part(F.col("words"), 1, F.col("k")))
        .withColumn("tail", F.expr("array_join(slice(words, k + 1, size - k), ' ')"))
        .select("lang", "phrase", F.col("count").alias("a"), "k", "head", "tail")
    )
    for name, column in (("head", "l"), ("tail", "r")):
        same = (F.col("lang") == F.col("part_lang")) & (F.col(name) == F.col("part"))
        cuts = cuts.join(parts.withColumnRenamed("part_count", column), same).drop("part_lang", "part")
    whole = "decimal(20,0)"  # products get up to 38 digits
    scored = cuts.join(totals, "lang").withColumn(
        "score",
        F.expr(f"(1000 * cast(a as {whole}) * n) div (cast(l as {whole}) * r)"),
    )
    lowest = F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("lowest")
    best = scored.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", "lowest.*")
    # First among a share of a language's phrases, so that no task ranks them all.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    ranked = best
    for group in (["lang", share], ["lang"]):
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("a", "l", "r", "n", "score")]
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", *numbers)
