"""BPE encoding and decoding with the vocabulary of a public tokenizer file.

The method is the contiguous rank array: a word's parts lie in one list and the ranks
of adjacent parts in another. The lowest rank is found by a scan, the boundary between
its two parts is deleted, and the ranks beside it are looked up again. A scan is fast
while a word is short; longer words take the same merges from a heap.

Most words of a corpus repeat, so each Python worker keeps the ids of recent words and
of recent stretches between spaces, up to a fixed number of entries. With the lower-casing
vocabulary, whose words never hold white space, whole batches of texts are cut into words
at once by the classes of their characters, and a word is looked up once a batch.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from starkit.llm.common import documents, slices
from starkit.llm.windows import Words, word_hashes

# Words of more parts are merged with a heap, whose cost is not quadratic.
SCAN_PARTS = 192
# Entries that a worker keeps in each of its two memos; about 200 bytes each.
MEMO_ENTRIES = 500_000
# Longer stretches hardly repeat and would make the memo's size unbounded.
MEMO_CHARS = 64

# Fixed values of the byte-level format: the pattern that cuts text into words.
BYTE_LEVEL_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

NO_RANK = np.iinfo(np.int32).max
# Words that are merged together; bounds the arrays.
SCAN_WORDS = 16_384
# Latin Extended-B ends here.
LATIN_END = "\u024f"
_BEYOND_LATIN = re.compile(f"[^\0-{LATIN_END}]")
# Classes of the characters up to there, for cutting whole batches.
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
# Fixed values of the lower-casing format: endings that an apostrophe makes words.
_SHORT_ENDINGS, _LONG_ENDINGS = "stmd", ("re", "ve", "ll")
# Characters that are cut and looked up together; a longer stretch without a space is one.
BATCH_CHARS = 1 << 20
# Words that the memo of whole batches keeps; about 150 bytes each.
BATCH_WORDS = 200_000
# A space that white space or the end follows: there words do not start at each space.
_LOOSE_SPACE = re.compile(r" (?:\s|\Z)")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others for 256, 257, ... in order."""
    symbols, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(spare))
            spare += 1
    return symbols


class Memo:
    """Recent results by key, at most about ``limit``: when half of that is reached, the
    newer half becomes the older one, from which an entry is taken over when used."""

    def __init__(self, limit: int = MEMO_ENTRIES) -> None:
        self.recent: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._half = limit // 2

    def unknown(self, keys: set[str]) -> list[str]:
        """Of keys that ``recent`` lacks, those without a result; the others are in
        ``recent`` afterwards."""
        unknown = []
        for key in keys:
            value = self._older.get(key)
            if value is None:
                unknown.append(key)
            else:
                self.recent[key] = value
        return unknown

    def turn(self) -> None:
        """Begin a new half if this one is full; not while results are being collected."""
        if len(self.recent) > self._half:
            self._older, self.recent = self.recent, {}

    def forget_long(self, keys: Iterable[str]) -> None:
        for key in keys:
            if len(key) > MEMO_CHARS:
                self.recent.pop(key, None)


class BatchMemo:
    """The ids of recent words by 128 bits of hash, for all words of a batch at once. It
    begins anew when it holds ``limit`` words."""

    def __init__(self, dtype: np.dtype, limit: int = BATCH_WORDS) -> None:
        self._dtype, self._limit = dtype, limit
        self._forget()

    def _forget(self) -> None:
        self._places: dict[int, int] = {}
        self._checks = np.empty(0, np.uint64)
        self._flat = np.empty(0, self._dtype)
        self._ends = np.zeros(1, np.int64)

    def found(self, words: Words, merged) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of all words in order, and how many each has; new words come from
        ``merged``. None if two words share a hash but not the other one."""
        if len(self._places) >= self._limit:
            self._forget()
        hashes, checks = word_hashes(words)
        codes, unique = pd.factorize(hashes)
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        if not (checks[first][codes] == checks).all():
            return None
        keys = unique.tolist()
        places = [self._places.get(key, -1) for key in keys]
        entries = np.array(places, np.int64)
        new = np.flatnonzero(entries < 0)
        if len(new):
            data, at = words.data.tobytes(), first[new]
            spans = zip(words.starts[at].tolist(), words.ends[at].tolist())
            ids = merged([data[start:end] for start, end in spans])
            count = len(self._checks)
            entries[new] = np.arange(count, count + len(new))
            self._places.update((keys[n], count + k) for k, n in enumerate(new.tolist()))
            self._checks = np.concatenate([self._checks, checks[at]])
            self._flat = np.concatenate([self._flat, np.frombuffer(b"".join(ids), self._dtype)])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self._dtype.itemsize
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
        if not (self._checks[entries] == checks[first]).all():
            return None
        entries = entries[codes]
        starts = self._ends[entries]
        sizes = self._ends[entries + 1] - starts
        before = np.cumsum(sizes) - sizes
        take = np.repeat(starts - before, sizes)
        return self._flat[take + np.arange(len(take))], sizes


def _class_of(character: str) -> int:
    patterns = {_SPACE: r"\s", _LETTER: r"\p{L}", _NUMBER: r"\p{N}"}
    return next((c for c, pattern in patterns.items() if regex.match(pattern, character)), _OTHER)


def _stretches(text: str) -> Iterator[str]:
    """A text in pieces of about ``BATCH_CHARS`` that end before a space."""
    start = 0
    while len(text) - start > BATCH_CHARS:
        end = text.find(" ", start + BATCH_CHARS)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text


class PairRanks:
    """The rank of a pair of parts, for arrays of pairs: an open hash table."""

    def __init__(self, ranks: dict[int, int]) -> None:
        self._shift = np.uint64(64 - max(4, (8 * len(ranks)).bit_length()))
        size = 1 << (64 - int(self._shift))
        self._keys, self._ranks = np.full(size, -1, np.int64), np.full(size, NO_RANK, np.int32)
        slots = self._slots(np.fromiter(ranks, np.int64, len(ranks))).tolist()
        for slot, (key, rank) in zip(slots, ranks.items()):
            while self._keys[slot] != -1:
                slot = (slot + 1) % size
            self._keys[slot], self._ranks[slot] = key, rank

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self._shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        seen = self._keys[slots]
        result = np.where(seen == keys, self._ranks[slots], NO_RANK)
        left = np.flatnonzero((seen != keys) & (seen != -1))
        while len(left):
            slots[left] = (slots[left] + 1) % len(self._keys)
            seen = self._keys[slots[left]]
            hit = seen == keys[left]
            result[left[hit]] = self._ranks[slots[left[hit]]]
            left = left[~hit & (seen != -1)]
        return result


class Bpe:
    """Encoder and decoder for one vocabulary file (JSON of a byte-level BPE model)."""

    def __init__(self, source: bytes) -> None:
        spec = json.loads(source)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.size = max([*vocab.values(), *added.values()]) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._pairs: dict[int, int] = {}
        self._merged: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self._pairs.setdefault(vocab[left] * self.size + vocab[right], rank)
            self._merged.append(vocab[left + right])
        symbols = byte_symbols()
        suffix = model.get("end_of_word_suffix") or ""
        self._first = [vocab[symbol] for symbol in symbols]
        self._last = [vocab[symbol + suffix] for symbol in symbols]
        self._lower = spec["normalizer"] is not None
        if self._lower:
            steps = spec["pre_tokenizer"]["pretokenizers"]
            self._words = regex.compile(steps[0]["pattern"]["Regex"])
        else:
            self._words = regex.compile(BYTE_LEVEL_WORDS)
        self._added = added
        self._added_words = re.compile("|".join(map(re.escape, added))) if added else None
        byte_of = {symbol: byte for byte, symbol in enumerate(symbols)}
        self._bytes = [b""] * self.size
        for token, number in vocab.items():
            if token not in added:
                ending = b" " if suffix and token.endswith(suffix) else b""
                text = token[: len(token) - len(suffix)] if ending else token
                self._bytes[number] = bytes(byte_of[c] for c in text) + ending
        for token, number in added.items():
            self._bytes[number] = token.encode()
        self._ranks = PairRanks(self._pairs)
        self._tokens = pa.array(self._bytes, pa.binary())
        self._merged_ids = np.array(self._merged, np.int64)
        self._first_ids = np.array(self._first, np.int64)
        self._last_ids = np.array(self._last, np.int64)
        self._word_ids, self._chunk_ids = Memo(), Memo()
        self._library = Tokenizer.from_buffer(source) if self._lower else None
        self._batch_ids = BatchMemo(self.dtype)
        self._classes = np.array([_class_of(chr(code)) for code in range(ord(LATIN_END) + 1)], np.uint8)

    # Words --------------------------------------------------------------------

    def _ids_of_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word: short ones together, by similar length."""
        widths = [8, 16, 32, SCAN_PARTS]
        by_width: list[list[int]] = [[] for _ in widths]
        found = [b""] * len(words)
        for number, data in enumerate(words):
            place = bisect_left(widths, len(data))
            if place < len(widths):
                by_width[place].append(number)
            else:
                parts = [self._first[byte] for byte in data[:-1]] + [self._last[data[-1]]]
                found[number] = np.array(self._merge_with_heap(parts), self.dtype).tobytes()
        for width, group in zip(widths, by_width):
            for start in range(0, len(group), SCAN_WORDS):
                some = group[start : start + SCAN_WORDS]
                for number, ids in zip(some, self._merge_by_scan([words[n] for n in some], width)):
                    found[number] = ids
        return found

    def _merge_words(self, words: list[str]) -> None:
        """Find the ids of new words."""
        self._word_ids.recent.update(zip(words, self._ids_of_words([word.encode() for word in words])))

    def _merge_by_scan(self, words: list[bytes], width: int) -> list[bytes]:
        """One row per word: its parts, and the ranks between neighbours. Each round
        takes the lowest rank of every row, the leftmost of equals; rows without any
        rank left are done."""
        lengths = np.array([len(word) for word in words])
        data = np.frombuffer(b"".join(word.ljust(width, b"\0") for word in words), np.uint8)
        data = data.reshape(len(words), width)
        parts = self._first_ids[data]
        row = np.arange(len(words))
        parts[row, lengths - 1] = self._last_ids[data[row, lengths - 1]]
        parts[np.arange(width) >= lengths[:, None]] = -1
        ranks = self._rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(-1, width - 1)
        places, found = row, [b""] * len(words)
        while True:
            count, pairs = ranks.shape
            row = np.arange(count)
            at = ranks.argmin(axis=1) if pairs else np.zeros(count, np.int64)
            lowest = ranks[row, at] if pairs else np.full(count, NO_RANK)
            done = lowest == NO_RANK
            if done.any():
                ended = parts[done].astype(np.int64)
                kept = ended >= 0
                packed = ended[kept].astype(self.dtype).tobytes()
                ends = [0, *(np.cumsum(kept.sum(axis=1)) * self.dtype.itemsize).tolist()]
                for place, start, end in zip(places[done].tolist(), ends, ends[1:]):
                    found[place] = packed[start:end]
                if done.all():
                    return found
                left = ~done
                parts, ranks, places = parts[left], ranks[left], places[left]
                at, lowest, row = at[left], lowest[left], np.arange(int(left.sum()))
            parts[row, at] = self._merged_ids[lowest]
            keep = np.ones(parts.shape, bool)
            keep[row, at + 1] = False
            parts = parts[keep].reshape(len(row), -1)
            keep = np.ones(ranks.shape, bool)
            keep[row, at] = False
            ranks = ranks[keep].reshape(len(row), -1)
            for side in (at - 1, at):
                inside = np.flatnonzero((side >= 0) & (side < ranks.shape[1]))
                r, s = row[inside], side[inside]
                ranks[r, s] = self._rank(parts[r, s], parts[r, s + 1])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where((left < 0) | (right < 0), NO_RANK, self._ranks(left * self.size + right))

    def _merge_with_heap(self, parts: list[int]) -> list[int]:
        """The same merges for a long word: lowest rank first, then the leftmost."""
        count, rank_of, size = len(parts), self._pairs.get, self.size
        after = [*range(1, count), -1]
        before = [-1, *range(count - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            rank = rank_of(parts[left] * size + parts[right], NO_RANK)
            if rank != NO_RANK:
                heap.append((rank, left, parts[left], parts[right]))

        for left in range(count - 1):
            offer(left)
        heapq.heapify(heap)
        while heap:
            rank, left, first, second = heapq.heappop(heap)
            right = after[left]
            if parts[left] != first or right < 0 or parts[right] != second:
                continue
            parts[left], parts[right] = self._merged[rank], -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            grown = len(heap)
            if before[left] >= 0:
                offer(before[left])
            if after[left] >= 0:
                offer(left)
            added = heap[grown:]
            del heap[grown:]
            for entry in added:
                heapq.heappush(heap, entry)
        return [part for part in parts if part >= 0]

    # Texts --------------------------------------------------------------------

    def _normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # a capital sigma at a word's end would depend on its place
            return "".join(character.lower() for character in text)
        return text.lower()

    def _library_ids(self, text: str) -> bytes:
        """By the tokenizers library itself: characters beyond the Latin blocks, where
        versions of Unicode differ on what is a letter or a composed character."""
        ids = self._library.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _segments(self, text: str) -> list[tuple[str, str]]:
        """The text as added tokens, stretches to be cut into words, and stretches that
        are looked up whole. Words never reach over the space before a stretch."""
        if not text:
            return []
        if self._added_words is not None and any(token in text for token in self._added):
            found, done = [], 0
            for match in self._added_words.finditer(text):
                found += self._plain_segments(text[done : match.start()])
                found.append(("added", match[0]))
                done = match.end()
            return found + self._plain_segments(text[done:])
        return self._plain_segments(text)

    def _plain_segments(self, text: str) -> list[tuple[str, str]]:
        if self._lower:
            return [("chunks", text)] if text else []
        if _LOOSE_SPACE.search(text):
            return [("words", text)]
        first, _, others = text.partition(" ")
        segments = [("words", first)] if first else []
        return segments + [("chunks", others)] if others else segments

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as ``dtype``."""
        return self._encode_whole(texts) if self._lower else self._encode_by_chunks(texts)

    def _encode_whole(self, texts: list[str]) -> list[bytes]:
        """Normalised texts of Latin characters without an added token, in batches; the
        others by their chunks."""
        parts: list[list[bytes]] = [[] for _ in texts]
        others, batch, held = [], [], 0
        for number, text in enumerate(texts):
            normal = text.lower() if text.isascii() else self._normal(text)
            latin = text.isascii() or not (_BEYOND_LATIN.search(text) or _BEYOND_LATIN.search(normal))
            if not latin or (self._added_words is not None and self._added_words.search(text)):
                others.append(number)
                continue
            for stretch in _stretches(normal):
                batch.append((number, stretch))
                held += len(stretch)
                if held >= BATCH_CHARS:
                    self._encode_batch(batch, parts)
                    batch, held = [], 0
        if batch:
            self._encode_batch(batch, parts)
        for number, ids in zip(others, self._encode_by_chunks([texts[n] for n in others])):
            parts[number] = [ids]
        return [found[0] if len(found) == 1 else b"".join(found) for found in parts]

    def _encode_batch(self, batch: list[tuple[int, str]], parts: list[list[bytes]]) -> None:
        """Add the ids of each normalised stretch to the parts of its text."""
        words = self._words_of([stretch for _, stretch in batch])
        ids = self._batch_ids.found(words, self._ids_of_words)
        if ids is None:  # two words share a hash
            for (number, _), packed in zip(batch, self._encode_by_chunks([s for _, s in batch])):
                parts[number].append(packed)
            return
        flat, sizes = ids
        ends = np.concatenate([[0], np.cumsum(sizes)])[words.first].tolist()
        for (number, _), start, end in zip(batch, ends, ends[1:]):
            parts[number].append(flat[start:end].tobytes())

    def _words_of(self, texts: list[str]) -> Words:
        """What the word pattern finds: a run of letters, a number, a run of others, or an
        apostrophe at the beginning of a run with one of its endings."""
        text = "".join(texts)
        data = np.frombuffer(text.encode(), np.uint8)
        one_byte = len(data) == len(text)
        codes = data if one_byte else np.frombuffer(text.encode("utf-32-le"), "<u4")
        edges = np.cumsum([0, *map(len, texts)])
        classes = self._classes[codes]
        starts = np.ones(len(codes) + 1, bool)
        starts[1:-1] = (classes[1:] != classes[:-1]) | (classes[1:] == _NUMBER)
        starts[edges] = True
        quotes = np.flatnonzero((codes == ord("'")) & starts[:-1] & starts[1:])
        for at in np.setdiff1d(quotes, edges - 1).tolist():
            # A text's edge is a start, so an ending does not reach over it.
            for ending in (*_SHORT_ENDINGS, *_LONG_ENDINGS):
                behind = at + 1 + len(ending)
                if text.startswith(ending, at + 1) and not starts[at + 2 : behind].any():
                    starts[at + 1], starts[behind] = False, True
                    break
        bounds = np.flatnonzero(starts)
        begins, ends = bounds[:-1], bounds[1:]
        kept = classes[begins] != _SPACE
        begins, ends = begins[kept], ends[kept]
        first = np.searchsorted(begins, edges)
        if not one_byte:
            places = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F))])
            begins, ends = places[begins], places[ends]
        return Words(data, begins, ends, first)

    def _encode_by_chunks(self, texts: list[str]) -> list[bytes]:
        self._word_ids.turn()
        self._chunk_ids.turn()
        known = {"words": self._word_ids.recent, "chunks": self._chunk_ids.recent}
        lacking: dict[str, set[str]] = {"words": set(), "chunks": set()}
        cut = []
        for text in texts:
            mine = []
            for kind, stretch in self._segments(text):
                if kind == "added":
                    ids = np.array([self._added[stretch]], self.dtype).tobytes()
                    mine.append((kind, [], [ids]))
                    continue
                keys = stretch.split(" ") if kind == "chunks" else self._words.findall(stretch)
                values = list(map(known[kind].get, keys))
                if None in values:
                    lacking[kind].update([k for k, v in zip(keys, values) if v is None])
                mine.append((kind, keys, values))
            cut.append(mine)
        self._learn(lacking["words"], lacking["chunks"])
        result = []
        for mine in cut:
            parts = []
            for kind, keys, values in mine:
                if None in values:
                    found = known[kind]
                    values = [found[k] if v is None else v for k, v in zip(keys, values)]
                parts += values
            result.append(b"".join(parts))
        for memo, keys in ((self._word_ids, lacking["words"]), (self._chunk_ids, lacking["chunks"])):
            memo.forget_long(keys)
        return result

    def _learn(self, words: set[str], chunks: set[str]) -> None:
        """Put the ids of all these words and chunks into the memos."""
        words_of = {}
        for chunk in self._chunk_ids.unknown(chunks):
            if not self._lower:
                words_of[chunk] = self._words.findall(f" {chunk}")
            elif chunk.isascii() or max(chunk) <= LATIN_END:
                words_of[chunk] = self._words.findall(self._normal(chunk))
            else:
                self._chunk_ids.recent[chunk] = self._library_ids(chunk)
        found = self._word_ids.recent
        needed = set().union(*words_of.values()).difference(found)
        unknown = self._word_ids.unknown(needed | words)
        self._merge_words(unknown)
        for chunk, parts in words_of.items():
            self._chunk_ids.recent[chunk] = b"".join(map(found.__getitem__, parts))
        self._word_ids.forget_long([word for word in unknown if word not in words])

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The texts of many lists of ids: the bytes of all tokens, gathered at once, are
        cut at the ends of the lists. Bytes that are not UTF-8 are replaced, list by list."""
        ids = ids.fill_null([]) if ids.null_count else ids
        tokens = self._tokens.take(ids.flatten())
        offsets = ids.offsets.to_numpy() - ids.offsets[0].as_py()
        ends = np.frombuffer(tokens.buffers()[1], np.int32)[: len(tokens) + 1][offsets]
        buffers = [None, pa.py_buffer(ends.tobytes()), tokens.buffers()[2] or pa.py_buffer(b"")]
        texts = pa.Array.from_buffers(pa.string(), len(ids), buffers)
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            return pa.array([self.decode(one) for one in ids.to_pylist()], pa.string())
        return texts


@lru_cache(maxsize=2)
def loaded(source: bytes) -> Bpe:
    """The encoder of a vocabulary, once per Python worker."""
    return Bpe(source)


def vocabulary(spark: SparkSession, path: str):
    """The file's bytes for every task: a few MB whatever the corpus."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate([np.empty(0, np.int32), *parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, ids array<int>)`` of every whole text, in the tokenizer's own ids.

    A null text counts as empty and an empty one has no ids. Repeated rows are encoded
    each, null ids pass through, and other columns of ``docs`` are not read.
    """
    source = vocabulary(docs.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source.value)
        for batch in slices(batches):
            texts = [text or "" for text in batch["text"].to_pylist()]
            ids = [np.frombuffer(packed, bpe.dtype) for packed in bpe.encode_all(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], _list_array(ids)], names=["doc_id", "ids"]
            )

    return documents(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, ids, text)``: the text that the ids stand for, special tokens included."""
    source = vocabulary(encoded.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["ids"], bpe.decode_all(batch["ids"])],
                names=["doc_id", "ids", "text"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids array<int>, text string"
    )
