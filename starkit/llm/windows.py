"""Word windows of a batch of texts as arrays, without a Python object per word.

Texts are read from the Arrow buffer as bytes. A word is hashed twice, eight bytes at a
time, and a window by doubling its width. Every step ends in a bijection that mixes all
bits, so that neither hash is linear and the two of a window are 128 independent bits.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

# Odd factors of the two independent hashes, for words and for windows.
WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
# Longer words are hashed by the xxhash library, with these numbers as seeds.
LONG_WORD = 256
_SEEDS = (0x9E3779B97F4A7C15, 0xE7037ED1A0B428DB)
_LANE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


class Words(NamedTuple):
    """Byte spans of all words of a batch, and where each text's words begin."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # text -> its first word; one more entry at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; one more entry at the end. A null
    text is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each text; a null text has none."""
    data, offsets = text_bytes(texts)
    return words_in(data, offsets, (data != 32) & ((data - np.uint8(9)) > 4))


def words_in(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Runs of the bytes that are ``inside``, cut at the edges of the texts."""
    starts, ends = inside.copy(), np.zeros(len(data) + 1, bool)
    starts[1:] &= ~inside[:-1]
    ends[1:-1] = inside[:-1] & ~inside[1:]
    # A text's edge is an edge of a word, too.
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    ends[edges] |= inside[edges - 1]
    if len(data):
        ends[-1] = inside[-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every word."""
    sizes = words.ends - words.starts
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(words.data), "<u8", padded, strides=(1,))  # the 8 bytes at each place
    hashes = tuple(mixed(sizes.astype(np.uint64) ^ np.uint64(seed)) for seed in _SEEDS)
    long = sizes > LONG_WORD
    left = np.flatnonzero(~long) if long.any() else slice(None)
    at, sizes_left = words.starts[left], sizes[left]
    while len(at):
        lane = lanes[at] & _LANE_MASKS[np.minimum(sizes_left, 8)]
        for found, factor in zip(hashes, WINDOW_BASES):
            found[left] = mixed((found[left] ^ lane) * np.uint64(factor))
        more = sizes_left > 8
        left = (np.arange(len(sizes)) if isinstance(left, slice) else left)[more]
        at, sizes_left = at[more] + 8, sizes_left[more] - 8
    for place in np.flatnonzero(long).tolist():
        word = words.data[words.starts[place] : words.ends[place]].tobytes()
        for found, seed in zip(hashes, _SEEDS):
            found[place] = xxhash.xxh64_intdigest(word, seed)
    return hashes


def _joined(left: np.ndarray, left_width: int, right: np.ndarray, power: int) -> np.ndarray:
    """Hashes of windows made of a window of ``left_width`` words and one behind it."""
    count = max(0, len(right) - left_width)
    return mixed(left[:count] * np.uint64(power) + right[left_width : left_width + count])


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """The hash of each run of ``width`` words, across texts as well."""
    part, part_width, found, found_width = hashes, 1, None, 0
    while True:
        if width & part_width:
            if found is None:
                found, found_width = part, part_width
            else:
                power = pow(base, part_width, 1 << 64)
                found = _joined(found, found_width, part, power)
                found_width += part_width
        if 2 * part_width > width:
            return found
        part = _joined(part, part_width, part, pow(base, part_width, 1 << 64))
        part_width *= 2


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def window_starts(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window that lies in one text: its first word, and its text."""
    per_text = np.maximum(words.counts() - (width - 1), 0)
    text = np.repeat(np.arange(len(per_text)), per_text)
    before = np.cumsum(per_text) - per_text
    return np.arange(len(text)) - before[text] + words.first[:-1][text], text
