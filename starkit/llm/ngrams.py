"""Hashed character n-grams of whole texts, as arrays."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

_SPACE = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


class NgramSpec(NamedTuple):
    """Orders of the n-grams, and the power of two of features they are hashed to."""

    orders: tuple[int, ...]
    bits: int

    @property
    def size(self) -> int:
        return 1 << self.bits


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for code in range(0x110000):
        character = chr(code)
        if character.isalpha():
            table[code] = ord(character.lower()[0])
    return table


def letters(text: str | None) -> np.ndarray:
    """Lower-cased letters, with one space for all else between and around words; empty if
    there is no letter."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letter_table()[codes]
    codes = np.concatenate([[np.uint32(_SPACE)], codes, [np.uint32(_SPACE)]])
    space = codes == _SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first space behind a word
    keep[0] = True
    codes = codes[keep]
    return codes if len(codes) > 1 else codes[:0]


def features(codes: np.ndarray, spec: NgramSpec) -> list[np.ndarray]:
    """The feature number of each n-gram, an array for each order."""
    found, hashes = [], None
    for order in range(1, max(spec.orders) + 1):
        if hashes is None:
            hashes = (codes.astype(np.uint64) + np.uint64(1)) * _STEP
        elif len(hashes) > 1:
            hashes = (hashes[:-1] ^ (hashes[:-1] >> np.uint64(29))) * _STEP
            hashes += codes[order - 1 :]
        else:
            break
        if order in spec.orders:
            mixed = (hashes ^ (hashes >> np.uint64(32))) * _STEP
            found.append((mixed >> np.uint64(64 - spec.bits)).astype(np.int64))
    return found


def counts(codes: np.ndarray, spec: NgramSpec) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text in order, and how often each occurs."""
    total = np.zeros(spec.size, np.int32)
    for part in features(codes, spec):
        total += np.bincount(part, minlength=spec.size).astype(np.int32)
    present = np.flatnonzero(total)
    return present, total[present]


def presence(codes: np.ndarray, spec: NgramSpec) -> np.ndarray:
    """The features that a text has, in order."""
    marked = np.zeros(spec.size, bool)
    for part in features(codes, spec):
        marked[part] = True
    return np.flatnonzero(marked)
