"""Character n-grams of whole texts as 64-bit keys."""

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tidegate.llm.text import byte_arrays, point_arrays

BLANK = 0x20
POINT_BITS = 21  # of any code point


@lru_cache(1)
def lower_points() -> np.ndarray:
    """The lower-case code point of each one that has a single one."""
    table = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x20000):  # letters with case lie below
        low = chr(i).lower()
        if len(low) == 1:
            table[i] = ord(low)
    return table


@lru_cache(1)
def letters_only() -> np.ndarray:
    """The lower-case letter of each code point, a blank for what is no letter or mark."""
    table = lower_points().copy()
    kinds = np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)), bool, 0x110000)
    table[~kinds] = BLANK
    return table


def padded(points: np.ndarray, offsets: np.ndarray, pad: int, symbol: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with `pad` symbols before each and one after it, the text of each symbol, and where texts begin."""
    count = len(offsets) - 1
    sizes = np.diff(offsets)
    begins = offsets + np.arange(count + 1) * (pad + 1)
    out = np.full(int(begins[-1]), symbol, np.uint32)
    owner = np.repeat(np.arange(count), sizes + pad + 1)
    out[np.arange(len(points)) + np.repeat(np.arange(count) * (pad + 1) + pad, sizes)] = points
    return out, owner, begins


def word_trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of three characters of a word and the blanks around it, and the text of each."""
    points, offsets = point_arrays(*byte_arrays(texts))
    symbols, owner, _ = padded(letters_only()[points], offsets, 1, BLANK)
    wide = symbols.astype(np.uint64)
    keys = wide[:-2] << np.uint64(2 * POINT_BITS) | wide[1:-1] << np.uint64(POINT_BITS) | wide[2:]
    inner = symbols[1:-1] != BLANK
    return keys[inner], owner[1:-1][inner]


def has_letter(texts: pa.Array) -> np.ndarray:
    points, offsets = point_arrays(*byte_arrays(texts))
    before = np.concatenate(([0], np.cumsum(letters_only()[points] != BLANK)))[offsets]
    return np.diff(before) > 0
