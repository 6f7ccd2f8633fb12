"""Whole texts as flat numpy arrays: bytes, code points, words, hashes of slices.

Spark hands Arrow batches of texts to a task; these helpers lay the texts of a
batch end to end, so that one numpy call works on all of them. `runs` cuts a batch
so that the arrays stay small however long the texts are together; a text is
never cut.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 2 << 20  # texts of one run together, unless one text alone is longer

# An odd 64-bit multiplier and the constants of a 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values over all bits; a one-to-one mapping for each seed."""
    out = values.astype(np.uint64) ^ np.uint64((seed * BASE) & 0xFFFFFFFFFFFFFFFF)
    out ^= out >> np.uint64(33)
    out *= MIX_1
    out ^= out >> np.uint64(33)
    out *= MIX_2
    out ^= out >> np.uint64(33)
    return out


def as_text(column: pa.Array) -> pa.Array:
    """A string column without nulls: null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def runs(texts: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together have at most `most` bytes, at least one row each."""
    sizes = pc.binary_length(texts.cast(pa.large_binary())).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def byte_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins and the last ends."""
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def point_arrays(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, and where each text begins and the last ends."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return points, before[offsets]


class SliceHashes:
    """Hashes of any slices of a symbol array, from one prefix sum.

    A slice's hash depends on its symbols and their order, not on its place.
    Different slices collide with about 2 ** -64, so exact users compare after it.
    """

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    def __init__(self, symbols: np.ndarray):
        cls = type(self)
        if len(cls.powers) < len(symbols) + 1:
            size = max(len(symbols) + 1, RUN_BYTES + 1)
            cls.inverses = np.cumprod(
                np.concatenate((np.ones(1, np.uint64), np.full(size - 1, BASE_INVERSE, np.uint64))), dtype=np.uint64
            )
            cls.powers = np.cumprod(
                np.concatenate((np.ones(1, np.uint64), np.full(size - 1, BASE, np.uint64))), dtype=np.uint64
            )
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        table = cls.symbol_table
        spread = table[symbols] if symbols.dtype == np.uint8 else mix(symbols, 11)
        np.cumsum(spread * cls.powers[: len(symbols)], out=self.sums[1:])

    symbol_table = mix(np.arange(256, dtype=np.uint64), 11)

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        raw = (self.sums[stops] - self.sums[starts]) * self.inverses[starts]
        return mix(raw + (stops - starts).astype(np.uint64), 3)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table[data]


# Bytes of words: ASCII digits and lower-case letters, and all of a character beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[ord("0") : ord("9") + 1] = True
WORD_BYTE[ord("a") : ord("z") + 1] = True
WORD_BYTE[0x80:] = True


class Words:
    """The words of the texts of one run, in order, A-Z lower-cased.

    `starts`, `stops`: byte ranges in `data`; `first`: the first word of each text,
    and the number of all words at the end; `owner`: the text of each word.
    """

    def __init__(self, texts: pa.Array):
        raw, self.offsets = byte_arrays(texts)
        self.data = lower_ascii(raw)
        size = len(self.data)
        inside = WORD_BYTE[self.data]
        before, after = np.zeros(size, bool), np.zeros(size, bool)
        if size:
            before[1:], after[:-1] = inside[:-1], inside[1:]
            begins = self.offsets[:-1]
            before[begins[begins < size]] = False
            ends = self.offsets[1:] - 1
            after[ends[ends >= 0]] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.stops = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hashes = SliceHashes(self.data).of(self.starts, self.stops)

    def text(self, start: int, stop: int) -> list[str]:
        return [bytes(self.data[self.starts[i] : self.stops[i]]).decode() for i in range(start, stop)]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` words within a text, and the first word of each."""
        count = len(self.hashes) - size + 1
        if count <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        sums = np.zeros(count, np.uint64)
        for i in range(size):
            sums = sums * np.uint64(BASE) + self.hashes[i : i + count]
        at = np.flatnonzero(self.owner[:count] == self.owner[size - 1 :])
        return mix(sums[at], size), at


def signed(hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes as the signed integers that Spark has."""
    return hashes.astype(np.uint64).view(np.int64)


def unsigned(values: np.ndarray) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)
