"""Simple-8b: integers in 64-bit words, whole blocks at a time in numpy.

The top four bits of a word select how many values it holds and how wide they are;
the values follow from the lowest bit up. A value of more than 60 bits is an escape:
its word holds its place in a list of plain 64-bit values. Blocks of BLOCK values
begin a word of their own, and the first word of each block is listed, so a block is
read without those before it. All blocks are packed side by side: the choice of the
next word is a step that numpy takes for every block at once.
"""

import numpy as np

BLOCK = 1024

# Per selector, the values in a word and the bits of each; 0 is the escape.
COUNTS = np.array([1, 240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 0
SELECTOR_AT = np.uint64(60)
PAYLOAD = np.uint64((1 << 60) - 1)


def block_ends(n: int) -> np.ndarray:
    """Where each block ends, of `n` values."""
    return np.minimum(np.arange(BLOCK, n + BLOCK, BLOCK), n)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """The bits of each value; conversion to a float is exact for the halves."""
    if not int(values.max(initial=0)) >> 32:
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    high, low = values >> np.uint64(32), values & np.uint64((1 << 32) - 1)
    return np.where(high > 0, bit_lengths(high) + 32, bit_lengths(low)).astype(np.uint8)


def selectors(values: np.ndarray) -> np.ndarray:
    """The selector of a word that begins at each place: the most values that fit.

    The widest of the next values is found for longer and longer runs, each from two
    shorter ones. Beyond its block a run meets nothing that needs a bit.
    """
    n = len(values)
    blocks = len(block_ends(n))
    beyond = int(COUNTS.max())
    bits = np.zeros((blocks, BLOCK + beyond), np.uint8)
    whole = n // BLOCK
    lengths = bit_lengths(values)
    bits[:whole, :BLOCK] = lengths[: whole * BLOCK].reshape(whole, BLOCK)
    if whole < blocks:
        bits[whole, : n - whole * BLOCK] = lengths[whole * BLOCK :]
    best = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    widest, covered = bits, 1  # of the next `covered` values
    for number in range(len(COUNTS) - 1, 0, -1):  # from few values to many, so the last that fits stands
        count = int(COUNTS[number])
        while covered < count:
            step = min(covered, count - covered)
            widest = np.maximum(widest[:, : widest.shape[1] - step], widest[:, step:])
            covered += step
        best[widest[:, :BLOCK] <= WIDTHS[number]] = number
    return best.reshape(-1)[:n]


def word_places(best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, and the number of the first word of each block."""
    n = len(best)
    ends = block_ends(n)
    steps, at = [], np.arange(0, n, BLOCK)
    running = np.arange(len(ends))
    while len(running):
        steps.append((running, at))
        at = at + COUNTS[best[at]]
        going = at < ends[running]
        running, at = running[going], at[going]
    blocks = np.concatenate([blocks for blocks, _ in steps])
    places = np.sort(np.concatenate([at for _, at in steps]))
    words = np.bincount(blocks, minlength=len(ends))
    return places, np.concatenate(([0], np.cumsum(words)[:-1]))


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, the number of each block's first word, and the escaped values."""
    values = np.ascontiguousarray(values, np.uint64)
    if not len(values):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64)
    best = selectors(values)
    places, firsts = word_places(best)
    chosen = best[places].astype(np.int64)
    stops = np.append(places[1:], len(values))
    words = chosen.astype(np.uint64) << SELECTOR_AT
    for number in np.unique(chosen):
        mine = np.flatnonzero(chosen == number)
        if number == ESCAPE:
            escapes = values[places[mine]]
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
            continue
        for k in range(int(COUNTS[number]) if WIDTHS[number] else 0):
            held = mine[places[mine] + k < stops[mine]]
            words[held] |= values[places[held] + k] << np.uint64(k * int(WIDTHS[number]))
    return words, firsts, escapes if (chosen == ESCAPE).any() else np.empty(0, np.uint64)


def unpack(words: np.ndarray, firsts: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The `n` values of blocks whose first words are `firsts`, counted from the first of `words`."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    number = (words >> SELECTOR_AT).astype(np.int64)
    before = np.concatenate(([0], np.cumsum(COUNTS[number])))
    sizes = np.diff(np.append(firsts, len(words)))
    # a block's last word may stand for more values than are left
    starts = before[:-1] - np.repeat(before[firsts] - np.arange(0, n, BLOCK), sizes)
    stops = np.repeat(block_ends(n), sizes)
    payload = words & PAYLOAD
    for chosen in np.unique(number):
        mine = np.flatnonzero(number == chosen)
        if chosen == ESCAPE:
            out[starts[mine]] = escapes[payload[mine].astype(np.int64)]
            continue
        width = int(WIDTHS[chosen])
        mask = np.uint64((1 << width) - 1)
        for k in range(int(COUNTS[chosen]) if width else 0):
            held = mine[starts[mine] + k < stops[mine]]
            out[starts[held] + k] = (payload[held] >> np.uint64(k * width)) & mask
    return out


def unpack_range(words: np.ndarray, firsts: np.ndarray, escapes: np.ndarray, n: int, start: int, stop: int) -> np.ndarray:
    """Values `start` to `stop` (exclusive): only the blocks that hold them are read."""
    if start >= stop:
        return np.empty(0, np.uint64)
    low, high = start // BLOCK, (stop - 1) // BLOCK + 1
    last = int(firsts[high]) if high < len(firsts) else len(words)
    some = unpack(words[int(firsts[low]) : last], firsts[low:high] - firsts[low], escapes, min(n, high * BLOCK) - low * BLOCK)
    return some[start - low * BLOCK : stop - low * BLOCK]
