"""Byte-level BPE encoding and decoding, with pre-tokenisation by array scans.

The pattern that cuts a text into pieces is an automaton over classes of code
points. Each character is a function from state to state; functions compose, so
blocks of text are reduced to one function each, the blocks' functions are scanned,
and the blocks are replayed from their true first state, all of it in numpy over
many blocks at once. No regular expression is run.

Pieces go through a cache; those not in it are merged together in numpy, one merge
per piece and round. Token offsets in bytes are kept, and ids are decoded by
gathering the vocabulary's bytes.

Defined results: null and empty texts have no tokens; rows that repeat get a row
each; special tokens are ordinary text; other columns are kept by `encode`.
"""

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.tasks import map_texts
from tidegate.llm.text import byte_arrays, point_arrays

# Symbols: classes of code points, told apart by what follows where that decides.
LETTER, NUMBER, OTHER, SHORT, LONG, JOINER, LAST_SPACE, SPACE = range(8)
# States: what the last character belongs to. AFTER_JOINER: a blank that opens the next
# piece; REST_1, REST_2: characters of a contraction still to come; DONE: a piece just ended.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_JOINER, IN_SPACES, REST_1, REST_2, DONE = range(8)
STATES = 8

# White space as Unicode defines it, and the contractions of the pattern.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters and numbers of Unicode 16, which Python's tables do not have yet.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")

BLOCKS = 1024  # blocks of a run that are scanned side by side
CACHE_PIECES = 1 << 17  # pieces remembered by a task
LONG_PIECE = 256  # bytes from which a piece is merged on its own, by a heap


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """By symbol and state: the next state, and whether a piece begins. First characters of texts are symbols + 8."""
    goes = np.empty((16, STATES), np.uint8)
    begins = np.ones((16, STATES), bool)
    runs = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    for symbol in range(8):
        for state in range(STATES):
            inside = False
            if state == REST_2:
                to, inside = REST_1, True
            elif state == REST_1:
                to, inside = DONE, True
            elif symbol in runs:
                to = runs[symbol]
                inside = state in (to, AFTER_JOINER)
            elif symbol in (SHORT, LONG):
                inside = state in (IN_OTHERS, AFTER_JOINER)
                to = IN_OTHERS if inside else REST_1 if symbol == SHORT else REST_2
            elif symbol == JOINER:
                to = AFTER_JOINER
            elif symbol == LAST_SPACE:
                to = IN_SPACES
            else:
                to, inside = IN_SPACES, state == IN_SPACES
            goes[symbol, state], begins[symbol, state] = to, not inside
        goes[symbol + 8] = goes[symbol, DONE]
    return goes.reshape(-1), begins.reshape(-1)


@lru_cache(1)
def point_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACE for every code point."""
    by_initial = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((by_initial.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    for first, last in NEW_LETTERS:
        table[first : last + 1] = LETTER
    for first, last in NEW_NUMBERS:
        table[first : last + 1] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def symbols(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The symbol of every character of the texts laid end to end."""
    size = len(points)
    out = point_classes()[points]
    firsts = offsets[:-1][np.diff(offsets) > 0]

    def following(step: int) -> np.ndarray:
        """The character `step` further on in the same text, 0 beyond its end."""
        ahead = np.zeros(size, np.uint32)
        ahead[: size - step] = points[step:] if size > step else 0
        for back in range(1, step + 1):
            ends = firsts - back
            ahead[ends[ends >= 0]] = 0
        return ahead

    spaces = np.flatnonzero(out == SPACE)
    last = np.zeros(size, bool)
    last[:-1] = out[1:] != SPACE
    last[firsts[firsts > 0] - 1] = False  # white space that ends a text stays in one piece
    ending = spaces[last[spaces]]
    out[ending] = np.where(points[ending] == 0x20, JOINER, LAST_SPACE)
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        one, two = following(1)[quotes], following(2)[quotes]
        out[quotes[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
        pair = np.zeros(len(quotes), bool)
        for a, b in LONG_ENDINGS:
            pair |= (one == ord(a)) & (two == ord(b))
        out[quotes[pair]] = LONG
    out[firsts] += 8
    return out


def piece_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of all texts begin."""
    size = len(points)
    if not size:
        return np.empty(0, np.int64)
    goes, begins = transitions()
    width = -(-size // BLOCKS)
    padded = np.full(BLOCKS * width, SPACE, np.uint8)
    padded[:size] = symbols(points, offsets)
    columns = np.ascontiguousarray(padded.reshape(BLOCKS, width).T).astype(np.int16) * STATES

    whole = np.tile(np.arange(STATES, dtype=np.uint8), (BLOCKS, 1))  # each block's function
    for column in columns:
        whole = goes[column[:, None] + whole]
    step = 1
    while step < BLOCKS:  # functions of all blocks up to each one
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].copy(), axis=1)
        step *= 2
    state = np.concatenate(([DONE], whole[:-1, DONE])).astype(np.uint8)
    marks = np.empty((width, BLOCKS), bool)
    for i, column in enumerate(columns):
        at = column + state
        marks[i] = begins[at]
        state = goes[at]
    return np.flatnonzero(marks.T.reshape(-1)[:size])


def read_ranks(path: str) -> bytes:
    """A rank file as it is; its size is that of the vocabulary, not of the data."""
    with open(path, "rb") as file:
        return file.read()


class Encoder:
    """Merges pieces by the ranks of a vocabulary."""

    def __init__(self, ranks: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_sizes = np.array([len(token) for token in tokens], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        digits = [b"%d," % rank for rank in range(size)]
        self.digit_sizes = np.array([len(text) for text in digits], np.int64)
        self.digit_starts = np.cumsum(self.digit_sizes) - self.digit_sizes
        self.digit_bytes = np.frombuffer(b"".join(digits), np.uint8)
        self.none = size  # rank of a pair that does not merge
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], size)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.clear()

    def clear(self) -> None:
        self.cache = PieceNumbers()
        self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], self.none)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces end to end, and how many each has."""
        done: list = [None] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                done[i] = (rank,)
            elif len(piece) > LONG_PIECE:
                done[i] = self.merge_long(piece)
            else:
                short.append(i)
        sizes = np.array([len(ids) if ids is not None else 0 for ids in done], np.int64)
        if not short:
            return np.array([x for ids in done for x in ids], np.int32), sizes
        merged, counts = self.merge_short([pieces[i] for i in short])
        sizes[short] = counts
        starts = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.int32)
        flat[spread(starts[short], counts)] = merged
        known = [i for i, ids in enumerate(done) if ids is not None]
        if known:
            flat[spread(starts[known], sizes[known])] = [x for i in known for x in done[i]]
        return flat, sizes

    def merge_short(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """One merge per piece and round: of the leftmost pair with the piece's lowest rank."""
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        sizes = np.array([len(piece) for piece in pieces], np.int64)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        ended, ended_owner = [], []
        pair = np.full(len(ids), self.none, np.int64)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        pair[inner] = self.rank_of(ids[inner], ids[inner + 1])
        while len(ids):
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.minimum.reduceat(pair, first)
            counts = np.diff(np.append(first, len(ids)))
            over = np.repeat(lowest == self.none, counts)
            if over.any():
                ended.append(ids[over])
                ended_owner.append(owner[over])
                ids, owner, pair = ids[~over], owner[~over], pair[~over]
                counts, lowest = counts[lowest != self.none], lowest[lowest != self.none]
                if not len(ids):
                    break
            hits = np.flatnonzero(pair == np.repeat(lowest, counts))
            at = hits[np.concatenate(([True], owner[hits[1:]] != owner[hits[:-1]]))]
            ids[at] = pair[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            ids, owner, pair = ids[keep], owner[keep], pair[keep]
            at = moved[at]
            for left in (at[at > 0] - 1, at):
                right = np.minimum(left + 1, len(ids) - 1)
                fits = (right > left) & (owner[left] == owner[right])
                pair[left] = np.where(fits, self.rank_of(ids[left], ids[right]), self.none)
        ids, owner = np.concatenate(ended), np.concatenate(ended_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.int32), np.bincount(owner, minlength=len(pieces))

    def merge_long(self, piece: bytes) -> list[int]:
        """The same for one piece, its pairs in a heap by rank and place."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                rank = self.pairs.get(ids[i] << 32 | ids[after[i]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's ids begin and the last end."""
        data, byte_offsets = byte_arrays(texts)
        points, offsets = point_arrays(data, byte_offsets)
        starts = piece_starts(points, offsets)
        if len(self.cache) > CACHE_PIECES:
            self.clear()
        whole = data.tobytes().decode("utf-8")
        bounds = [*starts.tolist(), len(points)]
        number = self.cache.__getitem__
        numbers = np.array([number(whole[a:b]) for a, b in zip(bounds, bounds[1:])], np.int64)
        if self.cache.pending:
            flat, sizes = self.merge([piece.encode() for piece in self.cache.pending])
            self.flat, self.sizes = np.concatenate((self.flat, flat)), np.concatenate((self.sizes, sizes))
            self.cache.pending.clear()
        begins = np.cumsum(self.sizes) - self.sizes
        counts = self.sizes[numbers]
        ids = self.flat[spread(begins[numbers], counts)]
        before = np.concatenate(([0], np.cumsum(counts)))
        return ids, before[np.searchsorted(starts, offsets)]

    def token_offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each token begins in the bytes of all tokens, and where the last ends."""
        return np.concatenate(([0], np.cumsum(self.token_sizes[ids])))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[spread(self.token_starts[ids], self.token_sizes[ids])].tobytes()

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, a comma after each."""
        return self.digit_bytes[spread(self.digit_starts[ids], self.digit_sizes[ids])].tobytes()


class PieceNumbers(dict):
    """Numbers pieces in the order they are first asked for."""

    def __init__(self):
        self.pending: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.pending.append(piece)
        return number


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all ranges, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + sizes, sizes) + np.arange(total)


@lru_cache(2)
def encoder_for(ranks: bytes) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(ranks)


def encode(documents: DataFrame, ranks: bytes) -> DataFrame:
    """`documents` with `ids`, and `token_starts`: each token's first byte in the text."""
    sent = documents.sparkSession.sparkContext.broadcast(ranks)
    added = "ids array<int>, token_starts array<int>"

    def run(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(sent.value)
        ids, bounds = encoder.encode(texts)
        at = encoder.token_offsets(ids)[:-1]
        at -= np.repeat(byte_arrays(texts)[1][:-1], np.diff(bounds))
        lists = [
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
            for values in (ids, at)
        ]
        names = [name for name in rows.schema.names if name not in ("ids", "token_starts")]
        yield pa.RecordBatch.from_arrays([rows.column(n) for n in names] + lists, [*names, "ids", "token_starts"])

    kept = documents.drop("ids", "token_starts")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_texts(kept, run, f"{schema}, {added}")


def decode(encoded: DataFrame, ranks: bytes, name: str = "decoded") -> DataFrame:
    """doc_id and the bytes that `ids` stand for, a null list counting as empty."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(sent.value)
        for batch in batches:
            out = [encoder.decode(np.array(ids.as_py() or [], np.int64)) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", name])

    rows = encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids")
    return rows.mapInArrow(run, f"doc_id bigint, {name} binary")


def encode_and_decode(documents: DataFrame, ranks: bytes) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256; the ids stay in the task."""
    sent = documents.sparkSession.sparkContext.broadcast(ranks)

    def run(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(sent.value)
        ids, bounds = encoder.encode(texts)
        digits, decoded = memoryview(encoder.decimals(ids)), memoryview(encoder.decode(ids))
        digit_at = np.concatenate(([0], np.cumsum(encoder.digit_sizes[ids])))[bounds].tolist()
        byte_at = encoder.token_offsets(ids)[bounds].tolist()
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array([hashlib.sha256(digits[a : max(a, b - 1)]).hexdigest() for a, b in zip(digit_at, digit_at[1:])]),
                pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(byte_at, byte_at[1:])]),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_texts(rows, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
