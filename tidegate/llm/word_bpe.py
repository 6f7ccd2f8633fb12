"""Ids of the tokenizers library, with each distinct word of a run encoded once.

For tokenizers that drop white space and look at no character beyond it, the ids of a
text are those of its parts, cut before a blank or a line break. A part is also cut
between an ASCII letter and a sign of ENDS: no piece of the pattern holds both, and
neither normalisation nor a special token joins them. A line break counts as a blank,
and an ASCII capital as its small letter, as the library has it after normalisation,
unless a character beyond ASCII follows, with which it might be composed, or the run
holds an opening of a special token. Parts are gathered per run, looked up, and the
unknown ones are encoded together, with a character between them that becomes a token
of its own.

Known parts are kept in two generations of KEPT parts, so memory is bounded: when one
is full, it replaces the one before.
"""

import os

import numpy as np
import pyarrow as pa

KEPT, KEPT_BYTES = 1 << 18, 48
TOGETHER = 2000  # unknown parts of one call
ENDS = ",.;:!?"
MARK = "\x01"  # between parts; parts that hold it are encoded alone

OPENING = b"<|"  # of special tokens, which are told apart by case

LETTERS, SIGNS, GAPS, CAPITALS = (np.zeros(256, bool) for _ in range(4))
CAPITALS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
LETTERS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
SIGNS[list(ENDS.encode())] = True
GAPS[list(b" \n")] = True


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        (self.mark,) = self.ids_of(MARK)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids_of(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The flat ids of all texts, and where each text's begin and the last end."""
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        begins = GAPS[data]
        begins[1:] |= SIGNS[data[1:]] & LETTERS[data[:-1]]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        cuts = np.append(np.flatnonzero(begins), len(data))
        data = self.alike(data)
        parts = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data))
        coded = parts.dictionary_encode()
        ids, sizes = self.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = coded.indices.to_numpy()
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        shift = (np.cumsum(sizes) - sizes)[which] - (ends - lengths)
        flat = ids[np.arange(int(ends[-1])) + np.repeat(shift, lengths)]
        before = np.concatenate(([0], ends))
        return flat, before[np.searchsorted(cuts, offsets)]

    @staticmethod
    def alike(data: np.ndarray) -> np.ndarray:
        """Bytes with the same ids, in fewer forms."""
        data = np.where(data == 10, np.uint8(32), data)
        if OPENING not in data.tobytes():
            data[:-1][CAPITALS[data[:-1]] & (data[1:] < 128)] |= 32
        return data

    def look_up(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The flat ids of distinct parts, and how many each has."""
        found = list(map(self.recent.get, parts))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self.older.get(parts[i])
        missing = [i for i, ids in enumerate(found) if ids is None]
        plain = [i for i in missing if MARK not in parts[i]]
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            ids = np.array(self.ids_of(f" {MARK} ".join([parts[i] for i in some])), np.uint32)
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            begins = np.concatenate(([0], ends[:-1] + 1))
            for i, a, b in zip(some, begins.tolist(), ends.tolist()):
                found[i] = ids[a:b].tobytes()
        for i in set(missing).difference(plain):
            found[i] = np.array(self.ids_of(parts[i]), np.uint32).tobytes()
        for i in missing:
            if len(parts[i]) <= KEPT_BYTES:
                self.keep(parts[i], found[i])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), sizes

    def keep(self, part: str, ids: bytes) -> None:
        if len(self.recent) >= KEPT:
            self.older, self.recent = self.recent, {}
        self.recent[part] = ids


encoders: dict[str, WordEncoder] = {}


def encoder_at(path: str) -> WordEncoder:
    """One encoder per file and worker."""
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]
