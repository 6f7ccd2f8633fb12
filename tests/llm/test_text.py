import re

import numpy as np
import pyarrow as pa

from tidegate.llm.text import RUN_BYTES, Words, as_text, runs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["Hello, wörld 12!", "", None, "a b c d e f", "x", "é", "ÀB c-d\x00e", "tail word"]


def test_words_are_those_of_the_pattern():
    words = Words(as_text(pa.array(TEXTS)))
    for i, text in enumerate(TEXTS):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        assert words.text(words.first[i], words.first[i + 1]) == WORD.findall(low)


def test_shingles_stay_within_a_text_and_depend_on_words_alone():
    a, at = Words(as_text(pa.array(["a b c", "b c d"]))).shingles(2)
    assert at.tolist() == [0, 1, 3, 4]
    assert a[1] == a[2] and len(set(a.tolist())) == 3
    assert len(Words(as_text(pa.array(["a b", "c"]))).shingles(3)[0]) == 0


def test_runs_cover_all_rows_and_cut_no_text():
    texts = as_text(pa.array(["x" * (RUN_BYTES // 2), "y" * (2 * RUN_BYTES), None, "", "z"]))
    found = list(runs(texts))
    assert [row for start, stop in found for row in range(start, stop)] == list(range(5))
    assert list(runs(texts.slice(0, 0))) == []


def test_slices_of_arrow_arrays():
    texts = as_text(pa.array(["skip", "one two", "three"])).slice(1, 2)
    words = Words(texts)
    assert words.text(0, 3) == ["one", "two", "three"]
    assert np.diff(words.first).tolist() == [2, 1]
