import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegate.llm import simple8b, token_files, word_bpe
from tidegate.llm.queries import op11_token_files
from tidegate.llm.text import as_text

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "abstΣσ'rvedIL,.;:!? \n\t19-<|endoftext|>é́̈世\U0001F600ⅷ²\x1c\x01̸=İ​\xa0\rſK"
ODD = ["<|endoftext|>,x a<|startoftext|>.", "", None, "a" * 5000, " " * 500, "it's, I'll. we've! 'twas", "\x01", "\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(count):
    rng = random.Random(5)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def expected(library, texts):
    return [library.encode(text or "", add_special_tokens=False).ids + [1] for text in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 59, 60, 61, 239, 240, 241, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("bits", [0, 1, 2, 5, 16, 40, 60, 61, 64])
def test_words_hold_all_values(n, bits):
    rng = np.random.default_rng(n * 100 + bits)
    values = rng.integers(0, (1 << bits) - 1, n, dtype=np.uint64, endpoint=True)
    values[rng.random(n) < 0.4] = 0
    words, firsts, escapes = simple8b.pack(values)
    assert (simple8b.unpack(words, firsts, escapes, n) == values).all()
    assert len(escapes) == (values >> np.uint64(60) > 0).sum()
    for _ in range(5):
        start, stop = sorted(rng.integers(0, n + 1, 2).tolist())
        assert (simple8b.unpack_range(words, firsts, escapes, n, start, stop) == values[start:stop]).all()


def test_each_word_holds_as_many_values_as_fit():
    words, firsts, escapes = simple8b.pack(np.array([1] * 60 + [3] * 30 + [1 << 59], np.uint64))
    assert (words >> np.uint64(60)).tolist() == [2, 3, 15]
    assert len(simple8b.pack(np.zeros(1024, np.uint64))[0]) == 5
    assert firsts.tolist() == [0] and not len(escapes)


def test_ids_are_those_of_the_library(library):
    texts = random_texts(3000) + ODD
    ids, bounds = word_bpe.WordEncoder(PATH).encode(as_text(pa.array(texts)))
    for text, want, a, b in zip(texts, expected(library, texts), bounds, bounds[1:]):
        assert ids[a:b].tolist() == want[:-1], text


def test_known_parts_are_forgotten_in_generations(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "KEPT", 3)
    encoder = word_bpe.WordEncoder(PATH)
    for text in ["one two three four five", "six one  seven", "one two"]:
        ids, _ = encoder.encode(as_text(pa.array([text])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.recent) <= 3 and len(encoder.older) <= 3


def test_a_file_gives_back_documents_escapes_and_ranges(monkeypatch):
    monkeypatch.setattr(token_files, "PACK_IDS", 2 * simple8b.BLOCK)
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 1 << 16, 10_000, dtype=np.uint64)
    ids[::777] = np.uint64(1 << 63) + ids[::777]
    sizes = np.array([4000, 0, 5000, 1000])
    content = token_files.as_file(3, 4, np.array([-5, 0, 7, 8]), np.array([False, True, False, False]), sizes, ids)
    file = token_files.File(content + b"\n")
    assert (file.task, file.number, file.doc_ids.tolist(), file.unknown.tolist()) == (3, 4, [-5, 0, 7, 8], [False, True, False, False])
    assert (file.ids() == ids).all()
    assert (file.ids_between(3990, 7003) == ids[3990:7003]).all()
    with pytest.raises(ValueError):
        token_files.File(content[:-8])
    with pytest.raises(ValueError):
        token_files.File(b"x" * len(content))


def read_back(spark, frame, folder):
    token_files.write_ids(frame, folder, lambda: word_bpe.encoder_at(PATH), 1)
    rows = token_files.with_starts(token_files.read_ids(spark, folder), token_files.file_starts(spark, folder)).collect()
    return sorted(rows, key=lambda row: row["start"])


def test_files_hold_documents_in_order(spark, docs, library, tmp_path, monkeypatch):
    texts = random_texts(300) + ODD
    frame = docs(texts).selectExpr("*", "1 as ids", "2 as content", "3 as start", "4 as task")
    rows = read_back(spark, frame.orderBy(F.desc("doc_id")), str(tmp_path / "ids"))
    want = expected(library, texts)
    assert [row["doc_id"] for row in rows] == list(range(len(texts)))
    start = 0
    for row, ids in zip(rows, want):
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        start += len(ids)


def test_files_are_closed_when_full_and_hold_whole_documents(library):
    pending = token_files.Pending(6)
    token_files_of = []
    limit, token_files.FILE_IDS = token_files.FILE_IDS, 10
    try:
        sizes = np.array([4, 4, 4, 25, 1, 10, 3])
        ids = np.arange(sizes.sum(), dtype=np.uint64)
        for part in (slice(0, 3), slice(3, 7)):
            done = sizes[: part.start].sum()
            mine = ids[done : done + sizes[part].sum()]
            numbers = np.arange(part.start, part.stop)
            token_files_of += pending.add(numbers, numbers < 0, sizes[part], mine)
        token_files_of.append(pending.close())
    finally:
        token_files.FILE_IDS = limit
    files = [token_files.File(content) for content in token_files_of]
    assert [file.doc_ids.tolist() for file in files] == [[0, 1, 2], [3], [4, 5], [6]]
    assert [file.number for file in files] == [0, 1, 2, 3] and {file.task for file in files} == {6}
    assert np.concatenate([file.ids() for file in files]).tolist() == ids.tolist()


def test_null_ids_repeats_and_ties(spark, library, tmp_path):
    rows = [(None, "b"), (3, "a"), (3, "a"), (3, None), (None, "b"), (-1, "c c")]
    found = read_back(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "ids"))
    assert [row["doc_id"] for row in found] == [None, None, -1, 3, 3, 3]
    assert sum(row["n_tokens"] for row in found) == sum(map(len, expected(library, [text for _, text in rows])))
    assert [row["start"] for row in found] == np.cumsum([0] + [row["n_tokens"] for row in found])[:-1].tolist()


def test_empty_table(spark, docs, tmp_path):
    assert read_back(spark, docs([]), str(tmp_path / "ids")) == []


def test_query_over_the_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = {row["doc_id"]: row for row in op11_token_files(spark, folder).collect()}
    start = 0
    for doc in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        ids = expected(library, [doc["text"]])[0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(rows[doc["doc_id"]][c] for c in ("start", "n_tokens", "ids_crc32")) == (start, len(ids), crc)
        start += len(ids)
