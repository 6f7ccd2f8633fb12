import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tidegate.llm import bpe
from tidegate.llm.text import as_text

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", None, "a" * 3000, "ab'll" * 300, " " * 500, "x" + "\n" * 40 + "y", "***" * 400, "it's 'twas ''s !'s\n's", "\U0001F600 ⅷ²"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(count):
    rng = random.Random(7)
    signs = "abst'rved lL  \n\t19!?-  　é世\U0001F600ⅷ²'\x1c​\U000105C0"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_ids_are_those_of_the_library(library):
    texts = random_texts(4000) + ODD
    encoder = bpe.Encoder(bpe.read_ranks(PATH))
    ids, bounds = encoder.encode(as_text(pa.array(texts)))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == library.encode_ordinary(text or "")
    assert encoder.decode(ids) == "".join(text or "" for text in texts).encode()


def test_cache_is_emptied_and_filled_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    encoder = bpe.Encoder(bpe.read_ranks(PATH))
    for text in ["one two three four five", "six seven one", "one"]:
        ids, _ = encoder.encode(as_text(pa.array([text])))
        assert ids.tolist() == library.encode_ordinary(text)


def test_long_pieces_merge_as_short_ones_do():
    encoder = bpe.Encoder(bpe.read_ranks(PATH))
    piece = b"thethingabcabca" * 10
    flat, _ = encoder.merge_short([piece])
    assert flat.tolist() == list(encoder.merge_long(piece))


def test_query_digests(spark, docs, library):
    texts = ["Hello world", "Hello world", *ODD]
    rows = {r["doc_id"]: r for r in bpe.encode_and_decode(docs(texts), bpe.read_ranks(PATH)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_and_decode(docs([]), bpe.read_ranks(PATH)).collect() == []


def test_round_trip_with_offsets(spark, docs):
    frame = docs(["naïve café", "", None, "b b"]).selectExpr("*", "1 as ids")
    ranks = bpe.read_ranks(PATH)
    encoded = bpe.encode(frame, ranks)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "token_starts"]
    decoded = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(encoded, ranks).collect()}
    vocabulary = bpe.Encoder(ranks)
    for row in encoded.collect():
        text = (row["text"] or "").encode()
        assert decoded[row["doc_id"]] == text
        ends = row["token_starts"][1:] + [len(text)]
        assert [text[a:b] for a, b in zip(row["token_starts"], ends)] == [vocabulary.decode([i]) for i in row["ids"]]
