import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegate.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(rows):
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found[conv_id].append((turn is not None, turn or 0, role, digest, text))
    return {conv_id: [(role, text) for _, _, role, _, text in sorted(turns)] for conv_id, turns in found.items()}


def by_hand(turns_of):
    members = defaultdict(list)
    for conv_id, turns in turns_of.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved, found = {}, {}, []
    for prefix in sorted(members, key=len, reverse=True):
        convs = members[prefix]
        leaves[prefix] = sum(leaves[child] for child in children[prefix]) or 1
        own = (len(convs) - 1) * (len(prefix[-1][1]) if prefix else 0)
        saved[prefix] = own + sum(saved[child] for child in children[prefix])
        ends = ",".join(map(str, sorted(c for c in convs if len(turns_of[c]) == len(prefix))))
        parent = min(members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(convs), len(prefix), parent, len(convs), len(children[prefix]), leaves[prefix], saved[prefix], digest))
    return sorted(found, key=repr)


def rows_of(frame):
    assert tuple(frame.columns) == COLUMNS
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def some_rows(count, seed, first=0):
    rng = random.Random(seed)
    rows = []
    for conv_id in range(first, first + count):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv_id, turn, "ua"[turn % 2], rng.choice(["", "x", "ü\n", "long text"])))
    return rows


def test_conversations_as_they_are(spark):
    rows = some_rows(200, 1)
    assert rows_of(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(sequences(rows))


def test_spans_of_ids_that_end_together(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS_SPAN", 7)
    rows = [(conv_id, 0, "u", "same") for conv_id in (*range(-20, 40), 900, 10**15)]
    rows += [(conv_id, 1, "a", "more") for conv_id in range(0, 40, 3)]
    assert rows_of(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(sequences(rows))


def test_long_conversations_do_not_lengthen_the_peeling(spark):
    rows = [(1, turn, "u", f"{turn}") for turn in range(400)] + [(2, 0, "u", "0"), (2, 1, "a", "1"), (3, 0, "u", "0")]
    assert rows_of(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(sequences(rows))


def test_branched_conversations(spark):
    """Bases that are absent, shorter than the head, negative ids, and conversations without turns."""
    rows = some_rows(30, 2) + some_rows(30, 3, first=205) + some_rows(20, 4, first=-110) + some_rows(2, 5, first=1000)
    rows += [(400, 0, "u", "only"), (407, 0, "u", "a"), (409, 0, "u", "b"), (411, 0, None, None)]
    turns_of = sequences(rows)
    rebuilt = {}
    for conv_id, turns in turns_of.items():
        head = zlib.crc32(str(conv_id).encode()) % 6
        base = conv_id - (abs(conv_id) % 100) * (1 if conv_id >= 0 else -1)
        rebuilt[conv_id] = turns_of.get(base, [])[:head] + turns[head:]
    assert any(not turns for turns in rebuilt.values())
    turns = trie.turn_rows(spark.createDataFrame(rows, SCHEMA))
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    assert rows_of(trie.build(*trie.branched(turns, head, F.expr("conv_id - conv_id % 100")))) == by_hand(rebuilt)


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    rows = [
        (None, 0, "u", "nobody's"),
        (1, None, None, None),
        (1, None, "u", "first"),
        (1, 0, "u", "tie"),
        (1, 0, "u", "tie"),
        (1, 0, "a", "tie"),
        (2, 0, "", ""),
        (2, 7, "u", "first"),
        (3, 0, "", "x" * 200_000),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as depth", "2 as key", "3 as n", "4 as digest", "5 as row", "6 as one", "7 as at"
    )
    assert rows_of(trie.prefix_trie(frame)) == by_hand(sequences(rows))


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")]])
def test_no_conversation_no_root(spark, rows):
    assert trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_roles_and_texts_stay_apart(spark):
    rows = [(1, 0, "u", "ab"), (2, 0, "ua", "b"), (3, 0, "", "uab")]
    assert trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).filter("depth = 1").count() == 3
