import random

import duckdb
import pandas as pd
import pytest

from tidegate.llm import chat, queries
from tidegate.llm.chat import format_chats

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CHAT = [
    (1, 0, "user", "How do I read a file?\nIt is a big one."),
    (1, 1, "assistant", "Use a reader."),
    (1, 2, "user", "> it is   a BIG one\nHow big is big?"),
    (1, 3, "assistant", "On Monday, X wrote:\n> How big is big?\n>> It is a big one.\nVery."),
    (1, 4, "user", ">Use a reader.\n\nWhich reader?"),
    (1, 5, "user", "> never said"),
    (1, 6, "user", "> How do\n> I read a file? It\n> is a big one.\nThat is what I asked."),
    (1, 7, "user", ">> Use a reader.\nAn answer to a quote within a lost quote."),
]


def rows(spark, data):
    found = format_chats(spark.createDataFrame(data, SCHEMA)).collect()
    return {(r["conv_id"], r["turn"]): r for r in found}, found


def test_quotes_link_to_their_messages(spark):
    by, _ = rows(spark, CHAT)
    assert [by[1, t]["reply_to"] for t in range(8)] == [None, 0, 0, 2, 1, 4, 0, 1]
    assert [by[1, t]["n_quoted"] for t in range(8)] == [0, 0, 1, 2, 1, 1, 1, 1]
    assert [by[1, t]["n_linked"] for t in range(8)] == [0, 0, 1, 2, 1, 0, 1, 1]
    assert [by[1, t]["content"] for t in range(2, 6)] == ["How big is big?", "Very.", "\nWhich reader?", ""]
    assert [by[1, t]["branch"] for t in range(8)] == [0, 0, 2, 2, 0, 0, 6, 7]
    assert [by[1, t]["position"] for t in range(8)] == [1, 2, 5, 6, 3, 4, 7, 8]
    assert by[1, 1]["formatted"] == "<|assistant|>\nUse a reader.\n<|end|>"


def test_links_stay_within_a_conversation_and_go_back(spark):
    by, _ = rows(spark, [(1, 0, "u", "same words"), (2, 0, "u", "> same words"), (1, 1, "u", "> later"), (1, 2, "u", "later")])
    assert by[2, 0]["n_linked"] == 0 and by[2, 0]["reply_to"] is None
    assert by[1, 1]["n_linked"] == 0 and by[1, 1]["reply_to"] == 0


def invented_chats(seed, chats=12, turns=25):
    """Messages that quote earlier ones: nested, wrapped anew, in part, interleaved, across conversations."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    data, said = [], {}
    for conv in range(chats):
        for turn in range(turns):
            parts = []
            for _ in range(rng.randint(0, 2)):
                if not said:
                    break
                pool = [k for k in said if k[0] == conv] if rng.random() < 0.9 else list(said)
                source = said[rng.choice(pool or list(said))].split()
                start = rng.randint(0, max(0, len(source) - 6))
                words = source[start : start + rng.randint(1, 20)]
                marks = rng.choice(["> ", ">> ", "> > ", ">", ">>>"])
                step = rng.randint(2, 7)
                if rng.random() < 0.3:
                    parts.append(rng.choice(["On Monday, X wrote:", "> X schrieb:"]))
                parts += [marks + rng.choice([" ", "  "]).join(words[i : i + step]).upper() for i in range(0, len(words), step)]
            own = rng.choices(vocabulary, k=rng.randint(0, 15))
            parts += [" ".join(own[:4]), ", ".join(own[4:])]
            said[conv, turn] = " ".join(own)
            data.append((conv, turn * 2, rng.choice(["user", "assistant", None]), "\n".join(parts) if rng.random() < 0.97 else None))
    return data + rng.sample(data, 5) + [(0, 2, "again", "> w1 w2"), (5, 400, "user", "")]


def comparable(found):
    return sorted((tuple(row) for row in found), key=repr)


@pytest.mark.parametrize("block", [256, 4])
def test_rows_are_those_of_the_sql(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    data = invented_chats(7)
    con = duckdb.connect()
    con.register("frame", pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"]))
    con.execute("CREATE VIEW conversations AS SELECT * FROM frame")
    relation = con.execute(queries.ORACLES["op5_chat"])
    names = [d[0] for d in relation.description]
    found = format_chats(spark.createDataFrame(data, SCHEMA))
    got = found.select(*names).collect()
    assert comparable(got) == comparable(relation.fetchall())
    assert len({r["branch"] for r in got}) > 5 and sum(r["n_linked"] for r in got) > 50
    parents = {(r["conv_id"], r["turn"]): r["position"] for r in got}
    assert all(r["reply_to"] is None or parents[r["conv_id"], r["reply_to"]] < r["position"] for r in got)


def test_long_chains_of_branches(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 4)
    said = [f"alpha{t} beta{t} gamma{t}" for t in range(60)]
    data = [(1, t, "u", f"> {said[t - 2]}\n{said[t]}" if t > 1 else said[t]) for t in range(60)]
    by, _ = rows(spark, data)
    assert [by[1, t]["reply_to"] for t in range(2, 60)] == list(range(58))
    # turn 1 is the first reply to turn 0, so turn 2 opens the branch of the even turns
    assert [by[1, t]["branch"] for t in range(60)] == [0, 0] + [2 if t % 2 == 0 else 0 for t in range(2, 60)]
    assert sorted(r["position"] for r in by.values()) == list(range(1, 61))


def test_odd_rows(spark):
    data = [(None, None, None, None), (None, 1, "u", ""), (3, 0, "u", "x"), (3, 0, "u", "x"), (3, 0, "a", "> x"), (3, None, "s", "sys")]
    _, found = rows(spark, data)
    assert len(found) == len(data)
    assert sorted(r["position"] for r in found if r["conv_id"] == 3) == [1, 2, 3, 4]
    assert [r["reply_to"] for r in found if r["conv_id"] is None] == [None, None]
    assert rows(spark, [])[1] == []


def test_clashing_columns_and_long_texts(spark):
    names = ("conv", "no", "block", "branch", "position", "said", "passages", "reply", "previous", "hash")
    long = "\n".join(f"> alpha{i} beta" for i in range(50_000))
    data = CHAT + [(9, 0, "u", long.replace("> ", "")), (9, 1, "u", "between"), (9, 2, "u", long)]
    frame = spark.createDataFrame(data, SCHEMA).selectExpr("*", *[f"'x' AS {name}" for name in names])
    by = {(r["conv_id"], r["turn"]): r for r in format_chats(frame).collect()}
    assert len(by) == len(data) and by[9, 2]["reply_to"] == 0 and by[9, 2]["content"] == ""
