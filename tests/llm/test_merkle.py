import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegate.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root of `nodes`, and per node the digests left and right of it on its way up."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        members = [under[i : i + 3] for i in range(0, len(nodes), 3)]
        for run, groups in zip(runs, members):
            for k, group in enumerate(groups):
                for i in group:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
        nodes, under = [digest(*run) for run in runs], [sum(groups, []) for groups in members]
    return nodes[0], paths


def by_hand(rows):
    """Per row: doc_id, leaf, presented, path, subroot, root, sorted."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: tree([x[2] for x in sorted(groups[name], key=lambda x: x[:3])]) for name in names}
    root, tops = tree([trees[name][0] for name in names])
    found = []
    for name, top in zip(names, tops):
        subroot, paths = trees[name]
        for (_, _, own, row), path in zip(sorted(groups[name], key=lambda x: x[:3]), paths):
            presented = leaf(row, row["text"] and row["text"].replace("\n", ""))
            found.append((row["doc_id"], own, presented, path + top, subroot, root))
    return sorted(found, key=repr)


def proofs(frame):
    values = [F.col(name) for name in COLUMNS[:-1]]
    tampered = F.replace("text", F.lit("\n"), F.lit(""))
    return merkle.proofs(
        frame.select(
            "source",
            "doc_id",
            merkle.leaf_digest(*values, F.col("text")).alias("leaf"),
            merkle.leaf_digest(*values, tampered).alias("presented"),
        )
    )


def check(frame):
    rows = proofs(frame).withColumns(
        {"folded": merkle.fold(F.col("path"), F.col("presented")), "proof": merkle.proof_digest(F.col("path"))}
    ).collect()
    found = [
        (r["doc_id"], r["leaf"], r["presented"], [tuple(step) for step in r["path"]], r["subroot"], r["root"]) for r in rows
    ]
    assert sorted(found, key=repr) == by_hand(frame.collect())
    for row in rows:
        node = row["presented"]
        for left, right in row["path"]:
            node = digest(left, node, right)
        assert row["folded"] == node
        assert (node == row["root"]) == (row["presented"] == row["leaf"])
        assert row["proof"] == digest(*(left + right for left, right in row["path"]))


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def made(spark, sizes):
    rows = [(i, source, "en", i, f"text\n{i}" if i % 2 else f"é{i}") for source, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_any_size(spark, monkeypatch, levels):
    """Blocks of one, two and six levels, so that trees of one to four tiers stand above the leaves."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    check(made(spark, {"a": 1, "b": 3, "c": 4, "d": 28, None: 10}))


def test_one_row_is_the_root(spark):
    (row,) = proofs(made(spark, {"a": 1})).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == []


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (None, None, None, None, None),
        (None, "a", None, 1, ""),
        (5, "a", "en", 1, "x\ny"),
        (5, "a", "en", 1, "x\ny"),
        (5, "a", "de", 1, "z" * 300_000),
        (4, "", "en", 1, "1:a-"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    extra = frame.selectExpr("*", "1 as digest", "2 as grp", "3 as block", "4 as n", "5 as place", "6 as path")
    check(extra)


def test_values_laid_end_to_end_stay_apart(spark):
    rows = [(1, "a", "b", 1, "c"), (1, "a", "", 1, "bc"), (1, "a", None, 1, "bc"), (1, "a", "-", 1, "bc")]
    assert proofs(spark.createDataFrame(rows, SCHEMA)).select("leaf").distinct().count() == 4


def test_empty_table(spark):
    assert proofs(spark.createDataFrame([], SCHEMA)).collect() == []
