import random
import re

import pytest
from pyspark.sql import functions as F

from tidegate.llm import near
from tidegate.llm.near import components, find_near_copies, keep_one_each

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def brute(texts):
    """Class and number of links of each text, over all pairs."""
    sets = [shingles(t) for t in texts]
    links, root = [0] * len(texts), list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                links[i], links[j] = links[i] + 1, links[j] + 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(find(i), links[i]) for i in range(len(texts))]


def corpus(seed=3, singles=60, groups=12, size=6, length=80):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts = [" ".join(rng.choice(vocabulary) for _ in range(length)) for _ in range(singles)]
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(length)) for _ in range(singles)]
    for _ in range(groups):
        words = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(size):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += ["", None, "a b", "A, b", "a b c", "one two three four five", texts[0], texts[0].upper()]
    rng.shuffle(texts)
    return texts


def found(frame):
    return [(r["class_id"], r["n_links"]) for r in find_near_copies(frame).orderBy("doc_id").collect()]


def test_against_all_pairs(docs):
    texts = corpus()
    assert found(docs(texts)) == brute(texts)


@pytest.mark.parametrize("small, block", [(4, 1024), (128, 8), (4, 8)])
def test_splits_and_blocks_lose_nothing(docs, monkeypatch, small, block):
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "BLOCK_NODES", block)
    texts = corpus(seed=5, singles=40, groups=3, size=25)
    assert found(docs(texts)) == brute(texts)


def test_variants_of_a_template_meet_in_its_large_buckets(docs):
    rng = random.Random(11)
    template = [f"t{i}" for i in range(84)]
    own = [[f"x{rng.randrange(10**9)}" for _ in range(20)] for _ in range(400)]
    texts = [" ".join(template), *(" ".join(template + words) for words in own)]
    assert found(docs(texts)) == [(0, 400)] + [(0, 1)] * 400


def test_short_texts_and_their_longer_copies(docs):
    rng = random.Random(13)
    texts = []
    for _ in range(100):
        for length in (8, 13, 18, 23, 30):
            words = [f"s{rng.randrange(10**9)}" for _ in range(length)]
            more = [f"s{rng.randrange(10**9)}" for _ in range((length - 4) // 4)]
            texts += [" ".join(words), " ".join(words + more)]
    assert found(docs(texts)) == brute(texts)


def test_long_chains_become_one_class(spark):
    edges = [(bytes([i // 250, i % 250]), bytes([(i + 1) // 250, (i + 1) % 250])) for i in range(700)]
    rows = components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    assert len(rows) == 700 and {bytes(r["root"]) for r in rows} == {bytes([0, 0])}


def test_empty_table_repeated_rows_and_null_ids(docs):
    assert find_near_copies(docs([])).collect() == []
    text = "one two three four five six seven"
    twice = docs([text, "other words here"]).unionByName(docs([text, "other words here"]))
    assert {r["n_links"] for r in find_near_copies(twice).collect()} == {1}
    nameless = docs([text, text, ""]).withColumn("doc_id", F.lit(None).cast("bigint"))
    assert sorted(r["n_links"] for r in find_near_copies(nameless).collect()) == [0, 1, 1]


def test_one_of_each_class_stays_with_its_columns(docs):
    texts = corpus(seed=9, singles=10, groups=4)
    frame = docs(texts).withColumn("node", F.lit("x")).withColumn("digest", F.col("doc_id"))
    kept = keep_one_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in brute(texts)})
