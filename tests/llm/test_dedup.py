import hashlib

from pyspark.sql import functions as F

from tidegate.llm.dedup import drop_copies, find_copies

TEXTS = ["a", "b", "a", None, "", "a ", "b", "long " * 5000, "long " * 5000]


def expected(texts):
    groups = {}
    for i, text in enumerate(texts):
        groups.setdefault(text or "", []).append(i)
    return {
        i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in enumerate(texts)
    }


def found(frame, **options):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in find_copies(frame, **options).collect()}


def test_groups(docs):
    assert found(docs(TEXTS)) == expected(TEXTS)


def test_texts_that_share_a_digest_stay_apart(docs):
    by_length = lambda content: F.length(content).cast("string").cast("binary")
    assert found(docs(TEXTS), digest=by_length) == expected(TEXTS)


def test_a_hot_text(docs):
    texts = ["hot"] * 500 + [f"t{i}" for i in range(100)]
    assert found(docs(texts)) == expected(texts)


def test_empty_table_and_null_ids(docs):
    assert find_copies(docs([])).collect() == []
    rows = find_copies(docs(["a", "a"]).withColumn("doc_id", F.lit(None).cast("bigint"))).collect()
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in rows] == [(None, 2, True)] * 2


def test_one_row_of_each_text_stays_whole(docs):
    frame = docs(TEXTS).withColumn("digest", F.col("doc_id") * 2).withColumn("row", F.create_map(F.lit("k"), "doc_id"))
    frame = frame.unionByName(frame.filter("doc_id = 8"))
    kept = drop_copies(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted({v[0] for v in expected(TEXTS).values()})
    for row in rows:
        assert row["text"] == TEXTS[row["doc_id"]] and row["digest"] == 2 * row["doc_id"] and row["row"] == {"k": row["doc_id"]}
    assert drop_copies(docs([])).collect() == []
    assert drop_copies(docs([None, None])).collect()[0]["text"] is None
