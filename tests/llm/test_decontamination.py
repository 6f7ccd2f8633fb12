import re

from pyspark.sql import functions as F

from tidegate.llm.decontamination import drop_contaminated, find_benchmark_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven."),
    (2, "alpha BETA gamma"),
    (3, "solo"),
    (4, ""),
    (5, None),
    (6, "two three four five six seven eight nine ten eleven"),
    (7, "a a a a a a a a a a a a"),
    (8, "pair of"),
]
TEXTS = [
    "x one two three four five six seven eight nine ten eleven y",
    "ONE, two; three four five six seven eight nine ten",
    "one two three four five six seven eight nine",
    "alpha beta gamma alpha-beta.gamma", "alpha beta", "so lo", "Solo solo é", "", None,
    "a " * 15, "a " * 9, "pair of pair of", "clean text with nothing", "pair\nof wörds",
]


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items=ITEMS):
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        v = words(item_text)
        n = min(10, len(v))
        for i in range(len(v) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_against_brute_force(spark, docs):
    rows = find_benchmark_words(docs(TEXTS), benchmark(spark)).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert (row["n_words"], row["n_hit"], row["items"]) == brute(TEXTS[row["doc_id"]])


def test_repeated_rows_null_ids_and_empty_tables(spark, docs):
    twice = docs(TEXTS[:4]).unionByName(docs(TEXTS[:4])).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    rows = find_benchmark_words(twice, benchmark(spark)).collect()
    assert len(rows) == 8 and sorted(r["n_hit"] for r in rows) == sorted(2 * [brute(t)[1] for t in TEXTS[:4]])
    assert find_benchmark_words(docs([]), benchmark(spark)).collect() == []
    assert {r["n_hit"] for r in find_benchmark_words(docs(TEXTS), benchmark(spark, [])).collect()} == {0}


def test_contaminated_documents_go_and_columns_stay(spark, docs):
    frame = docs(TEXTS).withColumn("digest", F.lit(1)).withColumn("n_words", F.lit("x"))
    kept = drop_contaminated(frame, benchmark(spark))
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, t in enumerate(TEXTS) if not brute(t)[1]]
