"""The operators that learn: against brute force on small text, and by held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import language, quality, toxicity

SF_DIR = "/root/testdata/sf0.01"


def invented(seed, syllables, count, words=40):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words)) for _ in range(count)]


LABELS = "doc_id bigint, quality int, toxic int"


# --- quality ---------------------------------------------------------------------------------------------------------


def kneser_ney(texts):
    """log p of the last symbol of a gram of four, written from the formulas with dictionaries."""
    pad = lambda t: "\1\1\1" + t + "\2"
    counts = {4: Counter(pad(t)[i : i + 4] for t in texts for i in range(len(t) + 1))}
    for n in (3, 2, 1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])
    cuts, totals, weights = {}, defaultdict(int), defaultdict(float)
    for n, table in counts.items():
        cc = [max(1, sum(c == k for c in table.values())) for k in (1, 2, 3, 4)]
        y = cc[0] / (cc[0] + 2 * cc[1])
        d = [min(max(k - (k + 1) * y * cc[k] / cc[k - 1], 0.1), k) for k in (1, 2, 3)]
        cuts[n] = lambda c, d=d: d[min(c, 3) - 1]
        for gram, c in table.items():
            totals[n, gram[:-1]] += c
            weights[n, gram[:-1]] += cuts[n](c)

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (len(counts[1]) + 1)
        lower = p(gram[1:])
        total = totals.get((n, gram[:-1]))
        if not total:
            return lower
        c = counts[n].get(gram, 0)
        return (c - (cuts[n](c) if c else 0)) / total + weights[n, gram[:-1]] / total * lower

    return lambda t: sum(math.log(p(pad(t)[i : i + 4])) for i in range(len(t) + 1))


def folds(spark, count):
    return [r[0] for r in spark.range(count).select(quality.fold(F.col("id"))).collect()]


def test_perplexity_score_and_threshold_are_those_of_the_formulas(spark, docs):
    texts = invented(1, ["ba", "no", "tri", "q"], 12) + ["zzz 99", "", None, "é\U0001F600"]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8)] + [(3, 0, 0), (None, 1, 0)], LABELS)
    fold = folds(spark, len(texts))
    assert len(set(fold[:8])) == quality.FOLDS
    models = [kneser_ney([t for i, t in enumerate(texts[:8]) if fold[i] != k]) for k in range(quality.FOLDS)]
    log_p = {i: models[fold[i]](text) for i, text in enumerate(texts[:13])}
    size = {i: len(texts[i]) + 1 for i in range(13)}
    usual = sum(log_p[i] for i in range(8)) / sum(size[i] for i in range(8))
    score = {i: math.exp(-(log_p[i] + quality.PRIOR * usual) / (size[i] + quality.PRIOR)) for i in range(13)}
    threshold = sorted(score[i] for i in range(8))[3]
    found = quality.classify(docs(texts), labels, quantile=0.5).collect()
    rows = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) == len(texts)
    for i in range(13):
        assert rows[i]["perplexity"] == pytest.approx(math.exp(-log_p[i] / size[i]), rel=1e-9)
        assert rows[i]["score"] == pytest.approx(score[i], rel=1e-9)
        assert rows[i]["threshold"] == pytest.approx(threshold, rel=1e-9)
        assert rows[i]["keep"] is (rows[i]["score"] <= rows[i]["threshold"])
    assert rows[12]["keep"] is False and rows[13]["keep"] is False and rows[13]["perplexity"] is None


def test_trusted_text_in_one_fold_is_the_model_of_all(spark, docs):
    texts = invented(3, ["ba", "no"], 6)
    fold = folds(spark, 6)
    trusted = [i for i in range(6) if fold[i] == fold[0]]
    log_p = kneser_ney([texts[i] for i in trusted])
    found = quality.classify(docs(texts), spark.createDataFrame([(i, 1, 0) for i in trusted], LABELS)).collect()
    for row in found:
        text = texts[row["doc_id"]]
        assert row["perplexity"] == pytest.approx(math.exp(-log_p(text) / (len(text) + 1)), rel=1e-9)


def test_repeated_rows_and_clashing_columns_do_not_change_quality(spark, docs):
    texts = invented(4, ["ba", "no", "tri"], 10)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8)], LABELS)
    frame = docs(texts)
    once = {r["doc_id"]: r["perplexity"] for r in quality.classify(frame, labels).collect()}
    names = ("model", "gram", "block", "score", "threshold", "fold", "packed", "hash", "language")
    clashing = frame.select("*", *[F.lit("x").alias(name) for name in names])
    assert {r["doc_id"]: r["perplexity"] for r in quality.classify(clashing, labels).collect()} == pytest.approx(once)
    doubled = quality.classify(frame.unionByName(frame.filter("doc_id >= 8")), labels.unionByName(labels)).collect()
    assert len(doubled) == 12 and {r["doc_id"]: r["perplexity"] for r in doubled} == pytest.approx(once)


def test_withheld_trusted_documents_are_kept_like_trusted_ones(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    withheld = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    good = read("labels").filter("quality = 1").withColumn("withheld", withheld)
    found = quality.classify(read("documents"), good.filter("not withheld").drop("withheld")).join(good, "doc_id")
    share = {r["withheld"]: r["kept"] for r in found.groupBy("withheld").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    print(share)
    assert abs(share[True] - quality.QUANTILE) < 0.02 and share[False] > 0.97


def test_blocks_do_not_change_the_scores(spark, docs, monkeypatch):
    texts = invented(2, ["ba", "no", "tri", "q"], 30)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 30, 2)], LABELS)
    whole = {r["doc_id"]: r["perplexity"] for r in quality.classify(docs(texts), labels).collect()}
    monkeypatch.setattr(quality, "BLOCK_CHARS", 400)
    cut = {r["doc_id"]: r["perplexity"] for r in quality.classify(docs(texts), labels).collect()}
    assert cut == pytest.approx(whole)


def test_quality_without_trusted_text_and_of_an_empty_table(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert {r["doc_id"]: r["keep"] for r in quality.classify(docs(["a", "", None]), none).collect()} == {0: True, 1: False, 2: False}
    assert quality.classify(docs([]), none).collect() == []


def test_junk_goes_and_clean_documents_stay(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    found = quality.classify(read("documents"), read("labels")).join(read("labels"), "doc_id")
    share = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.97 and share[0] < 0.2


# --- language --------------------------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id")
    row = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert row[0] > 0.98 and 0 <= row[1] <= row[2] <= 1


def test_folds_are_those_of_crc32(spark):
    rows = spark.range(50).select("id", language.fold(F.col("id"), 4).alias("fold")).collect()
    assert all(r["fold"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in rows)


def test_more_than_64_languages(docs):
    texts = ["".join(chr(0x4E00 + 40 * k + (i * 7 + j) % 40) for j in range(30)) for k in range(70) for i in range(4)]
    frame = docs(texts).withColumn("lang", F.format_string("l%02d", (F.col("doc_id") / 4).cast("int")))
    rows = language.predict(frame, language.learn(frame)).join(frame.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] for r in rows)


def test_filter_grows_with_the_largest_language(docs):
    points = np.random.default_rng(5).integers(0x4E00, 0x9FA0, (300, 4000))
    large = ["".join(map(chr, row)) for row in points]  # nearly 1.2 million trigrams
    frame = docs(large * 3, "zh").unionByName(docs(["the quick brown fox jumps over the lazy dog"] * 3, "en"))
    filters = language.learn(frame)
    assert filters.languages == ["en", "zh"] and 0.3 < filters.fill[1] < 0.5
    texts = docs(["the lazy fox jumps over the quick dog", large[7][:200], large[70][:200]])
    rows = language.predict(texts, filters).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in rows} == {0: "en", 1: "zh", 2: "zh"}


def test_language_of_odd_texts(docs):
    frame = docs(["the thing there", "the then them", "", None, "123 !!", "这", "the"] * 2)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(frame).collect()}
    assert [found[i] for i in (2, 3, 4)] == [("und", 0.0)] * 3 and found[5] == ("en", 0.0) and found[6][0] == "en"
    assert {r["lang_pred"] for r in language.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(docs([])).collect() == []


# --- toxicity --------------------------------------------------------------------------------------------------------


def planted(spark, docs, count=600):
    clean = invented(4, ["ba", "no", "tri", "q", "lem", "ost"], count)
    texts = [f"{t[: len(t) // 2]} {['Idiotba', 'scumno', 'zzroq'][i % 3]} {t[len(t) // 2 :]}" if i % 5 == 0 else t for i, t in enumerate(clean)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(count)], LABELS)
    return docs(texts), labels


def test_toxic_words_are_found_in_held_out_documents(spark, docs):
    documents, labels = planted(spark, docs)
    rows = toxicity.score_documents(documents, labels).collect()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert row["predicted"] == int(row["score"] >= 0.7)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_documents_are_not_read(spark, docs):
    documents, labels = planted(spark, docs, 200)
    held = language.fold(F.col("doc_id"), 3) == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity.score_documents(documents, l).collect()) for l in (labels, other)]
    assert scores[0] == scores[1]


def test_toxicity_without_labels_and_of_odd_texts(spark, docs):
    none = spark.createDataFrame([(None, 1, 1), (0, 1, None)], LABELS)
    rows = toxicity.score_documents(docs(["x", "", None]), none).collect()
    assert len(rows) == 3 and len({r["score"] for r in rows}) == 1 and {r["predicted"] for r in rows} == {0}
    assert toxicity.score_documents(docs([]), none).collect() == []


def test_clean_documents_stay_with_their_columns(spark, docs):
    documents, labels = planted(spark, docs, 300)
    frame = documents.withColumn("toxicity", F.lit("own")).withColumn("own 0", F.lit(1))
    kept = toxicity.drop_toxic(frame, labels)
    assert kept.columns == frame.columns and kept.first()["toxicity"] == "own"
    assert abs(kept.count() - 240) <= 12
