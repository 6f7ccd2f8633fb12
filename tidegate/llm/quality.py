"""Quality by the perplexity of a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney model over characters: grams of up
to ORDER characters, three discounts for each length from its counts of counts,
continuation counts below the longest. It is a table: each gram with its probability
and, as a context, the weight it gives to shorter grams.

No text is scored by a model that was counted on it: documents fall into FOLDS folds by a
hash of their id, and those of a fold are scored by the model of the trusted documents of
the other folds. So trusted and other documents are scored alike, and thresholds from
trusted ones hold for documents the model has not seen. If the trusted documents of some
other folds hold no text, all folds are scored by the model of all of them.

Counting and scoring join on grams. Trusted documents are joined on doc_id, after a
Bloom filter of a fixed size has spared most others the shuffle. For scoring, texts
of a fold are dealt into blocks of about BLOCK_CHARS characters; a block asks for each gram it
holds once, the requests are joined to the model's shards by gram, and the answers
come back to the block, which sums them up for each text. So what is joined grows
with the blocks, not with the occurrences, and no task holds the whole model.

A document's score is its perplexity, smoothed by PRIOR symbols at the usual rate of
its language's trusted text, since a few words say little. It is kept if the score is
at most its language's threshold: the QUANTILE of all trusted documents of that
language. Fewer than 1 / (1 - QUANTILE) of them are too few to know it; there the threshold
is at least the quantile over all languages of the score against the usual rate of its
language, times the usual rate of this one, or of all for one without trusted documents.

Characters beyond 16 bits share one symbol. Defined results: null and empty texts have
no perplexity and are not kept; without any trusted text nothing is scored and every
other text is kept; a document is trusted if one of its labels says 1; rows that
repeat get a row each; a null lang is a language of its own.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.filters import filter_words, passes
from tidegate.llm.grams import padded
from tidegate.llm.tasks import map_texts, ship_package
from tidegate.llm.text import RUN_BYTES, as_text, byte_arrays, point_arrays, runs, signed, unsigned
from tidegate.session import settle

ORDER = 4
FOLDS = 2
SYMBOL_BITS = 16
START, END, OTHER = 1, 2, 0xFFFF
BLOCK_CHARS = 16 << 20
QUANTILE = 0.99
LEAST_DISCOUNT = 0.1
PRIOR = 32  # symbols of the language's usual kind that a text is taken to have besides its own

PACKED = "doc_id bigint, lang string, packed binary"
GRAMS = "fold int, gram bigint, n bigint"
KEY = ["model", "gram"]


def longest_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A gram for each character and for the end of each text, and where each text's begin and the last end."""
    points, offsets = point_arrays(*byte_arrays(texts))
    points = np.where(points < 3, 3, np.minimum(points, OTHER)).astype(np.uint32)
    symbols, _, begins = padded(points, offsets, ORDER - 1, START)
    symbols = symbols.astype(np.uint64)
    symbols[begins[1:] - 1] = END
    grams = symbols[: len(symbols) - ORDER + 1].copy()
    for i in range(1, ORDER):
        grams = grams << np.uint64(SYMBOL_BITS) | symbols[i : len(symbols) - ORDER + 1 + i]
    own = np.ones(len(symbols), bool)
    for i in range(ORDER - 1):  # a gram begins where it ends in its own text
        own[begins[1:] - 1 - i] = False
    bounds = offsets + np.arange(len(offsets))
    return grams[own[: len(grams)]], bounds


def pack(documents: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """doc_id, lang and the compressed text; with `wanted`, only ids that may be in that filter."""

    def run(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        if wanted is not None:
            at = pa.array(np.flatnonzero(passes(wanted, unsigned(rows.column("hash").to_numpy()))))
            rows, texts = rows.take(at), texts.take(at)
        packed = [zlib.compress(text.encode(), 1) for text in texts.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("lang"), pa.array(packed, pa.binary())], ["doc_id", "lang", "packed"]
        )

    return map_texts(documents, run, PACKED)


def unpack(column: pa.Array) -> pa.Array:
    return as_text(pa.array([zlib.decompress(value).decode() for value in column.to_pylist()], pa.large_string()))


def packed_runs(column: pa.Array, step: int = 256) -> Iterator[tuple[int, int, pa.Array]]:
    """Row ranges and their texts, a few unpacked at a time."""
    for start in range(0, len(column), step):
        texts = unpack(column.slice(start, step))
        for a, b in runs(texts, RUN_BYTES // 2):
            yield start + a, start + b, texts.slice(a, b - a)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FOLDS)).cast("int")


def count_grams(trusted: DataFrame, cross: bool = True) -> DataFrame:
    """How often the texts have each longest gram: model, gram, n. Model i leaves out fold i, unless `cross` is false."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in packed_runs(batch.column("packed")):
                folds = batch.column("fold").slice(a, b - a).to_numpy()
                for own in np.unique(folds).tolist():
                    grams, n = np.unique(longest_grams(texts.filter(pa.array(folds == own)))[0], return_counts=True)
                    columns = [pa.array(np.full(len(grams), own, np.int32)), pa.array(signed(grams)), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["fold", "gram", "n"])

    ship_package(trusted.sparkSession)
    counted = trusted.select(fold(F.col("doc_id")).alias("fold"), "packed").mapInArrow(count, GRAMS)
    models = F.explode(F.array(*map(F.lit, range(FOLDS)))).alias("model")
    rows = counted.select(models, "fold", "gram", "n")
    if cross:
        rows = rows.filter("model != fold")
    return rows.groupBy(*KEY).agg(F.sum("n").alias("n"))


def tail(gram: Column, size: int) -> Column:
    """The last `size` symbols."""
    return gram.bitwiseAND(F.lit((1 << SYMBOL_BITS * size) - 1).cast("bigint"))


def head(gram: Column) -> Column:
    """All symbols but the last."""
    return F.shiftrightunsigned(gram, SYMBOL_BITS)


def of_model(values: list[float]) -> Column:
    """The value of the row's model."""
    return F.get(F.array(*map(F.lit, values)), F.col("model"))


def discounts(counts: DataFrame) -> list[tuple[float, float, float]]:
    """The three discounts of one gram length of each model, from its counts of counts; some mass is always left for shorter grams."""
    found = counts.groupBy("model").agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in range(1, 5)])
    result = []
    for row in sorted(found.collect()):  # a row per model
        n1, n2, n3, n4 = (max(row[f"n{i}"], 1) for i in range(1, 5))
        y = n1 / (n1 + 2 * n2)
        sizes = enumerate([(n1, n2), (n2, n3), (n3, n4)], 1)
        result.append(tuple(min(max(i - (i + 1) * y * b / a, LEAST_DISCOUNT), float(i)) for i, (a, b) in sizes))
    return result


def build_model(counts: DataFrame) -> tuple[DataFrame, list[float]]:
    """model, gram, log_p, log_weight, and per model the log probability of a symbol never seen."""
    levels = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):
        shorter = levels[size + 1].select("model", tail(F.col("gram"), size).alias("gram"))
        seen = shorter.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        levels[size] = settle(seen, "continuations", compact=True)
    model, lower, unseen = None, None, []
    for size in range(1, ORDER + 1):
        d1, d2, d3 = map(list, zip(*discounts(levels[size])))
        n = F.col("n")
        cut = F.when(n == 1, of_model(d1)).when(n == 2, of_model(d2)).otherwise(of_model(d3))
        totals = (F.sum("n").alias("total"), F.sum(cut).alias("cut"))
        grams = levels[size].withColumn("context", head(F.col("gram")))
        if size == 1:
            rows = sorted(levels[1].groupBy("model").agg(*totals, F.count(F.lit(1)).alias("symbols")).collect())
            shares = [row["cut"] / row["total"] / (row["symbols"] + 1) for row in rows]
            unseen = [float(np.log(share)) for share in shares]
            total = of_model([float(row["total"]) for row in rows])
            level = grams.select(*KEY, ((n - cut) / total + of_model(shares)).alias("p"))
        else:
            contexts = settle(grams.groupBy("model", "context").agg(*totals), "contexts", compact=True)
            level = (
                grams.join(contexts, ["model", "context"])
                .withColumn("shorter", tail(F.col("gram"), size - 1))
                .join(lower.select("model", F.col("gram").alias("shorter"), F.col("p").alias("lower")), ["model", "shorter"])
                .select(*KEY, ((n - cut) / F.col("total") + F.col("cut") / F.col("total") * F.col("lower")).alias("p"))
            )
            weight = F.log(F.col("cut") / F.col("total")).alias("log_weight")
            weights = contexts.select("model", F.col("context").alias("gram"), weight)
            shorter = lower.select(*KEY, F.log("p").alias("log_p")).join(weights, KEY, "full")
            model = shorter if model is None else model.unionByName(shorter)
        lower = settle(level, "probabilities", compact=True)
    last = lower.select(*KEY, F.log("p").alias("log_p"), F.lit(None).cast("double").alias("log_weight"))
    return settle(model.unionByName(last), "model", compact=True), unseen


def all_grams(longest: np.ndarray) -> np.ndarray:
    """The distinct grams of every length that a score of these may look at, contexts included."""
    out = [longest, np.unique(longest >> np.uint64(SYMBOL_BITS))]
    for size in range(ORDER - 1, 0, -1):
        shorter = np.unique(longest & np.uint64((1 << SYMBOL_BITS * size) - 1))
        out += [shorter, np.unique(shorter >> np.uint64(SYMBOL_BITS))]
    return np.unique(np.concatenate(out))


def log_probabilities(grams: np.ndarray, known: np.ndarray, log_p: np.ndarray, log_weight: np.ndarray, unseen: float) -> np.ndarray:
    """Of the last symbol of each longest gram after the others; `known` is sorted."""

    def look_up(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, values[at], np.nan)

    total, result = np.zeros(len(grams)), np.full(len(grams), np.nan)
    for size in range(ORDER, 0, -1):
        keys = grams & np.uint64((1 << SYMBOL_BITS * size) - 1) if size < ORDER else grams
        found = look_up(keys, log_p)
        fresh = np.isnan(result) & ~np.isnan(found)
        result[fresh] = total[fresh] + found[fresh]
        if size > 1:
            total += np.nan_to_num(look_up(keys >> np.uint64(SYMBOL_BITS), log_weight))
    return np.where(np.isnan(result), total + unseen, result)


def score(documents: DataFrame, model: DataFrame, unseen: list[float]) -> DataFrame:
    """doc_id, lang, n_symbols, log_p of each document, by the model of its fold."""
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-chars // (BLOCK_CHARS * FOLDS)))  # blocks of a fold
    place = F.pmod(F.xxhash64(F.crc32("packed"), "doc_id"), F.lit(count)).cast("int")
    block = place * FOLDS + fold(F.col("doc_id"))
    packed = pack(documents.select("doc_id", "lang", "text")).withColumn("block", block)
    dealt = packed.repartition(count * FOLDS, "block")

    def ask(table: pa.Table) -> pa.Table:
        found = [np.empty(0, np.uint64)]
        for _, _, texts in packed_runs(table.column("packed").combine_chunks()):
            found.append(np.unique(longest_grams(texts)[0]))
        grams = all_grams(np.unique(np.concatenate(found)))
        return pa.table({"block": pa.array(np.full(len(grams), table.column("block")[0].as_py()), pa.int32()), "gram": signed(grams)})

    requests = dealt.groupBy("block").applyInArrow(ask, "block int, gram bigint")
    requests = requests.withColumn("model", F.col("block") % FOLDS)
    answers = requests.join(model, KEY).select("block", "gram", "log_p", "log_weight")

    def add_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        own_unseen = unseen[table.column("block")[0].as_py() % FOLDS] if table.num_rows else 0.0
        known = unsigned(answers.column("gram").to_numpy())
        order = np.argsort(known)
        log_p, log_weight = (answers.column(c).to_numpy().astype(float)[order] for c in ("log_p", "log_weight"))
        known = known[order] if len(order) else np.zeros(1, np.uint64)
        if not len(order):
            log_p = log_weight = np.full(1, np.nan)
        sums, sizes = np.zeros(table.num_rows), np.zeros(table.num_rows, np.int64)
        for a, b, texts in packed_runs(table.column("packed").combine_chunks()):
            grams, bounds = longest_grams(texts)
            distinct, number = np.unique(grams, return_inverse=True)
            logs = log_probabilities(distinct, known, log_p, log_weight, own_unseen)[number]
            before = np.concatenate(([0.0], np.cumsum(logs)))
            sums[a:b], sizes[a:b] = np.diff(before[bounds]), np.diff(bounds)
        return pa.table({"doc_id": table.column("doc_id"), "lang": table.column("lang"), "n_symbols": sizes, "log_p": sums})

    pairs = dealt.groupBy("block").cogroup(answers.groupBy("block"))
    return pairs.applyInArrow(add_up, "doc_id bigint, lang string, n_symbols bigint, log_p double")


def classify(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Per document: doc_id, lang, perplexity, score (smoothed), threshold, keep."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    trusted = settle(labels.filter("quality = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).dropna().distinct(), "trusted")
    wanted = filter_words(trusted.select(F.xxhash64("doc_id").alias("hash")), "hash")
    likely = pack(rows.filter("text != ''").withColumn("hash", F.xxhash64("doc_id")), wanted)
    likely = likely.join(trusted, "doc_id", "left_semi")
    counts = settle(count_grams(likely), "grams", compact=True)
    if counts.select("model").distinct().count() < FOLDS:
        counts = settle(count_grams(likely, cross=False), "grams", compact=True)
    if counts.isEmpty():
        none = F.lit(None).cast("double")
        keep = F.coalesce(F.length("text") > 0, F.lit(False)).alias("keep")
        return rows.select("doc_id", "lang", none.alias("perplexity"), none.alias("score"), none.alias("threshold"), keep)
    scores = settle(score(rows, *build_model(counts)), "scores", compact=True)
    sums = (F.sum("log_p") / F.sum("n_symbols")).alias("usual")
    known = scores.join(trusted, "doc_id", "left_semi").filter("n_symbols > 1")
    usual = known.groupBy(F.col("lang").alias("language")).agg(sums)
    overall = known.agg(sums).first()["usual"]
    smoothed = F.exp(-(F.col("log_p") + PRIOR * F.coalesce("usual", F.lit(overall))) / (F.col("n_symbols") + PRIOR))
    scores = scores.join(usual, F.col("lang").eqNullSafe(F.col("language")), "left").select(
        "doc_id", "lang",
        F.when(F.col("n_symbols") > 1, F.exp(-F.col("log_p") / F.col("n_symbols"))).alias("perplexity"),
        F.when(F.col("n_symbols") > 1, smoothed).alias("score"),
        F.exp(-F.coalesce("usual", F.lit(overall))).alias("rate"),
    )
    scores = settle(scores, "perplexities", compact=True)
    known = scores.join(trusted, "doc_id", "left_semi").filter("score is not null")
    limit = F.percentile_approx("score", quantile, 10_000)
    limits = known.groupBy(F.col("lang").alias("language")).agg(limit.alias("own"), F.count(F.lit(1)).alias("n"))
    pooled = known.agg(F.percentile_approx(F.col("score") / F.col("rate"), quantile, 10_000).alias("ratio")).first()["ratio"]
    enough = F.col("n") * (1 - quantile) >= 1
    threshold = F.when(enough, F.col("own")).otherwise(F.greatest("own", F.lit(pooled) * F.col("rate")))
    return scores.join(limits, F.col("lang").eqNullSafe(F.col("language")), "left").select(
        "doc_id", "lang", "perplexity", "score", threshold.alias("threshold"),
        F.coalesce(F.col("score") <= threshold, F.lit(False)).alias("keep"),
    )
