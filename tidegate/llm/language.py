"""Language identification by n-gram filters that hold language bit masks.

One Bloom filter serves all languages: each of its rows is a mask with a bit for
every language, so that one lookup of a trigram, an AND of its rows, gives all the
languages that contain it. A document's hits per language are counted, corrected
for the hits that the filter's fill alone would give, and the language with most
hits is predicted.

The filter's rows follow the language that contains most trigrams: a power of two, at
least ROWS and ROWS_PER_TRIGRAM for each, so that less than half of a language's bits
are set however much was learned from.

A language contains a trigram if its share of the language's trigrams is at least
SHARE of the largest share any language has; counts are over all rows learned from.

Defined results: `und` with score 0 where the text is null or has no letter, and
everywhere if nothing could be learned; a text without known trigrams gets the first
language in order, with score 0; ties go to the first language; rows that repeat get
a row each; rows without lang are predicted, not learned from.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.grams import has_letter, word_trigrams
from tidegate.llm.tasks import map_texts
from tidegate.llm.text import mix, signed, unsigned
from tidegate.session import settle

ROWS = 1 << 20  # of the filter at least, eight bytes each for every 64 languages
PROBES = 3
ROWS_PER_TRIGRAM = PROBES / math.log(2)  # half of the bits set
SHARE = 0.25
LEAST_COUNT = 3
UNKNOWN = "und"


@dataclass
class Filters:
    """Masks by row, 64 languages to a word, and how much of each language's bits is set."""

    languages: list[str]
    masks: np.ndarray
    fill: np.ndarray

    def masks_of(self, keys: np.ndarray) -> np.ndarray:
        found = self.masks[rows_of(keys, 0, len(self.masks))]
        for probe in range(1, PROBES):
            found = found & self.masks[rows_of(keys, probe, len(self.masks))]
        return found


def rows_of(keys: np.ndarray, probe: int, size: int) -> np.ndarray:
    return (mix(keys, 51 + probe) % np.uint64(size)).astype(np.int64)


def filter_rows(most: int) -> int:
    """The rows of a filter in which no language has more than `most` trigrams."""
    return ROWS << max(0, math.ceil(math.log2(max(1.0, most * ROWS_PER_TRIGRAM) / ROWS)))


def count_trigrams(documents: DataFrame) -> DataFrame:
    """How often the documents of each language have each trigram: lang, key, n."""

    def count(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        keys, owner = word_trigrams(texts)
        codes = rows.column("lang").dictionary_encode()
        code = codes.indices.to_numpy()[owner]
        for i, lang in enumerate(codes.dictionary.to_pylist()):
            found, counts = np.unique(keys[code == i], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(signed(found)), pa.array(counts, pa.int64())],
                ["lang", "key", "n"],
            )

    counts = map_texts(documents.select("lang", "text"), count, "lang string, key bigint, n bigint")
    return counts.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def learn(documents: DataFrame) -> Filters:
    """Filters from all given documents that have a language."""
    counts = settle(count_trigrams(documents.filter("lang is not null")), "trigrams", compact=True)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(row["lang"] for row in totals.select("lang").collect())
    numbers = documents.sparkSession.createDataFrame([(l, i) for i, l in enumerate(languages)], "lang string, number int")
    shares = counts.filter(F.col("n") >= LEAST_COUNT).join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    largest = shares.groupBy("key").agg(F.max("share").alias("largest"))
    held = shares.join(largest, "key").filter(F.col("share") >= SHARE * F.col("largest")).join(numbers, "lang")
    held = settle(held.select("key", "number"), "held", compact=True)
    most = held.groupBy("number").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    size = filter_rows(most)
    width = max(1, -(-len(languages) // 64))
    masks, fill = np.zeros((size, width), np.uint64), np.zeros(len(languages))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, number = unsigned(batch.column("key").to_numpy()), batch.column("number").to_numpy()
            at = np.concatenate([rows_of(keys, probe, size) for probe in range(PROBES)])
            bits = np.tile(np.uint64(1) << (number % 64).astype(np.uint64), PROBES)
            words = np.tile(number // 64, PROBES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(words, pa.int32()), pa.array(signed(bits))], ["at", "word", "bits"]
            )

    filled = (
        held.mapInArrow(rows, "at bigint, word int, bits bigint")
        .groupBy("at", "word").agg(F.bit_or("bits").alias("bits"))
    )
    if size > ROWS:
        filled = settle(filled, "filled", compact=True)
    for start in range(0, size, ROWS):  # at most ROWS rows at once for every 64 languages
        part = filled.filter((F.col("at") >= start) & (F.col("at") < start + ROWS)).toArrow()
        masks[part["at"].to_numpy(), part["word"].to_numpy()] = unsigned(part["bits"].to_numpy())
    for i in range(len(languages)):
        fill[i] = np.mean(masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1))
    return Filters(languages, masks, fill)


def predict(documents: DataFrame, filters: Filters) -> DataFrame:
    """`doc_id, lang_pred, score` of every document, from its text alone."""
    sent = documents.sparkSession.sparkContext.broadcast((filters.languages, filters.masks, filters.fill))

    def run(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        filters = Filters(*sent.value)
        keys, owner = word_trigrams(texts)
        found = filters.masks_of(keys)
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        total = np.diff(bounds)
        hits = np.zeros((len(texts), max(1, len(filters.languages))))
        for i in range(len(filters.languages)):
            bit = (found[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64)
            counted = np.diff(np.concatenate(([0], np.cumsum(bit)))[bounds])
            false = filters.fill[i] ** PROBES
            hits[:, i] = np.maximum(0, (counted - false * total) / max(1e-9, 1 - false))
        best = np.argmax(hits, axis=1)
        sums = hits.sum(axis=1)
        known = has_letter(texts) & bool(filters.languages)
        names = np.array([*filters.languages, UNKNOWN], object)
        pred = names[np.where(known, best, len(filters.languages))]
        score = np.where(known & (sums > 0), hits[np.arange(len(texts)), best] / np.maximum(sums, 1e-9), 0.0)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(pred.tolist(), pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
        )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_texts(rows, run, "doc_id bigint, lang_pred string, score double")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def identify(documents: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Learn from the documents outside one fold and predict all of them."""
    filters = learn(documents.filter(fold(F.col("doc_id"), folds) != held_out))
    out = fold(F.col("doc_id"), folds) == held_out
    return predict(documents, filters).select("doc_id", out.alias("held_out"), "lang_pred", "score")
