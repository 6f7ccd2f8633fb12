"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of `WINDOW` consecutive words; an item with fewer words
is one window. A window is a set of shingles with their places. Containment in full
needs every shingle of a window, so one prefix token is enough to find it: the
rarest shingle over all documents. Shingles are ordered by that rarity, and a
window with a shingle that no document has is dropped at once.

A first pass over the documents counts the shingles that items have, a second one
finds the places of prefix tokens and keeps the words around them. They are joined
on the token; the token's place in window and document and the document's length
bound where the window could lie; then its words are compared in full.

Both passes look shingles up in Bloom filters of a fixed size, which only spare the
shuffle rows without a partner. Nothing is broadcast by hand.

Defined results: null and empty texts have no words and no hits; an item without
words has no windows; rows that repeat a document get a row each; equal items with
different ids count each, and item ids are compared as strings, a null id counting
as the empty string; other columns are left alone.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.filters import filter_words, passes
from tidegate.llm.tasks import map_texts
from tidegate.llm.text import Words, signed
from tidegate.session import settle

WINDOW = 10
SHINGLE = 3  # words of a shingle, fewer in a window that has fewer

WINDOWS = "item string, words string, length int, place int, shingle bigint"
COUNTS = "shingle bigint, n bigint"
FOUND = "doc_id bigint, digest bigint, n_words bigint, at bigint, shingle bigint, low bigint, around array<string>"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """A row for each shingle of each window of each item."""

    def cut(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        words = Words(texts)
        by_size = {size: dict(zip(*swap(words.shingles(size)))) for size in range(1, SHINGLE + 1)}
        out = []
        for i, item in enumerate(rows.column("item").to_pylist()):
            first, last = int(words.first[i]), int(words.first[i + 1])
            length = min(WINDOW, last - first)
            size = min(SHINGLE, length)
            for start in range(first, last - length + 1) if length else ():
                text = " ".join(words.text(start, start + length))
                for place in range(length - size + 1):
                    out.append((item, text, length, place, by_size[size][start + place]))
        yield batch_of(out, WINDOWS)

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return map_texts(items, cut, WINDOWS)


def swap(found: tuple[np.ndarray, np.ndarray]) -> tuple[list[int], list[int]]:
    hashes, at = found
    return at.tolist(), signed(hashes).tolist()


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string())}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields)], [name for name, _ in fields]
    )


def count_shingles(documents: DataFrame, known: np.ndarray) -> DataFrame:
    """How often documents have the shingles that may be in the filter `known`."""

    def count(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        words = Words(texts)
        found = [hashes[passes(known, hashes)] for size in range(1, SHINGLE + 1) for hashes in [words.shingles(size)[0]]]
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(values)), pa.array(counts.astype(np.int64))], ["shingle", "n"])

    return map_texts(documents.select("text"), count, COUNTS).groupBy("shingle").agg(F.sum("n").alias("n"))


def find_tokens(documents: DataFrame, tokens: np.ndarray) -> DataFrame:
    """A row for each document, and one for each place of a token that may be in the filter."""

    def find(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        words = Words(texts)
        ids, digests = rows.column("doc_id").to_pylist(), rows.column("digest").to_pylist()
        counts = np.diff(words.first)
        out = [(ids[i], digests[i], int(n), None, None, None, None) for i, n in enumerate(counts)]
        for size in range(1, SHINGLE + 1):
            hashes, at = words.shingles(size)
            hit = np.flatnonzero(passes(tokens, hashes))
            for word, shingle in zip(at[hit].tolist(), signed(hashes[hit]).tolist()):
                i = int(words.owner[word])
                first, last = int(words.first[i]), int(words.first[i + 1])
                low, high = max(first, word - WINDOW + 1), min(last, word + WINDOW)
                out.append((ids[i], digests[i], last - first, word - first, shingle, low - first, words.text(low, high)))
        yield batch_of(out, FOUND)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_digest().alias("digest"), "text")
    return map_texts(rows, find, FOUND)


def row_digest() -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def find_benchmark_words(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, digest (of its text), n_words, n_hit, items (sorted)."""
    shingles = settle(item_windows(benchmark), "windows")
    owners = shingles.select("item", "words").distinct()
    counts = count_shingles(documents, filter_words(shingles, "shingle"))
    windows = (
        shingles.select("words", "length", "place", "shingle")
        .distinct()
        .join(counts, "shingle", "left")
        .groupBy("words", "length")
        .agg(
            F.min(F.coalesce("n", F.lit(0))).alias("rarest"),
            F.min(F.struct(F.coalesce("n", F.lit(0)), "shingle", "place")).alias("token"),
        )
        .filter("rarest > 0")
        .select("words", "length", "token.shingle", "token.place")
    )
    windows = settle(windows, "prefixes")
    found = settle(find_tokens(documents, filter_words(windows, "shingle")), "tokens", compact=True)

    start = F.col("at") - F.col("place")
    around = F.array_join(F.slice("around", (start - F.col("low") + 1).cast("int"), F.col("length")), " ")
    spans = (
        found.filter("at is not null")
        .join(windows, "shingle")
        .filter((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .filter(around == F.col("words"))
        .select("doc_id", "digest", start.alias("start"), (start + F.col("length")).alias("stop"), "words")
        .distinct()
    )
    spans = settle(spans, "spans", compact=True)
    reach = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "stop"))),
        F.struct(F.lit(0).cast("bigint").alias("covered"), F.lit(0).cast("bigint").alias("reach")),
        lambda done, span: F.struct(
            (done["covered"] + F.greatest(F.lit(0), span["stop"] - F.greatest(span["start"], done["reach"]))).alias("covered"),
            F.greatest(done["reach"], span["stop"]).alias("reach"),
        ),
        lambda done: done["covered"],
    )
    row = ["doc_id", "digest"]
    covered = spans.groupBy(*row).agg(reach.alias("n_hit"))
    items = (
        spans.select(*row, "words").distinct().join(owners, "words").groupBy(*row)
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hits = covered.join(items, same_row(covered, items)).select(covered["*"], items["items"])
    lengths = found.filter("at is null").select(*row, "n_words")
    return lengths.join(hits, same_row(lengths, hits), "left").select(
        lengths["*"],
        F.coalesce(hits["n_hit"], F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(hits["items"], F.array().cast("array<string>")).alias("items"),
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["digest"] == right["digest"])


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents no window occurs in, with their columns."""
    hit = find_benchmark_words(documents, benchmark).filter("n_hit > 0").select("doc_id", "digest").distinct()
    keyed = documents.withColumn("digest of text", row_digest())
    return keyed.join(
        hit, keyed["doc_id"].eqNullSafe(hit["doc_id"]) & (keyed["digest of text"] == hit["digest"]), "left_anti"
    ).drop("digest of text")
