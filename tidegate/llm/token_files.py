"""Token ids of documents in binary files, coded in 64-bit words, and read back.

Documents are dealt to tasks by ranges of doc_id (null first; rows that share one lie
side by side, by a hash of their text), tokenised there, and written in that order.
A file holds whole documents: it is closed with the document that brings it to
FILE_IDS ids. So memory is bounded by FILE_IDS or the longest document.

A file is a row of little-endian 64-bit numbers:

    magic, task, file of the task, documents, ids, words, escapes
    per document: doc_id
    per document: ids, and the top bit if doc_id is null
    per 1,024 ids: number of the block's first word
    the words, then the escaped values (see simple8b)

What follows the last number is not part of the file. Spark writes and reads the
files, so they may lie wherever it can write, and a task that is lost is run again
without a trace of its first run.

Ids are any integers from 0 to 2**64 - 1. Texts that are null count as empty; an
empty text has its end id alone. Files without documents are empty, and are skipped.
Columns other than doc_id and text are ignored. Rows that repeat doc_id and text have
a row each.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm.simple8b import BLOCK, pack, unpack, unpack_range
from tidegate.llm.tasks import ship_package
from tidegate.llm.text import as_text, runs
from tidegate.operators.numbering import running_total
from tidegate.session import settle

FILE_IDS = 8 << 20
PACK_IDS = 1 << 20  # ids packed at once: whole blocks
RUN_BYTES = 8 << 20  # bytes of text that are tokenised together

# Fixed values of the format.
MAGIC = int.from_bytes(b"tokens8b", "little")
HEADER = 7
NO_ID = np.uint64(1 << 63)


def as_file(task: int, number: int, doc_ids: np.ndarray, unknown: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one file."""
    parts = [pack(ids[at : at + PACK_IDS]) for at in range(0, len(ids), PACK_IDS)]
    words = np.concatenate([np.empty(0, np.uint64), *(part[0] for part in parts)])
    escapes = np.concatenate([np.empty(0, np.uint64), *(part[2] for part in parts)])
    firsts, n_words, n_escapes = [np.empty(0, np.int64)], 0, 0
    for part_words, part_firsts, part_escapes in parts:
        # escapes are counted through the file
        mine = part_words >> np.uint64(60) == 0
        words[n_words : n_words + len(part_words)][mine] += np.uint64(n_escapes)
        firsts.append(part_firsts + n_words)
        n_words += len(part_words)
        n_escapes += len(part_escapes)
    head = np.array([MAGIC, task, number, len(doc_ids), len(ids), n_words, n_escapes], np.uint64)
    listed = sizes.astype(np.uint64) | np.where(unknown, NO_ID, np.uint64(0))
    numbers = [head, doc_ids.astype(np.int64).view(np.uint64), listed, np.concatenate(firsts).astype(np.uint64), words, escapes]
    return np.concatenate(numbers).astype("<u8").tobytes()


class File:
    """One file's documents and ids."""

    def __init__(self, content: bytes):
        numbers = np.frombuffer(content, "<u8", count=len(content) // 8)
        magic, self.task, self.number, documents, self.n, n_words, n_escapes = (int(x) for x in numbers[:HEADER])
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        blocks = -(-self.n // BLOCK)
        cuts = np.cumsum([HEADER, documents, documents, blocks, n_words, n_escapes])
        if cuts[-1] > len(numbers):
            raise ValueError("a file of token ids is cut short")
        ids, listed, firsts, self.words, self.escapes = (numbers[a:b] for a, b in zip(cuts, cuts[1:]))
        self.doc_ids, self.unknown = ids.astype(np.int64), listed & NO_ID != 0
        self.sizes = (listed & ~NO_ID).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.firsts = firsts.astype(np.int64)

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.firsts, self.escapes, self.n)

    def ids_between(self, start: int, stop: int) -> np.ndarray:
        return unpack_range(self.words, self.firsts, self.escapes, self.n, start, stop)


class Pending:
    """Documents of a task that wait for their file to be full."""

    def __init__(self, task: int):
        self.task, self.number = task, 0
        self.clear()

    def clear(self) -> None:
        self.n, self.doc_ids, self.unknown, self.sizes, self.ids = 0, [], [], [], []

    def add(self, doc_ids: np.ndarray, unknown: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
        """Take documents; yield the files they fill."""
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            before = int(ends[at - 1]) if at else 0
            stop = min(int(np.searchsorted(ends, before + FILE_IDS - self.n)) + 1, len(sizes))
            after = int(ends[stop - 1])
            for kept, new in zip((self.doc_ids, self.unknown, self.sizes), (doc_ids, unknown, sizes)):
                kept.append(new[at:stop])
            self.ids.append(ids[before:after])
            self.n += after - before
            at = stop
            if self.n >= FILE_IDS:
                yield self.close()

    def close(self) -> bytes:
        columns = (np.concatenate(part) for part in (self.doc_ids, self.unknown, self.sizes, self.ids))
        content = as_file(self.task, self.number, *columns)
        self.number += 1
        self.clear()
        return content


def in_order(documents: DataFrame) -> DataFrame:
    """doc_id and text, dealt by ranges and sorted; the last two keys split rows that share a doc_id."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def write_ids(documents: DataFrame, folder: str, make_tokenizer: Callable[[], object], end_id: int) -> None:
    """Tokenise `documents` and write their ids, each document's followed by `end_id`.

    `make_tokenizer` makes, in a task, an object whose `encode(texts)` returns the flat
    ids of an Arrow array of texts and where each text's ids begin and the last end.
    """
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = make_tokenizer()
        pending = Pending(TaskContext.get().partitionId())

        def row(content: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            texts, column = as_text(batch.column("text")), batch.column("doc_id")
            doc_ids, unknown = column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
            for a, b in runs(texts, RUN_BYTES):
                ids, bounds = tokenizer.encode(texts.slice(a, b - a))
                sizes = np.diff(bounds) + 1
                # every document's end id comes after its own
                ended = np.insert(ids.astype(np.uint64), bounds[1:], np.uint64(end_id))
                yield from map(row, pending.add(doc_ids[a:b], unknown[a:b], sizes, ended))
        if pending.sizes:
            yield row(pending.close())

    files = in_order(documents).mapInArrow(run, "content binary")
    # a text line per file: Spark writes the bytes as they are, and a line end that no reader looks at
    files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "compression", "none"
    ).text(folder)


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.format("binaryFile").load(folder)
    return found.filter("length > 0").select("content")


def file_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Per file: task, file, and the ids of all files before it. Only headers leave Spark's scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = np.array([np.frombuffer(head, "<u8") for head in batch.column("head").to_pylist()]).reshape(-1, HEADER)
            columns = [pa.array(heads[:, place].astype(np.int64)) for place in (1, 2, 4)]
            yield pa.RecordBatch.from_arrays(columns, ["task", "file", "n"])

    heads = files_of(spark, folder).select(F.substring("content", 1, 8 * HEADER).alias("head"))
    totals = settle(heads.mapInArrow(run, "task bigint, file bigint, n bigint"), "token-files")
    return running_total(totals, ["task", "file"], "n", "ids_before").drop("n")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: task, file, place (ids before it in its file), doc_id, n_tokens, and ids as
    little-endian unsigned 32-bit numbers. Larger ids make the read fail; `File` reads them."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = File(content.as_buffer())
                ids = file.ids()
                if len(ids) and int(ids.max()) >> 32:
                    raise ValueError("an id has more than 32 bits")
                flat, many = ids.astype("<u4"), len(file.sizes)
                offsets = np.append(file.starts, file.n).astype(np.int64) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(many, file.task)),
                        pa.array(np.full(many, file.number)),
                        pa.array(file.starts),
                        pa.array(file.doc_ids, mask=file.unknown),
                        pa.array(file.sizes),
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), many, [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
                        ).cast(pa.binary()),
                    ],
                    ["task", "file", "place", "doc_id", "n_tokens", "ids"],
                )

    schema = "task bigint, file bigint, place bigint, doc_id bigint, n_tokens bigint, ids binary"
    return files_of(spark, folder).mapInArrow(run, schema)


def with_starts(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """`rows` of `read_ids` with `start`: the ids of all documents before theirs."""
    start = (F.col("ids_before") + F.col("place")).alias("start")
    others = [name for name in rows.columns if name not in ("task", "file", "place")]
    return rows.join(starts, ["task", "file"]).select(*others, start)
