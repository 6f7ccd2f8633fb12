"""The first lines of files, without reading the files.

Each file is a task of its own whose lines are asked for in small batches, and which
stops at the last line wanted. Where that line stands behind many others, the task
just reads on.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.session import settle

WHOLE = str(1 << 44)  # bytes no file has: a split is a file
BATCH_LINES = "256"
DISTINCT_HEADS = 1000  # different lines that a filter names


@dataclass(frozen=True)
class Heads:
    """Per file its first lines (file_path, texts), and all different ones."""

    files: DataFrame
    texts: list[str]


def first_lines(spark: SparkSession, path: str | list[str], glob: str | None, counted: Column, n: int) -> DataFrame:
    """The first `n` lines for which `counted` holds: file_path, number, value."""
    apart = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        apart.conf.set(f"spark.sql.files.{key}", WHOLE)
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_LINES)
    reader = apart.read if glob is None else apart.read.option("pathGlobFilter", glob)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file_path"), counted.alias("counted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = 0
        for batch in batches:
            kept = pa.Table.from_batches([batch]).filter(batch.column("counted")).slice(0, n - found).combine_chunks()
            numbers = pa.array(range(found + 1, found + 1 + len(kept)), pa.int64())
            found += len(kept)
            if len(kept):
                columns = [kept["file_path"].combine_chunks(), numbers, kept["value"].combine_chunks()]
                yield pa.RecordBatch.from_arrays(columns, ["file_path", "number", "value"])
            if found == n:
                return

    return settle(lines.mapInArrow(run, "file_path string, number bigint, value string"), "heads", session=spark)


def read_heads(spark: SparkSession, path: str | list[str], glob: str | None, counted: Column, n: int) -> Heads | None:
    """None if there are too many different lines to be named."""
    lines = first_lines(spark, path, glob, counted, n)
    texts = [row["value"] for row in lines.select("value").distinct().limit(DISTINCT_HEADS + 1).collect()]
    if len(texts) > DISTINCT_HEADS:
        return None
    ordered = F.array_sort(F.collect_list(F.struct("number", "value")))
    return Heads(lines.groupBy("file_path").agg(ordered["value"].alias("texts")), texts)
