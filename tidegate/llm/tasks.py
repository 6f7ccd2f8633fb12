"""Running numpy code over the texts of a DataFrame, one Arrow batch at a time."""

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm.text import as_text, runs

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of this session the package, once per application."""
    context = spark.sparkContext
    if getattr(context, "tidegate_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tidegate-"), "tidegate.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    context.addPyFile(path)
    context.tidegate_shipped = True


def map_texts(
    df: DataFrame, function: Callable[[pa.RecordBatch, pa.Array], Iterator[pa.RecordBatch]], schema: str, text: str = "text"
) -> DataFrame:
    """`function(rows, texts)` over runs of rows that together hold about two MiB of text.

    `rows` has all columns of `df`; `texts` is its text column, null as empty.
    """
    ship_package(df.sparkSession)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_text(batch.column(text))
            for start, stop in runs(texts):
                yield from function(batch.slice(start, stop - start), texts.slice(start, stop - start))

    return df.mapInArrow(per_task, schema)
