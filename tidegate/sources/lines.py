"""Text lines with the file and split they came from."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.session import tune_scans

FILE_COLUMNS = ("file_path", "block_start", "file_size", "modified")


def file_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    tune_scans(spark)
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    return reader.text(path).select("value", *file_columns())
