"""Tables written out as the text files a client would send."""

from collections.abc import Iterator

from pyarrow import ArrowInvalid
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidegate.operators.numbering import ID_BITS
from tidegate.session import hadoop_path, new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def delimited(sep: str, *columns: Column) -> Column:
    """Fields joined by `sep`; those that need it are quoted, NULL is empty."""
    quote = F.lit('"')

    def field(column: Column) -> Column:
        text = column.cast("string")
        needs = text.contains(sep) | text.contains('"') | text.contains("\n") | text.contains("\r")
        doubled = F.concat(quote, F.replace(text, quote, F.lit('""')), quote)
        return F.coalesce(F.when(needs, doubled).otherwise(text), F.lit(""))

    return F.concat_ws(sep, *[field(c) for c in columns])


def spread(df: DataFrame) -> DataFrame:
    """As many files as the cluster runs tasks at once."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """Files whose names and lines follow `order`."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def write_lines(df: DataFrame, line: Column, label: str, top: str | None = None) -> str:
    """One file per partition, each starting with the lines `top`."""
    folder = new_folder(df.sparkSession, label)
    if top is not None:
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ID_BITS) - 1))
        line = F.when(row == 0, F.concat(F.lit(top + "\n"), line)).otherwise(line)
    # without the marker file that Spark adds: clients send none
    marker = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    df.select(line.alias("value")).write.option(marker, "false").text(folder)
    return folder


def name_files(spark: SparkSession, folder: str, pattern: str) -> None:
    """Rename a folder's part files to `pattern` with their number, in order."""
    fs, root = hadoop_path(spark, folder)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(root) if "part-" in s.getPath().getName())
    for number, part in enumerate(parts):
        fs.rename(hadoop_path(spark, part)[1], hadoop_path(spark, f"{folder}/{pattern.format(number)}")[1])


def write_files(df: DataFrame, root: str) -> None:
    """A file per row: `content` at `root`/`segment`/`mark`c `number`.csv, made by the tasks that have the rows.

    In a store that only Hadoop knows the driver's file system makes them, one after the other.
    """
    place = hadoop_path(df.sparkSession, root)[1].toUri().toString()
    try:
        FileSystem.from_uri(place)
    except (ArrowInvalid, OSError):
        write_files_from_driver(df, root)
        return

    def make(rows: Iterator[Row]) -> None:
        store, top = FileSystem.from_uri(place)
        made = set()
        for row in rows:
            folder = f"{top}/{row['segment']}"
            if folder not in made:
                store.create_dir(folder)
                made.add(folder)
            with store.open_output_stream(f"{folder}/{row['mark']}c {row['number']}.csv") as stream:
                stream.write(row["content"].encode())

    # rows of one file in one task
    tasks = df.sparkSession.sparkContext.defaultParallelism
    df.repartition(tasks, "segment", "mark", "number").sortWithinPartitions("number").foreachPartition(make)


def write_files_from_driver(df: DataFrame, root: str) -> None:
    for row in df.orderBy("number").toLocalIterator():
        fs, place = hadoop_path(df.sparkSession, f"{root}/{row['segment']}/{row['mark']}c {row['number']}.csv")
        stream = fs.create(place, True)
        stream.write(bytearray(row["content"].encode()))
        stream.close()
