"""Line and row numbers without sorting or shuffling the rows.

`monotonically_increasing_id` is consecutive inside a task, and a file split is
read by one task in order. So a row's place in its split is its id minus the
split's first id, and a table with one row per split supplies the rest.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.session import settle

BLOCK = ("file_path", "block_start")
ID_BITS = 33  # fixed value: low bits of the id that count rows inside a task
SPLIT = "split"  # the key of a split in a table that lines are joined to
SENT_BYTES = 128 << 20  # the largest table of splits that is sent to every executor
FEW = 10_000  # rows that one task numbers; more are cut into ranges


def task_of(at: Column) -> Column:
    return F.shiftright(at, ID_BITS)


def split_key() -> Column:
    """Eight bytes for a split, in place of its path and start."""
    return F.xxhash64(*BLOCK)


def split_table(blocks: DataFrame, label: str) -> DataFrame:
    """`blocks` keyed by SPLIT. Two splits with one key, which nobody has seen, end the job."""
    kept = [name for name in blocks.columns if name not in BLOCK]
    alone = F.assert_true(F.count(F.lit(1)) == 1, F.lit("two splits with one key"))
    keyed = blocks.withColumn(SPLIT, split_key()).groupBy(SPLIT).agg(
        *[F.first(name).alias(name) for name in kept], alone.cast("string").alias("alone")
    )
    return settle(keyed.filter(F.col("alone").isNull()).drop("alone"), label)


def row_bytes(table: DataFrame) -> int:
    """Bytes of a row of numbers; an array counts for what the widest of its kind may hold."""
    return sum(8 if field.dataType.typeName() != "array" else 8 + 4 * 256 for field in table.schema)


def at_splits(lines: DataFrame, table: DataFrame, n_splits: int) -> DataFrame:
    """`lines`, which carry SPLIT, joined to one row per split, which is sent to them while it is small.

    With 48 bytes a split the table of a feed of 300 TB is small: no line moves.
    """
    small = n_splits * row_bytes(table) <= SENT_BYTES
    return lines.join(F.broadcast(table) if small else table, SPLIT)


def count_blocks(lines: DataFrame) -> DataFrame:
    """Per split: its first id, its lines, and the lines before it in its file."""
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return (
        lines.groupBy(*BLOCK)
        .agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("lines"))
        .withColumn("lines_before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    )


def place_in_block(at: str, first: str, size: str) -> Column:
    """0-based place in the split; fails if the splits are not those counted."""
    place = F.col(at) - F.col(first)
    return F.when((place >= 0) & (place < F.col(size)), place).otherwise(
        F.raise_error(F.lit("file splits changed between two passes over the same files")).cast("bigint")
    )


def number_lines(lines: DataFrame, blocks: DataFrame, name: str = "line_no") -> DataFrame:
    """1-based line number in the file, for lines that carry `at`."""
    table = split_table(blocks.select(*BLOCK, "first_at", "lines", "lines_before"), "splits")
    return (
        at_splits(lines.withColumn(SPLIT, split_key()), table, table.count())
        .withColumn(name, F.col("lines_before") + place_in_block("at", "first_at", "lines") + 1)
        .drop(SPLIT, "first_at", "lines", "lines_before")
    )


def in_slices(df: DataFrame, order: list, label: str) -> DataFrame:
    """`df` range-partitioned and sorted by `order`, written with its ids `at`.

    A key may fill many slices as long as `order` ends in something that tells
    its rows apart.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(ranged.withColumn("at", F.monotonically_increasing_id()), label, compact=True)


def slice_starts(sliced: DataFrame, amount: Column) -> DataFrame:
    """Per slice: its first id and the `amount` of all earlier slices."""
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.groupBy(task_of(F.col("at")).alias("slice"))
        .agg(F.min("at").alias("first_at"), F.sum(amount).alias("amount"))
        .withColumn("in_earlier_slices", F.coalesce(F.sum("amount").over(earlier), F.lit(0)))
        .select("slice", "first_at", "in_earlier_slices")
    )


def number_rows(df: DataFrame, order: list, name: str = "rownum", start: int = 0, rows: int | None = None) -> DataFrame:
    """`start + 1`, `start + 2`, ... in `order`; `rows` is their number where it has been counted."""
    if rows is not None and rows <= FEW:
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*order)) + F.lit(start)).cast("bigint"))
    sliced = in_slices(df, order, "numbered")
    starts = slice_starts(sliced, F.lit(1))
    number = F.col("in_earlier_slices") + F.col("at") - F.col("first_at") + F.lit(start + 1)
    return (
        sliced.withColumn("slice", task_of(F.col("at")))
        .join(starts, "slice")
        .withColumn(name, number.cast("bigint"))
        .drop("slice", "at", "first_at", "in_earlier_slices")
    )


def running_total(df: DataFrame, order: list, amount: str, name: str, rows: int | None = None) -> DataFrame:
    """The `amount` of all earlier rows in `order`; `rows` is their number where it has been counted."""
    if rows is not None and rows <= FEW:
        earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
    sliced = in_slices(df, order, "totals")
    starts = slice_starts(sliced, F.col(amount))
    earlier = Window.partitionBy("slice").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("slice", task_of(F.col("at")))
        .withColumn(name, F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
        .join(starts.drop("first_at"), "slice")
        .withColumn(name, F.col(name) + F.col("in_earlier_slices"))
        .drop("slice", "at", "in_earlier_slices")
    )
