"""Records whose quoted fields hold line breaks, put together from the lines of splits.

A line maps the state it begins in, inside a quoted field or not, to the state it ends
in. Most lines leave the state alone, a line with a quote left open turns it over, and a
line may end in one state whatever it began in. Such maps combine in any grouping: of a
run of lines, the last one that fixes the state and the turns after it decide. So a
split is summed up by itself, the sums are carried from split to split of a file, and
with the state a split begins in every line knows whether it begins a record.

The task that reads a split puts its records together, so no line moves and none is
written, but for the lines at the head of a split: they may belong to a record that
began some splits earlier, and are sent to the task that reads that split. A file is
never read by one task because of its line breaks; a record is held whole.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.operators import numbering
from tidegate.operators.numbering import BLOCK, SPLIT, row_bytes, split_key, split_table
from tidegate.session import settle
from tidegate.sources.delimited import has_open_quote
from tidegate.sources.lines import FILE_COLUMNS

# The rest of a quoted field that began on an earlier line, up to its closing quote.
CLOSING = '^[^"]*+(?:""[^"]*+)*+"'


def ends_inside(value: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field, if it begins outside one and if it begins inside."""
    after = F.concat(F.lit("x"), F.regexp_replace(value, CLOSING, ""))
    inside = F.when(F.contains(value, F.lit('"')) & value.rlike(CLOSING), has_open_quote(after, sep)).otherwise(F.lit(True))
    return has_open_quote(value, sep), inside


def after(state: Column, fixed: Column, turned: Column) -> Column:
    """The state that lines lead to from `state`."""
    return F.coalesce(fixed, state).bitwiseXOR(F.coalesce(turned, F.lit(0)).cast("int"))


def line_maps(lines: DataFrame, sep: str) -> DataFrame:
    """`lines` with their place in the scan, `at`, and the map of each: `fixes` or `turns`."""
    outside, inside = ends_inside(F.col("value"), sep)
    placed = lines.withColumns({"at": F.monotonically_increasing_id(), "outside": outside, "inside": inside})
    return placed.select(
        *lines.columns,
        "at",
        F.when(F.col("outside") == F.col("inside"), F.col("outside").cast("int")).alias("fixes"),
        (F.col("outside") & ~F.col("inside")).cast("int").alias("turns"),
    )


def running_maps(maps: DataFrame, group: list[str], order: str, last: int) -> DataFrame:
    """`maps` with the map of the rows of their group from its first to the one `last` rows on.

    What is fixed is kept as it would be without any turn since the group began, so that
    one parity serves all rows.
    """
    window = Window.partitionBy(*group).orderBy(order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = F.col("fixes").bitwiseXOR(F.col("parity"))
    placed = maps.withColumn("parity", (F.sum("turns").over(so_far) % 2).cast("int")).withColumn("plain", plain)
    some = window.rowsBetween(Window.unboundedPreceding, last)
    return placed.withColumns(
        {
            "fixed": F.last("plain", ignorenulls=True).over(some),
            "turned": F.coalesce(F.sum("turns").over(some) % 2, F.lit(0)).cast("int"),
        }
    ).drop("plain", "parity")


def split_map(changes: Column) -> Column:
    """The map of a split, `fixes` or `turns`, from those of its lines in order."""
    nothing = F.struct(F.lit(None).cast("int").alias("fixes"), F.lit(0).alias("turns"))

    def then(so_far: Column, line: Column) -> Column:
        turned = line["turns"]
        return F.struct(
            F.coalesce(line["fixes"], so_far["fixes"].bitwiseXOR(turned)).alias("fixes"),
            F.when(line["fixes"].isNotNull() | so_far["fixes"].isNotNull(), 0)
            .otherwise(so_far["turns"].bitwiseXOR(turned))
            .alias("turns"),
        )

    return F.aggregate(changes, nothing, then)


def split_states(maps: DataFrame) -> DataFrame:
    """Per split: `begins`, `ends_open` of its file, the last line of its head, `head_end`, and the split
    whose last record that head belongs to, `owner`."""
    change = F.struct("at", "fixes", F.coalesce("turns", F.lit(0)).alias("turns"))
    # up to the first line that leads out of a quoted field a split that begins inside stays inside
    leads_out = (F.col("turns") == 1) | (F.col("fixes") == 0)
    splits = maps.groupBy(*BLOCK).agg(
        F.max("file_size").alias("file_size"),
        F.max("modified").alias("modified"),
        F.min(F.when(leads_out, F.col("at"))).alias("head_end"),
        F.array_sort(F.collect_list(F.when(F.col("fixes").isNotNull() | (F.col("turns") == 1), change))).alias("changes"),
    )
    whole = settle(splits.withColumn("map", split_map(F.col("changes"))).drop("changes"), "splits-quoted")
    # a split that fixes the state does so whatever the one before leaves, with its turns counted in
    whole = whole.select("*", "map.fixes", "map.turns").drop("map")
    nothing = F.lit(0)
    before = running_maps(whole, ["file_path"], "block_start", -1).withColumn(
        "begins", after(nothing, F.col("fixed"), F.col("turned"))
    )
    end = F.coalesce(F.col("fixes"), F.col("begins").bitwiseXOR(F.col("turns")))
    file = Window.partitionBy("file_path")
    earlier = file.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    # a split that ends with its head has no record, but none of the later heads belongs to an earlier one then
    has_records = (F.col("begins") == 0) | F.col("head_end").isNotNull()
    return before.select(
        *BLOCK,
        "file_size",
        "modified",
        "begins",
        (F.max_by(end, "block_start").over(file) == 1).alias("ends_open"),
        "head_end",
        F.last(F.when(has_records, F.col("block_start")), ignorenulls=True).over(earlier).alias("owner"),
    )


def split_tails(heads: DataFrame) -> DataFrame:
    """Per split: the lines at the head of later splits that go on with its last record, as one text.

    `heads` are lines of splits that begin inside a quoted field, with `owner` and `head_end` of their split.
    """
    parts = F.array_sort(F.collect_list(F.struct("block_start", "at", "value")))
    return (
        heads.filter(F.col("head_end").isNull() | (F.col("at") <= F.col("head_end")))
        .groupBy("file_path", "owner")
        .agg(F.array_join(parts["value"], "\n").alias("tail"))
        .select(F.xxhash64("file_path", "owner").alias(SPLIT), "tail")
    )


def record_maker() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that puts the lines of a task (SPLIT, value, begins, fixes, turns), split by split, together to
    records: SPLIT, value, and whether it is the last of its split.

    Lines at the head of a split that belong to an earlier one are left out. The function
    goes to the tasks as it is, which need not have this package.
    """

    def line_states(begins: np.ndarray, first: np.ndarray, fixes: np.ndarray, turns: np.ndarray, state: int) -> np.ndarray:
        """The state each line begins in, and the one after them; the first line of a split begins as its split."""
        n = len(first)
        known = np.full(n + 1, -1)
        known[0] = state
        fixing = np.flatnonzero(fixes >= 0)
        known[fixing + 1] = fixes[fixing]
        known[:n][first] = begins[first]
        latest = np.maximum.accumulate(np.where(known >= 0, np.arange(n + 1), 0))
        turned = np.concatenate([[0], np.cumsum(turns)])
        return known[latest] ^ (turned - turned[latest]) % 2

    def batch_of(splits: list, values: list, last: list) -> pa.RecordBatch:
        columns = [pa.array(splits, pa.int64()), pa.array(values, pa.string()), pa.array(last, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, [SPLIT, "value", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state = None, 0  # where the last batch ended
        owner, parts = None, []  # the last record so far, which may go on
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            of, begins, fixes, turns = (batch.column(name).to_numpy() for name in (SPLIT, "begins", "fixes", "turns"))
            values = batch.column("value")
            first = np.append(of[0] != split, of[1:] != of[:-1])
            states = line_states(begins, first, fixes, turns, state)
            starts = states[:n] == 0
            begun = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            opened = np.maximum.accumulate(np.where(first, np.arange(n), -1))
            goes_on = (begun < 0) & (opened < 0)
            if owner is not None and owner == split and goes_on.any():
                parts.append("\n".join(values.filter(pa.array(goes_on)).to_pylist()))
            if starts.any():
                mine = (begun >= 0) & (begun >= opened)
                kept = values.filter(pa.array(mine))
                ends = np.append(np.flatnonzero(starts[mine]), len(kept)).astype(np.int32)
                records = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), kept), "\n")
                owners = of[starts]
                if owner is not None:
                    yield batch_of([owner], ["\n".join(parts)], [bool(owner != owners[0])])
                if len(owners) > 1:
                    columns = [pa.array(owners[:-1]), records[:-1], pa.array(owners[1:] != owners[:-1])]
                    yield pa.RecordBatch.from_arrays(columns, [SPLIT, "value", "last"])
                owner, parts = int(owners[-1]), [records[-1].as_py()]
            split, state = int(of[-1]), int(states[n])
        if owner is not None:
            yield batch_of([owner], ["\n".join(parts)], [True])

    return run


def whole_records(lines: DataFrame, sep: str) -> DataFrame:
    """The records of `lines` as rows like lines, with line breaks inside.

    A record stands in the split its first line is in, and is read with it, in order. A
    file that ends inside a quoted field has one row in place of its records, a quote that
    is left open. Only states and tails of splits are written. Where these are too large
    to be sent to every task, lines are moved to their splits, and the records written.
    """
    maps = line_maps(lines, sep)
    states = settle(split_states(maps), "states")
    closed = states.filter(~F.col("ends_open"))
    keyed = closed.select(*FILE_COLUMNS, "begins", "owner", "head_end")
    table = split_table(keyed.withColumn("path", F.col("file_path")).withColumn("start", F.col("block_start")), "begins")
    size = table.agg(F.count(F.lit(1)), F.sum(F.octet_length("path"))).first()
    held = size[0] * row_bytes(table) + (size[1] or 0)

    def sent(df: DataFrame, more: int = 0) -> DataFrame:
        return F.broadcast(df) if held + more <= numbering.SENT_BYTES else df

    inside = table.filter("begins = 1").select(SPLIT, "owner", "head_end")
    placed = lines.select("value", *BLOCK, F.monotonically_increasing_id().alias("at"), split_key().alias(SPLIT))
    tails = settle(split_tails(placed.join(sent(inside), SPLIT)), "tails", compact=True)
    longest = tails.agg(F.sum(F.octet_length("tail"))).first()[0] or 0
    small = held + longest <= numbering.SENT_BYTES

    begins = table.select(SPLIT, "begins")
    told = maps.withColumn(SPLIT, split_key()).join(sent(begins, longest), SPLIT)
    if not small:
        told = told.repartition(SPLIT).sortWithinPartitions(SPLIT, "at")
    told = told.select(
        SPLIT, "value", "begins", F.coalesce("fixes", F.lit(-1)).alias("fixes"), F.coalesce("turns", F.lit(0)).alias("turns")
    )
    records = told.mapInArrow(record_maker(), f"{SPLIT} bigint, value string, last boolean")
    files = table.join(tails, SPLIT, "left").select(
        SPLIT, F.col("path").alias("file_path"), F.col("start").alias("block_start"), "file_size", "modified", "tail"
    )
    whole_text = F.when(F.col("last") & F.col("tail").isNotNull(), F.concat("value", F.lit("\n"), "tail"))
    if small:
        found = records.join(F.broadcast(files), SPLIT)
    else:
        found = records.withColumn("record", F.monotonically_increasing_id()).join(files, SPLIT)
        found = found.repartition("file_path", "block_start").sortWithinPartitions("file_path", "block_start", "record")
    whole = found.select(F.coalesce(whole_text, "value").alias("value"), *FILE_COLUMNS)
    if not small:
        whole = settle(whole, "records", compact=True, one_group=True)
    marks = states.filter("ends_open").groupBy("file_path").agg(
        F.max("file_size").alias("file_size"), F.max("modified").alias("modified")
    )
    marks = marks.select(
        F.lit('"').alias("value"), "file_path", F.lit(0).cast("bigint").alias("block_start"), "file_size", "modified"
    )
    return whole.unionByName(settle(marks, "left-open"))
