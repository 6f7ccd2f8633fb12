"""Records put together from the lines of splits, by the tasks that read them."""

import csv
import io
import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import load, make_feed
from tidegate.operators import numbering
from tidegate.session import shared_root
from tidegate.sources.lines import read_lines
from tidegate.sources.quoted import record_maker, whole_records

AB = {"a": "A", "b": "B"}


def as_csv(rows):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([("a", "b"), *rows])
    return text.getvalue()


def some_rows(seed, n):
    rng = random.Random(seed)
    pieces = ["x", "y,", '"', '""', "\n", "\n\n", '",\n"', ',"', " plain words ", "line\n" * 40]
    return [(i, "t" + "".join(rng.choices(pieces, k=rng.randrange(12))) + "e") for i in range(n)]


@pytest.fixture(params=["sent", "moved"])
def way(request, spark, monkeypatch):
    """States and tails of splits are sent to the tasks, or are too large for that."""
    if request.param == "sent":
        yield
        return
    monkeypatch.setattr(numbering, "SENT_BYTES", 0)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_records_over_many_splits(spark, write, tiny_splits, way):
    files = {f"{i}.csv": some_rows(i, 12) for i in range(3)} | {"flat.csv": [(1, "tee")]}
    rows, _, problems = load(spark, write({name: as_csv(of) for name, of in files.items()}), make_feed(AB))
    assert set(problems.values()) == {None}
    assert rows == [row for name in sorted(files) for row in files[name]]


def test_splits_of_blank_lines_belong_to_their_record(spark, write, tiny_splits, way):
    want = [(1, "t" + "\n" * 500 + "e"), (2, "te"), (3, "t\n" + " \n" * 200 + "e")]
    rows, _, problems = load(spark, write({"x.csv": as_csv(want)}), make_feed(AB))
    assert rows == want and problems == {"x.csv": None}


def test_open_files_are_rejected_beside_whole_ones(spark, write, tiny_splits, way):
    want = some_rows(7, 8)
    files = {"open.csv": as_csv(some_rows(8, 8)) + '9,"open\n' + "on and on\n" * 30, "x.csv": as_csv(want)}
    rows, _, problems = load(spark, write(files), make_feed(AB))
    assert rows == want and problems == {"open.csv": "quote left open", "x.csv": None}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 100])
def test_records_do_not_depend_on_batches(size):
    # split, value, begins, fixes, turns: split 2 begins with the end of a record of split 1, 3 and 4 are nothing else
    lines = [
        (1, "a", 0, -1, 0), (1, 'b"', 0, -1, 1), (1, "c", 0, -1, 0), (2, "d", 1, -1, 0), (2, 'e"', 1, 0, 0), (2, "f", 1, -1, 0),
        (2, 'g"', 1, 1, 0), (3, "h", 1, -1, 0), (4, "i", 1, -1, 0), (5, 'j"', 1, -1, 1), (5, "k", 1, -1, 0),
    ]
    names = ["split", "value", "begins", "fixes", "turns"]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines[i : i + size]), kinds)], names)
        for i in range(0, len(lines), size)
    ]
    found = [tuple(row.values()) for batch in record_maker()(iter(batches)) for row in batch.to_pylist()]
    assert found == [(1, "a", False), (1, 'b"\nc', True), (2, "f", False), (2, 'g"', True), (5, "k", True)]


def held(spark):
    root = Path(shared_root(spark).removeprefix("file:")) / "tidegate"
    return sum(p.stat().st_size for p in root.rglob("*.parquet"))


def test_no_line_moves_and_none_is_written(spark, write):
    """What is kept of a feed with line breaks is small beside it, and its records are read without a shuffle."""
    rng = random.Random(1)
    rows = [(i, "t" + "".join(rng.choices("abcdefgh\n", k=3000)) + "e") for i in range(700)]
    folder = write({"x.csv": as_csv(rows)})
    before = held(spark)
    records = whole_records(read_lines(spark, folder), ",")
    got = records.filter(F.col("value") != "a,b").select(F.length("value").alias("n")).collect()
    assert sorted(row["n"] for row in got) == sorted(len(f'{i},"{text}"') if "\n" in text else len(f"{i},{text}") for i, text in rows)
    assert held(spark) - before < 2_000_000 / 10
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange hashpartitioning", "Exchange SinglePartition", "Window", "Sort "))
