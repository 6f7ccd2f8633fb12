"""The ways taken when tables outgrow a broadcast or one task, and what plans look like."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import load, make_feed
from tidegate.operators import numbering
from tidegate.plans import batch
from tidegate.plans.batch import run_load
from tidegate.plans.stage import profile_paths, row_offsets, typed_rows
from tidegate.plans.stores import ParquetStore

AB = {"a": "A", "b": "B"}


@pytest.fixture
def large(spark, tiny_splits, monkeypatch):
    """Every table counts as too large to broadcast, and to be numbered by one task."""
    monkeypatch.setattr(numbering, "FEW", 0)
    monkeypatch.setattr(numbering, "SENT_BYTES", 0)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def files(n):
    return {
        f"f_{i}.csv": ("x\n" if i % 2 else "\nx\n\n") + ("a,b\n" if i % 3 else "b,a\n")
        + "".join((f"{i * 1000 + j},t{j}\n" if i % 3 else f"t{j},{i * 1000 + j}\n") + (",\n" if j % 5 == 0 else "")
                  for j in range(i * 7 + 1))
        for i in range(n)
    }


WANT = [(i * 1000 + j, f"t{j}") for i in range(6) for j in range(i * 7 + 1)]


def test_rows_without_any_broadcast(spark, write, large):
    rows, _, problems = load(spark, write(files(6)), make_feed(AB, headerrownumber=2))
    assert set(problems.values()) == {None}
    assert rows == WANT


def arrive_late(module, monkeypatch, write, names):
    """Write files of the feed after its listing was taken."""
    listed = module.discover

    def discover(*args):
        found = listed(*args)
        write(names)
        return found

    monkeypatch.setattr(module, "discover", discover)


def test_run_without_any_broadcast(spark, write, large, tmp_path, monkeypatch):
    folder = write(files(6) | {"g_1.csv": "x\na,b\nq,r\n"})
    configs = spark.createDataFrame(
        [(1, 7, 2, folder, "f_*", repr(AB), True, 2, None, ",", "csv")],
        "clientfileconfigid int, clientid int, filetypeid int, srcfilepath string, filemask string, columnstring string, "
        "hasheader boolean, headerrownumber int, datastartingrownumber int, textdelimiter string, fileextension string",
    )
    store = ParquetStore(str(tmp_path / "out"))
    arrive_late(batch, monkeypatch, write, {"f_0a.csv": "x\na,b\ntext,y\n"})
    run_load(spark, configs, None, store)
    rows = store.read(spark, "Raw_Trades").orderBy("rownum").collect()
    assert [(r["a"], r["b"], r["fileid"], r["rownum"]) for r in rows] == [
        (a, b, a // 1000 + 1, n) for n, (a, b) in enumerate(WANT, 1)]


def test_final_pass_parses_once_and_moves_no_rows(spark, write):
    found = profile_paths(spark, make_feed(AB, headerrownumber=2), write(files(3)))
    plan = typed_rows(found, row_offsets(found))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1
    assert "BroadcastHashJoin" in plan
    assert not any(word in plan for word in ("Exchange hashpartitioning", "Exchange SinglePartition", "SortAggregate"))


def test_many_columns(spark, write):
    names = [f"c{i}" for i in range(150)]
    text = ",".join(names) + "\n" + "".join(",".join(str(i * j) for j in range(150)) + "\n" for i in range(3))
    rows, types, _ = load(spark, write({"x.csv": text}), make_feed({n: n for n in names}))
    assert {types[n] for n in names} == {"bigint"}
    got = dict(zip(types, rows[2]))
    assert got["c149"] == 298 and got["c7"] == 14


def test_no_line_moves_at_800_000_splits(spark, write):
    """The table of splits of a feed of 100 TB, as the final pass joins it."""
    feed = make_feed(AB, headerrownumber=2)
    found = replace(profile_paths(spark, feed, write(files(1))), n_splits=800_000)
    numbers = spark.range(800_000).withColumnsRenamed({"id": "block_start"})
    columns = ("first_row_at", "lasting", "lead", "rows_before", "fileid")
    synthetic = numbers.select(F.lit("s3://bucket/in/a file.csv").alias("file_path"), "block_start",
                               *[F.lit(1).cast("bigint").alias(c) for c in columns])
    frame = typed_rows(found, row_offsets(found).withColumn("fileid", F.lit(7).cast("bigint")).unionByName(synthetic))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [split" in plan
    assert not any(word in plan for word in ("Exchange hashpartitioning", "Exchange SinglePartition", "SortMergeJoin"))
    assert [(row["fileid"], row["rownum"]) for row in frame.collect()] == [(7, 1)]


def test_a_large_table_of_splits_is_not_sent(spark, write, monkeypatch):
    folder = write(files(3))
    want = load(spark, folder, make_feed(AB, headerrownumber=2))
    monkeypatch.setattr(numbering, "SENT_BYTES", 0)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    found = profile_paths(spark, make_feed(AB, headerrownumber=2), folder)
    plan = typed_rows(found, row_offsets(found))._jdf.queryExecution().executedPlan().toString()
    got = load(spark, folder, make_feed(AB, headerrownumber=2))
    for key in keys:
        spark.conf.unset(key)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert got == want


def test_two_splits_with_one_key_end_the_job(spark):
    blocks = spark.createDataFrame([("a", 0, 1), ("a", 0, 2)], "file_path string, block_start bigint, n bigint")
    with pytest.raises(Exception, match="two splits with one key"):
        numbering.split_table(blocks, "twice")
