"""Line and row numbers."""

import pytest
from pyspark.sql import functions as F

from tidegate.operators.numbering import count_blocks, number_lines, number_rows, running_total
from tidegate.session import settle
from tidegate.sources.lines import read_lines


def test_line_numbers_across_splits_and_files(spark, write, tiny_splits):
    folder = write({f"f{i}.txt": "".join(f"{n} {'x' * (n % 40)}\n" for n in range(1, 30 * i + 2)) for i in range(6)})
    lines = read_lines(spark, folder).withColumn("at", F.monotonically_increasing_id())
    blocks = settle(count_blocks(lines), "blocks")
    assert blocks.count() > 30
    numbered = number_lines(lines, blocks)
    assert numbered.count() == sum(30 * i + 1 for i in range(6))
    assert numbered.filter(F.col("line_no") != F.split("value", " ")[0].cast("bigint")).isEmpty()


def test_changed_splits_are_noticed(spark, write):
    folder = write({"f.txt": "".join(f"{n}\n" for n in range(50))})
    lines = read_lines(spark, folder).withColumn("at", F.monotonically_increasing_id())
    blocks = settle(count_blocks(lines).withColumn("lines", F.lit(10)), "blocks")
    with pytest.raises(Exception, match="file splits changed"):
        number_lines(lines, blocks).collect()


def test_row_numbers_with_one_key_for_most_rows(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 11).alias("key"), "id")
    numbered = number_rows(rows, ["key", "id"], start=10).orderBy("key", "id").collect()
    assert [row["rownum"] for row in numbered] == list(range(11, 5011))


def test_running_total(spark):
    amounts = spark.range(300).select((F.col("id") * 37 % 300).alias("k"), (F.col("id") % 5).alias("n"))
    total = 0
    for row in running_total(amounts, ["k"], "n", "before").orderBy("k").collect():
        assert row["before"] == total
        total += row["n"]


def test_plans_do_not_shuffle_lines(spark, write):
    folder = write({"f.txt": "a\nb\n"})
    lines = read_lines(spark, folder).withColumn("at", F.monotonically_increasing_id())
    plan = number_lines(lines, settle(count_blocks(lines), "blocks"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_few_rows_are_numbered_as_many_are(spark):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), (F.col("id") % 5).alias("n"))
    for few in (None, 500):
        assert {(r["k"], r["rownum"]) for r in number_rows(rows, ["k"], start=3, rows=few).collect()} == {(k, k + 4) for k in range(500)}
    many = running_total(rows, ["k"], "n", "before").orderBy("k").collect()
    assert running_total(rows, ["k"], "n", "before", rows=500).orderBy("k").collect() == many
