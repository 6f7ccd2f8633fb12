"""Config rows: flags, feed kinds and the reasons a feed cannot be loaded."""

import pytest
from pyspark.sql import functions as F

from helpers import ROW, make_feed
from tidegate.functions.mappings import header_names
from tidegate.operators.columns import drop_matching, rename_by_header, rename_by_position
from tidegate.plans.config import feed_of, header_flag, split_configs
from tidegate.sources.listing import takes, takes_name

GOOD = {"a": "A"}


@pytest.mark.parametrize(
    "changes, problem",
    [
        ({}, None),
        ({"fileextension": "xlsx"}, "cannot read xlsx files"),
        ({"fileextension": "txt"}, "cannot read txt files"),
        ({"fileextension": "dat"}, "a dat feed cannot have a header"),
        ({"filetypeid": 4}, "no staging table for file type 4"),
        ({"clientid": None}, "no clientid"),
        ({"columnstring": None}, "no columnstring"),
        ({"headerrownumber": "one"}, "header row is not a number"),
        ({"columnstring": "{'a': 'X', 'b': 'x'}"}, "two columns with one target"),
        ({"columnstring": "{'a': 'unknown', 'b': 'unknown'}"}, None),
        ({"columnstring": "['a']"}, "column mapping: column mapping is not a non-empty dict"),
        ({"textdelimiter": "fixedwidth"}, "no fixed-width mapping"),
    ],
)
def test_problems(changes, problem):
    assert feed_of(ROW | {"columnstring": repr(GOOD)} | changes, []).problem == problem


def test_broken_mappings():
    assert make_feed(columnstring="{'a': ").problem.startswith("column mapping")
    assert make_feed(columnstring="{1: 'a', 'b': 'c'}").problem.startswith("column mapping")
    assert make_feed(columnstring="__import__('os').getcwd()").problem.startswith("column mapping")


def test_header_flag(spark):
    rows = [(flag, row) for flag in (True, False, None) for row in (0, 1, None)]
    df = spark.createDataFrame(rows, "f boolean, r int")
    got = df.withColumn("flag", header_flag(F.col("f"), F.col("r"))).collect()
    assert all(r["flag"] == (not (r["f"] is False and r["r"] == 0)) for r in got)


def test_feed_kinds(spark):
    rows = [ROW | {"clientfileconfigid": i, "textdelimiter": d, "srcfilepath": "s3:\\b\\in/x\\"}
            for i, d in enumerate([",", None, "fixedwidth", "FIXEDWIDTH", "FixedWidth", "Fixedwidth"])]
    schema = ("clientfileconfigid int, clientid int, filetypeid int, srcfilepath string, filemask string, "
              "columnstring string, hasheader boolean, headerrownumber int, datastartingrownumber int, "
              "textdelimiter string, fileextension string")
    names = [part.split()[0] for part in schema.split(", ")]
    configs = spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schema)
    delimited, fixed = split_configs(configs)
    assert [r["clientfileconfigid"] for r in delimited.collect()] == [0, 5]
    assert [r["clientfileconfigid"] for r in fixed.collect()] == [2, 3, 4]
    assert len(delimited.columns) == len(fixed.columns) == 10
    assert delimited.first()["srcfilepath"] == "s3:/b/in/x/"


def test_header_names(spark):
    rows = [(["a", "a", "a.1", "a"],), ([" ", "", None],), (["NA", "x", "NA"],)]
    got = [r[0] for r in spark.createDataFrame(rows, "c array<string>").select(header_names(F.col("c"))).collect()]
    assert got == [["a", "a.2", "a.1", "a.3"], [" ", "Unnamed: 1", "Unnamed: 2"], ["NA", "x", "NA.1"]]


def test_masks(spark):
    rows = [("s3://b/in/acme/tr_1.csv", "tr_*.csv"), ("s3://b/in/acme/x_tr_1.dat", "tr_*.csv"),
            ("s3://b/in/acme/y.csv", "acme*"), ("s3://b/in/acme/y.csv", "*"), ("s3://b/in/acme/a+b.csv", "a+?.csv")]
    got = spark.createDataFrame(rows, "k string, m string").select(takes(F.col("k"), F.col("m")), takes_name(F.col("k"), F.col("m")))
    assert [tuple(r) for r in got.collect()] == [
        (True, True), (True, False), (True, False), (True, True), (False, True)]


def test_renames(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b ` int")
    assert rename_by_position(df, ["B ", "X"]).columns == ["b ", "x"]
    assert rename_by_header(df, {"a": "B", "b": "A"}).columns == ["b", "a"]
    with pytest.raises(KeyError):
        rename_by_header(df, {"a": "B"})
    assert drop_matching(df.toDF("unknown", "unknow")).columns == []
