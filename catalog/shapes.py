"""Column shapes, null rules, unions and row numbers."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.render import delimited, in_order, table, write_lines
from catalog.scans import feed
from tidegate.functions.values import null_if_token
from tidegate.operators.columns import (
    drop_empty_rows,
    drop_matching,
    rename_by_header,
    rename_by_position,
    text_matching,
    trim_names,
    union_by_name,
)
from tidegate.operators.numbering import number_rows
from tidegate.operators.routing import route
from tidegate.plans.stage import scan_feed


def rename_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that are also source names further right do not collide."""
    customer = table(spark, sf_dir, "customer")
    return rename_by_position(customer, ["C_NAME", "C_CUSTKEY", "Nation", "BALANCE", "segment"])


def rename_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "customer").toDF(" Acct No", "Name ", " Nation ", "Balance", "Segment")
    named = trim_names(padded.select(" Acct No", "Name ", " Nation "))
    return rename_by_header(named, {"Acct No": "ACCTID", "Name": "AcctName", "Nation": "NATION"})


def drop_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return drop_matching(part.withColumnsRenamed({"p_type": "unknown_1", "p_size": "is_unknowable", "p_brand": "UNKNOWN"}))


def cast_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    return text_matching(
        orders.select(
            "o_orderkey",
            F.when(F.col("o_orderkey") % 5 != 0, day).alias("orderdate"),
            F.col("o_custkey").alias("updater"),
            F.col("o_totalprice").alias("price"),
        )
    )


TOKEN_CASES = ["NA", " NA ", "null", "#N/A N/A", "-1.#IND", "Na", "", "0", "None", "nan"]


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.element_at(F.array(*[F.lit(t) for t in TOKEN_CASES]), (F.col("p_partkey") % 12 + 1).cast("int"))
    text = F.when(F.col("p_partkey") % 12 < 10, token).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("text")).select(
        "p_partkey", F.expr(null_if_token("text")).alias("value")
    )


def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.col("p_partkey") % 4 == 0
    part = table(spark, sf_dir, "part")
    return drop_empty_rows(
        part.select(*[F.when(~gone, F.col(c)).alias(c) for c in ("p_partkey", "p_name")],
                    F.when(F.col("p_partkey") % 8 == 0, F.col("p_size")).alias("p_size"))
    )


def union_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    status = F.col("o_orderstatus")
    return union_by_name(
        [
            orders.filter(status == "F"),
            orders.filter(status == "O").select("o_totalprice", "o_orderkey", "o_orderstatus"),
            orders.filter(~status.isin("F", "O")).select("o_orderstatus", "o_totalprice", "o_orderkey"),
        ]
    )


def rownum_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return number_rows(orders, ["o_orderstatus", "o_orderkey"])


def rownum_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers over the files of a feed, after rows without values are gone."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    kept = F.col("l_linenumber") != 4
    line = F.when(kept, delimited(",", *[F.col(c) for c in order])).otherwise(F.lit(",NA,null,"))
    folder = write_lines(in_order(table(spark, sf_dir, "lineitem"), *order), line, "lineitem-gaps", top=",".join(order))
    return scan_feed(spark, feed({name: name for name in order}), folder)


def route_by_filetype(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_orderstatus")
    number = F.when(kind == "F", 1).when(kind == "O", 2).when(F.col("o_orderkey") % 2 == 0, 3).otherwise(4)
    routed = route(table(spark, sf_dir, "orders").select(number.alias("filetypeid"), "o_totalprice"))
    return routed.groupBy("filetypeid", "target").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "rename_positional": rename_positional,
    "rename_by_header": rename_header,
    "drop_unknown": drop_unknown,
    "cast_dates": cast_dates,
    "null_tokens": null_tokens,
    "drop_all_null": drop_all_null,
    "union_by_name": union_frames,
    "rownum_global": rownum_global,
    "rownum_staged": rownum_staged,
    "route_by_filetype": route_by_filetype,
}

ORACLES = {
    "rename_positional": """
        SELECT c_custkey AS c_name, c_name AS c_custkey, c_nationkey AS nation, c_acctbal AS balance,
               c_mktsegment AS segment
        FROM customer""",
    "rename_by_header": "SELECT c_custkey AS acctid, c_name AS acctname, c_nationkey AS nation FROM customer",
    "drop_unknown": 'SELECT p_partkey, p_name, p_brand AS "UNKNOWN", p_retailprice FROM part',
    "cast_dates": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y%m%d') END AS orderdate,
               CAST(o_custkey AS VARCHAR) AS updater, o_totalprice AS price
        FROM orders""",
    "null_tokens": """
        SELECT p_partkey, CASE p_partkey % 12 WHEN 1 THEN ' NA ' WHEN 5 THEN 'Na' WHEN 7 THEN '0'
                               WHEN 10 THEN p_name WHEN 11 THEN p_name END AS value
        FROM part""",
    "drop_all_null": """
        SELECT CASE WHEN p_partkey % 4 <> 0 THEN p_partkey END AS p_partkey,
               CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS p_name,
               CASE WHEN p_partkey % 8 = 0 THEN p_size END AS p_size
        FROM part WHERE p_partkey % 4 <> 0 OR p_partkey % 8 = 0""",
    "union_by_name": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "rownum_global": """
        SELECT o_orderkey, o_orderstatus,
               CAST(row_number() OVER (ORDER BY o_orderstatus, o_orderkey) AS BIGINT) AS rownum
        FROM orders""",
    "rownum_staged": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
               CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS rownum
        FROM lineitem WHERE l_linenumber <> 4""",
    "route_by_filetype": """
        SELECT filetypeid, CASE filetypeid WHEN 1 THEN 'Raw_Accounts' WHEN 2 THEN 'Raw_Trades'
                                           WHEN 3 THEN 'Raw_Balances' END AS target, count(*) AS n
        FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2
                          WHEN o_orderkey % 2 = 0 THEN 3 ELSE 4 END AS filetypeid
              FROM orders) AS o
        GROUP BY filetypeid""",
}
