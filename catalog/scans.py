"""Sources: every way a feed's files are read."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.render import delimited, in_order, name_files, spread, table, write_lines
from tidegate.operators.numbering import count_blocks, number_lines, running_total
from tidegate.plans.config import feed_of
from tidegate.plans.stage import profile_paths, scan_feed
from tidegate.plans.stores import ParquetStore
from tidegate.session import delete_path, hadoop_path, new_folder, settle
from tidegate.sources.delimited import csv_options, read_delimited
from tidegate.sources.lines import read_lines
from tidegate.streaming.pickup import pick_up

BASE = {
    "clientfileconfigid": 1, "clientid": 7, "filetypeid": 2, "srcfilepath": "/", "filemask": "part-*",
    "hasheader": True, "headerrownumber": 1, "datastartingrownumber": None, "textdelimiter": ",",
    "fileextension": "csv", "columnstring": None,
}


def feed(mapping: dict | None = None, specs: list[dict] = (), **changes):
    row = BASE | ({"columnstring": repr(mapping)} if mapping else {}) | changes
    return feed_of(row, list(specs))


def field_rows(*fields: tuple[str, int]) -> list[dict]:
    """Field specs for consecutive fields behind one leading pad character."""
    rows, start = [], 1
    for name, length in fields:
        rows.append({"start_pos": start, "end_pos": start + length, "field_mapped_to": name})
        start += length
    return rows


ORDER_FIELDS = field_rows(
    ("o_orderkey", 20), ("o_custkey", 20), ("o_orderstatus", 1), ("o_totalprice", 24), ("o_orderdate", 8),
    ("o_orderpriority", 15),
)


def order_line():
    return F.concat(
        F.lit("#"),
        F.lpad(F.col("o_orderkey").cast("string"), 20, " "),
        F.lpad(F.col("o_custkey").cast("string"), 20, " "),
        F.col("o_orderstatus"),
        F.format_string("%24.2f", "o_totalprice"),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.rpad("o_orderpriority", 15, " "),
    )


def scan_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_lines(spread(table(spark, sf_dir, "orders")), order_line(), "orders-fixed", top="ORDERS\n")
    fixed = feed(specs=ORDER_FIELDS, textdelimiter="fixedwidth", datastartingrownumber=3, hasheader=False, headerrownumber=0)
    return scan_feed(spark, fixed, folder).drop("rownum")


CUSTOMER_MAPPING = {
    "Acct No": "ACCTID", "Name": "ACCTNAME", "Nation": "NATIONKEY", "Balance": "BALANCE", "Segment": "SEGMENT",
}


def customer_line():
    return delimited(",", *[F.col(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")])


def scan_delimited_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = "Acct No, Name ,Nation,Balance,Segment"
    folder = write_lines(spread(table(spark, sf_dir, "customer")), customer_line(), "customer-header", top)
    return scan_feed(spark, feed(CUSTOMER_MAPPING), folder).drop("rownum")


def scan_delimited_noheader(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = delimited(";", F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey"), F.col("s_acctbal"))
    folder = write_lines(spread(table(spark, sf_dir, "supplier")), line, "supplier-plain")
    mapping = {3: "BALANCE", 0: "SUPPID", 1: "SUPPNAME", 2: "NATIONKEY"}
    plain = feed(mapping, hasheader=False, headerrownumber=0, textdelimiter=";")
    return scan_feed(spark, plain, folder).drop("rownum")


LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)
LINEITEM_MAPPING = {name: name.upper() for name in (*LINEITEM, "l_shipdate")}


def lineitem_line():
    return delimited(",", *[F.col(c) for c in LINEITEM], F.date_format("l_shipdate", "yyyyMMdd"))


def write_lineitem(spark: SparkSession, sf_dir: str) -> str:
    top = "Line items, all\n \t\n" + ",".join(LINEITEM_MAPPING)
    return write_lines(spread(table(spark, sf_dir, "lineitem")), lineitem_line(), "lineitem-title", top)


def scan_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_lineitem(spark, sf_dir)
    return scan_feed(spark, feed(LINEITEM_MAPPING, headerrownumber=2), folder).drop("rownum")


def scan_permuted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one feed with their columns in different orders."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "yyyyMMdd"))
    names = {"o_orderkey": "Key", "o_custkey": "Customer", "o_totalprice": "Price", "day": "Date"}
    folders = []
    for status, columns in (("F", list(names)), ("O", list(names)[::-1]), ("P", ["day", "o_orderkey", "o_totalprice", "o_custkey"])):
        part = spread(orders.filter(F.col("o_orderstatus") == status))
        top = "|".join(names[c] for c in columns)
        folders.append(write_lines(part, delimited("|", *[F.col(c) for c in columns]), f"orders-{status}", top))
    mapping = {"Key": "ORDERKEY", "Customer": "CUSTKEY", "Price": "PRICE", "Date": "ORDERDATE"}
    return scan_feed(spark, feed(mapping, textdelimiter="|"), folders).drop("rownum")


def scan_dat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col(c) for c in ("event_id", "user_id", "event_type", "value", "props")]
    line = F.concat_ws("|", *columns, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    folder = write_lines(spread(table(spark, sf_dir, "events")), line, "events-dat", top="EVENTS|7|x")
    name_files(spark, folder, "acme.20240131_events.{:05d}.dat")
    mapping = {5: "EVENTID", 4: "USERID", 3: "EVENTTYPE", 2: "VALUE", 1: "PROPS", 0: "TS"}
    dat = feed(mapping, hasheader=False, headerrownumber=0, textdelimiter="|", fileextension="dat")
    return scan_feed(spark, dat, folder).drop("rownum")


def scan_native_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "part-csv")
    spread(table(spark, sf_dir, "part")).write.options(**csv_options("|"), header=True, quoteAll=True).csv(folder)
    part = read_delimited(spark, folder)
    return part.withColumns({"p_partkey": F.col("p_partkey").cast("bigint"), "p_size": F.col("p_size").cast("bigint")})


def scan_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, whose line breaks sit inside quoted fields."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    line = delimited(",", *[F.col(c) for c in names])
    folder = write_lines(spread(table(spark, sf_dir, "documents")), line, "documents", top=",".join(names))
    return scan_feed(spark, feed({name: name for name in names}), folder).drop("rownum")


# Bytes of a split, at least and at most, and the number of splits of a folder from which on they are larger.
SMALL_SPLIT, LARGEST_SPLIT, SPLITS = 64 << 10, 16 << 20, 256


def small_splits(spark: SparkSession, folder: str) -> SparkSession:
    """A session of its own that cuts the files of `folder` into many splits.

    Every split is a task of every pass: where files are large, splits grow with them first, then their number.
    What it writes as parquet is packed harder than by default.
    """
    fs, root = hadoop_path(spark, folder)
    size = min(max(SMALL_SPLIT, -(-fs.getContentSummary(root).getLength() // SPLITS)), LARGEST_SPLIT)
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    apart.conf.set("spark.sql.files.openCostInBytes", "1k")
    apart.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return apart


DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "flat")


def write_documents(spark: SparkSession, sf_dir: str, label: str, top: str) -> str:
    """Files of documents with line breaks in their texts, beside files of the same without.

    A table that is read by many tasks is put into as many files as `spread` makes, but without a shuffle.
    """
    documents = table(spark, sf_dir, "documents").withColumn("flat", F.lit(0))
    flat = documents.withColumns({"text": F.translate("text", "\r\n", "  "), "flat": F.lit(1)})
    n = spark.sparkContext.defaultParallelism
    many = documents.rdd.getNumPartitions() >= n
    rows = reduce(DataFrame.unionByName, [df.coalesce(n) if many else spread(df) for df in (documents, flat)])
    return write_lines(rows, delimited(",", *[F.col(c) for c in DOCUMENT_COLUMNS]), label, top)


def scan_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken and unbroken files in one feed, cut into splits that end inside texts, read in three ways.

    The files are several times as large as the table. The rows of the first two ways are
    written, and their files deleted, before those of the third way are made.
    """
    mapping = {name: name.upper() for name in DOCUMENT_COLUMNS}
    folder = write_documents(spark, sf_dir, "documents-mixed", ",".join(DOCUMENT_COLUMNS))
    apart = small_splits(spark, folder)
    batch = settle(scan_feed(apart, feed(mapping), folder), "batch", compact=True, session=spark)

    store = ParquetStore(new_folder(apart, "warehouse"))
    streamed = feed(mapping, srcfilepath=folder)
    pick_up(apart, streamed, store, new_folder(apart, "checkpoint")).awaitTermination()
    delete_path(spark, folder)

    dated = write_documents(spark, sf_dir, "documents-dat", "DOCUMENTS,7")
    name_files(spark, dated, "acme.20240131_documents.{:05d}.dat")
    places = dict(enumerate(name.upper() for name in DOCUMENT_COLUMNS))
    dat = feed(places, hasheader=False, headerrownumber=0, fileextension="dat")
    ways = {"batch": batch, "stream": store.read(spark, "Raw_Trades"), "dat": scan_feed(apart, dat, dated)}
    parts = [rows.select(F.lit(way).alias("way"), *DOCUMENT_COLUMNS, "rownum") for way, rows in ways.items()]
    found = reduce(DataFrame.unionByName, parts)
    # all numbers of a way are there once; a row per way is sent to the texts, not they to it
    top = found.groupBy("way").agg(F.max("rownum").alias("last"), F.count_distinct("rownum").alias("numbers"))
    return found.drop("rownum").join(F.broadcast(top), "way")


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines numbered in their file, plus the lines of the files before it."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    folder = write_lines(in_order(table(spark, sf_dir, "lineitem"), *order), lineitem_line(), "lineitem-order")
    lines = read_lines(spark, folder).withColumn("at", F.monotonically_increasing_id())
    blocks = settle(count_blocks(lines), "blocks")
    totals = blocks.groupBy("file_path").agg(F.sum("lines").alias("n"))
    files = running_total(totals, ["file_path"], "n", "earlier")
    cells = F.split("value", ",")
    return (
        number_lines(lines, blocks)
        .join(files.select("file_path", "earlier"), "file_path")
        .select(
            *[cells[LINEITEM.index(c)].cast("bigint").alias(c) for c in order],
            (F.col("earlier") + F.col("line_no")).alias("line_no"),
        )
    )


def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type every column of the rendered lineitem files gets, with the files' rows."""
    lineitem = feed(LINEITEM_MAPPING | {"l_shipdate": "L_SHIPDAY"}, headerrownumber=2)
    found = profile_paths(spark, lineitem, write_lineitem(spark, sf_dir))
    pairs = ", ".join(f"('{name}', '{found_type}')" for name, found_type in zip(lineitem.targets, found.types))
    return found.good.agg(F.sum("rows").alias("n_rows")).selectExpr(
        "n_rows", f"inline(array({pairs})) AS (column_name, column_type)"
    )


QUERIES = {
    "scan_fixed_width": scan_fixed_width,
    "scan_delimited_header": scan_delimited_header,
    "scan_delimited_noheader": scan_delimited_noheader,
    "scan_preamble": scan_preamble,
    "scan_permuted": scan_permuted,
    "scan_dat": scan_dat,
    "scan_native_csv": scan_native_csv,
    "scan_multi_line": scan_multi_line,
    "scan_quoted_breaks": scan_quoted_breaks,
    "line_numbers": line_numbers,
    "infer_types": infer_types,
}

ORACLES = {
    "scan_fixed_width": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS o_orderdate, o_orderpriority
        FROM orders""",
    "scan_delimited_header": """
        SELECT c_custkey AS acctid, c_name AS acctname, CAST(c_nationkey AS BIGINT) AS nationkey,
               c_acctbal AS balance, c_mktsegment AS segment
        FROM customer""",
    "scan_delimited_noheader": """
        SELECT s_suppkey AS suppid, s_name AS suppname, CAST(s_nationkey AS BIGINT) AS nationkey,
               s_acctbal AS balance
        FROM supplier""",
    "scan_preamble": """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
               CAST(strftime(l_shipdate, '%Y%m%d') AS VARCHAR) AS l_shipdate
        FROM lineitem""",
    "scan_permuted": """
        SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_totalprice AS price,
               strftime(o_orderdate, '%Y%m%d') AS orderdate
        FROM orders""",
    "scan_dat": """
        SELECT event_id AS eventid, user_id AS userid, event_type AS eventtype, value, props,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, '20240131' AS asofdate
        FROM events""",
    "scan_native_csv": """
        SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""",
    "scan_multi_line": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "scan_quoted_breaks": """
        SELECT way, doc_id, CASE flat WHEN 0 THEN text ELSE replace(replace(text, chr(13), ' '), chr(10), ' ') END AS text,
               lang, source, n_chars, CAST(flat AS BIGINT) AS flat,
               (SELECT 2 * count(*) FROM documents) AS last, (SELECT 2 * count(*) FROM documents) AS numbers
        FROM documents, (VALUES ('batch'), ('stream'), ('dat')) AS ways(way), (VALUES (0), (1)) AS kinds(flat)""",
    "line_numbers": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
               CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS line_no
        FROM lineitem""",
    "infer_types": """
        SELECT column_name, column_type, (SELECT count(*) FROM lineitem) AS n_rows
        FROM (VALUES ('l_orderkey', 'bigint'), ('l_partkey', 'bigint'), ('l_suppkey', 'bigint'),
                     ('l_linenumber', 'bigint'), ('l_quantity', 'double'), ('l_extendedprice', 'double'),
                     ('l_discount', 'double'), ('l_tax', 'double'), ('l_returnflag', 'string'),
                     ('l_linestatus', 'string'), ('l_shipday', 'bigint')) AS t (column_name, column_type)""",
}
