"""Files as rows: discovery, registry, rejection, staging, sinks and the stream."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.render import delimited, spread, table, write_files, write_lines
from catalog.scans import CUSTOMER_MAPPING, ORDER_FIELDS, customer_line, feed, order_line
from tidegate.functions.paths import base_name
from tidegate.operators.registry import assign_ids, disposition, latest_status, registry_rows
from tidegate.plans.batch import discover, register, run_load
from tidegate.plans.commits import Loading
from tidegate.plans.config import load_feeds, unmapped_configs
from tidegate.plans.stage import profile_paths, staged_rows
from tidegate.plans.stores import ParquetStore
from tidegate.plans.summary import load_summary
from tidegate.session import list_names, new_folder, settle
from tidegate.sources.jdbc import read_table, write_table
from tidegate.sources.listing import match_files
from tidegate.streaming.pickup import pick_up, pick_up_feeds

CONFIG_SCHEMA = (
    "clientfileconfigid int, clientid int, filetypeid int, srcfilepath string, filemask string, columnstring string, "
    "hasheader boolean, headerrownumber int, datastartingrownumber int, textdelimiter string, fileextension string"
)
MAPPING_SCHEMA = (
    "fixedwidth_field_mapping_id int, client_file_config_id int, starting_position int, length int, field_mapped_to string"
)


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file key per document, in the folder of its source."""
    key = F.concat_ws("/", F.lit("s3://bucket-1/in"), "source", F.concat("lang", F.lit("_"), "doc_id", F.lit(".csv")))
    return table(spark, sf_dir, "documents").select("doc_id", key.alias("key"))


def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    configs = documents.groupBy("source").agg(F.min("doc_id").alias("clientfileconfigid")).select(
        "clientfileconfigid",
        F.concat(F.lit("s3://bucket-1/in/"), "source", F.lit("/")).alias("srcfilepath"),
        F.when(F.col("clientfileconfigid") % 3 == 0, "en_*.csv")
        .when(F.col("clientfileconfigid") % 3 == 1, "*")
        .otherwise("1*").alias("filemask"),
    )
    return match_files(document_files(spark, sf_dir), settle(configs, "configs")).select("clientfileconfigid", "doc_id", "key")


def listed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as real files, one each, in three folders: some without bytes, some with hidden names. The files
    each folder's feed takes, and what a run says about those it cannot read."""
    key = F.col("s_suppkey")
    supplier = table(spark, sf_dir, "supplier").select(
        key.alias("number"),
        F.concat(F.lit("client "), key % 4 % 3).alias("segment"),
        F.when(key % 5 == 0, F.lit("_")).when(key % 7 == 0, F.lit(".")).otherwise(F.lit("")).alias("mark"),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(key, F.lit("|x\n"))).alias("content"),
    )
    root = new_folder(spark, "clients")
    write_files(supplier, root)
    names = sorted(list_names(spark, root))
    configs = spark.createDataFrame(
        [(i, 1, 1, f"{root}/{name}/", "c 1*", "{0: 'ID', 1: 'X'}", False, 0, None, "|", "csv") for i, name in enumerate(names)],
        CONFIG_SCHEMA,
    )
    load = run_load(spark, configs, None, ParquetStore(new_folder(spark, "warehouse")))
    reason = load.events.select("fileid", "reason", F.col("rows").alias("n_rows"))
    return load.files.join(reason, "fileid").select(
        F.element_at(F.split("directory", "/"), -1).alias("segment"), base_name(F.col("key")).alias("name"),
        "file_size", "reason", "n_rows",
    )


def file_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per customer, a config per nation."""
    key = F.concat(F.lit("s3://bucket/in/acme/"), F.lower("c_mktsegment"), F.lit("."), "c_custkey", F.lit(".csv"))
    files = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("clientfileconfigid"),
        (F.col("c_custkey") % 9).alias("clientid"),
        (F.col("c_custkey") % 3 + 1).alias("filetypeid"),
        key.alias("key"),
        key.alias("file_path"),
        F.lit("s3://bucket/in/acme").alias("directory"),
        F.timestamp_seconds(F.col("c_custkey")).alias("modified"),
        (F.col("c_custkey") * 10).alias("file_size"),
    )
    return registry_rows(assign_ids(files, last_id=100)).drop("lastupdateddatetime")


def stage_with_fileid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged customers, each led back through its file id to the file it came from."""
    customer = table(spark, sf_dir, "customer")
    top = ",".join(CUSTOMER_MAPPING)
    folders = {
        segment: write_lines(spread(customer.filter(condition)), customer_line(), f"customer-{segment}", top)
        for segment, condition in (
            ("auto", F.col("c_mktsegment").eqNullSafe("AUTOMOBILE")),
            ("rest", ~F.col("c_mktsegment").eqNullSafe("AUTOMOBILE")),
        )
    }
    feeds = [feed(CUSTOMER_MAPPING, srcfilepath=f, clientfileconfigid=i) for i, f in enumerate(folders.values())]
    files = register(spark, discover(spark, feeds), ParquetStore(new_folder(spark, "registry")), "load")
    found = profile_paths(spark, feeds[0], list(folders.values()))
    return (
        staged_rows(found, files)
        .join(files.select("fileid", "clientfileconfigid"), "fileid")
        .select("acctid", "acctname", "clientid", "clientfileconfigid")
    )


def file_status_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("processstatus"), "event_id")
    return latest_status(log, ["user_id"], order="event_id")


def order_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per order; open ones have no outcome yet."""
    status = F.when(F.col("o_orderstatus") == "F", "InStage").when(F.col("o_orderstatus") == "P", "Rejected")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", status.alias("processstatus"))


def disposition_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("s3://bucket/in/acme/"), "o_custkey", F.lit("_"), "o_orderkey", F.lit(".csv"))
    return disposition(order_outcomes(spark, sf_dir).withColumn("key", key)).drop("o_custkey")


def load_summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    configs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("clientfileconfigid"))
    outcomes = order_outcomes(spark, sf_dir).select(
        F.col("o_custkey").alias("clientfileconfigid"), "processstatus", (F.col("o_orderkey") % 100).alias("rows")
    )
    return load_summary(configs, outcomes)


def arity_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority: files with wide rows, a short header, narrow rows, an unknown header, or nothing wrong."""
    orders = table(spark, sf_dir, "orders")
    columns = [F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")]
    narrow = F.when(F.col("o_orderkey") % 2 == 0, delimited(",", *columns)).otherwise(delimited(",", *columns[:3]))
    shapes = {
        "1": (delimited(",", *columns, F.col("o_orderpriority")), "Key,Customer,Status,Price"),
        "2": (delimited(",", *columns), "Key,Customer,Status"),
        "3": (narrow, "Price,Key,Customer,Status"),
        "4": (delimited(",", *columns), "Key,Customer,Status,Total"),
        "5": (delimited(",", *columns), "Key,Customer,Status,Price"),
    }
    folders = {}
    for number, (line, top) in shapes.items():
        part = orders.filter(F.col("o_orderpriority").startswith(number))
        folders[number] = write_lines(spread(part), line, f"priority-{number}", top)
    mapping = {"Key": "KEY", "Customer": "CUSTOMER", "Status": "STATUS", "Price": "PRICE"}
    found = profile_paths(spark, feed(mapping), list(folders.values()))
    priority = F.regexp_extract("file_path", "/priority-([0-9])", 1)
    return found.files.groupBy(priority.alias("priority"), "problem").agg(F.sum("rows").alias("n_rows"))


def unmapped_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files (customers) of the configs (nations) for which no field (supplier) is mapped."""
    configs = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("clientfileconfigid"), "n_name")
    rich = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") % 3 > 0)
    mapping = rich.select(F.col("s_nationkey").alias("client_file_config_id"))
    files = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("clientfileconfigid"))
    return files.join(unmapped_configs(configs, mapping), "clientfileconfigid").select(
        "c_custkey", "clientfileconfigid", F.lit("Rejected").alias("processstatus")
    )


def three_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Configs and mapping of accounts, balances and trades: two delimited feeds, a fixed-width one, and one that cannot be read."""
    accounts = write_lines(
        spread(table(spark, sf_dir, "customer")), customer_line(), "load-accounts", ",".join(CUSTOMER_MAPPING)
    )
    columns = [F.col(c) for c in ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")]
    balances = write_lines(spread(table(spark, sf_dir, "supplier")), delimited("|", *columns), "load-balances")
    trades = write_lines(spread(table(spark, sf_dir, "orders")), order_line(), "load-trades")
    configs = spark.createDataFrame(
        [
            (1, 7, 1, accounts + "/", "part-*", repr(CUSTOMER_MAPPING), True, 1, None, ",", "csv"),
            (2, 7, 3, balances + "/", "part-*", "{0: 'SUPPID', 1: 'UNKNOWN', 2: 'NATION', 3: 'BALANCE'}", False, 0, None, "|", "csv"),
            (3, 8, 2, trades + "/", "*", "", False, 0, 1, "fixedwidth", "txt"),
            (4, 8, 2, trades + "/", "part-*", "", False, 0, 1, "fixedwidth", "txt"),
        ],
        CONFIG_SCHEMA,
    )
    mapping = spark.createDataFrame(
        [
            (i, 3, spec["start_pos"] + 2, spec["end_pos"] - spec["start_pos"], spec["field_mapped_to"])
            for i, spec in enumerate(ORDER_FIELDS)
        ],
        MAPPING_SCHEMA,
    )
    return configs, mapping


def load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts, balances and trades from two delimited feeds and a fixed-width one, in one run."""
    store = ParquetStore(new_folder(spark, "warehouse"))
    load = run_load(spark, *three_feeds(spark, sf_dir), store)
    staged = None
    for name, amount in (("Raw_Accounts", "balance"), ("Raw_Balances", "balance"), ("Raw_Trades", "o_totalprice")):
        rows = store.read(spark, name).agg(
            F.lit(name).alias("target"),
            F.max("rownum").alias("last_rownum"),
            F.round(F.sum(amount), 2).alias("amount"),
            F.count_distinct("rownum").alias("n_rownums"),
        )
        staged = rows if staged is None else staged.unionByName(rows)
    joined = load.outcomes.join(staged, "target").withColumn("clean", F.col("files_rejected") == 0)
    return joined.selectExpr(
        "clientfileconfigid", "outcome", "reason", "target", "clean", "rows_staged",
        "CASE WHEN rows_staged > 0 THEN last_rownum END AS last_rownum",
        "CASE WHEN rows_staged > 0 THEN n_rownums END AS n_rownums",
        "CASE WHEN rows_staged > 0 THEN amount END AS amount",
    )


def stream_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds of `load_all` through one stream, each staged row led back through its file id to its feed's config,
    with the files' statuses."""
    store = ParquetStore(new_folder(spark, "warehouse"))
    feeds = load_feeds(*three_feeds(spark, sf_dir))
    pick_up_feeds(spark, feeds, store, new_folder(spark, "checkpoint")).awaitTermination()
    keys = {"Raw_Accounts": ("acctid", "balance"), "Raw_Balances": ("suppid", "balance"), "Raw_Trades": ("o_orderkey", "o_totalprice")}
    parts = [
        store.read(spark, name).select(
            F.lit(name).alias("target"), F.col(key).alias("number"), F.col(amount).alias("amount"), "fileid", "clientid", "rownum"
        )
        for name, (key, amount) in keys.items()
    ]
    rows = reduce(DataFrame.unionByName, parts)
    numbers = rows.groupBy("target").agg(F.max("rownum").alias("last"), F.count_distinct("rownum").alias("n_rownums"))
    files = store.read(spark, "Files").select("fileid", F.col("cleintconfigid").alias("clientfileconfigid"))
    events = store.read(spark, "FileStatus").select("fileid", "processstatus", "reason")
    staged = files.join(events, "fileid").join(rows.drop("rownum").join(numbers, "target"), "fileid", "left")
    good = staged.filter("processstatus = 'InStage'").drop("fileid")
    # the feed that cannot be read has the same files, all rejected
    bad = staged.filter("processstatus = 'Rejected'").drop("fileid").distinct()
    return good.unionByName(bad)


def supplier_files(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, DataFrame]:
    """Suppliers as files, and the config that takes them."""
    columns = [F.col(c) for c in ("s_suppkey", "s_name")]
    folder = write_lines(spread(table(spark, sf_dir, "supplier")), delimited("|", *columns), label)
    config = (1, 7, 3, folder + "/", "part-*", "{0: 'SUPPID', 1: 'NAME'}", False, 0, None, "|", "csv")
    return folder, spark.createDataFrame([config], CONFIG_SCHEMA)


def rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers staged by the first of two equal runs; the second finds nothing new."""
    _, configs = supplier_files(spark, sf_dir, "rerun")
    store = ParquetStore(new_folder(spark, "warehouse"))
    run_load(spark, configs, None, store)
    again = run_load(spark, configs, None, store)
    outcome = again.outcomes.select("clientfileconfigid", F.col("outcome").alias("second_run"))
    rows = store.read(spark, "Raw_Balances").withColumn("clientfileconfigid", F.lit(1))
    return rows.join(outcome, "clientfileconfigid").select("suppid", "name", "second_run")


class ClosedStore(ParquetStore):
    """A store whose staging tables cannot be written."""

    def append(self, df: DataFrame, table: str, loading: Loading) -> None:
        if table.startswith("Raw_"):
            raise OSError("table is closed")
        super().append(df, table, loading)


def retry_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers whose first load failed at the table, staged by the next run."""
    _, configs = supplier_files(spark, sf_dir, "retry")
    root = new_folder(spark, "warehouse")
    failed = run_load(spark, configs, None, ClosedStore(root))
    store = ParquetStore(root)
    run_load(spark, configs, None, store)
    outcome = failed.outcomes.select("clientfileconfigid", F.concat_ws(": ", "outcome", "reason").alias("first_run"))
    rows = store.read(spark, "Raw_Balances").withColumn("clientfileconfigid", F.lit(1))
    return rows.join(outcome, "clientfileconfigid").select("suppid", "name", "first_run")


def load_twice_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers staged by five runs: one that fails, then without names, with names, and with keys that
    are no integers; the last goes into a table whose keys are given as integers."""
    supplier = table(spark, sf_dir, "supplier")
    lines = {
        1: delimited("|", F.concat(F.lit("k"), "s_suppkey"), F.col("s_name")),
        2: delimited("|", F.col("s_suppkey"), F.lit("")),
        3: delimited("|", F.col("s_suppkey"), F.col("s_name")),
        4: delimited("|", F.col("s_suppkey") + 0.5, F.col("s_name")),
    }
    root = new_folder(spark, "warehouse")
    stores = {1: ClosedStore(root), 5: ParquetStore(new_folder(spark, "warehouse"), {"Raw_Balances": {"suppid": "bigint"}})}
    open_store, reasons = ParquetStore(root), None
    for number in (1, 2, 3, 4, 5):
        folder = write_lines(spread(supplier), lines[min(number, 4)], f"twice-{number}")
        row = (number, number, 3, folder + "/", "part-*", "{0: 'SUPPID', 1: 'NAME'}", False, 0, None, "|", "csv")
        configs = spark.createDataFrame([row], CONFIG_SCHEMA)
        load = run_load(spark, configs, None, stores.get(number, open_store))
        outcome = load.outcomes.join(load.events.select("clientfileconfigid", F.col("reason").alias("why")), "clientfileconfigid", "left")
        found = outcome.select("clientfileconfigid", F.coalesce("why", "reason").alias("reason")).distinct()
        reasons = found if reasons is None else reasons.unionByName(found)
    rows = open_store.read(spark, "Raw_Balances").select("suppid", "name", F.col("clientid").alias("clientfileconfigid"))
    return settle(reasons, "reasons").join(rows, "clientfileconfigid", "left").select(
        "clientfileconfigid", "reason", "suppid", "name"
    )


STEPS = ("intent", "rows begun", "rows", "events", "commit begun", "commit")


class BreakingStore(ParquetStore):
    """A store that dies at one step of a load, which the number of its feed picks."""

    def breaks(self, loading: Loading, step: str) -> None:
        if loading.feed.isdigit() and STEPS[int(loading.feed)] == step:
            raise OSError(f"died at {step}")

    def begin(self, spark: SparkSession, loading: Loading) -> None:
        super().begin(spark, loading)
        self.breaks(loading, "intent")

    def append(self, df: DataFrame, table: str, loading: Loading) -> None:
        if table.startswith("Raw_"):
            if loading.feed.isdigit() and STEPS[int(loading.feed)] == "rows begun":
                super().append(df.filter("suppid % 2 = 0"), table, loading)
            self.breaks(loading, "rows begun")
        super().append(df, table, loading)
        self.breaks(loading, "rows" if table.startswith("Raw_") else "events")

    def commit(self, spark: SparkSession, loading: Loading) -> None:
        self.breaks(loading, "commit begun")
        super().commit(spark, loading)
        self.breaks(loading, "commit")


def exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers sent by one client per step of a load: the first run dies at that step, the second one goes
    through. Per client the staged rows, the outcomes recorded and the registry's rows per file."""
    columns = [F.col(c) for c in ("s_suppkey", "s_name")]
    folder = write_lines(spread(table(spark, sf_dir, "supplier")), delimited("|", *columns), "once")
    mapping = "{0: 'SUPPID', 1: 'NAME'}"
    configs = spark.createDataFrame(
        [(i, i, 3, folder + "/", "part-*", mapping, False, 0, None, "|", "csv") for i in range(len(STEPS))], CONFIG_SCHEMA
    )
    root = new_folder(spark, "warehouse")
    first = run_load(spark, configs, None, BreakingStore(root))
    store = ParquetStore(root)
    second = run_load(spark, configs, None, store)
    runs = first.outcomes.select("clientfileconfigid", F.col("reason").alias("first_run")).join(
        second.outcomes.select("clientfileconfigid", F.col("outcome").alias("second_run")), "clientfileconfigid"
    )
    events = store.read(spark, "FileStatus").groupBy("fileid").agg(F.count(F.lit(1)).alias("n_events"))
    files = store.read(spark, "Files").groupBy(F.col("cleintconfigid").alias("clientfileconfigid"), "file_path").agg(
        F.count(F.lit(1)).alias("n_registered"), F.max("fileid").alias("fileid")
    )
    rows = store.read(spark, "Raw_Balances")
    return rows.join(files.join(events, "fileid"), "fileid").join(runs, "clientfileconfigid").select(
        "clientfileconfigid", "first_run", "second_run", "suppid", "name", "n_events", "n_registered"
    )


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers appended to a table and read back in ranges.

    The database lives inside this process, so executors in other processes could
    not reach it: the query is for local mode, the two functions it calls are not.
    """
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("the in-process database of this query is only visible in local mode")
    java = spark._jvm.java.lang.System
    java.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:memory:tidegate{uuid.uuid4().hex};create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    customer = table(spark, sf_dir, "customer")
    write_table(customer, url, "Raw_Accounts", connections=4, **driver)
    last = customer.agg(F.max("c_custkey")).first()[0]
    rows = read_table(spark, url, "Raw_Accounts", split_on="c_custkey", bounds=(0, last), partitions=4, **driver)
    return rows.toDF(*[name.lower() for name in rows.columns])


def stream_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders staged by a file stream in several batches."""
    columns = [F.col(c) for c in ("o_orderkey", "o_orderstatus", "o_totalprice")]
    folder = write_lines(spread(table(spark, sf_dir, "orders")), delimited(",", *columns), "orders-stream", "Key,Status,Price")
    store = ParquetStore(new_folder(spark, "warehouse"))
    mapping = {"Key": "ORDERKEY", "Status": "STATUS", "Price": "PRICE"}
    half = max(spark.sparkContext.defaultParallelism // 2, 1)
    query = pick_up(
        spark,
        feed(mapping, srcfilepath=folder),
        store,
        new_folder(spark, "checkpoint"),
        archive=new_folder(spark, "archive"),
        files_per_batch=half,
    )
    query.awaitTermination()
    return (
        store.read(spark, "Raw_Trades")
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("orderkey").alias("keys"))
    )


QUERIES = {
    "discover_files": discover_files,
    "listed_folders": listed_folders,
    "file_registry": file_registry,
    "stage_with_fileid": stage_with_fileid,
    "file_status_latest": file_status_latest,
    "disposition_manifest": disposition_manifest,
    "load_summary": load_summary_counts,
    "arity_reject": arity_reject,
    "unmapped_reject": unmapped_reject,
    "load_all": load_all,
    "rerun_idempotent": rerun_idempotent,
    "retry_after_failure": retry_after_failure,
    "load_twice_types": load_twice_types,
    "exactly_once": exactly_once,
    "jdbc_roundtrip": jdbc_roundtrip,
    "stream_pickup": stream_pickup,
    "stream_all": stream_all,
}

ORACLES = {
    "discover_files": """
        SELECT clientfileconfigid, doc_id, 's3://bucket-1/in/' || source || '/' || lang || '_' || doc_id || '.csv' AS key
        FROM documents
        JOIN (SELECT source, min(doc_id) AS clientfileconfigid FROM documents GROUP BY source) AS c USING (source)
        WHERE CASE clientfileconfigid % 3 WHEN 0 THEN lang = 'en' WHEN 1 THEN true
                   ELSE contains('in/' || source || '/' || lang || '_' || doc_id || '.csv', '1') END""",
    "listed_folders": """
        SELECT segment, name, strlen(content) AS file_size,
               CASE WHEN mark <> '' THEN 'hidden file name' WHEN content = '' THEN 'empty file' END AS reason,
               CAST(CASE WHEN mark = '' AND content <> '' THEN 1 ELSE 0 END AS BIGINT) AS n_rows
        FROM (SELECT 'client ' || s_suppkey % 4 % 3 AS segment, mark || 'c ' || s_suppkey || '.csv' AS name, mark,
                     CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_suppkey || '|x' || chr(10) END AS content
              FROM (SELECT *, CASE WHEN s_suppkey % 5 = 0 THEN '_' WHEN s_suppkey % 7 = 0 THEN '.' ELSE '' END AS mark
                    FROM supplier))
        WHERE contains(name, 'c 1')""",
    "file_registry": """
        SELECT CAST(100 + row_number() OVER (
                   ORDER BY c_nationkey, 's3://bucket/in/acme/' || lower(c_mktsegment) || '.' || c_custkey || '.csv'
               ) AS BIGINT) AS fileid,
               c_custkey % 9 AS clientid, c_custkey % 3 + 1 AS filetypeid,
               lower(c_mktsegment) || '.' || c_custkey || '.csv' AS filename,
               's3://bucket/in/acme' AS filelocation, CAST(NULL AS VARCHAR) AS filecreatedby,
               strftime(make_timestamp(c_custkey * 1000000), '%Y-%m-%d %H:%M:%S') AS filelastmodifieddate,
               strftime(make_timestamp(c_custkey * 1000000), '%Y-%m-%d %H:%M:%S') AS createddatetime,
               c_nationkey AS cleintconfigid,
               's3://bucket/in/acme/' || lower(c_mktsegment) || '.' || c_custkey || '.csv' AS file_path,
               c_custkey * 10 AS file_size, c_custkey * 1000000 AS changed
        FROM customer""",
    "stage_with_fileid": """
        SELECT c_custkey AS acctid, c_name AS acctname, CAST(7 AS INTEGER) AS clientid,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 0 ELSE 1 END AS clientfileconfigid
        FROM customer""",
    "file_status_latest": """
        SELECT user_id, arg_max(event_type, event_id) AS processstatus FROM events GROUP BY user_id""",
    "disposition_manifest": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'InStage' WHEN 'P' THEN 'Rejected' END AS processstatus,
               's3://bucket/in/acme/' || o_custkey || '_' || o_orderkey || '.csv' AS key,
               CASE o_orderstatus
                    WHEN 'F' THEN 's3://bucket/in/acme/Processed/' || o_custkey || '_' || o_orderkey || '.csv'
                    WHEN 'P' THEN 's3://bucket/in/acme/Rejected/' || o_custkey || '_' || o_orderkey || '.csv'
               END AS destination
        FROM orders""",
    "load_summary": """
        SELECT c_custkey AS clientfileconfigid, count(*) FILTER (o_orderstatus = 'F') AS files_staged,
               count(*) FILTER (o_orderstatus = 'P') AS files_rejected,
               CAST(coalesce(sum(o_orderkey % 100) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS rows_staged
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey""",
    "arity_reject": """
        SELECT substr(o_orderpriority, 1, 1) AS priority,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'row wider than the columns'
                    WHEN '2' THEN 'column count differs from the mapping'
                    WHEN '4' THEN 'unknown header name' END AS problem,
               count(*) AS n_rows
        FROM orders GROUP BY 1, 2""",
    "unmapped_reject": """
        SELECT c_custkey, c_nationkey AS clientfileconfigid, 'Rejected' AS processstatus
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_nationkey % 3 > 0)""",
    "load_all": """
        SELECT 1 AS clientfileconfigid, 'staged' AS outcome, CAST(NULL AS VARCHAR) AS reason,
               'Raw_Accounts' AS target, true AS clean, count(*) AS rows_staged, count(*) AS last_rownum,
               count(*) AS n_rownums, round(sum(c_acctbal), 2) AS amount
        FROM customer
        UNION ALL
        SELECT 2, 'staged', NULL, 'Raw_Balances', true, count(*), count(*), count(*), round(sum(s_acctbal), 2)
        FROM supplier
        UNION ALL
        SELECT 3, 'staged', NULL, 'Raw_Trades', true, count(*), count(*), count(*), round(sum(o_totalprice), 2)
        FROM orders
        UNION ALL
        SELECT 4, 'nothing staged', 'no fixed-width mapping', 'Raw_Trades', false, 0, NULL, NULL, NULL""",
    "rerun_idempotent": "SELECT s_suppkey AS suppid, s_name AS name, 'no files' AS second_run FROM supplier",
    "retry_after_failure": """
        SELECT s_suppkey AS suppid, s_name AS name, 'failed: table is closed' AS first_run FROM supplier""",
    "load_twice_types": """
        SELECT 1 AS clientfileconfigid, 'table is closed' AS reason, CAST(NULL AS DOUBLE) AS suppid, CAST(NULL AS VARCHAR) AS name
        UNION ALL SELECT 2, NULL, s_suppkey, NULL FROM supplier
        UNION ALL SELECT 3, NULL, s_suppkey, s_name FROM supplier
        UNION ALL SELECT 4, NULL, s_suppkey + 0.5, s_name FROM supplier
        UNION ALL SELECT 5, 'values do not fit the types of the staging table', NULL, NULL""",
    "exactly_once": """
        SELECT CAST(i AS INTEGER) AS clientfileconfigid, 'died at ' || step AS first_run,
               CASE WHEN step = 'commit' THEN 'no files' ELSE 'staged' END AS second_run,
               s_suppkey AS suppid, s_name AS name, CAST(1 AS BIGINT) AS n_events, CAST(1 AS BIGINT) AS n_registered
        FROM supplier, (VALUES (0, 'intent'), (1, 'rows begun'), (2, 'rows'), (3, 'events'), (4, 'commit begun'), (5, 'commit'))
             AS steps(i, step)""",
    "jdbc_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "stream_pickup": """
        SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
        FROM orders GROUP BY o_orderstatus""",
    "stream_all": """
        WITH rows AS (
            SELECT 1 AS clientfileconfigid, 'Raw_Accounts' AS target, c_custkey AS number, c_acctbal AS amount, 7 AS clientid FROM customer
            UNION ALL SELECT 2, 'Raw_Balances', s_suppkey, s_acctbal, 7 FROM supplier
            UNION ALL SELECT 3, 'Raw_Trades', o_orderkey, o_totalprice, 8 FROM orders)
        SELECT clientfileconfigid, 'InStage' AS processstatus, CAST(NULL AS VARCHAR) AS reason, target, number, amount, clientid,
               count(*) OVER (PARTITION BY target) AS last, count(*) OVER (PARTITION BY target) AS n_rownums
        FROM rows
        UNION ALL SELECT 4, 'Rejected', 'no fixed-width mapping', NULL, NULL, NULL, NULL, NULL, NULL""",
}
