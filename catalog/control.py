"""Config and mapping tables, and the column rules applied to them."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.render import table
from tidegate.functions.mappings import has_unknown, header_names, key_order, key_places, mapping_entries, strip_names
from tidegate.functions.paths import (
    as_of_date,
    base_name,
    bucket,
    epoch_text,
    folder,
    reader_for,
    time_text,
)
from tidegate.plans.config import ALL_COLUMNS, config_json, header_flag, normalise_configs, split_configs
from tidegate.sources.fixed_width import field_specs


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A config row per customer, with every flag, some NULLs and both slashes."""
    key, n = F.col("c_custkey"), F.col("c_custkey") % 7
    return table(spark, sf_dir, "customer").select(
        key.alias("clientfileconfigid"),
        F.col("c_nationkey").alias("clientid"),
        (key % 4).cast("int").alias("filetypeid"),
        F.concat(F.lit("s3:\\\\in\\"), "c_mktsegment", F.lit("\\"), key.cast("string"), F.lit("/")).alias("srcfilepath"),
        F.concat(F.lower("c_mktsegment"), F.lit("_*.csv")).alias("filemask"),
        F.concat(F.lit("{'Acct': '"), "c_name", F.lit("'}")).alias("columnstring"),
        F.when(n < 3, False).when(n < 5, True).alias("hasheader"),
        F.when(n != 6, (key % 3).cast("int")).alias("headerrownumber"),
        F.when(key % 2 == 0, (key % 5).cast("int")).alias("datastartingrownumber"),
        F.element_at(
            F.array(*[F.lit(d) for d in (",", "fixedwidth", "|", "FIXEDWIDTH", "FixedWidth", None, "fixedWidth")]),
            (n + 1).cast("int"),
        ).alias("textdelimiter"),
        F.when(key % 2 == 0, "csv").otherwise("dat").alias("fileextension"),
    )


CONFIG_SQL = """
    SELECT c_custkey AS clientfileconfigid, c_nationkey AS clientid, CAST(c_custkey % 4 AS INTEGER) AS filetypeid,
           's3:\\\\in\\' || c_mktsegment || '\\' || c_custkey || '/' AS srcfilepath,
           lower(c_mktsegment) || '_*.csv' AS filemask,
           '{''Acct'': ''' || c_name || '''}' AS columnstring,
           CASE WHEN c_custkey % 7 < 3 THEN false WHEN c_custkey % 7 < 5 THEN true END AS hasheader,
           CASE WHEN c_custkey % 7 <> 6 THEN CAST(c_custkey % 3 AS INTEGER) END AS headerrownumber,
           CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 5 AS INTEGER) END AS datastartingrownumber,
           CASE c_custkey % 7 WHEN 0 THEN ',' WHEN 1 THEN 'fixedwidth' WHEN 2 THEN '|' WHEN 3 THEN 'FIXEDWIDTH'
                WHEN 4 THEN 'FixedWidth' WHEN 6 THEN 'fixedWidth' END AS textdelimiter,
           CASE WHEN c_custkey % 2 = 0 THEN 'csv' ELSE 'dat' END AS fileextension
    FROM customer"""

FLAG_SQL = "coalesce(hasheader OR headerrownumber <> 0, true) AS hasheader"
PATH_SQL = "replace(srcfilepath, '\\', '/') AS srcfilepath"


def config_header_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = header_flag(F.col("hasheader"), F.col("headerrownumber"))
    return configs(spark, sf_dir).select("clientfileconfigid", flag.alias("hasheader"))


def config_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_configs(configs(spark, sf_dir)).select("clientfileconfigid", "srcfilepath")


def config_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    delimited, fixed = split_configs(configs(spark, sf_dir))
    kinds = [delimited.withColumn("kind", F.lit("delimited")), fixed.withColumn("kind", F.lit("fixed"))]
    return kinds[0].unionByName(kinds[1], allowMissingColumns=True).select(*ALL_COLUMNS, "kind")


def config_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from JSON; a NULL field has no key in its text."""
    texts = config_json(configs(spark, sf_dir))
    return texts.select(
        F.get_json_object("json", "$.clientfileconfigid").cast("bigint").alias("clientfileconfigid"),
        F.get_json_object("json", "$.textdelimiter").alias("textdelimiter"),
        F.get_json_object("json", "$.headerrownumber").cast("int").alias("headerrownumber"),
        F.json_array_length(F.to_json(F.json_object_keys("json"))).alias("n_fields"),
    )


def mapping_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping row per customer, a config per nation."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("fixedwidth_field_mapping_id"),
        F.col("c_nationkey").alias("client_file_config_id"),
        (F.col("c_custkey") % 400 + 2).alias("starting_position"),
        F.length("c_mktsegment").alias("length"),
        F.col("c_name").alias("field_mapped_to"),
    )


def fixed_width_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_specs(mapping_rows(spark, sf_dir))


def schema_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping texts of all brands, their entries numbered in key order."""
    pair = F.concat(F.lit("'"), F.col("p_size").cast("string"), F.lit("': 'SIZE"), F.col("p_size").cast("string"), F.lit("'"))
    sizes = table(spark, sf_dir, "part").select("p_brand", pair.alias("pair")).distinct()
    texts = sizes.groupBy("p_brand").agg(
        F.concat(F.lit("{"), F.array_join(F.collect_list("pair"), ", "), F.lit("}")).alias("columnstring")
    )
    entries = key_order(mapping_entries(F.col("columnstring")))
    return texts.select("p_brand", F.posexplode(entries).alias("pos", "entry")).select(
        "p_brand", F.col("pos").cast("bigint").alias("pos"), F.col("entry.key").alias("source"), F.col("entry.value").alias("target")
    )


HEADER_KEYS = ["Acct No", "BUILDING", "MACHINERY", "Amt"]


def unknown_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header per customer against one mapping: is it known, and where are the keys."""
    cells = F.array(F.lit(" Acct No"), F.col("c_mktsegment"), F.lit("Amt "))
    names = strip_names(header_names(cells))
    return table(spark, sf_dir, "customer").select("c_custkey", names.alias("names")).select(
        "c_custkey",
        has_unknown(F.col("names"), HEADER_KEYS).alias("unknown"),
        F.concat_ws(",", key_places(F.col("names"), HEADER_KEYS)).alias("places"),
    )


def duplicate_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header per order with blank and repeated cells."""
    cells = F.array("o_orderstatus", F.lit(""), F.substring("o_orderpriority", 3, 1), F.lit("O"), F.lit("F"), F.lit(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(header_names(cells), "|").alias("names"))


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", bucket(url).alias("bucket"), folder(url).alias("folder"), base_name(url).alias("name")
    )


EXTENSIONS = ["csv", "xls", "xlsx", "dat", "txt", "csv.gz", "CSV"]


def format_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    extension = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("doc_id") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", reader_for(extension).alias("reader"))


def asof_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("acme."), day, F.lit("_orders.dat"))).when(
        F.col("o_orderkey") % 3 == 1, F.concat(F.lit("20"), F.substring(day, 3, 6), F.lit("_x.20991231.dat"))
    ).otherwise(F.concat(F.lit("acme_"), day, F.lit(".dat")))
    return table(spark, sf_dir, "orders").select("o_orderkey", as_of_date(name).alias("asofdate"))


def format_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_text(seconds).alias("epoch_text"), time_text(F.col("ts")).alias("time_text")
    )


QUERIES = {
    "config_header_flag": config_header_flag,
    "config_path": config_path,
    "config_feeds": config_feeds,
    "config_json": config_json_fields,
    "fixed_width_spec": fixed_width_spec,
    "schema_order": schema_order,
    "unknown_headers": unknown_headers,
    "duplicate_headers": duplicate_headers,
    "path_parts": path_parts,
    "format_dispatch": format_dispatch,
    "asof_date": asof_date,
    "format_epoch": format_epoch,
}

FIXED_SQL = "textdelimiter IN ('fixedwidth', 'FIXEDWIDTH', 'FixedWidth')"

ORACLES = {
    "config_header_flag": f"SELECT clientfileconfigid, {FLAG_SQL} FROM ({CONFIG_SQL}) AS c",
    "config_path": f"SELECT clientfileconfigid, {PATH_SQL} FROM ({CONFIG_SQL}) AS c",
    "config_feeds": f"""
        SELECT {PATH_SQL}, filemask, CASE WHEN NOT {FIXED_SQL} THEN columnstring END AS columnstring, {FLAG_SQL},
               clientfileconfigid, clientid, filetypeid, headerrownumber, textdelimiter, fileextension,
               CASE WHEN {FIXED_SQL} THEN datastartingrownumber END AS datastartingrownumber,
               CASE WHEN {FIXED_SQL} THEN 'fixed' ELSE 'delimited' END AS kind
        FROM ({CONFIG_SQL}) AS c WHERE textdelimiter IS NOT NULL""",
    "config_json": f"""
        SELECT clientfileconfigid, textdelimiter, headerrownumber,
               CAST(11 - (hasheader IS NULL)::INT - (headerrownumber IS NULL)::INT
                    - (datastartingrownumber IS NULL)::INT - (textdelimiter IS NULL)::INT AS INTEGER) AS n_fields
        FROM ({CONFIG_SQL}) AS c""",
    "fixed_width_spec": """
        SELECT c_nationkey AS client_file_config_id, c_custkey AS fixedwidth_field_mapping_id,
               c_custkey % 400 AS start_pos, c_custkey % 400 + length(c_mktsegment) AS end_pos,
               c_name AS field_mapped_to
        FROM customer""",
    "schema_order": """
        SELECT p_brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY size) - 1 AS BIGINT) AS pos,
               size AS source, 'SIZE' || size AS target
        FROM (SELECT DISTINCT p_brand, CAST(p_size AS VARCHAR) AS size FROM part) AS p""",
    "unknown_headers": """
        SELECT c_custkey, c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS unknown,
               '1,' || CASE c_mktsegment WHEN 'BUILDING' THEN '2,0' WHEN 'MACHINERY' THEN '0,2' ELSE '0,0' END
               || ',3' AS places
        FROM customer""",
    "duplicate_headers": """
        SELECT o_orderkey,
               o_orderstatus || '|Unnamed: 1|'
               || CASE WHEN p = o_orderstatus THEN p || '.1' ELSE p END || '|'
               || CASE (o_orderstatus = 'O')::INT + (p = 'O')::INT WHEN 0 THEN 'O' WHEN 1 THEN 'O.1' ELSE 'O.2' END || '|'
               || CASE (o_orderstatus = 'F')::INT + (p = 'F')::INT WHEN 0 THEN 'F' WHEN 1 THEN 'F.1' ELSE 'F.2' END
               || '|Unnamed: 5' AS names
        FROM (SELECT o_orderkey, o_orderstatus, substr(o_orderpriority, 3, 1) AS p FROM orders) AS o""",
    "path_parts": """
        SELECT page_id, split_part(url, '/', 3) AS bucket,
               array_to_string(list_slice(string_split(url, '/'), 1, len(string_split(url, '/')) - 1), '/') AS folder,
               list_extract(string_split(url, '/'), -1) AS name
        FROM pages""",
    "format_dispatch": """
        SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'delimited' WHEN 1 THEN 'excel' WHEN 2 THEN 'excel'
                            WHEN 3 THEN 'dat' WHEN 5 THEN 'delimited' END AS reader
        FROM documents""",
    "asof_date": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 3 = 0 AND year(o_orderdate) >= 2000 THEN strftime(o_orderdate, '%Y%m%d')
                    WHEN o_orderkey % 3 = 1 THEN '20' || substr(strftime(o_orderdate, '%Y%m%d'), 3, 6) END AS asofdate
        FROM orders""",
    "format_epoch": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS epoch_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text
        FROM events""",
}
