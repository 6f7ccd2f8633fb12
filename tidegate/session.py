"""Where a job may keep its own tables, and how its scans are split."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
MIN_SPLITS = "spark.sql.files.minPartitionNum"
METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"
# Spark's default for the setting above, and the size the JVM compiles up to.
DEFAULT_METHOD_BYTES, COMPILED_METHOD_BYTES = 65535, 8000


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegate-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/tidegate/{label}-{uuid.uuid4().hex}"


def settle(
    df: DataFrame, label: str, compact: bool = False, session: SparkSession | None = None, one_group: bool = False
) -> DataFrame:
    """Write `df` to the shared folder and go on from the written table.

    The table outlives its executors, and values that depend on the task that made
    them stay as they were written. Unless `compact`, values are written plainly,
    so the file size that Spark compares with its broadcast threshold is their
    real size: below it a join broadcasts the table, beyond it both sides shuffle.
    The table is read in `session`, if it is to be another one than that of `df`. With
    `one_group` a file has one row group, so what a task wrote is read by one task.
    """
    spark = session or df.sparkSession
    path = new_folder(spark, label)
    plain = {"compression": "none", "parquet.enable.dictionary": "false"}
    group = {"parquet.block.size": str((1 << 31) - 1)} if one_group else {}
    df.write.options(**group, **({} if compact else plain)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tune_scans(spark: SparkSession) -> None:
    """Scan settings, where the session has none of its own.

    Split size otherwise follows the number of executors alive when each pass over
    the same files is planned, which changes under dynamic allocation. And feeds
    have many columns, so generated methods outgrow what the JVM compiles; beyond
    that size Spark's smaller ones are faster.
    """
    if spark.conf.get(MIN_SPLITS, None) is None:
        spark.conf.set(MIN_SPLITS, str(spark.sparkContext.defaultParallelism))
    if int(spark.conf.get(METHOD_BYTES)) == DEFAULT_METHOD_BYTES:
        spark.conf.set(METHOD_BYTES, str(COMPILED_METHOD_BYTES))


def hadoop_path(spark: SparkSession, path: str):
    """The file system of `path` and `path` itself, fully qualified."""
    raw = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = raw.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(raw)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, full = hadoop_path(spark, path)
    return fs.exists(full)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of control files, drafts of `write_once` aside; none if there is no folder."""
    fs, full = hadoop_path(spark, path)
    found = [entry.getPath().getName() for entry in fs.listStatus(full)] if fs.exists(full) else []
    return sorted(name for name in found if not name.startswith("."))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, full = hadoop_path(spark, path)
    stream = fs.open(full)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file that appears whole; False, and nothing changed, if it is there already."""
    fs, full = hadoop_path(spark, path)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(full.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), spark._jsc.hadoopConfiguration())
    replacing_none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, full, replacing_none)
        return True
    except Exception:
        fs.delete(draft, False)
        if fs.exists(full):
            return False
        raise


def delete_path(spark: SparkSession, path: str) -> None:
    fs, full = hadoop_path(spark, path)
    fs.delete(full, True)
