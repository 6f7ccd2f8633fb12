"""Which files a feed takes."""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.functions.paths import base_name, decoded_path, folder, mask_text, object_key
from tidegate.session import hadoop_path, path_exists, settle

SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def literal_glob(text: str, special: str = "\\[]{},*?") -> str:
    return "".join("\\" + c if c in special else c for c in text)


def is_hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


# Names that may be hidden, as a glob.
MAYBE_HIDDEN = "{.*,_*,*._COPYING_}"
# Between texts that come in one: no path contains it.
NUL = "\0"


def hidden_files(spark: SparkSession, folders: list[str]) -> list[tuple[str, str, int, int]]:
    """Files whose names Spark's file sources pass over. The file system picks them; only they come here.

    Checksums that a local file system keeps beside files are none.
    """
    found = []
    for path in folders:
        fs, full = hadoop_path(spark, path)
        local = fs.getScheme() == "file"
        places = spark._jvm.org.apache.hadoop.fs.Path(f"{literal_glob(full.toString())}/{MAYBE_HIDDEN}")
        for entry in described(spark, fs.globStatus(places)):
            name = entry[0].rsplit("/", 1)[1]
            checksum = local and name.startswith(".") and name.endswith(".crc")
            if is_hidden(name) and not checksum:
                found.append(entry)
    return found


def named_files(spark: SparkSession, paths: list[str]) -> list[tuple[str, str, int, int]]:
    """The files at `paths`, asked about by the JVM: a call from here per file system, not per path."""
    jvm, stores = spark._jvm, {}
    for path in paths:
        stores.setdefault(re.match("([^:/]+:(//[^/]*)?)?", path)[0], []).append(path)
    found = []
    for some in stores.values():
        fs, _ = hadoop_path(spark, some[0])
        names = jvm.java.util.regex.Pattern.compile(NUL).split(NUL.join(some))
        found += described(spark, fs.listStatus(jvm.org.apache.hadoop.util.StringUtils.stringToPath(names)))
    return found


def jvm_list(spark: SparkSession, array):
    """An array of the JVM as a list there."""
    jvm = spark._jvm
    copied = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, len(array))
    jvm.java.lang.System.arraycopy(array, 0, copied, 0, len(array))
    return jvm.java.util.Arrays.asList(copied)


def getter(jvm, kind, owner, name: str, result):
    """The method `name` of the Java class `owner` as a Java function of the type `kind`."""
    invoke = jvm.java.lang.invoke
    method = invoke.MethodType.methodType(result)
    handle = invoke.MethodHandles.publicLookup().findVirtual(owner._java_lang_class, name, method)
    return invoke.MethodHandleProxies.asInterfaceInstance(kind._java_lang_class, handle)


def described(spark: SparkSession, entries) -> list[tuple[str, str, int, int]]:
    """Of entries of a file system that are files: path as written, path as a URI, bytes, and time of change in
    milliseconds. The entries stay in the JVM, and each of these comes from it as one text."""
    if entries is None:
        return []
    jvm = spark._jvm
    lang, util, status, path = jvm.java.lang, jvm.java.util, jvm.org.apache.hadoop.fs.FileStatus, jvm.org.apache.hadoop.fs.Path
    files = util.ArrayList(jvm_list(spark, entries))
    files.removeIf(getter(jvm, util.function.Predicate, status, "isDirectory", lang.Boolean.TYPE))
    files.removeIf(getter(jvm, util.function.Predicate, status, "isSymlink", lang.Boolean.TYPE))
    if files.isEmpty():
        return []

    def texts(*steps) -> list[str]:
        values = util.ArrayList(files)
        for owner, name, result in (*steps, (lang.Object, "toString", lang.String._java_lang_class)):
            values.replaceAll(getter(jvm, util.function.UnaryOperator, owner, name, result))
        return lang.String.join(NUL, values).split(NUL)

    place = (status, "getPath", path._java_lang_class)
    uri = (path, "toUri", jvm.java.net.URI._java_lang_class)
    length = (status, "getLen", lang.Long.TYPE)
    changed = (status, "getModificationTime", lang.Long.TYPE)
    return list(zip(texts(place), texts(place, uri), map(int, texts(length)), map(int, texts(changed))))


def scanned_paths(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """The paths (file_path) a scan has listed, of files without bytes too; they stay in the JVM."""
    paths = jvm_list(spark, scan._jdf.inputFiles())
    made = spark._jsparkSession.createDataset(paths, spark._jvm.org.apache.spark.sql.Encoders.STRING())
    # a scan writes paths without an empty authority
    return DataFrame(made.toDF(), spark).select(F.regexp_replace("value", "^([^:/]+:)///", "$1/").alias("file_path"))


def list_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The files directly under `folders`, as they are now; no file is opened.

    Spark lists the folders, in tasks where they are many. Two kinds of files it does not
    read are added: those without bytes, which are in its listing and not in its scan, and
    those with hidden names, for which `readable` is false. Only these are asked about
    one by one, within the JVM. The scan is planned with very large splits, in a session of its
    own, because it reads names only.
    """
    present = [f for f in folders if path_exists(spark, f)]
    if not present:
        return described_files(spark, [])
    apart = spark.newSession()
    apart.conf.set(SPLIT_BYTES, str(1 << 44))
    scan = apart.read.format("binaryFile").load([literal_glob(f) for f in present])
    listed = settle(
        scan.filter("length > 0").select(
            F.col("path").alias("key"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("modified"),
            F.lit(True).alias("readable"),
        ),
        "listing",
        session=spark,
    )
    without = scanned_paths(spark, scan).join(listed, "file_path", "left_anti").select(decoded_path(F.col("file_path")))
    rows = hidden_files(spark, present) + named_files(spark, [path for (path,) in without.collect()])
    return listed.unionByName(described_files(spark, rows))


def described_files(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of `described`, as a listing."""
    return spark.createDataFrame(
        [(*row, not is_hidden(row[0].rsplit("/", 1)[1])) for row in rows],
        "key string, file_path string, file_size bigint, changed bigint, readable boolean",
    ).select("key", "file_path", "file_size", F.timestamp_millis("changed").alias("modified"), "readable")


def takes(key: Column, mask: Column) -> Column:
    """The mask's text before the first star occurs anywhere in the key, bucket and scheme aside."""
    return object_key(key).contains(mask_text(mask))


def takes_name(key: Column, mask: Column) -> Column:
    """The whole mask matches the file name, `*` and `?` as usual."""
    quoted = F.regexp_replace(mask, r"([.+^$(){}\[\]|\\])", r"\\$1")
    pattern = F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.regexp_like(base_name(key), F.concat(F.lit("^"), pattern, F.lit("$")))


def match_files(files: DataFrame, configs: DataFrame, mode: str = "prefix") -> DataFrame:
    """Files joined to the configs that take them: same folder, mask in the key."""
    test = takes if mode == "prefix" else takes_name
    listed = files.withColumn("directory", folder(F.col("key")))
    placed = configs.withColumn("directory", F.rtrim(F.col("srcfilepath"), F.lit("/")))
    return listed.join(placed, "directory").filter(test(F.col("key"), F.col("filemask")))
