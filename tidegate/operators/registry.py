"""The file registry: ids, status events, latest status, where files belong."""

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.paths import base_name, folder, utc_text
from tidegate.operators.numbering import number_rows
from tidegate.session import settle

# The two outcomes and their folders.
STAGED, REJECTED = "InStage", "Rejected"
FOLDERS = {STAGED: "Processed", REJECTED: "Rejected"}
# The registry's tables.
FILES, EVENTS = "Files", "FileStatus"
EVENT_SCHEMA = (
    "fileid bigint, clientfileconfigid int, key string, processstatus string, "
    "reason string, rows bigint, seq bigint, batch string"
)


def assign_ids(files: DataFrame, last_id: int = 0) -> DataFrame:
    """`fileid` from `last_id + 1` on, by config and path."""
    order = ["clientfileconfigid", "file_path"]
    return settle(number_rows(files, order, "fileid", last_id, files.count()), "registered")


def registry_rows(files: DataFrame) -> DataFrame:
    """The registry's columns; the creation time of an object is its last change.

    Times are UTC. `file_size` and `changed` (microseconds) tell versions of a file apart.
    """
    modified = utc_text(F.col("modified"))
    return files.select(
        "fileid",
        "clientid",
        "filetypeid",
        base_name(F.col("key")).alias("filename"),
        F.col("directory").alias("filelocation"),
        F.lit(None).cast("string").alias("filecreatedby"),
        modified.alias("filelastmodifieddate"),
        modified.alias("createddatetime"),
        utc_text(F.current_timestamp()).alias("lastupdateddatetime"),
        F.col("clientfileconfigid").alias("cleintconfigid"),
        "file_path",
        "file_size",
        F.unix_micros("modified").alias("changed"),
    )


def latest_status(events: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The last `processstatus` of every file.

    A log is first reduced to one number per file and status, which is hashed in
    the tasks that read it.
    """
    reduced = events.groupBy(*keys, "processstatus").agg(F.max(order).alias(order))
    return reduced.groupBy(*keys).agg(F.max_by("processstatus", order).alias("processstatus"))


def destination(status: Column, path: Column) -> Column:
    """`{folder}/{Processed|Rejected}/{name}`; NULL while a file has no outcome."""
    place = F.create_map(*[F.lit(x) for pair in FOLDERS.items() for x in pair])[status]
    return F.when(place.isNotNull(), F.concat_ws("/", folder(path), place, base_name(path)))


def disposition(files: DataFrame, path: str = "key") -> DataFrame:
    """Where each file should end."""
    return files.withColumn("destination", destination(F.col("processstatus"), F.col(path)))
