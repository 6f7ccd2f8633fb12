"""Counts per config over files and their outcomes."""

from pyspark.sql import DataFrame, functions as F

from tidegate.operators.registry import REJECTED, STAGED


def load_summary(configs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Files and rows per config; a config without files has zeros.

    `outcomes` has one row per file: clientfileconfigid, processstatus, rows.
    """
    status = F.col("processstatus")
    counts = outcomes.groupBy("clientfileconfigid").agg(
        F.count_if(status == STAGED).alias("files_staged"),
        F.count_if(status == REJECTED).alias("files_rejected"),
        F.sum(F.when(status == STAGED, F.col("rows")).otherwise(0)).alias("rows_staged"),
    )
    zero = {"files_staged": 0, "files_rejected": 0, "rows_staged": 0}
    return configs.select("clientfileconfigid").join(counts, "clientfileconfigid", "left").na.fill(zero)
