"""Staging table by file type."""

from pyspark.sql import Column, DataFrame, functions as F

# Staging table of every file type.
TARGETS = {1: "Raw_Accounts", 2: "Raw_Trades", 3: "Raw_Balances"}


def target_of(file_type: Column) -> Column:
    """The staging table name; NULL for a type that has none."""
    return F.create_map(*[F.lit(x) for pair in TARGETS.items() for x in pair])[file_type]


def route(df: DataFrame, file_type: str = "filetypeid") -> DataFrame:
    return df.withColumn("target", target_of(F.col(file_type)))
