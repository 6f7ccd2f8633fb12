"""Column names and shapes."""

import re
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Columns that are dropped, and columns that stay text.
UNKNOWN = ".*unknown*"
DATE_LIKE = ".*date*"


def rename_by_position(df: DataFrame, targets: list[str]) -> DataFrame:
    return df.toDF(*[target.lower() for target in targets])


def rename_by_header(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Each column takes the target of its trimmed name; unknown names are an error."""
    missing = [name for name in df.columns if name.strip() not in mapping]
    if missing:
        raise KeyError(f"columns without a target: {missing}")
    return df.toDF(*[mapping[name.strip()].lower() for name in df.columns])


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def names_like(names: list[str], pattern: str) -> list[str]:
    return [name for name in names if re.match(pattern, name)]


def drop_matching(df: DataFrame, pattern: str = UNKNOWN) -> DataFrame:
    return df.drop(*names_like(df.columns, pattern))


def text_matching(df: DataFrame, pattern: str = DATE_LIKE) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in names_like(df.columns, pattern)})


def drop_empty_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="all", subset=columns)


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns in any order."""
    return reduce(DataFrame.unionByName, parts)
