"""Delimited records: one struct of texts per line, before any typing.

Every record source gives the same columns: `value`, those of FILE_COLUMNS, `at` (place
in the scan, see operators.numbering), `rec` (struct `_0`, `_1`, ... of texts),
`width` (fields on the line), `broken` (a quote left open), `quotes` (quote
characters) and `blank`.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.sources.lines import FILE_COLUMNS


def struct_of_texts(n: int) -> str:
    return ", ".join(f"`_{i}` string" for i in range(n))


def csv_options(sep: str, columns: int = 100_000) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "maxColumns": str(columns)}


def is_blank(value: Column, sep: str) -> Column:
    """Nothing but blanks and tabs; a tab that separates fields is not blank."""
    return F.btrim(value, F.lit(" " if sep == "\t" else " \t")) == ""


def without_quoted(value: Column, sep: str) -> Column:
    """The line with its quoted fields emptied."""
    quoted = f'(^|{re.escape(sep)})"[^"]*+(?:""[^"]*+)*+"'
    return F.when(
        F.contains(value, F.lit('"')), F.regexp_replace(value, quoted, "$1")
    ).otherwise(value)


def field_count(value: Column, sep: str) -> Column:
    bare = without_quoted(value, sep)
    separators = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(sep), F.lit("")))
    return (separators / len(sep.encode())).cast("int") + 1


def has_open_quote(value: Column, sep: str) -> Column:
    """A quoted field that does not end on its line."""
    return F.contains(value, F.lit('"')) & without_quoted(value, sep).rlike(f'(?:^|{re.escape(sep)})"')


def quote_count(value: Column) -> Column:
    quote = F.lit('"')
    found = F.octet_length(value) - F.octet_length(F.replace(value, quote, F.lit("")))
    return F.when(F.contains(value, quote), found).otherwise(0)


def delimited_records(lines: DataFrame, sep: str, columns: int, count_blank: bool = False) -> DataFrame:
    """Split lines into fields; `at` counts blank lines only with `count_blank`."""
    value = F.col("value")
    blank = is_blank(value, sep)
    counted = lines if count_blank else lines.filter(~blank)
    width = field_count(value, sep)
    # Wider lines make their file be rejected; the parser would fail on them.
    fields = F.when(width <= columns, F.from_csv(value, struct_of_texts(columns), csv_options(sep, columns + 1)))
    return counted.select(
        "value",
        *FILE_COLUMNS,
        F.monotonically_increasing_id().alias("at"),
        fields.alias("rec"),
        width.alias("width"),
        has_open_quote(value, sep).alias("broken"),
        quote_count(value).alias("quotes"),
        (blank if count_blank else F.lit(False)).alias("blank"),
    )


def read_delimited(spark: SparkSession, path: str, sep: str = "|", header: bool = True) -> DataFrame:
    """Spark's own reader with its own inference, for files that need no mapping."""
    return spark.read.options(**csv_options(sep), header=header, inferSchema=True).csv(path)
