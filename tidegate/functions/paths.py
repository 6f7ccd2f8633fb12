"""Paths, file names, masks and times as column expressions."""

from pyspark.sql import Column, functions as F

# Fixed value: how file times are written.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def forward_slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def decoded_name(path: Column) -> Column:
    """The file name of a path written as a URI, as it is in storage."""
    return F.url_decode(F.replace(base_name(path), F.lit("+"), F.lit("%2B")))


def decoded_path(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def folder(path: Column) -> Column:
    """Everything before the last slash, whatever the depth."""
    return F.regexp_replace(path, "/[^/]*$", "")


def bucket(path: Column) -> Column:
    """The authority of `scheme://authority/...`; empty where there is none."""
    return F.regexp_extract(path, "^[^:/]+://([^/]*)", 1)


def object_key(path: Column) -> Column:
    """The path without scheme and bucket."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "")


def mask_text(mask: Column) -> Column:
    """The part of a file mask before its first star."""
    return F.substring_index(mask, "*", 1)


def in_folder(path: Column, directory: Column) -> Column:
    return folder(path) == F.rtrim(directory, F.lit("/"))


def as_of_date(name: Column) -> Column:
    """First dot-separated token that starts with 20, up to its first underscore."""
    return F.nullif(F.regexp_extract(name, r"(?:^|[.])(20[^._]*)", 1), F.lit(""))


def time_text(when: Column) -> Column:
    return F.date_format(when, TIME_FORMAT)


def utc_text(when: Column) -> Column:
    """An instant as UTC wall-clock text, whatever the session's time zone."""
    return epoch_text(F.unix_seconds(when))


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds as UTC wall-clock text, whatever the session's time zone."""
    utc = F.timestamp_add("SECOND", seconds.cast("bigint"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(utc, TIME_FORMAT)


def reader_for(extension: Column) -> Column:
    """Which reader a file extension asks for; `excel` and NULL are not readable."""
    return (
        F.when(extension.contains("xls"), "excel")
        .when(extension.contains("csv"), "delimited")
        .when(extension.contains("dat"), "dat")
    )
