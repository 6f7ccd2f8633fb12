"""Fixed-width fields: bounds from the mapping table, slices as substrings."""

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.values import strip_field
from tidegate.sources.lines import FILE_COLUMNS

ORIGIN = 2  # a field at position 2 starts at a line's first character


def slice_bounds(mapping: DataFrame, origin: int = ORIGIN) -> DataFrame:
    """Mapping rows with 0-based, half-open bounds `start_pos`, `end_pos`."""
    start = F.col("starting_position") - origin
    return mapping.withColumns({"start_pos": start, "end_pos": start + F.col("length")})


def field_specs(mapping: DataFrame, config_id: int | None = None) -> DataFrame:
    """Bounds and names in mapping order, of one config or of all."""
    chosen = mapping if config_id is None else mapping.filter(F.col("client_file_config_id") == config_id)
    return (
        slice_bounds(chosen)
        .select("client_file_config_id", "fixedwidth_field_mapping_id", "start_pos", "end_pos", "field_mapped_to")
        .orderBy("client_file_config_id", "fixedwidth_field_mapping_id")
    )


def slice_field(value: Column, start: int, end: int) -> Column:
    """One trimmed field; NULL where the line is too short or nothing is left."""
    if start < 0 or end <= start:
        return F.lit(None).cast("string")
    return F.nullif(strip_field(F.substring(value, start + 1, end - start)), F.lit(""))


def fixed_width_records(lines: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    fields = [slice_field(F.col("value"), start, end).alias(f"_{i}") for i, (start, end) in enumerate(bounds)]
    return lines.select(
        "value",
        *FILE_COLUMNS,
        F.monotonically_increasing_id().alias("at"),
        F.struct(*fields).alias("rec"),
        F.lit(len(bounds)).alias("width"),
        F.lit(False).alias("broken"),
        F.lit(0).alias("quotes"),
        F.lit(False).alias("blank"),
    )
