"""The config table: normalised columns, the two kinds of feed, and `Feed` objects."""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.mappings import parse_mapping
from tidegate.functions.paths import forward_slashes
from tidegate.operators.columns import DATE_LIKE, UNKNOWN, names_like
from tidegate.operators.routing import TARGETS
from tidegate.sources.fixed_width import field_specs

# Delimiters that mean fixed-width, and the columns of each kind of feed.
FIXED_WIDTH_WORDS = ("fixedwidth", "FIXEDWIDTH", "FixedWidth")
DELIMITED_COLUMNS = (
    "srcfilepath", "filemask", "columnstring", "hasheader", "clientfileconfigid",
    "clientid", "filetypeid", "headerrownumber", "textdelimiter", "fileextension",
)
FIXED_COLUMNS = (
    "srcfilepath", "filemask", "hasheader", "clientfileconfigid", "clientid",
    "filetypeid", "headerrownumber", "datastartingrownumber", "textdelimiter",
    "fileextension",
)
ALL_COLUMNS = tuple(dict.fromkeys(DELIMITED_COLUMNS + FIXED_COLUMNS))


def header_flag(has_header: Column, header_row: Column) -> Column:
    """False only for `hasheader = false` with header row 0; NULLs count as true."""
    return F.coalesce(has_header | (header_row != 0), F.lit(True))


def normalise_configs(configs: DataFrame) -> DataFrame:
    return configs.withColumns(
        {
            "hasheader": header_flag(F.col("hasheader"), F.col("headerrownumber")),
            "srcfilepath": forward_slashes(F.col("srcfilepath")),
        }
    )


def is_fixed_width(delimiter: Column) -> Column:
    return delimiter.isin(*FIXED_WIDTH_WORDS)


def split_configs(configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delimited and fixed-width rows; a NULL delimiter is in neither."""
    ready = normalise_configs(configs)
    fixed = is_fixed_width(F.col("textdelimiter"))
    return (
        ready.filter(~fixed).select(*DELIMITED_COLUMNS).orderBy("clientfileconfigid"),
        ready.filter(fixed).select(*FIXED_COLUMNS).orderBy("clientfileconfigid"),
    )


def config_json(configs: DataFrame) -> DataFrame:
    """One JSON text per row; NULL fields are left out."""
    return configs.select(F.to_json(F.struct(*configs.columns)).alias("json"))


@dataclass(frozen=True)
class Feed:
    """One config row, checked; `problem` says why it cannot be loaded."""

    config_id: int
    client_id: int | None = None
    file_type: int | None = None
    directory: str = ""
    mask: str = ""
    kind: str = "delimited"  # delimited, dat or fixed
    sep: str = ","
    header: bool = False
    header_row: int = 0
    skip: int = 0  # lines before the data: up to the header, or raw lines
    keys: tuple[str, ...] = ()  # source names, for feeds with a header flag
    targets: tuple[str, ...] = ()  # column names, in the order of keys or fields
    bounds: tuple[tuple[int, int], ...] = ()
    dated: bool = False  # as-of date taken from the file name
    mended: bool = False  # lines were put together to records
    problem: str | None = None

    @property
    def columns(self) -> int:
        return len(self.targets)

    @property
    def kept(self) -> list[int]:
        """Places of the targets that reach the staging table."""
        if self.kind == "fixed":
            return list(range(self.columns))
        dropped = set(names_like(list(self.targets), UNKNOWN))
        return [i for i, target in enumerate(self.targets) if target not in dropped]

    @property
    def as_text(self) -> set[str]:
        return set() if self.kind == "fixed" else set(names_like(list(self.targets), DATE_LIKE))


def feed_of(row: dict, specs: list[dict]) -> Feed:
    """Check one normalised config row; `specs` are its fixed-width fields."""
    feed = Feed(config_id=row["clientfileconfigid"])
    fixed = row["textdelimiter"] in FIXED_WIDTH_WORDS
    needed = FIXED_COLUMNS if fixed else DELIMITED_COLUMNS
    absent = [name for name in needed if row.get(name) is None]
    # the places needed to list and register a feed's files, as far as they are known
    feed = replace(
        feed,
        client_id=row["clientid"],
        file_type=row["filetypeid"],
        directory=row["srcfilepath"] or "",
        mask=row["filemask"] or "",
        kind="fixed" if fixed else "delimited",
    )
    if absent:
        return replace(feed, problem=f"no {absent[0]}")
    if feed.file_type not in TARGETS:
        return replace(feed, problem=f"no staging table for file type {feed.file_type}")
    try:
        header_row = int(row["headerrownumber"])
    except ValueError:
        return replace(feed, problem="header row is not a number")
    if fixed:
        return _fixed_feed(feed, row, specs)
    return _delimited_feed(feed, row, header_row)


def _fixed_feed(feed: Feed, row: dict, specs: list[dict]) -> Feed:
    if not specs:
        return replace(feed, problem="no fixed-width mapping")
    try:
        skip = max(int(row["datastartingrownumber"]) - 1, 0)
    except ValueError:
        return replace(feed, problem="data starting row is not a number")
    if any(spec[name] is None for spec in specs for name in ("start_pos", "end_pos", "field_mapped_to")):
        return replace(feed, problem="a field of the fixed-width mapping has no place or no name")
    names = tuple(spec["field_mapped_to"] for spec in specs)
    if len({name.lower() for name in names}) < len(names):
        return replace(feed, problem="two fields with one target")
    bounds = tuple((int(spec["start_pos"]), int(spec["end_pos"])) for spec in specs)
    return replace(feed, targets=names, bounds=bounds, skip=skip)


def _delimited_feed(feed: Feed, row: dict, header_row: int) -> Feed:
    extension, sep = row["fileextension"], row["textdelimiter"].strip() or row["textdelimiter"]
    if "xls" in extension or not ("csv" in extension or "dat" in extension):
        return replace(feed, problem=f"cannot read {extension} files")
    dat = "csv" not in extension
    header = bool(row["hasheader"])
    if dat and header:
        return replace(feed, problem="a dat feed cannot have a header")
    try:
        mapping = parse_mapping(row["columnstring"])
        if "dat" not in extension:
            mapping = sorted(mapping)
    except (ValueError, SyntaxError, TypeError) as error:
        return replace(feed, problem=f"column mapping: {error}")
    feed = replace(
        feed,
        kind="dat" if dat else "delimited",
        sep=sep,
        header=header,
        header_row=0 if dat else header_row,
        skip=1 if dat else header_row,
        keys=tuple(str(key) for key, _ in mapping) if header else (),
        targets=tuple(target.lower() for _, target in mapping),
        dated="dat" in extension,
    )
    landed = [feed.targets[i] for i in feed.kept] + (["asofdate"] if feed.dated else [])
    if len(set(landed)) < len(landed):
        return replace(feed, problem="two columns with one target")
    if header and not all(isinstance(key, str) for key, _ in mapping):
        return replace(feed, problem="header names must be text")
    return feed


def load_feeds(configs: DataFrame, mapping: DataFrame | None = None) -> list[Feed]:
    """All feeds in config order. Config and mapping rows are control data and are collected."""
    ready = normalise_configs(configs).filter(F.col("textdelimiter").isNotNull())
    rows = ready.select(*ALL_COLUMNS).orderBy("clientfileconfigid").collect()
    specs: dict[int, list[dict]] = {}
    if mapping is not None:
        for spec in field_specs(mapping).collect():
            specs.setdefault(spec["client_file_config_id"], []).append(spec.asDict())
    return [feed_of(row.asDict(), specs.get(row["clientfileconfigid"], [])) for row in rows]


def unmapped_configs(configs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Configs none of whose fields are mapped; all their files are rejected."""
    mapped = mapping.select(F.col("client_file_config_id").alias("clientfileconfigid"))
    return configs.join(mapped, "clientfileconfigid", "left_anti")
