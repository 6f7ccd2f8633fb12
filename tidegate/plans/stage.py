"""One feed from files to staged rows.

Three passes over the text, none of which shuffles a row:

1. lines per split, for feeds whose data start below the first line (where files are
   large, only their first lines are read instead);
2. a profile per split: header, field counts, rows to keep, type masks;
3. the staged rows, numbered and typed.

Everything between the passes is one row per split or per file.
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegate.functions.mappings import has_unknown, header_names, key_places, strip_names
from tidegate.functions.paths import as_of_date, decoded_name
from tidegate.functions.values import all_missing, fits, read_as, type_mask, type_of_mask, wider
from tidegate.operators.numbering import (
    BLOCK,
    ID_BITS,
    SPLIT,
    at_splits,
    count_blocks,
    number_lines,
    place_in_block,
    running_total,
    split_key,
    split_table,
    task_of,
)
from tidegate.plans.config import Feed
from tidegate.session import settle
from tidegate.sources.delimited import delimited_records, is_blank
from tidegate.sources.fixed_width import fixed_width_records
from tidegate.sources.heads import Heads, read_heads
from tidegate.sources.lines import FILE_COLUMNS, read_lines
from tidegate.sources.quoted import whole_records


PLACE_COLUMNS = ("first_row_at", "lasting", "lead", "rows_before")
LINE_BREAK, LEFT_OPEN = "line break inside quotes", "quote left open"
NAMED_FILES = 1000  # files that a filter names
LARGE_FILE = 16 << 20  # bytes from which a file is dearer to read than to open


def fields_of(n: int) -> list[str]:
    return [f"rec._{i}" for i in range(n)]


def lines_to_records(lines: DataFrame, feed: Feed) -> DataFrame:
    if feed.kind == "fixed":
        return fixed_width_records(lines, list(feed.bounds))
    return delimited_records(lines, feed.sep, feed.columns, count_blank=feed.kind == "dat")


def lasting(feed: Feed) -> Column:
    """Not blank, and at least one field with a value, or too many fields to be parsed."""
    return F.expr(f"NOT blank AND (width > {feed.columns} OR NOT ({all_missing(fields_of(feed.columns))}))")


def checked_records(records: DataFrame, feed: Feed) -> tuple[DataFrame, list[str]]:
    """`records` with `is_lasting` and a type mask per column, whose names are returned too."""
    fields = fields_of(feed.columns)
    masks = [f"mask_{i}" for i in range(feed.columns)]
    any_case = feed.kind != "fixed"
    masked = records.select("*", *[F.expr(type_mask(f, any_case)).alias(m) for f, m in zip(fields, masks)])
    lasting = f"NOT blank AND (width > {feed.columns} OR coalesce({', '.join(masks)}) IS NOT NULL)"
    return masked.withColumn("is_lasting", F.expr(lasting)), masks


def profile_blocks(records: DataFrame, feed: Feed) -> DataFrame:
    """One row per split, and one more for a header line in it.

    Header cells are a grouping key, not an aggregate: all aggregates then have
    fixed-size buffers and are hashed in the scan's own tasks, without a sort.
    `lasting` counts rows with a value, `lead` those of them at or above the
    skipped line. Both depend on the line alone, so the final pass can drop the
    others before it takes row ids.
    """
    if feed.skip:
        numbered = number_lines(records, settle(count_blocks(records), "blocks"))
    else:
        numbered = records.withColumn("line_no", F.lit(1).cast("bigint"))
    below = f"line_no > {feed.skip}"
    header = f"line_no = {feed.header_row}" if feed.header_row else "false"
    known, masks = checked_records(numbered, feed)
    checked = known.selectExpr(
        "at",
        "file_size",
        "modified",
        *BLOCK,
        "width",
        "broken",
        "quotes",
        "is_lasting",
        f"{below} AND NOT blank AS data",
        f"NOT {below} AS above",
        f"{header} AS is_header",
        f"CASE WHEN {header} THEN array({', '.join(fields_of(feed.columns))}) END AS cells",
        *masks,
    )
    return checked.groupBy(*BLOCK, "cells").agg(
        F.min("at").alias("first_at"),
        F.count_if("is_lasting").alias("lasting"),
        F.expr("count_if(is_lasting AND above)").alias("lead"),
        F.expr("max(width) FILTER (WHERE is_header)").alias("header_width"),
        F.expr("min_by(width, at) FILTER (WHERE data)").alias("first_width"),
        F.expr("max(width) FILTER (WHERE data)").alias("max_width"),
        F.max("broken").alias("broken"),
        F.sum("quotes").alias("quotes"),
        F.max("file_size").alias("file_size"),
        F.max("modified").alias("modified"),
        F.expr(f"array({', '.join(f'bit_and({mask}) FILTER (WHERE data)' for mask in masks)})").alias("masks"),
    )


def profile_blocks_below(records: DataFrame, feed: Feed, heads: Heads) -> DataFrame:
    """The same from known first lines of the files, without a pass that counts lines.

    Lines with the text of some first line are kept apart, per text. All lines of one
    text are alike, so it is enough to know how many of a split's stand above the data.
    """
    known, masks = checked_records(records, feed)
    named = F.when(F.col("value").isin(heads.texts), F.col("value"))
    fields = ", ".join(fields_of(feed.columns))
    apart = known.withColumn("head", named).withColumn("cells", F.expr(f"CASE WHEN head IS NOT NULL THEN array({fields}) END"))
    found = settle(
        apart.groupBy(*BLOCK, "head", "cells").agg(
            F.min("at").alias("first_at"),
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_lasting").alias("lasting"),
            F.expr("min_by(width, at)").alias("first_width"),
            F.max("width").alias("max_width"),
            F.max("broken").alias("broken"),
            F.sum("quotes").alias("quotes"),
            F.max("file_size").alias("file_size"),
            F.max("modified").alias("modified"),
            F.array(*[F.bit_and(mask) for mask in masks]).alias("masks"),
        ),
        "texts",
    )
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy(*BLOCK).agg(F.sum("n").alias("lines"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    placed = found.join(sizes, list(BLOCK)).join(heads.files, "file_path", "left")
    places = "filter(sequence(1, size(texts)), i -> i > before AND i <= before + lines AND texts[i - 1] = head)"
    here = placed.withColumn("places", F.expr(f"CASE WHEN head IS NULL OR texts IS NULL THEN array() ELSE {places} END"))
    data, header = "n > size(places)", f"array_contains(places, {feed.header_row})"
    return here.selectExpr(
        *BLOCK,
        f"CASE WHEN {header} THEN cells END AS cells",
        "first_at",
        "lasting",
        "CASE WHEN lasting > 0 THEN CAST(size(places) AS bigint) ELSE 0L END AS lead",
        f"CASE WHEN {header} THEN max_width END AS header_width",
        f"CASE WHEN {data} THEN first_width END AS first_width",
        f"CASE WHEN {data} THEN max_width END AS max_width",
        "broken",
        "quotes",
        "file_size",
        "modified",
        f"CASE WHEN {data} THEN masks ELSE transform(masks, m -> CAST(NULL AS int)) END AS masks",
    )


def profile_files(blocks: DataFrame, feed: Feed) -> DataFrame:
    """One row per file that has lines, with `problem` set on those to reject."""
    files = blocks.groupBy("file_path").agg(
        F.max("cells").alias("cells"),
        F.max("header_width").alias("header_width"),
        F.expr("min_by(first_width, block_start) FILTER (WHERE first_width IS NOT NULL)").alias("first_width"),
        F.max("max_width").alias("max_width"),
        F.max("broken").alias("broken"),
        F.sum("quotes").alias("quotes"),
        F.max("file_size").alias("file_size"),
        F.max("modified").alias("modified"),
        F.sum(F.col("lasting") - F.col("lead")).alias("rows"),
        F.count(F.lit(1)).alias("splits"),
        F.expr(f"array({', '.join(f'bit_and(masks[{i}])' for i in range(feed.columns))})").alias("masks"),
    )
    if feed.header_row:
        names = header_names(F.col("cells"))
    else:
        names = F.array(*[F.lit(str(i)) for i in range(feed.columns)])
    if feed.header:
        keys = list(feed.keys)
        files = files.withColumn("names", strip_names(names)).withColumns(
            {
                "places": key_places(F.col("names"), keys),
                "unknown": has_unknown(F.col("names"), keys),
            }
        )
    else:
        files = files.withColumns(
            {
                "places": F.array(*[F.lit(i + 1) for i in range(feed.columns)]),
                "unknown": F.lit(False),
            }
        )
    declared = F.col("header_width") if feed.header_row else F.col("first_width")
    missing = "no header line" if feed.header_row else "empty file"
    problem = (
        F.when(F.col("broken"), LEFT_OPEN if feed.mended else LINE_BREAK)
        .when(declared.isNull(), missing)
        .when(declared != feed.columns, "column count differs from the mapping")
        .when(F.col("max_width") > feed.columns, "row wider than the columns")
        .when(F.col("unknown"), "unknown header name")
        .when(F.array_contains("places", 0), "header name given twice")
    )
    if feed.dated:
        problem = F.coalesce(
            problem,
            F.when(as_of_date(decoded_name(F.col("file_path"))).isNull(), "no as-of date in the file name"),
        )
    return files.select(
        "file_path", "file_size", "modified", "rows", "splits", "masks", "places", problem.alias("problem")
    )


@dataclass(frozen=True)
class Profile:
    """What the first two passes found about one feed."""

    feed: Feed
    records: DataFrame
    blocks: DataFrame
    files: DataFrame
    problems: list[str]
    types: list[str]
    empty: list[bool]  # columns of which no good file has a value
    n_good: int
    n_splits: int
    places: list[int] | None  # None where files differ in their column order

    @property
    def good(self) -> DataFrame:
        return self.files.filter(F.col("problem").isNull())


def misfit(feed: Feed, given: dict[str, str]) -> Column:
    """The problem of files with values that the given type of their column cannot take."""
    tests = [
        fits(f"get(masks, places[{i}] - 1)", given[feed.targets[i].lower()])
        for i in feed.kept
        if feed.targets[i].lower() in given
    ]
    bad = f"NOT ({' AND '.join(tests)})" if tests else "false"
    return F.when(F.expr(bad), "values do not fit the types of the staging table")


def column_type(feed: Feed, target: str, mask: int | None, known: dict[str, str], given: dict[str, str]) -> str:
    """The type a column is read as: the given one, or one for its values and those the table has."""
    if target.lower() in given:
        return given[target.lower()]
    own = "string" if target in feed.as_text else "void" if mask is None else type_of_mask(mask)
    found = wider(known.get(target.lower(), "void"), own)
    return type_of_mask(None) if found == "void" else found


def profile(
    feed: Feed,
    records: DataFrame,
    only: DataFrame | None = None,
    known: dict[str, str] | None = None,
    given: dict[str, str] | None = None,
    heads: Heads | None = None,
) -> Profile:
    """Run the first two passes; `only` names the files (file_path) that count, if not all do.

    `known` has the types that the staging table's columns have so far, `given` those
    that are fixed. With `heads`, the first lines of the files, the first pass is left out.
    """
    known, given = known or {}, given or {}
    blocks = profile_blocks(records, feed) if heads is None else profile_blocks_below(records, feed, heads)
    blocks = settle(blocks, "profile")
    files = profile_files(blocks, feed)
    if only is not None:
        files = files.join(only.select("file_path"), "file_path", "left_semi")
    files = files.withColumn("problem", F.coalesce("problem", misfit(feed, given)))
    good = "FILTER (WHERE problem IS NULL)"
    masks = [f"bit_and(get(masks, places[{i}] - 1)) {good}" for i in range(feed.columns)]
    verdict = files.selectExpr(
        "collect_set(problem) AS problems",
        f"count(*) {good} AS n_good",
        "coalesce(sum(splits), 0) AS n_splits",
        f"array({', '.join(masks)}) AS masks",
        f"min(places) {good} AS first_order",
        f"max(places) {good} AS last_order",
    ).first()
    types = [column_type(feed, target, mask, known, given) for target, mask in zip(feed.targets, verdict["masks"])]
    places = verdict["first_order"] if verdict["first_order"] == verdict["last_order"] else None
    counts = verdict["n_good"], verdict["n_splits"]
    empty = [mask is None for mask in verdict["masks"]]
    return Profile(feed, records, blocks, files, verdict["problems"], types, empty, *counts, places)


def mended_lines(lines: DataFrame, found: Profile) -> DataFrame:
    """`lines`, with those of files that have quoted line breaks put together to records.

    The other files are read as they were, unless too many are to be named.
    """
    broken = found.files.filter(F.col("problem") == LINE_BREAK).select("file_path")
    named = [row["file_path"] for row in broken.limit(NAMED_FILES + 1).collect()]
    columns = ["value", *FILE_COLUMNS]
    if len(named) > NAMED_FILES:
        return whole_records(lines, found.feed.sep)
    mine = F.col("file_path").isin(named)
    records = whole_records(lines.filter(mine), found.feed.sep)
    return lines.filter(~mine).select(*columns).unionByName(records.select(*columns))


def profile_lines(
    feed: Feed,
    lines: DataFrame,
    only: DataFrame | None = None,
    known: dict[str, str] | None = None,
    given: dict[str, str] | None = None,
    heads: Heads | None = None,
) -> Profile:
    """The profile of a feed's lines; if quoted fields hold line breaks, that of the records they make."""
    found = profile(feed, lines_to_records(lines, feed), only, known, given, heads)
    if LINE_BREAK in found.problems:
        feed = replace(feed, mended=True)
        found = profile(feed, lines_to_records(mended_lines(lines, found), feed), only, known, given)
    return found


def heads_of(spark: SparkSession, feed: Feed, path: str | list[str], glob: str | None, files: DataFrame) -> Heads | None:
    """The lines that a feed skips, where its files are large; of small ones all lines are counted instead."""
    if not feed.skip or feed.kind == "dat":
        return None
    usual = files.agg(F.avg("file_size")).first()[0] or 0
    if usual < LARGE_FILE:
        return None
    counted = F.lit(True) if feed.kind == "fixed" else ~is_blank(F.col("value"), feed.sep)
    return read_heads(spark, path, glob, counted, feed.skip)


def profile_paths(
    spark: SparkSession,
    feed: Feed,
    path: str | list[str],
    glob: str | None = None,
    only: DataFrame | None = None,
    known: dict[str, str] | None = None,
    given: dict[str, str] | None = None,
) -> Profile:
    """The profile of files on storage, by the rules of `profile_lines`; `only` may tell their `file_size`."""
    sized = only is not None and "file_size" in only.columns
    heads = heads_of(spark, feed, path, glob, only) if sized else None
    return profile_lines(feed, read_lines(spark, path, glob), only, known, given, heads)


def row_offsets(found: Profile) -> DataFrame:
    """Per split of the good files: its first row id in the final pass and the rows before it."""
    in_task = Window.partitionBy(task_of(F.col("first_at"))).orderBy("first_at")
    earlier = in_task.rowsBetween(Window.unboundedPreceding, -1)
    first = F.shiftleft(task_of(F.col("first_at")), ID_BITS) + F.coalesce(F.sum("lasting").over(earlier), F.lit(0))
    blocks = found.blocks.groupBy(*BLOCK).agg(
        F.min("first_at").alias("first_at"), F.sum("lasting").alias("lasting"), F.sum("lead").alias("lead")
    )
    places = (
        blocks.withColumn("first_row_at", first)
        .filter(F.col("lasting") > 0)
        .join(found.good, "file_path", "left_semi")
        .select(*BLOCK, "first_row_at", "lasting", "lead", (F.col("lasting") - F.col("lead")).alias("rows"))
    )
    return running_total(places, list(BLOCK), "rows", "rows_before", found.n_splits).drop("rows")


def typed_rows(found: Profile, offsets: DataFrame) -> DataFrame:
    """Typed columns of the kept rows, `rownum`, and what `offsets` adds beyond the row places."""
    feed = found.feed
    fields = fields_of(feed.columns)
    if found.places is not None:
        sources = [fields[place - 1] for place in found.places]
    else:
        offsets = offsets.join(found.files.select("file_path", "places"), "file_path")
        sources = [f"get(array({', '.join(fields)}), places[{i}] - 1)" for i in range(feed.columns)]
    # Row ids never pass line ids. Asking for it keeps `at` in the plan, and with it
    # the filter above the parsing projection: each line is parsed once.
    in_step = F.col("row_at") <= F.col("at")
    own = found.records.filter(lasting(feed)).select(
        "at", "rec", "file_path", split_key().alias(SPLIT), F.monotonically_increasing_id().alias("row_at")
    )
    rows = (
        at_splits(own, split_table(offsets, "offsets"), found.n_splits)
        .withColumn("place", place_in_block("row_at", "first_row_at", "lasting"))
        .filter((F.col("place") >= F.col("lead")) & in_step)
    )
    columns = [F.expr(read_as(sources[i], found.types[i])).alias(feed.targets[i]) for i in feed.kept]
    if feed.dated:
        columns.append(as_of_date(decoded_name(F.col("file_path"))).alias("asofdate"))
    added = [c for c in offsets.columns if c not in (*BLOCK, *PLACE_COLUMNS, "places")]
    rownum = F.col("rows_before") + F.col("place") - F.col("lead") + 1
    return rows.select(*columns, *added, rownum.alias("rownum"))


def scan_feed(spark: SparkSession, feed: Feed, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Typed rows and `rownum` of a feed's files, without a registry."""
    found = profile_paths(spark, feed, path, glob)
    return typed_rows(found, row_offsets(found))


def staged_rows(found: Profile, ids: DataFrame) -> DataFrame:
    """Rows for the staging table; `ids` gives `fileid` by `file_path`.

    Mapped columns named like one of the three added columns give way to it.
    """
    feed = found.feed
    taken = {"fileid", "clientid", "rownum"}
    kept = tuple(t if t.lower() not in taken else f"_mapped_{t}" for t in feed.targets)
    renamed = replace(found, feed=replace(feed, targets=kept))
    offsets = row_offsets(found).join(ids.select("file_path", "fileid"), "file_path")
    rows = typed_rows(renamed, offsets).withColumn("clientid", F.lit(feed.client_id))
    return rows.drop(*[t for t in kept if t.startswith("_mapped_")])
