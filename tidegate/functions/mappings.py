"""Column mappings: text from the config table, and header names against them."""

import ast

from pyspark.sql import Column, functions as F


def parse_mapping(text: str) -> list[tuple]:
    """`{source: target}` in written order."""
    mapping = ast.literal_eval(text)
    if not isinstance(mapping, dict) or not mapping:
        raise ValueError("column mapping is not a non-empty dict")
    return [(key, str(target)) for key, target in mapping.items()]


def mapping_entries(text: Column) -> Column:
    """The same for a column of such texts, as `array<struct<key, value>>`."""
    parsed = F.from_json(text, "map<string,string>", {"allowSingleQuotes": "true"})
    return F.map_entries(parsed)


def key_order(entries: Column) -> Column:
    """Mapping entries by key; text keys sort as text."""
    return F.array_sort(entries)


def header_names(cells: Column) -> Column:
    """Column names of a header line.

    A blank cell at 0-based place k is `Unnamed: k`; a repeated name gets the
    next free `.1`, `.2`, ...
    """
    named = F.transform(
        cells,
        lambda cell, k: F.when(
            F.coalesce(cell, F.lit("")) == "", F.concat(F.lit("Unnamed: "), k.cast("string"))
        ).otherwise(cell),
    )

    def unique(name: Column, k: Column) -> Column:
        earlier = F.size(F.filter(F.slice(named, F.lit(1), k), lambda other: other == name))
        free = F.filter(
            F.sequence(F.lit(1), F.size(named) + 1),
            lambda n: ~F.array_contains(named, F.concat(name, F.lit("."), n.cast("string"))),
        )
        suffixed = F.concat(name, F.lit("."), F.get(free, earlier - 1).cast("string"))
        return F.when(earlier == 0, name).otherwise(suffixed)

    return F.transform(named, unique)


def strip_names(names: Column) -> Column:
    return F.transform(names, lambda name: F.regexp_replace(name, r"^\s+|\s+$", ""))


def key_places(names: Column, keys: list[str]) -> Column:
    """1-based place of every key among `names`, 0 where it is missing."""
    return F.array(*[F.array_position(names, key).cast("int") for key in keys])


def has_unknown(names: Column, keys: list[str]) -> Column:
    known = F.array(*[F.lit(key) for key in keys])
    return F.exists(names, lambda name: ~F.array_contains(known, name))
