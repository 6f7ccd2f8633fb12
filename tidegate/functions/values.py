"""Null tokens and type rules for field texts.

The rules are SQL text over a field's name, to be used with `expr` or `selectExpr`:
a feed has many fields, and one text per field is built faster than a tree of
column objects.
"""

from pyspark.sql import Column, functions as F

# Field texts that stand for "no value", matched exactly.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Spellings of the two booleans. Delimited files take any casing.
TRUE_WORDS = ("True", "TRUE", "true")
FALSE_WORDS = ("False", "FALSE", "false")
# Number syntax.
SHORT_INTEGER = r"^\s*[+-]?\d{1,18}\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"

# Bits of a type mask: what a text, or every text of a column, can be read as.
LONG, DOUBLE, BOOLEAN, INTEGRAL = 1, 2, 4, 8


def words(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def is_missing(field: str) -> str:
    return f"({field} IS NULL OR {field} IN ({words(NULL_TOKENS)}))"


def null_if_token(field: str) -> str:
    return f"CASE WHEN NOT {is_missing(field)} THEN {field} END"


def all_missing(fields: list[str]) -> str:
    return " AND ".join(is_missing(field) for field in fields)


def strip_field(text: Column) -> Column:
    """Blanks, tabs and line ends removed from both ends."""
    return F.btrim(text, F.lit(" \t\r\n"))


def is_boolean(field: str, any_case: bool) -> str:
    if any_case:
        return f"octet_length({field}) <= 5 AND lower({field}) IN ('true', 'false')"
    return f"{field} IN ({words(TRUE_WORDS + FALSE_WORDS)})"


def type_mask(field: str, any_case: bool = True) -> str:
    """The readings one field allows; NULL for a missing value.

    `any_case` lets booleans be spelled in any casing, not only in three.

    Most fields are decided by their first character and one pattern. Only numbers
    of 19 or more digits need a trial cast: a failed one is costly.
    """
    any_integer = LONG | DOUBLE | INTEGRAL
    return f"""
        CASE WHEN {is_missing(field)} THEN NULL
             WHEN NOT (ascii({field}) <= {ord('9')} OR ascii({field}) IN ({ord('I')}, {ord('i')}))
             THEN IF({is_boolean(field, any_case)}, {BOOLEAN}, 0)
             WHEN contains({field}, '.') THEN IF({field} RLIKE r'{NUMBER}', {DOUBLE}, 0)
             WHEN {field} RLIKE r'{SHORT_INTEGER}' THEN {any_integer}
             WHEN {field} RLIKE r'{INTEGER}'
             THEN IF(try_cast({field} AS bigint) IS NULL, {DOUBLE | INTEGRAL}, {any_integer})
             WHEN {field} RLIKE r'{NUMBER}' THEN {DOUBLE}
             ELSE 0 END"""


def type_of_mask(mask: int | None) -> str:
    """The column type for the `bit_and` of its masks.

    Integers too long for 64 bits stay text; a column without any value is double.
    """
    if mask is None:
        return "double"
    for bit, type_name in ((LONG, "bigint"), (INTEGRAL, "string"), (DOUBLE, "double"), (BOOLEAN, "boolean")):
        if mask & bit:
            return type_name
    return "string"


def wider(one: str, other: str) -> str:
    """The narrowest type that holds the values of two; `void` has none."""
    if "void" in (one, other) or one == other:
        return other if one == "void" else one
    return "double" if {one, other} == {"bigint", "double"} else "string"


def fits(mask: str, type_name: str) -> str:
    """Whether a column's mask, an SQL expression, lets all its values be read as a type."""
    bit = {"bigint": LONG, "double": DOUBLE, "boolean": BOOLEAN}.get(type_name)
    return "true" if bit is None else f"coalesce({mask} & {bit}, {bit}) != 0"


def read_as(field: str, type_name: str) -> str:
    """A field as a type that `type_of_mask` found for its column."""
    if type_name == "string":
        return null_if_token(field)
    if type_name == "boolean":
        return f"CASE WHEN NOT {is_missing(field)} THEN lower({field}) = 'true' END"
    return f"try_cast({null_if_token(field)} AS {type_name})"
