"""Running values of rows in their groups, however many rows a group has.

Rows are dealt to slices by ranges of group and order, so a large group fills many
slices; a table with one row per slice and group carries what lies in earlier slices.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.operators.numbering import in_slices, task_of
from tidegate.session import settle


def running(
    df: DataFrame, group: str, order: list, values: dict[str, str], combine: Callable[[str], Column], label: str
) -> DataFrame:
    """`df` with the running and the whole value of its group, as `name` and `name_total`.

    `values` gives the bigint column to combine for each new name; `combine` is `F.sum` or
    `F.bit_xor`. A running value includes the row's own. Rows whose group is null are a
    group. `order` must tell a group's rows apart as far as they are to be spread.
    """
    together = {F.sum: lambda a, b: a + b, F.bit_xor: lambda a, b: a.bitwiseXOR(b)}[combine]
    sliced = in_slices(df, [F.col(group).asc_nulls_first(), *order], label).withColumn("slice", task_of(F.col("at")))
    totals = sliced.groupBy("slice", F.col(group).alias("of")).agg(
        *[combine(value).alias(name) for name, value in values.items()]
    )
    earlier = Window.partitionBy("of").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("of")
    carried = totals.select(
        F.col("slice").alias("in_slice"),
        "of",
        *[F.coalesce(combine(name).over(earlier), F.lit(0)).alias(f"{name} before") for name in values],
        *[combine(name).over(whole).alias(f"{name}_total") for name in values],
    )
    so_far = Window.partitionBy("slice", group).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumns({name: combine(value).over(so_far) for name, value in values.items()})
        .join(settle(carried, label), (F.col("slice") == F.col("in_slice")) & F.col(group).eqNullSafe(F.col("of")))
        .withColumns({name: together(F.col(name), F.col(f"{name} before")) for name in values})
        .drop("slice", "in_slice", "of", "at", *[f"{name} before" for name in values])
    )


def ranked(df: DataFrame, group: str, order: list, label: str) -> DataFrame:
    """`df` with `rank`, counted from 0 in its group, and `n`, the rows of the group."""
    counted = running(df.withColumn("one", F.lit(1).cast("bigint")), group, order, {"rank": "one"}, F.sum, label)
    return counted.withColumn("rank", F.col("rank") - 1).withColumnRenamed("rank_total", "n").drop("one")
