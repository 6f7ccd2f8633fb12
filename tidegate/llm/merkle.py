"""A Merkle manifest of a dataset: a digest per row, per group and for all, with proofs.

Leaves of a group stand in their order. Every three consecutive nodes are hashed into
one until one remains, the group's root; the groups' roots, in the order of their
names, are hashed likewise into the root.

Nodes are rolled up as nested structs. A leaf's rank is written in base three; in
blocks of 3 ** LEVELS leaves, one digit after the other is grouped away, each
time nesting what is below in an array of children. All of that happens after one
shuffle by block. The roots of blocks are the nodes of the next tier, rolled up in the
same way. On the way back each block gets the path above it by grouping, its nested
children are exploded, and each child takes the digests beside it: proofs come out of
the blocks without a join. A block holds at most 3 ** LEVELS leaves, with digests and
ids, no texts.

Rows are ordered by id, null first, then by digest: rows that share an id and differ
have a defined order, and rows that are alike give the same tree in any order. A null
group comes first. An empty table has no rows and no root. Columns other than the ones
asked for are ignored.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.slices import ranked
from tidegate.operators.numbering import number_rows
from tidegate.session import settle

ARITY = 3
LEVELS = 6  # levels of a block
PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def sized(value: Column) -> Column:
    """A value as `bytes:value`, a null as `-`: values laid end to end stay apart."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*[sized(value) for value in values])


def roll_up(nodes: DataFrame, label: str) -> DataFrame:
    """Blocks of `nodes` (grp, rank, n, digest, own): grp, block, n, digest, inner.

    `inner` nests the children down to `own`. A level is hashed only while more than one
    node of its group remains, which `n`, the group's nodes, decides.
    """
    digits = [f"digit_{level}" for level in range(LEVELS)]
    rest = nodes.select(
        "grp",
        F.expr(f"rank div {ARITY**LEVELS}").alias("block"),
        "n",
        *[F.expr(f"CAST(rank div {ARITY**level} % {ARITY} AS int)").alias(name) for level, name in enumerate(digits)],
        "digest",
        F.col("own").alias("inner"),
    ).repartition("grp", "block")
    for level, digit in enumerate(digits):
        child = F.struct(digit, "digest", "inner")
        rest = (
            rest.groupBy("grp", "block", "n", *digits[level + 1 :])
            .agg(F.array_sort(F.collect_list(child)).alias("inner"))
            .withColumn(
                "digest",
                F.when(F.col("n") > ARITY**level, F.sha2(F.array_join("inner.digest", ""), 256)).otherwise(
                    F.col("inner")[0]["digest"]
                ),
            )
        )
    return settle(rest, label, compact=True)


def tiers(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Blocks of `nodes`, blocks of those blocks, ... until each group has one."""
    found = []
    while True:
        blocks = roll_up(nodes, label)
        found.append(blocks)
        left = F.ceil(F.col("n") / ARITY**LEVELS).cast("bigint")
        if (blocks.agg(F.max(left)).first()[0] or 1) == 1:
            return found
        own = F.struct(F.col("block"), F.lit(None).cast("string").alias("presented"))
        nodes = blocks.select("grp", F.col("block").alias("rank"), left.alias("n"), "digest", own.alias("own"))


def children(blocks: DataFrame) -> DataFrame:
    """What `blocks` with `path`, `subroot` and `root` hold: grp, digest, own, and the path from there up."""
    rest = blocks
    for level in reversed(range(LEVELS)):
        beside = F.transform(
            "inner",
            lambda child, i: F.struct(
                child["digest"].alias("digest"),
                child["inner"].alias("inner"),
                F.array_join(F.slice(F.col("inner.digest"), F.lit(1), i), "").alias("left"),
                F.array_join(F.slice(F.col("inner.digest"), i + 2, F.lit(ARITY)), "").alias("right"),
            ),
        )
        step = F.array(F.struct(F.col("child.left"), F.col("child.right")))
        rest = rest.select("grp", "n", "path", "subroot", "root", F.explode(beside).alias("child")).select(
            "grp",
            "n",
            F.when(F.col("n") > ARITY**level, F.concat(step, "path")).otherwise(F.col("path")).alias("path"),
            "subroot",
            "root",
            F.col("child.digest").alias("digest"),
            F.col("child.inner").alias("inner"),
        )
    return rest.drop("n").withColumnRenamed("inner", "own")


def handed_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """`blocks` with the columns `above` has for each grp and block: two rows a group, one of each kind."""
    kinds = {"n": "bigint", "inner": blocks.schema["inner"].dataType, "path": PATH, "subroot": "string", "root": "string"}

    def row(frame: DataFrame) -> DataFrame:
        given = set(frame.columns)
        return frame.select(
            "grp", "block", *[(F.col(c) if c in given else F.lit(None).cast(kind)).alias(c) for c, kind in kinds.items()]
        )

    both = row(blocks.select("grp", "block", "n", "inner")).unionByName(row(above))
    return both.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in kinds])


def unfold(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """The rows at the bottom of `tiers`; `above` has path, subroot and root per grp."""
    above = above.withColumn("block", F.lit(0).cast("bigint"))
    for blocks in reversed(found[1:]):
        above = children(handed_down(blocks, above)).withColumn("block", F.col("own.block"))
    return children(handed_down(found[0], above))


def proofs(leaves: DataFrame) -> DataFrame:
    """Per row of `leaves` (source, doc_id, leaf, presented): these, path, subroot, root.

    `presented` is a digest to be checked, carried along. `path` has, from the leaf up,
    the digests left and right of the node.
    """
    kept = settle(leaves.withColumn("place", F.monotonically_increasing_id()), "leaves", compact=True)
    order = [F.col("doc_id").asc_nulls_first(), "leaf", "place"]
    own = F.struct("doc_id", "presented").alias("own")
    nodes = ranked(kept, "source", order, "leaf-order").select(
        F.col("source").alias("grp"), "rank", "n", F.col("leaf").alias("digest"), own
    )
    found = tiers(nodes, "blocks")
    # the last tier has one block a group: its digest is the group's root
    groups = found[-1].select("grp", F.col("digest").alias("subroot"))
    places = number_rows(groups, [F.col("grp").asc_nulls_first()], "rank", -1)
    n_groups = found[-1].count()
    one = F.lit(0).alias("one")
    tops = tiers(
        places.select(
            one.alias("grp"), "rank", F.lit(n_groups).cast("bigint").alias("n"), F.col("subroot").alias("digest"),
            F.struct(F.col("rank").alias("block"), F.col("grp").alias("source")).alias("own"),
        ),
        "group-blocks",
    )
    root = tops[-1].select(
        "grp", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root")
    )
    above = unfold(tops, root).select(
        F.col("own.source").alias("grp"), "path", F.col("digest").alias("subroot"), "root"
    )
    return unfold(found, settle(above, "group-paths", compact=True)).select(
        F.col("grp").alias("source"),
        F.col("own.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        F.col("own.presented").alias("presented"),
        "path",
        "subroot",
        "root",
    )


def proof_digest(path: Column) -> Column:
    """The digest of all digests in `path`."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def fold(path: Column, start: Column) -> Column:
    """The root that `start` leads to along `path`."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))
