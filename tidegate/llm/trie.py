"""The trie of conversation prefixes, by peeling truncations from the deepest up.

Every distinct sequence of first turns is a node. From the greatest depth down, the
conversations that end at a depth are merged with the nodes that survive from the depth
below; their last turn is stripped, and they are grouped anew. So a node's members,
children, leaves and savings are summed up while it is found, each depth once.

Rows carry digests in place of turns: a turn is the SHA-256 of its role and text, and a
prefix has for its key the exclusive or of the digests of its turns with their places,
256 bits that a running value over slices gives every row, however long a conversation
is. To strip a turn is to go from a key to its parent's. Prefixes that one conversation
alone has are complete as they are and are set aside first, so a long conversation that
shares little does not lengthen the peeling: there is one round per depth that two
conversations share, and rounds read the rows of their own depth only.

Turns stand in the order of turn (null first), role and digest, so rows that share
a turn have a defined order, and rows that are alike are turns one after the other. Null
role and text count as empty. Rows without conv_id belong to no conversation and are
left out. An empty table has no nodes, not even the root. Other columns are ignored.
"""

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.slices import ranked, running
from tidegate.session import new_folder, settle

WORDS = 4  # 64-bit words of a prefix key
ENDS_SPAN = 1 << 16  # conv_ids whose texts are joined in one row
ROOT = ".".join(["0"] * WORDS)
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, depth (from 1), n (turns of the conversation), digest, n_chars."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("bigint").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    placed = ranked(settle(rows, "turns"), "conv_id", order, "turn-order")
    return placed.select("conv_id", (F.col("rank") + 1).alias("depth"), "n", "digest", "n_chars")


def branched(turns: DataFrame, head: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first `head` turns are those of the conversation `base`.

    `head` and `base` are expressions over conv_id. The base's turns stand for all it has
    if it has fewer, none if it is absent; own turns after the first `head` follow.
    Returns rows like `turns`, and the conv_ids that have no turn.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("n").alias("n"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plans = sizes.select("conv_id", "n", head.cast("bigint").alias("head"), base.cast("bigint").alias("base"))
    plans = plans.join(bases, "base", "left").withColumn(
        "taken", F.least("head", F.coalesce("n_base", F.lit(0)))
    )
    plans = settle(
        plans.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).select(
            "conv_id", "head", "base", "taken", "total"
        ),
        "branches",
    )
    most = plans.agg(F.max("taken")).first()[0] or 0
    heads = (
        turns.filter(F.col("depth") <= most)
        .select(F.col("conv_id").alias("base"), "depth", "digest", "n_chars")
        .join(plans, "base")
        .filter(F.col("depth") <= F.col("taken"))
        .select("conv_id", "depth", F.col("total").alias("n"), "digest", "n_chars")
    )
    shift = F.col("taken") - F.col("head")
    own = (
        turns.drop("n")
        .join(plans, "conv_id")
        .filter(F.col("depth") > F.col("head"))
        .select("conv_id", (F.col("depth") + shift).alias("depth"), F.col("total").alias("n"), "digest", "n_chars")
    )
    return heads.unionByName(own), plans.filter("total = 0").select("conv_id")


def keyed(turns: DataFrame) -> DataFrame:
    """Per turn: conv_id, depth, key and parent of the prefix it ends, n_chars, ends."""
    words = [f"word_{i}" for i in range(WORDS)]
    mixed = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), "digest"), 256)
    pieces = {
        word: F.conv(F.substring(mixed, 1 + 16 * i, 16), 16, -10).cast("bigint") for i, word in enumerate(words)
    }
    rows = turns.withColumns(pieces).drop("digest")
    rows = running(rows, "conv_id", ["depth"], {f"prefix_{w}": w for w in words}, F.bit_xor, "prefixes")
    prefix = [F.col(f"prefix_{word}") for word in words]
    return rows.select(
        "conv_id",
        "depth",
        F.concat_ws(".", *prefix).alias("key"),
        F.concat_ws(".", *[whole.bitwiseXOR(F.col(word)) for whole, word in zip(prefix, words)]).alias("parent"),
        "n_chars",
        (F.col("depth") == F.col("n")).alias("ends"),
    )


def prefixes(rows: DataFrame) -> DataFrame:
    """Per distinct prefix: who ends there, and the prefix without its last turn."""
    return rows.groupBy("depth", "key").agg(
        F.max("parent").alias("parent"),
        F.max("n_chars").alias("n_chars"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("first"),
        F.count_if("ends").alias("n_ended"),
        F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("ended"),
    )


def by_depth(found: DataFrame, label: str) -> DataFrame:
    """`found` written with a folder per depth."""
    path = new_folder(found.sparkSession, label)
    found.repartitionByRange("depth", "key").write.partitionBy("depth").parquet(path)
    names = [name for name in found.columns if name != "depth"]
    schema = ", ".join(f"{name} {found.schema[name].dataType.simpleString()}" for name in [*names, "depth"])
    return found.sparkSession.read.schema(schema).parquet(path)


def peel(shared: DataFrame, alone: DataFrame, turnless: DataFrame) -> DataFrame:
    """The nodes of shared prefixes, from the deepest up: conv_id, depth, key, parent and SUMS."""
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    zero = F.lit(0).cast("bigint")

    def survivors(nodes: DataFrame) -> DataFrame:
        """Nodes of the depth below without their last turn."""
        return nodes.select(
            F.col("parent").alias("key"), F.lit(None).cast("string").alias("parent"),
            F.lit(None).cast("bigint").alias("n_chars"), "conv_id", "n_convs", F.lit(1).cast("bigint").alias("n_children"),
            "n_leaves", "saved_tokens",
        )

    def ended(found: DataFrame) -> DataFrame:
        """The prefixes of this depth, with the conversations that end there."""
        return found.select(
            "key", "parent", "n_chars", F.col("ended").alias("conv_id"), F.col("n_ended").alias("n_convs"),
            zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"),
        )

    found, nodes = [], None
    for depth in range(deepest, -1, -1):
        if depth:
            here = shared.filter(F.col("depth") == depth)
        else:
            here = turnless.agg(F.count(F.lit(1)).alias("n_ended"), F.min("conv_id").alias("ended")).select(
                F.lit(ROOT).alias("key"), F.lit("").alias("parent"), zero.alias("n_chars"), "n_ended", "ended"
            )
        single = alone.filter(F.col("depth") == depth + 1).select(
            "parent", F.col("first").alias("conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
            F.lit(1).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens"),
        )
        merged = ended(here).unionByName(survivors(single))
        if nodes is not None:
            merged = merged.unionByName(survivors(nodes))
        grouped = merged.groupBy("key").agg(
            F.max("parent").alias("parent"),
            F.max("n_chars").alias("n_chars"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(name).alias(name) for name in SUMS],
        )
        # a group without a prefix of this depth is a prefix that one conversation alone has
        whole = grouped.filter(F.col("parent").isNotNull() & (F.col("n_convs") > 0)).select(
            "conv_id",
            F.lit(depth).cast("bigint").alias("depth"),
            "key",
            "parent",
            "n_convs",
            "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
        )
        nodes = settle(whole, "trie")
        found.append(nodes)
    return reduce(DataFrame.unionByName, found)


def ends_digests(ends: DataFrame) -> DataFrame:
    """Per depth and key of `ends`: the digest of its conv_ids in order.

    Ids are first joined in rows of ENDS_SPAN consecutive numbers. The digest of a node
    takes its rows one after the other, as a digest has to; none is held.
    """
    span = F.expr(f"(conv_id - pmod(conv_id, {ENDS_SPAN})) div {ENDS_SPAN}")
    pieces = ends.groupBy("depth", "key", span.alias("span")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def row() -> pa.RecordBatch:
            names = ["depth", "key", "ends_sha256"]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names)

        for batch in batches:
            for depth, key, ids in zip(*(batch.column(name).to_pylist() for name in ("depth", "key", "ids"))):
                if (depth, key) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        yield row()
                    node, state = (depth, key), hashlib.sha256()
                state.update(ids.encode())
        if node is not None:
            yield row()

    dealt = pieces.repartition("depth", "key").sortWithinPartitions("depth", "key", "span").drop("span")
    return dealt.mapInArrow(run, "depth bigint, key string, ends_sha256 string")


def build(turns: DataFrame, turnless: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` are rows like those of `turn_rows`; `turnless` has the conv_ids without any.
    """
    rows = settle(keyed(turns), "keyed", compact=True)
    turnless = settle(turnless, "turnless")
    found = by_depth(prefixes(rows), "prefixes")
    shared, alone = found.filter("n > 1"), found.filter("n = 1")
    nodes = settle(peel(shared, alone, turnless), "nodes", compact=True)

    ended = rows.filter("ends").select("conv_id", "depth", "key").unionByName(
        turnless.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("key"))
    )
    none = F.sha2(F.lit(""), 256)
    many = nodes.join(ends_digests(ended), ["depth", "key"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", none)
    )
    one, last = F.lit(1).cast("bigint"), F.col("n_ended") > 0
    single = alone.select(
        F.col("first").alias("conv_id"),
        F.col("depth").cast("bigint").alias("depth"),
        "key",
        "parent",
        one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("first").cast("string"), 256)).otherwise(none).alias("ends_sha256"),
    )
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    return many.unionByName(single).join(above, ["depth", "parent"], "left").select(
        "conv_id",
        "depth",
        # a parent that is no shared node is a prefix of the same conversation alone
        F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"),
        *SUMS,
        "ends_sha256",
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = turn_rows(conversations)
    return build(turns, turns.select("conv_id").limit(0))
