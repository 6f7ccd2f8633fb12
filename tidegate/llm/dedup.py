"""Exact dedup by a skew-safe combine.

Rows are grouped by the digest of their text, a salt and the text itself: each map
task first merges what it holds, then the shuffle merges the salted groups, so a
text that fills a third of all rows arrives as at most one row per task and salt.
The winners of the salts are then merged by digest and text. Texts themselves are
group keys in every stage, so a digest never decides alone.

Only digests go back to the documents. If different texts share a digest, those
documents are joined on the texts instead.

Of equal texts the row with the largest doc_id stays, a null doc_id counting as the
smallest. Null counts as the empty text. Rows that repeat doc_id and text are one
document: `find_copies` gives each its row, `drop_copies` keeps one of them, the one
whose other columns hash highest. Other columns, also those named like ours, are kept.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tidegate.session import settle

SALTS = 16


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def prepared(documents: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    content = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return documents.select(
        doc_id.alias("doc_id"),
        content.alias("content"),
        digest(content).alias("digest"),
        F.pmod(F.xxhash64(doc_id), F.lit(SALTS)).cast("int").alias("salt"),
    )


def combine(rows: DataFrame) -> DataFrame:
    """Per text: digest, content, keep_id, group_size."""
    salted = rows.groupBy("digest", "salt", "content").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return salted.groupBy("digest", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def find_copies(documents: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = prepared(documents, digest)
    groups = combine(rows).groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    groups = settle(groups, "copies", compact=True)
    hashed = prepared(documents, digest).select("doc_id", "digest", F.sha2("content", 256).alias("text_sha256"))
    found = hashed.join(groups.filter("texts = 1"), "digest").drop("texts")
    mixed = groups.filter("texts > 1").select("digest")
    if not mixed.isEmpty():
        shared = rows.join(mixed, "digest", "left_semi")
        apart = shared.join(combine(shared), ["digest", "content"])
        text_sha256 = F.sha2("content", 256).alias("text_sha256")
        found = found.unionByName(apart.select("doc_id", "digest", text_sha256, "keep_id", "group_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def hashable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(hashable(field.dataType) for field in kind)
    return not isinstance(kind, MapType)


def drop_copies(documents: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with its own columns; no row is joined back."""
    content = F.coalesce(F.col("text"), F.lit(""))
    order = F.struct(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")),
        F.xxhash64(*[quoted(f.name) for f in documents.schema if f.name != "text" and hashable(f.dataType)]),
    )
    row = F.struct(*[quoted(name) for name in documents.columns if name != "text"], F.col("text").isNull().alias("no text"))
    rows = documents.select(
        sha256(content).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
        content.alias("content"),
        row.alias("row"),
        order.alias("order"),
    )
    salted = rows.groupBy("digest", "salt", "content").agg(
        F.max_by("row", "order").alias("row"), F.max("order").alias("order")
    )
    best = salted.groupBy("digest", "content").agg(F.max_by("row", "order").alias("row"))
    text = F.when(~F.col("row")["no text"], F.col("content")).alias("text")
    return best.select(*[text if name == "text" else F.col("row")[name].alias(name) for name in documents.columns])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
