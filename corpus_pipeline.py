"""Clean a corpus: toxicity, exact copies, near copies, benchmark passages, then token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes each
stage's rows to the folder that executors share and goes on from the written table.

All stages but the last return the columns they were given, of the documents they keep.
The last one returns the ids of the text and where each token begins in it, with the
other columns and without the text, which the ids stand for. Documents whose text is
null or empty are kept as far as no stage finds them to be copies.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import bpe, decontamination, dedup, near, toxicity
from tidegate.session import settle

RANKS = "byte_bpe_multi_50k.tiktoken"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(docs, bpe.read_ranks(public_tokenizers.path(RANKS)))
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint")).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE encoding and decoding", encode),
]

# The classifier, the tokenizer and the classes of near copies are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.split()[0].lower(), compact=True)
    return docs
