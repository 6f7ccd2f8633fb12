"""The query of quoted line breaks cuts files into many splits, but not into more tasks than large files need."""

import duckdb
import pytest
from pyspark.sql import functions as F

from catalog import scans
from tidegate.session import list_names, shared_root
from tidegate.sources.lines import read_lines


@pytest.mark.parametrize(("size", "most"), [(1 << 20, 20), (1 << 30, 270)])
def test_number_of_splits_is_bounded(spark, tmp_path, size, most):
    for name in ("a", "b"):
        with (tmp_path / f"{name}.csv").open("wb") as file:
            file.truncate(size // 2)
    lines = read_lines(scans.small_splits(spark, str(tmp_path)), str(tmp_path))
    assert 16 <= lines.rdd.getNumPartitions() <= most


def test_large_splits_end_inside_texts(spark, tmp_path, monkeypatch):
    """The rows of all ways, where splits are larger than the smallest and most of them begin inside a quoted field."""
    monkeypatch.setattr(scans, "SMALL_SPLIT", 64)
    monkeypatch.setattr(scans, "SPLITS", 24)
    rows = [(i, f'{i} "q", x\n' * (i % 7 * 30) + "end", None if i % 5 == 0 else "en", "s", i) for i in range(60)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = scans.scan_quoted_breaks(spark, str(tmp_path)).toPandas()
    documents = spark.read.parquet(str(tmp_path / "documents.parquet")).toPandas()  # noqa: F841
    want = duckdb.sql(scans.ORACLES["scan_quoted_breaks"]).df()
    key = lambda df: sorted(map(repr, df[list(want.columns)].astype(object).where(df.notna(), None).values.tolist()))
    assert key(got) == key(want)


def test_one_rendering_of_the_documents_is_kept(spark, tmp_path):
    """The files of the first two ways are gone when those of the third are made, and their rows are there."""
    rows = [(i, f"text {i}\n" * 40, "en", "s", i) for i in range(200)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(12).write.parquet(str(tmp_path / "documents.parquet"))
    root = f"{shared_root(spark)}/tidegate"
    before = set(list_names(spark, root))
    found = scans.scan_quoted_breaks(spark, str(tmp_path))
    kept = [name.rsplit("-", 1)[0] for name in set(list_names(spark, root)) - before]
    assert [name for name in kept if name.startswith("documents")] == ["documents-dat"]
    assert {(r["way"], r["n"]) for r in found.groupBy("way").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        (way, 400) for way in ("batch", "stream", "dat")}
