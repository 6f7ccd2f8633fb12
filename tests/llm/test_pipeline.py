import corpus_pipeline
from tidegate.llm.queries import ORACLES, QUERIES
from tidegate.session import settle


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns, kinds = docs.columns, docs.dtypes
        docs = settle(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert docs.columns == columns and docs.dtypes == kinds, name
    assert 0 < docs.count() < rows


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and QUERIES["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(QUERIES)
