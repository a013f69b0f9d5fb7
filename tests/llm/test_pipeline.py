"""The corpus pipeline and the registered text queries on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from panelkit.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")


def test_stages_keep_the_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    count = docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF_DIR)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        left = docs.count()
        assert 0 < left <= count
        count = left


def test_run_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    per = rows.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert per and all(r["sum(length)"] == r["max(doc_tokens)"] for r in per)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    with duckdb.connect() as duck:
        for path in Path(SF_DIR).glob("*.parquet"):
            duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        want = duck.execute(ORACLES[name])
        names = [d[0] for d in want.description]
        assert sorted(map(tuple, found.select(*names).collect())) == sorted(want.fetchall())
