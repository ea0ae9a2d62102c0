"""The registered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

from ledgerline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[key])
    got = QUERIES[key](spark, SF)
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(names).collect()))) == sorted(
        map(str, want.project(", ".join(names)).fetchall()))


def test_pipeline(spark):
    import corpus_pipeline
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    out = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(out) <= 3 * docs.count()
    out.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == sorted(r["doc_id"] for r in out)
    at = 0
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
