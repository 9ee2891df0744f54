"""The registered queries next to their SQL twins, and the pipeline's stages."""

import pytest

import corpus_pipeline
from ledgerlake.llm.queries import ORACLES, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_query_runs_on_all_rows(spark, name):
    table = "embeddings" if "vector" in name else "documents"
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    got = queries()[name](spark, SF).count()
    assert got == (n + 49) // 50 * 5 if name.startswith("op6") else got >= n


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "jaccard_join", "mix_sources", "best_fit_packing"]
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert first.columns == docs.columns
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
