"""Every registered query against its SQL oracle on the smallest driver
tables, and determinism under a different shuffle partition count."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from ledgerlake import queries as Q  # noqa: E402
from check_oracle import TABLES, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_matches_oracle(spark, duck, name):
    result = E.queries()[name](spark, SF)
    sdf = result.toPandas()
    sql = E.oracle_sql()
    assert name in sql
    odf = duck.execute(sql[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert _rows(sdf) == _rows(odf)
    # Stricter forms a comparison tool might use: text of each pandas cell,
    # and the repr of each Python value.
    cols = sorted(sdf.columns)
    as_text = lambda df: sorted(map(tuple, df[cols].astype(str).values.tolist()))
    assert as_text(sdf) == as_text(odf)
    srows = [tuple(r[c] for c in cols) for r in result.collect()]
    quoted = ", ".join(f'"{c}"' for c in cols)
    orows = duck.execute(f"SELECT {quoted} FROM ({sql[name]})").fetchall()
    as_repr = lambda rows: sorted(tuple(map(repr, r)) for r in rows)
    assert as_repr(srows) == as_repr(orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "transaction_date" in df.columns


@pytest.mark.parametrize("name", ["clean_players", "top_n_wide", "extend_affiliates"])
def test_same_result_other_partitioning(spark, name):
    q = E.queries()[name]
    before = sorted(map(str, q(spark, SF).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        after = sorted(map(str, q(spark, SF).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert before == after


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_oracle_column_types_match(spark, duck, name):
    spark_types = dict(E.queries()[name](spark, SF).dtypes)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_types.items()} == duck_types
