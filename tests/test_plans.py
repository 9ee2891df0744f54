"""Physical-plan properties the scale design relies on (checked on the
optimised plan, so a regression shows up as a failing test)."""

import pytest
from pyspark.sql import functions as F

from ledgerlake import queries as Q
from ledgerlake.operators import keyed, sequence

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_trims_groups_before_the_shuffle(spark):
    p = plan(Q.REGISTRY["top_n_wide"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_aggregates_combine_map_side(spark):
    ledger = plan(Q.REGISTRY["daily_ledger"](spark, SF))
    assert "partial_sum" in ledger
    latest = plan(Q.REGISTRY["latest_by_key"](spark, SF))
    assert "partial_max" in latest


def test_scans_read_only_needed_columns(spark):
    p = plan(Q.REGISTRY["daily_ledger"](spark, SF))
    orders_scan = [line for line in p.splitlines() if "orders.parquet" in line and "ReadSchema" in line]
    assert orders_scan and all("o_orderpriority" not in line for line in orders_scan)


def test_row_index_has_no_single_partition_window(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") * 7 % 1000).alias("k"))
    p = plan(sequence.row_index(df, ["k"], "i"))
    assert "Window" not in p


@pytest.mark.parametrize("hot", [(), [3]])
def test_gate_is_one_join_without_union(spark, hot):
    t = spark.range(0, 100).select(F.col("id"), F.current_timestamp().alias("timestamp"), (F.col("id") % 7).alias("player_id"))
    p = spark.range(0, 7).select(F.col("id"), F.lit("TRUE").alias("is_kyc_approved"), F.lit(None).cast("timestamp").alias("created_at"))
    gate = plan(keyed.kyc_time_gate(t, p, hot=hot))
    assert "Union" not in gate
