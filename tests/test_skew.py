"""Hot keys: one player holds a third of all transactions and one transaction
id has many versions. With AQE's skew thresholds lowered so the split paths
run, results must equal a brute-force pandas computation (no rows lost)."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import keyed
from ledgerlake.plans import marts

N = 30000
HOT_PLAYER = 7
HOT_ID = 5


@pytest.fixture(scope="module")
def skewed(spark):
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )}
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    i = F.col("id")
    txns = spark.range(0, N, 1, 8).select(
        F.when(i % 10 == 0, F.lit(HOT_ID)).otherwise(i).alias("id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (i * 7919) % 2_000_000).alias("timestamp"),
        F.when(i % 3 == 0, F.lit(HOT_PLAYER)).otherwise(i % 500).alias("player_id"),
        F.element_at(F.array(F.lit("Deposit"), F.lit("Withdraw"), F.lit("Bonus")), (i % 3 + 1).cast("int")).alias("type"),
        F.when(i % 37 != 0, ((i * 31) % 100000 / 100).cast("decimal(18,2)")).alias("amount"),
    )
    players = spark.range(0, 500).select(
        i.alias("id"),
        F.when(i % 4 != 0, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("is_kyc_approved"),
        F.lit(dt.datetime(2023, 11, 20)).cast("timestamp").alias("created_at"),
    )
    yield txns, players
    for k, v in old.items():
        spark.conf.set(k, v)


def test_latest_by_key_hot_id(skewed):
    txns, _ = skewed
    got = keyed.latest_by_key(txns, "id", "timestamp").toPandas()
    pdf = txns.toPandas()
    assert len(got) == pdf["id"].nunique()
    hot = pdf[pdf["id"] == HOT_ID]
    assert got[got["id"] == HOT_ID]["timestamp"].iloc[0] == hot["timestamp"].max()


def test_gate_hot_player(skewed):
    txns, players = skewed
    got = keyed.kyc_time_gate(txns, players).toPandas()
    t, p = txns.toPandas(), players.toPandas()
    m = t.merge(p.rename(columns={"id": "player_id"}), on="player_id")
    want = m[(m["is_kyc_approved"].str.upper() == "TRUE") & (m["timestamp"] >= m["created_at"])]
    assert len(got) == len(want)
    assert (got["player_id"] == HOT_PLAYER).sum() == (want["player_id"] == HOT_PLAYER).sum()


def test_marts_hot_player(skewed):
    txns, _ = skewed
    t = txns.toPandas()
    ledger = marts.daily_ledger(txns, stamp=False).toPandas()
    dw = t[t["type"].isin(["Deposit", "Withdraw"])].copy()
    dw["d"] = dw["timestamp"].dt.date
    assert len(ledger) == dw.groupby(["player_id", "d"]).ngroups
    hot = ledger[ledger["player_id"] == HOT_PLAYER]
    want_dep = dw[(dw["player_id"] == HOT_PLAYER) & (dw["type"] == "Deposit")]["amount"].dropna().sum()
    assert hot["deposits"].dropna().sum() == want_dep
    top = marts.top_n_wide(txns, 3, stamp=False).toPandas().set_index("player_id")
    dep = t[t["type"] == "Deposit"]
    hot_dep = dep[dep["player_id"] == HOT_PLAYER]
    # nulls first (PostgreSQL DESC): the hot player has null amounts, so rank 1 is null.
    assert hot_dep["amount"].isna().any()
    assert pd.isna(top.loc[HOT_PLAYER, "first_largest_deposit"])
    assert len(top) == dep["player_id"].nunique()


def test_row_index_spreads_a_hot_sort_key(spark):
    from ledgerlake.operators import sequence

    df = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sequence.row_index(df, ["k"], "i")
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        ks = out.orderBy("i").select("k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.k for r in ks] == sorted(r.k for r in ks)
    assert out.select("i").distinct().count() == 20000
    # the hot key (a third of the rows) is not in one partition
    assert max(sizes) < 20000 // 3


def test_null_safe_join_spreads_null_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.range(0, 30000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 100).alias("k")
        )
        right = spark.range(0, 100).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("v")).union(
            spark.createDataFrame([(None, -1)], "rk long, v long")
        )
        out = keyed.null_safe_join(left, right, "k", "rk", "inner")
        rows = out.select("id", "k", "v").collect()
        assert len(rows) == 30000
        assert all((r.v == -1) if r.k is None else (r.v == r.k * 10) for r in rows)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 10000  # the 10,000 null-key rows are not in one partition
        left_out = keyed.null_safe_join(left, right.where(F.col("rk").isNotNull()), "k", "rk", "left")
        assert left_out.count() == 30000 and left_out.where(F.col("v").isNull()).count() == 10000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_player_is_salted_in_the_gate(spark, skewed):
    txns, players = skewed
    hot = keyed.hot_keys(txns, "player_id", share=0.05)
    assert hot == [HOT_PLAYER]
    salted = keyed.kyc_time_gate(txns, players, hot=hot)
    plain = keyed.kyc_time_gate(txns, players)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[1] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot_rows = salted.where(F.col("player_id") == HOT_PLAYER).count()
    assert hot_rows > 0 and max(sizes) < hot_rows  # the hot player's rows are not in one partition


def test_hot_link_first_claim_salted_equals_plain(spark):
    i = F.col("id")
    players = spark.range(0, 9000, 1, 8).select(
        i,
        F.when(i % 3 == 0, F.lit(1)).when(i % 3 == 1, i % 500).alias("affiliate_id"),
        F.timestamp_seconds(F.lit(1_600_000_000) + (i * 7919) % 100_000).alias("created_at"),
    )
    assert keyed.hot_keys(players, "affiliate_id", share=0.05) == [1]
    salted = keyed.first_claim(players, hot_key_share=0.05)
    plain = keyed.first_claim(players, hot_key_share=None)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    assert salted.where(F.col("affiliate_id") == 1).count() == 1


def test_hot_key_sketch_in_the_gate(spark, skewed):
    txns, players = skewed
    before = _jobs(spark)
    hot = keyed.hot_key_sketch(txns, "player_id", share=0.05)
    salted = keyed.kyc_time_gate(txns, players, hot=hot)
    assert _jobs(spark) == before  # nothing ran while the plan was built
    plain = keyed.kyc_time_gate(txns, players)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


def _jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_sketch_misses_no_key_above_the_share(spark):
    # 10,000 different keys besides three that hold 30, 5 and 1.2 %; nulls hold 10 %
    i = F.col("id")
    k = F.when(i % 10 < 3, -1).when(i % 20 == 3, -2).when(i % 1000 < 520, F.when(i % 1000 >= 508, -3)).otherwise(i % 10007)
    df = spark.range(0, 200000, 1, 8).select(k.alias("k"))
    found = keyed.hot_keys(df, "k", share=0.01)
    counts = {r[0]: r[1] for r in df.groupBy("k").count().collect()}
    must = {x for x, n in counts.items() if x is not None and n >= 2000}
    assert must <= set(found) and len(found) <= 100 and None not in found
    assert all(counts[x] >= 1500 for x in found)  # the sketch's error is a small part of the share


def test_clean_transactions_scans_once_and_runs_nothing_early(spark):
    from ledgerlake.plans import clean
    from ledgerlake.sources import staging

    sf = "/root/testdata/sf0.001"
    players = clean.clean_players(staging.raw_players(spark, sf), staging.raw_affiliates(spark, sf))
    raw = staging.raw_transactions(spark, sf)  # reads a file's schema
    before = _jobs(spark)
    df = clean.clean_transactions(raw, players)
    assert _jobs(spark) == before
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("+- == Initial Plan ==\n   ")] if "+- == Initial Plan ==\n   " in final else final
    assert "approx_top_k" in df._jdf.queryExecution().optimizedPlan().toString()
    assert "ReusedExchange" in final


FORMS_DATA = [
    # key, sort, a, b: null sort wins, ties on sort, a null key, identical rows
    (1, 5, "x", 1), (1, 7, "y", 2), (1, None, "z", 3), (2, 4, "p", 1), (2, 4, "q", 0), (2, 4, None, 9),
    (3, 1, "one", 1), (None, 2, "n", 1), (None, 3, "m", 1), (4, 8, "s", 1), (4, 8, "s", 1),
    (5, None, "a", 1), (5, None, "b", 1), (6, -(2**63), "low", 1), (6, 2**63 - 1, "high", 1), (7, 2**63 - 1, "v", 1), (7, None, "null", 1),
]


@pytest.mark.parametrize("form", ["struct", "hash", "window"])
def test_latest_forms_agree(spark, form):
    df = spark.createDataFrame(FORMS_DATA, "k long, t long, a string, b int").repartition(4)
    got = sorted(map(str, keyed.latest_by_key(df, "k", "t", form=form).collect()))
    want = {1: (1, None, "z", 3), 2: (2, 4, "q", 0), 3: (3, 1, "one", 1), None: (None, 3, "m", 1), 4: (4, 8, "s", 1),
            5: (5, None, "b", 1), 6: (6, 2**63 - 1, "high", 1), 7: (7, None, "null", 1)}
    assert got == sorted(map(str, spark.createDataFrame(list(want.values()), df.schema).collect()))


@pytest.mark.parametrize("form", ["struct", "hash", "window"])
def test_latest_forms_on_a_hot_key(skewed, form):
    txns, _ = skewed
    got = keyed.latest_by_key(txns, "id", "timestamp", form=form)
    assert sorted(map(str, got.collect())) == sorted(map(str, keyed.latest_by_key(txns, "id", "timestamp").collect()))


def test_hash_form_sorts_only_what_ties(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 300).alias("k"), F.timestamp_seconds("id").alias("t"), F.lit("x").alias("v"))
    out = keyed.latest_by_key(df, "k", "t", form="hash")
    assert out.count() == 300
    p = out._jdf.queryExecution().executedPlan().toString()
    p = p[: p.index("== Initial Plan ==")] if "== Initial Plan ==" in p else p
    alone = p[: p.index("SortAggregate")]  # the branch of keys with several rows comes second
    assert "HashAggregate" in alone and "Sort [" not in alone and "SortMergeJoin" not in p
    with pytest.raises(ValueError):
        keyed.latest_by_key(df, "k", "v", form="hash")
