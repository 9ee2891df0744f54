"""One small frame per semantics-ledger item that changes a result."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import coerce
from ledgerlake.operators import aggregates, keyed, sequence
from ledgerlake.plans import marts
from ledgerlake.schemas import AMOUNT

TS = T.TimestampType()


def ts(s):
    return dt.datetime.fromisoformat(s)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_l1_null_sort_value_wins(spark):
    df = frame(spark, [(1, "a", ts("2024-01-02")), (1, "b", None), (1, "c", ts("2024-03-01"))], "id long, v string, u timestamp")
    assert [r.v for r in keyed.latest_by_key(df, "id", "u").collect()] == ["b"]


def test_l2_ties_are_deterministic(spark):
    rows = [(1, "a", ts("2024-01-02")), (1, "z", ts("2024-01-02")), (1, "m", ts("2024-01-02"))]
    df = frame(spark, rows, "id long, v string, u timestamp")
    for parts in (1, 3):
        got = keyed.latest_by_key(df.repartition(parts), "id", "u").collect()
        assert [r.v for r in got] == ["z"]


def test_l4_null_keys_form_one_group(spark):
    df = frame(spark, [(None, "a", ts("2024-01-01")), (None, "b", ts("2024-02-01")), (2, "c", None)], "id long, v string, u timestamp")
    got = sorted((r.id is None, r.v) for r in keyed.latest_by_key(df, "id", "u").collect())
    assert got == [(False, "c"), (True, "b")]


def test_l5_first_claimant_nulls_last(spark):
    rows = [(1, 7, None), (2, 7, ts("2024-05-01")), (3, 7, ts("2024-06-01")), (4, None, ts("2020-01-01"))]
    df = frame(spark, rows, "id long, affiliate_id long, created_at timestamp")
    got = {r.id: r.affiliate_id for r in keyed.first_claim(df).collect()}
    assert got == {1: None, 2: 7, 3: None, 4: None}


def test_dangling_link_nulled_row_kept(spark):
    players = frame(spark, [(1, 5), (2, 6), (3, None)], "id long, affiliate_id long")
    affs = frame(spark, [(5,), (None,)], "id long")
    got = {r.id: r.affiliate_id for r in keyed.null_dangling(players, "affiliate_id", affs).collect()}
    assert got == {1: 5, 2: None, 3: None}
    assert [r.id for r in keyed.dangling_links(players, "affiliate_id", affs).collect()] == [2]


def test_link_claims_equals_two_steps(spark):
    rows = [(i, (i * 7) % 13 if i % 3 else None, ts(f"2024-01-{1 + i % 5:02d}")) for i in range(60)]
    players = frame(spark, rows, "id long, affiliate_id long, created_at timestamp")
    affs = frame(spark, [(k,) for k in range(0, 13, 2)], "id long")
    fused = sorted(map(tuple, keyed.link_claims(players, "affiliate_id", affs).collect()))
    two = sorted(map(tuple, keyed.first_claim(keyed.null_dangling(players, "affiliate_id", affs)).collect()))
    assert fused == two


def test_l6_l7_timestamp_parsing(spark):
    texts = ["2024-01-10 17:07:01+00:00", "2024/01/10", "2024-01-10", "bad", None, "2024-01-10 17:07:01+02:00"]
    df = frame(spark, [(t,) for t in texts], "t string")
    got = [r.p for r in df.select(coerce.utc_timestamp("t").alias("p")).collect()]
    assert got == [ts("2024-01-10 17:07:01"), None, None, None, None, ts("2024-01-10 15:07:01")]


def test_l8_l9_whole_number_ids(spark):
    texts = ["9", "9.0", "1.5", "x", "", "9007199254740993"]
    df = frame(spark, [(t,) for t in texts], "t string")
    got = [r.p for r in df.select(coerce.whole_number("t").alias("p")).collect()]
    assert got == [9, 9, None, None, None, 9007199254740993]


def test_l10_truth_text(spark):
    texts = ["TRUE", "true", "True", "t", "yes", "1", None, "FALSE"]
    df = frame(spark, [(t,) for t in texts], "t string")
    assert [r.p for r in df.select(coerce.truth_text("t").alias("p")).collect()] == [
        True, True, True, False, False, False, False, False
    ]
    b = frame(spark, [(True,), (False,), (None,)], "t boolean")
    assert [r.p for r in b.select(coerce.truth_text("t").alias("p")).collect()] == [True, False, False]


def test_l11_null_tokens(spark, tmp_dir):
    from ledgerlake.sources import files

    path = f"{tmp_dir}/players"
    import os

    os.makedirs(path)
    with open(f"{path}/p.csv", "w") as f:
        f.write("id,country_code\n1,NA\n2,DE\n3,\n")
    parity = {r.id: r.country_code for r in files.read_csv(spark, path, T.StructType([T.StructField("id", T.LongType())])).collect()}
    assert parity == {1: None, 2: "DE", 3: None}
    kept = {r.id: r.country_code for r in files.read_csv(spark, path, T.StructType([T.StructField("id", T.LongType())]), na_tokens=()).collect()}
    assert kept[1] == "NA"


def test_l16_null_safe_gate(spark):
    txns = frame(spark, [(1, ts("2024-02-01"), None, "Deposit", Decimal("5.00")), (2, ts("2024-02-01"), 3, "Deposit", Decimal("6.00"))],
                 T.StructType([T.StructField("id", T.LongType()), T.StructField("timestamp", TS), T.StructField("player_id", T.LongType()),
                               T.StructField("type", T.StringType()), T.StructField("amount", AMOUNT)]))
    players = frame(spark, [(None, "TRUE", ts("2024-01-01")), (3, "TRUE", ts("2024-03-01"))], "id long, is_kyc_approved string, created_at timestamp")
    assert [r.id for r in keyed.kyc_time_gate(txns, players).collect()] == [1]


def _txns(spark, rows):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("timestamp", TS), T.StructField("player_id", T.LongType()),
                           T.StructField("type", T.StringType()), T.StructField("amount", AMOUNT)])
    return frame(spark, rows, schema)


def test_l13_null_amount_ranks_first_and_l20_null_sum(spark):
    rows = [
        (1, ts("2024-01-01 10:00:00"), 1, "Deposit", Decimal("10.00")),
        (2, ts("2024-01-02 10:00:00"), 1, "Deposit", None),
        (3, ts("2024-01-03 10:00:00"), 1, "Deposit", Decimal("30.00")),
        (4, ts("2024-01-04 10:00:00"), 1, "Deposit", Decimal("20.00")),
        (5, ts("2024-01-05 10:00:00"), 2, "Deposit", None),
        (6, ts("2024-01-05 11:00:00"), 2, "Bonus", Decimal("1.00")),
    ]
    t = _txns(spark, rows)
    top = {r.player_id: r for r in marts.top_n_wide(t, 3).collect()}
    assert top[1].first_largest_deposit is None
    assert top[1].second_largest_deposit == Decimal("30.00")
    assert top[1].third_largest_deposit == Decimal("20.00")
    ledger = {(r.player_id, r.transaction_date): r for r in marts.daily_ledger(t).collect()}
    assert ledger[(2, dt.date(2024, 1, 5))].deposits is None
    assert ledger[(2, dt.date(2024, 1, 5))].summary is None


def test_l21_bonus_only_day_has_no_row(spark):
    t = _txns(spark, [(1, ts("2024-01-01 10:00:00"), 1, "Bonus", Decimal("5.00"))])
    assert marts.daily_ledger(t).count() == 0


def test_segment_totals_counts_like_sql_with_repeated_players(spark):
    players = frame(spark, [(1, 1, "DE", True), (1, 1, "FR", True), (2, 2, "DE", True)],
                    "id long, affiliate_id long, country_code string, is_kyc_approved boolean")
    affs = frame(spark, [(1, "Discord"), (2, "Discord")], "id long, origin string")
    t = _txns(spark, [(1, ts("2024-01-01"), 1, "Deposit", Decimal("10.00")), (2, ts("2024-01-01"), 2, "Deposit", Decimal("1.00"))])
    got = {r.country_code: (r.deposit_count, r.total_deposits) for r in marts.segment_totals(players, affs, t).collect()}
    # Player 1 has two country codes, so each of its deposits counts twice per country (SQL semantics).
    assert got == {"DE": (3, Decimal("21.00")), "FR": (2, Decimal("20.00"))}


def test_a7_next_identifier_empty_and_null(spark):
    empty = frame(spark, [], "id long")
    nulls = frame(spark, [(None,), (None,)], "id long")
    assert aggregates.id_stats(empty).first().next_id == 1
    r = aggregates.id_stats(nulls, target=5).first()
    assert (r.next_id, r.distinct_ids, r.shortfall) == (1, 1, 4)


def test_row_index_matches_global_order(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = sequence.row_index(df, ["k"], "i").orderBy("k").collect()
    assert [r.i for r in got] == list(range(5000))


def test_l14_display_order_nulls_last(spark):
    df = frame(spark, [(None, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (1, None), (1, dt.date(2024, 1, 1))],
               "player_id long, transaction_date date")
    got = [(r.player_id, r.transaction_date) for r in marts.display_order("daily_ledger", df).collect()]
    assert got == [(1, dt.date(2024, 1, 1)), (1, None), (2, dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 1))]


def test_l24_linked_creation_time_wins(spark):
    affs = frame(spark, [(1, "A", None, ts("2020-01-01")), (2, "B", None, ts("2020-01-01")), (3, "C", None, None)],
                 "id long, code string, origin string, redeemed_at timestamp")
    players = frame(spark, [(10, 1, ts("2024-05-05")), (11, None, ts("2024-06-06")), (12, 3, None)],
                    "id long, affiliate_id long, created_at timestamp")
    got = {r.id: r.redeemed_at for r in keyed.fill_from_linked(affs, players).collect()}
    assert got == {1: ts("2024-05-05"), 2: ts("2020-01-01"), 3: None}


def test_l26_pandas_nanosecond_parquet(spark, tmp_dir):
    import pandas as pd

    from ledgerlake.schemas import PLAYERS
    from ledgerlake.sources import files

    pdf = pd.DataFrame({"id": [1, 2], "created_at": pd.to_datetime(["2024-01-10 17:07:01.123456+00:00", None], utc=True)})
    pdf.to_parquet(f"{tmp_dir}/p.parquet", index=False)
    schema = T.StructType([PLAYERS["id"], PLAYERS["created_at"]])
    got = sorted(files.read_parquet(spark, f"{tmp_dir}/p.parquet", schema).collect(), key=lambda r: r.id)
    assert got[0].created_at == dt.datetime(2024, 1, 10, 17, 7, 1, 123456) and got[1].created_at is None


def test_l28_versions_all_counts_stale_approval(spark):
    from ledgerlake.plans import increment

    players = frame(spark, [(1, None, "DE", "TRUE", ts("2024-01-01"), ts("2024-01-01")),
                            (1, None, "DE", "FALSE", ts("2024-01-01"), ts("2024-02-01"))],
                    "id long, affiliate_id long, country_code string, is_kyc_approved string, created_at timestamp, updated_at timestamp")
    base = frame(spark, [(1, ts("2024-01-05"), 1, "Deposit", None)],
                 "id long, timestamp timestamp, player_id long, type string, amount decimal(18,2)")
    assert increment.extend_transactions(base, players, 10) is base  # latest version is not approved
    assert increment.extend_transactions(base, players, 10, versions="all").count() == 10


def test_l15_day_boundary_is_utc(spark):
    from ledgerlake.session import configure

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        configure(spark)  # the engine pins UTC again
        t = _txns(spark, [(1, ts("2024-01-01 23:30:00"), 1, "Deposit", Decimal("5.00"))])
        assert [r.transaction_date for r in marts.daily_ledger(t).collect()] == [dt.date(2024, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_display_order_of_segment_totals_and_top_n(spark):
    seg = frame(spark, [("A", 1, Decimal("5.00")), ("B", 1, None), ("C", 2, Decimal("9.00"))],
                "country_code string, deposit_count long, total_deposits decimal(18,2)")
    assert [r.country_code for r in marts.display_order("segment_totals", seg).collect()] == ["B", "C", "A"]
    top = frame(spark, [(None,), (2,), (1,)], "player_id long")
    assert [r.player_id for r in marts.display_order("top_n_wide", top).collect()] == [1, 2, None]
