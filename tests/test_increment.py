"""Seed stability, no-op cases, padding ids and code clashes."""

import datetime as dt


from ledgerlake.plans import increment


def players(spark, rows):
    return spark.createDataFrame(
        rows, "id long, affiliate_id long, country_code string, is_kyc_approved string, created_at timestamp, updated_at timestamp"
    )


def affiliates(spark, rows):
    return spark.createDataFrame(rows, "id long, code string, origin string, redeemed_at timestamp")


def txns(spark, rows):
    return spark.createDataFrame(rows, "id long, timestamp timestamp, player_id long, type string, amount decimal(18,2)")


T0 = dt.datetime(2024, 1, 1)


def test_players_seed_stable_and_rules(spark):
    base = players(spark, [(1, 3, "DE", "TRUE", T0, T0), (2, None, "BR", "FALSE", T0, T0)])
    a = sorted(map(tuple, increment.extend_players(base, 50, seed=7).collect()), key=str)
    b = sorted(map(tuple, increment.extend_players(base, 50, seed=7).collect()), key=str)
    assert a == b and len(a) == 50
    new = [r for r in a if r[0] > 2]
    assert sorted(r[0] for r in new) == list(range(3, 51))
    links = sorted(r[1] for r in new if r[1] is not None)
    assert links == list(range(4, 4 + len(links)))  # running max + 1 from the base max (3)
    assert {r[2] for r in new} <= set(increment.COUNTRIES)
    as_of = dt.datetime(2025, 9, 1)
    assert all(as_of - dt.timedelta(days=365) <= r[4] <= as_of and r[4] == r[5] for r in new)


def test_no_change_at_target(spark):
    base = players(spark, [(1, None, "DE", "TRUE", T0, T0), (2, None, "DE", "TRUE", T0, T0)])
    assert increment.extend_players(base, 2) is base
    t = txns(spark, [(1, T0, 1, "Deposit", None)])
    no_kyc = players(spark, [(1, None, "DE", "FALSE", T0, T0)])
    assert increment.extend_transactions(t, no_kyc, 10) is t


def test_affiliates_padding_and_links(spark):
    base = affiliates(spark, [(1, "AAAAAA", "X", None), (2, "BBBBBB", None, None)])
    ps = players(spark, [(10, 3, "DE", "TRUE", T0, T0), (11, 1, "DE", "TRUE", T0, T0), (12, 4, "DE", "TRUE", T0, T0)])
    out = increment.extend_affiliates(base, ps, 6)
    new = sorted((r.id, r.redeemed_at) for r in out.collect() if r.code not in ("AAAAAA", "BBBBBB"))
    # linked ids ≥ start (3): 3 then 4 in player order, then padding 5, 6
    assert [i for i, _ in new] == [3, 4, 5, 6]
    assert new[0][1] == T0 and new[2][1] is None
    codes = [r.code for r in out.collect()]
    assert len(set(codes)) == len(codes)


def test_affiliates_no_links_start_plus_one(spark):
    base = affiliates(spark, [(1, "AAAAAA", "X", None)])
    ps = players(spark, [(10, None, "DE", "TRUE", T0, T0)])
    ids = sorted(r.id for r in increment.extend_affiliates(base, ps, 3).collect())
    assert ids == [1, 3, 4]


def test_code_clash_gets_extra_letter(spark):
    base = affiliates(spark, [(1, "ZZZZZZ", None, None)])
    ps = players(spark, [(10, None, "DE", "TRUE", T0, T0)])
    clean_run = increment.extend_affiliates(base, ps, 3)
    new_codes = [r.code for r in clean_run.collect() if r.id != 1]
    clash_base = affiliates(spark, [(1, new_codes[0], None, None)])
    out = [r.code for r in increment.extend_affiliates(clash_base, ps, 3).collect()]
    assert len(set(out)) == len(out)
    assert any(len(c) == 7 for c in out)


def test_transactions_rules(spark):
    ps = players(spark, [(1, None, "DE", "TRUE", dt.datetime(2025, 8, 1), None), (2, None, "DE", "FALSE", T0, T0),
                         (3, None, "DE", "true", dt.datetime(2025, 9, 1), None), (4, None, "DE", "TRUE", dt.datetime(2026, 1, 1), None)])
    base = txns(spark, [(5, T0, 1, "Deposit", None)])
    out = increment.extend_transactions(base, ps, 400, seed=3)
    new = [r for r in out.collect() if r.id > 5]
    assert len(new) == 399 and sorted(r.id for r in new) == list(range(6, 405))
    assert {r.player_id for r in new} <= {1, 3, 4}
    created = {1: dt.datetime(2025, 8, 1), 3: dt.datetime(2025, 9, 1), 4: dt.datetime(2026, 1, 1)}
    for r in new:
        lo = {"Deposit": 50, "Withdraw": 25, "Bonus": 10}[r.type]
        hi = {"Deposit": 1000, "Withdraw": 800, "Bonus": 100}[r.type]
        assert lo <= r.amount <= hi
        c = created[r.player_id]
        if r.player_id == 3:  # created exactly at as_of: 1–60 minutes later
            assert dt.timedelta(minutes=1) <= r.timestamp - c <= dt.timedelta(minutes=60)
        elif r.player_id == 4:  # created after as_of: within 30 days
            assert c <= r.timestamp <= c + dt.timedelta(days=30)
        else:
            assert c <= r.timestamp <= dt.datetime(2025, 9, 1)


def test_code_width_grows_with_quantity(spark):
    base = affiliates(spark, [(1, "AAAAAA", None, None)])
    ps = players(spark, [(10, None, "DE", "TRUE", T0, T0)])
    out = increment.extend_affiliates(base, ps, 700, code_width=2)  # 699 new codes > 26^2
    codes = [r.code for r in out.collect() if r.id != 1]
    assert len(codes) == 699 and len(set(codes)) == 699 and {len(c) for c in codes} == {3}
