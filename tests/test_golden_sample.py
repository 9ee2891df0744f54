"""Golden result on the reference's 11/10/10-row sample (FIXTURES §2):
CSV → clean → marts, with the expected rows derived by hand."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from ledgerlake.plans import clean, marts
from ledgerlake.sources import files

# The sample input rows, as CSV text.
PLAYERS_CSV = """id,affiliate_id,country_code,is_kyc_approved,created_at,updated_at
1,1,DE,TRUE,2024-01-10 17:07:01+00:00,2024-02-08 09:05:26+00:00
2,,BR,TRUE,2024-02-09 19:19:27+00:00,2024-03-05 08:06:20+00:00
3,2,BR,TRUE,2024-02-13 05:40:50+00:00,2024-02-17 10:58:17+00:00
4,3,GB,TRUE,2024-02-24 04:35:15+00:00,2024-03-05 19:19:09+00:00
5,4,AU,FALSE,2024-03-27 16:28:29+00:00,2024-04-01 05:38:15+00:00
6,,FR,TRUE,2024-04-05 02:33:27+00:00,2024-04-06 13:16:25+00:00
7,5,CA,TRUE,2024-04-16 19:27:32+00:00,2024-04-18 08:29:18+00:00
8,6,BR,TRUE,2024-09-05 07:53:23+00:00,2024-10-01 19:17:16+00:00
9,7,AU,FALSE,2024-10-13 00:24:33+00:00,2024-10-24 07:28:43+00:00
10,8,CA,FALSE,2024-10-14 23:45:05+00:00,2024-11-04 11:19:33+00:00
10,8,CA,TRUE,2024-10-14 23:45:05+00:00,2024-11-06 12:31:09+00:00
"""

AFFILIATES_CSV = """id,code,origin,redeemed_at
1,DWEHSP,YouTube,2024-01-10 17:07:01+00:00
2,QGKTBC,Discord,2024-02-13 05:40:50+00:00
3,YRLUJA,X,2024-02-24 04:35:15+00:00
4,ZXCVBN,,2024-03-27 16:28:29+00:00
5,POIUYT,YouTube,2024-04-16 19:27:32+00:00
6,LKJHGF,Discord,2024-09-05 07:53:23+00:00
7,MNBVCX,,2024-10-13 00:24:33+00:00
8,ASDFGH,X,2024-10-14 23:45:05+00:00
9,HGFDSA,YouTube,
10,TREWQS,Discord,
"""

TRANSACTIONS_CSV = """id,timestamp,player_id,type,amount
1,2024-01-10 17:07:01+00:00,7,Withdraw,213.13
2,2024-02-09 19:19:27+00:00,4,Withdraw,182.64
3,2024-02-13 05:40:50+00:00,8,Withdraw,184.22
4,2024-02-24 04:35:15+00:00,5,Deposit,304.94
5,2024-03-27 16:28:29+00:00,7,Withdraw,525.23
6,2024-04-05 02:33:27+00:00,10,Deposit,432.51
7,2024-04-16 19:27:32+00:00,3,Withdraw,291.94
8,2024-09-05 07:53:23+00:00,7,Withdraw,612.24
9,2024-10-13 00:24:33+00:00,8,Withdraw,140.35
10,2024-10-14 23:45:05+00:00,5,Withdraw,292.85
"""


def write(dir_, name, text):
    path = os.path.join(dir_, name)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)
    return path


@pytest.fixture(scope="module")
def raw(spark):
    import tempfile

    d = tempfile.mkdtemp(prefix="ledgerlake-golden-", dir="/tmp")
    return {
        "players": files.read_raw_table(spark, write(d, "players", PLAYERS_CSV), "players"),
        "affiliates": files.read_raw_table(spark, write(d, "affiliates", AFFILIATES_CSV), "affiliates"),
        "transactions": files.read_raw_table(spark, write(d, "transactions", TRANSACTIONS_CSV), "transactions"),
    }


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean.clean_all(raw)


def utc(s):
    return dt.datetime.fromisoformat(s)


def test_raw_types(raw):
    p = raw["players"]
    assert dict(p.dtypes) == {
        "id": "bigint",
        "affiliate_id": "bigint",
        "country_code": "string",
        "is_kyc_approved": "string",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    }
    assert dict(raw["transactions"].dtypes)["amount"] == "decimal(18,2)"


def test_clean_players(cleaned):
    rows = {r.id: r for r in cleaned["players"].collect()}
    assert len(rows) == 10
    assert rows[10].updated_at == utc("2024-11-06 12:31:09")
    assert rows[10].is_kyc_approved == "TRUE"
    links = {i: r.affiliate_id for i, r in rows.items()}
    assert links == {1: 1, 2: None, 3: 2, 4: 3, 5: 4, 6: None, 7: 5, 8: 6, 9: 7, 10: 8}


def test_clean_affiliates(cleaned, raw):
    rows = {r.id: r for r in cleaned["affiliates"].collect()}
    raw_rows = {r.id: r for r in raw["affiliates"].collect()}
    assert len(rows) == 10
    for i in range(1, 9):
        assert rows[i].redeemed_at == raw_rows[i].redeemed_at
    assert rows[9].redeemed_at is None and rows[10].redeemed_at is None


def test_clean_transactions(cleaned):
    rows = sorted(tuple(r) for r in cleaned["transactions"].collect())
    assert rows == [
        (7, utc("2024-04-16 19:27:32"), 3, "Withdraw", Decimal("291.94")),
        (8, utc("2024-09-05 07:53:23"), 7, "Withdraw", Decimal("612.24")),
        (9, utc("2024-10-13 00:24:33"), 8, "Withdraw", Decimal("140.35")),
    ]


def test_marts(cleaned):
    ledger = marts.daily_ledger(cleaned["transactions"])
    got = sorted((r.player_id, r.transaction_date, r.deposits, r.withdrawals, r.summary) for r in ledger.collect())
    assert got == [
        (3, dt.date(2024, 4, 16), Decimal("0.00"), Decimal("-291.94"), Decimal("-291.94")),
        (7, dt.date(2024, 9, 5), Decimal("0.00"), Decimal("-612.24"), Decimal("-612.24")),
        (8, dt.date(2024, 10, 13), Decimal("0.00"), Decimal("-140.35"), Decimal("-140.35")),
    ]
    assert all(r.updated_datetime is not None for r in ledger.collect())
    seg = marts.segment_totals(cleaned["players"], cleaned["affiliates"], cleaned["transactions"])
    assert seg.count() == 0
    assert marts.top_n_wide(cleaned["transactions"]).count() == 0
