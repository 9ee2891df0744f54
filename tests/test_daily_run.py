"""R1 end to end on the golden sample: extend → clean → land → marts → tests."""

import os
import re

from ledgerlake.plans import daily_run
from ledgerlake.sources import catalog

from test_golden_sample import AFFILIATES_CSV, PLAYERS_CSV, TRANSACTIONS_CSV


def test_daily_run_end_to_end(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for name, text in (("players", PLAYERS_CSV), ("affiliates", AFFILIATES_CSV), ("transactions", TRANSACTIONS_CSV)):
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write(text)
    result = daily_run.daily_run(spark, raw, os.path.join(tmp_dir, "work"), database="r1", target=40)
    assert len(result.tests) == 20 and all(r[3] == 0 for r in result.tests)
    players = catalog.source(spark, "r1", "raw_players")
    assert players.count() == 40  # 10 distinct base players + 30 generated
    assert spark.table(result.marts["daily_ledger"]).count() > 0
    # Second run replaces, does not append.
    again = daily_run.daily_run(spark, raw, os.path.join(tmp_dir, "work2"), database="r1", target=40)
    assert catalog.source(spark, "r1", "raw_players").count() == 40
    assert again.marts == result.marts


def test_daily_run_without_extension_matches_golden(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for name, text in (("players", PLAYERS_CSV), ("affiliates", AFFILIATES_CSV), ("transactions", TRANSACTIONS_CSV)):
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write(text)
    result = daily_run.daily_run(spark, raw, os.path.join(tmp_dir, "work"), database="r1b", extend=False)
    ledger = spark.table(result.marts["daily_ledger"])
    assert sorted(r.player_id for r in ledger.collect()) == [3, 7, 8]
    assert spark.table(result.marts["segment_totals"]).count() == 0


def test_parquet_hand_off_gives_same_tables(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for name, text in (("players", PLAYERS_CSV), ("affiliates", AFFILIATES_CSV), ("transactions", TRANSACTIONS_CSV)):
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write(text)
    daily_run.daily_run(spark, raw, os.path.join(tmp_dir, "w1"), database="r1c", target=30, expanded_format="csv")
    a = {t: sorted(map(str, catalog.source(spark, "r1c", f"raw_{t}").collect())) for t in ("players", "affiliates", "transactions")}
    daily_run.daily_run(spark, raw, os.path.join(tmp_dir, "w2"), database="r1c", target=30, expanded_format="parquet")
    b = {t: sorted(map(str, catalog.source(spark, "r1c", f"raw_{t}").collect())) for t in ("players", "affiliates", "transactions")}
    assert a == b


def test_hand_off_does_not_depend_on_the_raw_pattern(spark, tmp_dir):
    """Raw files in another timestamp layout: both hand-offs land the same rows,
    and no transaction is lost."""
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for name, text in (("players", PLAYERS_CSV), ("affiliates", AFFILIATES_CSV), ("transactions", TRANSACTIONS_CSV)):
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write(re.sub(r"(\d{4}-\d\d-\d\d) (\d\d:\d\d:\d\d\+00:00)", r"\1T\2", text))
    landed = []
    for fmt in ("csv", "parquet"):
        daily_run.daily_run(
            spark, raw, os.path.join(tmp_dir, fmt), database=f"r1p_{fmt}", target=30, expanded_format=fmt, pattern="yyyy-MM-dd'T'HH:mm:ssXXX"
        )
        landed.append({t: sorted(map(str, catalog.source(spark, f"r1p_{fmt}", f"raw_{t}").collect())) for t in daily_run.TABLES})
    assert landed[0] == landed[1]
    assert landed[0]["transactions"] and not any("created_at=None" in r for r in landed[0]["players"])
