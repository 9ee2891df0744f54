"""The arrival trigger runs once per batch of new raw files, never for old ones."""

import os

from ledgerlake.streaming.arrivals import on_new_files, refresh_on_arrival
from ledgerlake.sources import catalog

from test_golden_sample import AFFILIATES_CSV, PLAYERS_CSV, TRANSACTIONS_CSV


def test_runs_only_for_new_files(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    ckpt = os.path.join(tmp_dir, "ckpt")
    calls = []
    with open(os.path.join(raw, "a.csv"), "w") as f:
        f.write("x\n1\n")
    on_new_files(spark, raw, ckpt, calls.append).awaitTermination(120)
    assert len(calls) == 1
    on_new_files(spark, raw, ckpt, calls.append).awaitTermination(120)
    assert len(calls) == 1  # nothing new
    with open(os.path.join(raw, "b.csv"), "w") as f:
        f.write("x\n2\n")
    on_new_files(spark, raw, ckpt, calls.append).awaitTermination(120)
    assert len(calls) == 2


def test_refresh_on_arrival_runs_daily_batch(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for name, text in (("players", PLAYERS_CSV), ("affiliates", AFFILIATES_CSV), ("transactions", TRANSACTIONS_CSV)):
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write(text)
    q = refresh_on_arrival(spark, raw, os.path.join(tmp_dir, "work"), os.path.join(tmp_dir, "ckpt"),
                           database="stream_db", extend=False)
    q.awaitTermination(300)
    assert catalog.source(spark, "stream_db", "raw_transactions").count() == 3
