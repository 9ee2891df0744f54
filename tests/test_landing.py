"""Landing tables are replaced, not appended; the declared
VARCHAR(4) rejects longer country codes (ledger L25)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import clean
from ledgerlake.sources import catalog, files


def players(spark, code="DE"):
    return spark.createDataFrame(
        [(1, None, code, "TRUE", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))],
        "id long, affiliate_id long, country_code string, is_kyc_approved string, created_at timestamp, updated_at timestamp",
    )


def test_landing_replaces(spark):
    name = catalog.land(clean.landing_players(players(spark)), spark, "landing_t", "players")
    catalog.land(clean.landing_players(players(spark)), spark, "landing_t", "players")
    got = catalog.source(spark, "landing_t", "raw_players")
    assert got.count() == 1
    assert dict(got.dtypes)["is_kyc_approved"] == "boolean"
    assert name == "landing_t.raw_players"


def test_landing_rejects_long_country_code(spark):
    with pytest.raises(Exception) as err:
        catalog.land(clean.landing_players(players(spark, "ABCDE")), spark, "landing_t", "players")
    assert "EXCEED_LIMIT_LENGTH" in str(err.value) or "length" in str(err.value).lower()


def test_materialize_and_files_round_trip(spark, tmp_dir):
    df = players(spark)
    full = catalog.materialize(df, "marts_t", "m")
    assert spark.table(full).count() == 1
    catalog.materialize(df, "marts_t", "m")
    assert spark.table(full).count() == 1
    p = files.write_parquet(df, f"{tmp_dir}/pq")
    assert files.read_parquet(spark, p).count() == 1
    c = files.write_csv(df, f"{tmp_dir}/csv")
    back = files.read_raw_table(spark, c, "players")
    row = back.first()
    assert row.created_at == dt.datetime(2024, 1, 1) and row.id == 1
    text = spark.read.text(c).collect()
    assert any("2024-01-01 00:00:00+00:00" in r.value for r in text)


def test_bucketed_landing_removes_mart_shuffles(spark):
    from ledgerlake.plans import marts

    t = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1 + i % 20), i % 7, ["Deposit", "Withdraw", "Bonus"][i % 3], None) for i in range(200)],
        "id long, timestamp timestamp, player_id long, type string, amount decimal(18,2)",
    ).withColumn("amount", (F.col("id") / 4).cast("decimal(18,2)"))
    plain = catalog.land(t, spark, "bucket_t", "transactions")
    ledger_plain = sorted(map(tuple, marts.daily_ledger(spark.table(plain), stamp=False).collect()))
    spark.sql("DROP TABLE IF EXISTS bucket_t.raw_transactions")
    name = catalog.land(t, spark, "bucket_t", "transactions", buckets=4)
    ledger = marts.daily_ledger(spark.table(name), stamp=False)
    assert sorted(map(tuple, ledger.collect())) == ledger_plain
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_csv_columns_matched_by_header_name(spark, tmp_dir):
    import os

    path = f"{tmp_dir}/tx"
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("amount,type,player_id,timestamp,id\n12.5,Deposit,3,2024-01-10 17:07:01+00:00,9.0\nNA,Bonus,,bad,x\n")
    rows = sorted(files.read_raw_table(spark, path, "transactions").collect(), key=lambda r: str(r.id))
    assert dict(files.read_raw_table(spark, path, "transactions").dtypes)["amount"] == "decimal(18,2)"
    assert rows[0].id == 9 and rows[0].player_id == 3 and str(rows[0].amount) == "12.50"
    assert rows[0].timestamp == dt.datetime(2024, 1, 10, 17, 7, 1)
    assert rows[1].id is None and rows[1].amount is None and rows[1].timestamp is None and rows[1].type == "Bonus"


def test_rejected_load_keeps_the_old_rows(spark):
    name = catalog.land(clean.landing_players(players(spark)), spark, "landing_k", "players")
    before = sorted(map(str, spark.table(name).collect()))
    for bad in (players(spark, "ABCDE"), players(spark).withColumn("is_kyc_approved", F.lit("maybe"))):
        with pytest.raises(Exception):
            catalog.land(clean.landing_players(bad), spark, "landing_k", "players")
        assert sorted(map(str, spark.table(name).collect())) == before
    assert [t.name for t in spark.catalog.listTables("landing_k")] == ["raw_players"]
    catalog.land(clean.landing_players(players(spark, "FR")), spark, "landing_k", "players")
    assert [r.country_code for r in spark.table(name).collect()] == ["FR"]


def test_failed_rebuild_keeps_the_old_mart(spark):
    full = catalog.materialize(spark.range(5), "marts_k", "m")
    with pytest.raises(Exception):
        catalog.materialize(spark.range(5).withColumn("id", F.raise_error(F.lit("stop")).cast("long")), "marts_k", "m")
    assert spark.table(full).count() == 5
    catalog.materialize(spark.range(3).select(F.col("id"), F.lit("x").alias("other")), "marts_k", "m")
    assert spark.table(full).columns == ["id", "other"] and spark.table(full).count() == 3


def _csv(folder, **texts):
    import os

    os.makedirs(folder)
    for name, text in texts.items():
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            f.write(text)
    return folder


def test_csv_quotes_and_line_breaks(spark, tmp_dir):
    path = _csv(f"{tmp_dir}/q", a='id,note,code\n1,"say ""hi"", ok",X\n2,"two\nlines",Y\n3, padded ,Z\n')
    rows = sorted(map(tuple, files.read_csv(spark, path, multi_line=True).collect()))
    assert rows == [("1", 'say "hi", ok', "X"), ("2", "two\nlines", "Y"), ("3", " padded ", "Z")]
    with pytest.raises(Exception):
        files.read_csv(spark, path).collect()  # the line break needs multi_line
    with pytest.raises(Exception):
        files.read_csv(spark, path).select("id").collect()
    out = files.write_csv(spark.createDataFrame(rows, "id string, note string, code string"), f"{tmp_dir}/q2")
    assert sorted(map(tuple, files.read_csv(spark, out, multi_line=True).collect())) == rows


def test_csv_files_of_other_columns_raise(spark, tmp_dir):
    path = _csv(f"{tmp_dir}/h", a="id,code\n1,X\n", b="code,id\nY,2\n")
    with pytest.raises(Exception):
        files.read_csv(spark, path).collect()


def _frames(spark, n):
    affiliates = spark.range(n).select("id", F.lit("C").alias("code"), F.lit("X").alias("origin"), F.lit(None).cast("timestamp").alias("redeemed_at"))
    txns = spark.range(n).select(
        "id", F.lit(dt.datetime(2024, 1, 1)).alias("timestamp"), F.lit(1).cast("long").alias("player_id"), F.lit("Deposit").alias("type"), F.lit(1).cast("decimal(18,2)").alias("amount")
    )
    return {"players": clean.landing_players(players(spark)), "affiliates": affiliates, "transactions": txns}


def test_three_tables_change_together_or_not_at_all(spark):
    names = catalog.land_all(_frames(spark, 3), spark, "land_m", None)
    assert catalog.manifest(spark, "land_m")["version"] == 1
    old = {t: spark.table(n) for t, n in names.items()}
    bad = _frames(spark, 5)
    bad["transactions"] = bad["transactions"].withColumn("id", F.raise_error(F.lit("third table fails")).cast("long"))
    with pytest.raises(Exception):
        catalog.land_all(bad, spark, "land_m", None)
    assert catalog.manifest(spark, "land_m")["version"] == 1
    assert [spark.table(n).count() for n in names.values()] == [1, 3, 3]
    catalog.land_all(_frames(spark, 5), spark, "land_m", None)
    assert [spark.table(n).count() for n in names.values()] == [1, 5, 5]
    # readers opened before the load finish, and a version can still be read whole
    assert old["affiliates"].count() == 3 and old["transactions"].count() == 3
    first, last = catalog.snapshot(spark, "land_m", 1), catalog.snapshot(spark, "land_m")
    assert {t: f.count() for t, f in first.items()} == {"raw_players": 1, "raw_affiliates": 3, "raw_transactions": 3}
    assert {t: f.count() for t, f in last.items()} == {"raw_players": 1, "raw_affiliates": 5, "raw_transactions": 5}


def test_a_load_cut_off_after_its_commit_is_finished_by_the_next(spark, monkeypatch):
    names = catalog.land_all(_frames(spark, 2), spark, "land_c", None)
    real, calls = catalog.sync, []

    def cut(*args):
        calls.append(args)
        if len(calls) == 2:  # the one after the commit
            raise RuntimeError("driver lost")
        return real(*args)

    monkeypatch.setattr(catalog, "sync", cut)
    with pytest.raises(RuntimeError):
        catalog.land_all(_frames(spark, 4), spark, "land_c", None)
    monkeypatch.undo()
    assert catalog.snapshot(spark, "land_c")["raw_affiliates"].count() == 4
    assert spark.table(names["affiliates"]).count() == 2  # the catalog is behind, for all three alike
    catalog.sync(spark, "land_c")
    assert [spark.table(n).count() for n in names.values()] == [1, 4, 4]


def test_commits_of_two_loads_both_count(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS land_r")
    first = catalog._commit(spark, "land_r", {"a": "file:/x/a"})
    real = catalog.manifest
    stale = iter([{"version": first["version"] - 1, "at": 0.0, "tables": {}}])
    catalog.manifest = lambda *a: next(stale, None) or real(*a)  # another load commits in between
    try:
        second = catalog._commit(spark, "land_r", {"b": "file:/x/b"})
    finally:
        catalog.manifest = real
    assert second["version"] == 2 and second["tables"] == {"a": "file:/x/a", "b": "file:/x/b"}


def test_replaced_folders_go_after_the_grace_period(spark):
    import os

    names = catalog.land_all(_frames(spark, 2), spark, "land_v", None)
    before = catalog.manifest(spark, "land_v")["tables"]
    catalog.land_all(_frames(spark, 3), spark, "land_v", None)
    folder = lambda p: p.removeprefix("file:")
    assert all(os.path.isdir(folder(p)) for p in before.values())
    assert catalog.vacuum(spark, "land_v") == []
    gone = catalog.vacuum(spark, "land_v", grace=0)
    assert {p.rsplit("/", 1)[1] for p in gone} == {p.rsplit("/", 1)[1] for p in before.values()}
    assert not any(os.path.isdir(folder(p)) for p in before.values())
    assert [spark.table(n).count() for n in names.values()] == [1, 3, 3]
    assert catalog._versions(spark, "land_v") == [2]
