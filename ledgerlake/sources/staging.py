"""Staging views: the driver's star-schema tables mapped onto the three base
tables (players, affiliates, transactions).

The driver tables have unique keys and no nulls, so the mapping injects
duplicate versions, null sort values, dangling links, competing claims and
null amounts by arithmetic on the key. Every rule is a column expression
(plus one ``explode`` for the second version), so the staging scales with the
input and adds no shuffle. The same rules are written in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import AMOUNT


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(text: str):
    return F.lit(text).cast("timestamp")


def raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players from ``customer``: two versions when the key is a multiple of 5."""
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    c = F.col("c_custkey")
    # Size of the affiliate id space: supplier count × 6 div 5, so about a
    # sixth of the links dangle. A scalar subquery, evaluated once.
    id_space = F.floor(supplier.select(F.count(F.lit(1))).scalar() * 6 / 5).cast("long")
    versions = customer.select(
        "c_custkey",
        "c_nationkey",
        F.explode(F.when(c % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias(
            "ver"
        ),
    )
    ver = F.col("ver")
    return versions.select(
        c.alias("id"),
        F.when(c % 3 != 0, (c * 7) % id_space).alias("affiliate_id"),
        F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias(
            "country_code"
        ),
        ((c + ver) % 4 != 0).alias("is_kyc_approved"),
        F.when(c % 2 == 0, _ts("1995-01-01 00:00:00"))
        .otherwise(_ts("1998-01-01 00:00:00"))
        .alias("created_at"),
        F.when(ver == 1, _ts("2000-01-01 00:00:00"))
        .when(c % 10 != 0, _ts("1999-01-01 00:00:00"))
        .alias("updated_at"),
        ver.cast("int").alias("ver"),
    )


def raw_affiliates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affiliates from ``supplier``; origin cycles through the channels. Every
    tenth has a later second version, of another channel."""
    s = F.col("s_suppkey")
    later = F.col("ver") == 1
    versions = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.explode(F.when(s % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("ver")
    )
    return versions.select(
        s.alias("id"),
        F.col("s_name").alias("code"),
        F.when(later, "Discord")
        .when(s % 4 == 0, "YouTube")
        .when(s % 4 == 1, "Discord")
        .when(s % 4 == 2, "X")
        .alias("origin"),
        F.when(later, _ts("1997-01-01 00:00:00")).when(s % 5 != 0, _ts("1996-06-01 00:00:00")).alias("redeemed_at"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions from ``orders``: status F/O/P → Deposit/Withdraw/Bonus;
    every 97th amount is null, times lie inside the day, and every seventh has
    a second version a day later with another amount."""
    o = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    later = F.col("ver")
    versions = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.explode(F.when(o % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("ver"),
    )
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + (o * 7919) % 86400 + later * 86400
    return versions.select(
        o.alias("id"),
        F.timestamp_seconds(seconds).alias("timestamp"),
        F.col("o_custkey").alias("player_id"),
        F.when(status == "F", "Deposit")
        .when(status == "O", "Withdraw")
        .when(status == "P", "Bonus")
        .alias("type"),
        F.when(o % 97 != 0, (F.col("o_totalprice").cast(AMOUNT) + later).cast(AMOUNT)).alias("amount"),
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source with sub-day times: ``events`` as transactions.

    purchase → Deposit, click → Withdraw, signup → Bonus, all others → Other,
    a type that no mart counts.
    """
    et = F.col("event_type")
    return (
        read_table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("id"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.col("user_id").alias("player_id"),
            F.when(et == "purchase", "Deposit")
            .when(et == "click", "Withdraw")
            .when(et == "signup", "Bonus")
            .otherwise("Other")
            .alias("type"),
            F.col("value").cast(AMOUNT).alias("amount"),
        )
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "players": raw_players(spark, sf_dir),
        "affiliates": raw_affiliates(spark, sf_dir),
        "transactions": raw_transactions(spark, sf_dir),
    }
