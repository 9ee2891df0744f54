"""Declared schemas of the three base tables and the landing DDL."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 2)

PLAYERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("affiliate_id", T.LongType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("is_kyc_approved", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

AFFILIATES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("code", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("redeemed_at", T.TimestampType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("player_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", AMOUNT),
    ]
)

SCHEMAS = {"players": PLAYERS, "affiliates": AFFILIATES, "transactions": TRANSACTIONS}

# Landing table names (the marts read these) and column order of the load.
LANDING_NAMES = {
    "players": "raw_players",
    "affiliates": "raw_affiliates",
    "transactions": "raw_transactions",
}

# The landing tables' column lists. country_code is limited to four characters, which
# Spark enforces on table writes (ledger L25).
LANDING_COLUMNS = {
    "players": "id BIGINT, affiliate_id BIGINT, country_code VARCHAR(4), "
    "is_kyc_approved BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP",
    "affiliates": "id BIGINT, code STRING, origin STRING, redeemed_at TIMESTAMP",
    "transactions": "id BIGINT, timestamp TIMESTAMP, player_id BIGINT, type STRING, "
    "amount DECIMAL(18,2)",
}

# Bucketing column of each landing table: the marts read transactions per
# player and join players on their id, so both tables are stored hash-
# partitioned on that key and the marts need no shuffle of them.
LANDING_BUCKET_COLUMNS = {"players": "id", "transactions": "player_id"}

# Transaction types and affiliate channels (fixed domain values).
DEPOSIT = "Deposit"
WITHDRAW = "Withdraw"
BONUS = "Bonus"
TRANSACTION_TYPES = [DEPOSIT, WITHDRAW, BONUS]
