"""Extend the raw tables to a target number of distinct ids.

The reference grows its sample with unseeded random rows made in a Python
loop. Here the same rules run as a seeded, distributed job: new rows come from
``spark.range``, every random value is an md5 draw of (seed, table, column,
key) (:mod:`ledgerlake.functions.draws`), and the only driver-side values are
the scalars that size the range (max id, distinct count, a few counts).

Rules kept from the reference:

* shortfall = target − distinct ids (a null id counts as a value); if it is
  not positive the base table is returned unchanged;
* new ids are contiguous from max id + 1;
* players: country from five codes, KYC true/false evenly, created_at =
  updated_at within the 365 days before ``as_of``, affiliate id null or
  "running max + 1" evenly, the running max starting at the base's highest
  affiliate id (0 if there is none);
* affiliates: ids are the players' affiliate ids ≥ start, in player order,
  then last id + 1, …; redeemed_at is that player's created_at (null for
  padding rows); origin one of three channels or null, evenly; a fresh code of
  six capital letters (a seventh once 26^6 codes are not enough), unique
  against the base codes;
* transactions: only KYC-approved players (none → base unchanged); type
  evenly from three; amount uniform per type, 2 places; time uniform between
  the player's creation and ``as_of`` (30 days after creation if that is
  later; 1–60 minutes after creation if the two are equal).

``as_of`` is an explicit UTC timestamp (ledger L27); transactions use the
latest version of each player unless ``versions="all"`` (ledger L28).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.coerce import truth_text
from ledgerlake.functions.draws import DRAW_DIGITS, between, choice, draw, letters
from ledgerlake.operators.aggregates import distinct_with_null_expr, next_identifier_expr
from ledgerlake.operators.keyed import latest_by_key
from ledgerlake.operators.sequence import indexed_rows, running_allocation
from ledgerlake.schemas import AMOUNT
from ledgerlake.session import ensure_checkpoint_dir, parallelism

# Generator domains and ranges.
COUNTRIES = ["DE", "BR", "GB", "US", "CA"]
ORIGINS = ["YouTube", "Discord", "X", None]
TRANSACTION_TYPES = ["Deposit", "Withdraw", "Bonus"]
AMOUNT_RANGES = {"Deposit": (50.00, 1000.00), "Withdraw": (25.00, 800.00), "Bonus": (10.00, 100.00)}
LOOKBACK_DAYS = 365
FUTURE_WINDOW_DAYS = 30
ZERO_GAP_MINUTES = (1, 60)
CODE_WIDTH = 6

# Affine permutation of code numbers: the multiplier is coprime to 26, so
# (MULT × position + offset) mod 26^width never repeats for distinct positions.
CODE_MULTIPLIER = 7919
DAY = 86400
DEFAULT_AS_OF = "2025-09-01 00:00:00"
ROWS_PER_PARTITION = 1_000_000


def _stats(df: DataFrame, key: str = "id", *extra: Column) -> tuple:
    """The scalars that size an increment (one small aggregate action)."""
    return tuple(df.agg(next_identifier_expr(key), distinct_with_null_expr(key), *extra).first())


MIN_ROWS_PER_PARTITION = 10_000


def _range(spark: SparkSession, start: int, qty: int) -> DataFrame:
    """Generated ids in ordered slices: at least one slice per core of the
    cluster (so the draws run in parallel), at most a million rows each."""
    by_size = math.ceil(qty / ROWS_PER_PARTITION)
    by_cores = min(parallelism(spark), math.ceil(qty / MIN_ROWS_PER_PARTITION))
    return spark.range(start, start + qty, 1, max(1, by_size, by_cores))


Target = int | Callable[[int], int]


def _target(target: Target, n_ids: int) -> int:
    """A fixed target, or one derived from the current distinct id count."""
    return int(target(n_ids)) if callable(target) else int(target)


def _as_of_seconds(as_of: str) -> Column:
    return F.unix_seconds(F.date_trunc("second", F.lit(as_of).cast("timestamp")))


def _conform(new: DataFrame, base: DataFrame) -> DataFrame:
    """Cast new rows to the base's column types and append them."""
    types = {f.name: f.dataType for f in base.schema.fields}
    cols = [F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in new.columns]
    return base.unionByName(new.select(*cols), allowMissingColumns=True)


def code_offset(seed: int, width: int = CODE_WIDTH) -> int:
    """Seed-dependent offset of the code permutation (same md5 rule as draws)."""
    return int(hashlib.md5(f"{seed}|affiliates|code|offset".encode()).hexdigest()[:DRAW_DIGITS], 16) % 26**width


def extend_players(base: DataFrame, target: Target, seed: int = 42, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """G1 — append generated players until ``target`` distinct ids exist."""
    spark = base.sparkSession
    start, n_ids, max_aff = _stats(base, "id", F.max("affiliate_id"))
    qty = _target(target, n_ids) - n_ids
    if qty <= 0:
        return base
    key = F.col("id")
    d = lambda column: draw(seed, "players", column, key)
    rows = _range(spark, start, qty).select(
        key,
        (d("affiliate_id") % 2 == 0).alias("__linked"),
        choice(COUNTRIES, d("country_code")).alias("country_code"),
        (d("is_kyc_approved") % 2 == 0).alias("is_kyc_approved"),
        F.timestamp_seconds(
            _as_of_seconds(as_of) - d("created_at") % (LOOKBACK_DAYS * DAY + 1)
        ).alias("created_at"),
    )
    rows = running_allocation(
        rows, ["id"], F.col("__linked"), int(max_aff or 0), "affiliate_id", presorted=True, checkpoint=False
    )
    new = rows.select(
        "id", "affiliate_id", "country_code", "is_kyc_approved", "created_at", F.col("created_at").alias("updated_at")
    )
    return _conform(new, base)


def _spell_codes(rows: DataFrame, seed: int, width: int) -> DataFrame:
    number = (F.col("__pos") * CODE_MULTIPLIER + code_offset(seed, width)) % (26**width)
    return rows.withColumn("code", letters(number, width))


def _resolve_clashes(rows: DataFrame, base: DataFrame, seed: int) -> DataFrame:
    """Append one drawn letter to every new code that equals a base code,
    until none does. New codes are distinct among themselves by
    construction, so only the base can clash; rounds are rare and each is a
    join plus an emptiness check."""
    taken = base.select(F.col("code").alias("__taken")).where(F.col("__taken").isNotNull()).distinct()
    taken = taken.withColumn("__clash", F.lit(True))
    round_no = 0
    while not rows.join(taken, F.col("code") == F.col("__taken"), "left_semi").isEmpty():
        extra = letters(draw(seed, "affiliates", f"code_extra{round_no}", F.col("__pos")) % 26, 1)
        ensure_checkpoint_dir(rows.sparkSession)
        rows = (
            rows.join(taken, F.col("code") == F.col("__taken"), "left")
            .withColumn("code", F.when(F.col("__clash"), F.concat(F.col("code"), extra)).otherwise(F.col("code")))
            .drop("__taken", "__clash")
            .checkpoint(eager=True)
        )
        round_no += 1
    return rows


def extend_affiliates(
    base: DataFrame,
    players: DataFrame,
    target: Target,
    seed: int = 42,
    code_width: int = CODE_WIDTH,
) -> DataFrame:
    """G2 — append affiliates for the players' new affiliate ids, then padding
    ids, until ``target`` distinct ids exist."""
    spark = base.sparkSession
    start, n_ids = _stats(base, "id")
    qty = _target(target, n_ids) - n_ids
    if qty <= 0:
        return base
    # Codes stay ``code_width`` letters while the permutation has room for
    # every new row; beyond 26^width rows a letter is added (exact below 26^11).
    while 26**code_width < qty:
        code_width += 1
    linked = (
        players.where(F.col("affiliate_id").isNotNull())
        .select(
            F.col("affiliate_id").alias("id"),
            F.col("created_at").alias("redeemed_at"),
            F.col("id").alias("__player"),
        )
        .where(F.col("id") >= start)
    )
    order = [F.col("__player").asc_nulls_last(), F.col("id").asc(), F.col("redeemed_at").asc_nulls_last()]
    ranked, n_linked = indexed_rows(linked, order, "__pos")
    taken = ranked.where(F.col("__pos") < qty).drop("__player")  # O5: the first qty linked rows
    n_taken = min(n_linked, qty)
    rows = taken
    if n_taken < qty:
        if n_taken:
            last_id = taken.where(F.col("__pos") == n_taken - 1).select("id").first()[0]
        else:
            last_id = start
        pad = _range(spark, n_taken, qty - n_taken).select(
            (F.lit(last_id) + F.col("id") - n_taken + 1).alias("id"),
            F.lit(None).cast("timestamp").alias("redeemed_at"),
            F.col("id").alias("__pos"),
        )
        rows = taken.unionByName(pad)
    rows = _spell_codes(rows, seed, code_width)
    rows = _resolve_clashes(rows, base, seed)
    new = rows.select(
        "id",
        "code",
        choice(ORIGINS, draw(seed, "affiliates", "origin", F.col("__pos"))).alias("origin"),
        "redeemed_at",
    )
    return _conform(new, base)


def _cents(txn_type: Column, h: Column) -> Column:
    out = None
    for name, (lo, hi) in AMOUNT_RANGES.items():
        value = between(round(lo * 100), round(hi * 100), h)
        out = F.when(txn_type == name, value) if out is None else out.when(txn_type == name, value)
    return out


def extend_transactions(
    base: DataFrame,
    players: DataFrame,
    target: Target,
    seed: int = 42,
    as_of: str = DEFAULT_AS_OF,
    versions: str = "latest",
) -> DataFrame:
    """G3 — append transactions of KYC-approved players until ``target``
    distinct ids exist.

    Each new transaction draws a player index; approved players are numbered
    0..P−1 by a two-phase row index, so the pick is an equi-join on that
    index (evenly spread keys, no skew) instead of a lookup on the driver.
    """
    spark = base.sparkSession
    start, n_ids = _stats(base, "id")
    qty = _target(target, n_ids) - n_ids
    if qty <= 0:
        return base
    if versions == "latest":
        players = latest_by_key(players, "id", "updated_at")
    elif versions != "all":
        raise ValueError("versions must be 'latest' or 'all'")
    approved = players.where(truth_text("is_kyc_approved")).select(
        F.col("id").alias("__player"), F.col("created_at").alias("__created")
    )
    indexed, n_players = indexed_rows(
        approved, [F.col("__player").asc_nulls_last(), F.col("__created").asc_nulls_last()], "__pidx"
    )
    if n_players == 0:
        return base
    key = F.col("id")
    d = lambda column: draw(seed, "transactions", column, key)
    picks = _range(spark, start, qty).select(key, (d("player_id") % n_players).alias("__pidx"))
    rows = picks.join(indexed, "__pidx")
    txn_type = choice(TRANSACTION_TYPES, d("type"))
    created = F.unix_seconds(F.col("__created"))
    as_of_s = _as_of_seconds(as_of)
    end = F.when(created > as_of_s, created + FUTURE_WINDOW_DAYS * DAY).otherwise(as_of_s)
    gap = end - created
    lo_min, hi_min = ZERO_GAP_MINUTES
    offset = F.when(gap <= 0, between(lo_min, hi_min, d("timestamp_minutes")) * 60).otherwise(
        d("timestamp") % (gap + 1)
    )
    new = rows.select(
        key,
        F.timestamp_seconds(created + offset).alias("timestamp"),
        F.col("__player").alias("player_id"),
        txn_type.alias("type"),
        (_cents(txn_type, d("amount")).cast(T.DecimalType(18, 0)) / 100).cast(AMOUNT).alias("amount"),
    )
    return _conform(new, base)
