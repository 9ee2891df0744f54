"""Clean the three base tables.

Inputs are raw frames with at least the declared columns. Ids, timestamps and
amounts may be text or typed (they are coerced, ledger L6–L9, L12); the
approval flag is kept as it came in, because the KYC gate applies the text
rule of L10 to it and only the landing table turns it into a BOOLEAN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.coerce import TIMESTAMP_PATTERN, coerce_frame
from ledgerlake.operators.keyed import (
    fill_from_linked,
    hot_key_sketch,
    kyc_time_gate,
    latest_by_key,
    link_claims,
)
from ledgerlake.schemas import AFFILIATES, PLAYERS, TRANSACTIONS

PLAYER_COLUMNS = [f.name for f in PLAYERS.fields]
AFFILIATE_COLUMNS = [f.name for f in AFFILIATES.fields]
TRANSACTION_COLUMNS = [f.name for f in TRANSACTIONS.fields]


def _typed(df: DataFrame, schema: T.StructType, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Coerce declared columns except those in ``keep`` (left as they are)."""
    target = T.StructType([f for f in schema.fields if f.name not in keep])
    return coerce_frame(df, target, pattern)


def clean_players(
    players: DataFrame,
    affiliates: DataFrame,
    pattern: str = TIMESTAMP_PATTERN,
) -> DataFrame:
    """C1 — latest version per player, dangling affiliate links nulled, only
    the first claimant (by creation time, then id) keeps a shared link.

    The order matters and is kept: de-dup → dangling check → first claim.
    Only the set of affiliate ids is needed from ``affiliates``, and that set
    does not depend on which affiliate version is latest, so affiliates are
    not de-duplicated here.
    """
    p = _typed(players, PLAYERS, pattern, keep=("is_kyc_approved",))
    a = _typed(affiliates.select("id"), T.StructType([AFFILIATES["id"]]), pattern)
    latest = latest_by_key(p, "id", "updated_at")
    linked = link_claims(latest, "affiliate_id", a, "id", ("created_at", "id"))
    return linked.select(*PLAYER_COLUMNS)


def clean_affiliates(
    affiliates: DataFrame,
    cleaned_players: DataFrame,
    pattern: str = TIMESTAMP_PATTERN,
) -> DataFrame:
    """C2 — latest version per affiliate; the redemption time is the linked
    player's creation time, the raw value only a fallback (ledger L24)."""
    a = _typed(affiliates, AFFILIATES, pattern)
    latest = latest_by_key(a, "id", "redeemed_at")
    filled = fill_from_linked(latest, cleaned_players, "id", "affiliate_id", "created_at", "redeemed_at")
    return filled.select(*AFFILIATE_COLUMNS)


def clean_transactions(
    transactions: DataFrame,
    cleaned_players: DataFrame,
    pattern: str = TIMESTAMP_PATTERN,
    hot_key_share: float | None = 0.01,
) -> DataFrame:
    """C3 — latest version per transaction, only approved players, none
    before the player's creation time.

    Player ids holding at least ``hot_key_share`` of the transactions are
    salted in the gate join. They are found by a sketch over the de-duplicated
    rows (:func:`ledgerlake.operators.keyed.hot_key_sketch`), which reads the
    shuffle that the de-dup makes anyway: no driver-side action while the plan
    is built, and one scan of the transactions. ``None`` leaves hot players to
    AQE's skew split."""
    t = _typed(transactions, TRANSACTIONS, pattern)
    latest = latest_by_key(t, "id", "timestamp")
    hot = hot_key_sketch(latest, "player_id", hot_key_share) if hot_key_share else ()
    return kyc_time_gate(latest, cleaned_players, hot=hot).select(*TRANSACTION_COLUMNS)


def clean_all(
    raw: dict[str, DataFrame],
    pattern: str = TIMESTAMP_PATTERN,
    hot_player_share: float | None = 0.01,
) -> dict[str, DataFrame]:
    """C1–C3 on a dict of raw frames ``players``/``affiliates``/``transactions``.

    Cleaned players feed both other tables; the caller decides whether to
    persist or write them once (see :mod:`ledgerlake.plans.daily_run`).
    ``hot_player_share`` switches hot-key salting of the KYC gate (None: AQE's
    skew split).
    """
    players = clean_players(raw["players"], raw["affiliates"], pattern)
    return {
        "players": players,
        "affiliates": clean_affiliates(raw["affiliates"], players, pattern),
        "transactions": clean_transactions(raw["transactions"], players, pattern, hot_player_share),
    }


def landing_players(cleaned: DataFrame) -> DataFrame:
    """Landing projection of players: the approval flag becomes a BOOLEAN. Text
    that is no boolean raises when the rows are read; null stays null."""
    return cleaned.withColumn("is_kyc_approved", F.col("is_kyc_approved").cast("boolean"))
