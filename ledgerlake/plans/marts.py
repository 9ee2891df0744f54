"""M1–M3: the marts built on the landing tables.

Each function returns a DataFrame plan. ``updated_datetime`` is the load
stamp (one value per query, ledger L23); pass ``stamp=False`` to leave it out,
as the oracle comparison does. Stored tables carry no order, so no function
sorts globally; :func:`display_order` gives the reference's reading order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.coerce import boolean
from ledgerlake.schemas import DEPOSIT, WITHDRAW

ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"]


def _stamp(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("updated_datetime", F.current_timestamp()) if stamp else df


def daily_ledger(
    transactions: DataFrame,
    credit: str = DEPOSIT,
    debit: str = WITHDRAW,
    stamp: bool = True,
) -> DataFrame:
    """M1 — signed daily totals per player.

    Only credit/debit rows enter (a day with only other types has no row,
    L21). Sums are over ``CASE … ELSE 0``: a day whose credit rows all have a
    null amount and no other rows gives a null total (L20), as in SQL. The day
    is taken in the session time zone, which the engine pins to UTC (L15).
    One partial + final hash aggregate: a hot player is combined map-side.
    """
    t = transactions.where(F.col("type").isin(credit, debit))
    amount = F.col("amount")
    daily = t.groupBy(
        F.col("player_id"), F.to_date(F.col("timestamp")).alias("transaction_date")
    ).agg(
        F.sum(F.when(F.col("type") == credit, amount).otherwise(F.lit(0))).alias("deposits"),
        F.sum(F.when(F.col("type") == debit, -amount).otherwise(F.lit(0))).alias("withdrawals"),
    )
    out = daily.withColumn("summary", F.col("deposits") + F.col("withdrawals"))
    return _stamp(out, stamp)


def selected_players(
    players: DataFrame,
    affiliates: DataFrame,
    channel: str = "Discord",
    by_player: bool = False,
) -> DataFrame:
    """A4 (J3 + F1 + F3) — distinct (player_id, country_code) of approved
    players whose affiliate came through ``channel``.

    Inner join on the affiliate id: Catalyst adds ``IS NOT NULL`` on both keys
    and pushes it, with ``origin = channel``, into the scans, so players
    without a link never reach the shuffle. Landed players carry each
    affiliate id at most once (first claim), so no link is hot.
    """
    p = players.where(boolean("is_kyc_approved")).select(
        F.col("id").alias("player_id"), "country_code", "affiliate_id"
    )
    a = affiliates.where(F.col("origin") == channel).select(F.col("id").alias("__aff"))
    pairs = p.join(a, F.col("affiliate_id") == F.col("__aff"), "inner").select("player_id", "country_code")
    if by_player:
        # Hash-partitioned by player first: that layout also satisfies the
        # distinct on (player_id, country_code) and any later per-player
        # window or join, so all of them share one exchange.
        pairs = pairs.repartition("player_id")
    return pairs.distinct()


def segment_totals(
    players: DataFrame,
    affiliates: DataFrame,
    transactions: DataFrame,
    channel: str = "Discord",
    txn_type: str = DEPOSIT,
    stamp: bool = True,
) -> DataFrame:
    """M2 — count and sum of ``txn_type`` amounts per country, over approved
    players who came through ``channel``; countries with no non-null amount
    are left out (HAVING count > 0).

    Plan: transactions are cut down to the selected players (a semi-join, which
    AQE broadcasts when their measured size allows), reduced to one row per
    player (partial aggregation, skew-safe), then joined once to the selected
    players (J4/J5 collapse, ledger L22). The SQL semantics for a player listed under
    m country codes — every amount counted m times per country — are kept
    by weighting with m, computed by a window over the selected players,
    which are already partitioned by player_id for the join.
    """
    kdp = selected_players(players, affiliates, channel, by_player=True)
    kdp = kdp.withColumn("__m", F.count(F.lit(1)).over(Window.partitionBy("player_id")))
    # only the selected players' amounts are summed and shuffled
    per_player = (
        transactions.where(F.col("type") == txn_type)
        .join(kdp.select(F.col("player_id")), "player_id", "left_semi")
        .groupBy(F.col("player_id").alias("__pid"))
        .agg(
            F.count("amount").alias("__n"),
            F.sum("amount").alias("__s"),
        )
    )
    joined = kdp.join(per_player, F.col("player_id") == F.col("__pid"), "inner")
    out = (
        joined.groupBy("country_code")
        .agg(
            F.sum(F.col("__m") * F.col("__n")).alias("deposit_count"),
            F.sum(F.col("__m") * F.col("__s")).alias("total_deposits"),
        )
        .where(F.col("deposit_count") > 0)
    )
    return _stamp(out, stamp)


def ranked_rows(
    transactions: DataFrame,
    n: int = 3,
    txn_type: str = DEPOSIT,
) -> DataFrame:
    """W1 + F9 — per player, the ``n`` largest ``txn_type`` rows by amount
    then time, both descending with nulls first (PostgreSQL DESC, L13).

    ``row_number ≤ n`` lets Spark plan a WindowGroupLimit, which keeps at
    most ``n`` rows per player in each map partition before the shuffle, so
    a hot player costs no more than any other.
    """
    w = Window.partitionBy("player_id").orderBy(
        F.col("amount").desc_nulls_first(), F.col("timestamp").desc_nulls_first()
    )
    return (
        transactions.where(F.col("type") == txn_type)
        .select("player_id", "amount", "timestamp")
        .withColumn("deposit_rank", F.row_number().over(w))
        .where(F.col("deposit_rank") <= n)
    )


def rank_columns(n: int) -> list[str]:
    names = []
    for k in range(1, n + 1):
        word = ORDINALS[k - 1] if k <= len(ORDINALS) else f"top{k}"
        names += [f"{word}_largest_deposit", f"{word}_largest_deposit_date"]
    return names


def top_n_wide(
    transactions: DataFrame,
    n: int = 3,
    txn_type: str = DEPOSIT,
    stamp: bool = True,
) -> DataFrame:
    """M3 — the ``n`` largest deposits per player, one row per player.

    A5: long → wide by a conditional MAX per rank. The aggregate groups by
    the window's partition key, so it needs no second shuffle.
    The ``_date`` columns hold the full timestamp, as in the reference.
    """
    ranked = ranked_rows(transactions, n, txn_type)
    r = F.col("deposit_rank")
    names = rank_columns(n)
    aggs = []
    for k in range(1, n + 1):
        aggs.append(F.max(F.when(r == k, F.col("amount"))).alias(names[2 * (k - 1)]))
        aggs.append(F.max(F.when(r == k, F.col("timestamp"))).alias(names[2 * (k - 1) + 1]))
    out = ranked.groupBy("player_id").agg(*aggs)
    return _stamp(out, stamp)


#: O3 — the reference's reading order of each mart (PostgreSQL null order). The
#: last column of the totals only settles ties, which the reference leaves open.
READING_ORDER = {
    "daily_ledger": (("player_id", "asc_nulls_last"), ("transaction_date", "asc_nulls_last")),
    "segment_totals": (("total_deposits", "desc_nulls_first"), ("country_code", "asc_nulls_last")),
    "top_n_wide": (("player_id", "asc_nulls_last"),),
}


def reading_order(name: str) -> list[Column]:
    return [getattr(F.col(c), how)() for c, how in READING_ORDER.get(name, ())]


def display_order(name: str, df: DataFrame) -> DataFrame:
    """O3 — a mart in the reference's reading order (other names: as it is).
    A mart stored with ``materialize(..., order=reading_order(name))`` is in
    that order already, file by file (:func:`ledgerlake.sources.catalog.places`)."""
    order = reading_order(name)
    return df.orderBy(*order) if order else df
