"""Key-wise cleaning operators: latest version, first claim, dangling links,
linked fill-in and the KYC/time gate.

Scale notes (one key may hold a third of all rows):

* "one row per key" is a partial + final aggregate, so a hot key is collapsed
  on the map side to one row per map partition before the shuffle. Its three
  forms (:func:`latest_by_key`) are measured in ``docs/latest.md``.
* Rows with a null link key can never match, so they bypass the join
  instead of all hashing to one shuffle partition.
* Where a null key must match (the null-safe KYC gate) and where a hot key
  would meet a large partition of the other side (a hot player in the gate),
  the key is salted (:func:`salted_join`); the hot keys come from a mergeable
  sketch that the same query gathers (:func:`hot_key_sketch`).
* Other joins are plain equi-joins: AQE turns them into broadcast joins when
  the measured build side is small and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.coerce import truth_text


def _asc_nulls_last_key(cols: Sequence[str]) -> list[Column]:
    """Struct fields so that ``min`` picks ascending order, nulls last."""
    fields: list[Column] = []
    for i, c in enumerate(cols):
        fields.append(F.col(c).isNull().alias(f"_n{i}"))
        fields.append(F.col(c).alias(f"_v{i}"))
    return fields


def default_salts(df: DataFrame) -> int:
    """Salts a hot (or null) join key is spread over: as many as the session
    has shuffle partitions, so that a key with a third of all rows still makes
    tasks of ordinary size."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def hot_key_sketch(df: DataFrame, key: str, share: float = 0.01, min_count: int = 10) -> Column:
    """Array of the non-null ``key`` values that hold at least ``share`` of the
    rows of ``df`` (and at least ``min_count`` of them): a scalar subquery, so
    nothing runs while a plan is built, and all uses see one value.

    The keys come from a frequent-items sketch (``approx_top_k``): each task
    keeps a bounded table of candidates, tables are merged, and no key above
    ``share`` is missed. The array has at most ``1/share`` keys, whatever the
    data size. Where ``df`` is a shuffled aggregate that the query needs
    anyway, the sketch reads that shuffle's output (a reused exchange): the
    input is scanned once."""
    most = max(1, round(1 / share))
    top = df.agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {min(1 << 20, 16 * most)})").alias("__top"),
        F.greatest(F.lit(min_count), F.ceil(F.count(key) * F.lit(share))).alias("__least"),
    )
    often = F.filter("__top", lambda x: x["item"].isNotNull() & (x["count"] >= F.col("__least")))
    return top.select(F.transform(often, lambda x: x["item"]).alias("__hot")).scalar()


def hot_keys(df: DataFrame, key: str, share: float = 0.01, **kwargs) -> list:
    """The keys of :func:`hot_key_sketch` (at most ``1/share``), collected."""
    return df.sparkSession.range(1).select(hot_key_sketch(df, key, share, **kwargs).alias("k")).first()["k"]


def _is_hot(key: str, hot) -> Column:
    """Whether the row's key is one of the ``hot`` values (a bounded list, or
    an array column)."""
    if isinstance(hot, Column):
        return F.array_contains(hot, F.col(key))
    return F.col(key).isin(list(hot)) if hot else F.lit(False)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    null_safe: bool = True,
    hot=(),
    salts: int | None = None,
) -> DataFrame:
    """Equi-join on ``left_key = right_key`` (``<=>`` when ``null_safe``) in
    which the null group and the ``hot`` keys are spread over ``salts`` shuffle
    partitions instead of one.

    ``hot`` is a list of key values or an array of them
    (:func:`hot_key_sketch`). Each left row of such a key takes one salt from
    a hash of the row; each right row of such a key is replicated once per
    salt, so every left row still meets every matching right row exactly
    once. Other keys use salt 0 and join as usual. Replication is ``salts`` ×
    (right rows of spread keys), so the right side should be the one with
    few rows per key (e.g. players, one per id after de-dup).
    """
    columns = left.columns
    salts = salts or default_salts(left)
    lk, rk = F.col(left_key), F.col(right_key)
    spread_l, spread_r = F.coalesce(_is_hot(left_key, hot), F.lit(False)), F.coalesce(_is_hot(right_key, hot), F.lit(False))
    if null_safe:
        spread_l, spread_r = spread_l | lk.isNull(), spread_r | rk.isNull()
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    l2 = left.withColumn("__ls", F.when(spread_l, F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    r2 = right.withColumn("__rs", F.when(spread_r, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    # outer: else a filter on the array's size goes below the right side's
    # shuffle, which then is no longer one that the query has already
    r2 = r2.withColumn("__rs", F.explode_outer("__rs"))
    keys = lk.eqNullSafe(rk) if null_safe else lk == rk
    joined = l2.join(r2, keys & (F.col("__ls") == F.col("__rs")), how)
    return joined.drop("__ls", "__rs")


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    salts: int | None = None,
    hot=(),
) -> DataFrame:
    """J1's join: a null key matches a null key (``<=>``), and the null group
    (plus any ``hot`` keys) is salted (:func:`salted_join`) so it never piles
    up in one shuffle partition."""
    return salted_join(left, right, left_key, right_key, how, True, hot, salts)


#: Types whose order fits a long without loss, and the long that keeps it.
_ORDER_CODES = {
    T.TimestampType: lambda c: F.unix_micros(c),
    T.DateType: lambda c: F.unix_date(c).cast("long"),
    T.LongType: lambda c: c,
    T.IntegerType: lambda c: c.cast("long"),
    T.ShortType: lambda c: c.cast("long"),
    T.ByteType: lambda c: c.cast("long"),
    T.BooleanType: lambda c: c.cast("long"),
}
FORMS = ("struct", "hash", "window")


def latest_by_key(
    df: DataFrame,
    key: str,
    sort_by: str,
    tie_break: Sequence[str] | None = None,
    form: str = "struct",
) -> DataFrame:
    """A10 — keep one row per ``key``: the one with the greatest ``sort_by``.

    A null ``sort_by`` counts as the greatest value (ledger L1) and null keys
    form one group (L4). Ties on ``sort_by`` are broken by ``tie_break``
    (default: the remaining columns in order), each compared descending with
    nulls last (L2), so the result is deterministic.

    All forms give the same rows (times and plans in ``docs/latest.md``):

    * ``struct``: a grouped ``max`` over a struct of the whole row. One
      shuffle; a hot key leaves each map task as one row; sorts on both sides
      of the shuffle, because a struct is no fixed-width buffer;
    * ``hash``: a hash aggregate finds each key's greatest ``sort_by``, coded
      as a long that keeps the order, and how many rows have it; the rows that
      match are fetched by a hash join. No sort, but for the keys that tie.
      The rows themselves are shuffled, so a hot key is AQE's to split;
    * ``window``: ``row_number = 1``, trimmed before the shuffle.
    """
    rest = [c for c in df.columns if c not in (key, sort_by)]
    order = list(tie_break) if tie_break is not None else rest
    if form == "hash":
        return _latest_by_code(df, key, sort_by, order)
    if form == "window":
        by = [F.col(sort_by).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in order]]
        ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*by)))
        return ranked.where("__rank = 1").select(*df.columns)
    if form != "struct":
        raise ValueError(f"form must be one of {FORMS}")
    payload = [c for c in rest if c not in order]
    best = F.max(
        F.struct(
            F.col(sort_by).isNull().alias("__sort_is_null"),
            F.col(sort_by),
            *[F.col(c) for c in order],
            *[F.col(c) for c in payload],
        )
    ).alias("__best")
    return (
        df.groupBy(key)
        .agg(best)
        .select(key, *[F.col(f"__best.{c}").alias(c) for c in df.columns if c != key])
        .select(*df.columns)
    )


def _latest_by_code(df: DataFrame, key: str, sort_by: str, order: Sequence[str]) -> DataFrame:
    """The ``hash`` form of :func:`latest_by_key`."""
    kind = type(df.schema[sort_by].dataType)
    if kind not in _ORDER_CODES:
        raise ValueError(f"the hash form needs a fixed-width sort column, {sort_by} is {kind.__name__}")
    # a null is above every value: it has a flag of its own in the buffers
    code, null = _ORDER_CODES[kind](F.col(sort_by)), F.col(sort_by).isNull()
    coded = df.withColumns({"__code": F.coalesce(code, F.lit(0).cast("long")), "__null": null.cast("int")})
    best = coded.groupBy(F.col(key).alias("__key")).agg(
        F.max("__null").alias("__top_null"), F.max(F.when(~null, F.col("__code"))).alias("__top"), F.count(F.lit(1)).alias("__rows")
    )
    best = best.select("__key", "__top_null", F.when(F.col("__top_null") == 0, F.col("__top")).otherwise(0).alias("__top_code"), "__rows")
    met = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__null") == F.col("__top_null")) & (F.col("__code") == F.col("__top_code"))
    won = coded.join(best.hint("shuffle_hash"), met, "inner")
    alone = won.where("__rows = 1").select(*df.columns)
    # keys of several rows may have several at the top: the rows that tie are
    # few, and go through the struct form
    tied = latest_by_key(won.where("__rows > 1").select(*df.columns), key, sort_by, order)
    return alone.unionByName(tied)


def valid_keys(df: DataFrame, key: str = "id", alias: str = "__key") -> DataFrame:
    """A9 — the distinct non-null values of ``key`` (a one-column frame)."""
    return df.select(F.col(key).alias(alias)).where(F.col(alias).isNotNull()).distinct()


def null_dangling(
    df: DataFrame,
    link: str,
    targets: DataFrame,
    target_key: str = "id",
    hot_key_share: float | None = None,
) -> DataFrame:
    """J6 + P7 — set ``link`` to null where no row of ``targets`` has that key.

    Rows are kept; only the column is nulled. Null links bypass the join;
    hot links are salted in it (target keys are distinct, so a salted key
    replicates one row).
    """
    keys = valid_keys(targets, target_key, "__key").withColumn("__hit", F.lit(True))
    hot = hot_key_sketch(df, link, hot_key_share) if hot_key_share else ()
    linked = df.where(F.col(link).isNotNull())
    unlinked = df.where(F.col(link).isNull())
    checked = (
        salted_join(linked, keys, link, "__key", "left", False, hot)
        .withColumn(link, F.when(F.col("__hit"), F.col(link)))
        .select(*df.columns)
    )
    return checked.unionByName(unlinked)


def dangling_links(df: DataFrame, link: str, targets: DataFrame, target_key: str = "id") -> DataFrame:
    """List form of J6: rows whose non-null ``link`` has no partner."""
    keys = valid_keys(targets, target_key, "__key")
    return df.where(F.col(link).isNotNull()).join(keys, F.col(link) == F.col("__key"), "left_anti")


def _claim_order(df: DataFrame, link: str, order_by: Sequence[str]) -> list[str]:
    """``order_by`` then the remaining columns as tie-breaks (all ascending,
    nulls last), so exactly one row wins unless two rows are identical."""
    return list(order_by) + [c for c in df.columns if c != link and c not in order_by]


def _claim_winners(claimed: DataFrame, link: str, order: Sequence[str]) -> DataFrame:
    return claimed.groupBy(F.col(link).alias("__wkey")).agg(
        F.min(F.struct(*_asc_nulls_last_key(order))).alias("__winner")
    )


def _keep_winner(df: DataFrame, link: str, winners: DataFrame, order: Sequence[str], hot=()) -> DataFrame:
    mine = F.struct(*_asc_nulls_last_key(order))
    linked = df.where(F.col(link).isNotNull())
    unlinked = df.where(F.col(link).isNull())
    # Winners hold one row per link, so salting a hot link replicates one row.
    kept = (
        salted_join(linked, winners, link, "__wkey", "left", null_safe=False, hot=hot)
        .withColumn(link, F.when(mine.eqNullSafe(F.col("__winner")), F.col(link)))
        .select(*df.columns)
    )
    return kept.unionByName(unlinked)


def first_claim(
    df: DataFrame,
    link: str = "affiliate_id",
    order_by: Sequence[str] = ("created_at", "id"),
    hot_key_share: float | None = None,
) -> DataFrame:
    """A11 + P7 — when several rows carry the same non-null ``link``, only the
    first in ``order_by`` order (ascending, nulls last; ledger L5) keeps it;
    the others get null. Rows are never dropped.

    The winner per link is a grouped ``min`` (partial aggregation, skew-safe),
    joined back on the link. The other side of that join holds one row per
    link, so AQE's skew split of a hot link re-reads little; with
    ``hot_key_share`` the hot links are salted instead (:func:`hot_key_sketch`).
    """
    order = _claim_order(df, link, order_by)
    hot = hot_key_sketch(df, link, hot_key_share) if hot_key_share else ()
    winners = _claim_winners(df.where(F.col(link).isNotNull()), link, order)
    return _keep_winner(df, link, winners, order, hot)


def link_claims(
    df: DataFrame,
    link: str,
    targets: DataFrame,
    target_key: str = "id",
    order_by: Sequence[str] = ("created_at", "id"),
    row_key: str = "id",
) -> DataFrame:
    """J6 then A11 in one pass, for rows unique in ``row_key`` (as after
    de-dup; at most one has a null there): a link survives only if its target
    exists and this row is its first claimant.

    Same result as ``first_claim(null_dangling(df))``. One grouping by link
    finds the winner's ``row_key``, so a hot link leaves each map task as one
    row; a semi-join of winners (one per link) with the target keys takes the
    dangling links out; and the winners go back to the rows by ``row_key``,
    by which ``df`` is partitioned and sorted already: that join has no hot
    key, and the rows are not shuffled again."""
    keys = valid_keys(targets, target_key, "__key")
    order = list(order_by) + ([] if row_key in order_by else [row_key])
    winners = (
        _claim_winners(df.where(F.col(link).isNotNull()), link, order)
        .join(keys, F.col("__wkey") == F.col("__key"), "left_semi")
        .select(F.col("__wkey"), F.col(f"__winner._v{order.index(row_key)}").alias("__row"))
    )
    met = F.col(row_key).eqNullSafe(F.col("__row"))
    return df.join(winners, met, "left").withColumn(link, F.col("__wkey")).select(*df.columns)


def fill_from_linked(
    df: DataFrame,
    linked: DataFrame,
    key: str = "id",
    link: str = "affiliate_id",
    value: str = "created_at",
    target: str = "redeemed_at",
) -> DataFrame:
    """P12 (J2 + P10) — replace ``target`` with the linked row's ``value``.

    ``linked`` rows with a null link or value are ignored; the linked value
    wins and the row's own ``target`` is only the fallback (ledger L24).
    Left join: every row of ``df`` is kept. In C2 both sides hold at most one
    row per key (affiliates after de-dup, players after first claim), so the
    join has no hot key; with many partners per key, AQE splits the skew.
    """
    partners = linked.select(F.col(link).alias("__link"), F.col(value).alias("__value")).dropna()
    return (
        df.join(partners, F.col(key) == F.col("__link"), "left")
        .withColumn(target, F.coalesce(F.col("__value"), F.col(target)))
        .select(*df.columns)
    )


def kyc_time_gate(
    transactions: DataFrame,
    players: DataFrame,
    player_key: str = "player_id",
    approved: str = "is_kyc_approved",
    created: str = "created_at",
    ts: str = "timestamp",
    hot=(),
) -> DataFrame:
    """J1 + F4 + F5 — transactions of approved players, not before the
    player's creation time.

    The join is null-safe (ledger L16: a null player id matches the null-id
    player, of which de-dup leaves at most one) and salts the null keys and
    the ``hot`` player ids (:func:`salted_join`; see :func:`hot_key_sketch`), so
    neither piles up in one partition. Without a hot list, a hot player is
    left to AQE's skew split or avoided by a broadcast of the players.
    The approval test is the text rule of L10 and is applied to the player
    side before the join, so the build side is as small as possible. Only
    ``created_at`` is compared (L19).
    """
    gate = players.where(truth_text(approved)).select(
        F.col("id").alias("__pid"), F.col(created).alias("__created")
    )
    return (
        null_safe_join(transactions, gate, player_key, "__pid", "inner", hot=hot)
        .where(F.col(ts) >= F.col("__created"))
        .select(*transactions.columns)
    )
