"""Registered queries: one per operator or job, each ``(spark, sf_dir) → DataFrame``.

Every query reads the driver tables through the staging mapping
(:mod:`ledgerlake.sources.staging`), over the whole tables. Results are made
comparable with the SQL oracle by :func:`comparable`: exact decimals become
DOUBLE (the value is computed exactly first, then cast once on both sides,
ledger L12) and timestamps become UTC wall-clock ``timestamp_ntz``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import coerce
from ledgerlake.operators import aggregates, keyed, sequence
from ledgerlake.plans import clean, daily_run, increment, marts, quality
from ledgerlake.schemas import SCHEMAS
from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.sources import catalog, files, staging

Query = Callable[[SparkSession, str], DataFrame]


# Integer columns that hold nulls in a registered query's output. Client
# libraries disagree on how to hand such a column to pandas (float64 with NaN
# from Spark, a nullable Int64 from DuckDB), so both sides compare their text,
# which keeps every digit.
NULLABLE_INTEGERS = {
    "latest_by_key": ("affiliate_id",),
    "null_dangling": ("affiliate_id",),
    "first_claim": ("affiliate_id",),
    "clean_players": ("affiliate_id",),
    "null_safe_join": ("player_id", "matched_player"),
    "coerce_ids": ("id_value",),
    "running_allocation": ("affiliate_id", "allocated"),
    "extend_players": ("affiliate_id", "ver"),
    "land_players": ("affiliate_id",),
}


def comparable(df: DataFrame, as_text: tuple[str, ...] = ()) -> DataFrame:
    """Result in the representation the oracle uses: decimals (computed
    exactly) as DOUBLE, the listed nullable integer columns as text,
    timestamps as UTC wall-clock ``timestamp_ntz``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in as_text:
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class _Cleaned:
    """Cleaned tables of one staging input, built on first use only."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            s, d = self.spark, self.sf_dir
            if name == "players":
                df = clean.clean_players(staging.raw_players(s, d), staging.raw_affiliates(s, d))
            elif name == "affiliates":
                df = clean.clean_affiliates(staging.raw_affiliates(s, d), self["players"])
            else:
                df = clean.clean_transactions(staging.raw_transactions(s, d), self["players"])
            self._built[name] = df
        return self._built[name]


def _cleaned(spark: SparkSession, sf_dir: str) -> _Cleaned:
    return _Cleaned(spark, sf_dir)


def _latest_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.latest_by_key(staging.raw_players(spark, sf_dir), "id", "updated_at")


# --- cleaning operators -------------------------------------------------------


def q_latest_by_key(spark, sf_dir):
    return _latest_players(spark, sf_dir)


def q_null_dangling(spark, sf_dir):
    return keyed.null_dangling(
        staging.raw_players(spark, sf_dir), "affiliate_id", staging.raw_affiliates(spark, sf_dir)
    )


def q_first_claim(spark, sf_dir):
    return keyed.first_claim(_latest_players(spark, sf_dir), "affiliate_id", ("created_at", "id"))


def q_fill_from_linked(spark, sf_dir):
    return keyed.fill_from_linked(staging.raw_affiliates(spark, sf_dir), _latest_players(spark, sf_dir))


def q_kyc_time_gate(spark, sf_dir):
    return keyed.kyc_time_gate(staging.raw_transactions(spark, sf_dir), _latest_players(spark, sf_dir))


def q_null_safe_join(spark, sf_dir):
    """J1 with null keys on both sides: every 101st order has no player, and
    every 500th customer (offset 7) has a null id; null matches null. The
    players are reduced to their latest versions first, so at most one has a
    null id, however many null ids the transactions hold."""
    t = staging.raw_transactions(spark, sf_dir)
    t = t.withColumn("player_id", F.when(F.col("id") % 101 != 0, F.col("player_id")))
    p = staging.raw_players(spark, sf_dir)
    p = p.withColumn("id", F.when(F.col("id") % 500 != 7, F.col("id")))
    gate = keyed.latest_by_key(p, "id", "updated_at").select(F.col("id").alias("matched_player"), F.col("country_code"), F.col("ver"))
    return keyed.null_safe_join(t, gate, "player_id", "matched_player", "inner")


def q_clean_players(spark, sf_dir):
    return _cleaned(spark, sf_dir)["players"]


def q_clean_affiliates(spark, sf_dir):
    return _cleaned(spark, sf_dir)["affiliates"]


def q_clean_transactions(spark, sf_dir):
    return _cleaned(spark, sf_dir)["transactions"]


# --- coercion of text columns ------------------------------------------------
# Text variants are made from the driver keys by arithmetic (every row is
# kept; the key picks which spelling a row gets).


def _cents_text(cents, sign=""):
    whole = F.floor(F.abs(cents) / 100).cast("long").cast("string")
    frac = F.lpad((F.abs(cents) % 100).cast("string"), 2, "0")
    return F.concat(F.lit(sign), whole, F.lit("."), frac)


def q_coerce_ids(spark, sf_dir):
    k = F.col("o_orderkey")
    text = (
        F.when(k % 6 == 0, k.cast("string"))
        .when(k % 6 == 1, F.concat(k.cast("string"), F.lit(".0")))
        .when(k % 6 == 2, F.concat(k.cast("string"), F.lit(".5")))
        .when(k % 6 == 3, F.concat(F.lit("x"), k.cast("string")))
        .when(k % 6 == 4, F.lit(""))
        .otherwise((k + F.lit(9007199254740993)).cast("string"))
    )
    rows = staging.read_table(spark, sf_dir, "orders").select(k.alias("key"), text.alias("text"))
    return rows.select("key", "text", coerce.whole_number("text").alias("id_value"))


def q_coerce_amounts(spark, sf_dir):
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    text = (
        F.when(k % 5 == 0, _cents_text(cents))
        .when(k % 5 == 1, F.floor(cents / 100).cast("long").cast("string"))
        .when(k % 5 == 2, F.lit("abc"))
        .when(k % 5 == 3, F.concat(_cents_text(cents), F.lit("5")))
        .otherwise(_cents_text(cents, "-"))
    )
    rows = staging.read_table(spark, sf_dir, "orders").select(k.alias("key"), text.alias("text"))
    return rows.select("key", "text", coerce.amount("text").alias("amount"))


def q_coerce_timestamps(spark, sf_dir):
    k = F.col("o_orderkey")
    ts = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + k % 86400)
    base = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(k % 6 == 0, F.concat(base, F.lit("+00:00")))
        .when(k % 6 == 1, F.concat(base, F.lit("+02:00")))
        .when(k % 6 == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(k % 6 == 3, F.concat(F.date_format(ts, "yyyy/MM/dd HH:mm:ss"), F.lit("+00:00")))
        .when(k % 6 == 4, base)
        .otherwise(F.lit("bad"))
    )
    rows = staging.read_table(spark, sf_dir, "orders").select(k.alias("key"), text.alias("text"))
    return rows.select("key", "text", coerce.utc_timestamp("text").alias("parsed"))


# Spellings of a truth flag used to exercise the KYC text rule.
TRUTH_SPELLINGS = ["TRUE", "true", "True", "t", "yes", "1", None, "FALSE"]


def q_text_truth_filter(spark, sf_dir):
    c = F.col("c_custkey")
    text = F.element_at(F.array(*[F.lit(v) for v in TRUTH_SPELLINGS]), (c % len(TRUTH_SPELLINGS) + 1).cast("int"))
    rows = staging.read_table(spark, sf_dir, "customer").select(c.alias("key"), text.alias("text"))
    return rows.where(coerce.truth_text("text"))


# --- marts --------------------------------------------------------------------


def q_daily_ledger(spark, sf_dir):
    return marts.daily_ledger(_cleaned(spark, sf_dir)["transactions"], stamp=False)


def q_conditional_sum_by_day(spark, sf_dir):
    return marts.daily_ledger(staging.event_transactions(spark, sf_dir), stamp=False)


def q_distinct_selected_players(spark, sf_dir):
    c = _cleaned(spark, sf_dir)
    return marts.selected_players(c["players"], c["affiliates"], "Discord")


def q_segment_totals(spark, sf_dir):
    c = _Stored(spark, sf_dir)  # players feed the selection, the affiliates and the gate
    return marts.segment_totals(c["players"], c["affiliates"], c["transactions"], stamp=False)


def q_rank_per_player(spark, sf_dir):
    return marts.ranked_rows(staging.raw_transactions(spark, sf_dir), 3)


def q_top_n_wide(spark, sf_dir):
    return marts.top_n_wide(_cleaned(spark, sf_dir)["transactions"], 3, stamp=False)


# --- data tests -----------------------------------------------------------------


def _marts(c) -> dict[str, DataFrame]:
    return {
        "daily_ledger": marts.daily_ledger(c["transactions"]),
        "segment_totals": marts.segment_totals(c["players"], c["affiliates"], c["transactions"]),
        "top_n_wide": marts.top_n_wide(c["transactions"], 3),
    }


def q_check_unique(spark, sf_dir):
    return quality.duplicates(staging.raw_players(spark, sf_dir), "id")


def q_check_not_null(spark, sf_dir):
    raw = staging.raw_players(spark, sf_dir)
    return quality.check_not_null(raw, "raw_players", raw.columns)


class _Stored(_Cleaned):
    """Cleaned tables as the daily run hands them on: each is written to the
    shared folder once, and every reader reads the files. Players first; then
    both others, which need only them, at the same time."""

    def __getitem__(self, name: str) -> DataFrame:
        if not self._built:
            plain = _cleaned(self.spark, self.sf_dir)
            plain._built["players"] = self._built["players"] = self._written("players", plain["players"])
            others = ("affiliates", "transactions")
            with ThreadPoolExecutor(len(others)) as pool:
                done = pool.map(lambda n: self._written(n, plain[n]), others)
                self._built.update(zip(others, done))
        return self._built[name]

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        path = files.write_parquet(df, _folder(self.spark, f"cleaned-{name}"))
        return self.spark.read.schema(df.schema).parquet(path)


def q_quality_report(spark, sf_dir):
    c = _Stored(spark, sf_dir)
    tables = {
        "raw_players": clean.landing_players(c["players"]),
        "raw_affiliates": c["affiliates"],
        "raw_transactions": c["transactions"],
        **_marts(c),
    }
    return quality.quality_report(tables)


def q_invariant_report(spark, sf_dir):
    c = _Stored(spark, sf_dir)
    return quality.invariant_report(
        c["players"], c["affiliates"], c["transactions"], marts.daily_ledger(c["transactions"], stamp=False)
    )


# --- identifiers, sequences, increments ------------------------------------------

SEED = 42
AS_OF = increment.DEFAULT_AS_OF
# The reference's fixed target size per table.
REFERENCE_TARGET = 1000


def _doubled(n_ids: int) -> int:
    """Target used by the registered increment queries: twice the current
    number of distinct ids, so the generated part grows with the input."""
    return 2 * n_ids


def q_next_identifier(spark, sf_dir):
    return aggregates.id_stats(staging.raw_transactions(spark, sf_dir), "id")


def q_shortfall(spark, sf_dir):
    parts = []
    for name, df in staging.raw_tables(spark, sf_dir).items():
        parts.append(
            aggregates.id_stats(df, "id", REFERENCE_TARGET).select(F.lit(name).alias("table_name"), "*")
        )
    return quality.union_all(parts)


def q_running_allocation(spark, sf_dir):
    players = staging.raw_players(spark, sf_dir)
    start = staging.raw_affiliates(spark, sf_dir).agg(F.max("id")).first()[0] or 0
    rows = players.select("id", "ver", "affiliate_id")
    return sequence.running_allocation(
        rows, ["id", "ver"], F.col("affiliate_id").isNotNull(), int(start), "allocated"
    )


def q_union_increment(spark, sf_dir):
    base = staging.raw_transactions(spark, sf_dir)
    start = aggregates.id_stats(base, "id").select("next_id")
    events = staging.event_transactions(spark, sf_dir)
    # New ids continue from the base's max + 1 (scalar subquery, evaluated once).
    extra = events.withColumn("id", F.col("id") + start.scalar())
    return base.unionByName(extra.select("player_id", "amount", "type", "timestamp", "id"))


def _expanded_players(spark, sf_dir) -> DataFrame:
    base = staging.raw_players(spark, sf_dir)
    return increment.extend_players(base, _doubled, SEED, AS_OF)


def q_extend_players(spark, sf_dir):
    return _expanded_players(spark, sf_dir)


def q_extend_affiliates(spark, sf_dir):
    base = staging.raw_affiliates(spark, sf_dir)
    return increment.extend_affiliates(base, _expanded_players(spark, sf_dir), _doubled, SEED)


def q_extend_transactions(spark, sf_dir):
    base = staging.raw_transactions(spark, sf_dir)
    return increment.extend_transactions(base, _expanded_players(spark, sf_dir), _doubled, SEED, AS_OF)


# --- files, tables and the whole run: written to the shared folder, read back ---


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _database(spark, name: str) -> str:
    """A database of its own below the shared folder, so that two runs never
    meet in one table."""
    full = f"{name}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {full} LOCATION '{_folder(spark, name)}'")
    return full


def q_csv_round_trip(spark, sf_dir):
    """S4, X4, S1 — text with quotes, commas, line breaks and outer blanks, and
    timestamps with their offset, through a CSV folder."""
    k = F.col("o_orderkey")
    name = F.col("o_orderpriority")
    text = (
        F.when(k % 5 == 0, F.concat(F.lit(' "'), name, F.lit('", ok ')))
        .when(k % 5 == 1, F.concat(name, F.lit("\nsecond line")))
        .when(k % 5 == 2, F.concat(F.lit("back\\slash "), name))
        .when(k % 5 == 3, name)
    )
    rows = staging.read_table(spark, sf_dir, "orders").select(
        k.alias("key"), text.alias("text"), F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + k % 86400).alias("at")
    )
    path = files.write_csv(rows, _folder(spark, "csv"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("at", T.TimestampType())])
    return files.read_csv(spark, path, schema, (), multi_line=True)


def q_parquet_round_trip(spark, sf_dir):
    """S3, S2 — typed transactions through a Parquet folder."""
    path = files.write_parquet(staging.raw_transactions(spark, sf_dir), _folder(spark, "parquet"))
    return files.read_parquet(spark, path)


def q_land_players(spark, sf_dir):
    """C4 (S5, S6, S7) — the cleaned players in their landing table; landed
    twice, so the second load replaces the first."""
    database = _database(spark, "landing")
    players = clean.landing_players(_cleaned(spark, sf_dir)["players"])
    catalog.land(players.where("id % 2 = 0"), spark, database, "players")
    catalog.land(players, spark, database, "players")
    return catalog.source(spark, database, "raw_players")


def _in_reading_order(spark, name, mart):
    """S8, O3 — a mart stored in the reading order, with each row's place in
    it read off the files."""
    full = catalog.materialize(mart, _database(spark, "marts"), name, marts.reading_order(name))
    return catalog.places(spark.table(full))


def q_stored_ledger(spark, sf_dir):
    return _in_reading_order(spark, "daily_ledger", marts.daily_ledger(_cleaned(spark, sf_dir)["transactions"], stamp=False))


def q_stored_totals(spark, sf_dir):
    return _in_reading_order(spark, "segment_totals", q_segment_totals(spark, sf_dir))


def q_stored_top_n(spark, sf_dir):
    return _in_reading_order(spark, "top_n_wide", q_top_n_wide(spark, sf_dir))


def q_segment_totals_versions(spark, sf_dir):
    """J5 on players that are not de-duplicated: the second version of a player
    has another country, so each amount counts once per country code and
    version, as the SQL does."""
    country = F.when(F.col("ver") == 1, F.concat(F.lit("X"), F.col("country_code"))).otherwise(F.col("country_code"))
    players = staging.raw_players(spark, sf_dir).withColumn("country_code", country)
    return marts.segment_totals(players, staging.raw_affiliates(spark, sf_dir), staging.raw_transactions(spark, sf_dir), stamp=False)


def q_daily_run(spark, sf_dir):
    """R1 — raw CSV files through the whole run: extension to twice the ids,
    cleaning with hot players salted, landing, marts, tests. Every row of every
    stored table, as text, and the number of tests passed."""
    raw = _folder(spark, "raw")
    for name, df in staging.raw_tables(spark, sf_dir).items():
        columns = [f.name for f in SCHEMAS[name].fields]
        files.write_csv(df.select(*columns), f"{raw}/{name}")
    result = daily_run.daily_run(spark, raw, _folder(spark, "work"), _database(spark, "run"), target=_doubled, seed=SEED, as_of=AS_OF)
    parts = [spark.createDataFrame([("tests", str(len(result.tests)))], "table_name string, content string")]
    for key, t in {**{f"raw_{t}": n for t, n in result.landing.items()}, **result.marts}.items():
        df = spark.table(t).drop("updated_datetime")
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns])
        parts.append(df.select(F.lit(key).alias("table_name"), text.alias("content")))
    return quality.union_all(parts)


REGISTRY: dict[str, Query] = {
    "latest_by_key": q_latest_by_key,
    "null_dangling": q_null_dangling,
    "first_claim": q_first_claim,
    "fill_from_linked": q_fill_from_linked,
    "kyc_time_gate": q_kyc_time_gate,
    "null_safe_join": q_null_safe_join,
    "coerce_ids": q_coerce_ids,
    "coerce_amounts": q_coerce_amounts,
    "coerce_timestamps": q_coerce_timestamps,
    "text_truth_filter": q_text_truth_filter,
    "clean_players": q_clean_players,
    "clean_affiliates": q_clean_affiliates,
    "clean_transactions": q_clean_transactions,
    "daily_ledger": q_daily_ledger,
    "conditional_sum_by_day": q_conditional_sum_by_day,
    "distinct_selected_players": q_distinct_selected_players,
    "segment_totals": q_segment_totals,
    "rank_per_player": q_rank_per_player,
    "top_n_wide": q_top_n_wide,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "quality_report": q_quality_report,
    "invariant_report": q_invariant_report,
    "next_identifier": q_next_identifier,
    "shortfall": q_shortfall,
    "running_allocation": q_running_allocation,
    "union_increment": q_union_increment,
    "extend_players": q_extend_players,
    "extend_affiliates": q_extend_affiliates,
    "extend_transactions": q_extend_transactions,
    "csv_round_trip": q_csv_round_trip,
    "parquet_round_trip": q_parquet_round_trip,
    "land_players": q_land_players,
    "stored_ledger": q_stored_ledger,
    "stored_totals": q_stored_totals,
    "stored_top_n": q_stored_top_n,
    "segment_totals_versions": q_segment_totals_versions,
    "daily_run": q_daily_run,
}


def queries() -> dict[str, Query]:
    return {
        name: (lambda spark, sf_dir, _q=q, _d=NULLABLE_INTEGERS.get(name, ()): comparable(_q(spark, sf_dir), _d))
        for name, q in REGISTRY.items()
    }
