"""The daily end-to-end batch — extend → clean → land → marts → tests.

One Spark application runs the steps in the reference's order. Every hand-off
goes through storage (expanded and transformed files, catalog tables), as in the
reference; this also cuts the lineage, so a lost executor only reruns
tasks of the current step. ``work_dir`` must be shared storage on a cluster.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ledgerlake.functions.coerce import PANDAS_NA_TOKENS, TIMESTAMP_PATTERN
from ledgerlake.plans import clean, increment, marts, quality
from ledgerlake.session import configure
from ledgerlake.sources import catalog, files

TABLES = ("players", "affiliates", "transactions")
MART_NAMES = {"daily_ledger": "daily_ledger", "segment_totals": "segment_totals", "top_n_wide": "top_n_wide"}


@dataclass
class RunResult:
    expanded: dict[str, str] = field(default_factory=dict)
    transformed: dict[str, str] = field(default_factory=dict)
    landing: dict[str, str] = field(default_factory=dict)
    marts: dict[str, str] = field(default_factory=dict)
    tests: list[tuple] = field(default_factory=list)


def daily_run(
    spark: SparkSession,
    raw_dir: str,
    work_dir: str,
    database: str = "data",
    target: increment.Target = 1000,
    seed: int = 42,
    as_of: str = increment.DEFAULT_AS_OF,
    channel: str = "Discord",
    top_n: int = 3,
    na_tokens=PANDAS_NA_TOKENS,
    pattern: str = TIMESTAMP_PATTERN,
    extend: bool = True,
    expanded_format: str = "parquet",
    buckets: int = 0,
    hot_key_share: float | None = 0.01,
    fail_on_test_failure: bool = True,
    multi_line: bool = False,
) -> RunResult:
    """Run the whole batch. ``raw_dir`` holds ``players``, ``affiliates`` and
    ``transactions`` CSV files or folders (``<name>.csv`` or ``<name>``).

    ``expanded_format="parquet"`` hands the extended tables to the cleaning
    step typed; ``"csv"`` hands them over as text, like the reference. Text is
    read back in the layout it was written in, whatever ``pattern`` and
    ``na_tokens`` the raw files need, so both give the same values; Parquet
    takes a fraction of the I/O. ``multi_line``: the raw files hold line breaks
    inside quotes (:func:`ledgerlake.sources.files.read_csv`).

    ``buckets`` > 0 stores the players and transactions landing tables
    bucketed by player (see :func:`ledgerlake.sources.catalog.ensure_landing_table`):
    the three marts then read transactions without a shuffle. It is off by
    default because a bucketed scan reads each bucket in one task: if one
    player holds a large share of all transactions, that task gets all of it,
    whereas the unbucketed plan combines the player's rows map-side first.

    ``hot_key_share``: player ids with at least this share of a 1% sample of
    the transactions are salted in the KYC gate join (None: leave hot keys
    to AQE's skew split)."""
    configure(spark)
    out = RunResult()

    def raw_path(name: str) -> str:
        for cand in (f"{raw_dir}/{name}.csv", f"{raw_dir}/{name}"):
            if files.exists(spark, cand):
                return cand
        return f"{raw_dir}/{name}.csv"

    raw = {t: files.read_raw_table(spark, raw_path(t), t, na_tokens, pattern, multi_line) for t in TABLES}

    if expanded_format not in ("csv", "parquet"):
        raise ValueError("expanded_format must be 'csv' or 'parquet'")

    def hand_off(df, table: str):
        path = f"{work_dir}/expanded/{table}"
        if expanded_format == "csv":
            out.expanded[table] = files.write_csv(df, path)
            # as written by write_csv, not as the raw files: generated text may
            # hold line breaks and words that stand for null in the raw files
            return files.read_raw_table(spark, path, table, (), files.TIMESTAMP_PATTERN, multi_line)
        out.expanded[table] = files.write_parquet(df, path)
        return files.read_parquet(spark, path)

    # 1. Extend (G1, then G2 and G3 from the expanded players).
    if extend:
        players_x = hand_off(increment.extend_players(raw["players"], target, seed, as_of), "players")
        aff_x = increment.extend_affiliates(raw["affiliates"], players_x, target, seed)
        txn_x = increment.extend_transactions(raw["transactions"], players_x, target, seed, as_of)
        raw = {
            "players": players_x,
            "affiliates": hand_off(aff_x, "affiliates"),
            "transactions": hand_off(txn_x, "transactions"),
        }

    # 2. Clean (C1 → C2, C3); cleaned players are written once and read twice.
    out.transformed["players"] = files.write_parquet(
        clean.clean_players(raw["players"], raw["affiliates"], pattern), f"{work_dir}/transformed/players"
    )
    players = files.read_parquet(spark, out.transformed["players"])
    out.transformed["affiliates"] = files.write_parquet(
        clean.clean_affiliates(raw["affiliates"], players, pattern), f"{work_dir}/transformed/affiliates"
    )
    out.transformed["transactions"] = files.write_parquet(
        clean.clean_transactions(raw["transactions"], players, pattern, hot_key_share),
        f"{work_dir}/transformed/transactions",
    )

    # 3. Land (C4): fixed schema, full refresh, all three in one commit.
    transformed = {t: files.read_parquet(spark, p) for t, p in out.transformed.items()}
    transformed["players"] = clean.landing_players(transformed["players"])
    out.landing = catalog.land_all({t: transformed[t] for t in TABLES}, spark, database, buckets or None)

    # 4. Marts (M1–M3) from the landing tables, materialised.
    src = {t: catalog.source(spark, database, f"raw_{t}") for t in TABLES}
    built = {
        "daily_ledger": marts.daily_ledger(src["transactions"]),
        "segment_totals": marts.segment_totals(src["players"], src["affiliates"], src["transactions"], channel),
        "top_n_wide": marts.top_n_wide(src["transactions"], top_n),
    }
    for key, df in built.items():
        out.marts[key] = catalog.materialize(df, database, MART_NAMES[key])

    # 5. Tests (T3) on what was stored.
    stored = {f"raw_{t}": src[t] for t in TABLES}
    stored.update({key: spark.table(name) for key, name in out.marts.items()})
    report = quality.quality_report(stored).unionByName(
        quality.union_all([quality.check_row_count(src[t], transformed[t], f"raw_{t}") for t in TABLES])
    )
    if fail_on_test_failure:
        out.tests = quality.run_tests(report)
    else:
        out.tests = [tuple(r) for r in report.collect()]
    return out


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m ledgerlake.plans.daily_run --raw DIR --work DIR``.

    Uses the active session (e.g. under ``spark-submit``) or builds one.
    """
    import argparse

    parser = argparse.ArgumentParser(description="Daily extend → clean → land → marts → tests run")
    parser.add_argument("--raw", required=True, help="folder with players/affiliates/transactions CSV")
    parser.add_argument("--work", required=True, help="shared folder for expanded and transformed data")
    parser.add_argument("--database", default="data")
    parser.add_argument("--target", type=int, default=1000)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--as-of", default=increment.DEFAULT_AS_OF)
    parser.add_argument("--no-extend", action="store_true")
    parser.add_argument("--expanded-format", choices=("csv", "parquet"), default="parquet")
    args = parser.parse_args(argv)
    # An existing session (spark-submit) is used as is; a new one has no UI.
    spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    result = daily_run(
        spark,
        args.raw,
        args.work,
        database=args.database,
        target=args.target,
        seed=args.seed,
        as_of=args.as_of,
        extend=not args.no_extend,
        expanded_format=args.expanded_format,
    )
    for row in result.tests:
        print("\t".join(map(str, row)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
