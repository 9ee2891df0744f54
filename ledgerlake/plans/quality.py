"""Declarative column tests, plus the invariants the reference intends
but never asserts.

Every test yields rows ``(table_name, column_name, test_name, failures)``:

* ``unique`` — number of non-null values that occur more than once;
* ``not_null`` — number of null rows.

All tests of one table are one grouped aggregate over it: rows are grouped by
the tested values (several unique columns are expanded into one stream of
column number and value), null counts of the other columns ride along. So a
table is read once and shuffled once, after partial aggregation, in which a
hot value is combined map-side.

:func:`run_tests` collects the report (one row per declared test, a bounded
size) and raises if any test fails.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.keyed import hot_key_sketch, null_safe_join

@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    name: str
    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()


# Declared tests of the three landing tables and the three marts
# (4 unique + 13 not_null).
DECLARED = {
    "raw_players": TableTests("raw_players", unique=("id",), not_null=("id",)),
    "raw_affiliates": TableTests("raw_affiliates", unique=("id",), not_null=("id",)),
    "raw_transactions": TableTests("raw_transactions", unique=("id",), not_null=("id", "player_id")),
    "daily_ledger": TableTests(
        "daily_ledger", not_null=("player_id", "transaction_date", "updated_datetime")
    ),
    "segment_totals": TableTests(
        "segment_totals",
        not_null=("country_code", "deposit_count", "total_deposits", "updated_datetime"),
    ),
    "top_n_wide": TableTests("top_n_wide", unique=("player_id",), not_null=("player_id", "updated_datetime")),
}


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """T1 detail — non-null values of ``column`` seen more than once, with
    their row count ``n_records``."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """T1 — one report row: how many values of ``column`` are duplicated."""
    return check_columns(df, TableTests(table, unique=(column,)))


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """T2 — one report row per column: its number of nulls."""
    return check_columns(df, TableTests(table, not_null=tuple(columns)))


def check_columns(df: DataFrame, tests: TableTests) -> DataFrame:
    """T1 and T2 of one table in one pass: a report row per declared test."""
    nulls = {c: f"__nulls{i}" for i, c in enumerate(tests.not_null)}
    counted = [F.col(c).isNull().cast("long").alias(n) for c, n in nulls.items()]
    sums = [F.sum(n).alias(n) for n in nulls.values()]
    names = [f"__unique{i}" for i in range(len(tests.unique))]
    if tests.unique:
        if len(tests.unique) == 1:
            rows = df.select(F.lit(0).alias("__at"), F.col(tests.unique[0]).alias("__value"), *counted)
        else:
            # a row per unique column; the null counts go with the first
            pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(tests.unique)])
            rows = df.select(F.explode(pairs).alias("__p"), *counted).select(
                F.col("__p.at").alias("__at"),
                F.col("__p.value").alias("__value"),
                *[F.when(F.col("__p.at") == 0, F.col(n)).otherwise(0).alias(n) for n in nulls.values()],
            )
        # a constant is no grouping key: one column needs none
        keys = ["__at", "__value"] if len(tests.unique) > 1 else ["__value"]
        grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *sums)
        twice = F.col("__value").isNotNull() & (F.col("__n") > 1)
        found = [F.count(F.when(twice & (F.col("__at") == i if len(names) > 1 else F.lit(True)), 1)).alias(n) for i, n in enumerate(names)]
        counts = grouped.agg(*found, *sums)
    else:
        counts = df.select(*counted).agg(*sums)
    lines = [(c, "unique", n) for c, n in zip(tests.unique, names)] + [(c, "not_null", n) for c, n in nulls.items()]
    listed = F.array(
        *[
            F.struct(
                F.lit(tests.name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit(t).alias("test_name"),
                F.coalesce(F.col(n), F.lit(0)).cast("long").alias("failures"),
            )
            for c, t, n in lines
        ]
    )
    return counts.select(F.explode(listed).alias("r")).select("r.*")


def check_row_count(stored: DataFrame, written: DataFrame, table: str) -> DataFrame:
    """One report row: how many rows more or fewer the stored table has than
    the files it was loaded from."""
    other = written.select(F.count(F.lit(1))).scalar()
    return stored.agg(F.count(F.lit(1)).alias("a")).withColumn("b", other).select(
        F.lit(table).alias("table_name"),
        F.lit("*").alias("column_name"),
        F.lit("row_count").alias("test_name"),
        F.abs(F.col("a") - F.col("b")).cast("long").alias("failures"),
    )


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def quality_report(tables: dict[str, DataFrame], declared: dict[str, TableTests] = DECLARED) -> DataFrame:
    """T3 report over the given tables (keys as in ``declared``)."""
    return union_all(check_columns(tables[name], tests) for name, tests in declared.items() if name in tables)


def invariant_report(
    players: DataFrame,
    affiliates: DataFrame,
    transactions: DataFrame,
    ledger: DataFrame,
) -> DataFrame:
    """The cleaning's intentions as tests:

    * each affiliate is linked by at most one player;
    * no player links to a missing affiliate;
    * every transaction belongs to an approved player;
    * no transaction precedes its player's creation;
    * daily withdrawals are never positive.
    """
    # one grouping by link serves both link tests; affiliates are unique by id
    aff_ids = affiliates.select(F.col("id").alias("__aff")).where(F.col("__aff").isNotNull()).distinct()
    links = players.where(F.col("affiliate_id").isNotNull()).groupBy("affiliate_id").agg(F.count(F.lit(1)).alias("__n"))
    link_rows = _report_rows(
        links.join(aff_ids, F.col("affiliate_id") == F.col("__aff"), "left").agg(
            F.count(F.when(F.col("__n") > 1, 1)).alias("one_player_per_affiliate"),
            F.sum(F.when(F.col("__aff").isNull(), F.col("__n")).otherwise(0)).alias("affiliate_exists"),
        ),
        "raw_players",
        "affiliate_id",
    )
    p = players.select(
        F.col("id").alias("__pid"),
        F.col("is_kyc_approved").cast("string").alias("__kyc"),
        F.col("created_at").alias("__created"),
    )
    # Null-safe left join with salted null keys and hot players (as the KYC gate).
    t = null_safe_join(transactions, p, "player_id", "__pid", "left", hot=hot_key_sketch(transactions, "player_id"))
    gate = t.agg(
        F.sum(
            F.when(F.coalesce(F.upper(F.col("__kyc")) == "TRUE", F.lit(False)), 0).otherwise(1)
        ).alias("player_approved"),
        F.sum(F.when(F.col("timestamp") >= F.col("__created"), 0).otherwise(1)).alias("player_after_creation"),
    )
    gate_rows = _report_rows(gate, "raw_transactions", "player_id")
    withdrawals = ledger.agg(F.sum((F.col("withdrawals") > 0).cast("long")).alias("not_positive"))
    return union_all([link_rows, gate_rows, _report_rows(withdrawals, "daily_ledger", "withdrawals")])


def _report_rows(counts: DataFrame, table: str, column: str) -> DataFrame:
    """Report rows of a one-row frame of failures, a column per test."""
    return counts.fillna(0).unpivot([], list(counts.columns), "test_name", "failures").select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "test_name", F.col("failures").cast("long").alias("failures")
    )


class QualityError(AssertionError):
    pass


def run_tests(report: DataFrame) -> list[tuple]:
    """T3 — evaluate the report; raise :class:`QualityError` on any failure.

    The report has one row per declared test, so collecting it is bounded.
    """
    rows = [tuple(r) for r in report.collect()]
    failed = [r for r in rows if r[3]]
    if failed:
        raise QualityError(f"{len(failed)} data test(s) failed: {failed}")
    return rows
