"""ledgerlake — account and transaction analytics as Spark DataFrame plans.

Main entry points::

    from ledgerlake import configure, clean_all, daily_ledger, segment_totals, top_n_wide
    from ledgerlake import quality_report, run_tests, daily_run
"""

from ledgerlake.plans.clean import clean_affiliates, clean_all, clean_players, clean_transactions
from ledgerlake.plans.daily_run import daily_run
from ledgerlake.plans.increment import extend_affiliates, extend_players, extend_transactions
from ledgerlake.plans.marts import daily_ledger, segment_totals, top_n_wide
from ledgerlake.plans.quality import invariant_report, quality_report, run_tests
from ledgerlake.session import configure

__all__ = [
    "clean_affiliates",
    "clean_all",
    "clean_players",
    "clean_transactions",
    "configure",
    "daily_ledger",
    "daily_run",
    "extend_affiliates",
    "extend_players",
    "extend_transactions",
    "invariant_report",
    "quality_report",
    "run_tests",
    "segment_totals",
    "top_n_wide",
]
