"""Registered queries read whole tables: no row limit anywhere in their
optimised plans (WindowGroupLimit is the top-n feature itself)."""

import re

import pytest

from ledgerlake import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_no_row_limit_in_plan(spark, name):
    df = Q.queries()[name](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    limits = [m for m in re.findall(r"\b(\w*Limit)\b", text) if m != "WindowGroupLimit"]
    assert limits == []
