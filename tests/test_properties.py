"""Property tests: the key-wise operators against a direct pandas rendering
of the reference's rules, on random small frames.

Sort values are drawn without repeats (apart from nulls) because the
reference leaves the order of ties unspecified.
"""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators import keyed

SETTINGS = settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


@st.composite
def versions(draw):
    n = draw(st.integers(1, 25))
    keys = draw(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=n, max_size=n))
    days = draw(st.lists(st.integers(0, 10_000), min_size=n, max_size=n, unique=True))
    nulls = draw(st.lists(st.booleans(), min_size=n, max_size=n))
    rows, seen_null_key = [], set()
    for i, (k, d, is_null) in enumerate(zip(keys, days, nulls)):
        # at most one null sort value per key keeps the expected row unique
        sort_null = is_null and k not in seen_null_key
        if sort_null:
            seen_null_key.add(k)
        ts = None if sort_null else dt.datetime(2000, 1, 1) + dt.timedelta(days=d)
        rows.append((k, ts, f"v{i}"))
    return rows


@SETTINGS
@given(versions())
def test_latest_by_key_matches_sort_keep_last(spark, rows):
    df = spark.createDataFrame(rows, "id long, updated_at timestamp, payload string")
    got = sorted((r.id if r.id is not None else -1, r.payload) for r in keyed.latest_by_key(df, "id", "updated_at").collect())
    pdf = pd.DataFrame(rows, columns=["id", "updated_at", "payload"])
    want_df = pdf.sort_values("updated_at", na_position="last", kind="stable").drop_duplicates("id", keep="last")
    want = sorted((-1 if pd.isna(i) else int(i), p) for i, p in zip(want_df["id"], want_df["payload"]))
    assert got == want


@st.composite
def claims(draw):
    n = draw(st.integers(1, 25))
    ids = draw(st.lists(st.integers(0, 10_000), min_size=n, max_size=n, unique=True))
    links = draw(st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=n, max_size=n))
    days = draw(st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=n, max_size=n))
    return [(i, l, None if d is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=d)) for i, l, d in zip(ids, links, days)]


@SETTINGS
@given(claims())
def test_first_claim_matches_sort_keep_first(spark, rows):
    df = spark.createDataFrame(rows, "id long, affiliate_id long, created_at timestamp")
    got = {r.id: r.affiliate_id for r in keyed.first_claim(df).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "affiliate_id", "created_at"]).astype({"affiliate_id": "Int64"})
    pdf = pdf.sort_values(["created_at", "id"], na_position="last", kind="stable")
    dup = pdf["affiliate_id"].notna() & pdf.duplicated(subset="affiliate_id", keep="first")
    pdf.loc[dup, "affiliate_id"] = pd.NA
    want = {int(i): (None if pd.isna(a) else int(a)) for i, a in zip(pdf["id"], pdf["affiliate_id"])}
    assert got == want
