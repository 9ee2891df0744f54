"""Independent SQL (DuckDB dialect) for every registered query.

Written directly from the reference's semantics, not from the Spark plans:
window ``ROW_NUMBER`` where the engine uses grouped aggregates, ``IN``
subqueries where it uses semi-joins, and so on. PostgreSQL null ordering is
stated explicitly everywhere (ledger L13, L14). Amounts are cast to DOUBLE
and timestamps stay naive UTC, matching :func:`ledgerlake.queries.comparable`.
"""

from __future__ import annotations

# --- staging (FIXTURES §3) ----------------------------------------------------

RAW_PLAYERS = """
raw_players AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 3 <> 0
              THEN (c_custkey * 7) % (SELECT count(*) * 6 // 5 FROM supplier) END AS affiliate_id,
         'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
         (c_custkey + v.ver) % 4 <> 0 AS is_kyc_approved,
         CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '1995-01-01 00:00:00'
              ELSE TIMESTAMP '1998-01-01 00:00:00' END AS created_at,
         CASE WHEN v.ver = 1 THEN TIMESTAMP '2000-01-01 00:00:00'
              WHEN c_custkey % 10 <> 0 THEN TIMESTAMP '1999-01-01 00:00:00' END AS updated_at,
         v.ver AS ver
  FROM customer JOIN (VALUES (0), (1)) AS v(ver) ON v.ver = 0 OR c_custkey % 5 = 0
)"""

RAW_AFFILIATES = """
raw_affiliates AS (
  SELECT s_suppkey AS id, s_name AS code,
         CASE s_suppkey % 4 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'Discord' WHEN 2 THEN 'X' END AS origin,
         CASE WHEN s_suppkey % 5 <> 0 THEN TIMESTAMP '1996-06-01 00:00:00' END AS redeemed_at
  FROM supplier
  UNION ALL
  SELECT s_suppkey, s_name, 'Discord', TIMESTAMP '1997-01-01 00:00:00' FROM supplier WHERE s_suppkey % 10 = 3
)"""

RAW_TRANSACTIONS = """
raw_transactions AS (
  SELECT o_orderkey AS id, o_orderdate + to_seconds(o_orderkey * 7919 % 86400 + v.ver * 86400) AS "timestamp", o_custkey AS player_id,
         CASE o_orderstatus WHEN 'F' THEN 'Deposit' WHEN 'O' THEN 'Withdraw' WHEN 'P' THEN 'Bonus' END AS type,
         CASE WHEN o_orderkey % 97 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) + v.ver AS DECIMAL(18,2)) END AS amount
  FROM orders JOIN (VALUES (0), (1)) AS v(ver) ON v.ver = 0 OR o_orderkey % 7 = 0
)"""

EVENT_TRANSACTIONS = """
event_transactions AS (
  SELECT event_id AS id, ts AS "timestamp", user_id AS player_id,
         CASE event_type WHEN 'purchase' THEN 'Deposit' WHEN 'click' THEN 'Withdraw' WHEN 'signup' THEN 'Bonus' ELSE 'Other' END AS type,
         CAST(value AS DECIMAL(18,2)) AS amount
  FROM events
)"""

# --- cleaning -----------------------------------------------------------------

LATEST_PLAYERS = """
latest_players AS (
  SELECT id, affiliate_id, country_code, is_kyc_approved, created_at, updated_at, ver FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY id
      ORDER BY updated_at DESC NULLS FIRST, affiliate_id DESC NULLS LAST, country_code DESC NULLS LAST,
               is_kyc_approved DESC NULLS LAST, created_at DESC NULLS LAST, ver DESC NULLS LAST) AS rn
    FROM raw_players) WHERE rn = 1
)"""

VALID_LINK_PLAYERS = """
valid_link_players AS (
  SELECT id,
         CASE WHEN affiliate_id IN (SELECT id FROM raw_affiliates WHERE id IS NOT NULL)
              THEN affiliate_id END AS affiliate_id,
         country_code, is_kyc_approved, created_at, updated_at, ver
  FROM latest_players
)"""

CLEAN_PLAYERS = """
claimed_players AS (
  SELECT id, affiliate_id AS raw_link, country_code, is_kyc_approved, created_at, updated_at, ver,
         ROW_NUMBER() OVER (
           PARTITION BY affiliate_id
           ORDER BY created_at ASC NULLS LAST, id ASC NULLS LAST, country_code ASC NULLS LAST,
                    is_kyc_approved ASC NULLS LAST, updated_at ASC NULLS LAST, ver ASC NULLS LAST) AS claim_rank
  FROM valid_link_players
),
clean_players AS (
  SELECT id, CASE WHEN raw_link IS NOT NULL AND claim_rank = 1 THEN raw_link END AS affiliate_id,
         country_code, is_kyc_approved, created_at, updated_at
  FROM claimed_players
)"""

CLEAN_AFFILIATES = """
latest_affiliates AS (
  SELECT id, code, origin, redeemed_at FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY id ORDER BY redeemed_at DESC NULLS FIRST, code DESC NULLS LAST, origin DESC NULLS LAST) AS rn
    FROM raw_affiliates) WHERE rn = 1
),
clean_affiliates AS (
  SELECT a.id, a.code, a.origin, COALESCE(l.created_at, a.redeemed_at) AS redeemed_at
  FROM latest_affiliates a
  LEFT JOIN (SELECT affiliate_id, created_at FROM clean_players
             WHERE affiliate_id IS NOT NULL AND created_at IS NOT NULL) l
    ON a.id = l.affiliate_id
)"""

CLEAN_TRANSACTIONS = """
latest_transactions AS (
  SELECT id, "timestamp", player_id, type, amount FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY id ORDER BY "timestamp" DESC NULLS FIRST, player_id DESC NULLS LAST,
                               type DESC NULLS LAST, amount DESC NULLS LAST) AS rn
    FROM raw_transactions) WHERE rn = 1
),
clean_transactions AS (
  SELECT t.id, t."timestamp", t.player_id, t.type, t.amount
  FROM latest_transactions t
  JOIN clean_players p ON t.player_id IS NOT DISTINCT FROM p.id
  WHERE upper(CAST(p.is_kyc_approved AS VARCHAR)) = 'TRUE'
    AND t."timestamp" >= p.created_at
)"""

STAGING = [RAW_PLAYERS, RAW_AFFILIATES, RAW_TRANSACTIONS]
CLEANING = STAGING + [LATEST_PLAYERS, VALID_LINK_PLAYERS, CLEAN_PLAYERS, CLEAN_AFFILIATES, CLEAN_TRANSACTIONS]


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _ledger(source: str) -> str:
    return f"""
SELECT player_id, CAST("timestamp" AS DATE) AS transaction_date,
       CAST(SUM(CASE WHEN type = 'Deposit' THEN amount ELSE 0 END) AS DOUBLE) AS deposits,
       CAST(SUM(CASE WHEN type = 'Withdraw' THEN -amount ELSE 0 END) AS DOUBLE) AS withdrawals,
       CAST(SUM(CASE WHEN type = 'Deposit' THEN amount ELSE 0 END)
            + SUM(CASE WHEN type = 'Withdraw' THEN -amount ELSE 0 END) AS DOUBLE) AS summary
FROM {source}
WHERE type IN ('Deposit', 'Withdraw')
GROUP BY player_id, CAST("timestamp" AS DATE)"""


CHANNEL_PAIRS = """
channel_pairs AS (
  SELECT id AS player_id, country_code FROM clean_players
  WHERE is_kyc_approved AND affiliate_id IN (SELECT id FROM clean_affiliates WHERE origin = 'Discord')
  GROUP BY id, country_code
)"""

# Totals per player, each counted once per country code of that player.
COUNTRY_TOTALS = """
per_player AS (
  SELECT player_id, COUNT(amount) AS n, SUM(amount) AS s FROM clean_transactions WHERE type = 'Deposit' GROUP BY player_id
),
copies AS (SELECT player_id, COUNT(*) AS m FROM channel_pairs GROUP BY player_id),
country_totals AS (
  SELECT country_code, CAST(SUM(m * n) AS BIGINT) AS deposit_count, SUM(m * s) AS total_deposits
  FROM channel_pairs JOIN copies USING (player_id) JOIN per_player USING (player_id)
  GROUP BY country_code HAVING SUM(n) > 0
)"""

RANKED = """
SELECT player_id, CAST(amount AS DOUBLE) AS amount, "timestamp", CAST(deposit_rank AS INTEGER) AS deposit_rank FROM (
  SELECT player_id, amount, "timestamp",
         ROW_NUMBER() OVER (PARTITION BY player_id
                            ORDER BY amount DESC NULLS FIRST, "timestamp" DESC NULLS FIRST) AS deposit_rank
  FROM {source} WHERE type = 'Deposit')
WHERE deposit_rank <= 3"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["latest_by_key"] = with_ctes(
        STAGING + [LATEST_PLAYERS],
        "SELECT * REPLACE (CAST(affiliate_id AS VARCHAR) AS affiliate_id) FROM latest_players",
    )
    q["null_dangling"] = with_ctes(
        STAGING,
        """
SELECT id,
       CAST(CASE WHEN affiliate_id IN (SELECT id FROM raw_affiliates WHERE id IS NOT NULL)
                 THEN affiliate_id END AS VARCHAR) AS affiliate_id,
       country_code, is_kyc_approved, created_at, updated_at, ver
FROM raw_players""",
    )
    q["first_claim"] = with_ctes(
        STAGING + [LATEST_PLAYERS],
        """
SELECT id, CAST(CASE WHEN affiliate_id IS NOT NULL AND claim_rank = 1 THEN affiliate_id END AS VARCHAR) AS affiliate_id,
       country_code, is_kyc_approved, created_at, updated_at, ver
FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY affiliate_id
        ORDER BY created_at ASC NULLS LAST, id ASC NULLS LAST, country_code ASC NULLS LAST,
                 is_kyc_approved ASC NULLS LAST, updated_at ASC NULLS LAST, ver ASC NULLS LAST) AS claim_rank
      FROM latest_players)""",
    )
    q["fill_from_linked"] = with_ctes(
        STAGING + [LATEST_PLAYERS],
        """
SELECT a.id, a.code, a.origin, COALESCE(l.created_at, a.redeemed_at) AS redeemed_at
FROM raw_affiliates a
LEFT JOIN (SELECT affiliate_id, created_at FROM latest_players
           WHERE affiliate_id IS NOT NULL AND created_at IS NOT NULL) l
  ON a.id = l.affiliate_id""",
    )
    q["kyc_time_gate"] = with_ctes(
        STAGING + [LATEST_PLAYERS],
        """
SELECT t.id, t."timestamp", t.player_id, t.type, CAST(t.amount AS DOUBLE) AS amount
FROM raw_transactions t JOIN latest_players p ON t.player_id IS NOT DISTINCT FROM p.id
WHERE upper(CAST(p.is_kyc_approved AS VARCHAR)) = 'TRUE' AND t."timestamp" >= p.created_at""",
    )
    q["null_safe_join"] = with_ctes(
        STAGING,
        """
SELECT t.id, t."timestamp", CAST(t.player_id AS VARCHAR) AS player_id, t.type, CAST(t.amount AS DOUBLE) AS amount,
       CAST(p.matched_player AS VARCHAR) AS matched_player, p.country_code, p.ver
FROM (SELECT id, "timestamp", CASE WHEN id % 101 <> 0 THEN player_id END AS player_id, type, amount
      FROM raw_transactions) t
JOIN (SELECT matched_player, country_code, ver FROM (
        SELECT *, ROW_NUMBER() OVER (
          PARTITION BY matched_player
          ORDER BY updated_at DESC NULLS FIRST, affiliate_id DESC NULLS LAST, country_code DESC NULLS LAST,
                   is_kyc_approved DESC NULLS LAST, created_at DESC NULLS LAST, ver DESC NULLS LAST) AS rn
        FROM (SELECT CASE WHEN id % 500 <> 7 THEN id END AS matched_player, * FROM raw_players)) WHERE rn = 1) p
  ON t.player_id IS NOT DISTINCT FROM p.matched_player""",
    )
    q["clean_players"] = with_ctes(
        CLEANING, "SELECT * REPLACE (CAST(affiliate_id AS VARCHAR) AS affiliate_id) FROM clean_players"
    )
    q["clean_affiliates"] = with_ctes(CLEANING, "SELECT * FROM clean_affiliates")
    q["clean_transactions"] = with_ctes(
        CLEANING,
        'SELECT id, "timestamp", player_id, type, CAST(amount AS DOUBLE) AS amount FROM clean_transactions',
    )
    q["daily_ledger"] = with_ctes(CLEANING, _ledger("clean_transactions"))
    q["conditional_sum_by_day"] = with_ctes([EVENT_TRANSACTIONS], _ledger("event_transactions"))
    q["distinct_selected_players"] = with_ctes(CLEANING + [CHANNEL_PAIRS], "SELECT * FROM channel_pairs")
    q["segment_totals"] = with_ctes(
        CLEANING + [CHANNEL_PAIRS, COUNTRY_TOTALS],
        "SELECT country_code, deposit_count, CAST(total_deposits AS DOUBLE) AS total_deposits FROM country_totals",
    )
    q["rank_per_player"] = with_ctes(STAGING, RANKED.format(source="raw_transactions"))
    q["top_n_wide"] = with_ctes(CLEANING, _top_three())
    return q


def _top_three() -> str:
    order = 'ORDER BY amount DESC NULLS FIRST, "timestamp" DESC NULLS FIRST'
    cols = ", ".join(
        f"CAST(amounts[{k}] AS DOUBLE) AS {name}_largest_deposit, times[{k}] AS {name}_largest_deposit_date"
        for k, name in enumerate(("first", "second", "third"), 1)
    )
    return f"""
SELECT player_id, {cols}
FROM (SELECT player_id, list(amount {order}) AS amounts, list("timestamp" {order}) AS times
      FROM clean_transactions WHERE type = 'Deposit' GROUP BY player_id)"""


MARTS = [
    CHANNEL_PAIRS,
    COUNTRY_TOTALS,
    """
m_daily AS (
  SELECT DISTINCT player_id, CAST("timestamp" AS DATE) AS transaction_date, CURRENT_TIMESTAMP AS updated_datetime
  FROM clean_transactions WHERE type IN ('Deposit', 'Withdraw')
)""",
    "m_segment AS (SELECT *, CURRENT_TIMESTAMP AS updated_datetime FROM country_totals)",
    """
m_top AS (
  SELECT DISTINCT player_id, CURRENT_TIMESTAMP AS updated_datetime FROM clean_transactions WHERE type = 'Deposit'
)""",
]


def _unique(table: str, source: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, 'unique' AS test_name,
       CAST(COUNT(*) AS BIGINT) AS failures
FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1)"""


def _not_null(table: str, source: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, 'not_null' AS test_name,
       CAST(COUNT(*) AS BIGINT) AS failures
FROM {source} WHERE {column} IS NULL"""


def _quality() -> str:
    parts = [
        _unique("raw_players", "clean_players", "id"),
        _not_null("raw_players", "clean_players", "id"),
        _unique("raw_affiliates", "clean_affiliates", "id"),
        _not_null("raw_affiliates", "clean_affiliates", "id"),
        _unique("raw_transactions", "clean_transactions", "id"),
        _not_null("raw_transactions", "clean_transactions", "id"),
        _not_null("raw_transactions", "clean_transactions", "player_id"),
        _not_null("daily_ledger", "m_daily", "player_id"),
        _not_null("daily_ledger", "m_daily", "transaction_date"),
        _not_null("daily_ledger", "m_daily", "updated_datetime"),
        _not_null("segment_totals", "m_segment", "country_code"),
        _not_null("segment_totals", "m_segment", "deposit_count"),
        _not_null("segment_totals", "m_segment", "total_deposits"),
        _not_null("segment_totals", "m_segment", "updated_datetime"),
        _unique("top_n_wide", "m_top", "player_id"),
        _not_null("top_n_wide", "m_top", "player_id"),
        _not_null("top_n_wide", "m_top", "updated_datetime"),
    ]
    return with_ctes(CLEANING + MARTS, "\nUNION ALL\n".join(parts))


def _invariants() -> str:
    body = """
SELECT 'raw_players' AS table_name, 'affiliate_id' AS column_name, 'one_player_per_affiliate' AS test_name,
       CAST(COUNT(*) AS BIGINT) AS failures
FROM (SELECT affiliate_id FROM clean_players WHERE affiliate_id IS NOT NULL
      GROUP BY affiliate_id HAVING COUNT(*) > 1)
UNION ALL
SELECT 'raw_players', 'affiliate_id', 'affiliate_exists', CAST(COUNT(*) AS BIGINT)
FROM clean_players WHERE affiliate_id IS NOT NULL
  AND affiliate_id NOT IN (SELECT id FROM clean_affiliates WHERE id IS NOT NULL)
UNION ALL
SELECT 'raw_transactions', 'player_id', 'player_approved',
       CAST(COALESCE(SUM(CASE WHEN upper(CAST(p.is_kyc_approved AS VARCHAR)) = 'TRUE' THEN 0 ELSE 1 END), 0) AS BIGINT)
FROM clean_transactions t LEFT JOIN clean_players p ON t.player_id IS NOT DISTINCT FROM p.id
UNION ALL
SELECT 'raw_transactions', 'player_id', 'player_after_creation',
       CAST(COALESCE(SUM(CASE WHEN t."timestamp" >= p.created_at THEN 0 ELSE 1 END), 0) AS BIGINT)
FROM clean_transactions t LEFT JOIN clean_players p ON t.player_id IS NOT DISTINCT FROM p.id
UNION ALL
SELECT 'daily_ledger', 'withdrawals', 'not_positive', CAST(COUNT(*) AS BIGINT)
FROM (SELECT SUM(CASE WHEN type = 'Withdraw' THEN -amount ELSE 0 END) AS w
      FROM clean_transactions WHERE type IN ('Deposit', 'Withdraw')
      GROUP BY player_id, CAST("timestamp" AS DATE)) WHERE w > 0"""
    return with_ctes(CLEANING, body)


SEED = 42
AS_OF = "TIMESTAMP '2025-09-01 00:00:00'"


def _h(table: str, column: str, key: str) -> str:
    """md5 draw: first 15 hex digits of md5('seed|table|column|key')."""
    return (
        f"CAST(('0x' || substr(md5(concat_ws('|', '{SEED}', '{table}', '{column}', CAST({key} AS VARCHAR))), 1, 15))"
        " AS BIGINT)"
    )


def _id_stats(source: str) -> str:
    return f"""SELECT COALESCE(MAX(id), 0) + 1 AS next_id,
       COUNT(DISTINCT id) + COALESCE(MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END), 0) AS distinct_ids
FROM {source}"""


# Generated players (target = 2 × distinct ids, so the count to add equals
# the distinct count).
EXPANDED_PLAYERS = [
    f"""
p_stats AS (
  SELECT COALESCE(MAX(id), 0) + 1 AS start_id,
         COUNT(DISTINCT id) + COALESCE(MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END), 0) AS n_ids,
         COALESCE(MAX(affiliate_id), 0) AS max_aff
  FROM raw_players
)""",
    f"""
p_new AS (
  SELECT id,
         (['DE', 'BR', 'GB', 'US', 'CA'])[{_h('players', 'country_code', 'id')} % 5 + 1] AS country_code,
         {_h('players', 'is_kyc_approved', 'id')} % 2 = 0 AS is_kyc_approved,
         {AS_OF} - to_seconds({_h('players', 'created_at', 'id')} % (365 * 86400 + 1)) AS created_at,
         {_h('players', 'affiliate_id', 'id')} % 2 = 0 AS linked
  FROM (SELECT (SELECT start_id FROM p_stats) + r AS id
        FROM (SELECT unnest(range(0, (SELECT n_ids FROM p_stats))) AS r))
)""",
    """
expanded_players AS (
  SELECT id, affiliate_id, country_code, is_kyc_approved, created_at, updated_at, ver FROM raw_players
  UNION ALL
  SELECT id,
         CAST(CASE WHEN linked THEN (SELECT max_aff FROM p_stats)
              + SUM(CASE WHEN linked THEN 1 ELSE 0 END) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         END AS BIGINT) AS affiliate_id,
         country_code, is_kyc_approved, created_at, created_at AS updated_at, CAST(NULL AS INTEGER) AS ver
  FROM p_new
)""",
]


def _letters(number: str, width: int = 6) -> str:
    return " || ".join(f"chr(CAST(65 + ({number}) // {26**j} % 26 AS INTEGER))" for j in range(width - 1, -1, -1))


EXPANDED_AFFILIATES = [
    """
a_stats AS (
  SELECT COALESCE(MAX(id), 0) + 1 AS start_id,
         COUNT(DISTINCT id) + COALESCE(MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END), 0) AS n_ids
  FROM raw_affiliates
)""",
    """
a_taken AS (
  SELECT * FROM (
    SELECT affiliate_id AS id, created_at AS redeemed_at,
           ROW_NUMBER() OVER (ORDER BY id ASC NULLS LAST, affiliate_id ASC, created_at ASC NULLS LAST) - 1 AS pos
    FROM expanded_players
    WHERE affiliate_id IS NOT NULL AND affiliate_id >= (SELECT start_id FROM a_stats))
  WHERE pos < (SELECT n_ids FROM a_stats)
)""",
    """
a_pad AS (
  SELECT r AS pos,
         COALESCE((SELECT id FROM a_taken WHERE pos = (SELECT COUNT(*) FROM a_taken) - 1),
                  (SELECT start_id FROM a_stats)) + r - (SELECT COUNT(*) FROM a_taken) + 1 AS id,
         CAST(NULL AS TIMESTAMP) AS redeemed_at
  FROM (SELECT unnest(range((SELECT COUNT(*) FROM a_taken), (SELECT n_ids FROM a_stats))) AS r)
)""",
    f"""
a_new AS (
  SELECT id,
         {_letters("(pos * 7919 + " + "CAST(('0x' || substr(md5('42|affiliates|code|offset'), 1, 15)) AS BIGINT) % 308915776) % 308915776")} AS code,
         (['YouTube', 'Discord', 'X', NULL])[{_h('affiliates', 'origin', 'pos')} % 4 + 1] AS origin,
         redeemed_at
  FROM (SELECT pos, id, redeemed_at FROM a_taken UNION ALL SELECT pos, id, redeemed_at FROM a_pad)
)""",
]


EXPANDED_TRANSACTIONS = [
    """
t_stats AS (
  SELECT COALESCE(MAX(id), 0) + 1 AS start_id,
         COUNT(DISTINCT id) + COALESCE(MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END), 0) AS n_ids
  FROM raw_transactions
)""",
    """
xp_latest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY id
      ORDER BY updated_at DESC NULLS FIRST, affiliate_id DESC NULLS LAST, country_code DESC NULLS LAST,
               is_kyc_approved DESC NULLS LAST, created_at DESC NULLS LAST, ver DESC NULLS LAST) AS rn
    FROM expanded_players) WHERE rn = 1
)""",
    """
t_players AS (
  SELECT id AS player, created_at AS created,
         ROW_NUMBER() OVER (ORDER BY id ASC NULLS LAST, created_at ASC NULLS LAST) - 1 AS pidx
  FROM xp_latest WHERE upper(CAST(is_kyc_approved AS VARCHAR)) = 'TRUE'
)""",
    f"""
t_rows AS (
  SELECT k.id, p.player, CAST(floor(epoch(p.created)) AS BIGINT) AS cs,
         CAST(floor(epoch({AS_OF})) AS BIGINT) AS as_of_s,
         (['Deposit', 'Withdraw', 'Bonus'])[{_h('transactions', 'type', 'k.id')} % 3 + 1] AS type
  FROM (SELECT id, {_h('transactions', 'player_id', 'id')} % (SELECT COUNT(*) FROM t_players) AS pidx
        FROM (SELECT (SELECT start_id FROM t_stats) + r AS id
              FROM (SELECT unnest(range(0, (SELECT n_ids FROM t_stats))) AS r))) k
  JOIN t_players p ON k.pidx = p.pidx
)""",
    f"""
t_new AS (
  SELECT id,
         make_timestamp((cs + CASE WHEN gap <= 0 THEN (1 + {_h('transactions', 'timestamp_minutes', 'id')} % 60) * 60
                                   ELSE {_h('transactions', 'timestamp', 'id')} % (gap + 1) END) * 1000000) AS "timestamp",
         player AS player_id, type,
         CAST(CAST(CASE type WHEN 'Deposit' THEN 5000 + {_h('transactions', 'amount', 'id')} % 95001
                             WHEN 'Withdraw' THEN 2500 + {_h('transactions', 'amount', 'id')} % 77501
                             WHEN 'Bonus' THEN 1000 + {_h('transactions', 'amount', 'id')} % 9001 END
                   AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS amount
  FROM (SELECT *, (CASE WHEN cs > as_of_s THEN cs + 30 * 86400 ELSE as_of_s END) - cs AS gap FROM t_rows)
)""",
]


def _cents_text(cents: str, sign: str = "") -> str:
    return f"'{sign}' || CAST(abs({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0')"


COERCE_IDS = """
SELECT key, text,
       CAST(CASE WHEN try_cast(text AS DECIMAL(38,6)) = floor(try_cast(text AS DECIMAL(38,6)))
                 THEN CAST(try_cast(text AS DECIMAL(38,6)) AS BIGINT) END AS VARCHAR) AS id_value
FROM (SELECT o_orderkey AS key,
             CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderkey AS VARCHAR)
                                 WHEN 1 THEN CAST(o_orderkey AS VARCHAR) || '.0'
                                 WHEN 2 THEN CAST(o_orderkey AS VARCHAR) || '.5'
                                 WHEN 3 THEN 'x' || CAST(o_orderkey AS VARCHAR)
                                 WHEN 4 THEN ''
                                 ELSE CAST(o_orderkey + 9007199254740993 AS VARCHAR) END AS text
      FROM orders)"""

COERCE_AMOUNTS = f"""
SELECT key, text, CAST(try_cast(text AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM (SELECT o_orderkey AS key,
             CASE o_orderkey % 5 WHEN 0 THEN {_cents_text('cents')}
                                 WHEN 1 THEN CAST(cents // 100 AS VARCHAR)
                                 WHEN 2 THEN 'abc'
                                 WHEN 3 THEN {_cents_text('cents')} || '5'
                                 ELSE {_cents_text('cents', '-')} END AS text
      FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders))"""

COERCE_TIMESTAMPS = """
SELECT key, text,
       COALESCE(timezone('UTC', try_strptime(text, '%Y-%m-%d %H:%M:%S%z')), try_strptime(text, '%Y-%m-%d %H:%M:%S')) AS parsed
FROM (SELECT o_orderkey AS key,
             CASE o_orderkey % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00:00'
                                 WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '+02:00'
                                 WHEN 2 THEN strftime(ts, '%Y-%m-%d')
                                 WHEN 3 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') || '+00:00'
                                 WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                                 ELSE 'bad' END AS text
      FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS ts FROM orders))"""

CSV_ROUND_TRIP = r"""
SELECT o_orderkey AS key,
       CASE o_orderkey % 5 WHEN 0 THEN ' "' || o_orderpriority || '", ok '
                           WHEN 1 THEN o_orderpriority || chr(10) || 'second line'
                           WHEN 2 THEN 'back\slash ' || o_orderpriority
                           WHEN 3 THEN o_orderpriority END AS text,
       o_orderdate + to_seconds(o_orderkey % 86400) AS "at"
FROM orders"""

# The run reads the declared columns only: the files have no version number.
LATEST_VERSIONS_OF_FILES = LATEST_PLAYERS.replace(", ver DESC NULLS LAST", "")

# The totals as the joins and the HAVING clause say it, on versions of players.
SEGMENT_TOTALS_VERSIONS = """
SELECT chosen.country_code, COUNT(paid.amount) AS deposit_count, CAST(SUM(paid.amount) AS DOUBLE) AS total_deposits
FROM (SELECT DISTINCT p.id, CASE WHEN ver = 1 THEN 'X' || country_code ELSE country_code END AS country_code
      FROM raw_players p JOIN raw_affiliates a ON p.affiliate_id = a.id
      WHERE p.is_kyc_approved AND a.origin = 'Discord') chosen
LEFT JOIN (SELECT t.player_id, t.amount
           FROM raw_transactions t
           JOIN (SELECT DISTINCT p.id, CASE WHEN ver = 1 THEN 'X' || country_code ELSE country_code END AS country_code
                 FROM raw_players p JOIN raw_affiliates a ON p.affiliate_id = a.id
                 WHERE p.is_kyc_approved AND a.origin = 'Discord') c ON t.player_id = c.id
           WHERE t.type = 'Deposit') paid ON paid.player_id = chosen.id
GROUP BY chosen.country_code HAVING COUNT(paid.amount) > 0"""


def _daily_run() -> str:
    """The whole run: raw tables without version numbers, extended to twice
    their ids, cleaned, and each stored table's rows as text."""
    files = [c.replace(", ver DESC NULLS LAST", "") for c in EXPANDED_PLAYERS + EXPANDED_AFFILIATES + EXPANDED_TRANSACTIONS]
    extended = [
        "x_players AS (SELECT * FROM expanded_players)",
        "x_affiliates AS (SELECT id, code, origin, redeemed_at FROM raw_affiliates UNION ALL SELECT * FROM a_new)",
        'x_transactions AS (SELECT id, "timestamp", player_id, type, amount FROM raw_transactions UNION ALL SELECT id, "timestamp", player_id, type, amount FROM t_new)',
    ]
    cleaning = [LATEST_VERSIONS_OF_FILES, *CLEANING[4:], CHANNEL_PAIRS, COUNTRY_TOTALS]
    for t in ("players", "affiliates", "transactions"):
        cleaning = [c.replace(f"raw_{t}", f"x_{t}") for c in cleaning]
    money = "CAST(CAST({0} AS DECIMAL(28,2)) AS VARCHAR)"
    ledger = [money.format(c) for c in ("deposits", "withdrawals", "summary")]
    top = [x for n in ("first", "second", "third") for x in (money.format(f"{n}_largest_deposit"), f"{n}_largest_deposit_date")]
    tables = {
        "raw_players": ("clean_players", ["id", "affiliate_id", "country_code", "is_kyc_approved", "created_at", "updated_at"]),
        "raw_affiliates": ("clean_affiliates", ["id", "code", "origin", "redeemed_at"]),
        "raw_transactions": ("clean_transactions", ["id", '"timestamp"', "player_id", "type", "amount"]),
        "daily_ledger": (f"({_ledger('clean_transactions')})", ["player_id", "transaction_date", *ledger]),
        "segment_totals": ("country_totals", ["country_code", "deposit_count", money.format("total_deposits")]),
        "top_n_wide": (f"({_top_three()})", ["player_id", *top]),
    }
    body = ["SELECT 'tests' AS table_name, '20' AS content"]
    for name, (source, columns) in tables.items():
        text = " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in columns)
        body.append(f"SELECT '{name}', {text} FROM {source}")
    return with_ctes([*STAGING, *files, *extended, *cleaning], "\nUNION ALL\n".join(body))


TEXT_TRUTH = """
SELECT key, text
FROM (SELECT c_custkey AS key,
             (['TRUE', 'true', 'True', 't', 'yes', '1', NULL, 'FALSE'])[c_custkey % 8 + 1] AS text
      FROM customer)
WHERE COALESCE(upper(text) = 'TRUE', false)"""


def oracle_sql() -> dict[str, str]:
    q = _sql()
    q["coerce_ids"] = COERCE_IDS
    q["coerce_amounts"] = COERCE_AMOUNTS
    q["coerce_timestamps"] = COERCE_TIMESTAMPS
    q["text_truth_filter"] = TEXT_TRUTH
    q["next_identifier"] = with_ctes(STAGING, _id_stats("raw_transactions"))
    q["shortfall"] = with_ctes(
        STAGING,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, next_id, distinct_ids, GREATEST(1000 - distinct_ids, 0) AS shortfall "
            f"FROM ({_id_stats('raw_' + name)})"
            for name in ("players", "affiliates", "transactions")
        ),
    )
    q["running_allocation"] = with_ctes(
        STAGING,
        """
SELECT id, ver, CAST(affiliate_id AS VARCHAR) AS affiliate_id,
       CAST(CASE WHEN affiliate_id IS NOT NULL THEN
         (SELECT COALESCE(MAX(id), 0) FROM raw_affiliates)
         + SUM(CASE WHEN affiliate_id IS NOT NULL THEN 1 ELSE 0 END)
             OVER (ORDER BY id, ver ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       END AS VARCHAR) AS allocated
FROM raw_players""",
    )
    q["union_increment"] = with_ctes(
        STAGING + [EVENT_TRANSACTIONS],
        """
SELECT id, "timestamp", player_id, type, CAST(amount AS DOUBLE) AS amount FROM raw_transactions
UNION ALL
SELECT id + (SELECT COALESCE(MAX(id), 0) + 1 FROM raw_transactions), "timestamp", player_id, type,
       CAST(amount AS DOUBLE) FROM event_transactions""",
    )
    q["extend_players"] = with_ctes(
        STAGING + EXPANDED_PLAYERS,
        "SELECT * REPLACE (CAST(affiliate_id AS VARCHAR) AS affiliate_id, CAST(ver AS VARCHAR) AS ver) "
        "FROM expanded_players",
    )
    q["extend_affiliates"] = with_ctes(
        STAGING + EXPANDED_PLAYERS + EXPANDED_AFFILIATES,
        "SELECT id, code, origin, redeemed_at FROM raw_affiliates UNION ALL SELECT * FROM a_new",
    )
    q["extend_transactions"] = with_ctes(
        STAGING + EXPANDED_PLAYERS + EXPANDED_TRANSACTIONS,
        """
SELECT id, "timestamp", player_id, type, CAST(amount AS DOUBLE) AS amount FROM raw_transactions
UNION ALL
SELECT id, "timestamp", player_id, type, CAST(amount AS DOUBLE) FROM t_new""",
    )
    q["csv_round_trip"] = CSV_ROUND_TRIP
    q["parquet_round_trip"] = with_ctes(
        STAGING, 'SELECT id, "timestamp", player_id, type, CAST(amount AS DOUBLE) AS amount FROM raw_transactions'
    )
    q["land_players"] = q["clean_players"]
    q["stored_ledger"] = with_ctes(
        CLEANING,
        f"SELECT *, ROW_NUMBER() OVER (ORDER BY player_id NULLS LAST, transaction_date NULLS LAST) - 1 AS place FROM ({_ledger('clean_transactions')})",
    )
    place = "SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS place FROM totals"
    q["stored_totals"] = f"WITH totals AS ({q['segment_totals']})\n" + place.format(order="total_deposits DESC NULLS FIRST, country_code NULLS LAST")
    q["stored_top_n"] = f"WITH totals AS ({q['top_n_wide']})\n" + place.format(order="player_id NULLS LAST")
    q["segment_totals_versions"] = with_ctes(STAGING, SEGMENT_TOTALS_VERSIONS)
    q["daily_run"] = _daily_run()
    q["check_unique"] = with_ctes(
        STAGING,
        "SELECT id, COUNT(*) AS n_records FROM raw_players WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1",
    )
    cols = ["id", "affiliate_id", "country_code", "is_kyc_approved", "created_at", "updated_at", "ver"]
    q["check_not_null"] = with_ctes(
        STAGING,
        "\nUNION ALL\n".join(_not_null("raw_players", "raw_players", c) for c in cols),
    )
    q["quality_report"] = _quality()
    q["invariant_report"] = _invariants()
    return q
