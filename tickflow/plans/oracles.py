"""The same queries in SQL, for an independent engine on the same tables."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# epoch_ms would round up; milliseconds are cut off here.
MILLIS = "epoch_us(ts) // 1000"

SUPPLIER_DAYS = """
SELECT l_suppkey AS market,
       date_trunc('day', l_shipdate) AS window_start,
       date_trunc('day', l_shipdate) + INTERVAL 1 DAY AS window_end,
       floor(sum(l_extendedprice * l_quantity)) AS one_m_trade_volume
FROM lineitem GROUP BY ALL
"""


def event_windows(unit: str, market: str = "user_id", name: str = "event_type") -> str:
    return f"""
SELECT {market} AS market, {name} AS name,
       date_trunc('{unit}', ts) AS window_start,
       date_trunc('{unit}', ts) + INTERVAL 1 {unit} AS window_end,
       floor(sum(value * {K})) AS one_m_trade_volume
FROM events GROUP BY ALL
"""


def ranked(rows: str, ties: str = "market, name NULLS FIRST") -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY window_start, window_end
       ORDER BY one_m_trade_volume DESC NULLS LAST, {ties}) AS row_num
FROM ({rows})
"""


def top5(rows: str, ties: str = "market, name NULLS FIRST") -> str:
    return f"SELECT * FROM ({ranked(rows, ties)}) WHERE row_num <= 5"


def published(rows: str) -> str:
    return f"""
SELECT name, market, window_start, window_end, one_m_trade_volume, row_num,
       strftime(window_start, '%Y') AS year, strftime(window_start, '%m') AS month,
       strftime(window_start, '%d') AS day
FROM ({rows})
"""


EVENT_RESULT = published(f"""
SELECT * REPLACE (CAST(market AS VARCHAR) AS market) FROM ({top5(event_windows('minute'))})
""")

LAST_DAY = f"""
SELECT * FROM ({EVENT_RESULT})
WHERE date_trunc('day', window_start) = (SELECT date_trunc('day', max(ts)) FROM events)
"""

QUOTES = f"""
SELECT event_id, 'KRW-' || user_id AS market, event_type AS name, value AS trade_price,
       CAST({K} AS DOUBLE) AS trade_volume, {MILLIS} AS "timestamp"
FROM events
"""

URGENT = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"

BUILDERS = "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'"


def closed(unit: str) -> str:
    """The published windows whose end the watermark, one second behind, has passed."""
    rows = published(top5(event_windows(unit, market="'KRW-' || user_id")))
    return f"""
SELECT * FROM ({rows})
WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 SECOND FROM events)
"""


COMMON_KEYS = f"""
SELECT c_custkey AS market, c_name AS name FROM customer
WHERE EXISTS (SELECT 1 FROM ({URGENT}) WHERE o_custkey = c_custkey)
"""

ATTACH_NAME = f"""
SELECT o_orderkey, o_custkey, o_totalprice, c_name AS name
FROM orders LEFT JOIN ({BUILDERS}) ON o_custkey = c_custkey
"""

JOIN_QUOTES = """
SELECT l_suppkey AS market, l_orderkey, l_linenumber, l_extendedprice AS trade_price,
       s_name AS name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0
"""

MISSING_QUOTES = f"""
SELECT c_custkey AS market, c_name AS name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM ({URGENT}) WHERE o_custkey = c_custkey)
"""

DAY_RESULT = published(top5(event_windows("day", market="'KRW-' || user_id")))


def seoul_days(market: str) -> str:
    """Windows of the Seoul clock, nine hours ahead of the tables' clock."""
    return f"""
SELECT {market} AS market, event_type AS name,
       date_trunc('day', ts + INTERVAL 9 HOUR) AS window_start,
       date_trunc('day', ts + INTERVAL 9 HOUR) + INTERVAL 1 DAY AS window_end,
       floor(sum(value * {K})) AS one_m_trade_volume
FROM events GROUP BY ALL
"""


SEOUL_RESULT = published(top5(seoul_days("'KRW-' || user_id")))


def named_days(name: str) -> str:
    return f"""
SELECT 'KRW-' || user_id AS market, {name} AS name,
       date_trunc('day', ts) AS window_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       floor(sum(value * {K})) AS one_m_trade_volume
FROM events LEFT JOIN ({BUILDERS}) ON user_id = c_custkey GROUP BY ALL
"""


def odd_quotes(join: str) -> str:
    return f"""
SELECT market, trade_volume, c_name AS name, 'n/a' AS high_price, event_id
FROM ({QUOTES}) {join} ({BUILDERS}) ON market = 'KRW-' || c_custkey
"""


LAST_BY_KEY = """
SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


ORACLES: dict[str, str] = {
    "decode_events": f"SELECT event_id, {K} AS k FROM events",
    "decode_lenient": f"""
        SELECT event_id, market,
               CASE WHEN name <> 'click' THEN trade_price END AS trade_price,
               trade_volume, "timestamp", CAST(NULL AS VARCHAR) AS name
        FROM ({QUOTES}) WHERE name NOT IN ('error', 'signup')""",
    "decode_accounting": f"""
        WITH messages AS (
          SELECT name, name NOT IN ('error', 'signup') AS good, event_id % 4 AS fourth FROM ({QUOTES})
        )
        SELECT unnest(['messages', 'decoded', 'skipped', 'undated', 'unreadable_trade_price',
                       'unreadable_trade_volume', 'unreadable_timestamp']) AS counted,
               unnest([count(*), count(*) FILTER (good), count(*) FILTER (NOT good),
                       count(*) FILTER (good AND fourth <> 2), count(*) FILTER (name = 'click'),
                       0, count(*) FILTER (good AND fourth = 0)])::BIGINT AS n
        FROM messages""",
    "undated_ticks": f"""
        SELECT market, name, trade_price, trade_volume
        FROM ({QUOTES}) WHERE name IN ('error', 'click')""",
    "listing_rows": """
        SELECT p_partkey, position, prefix || p_partkey AS market,
               p_name AS korean_name, p_brand AS english_name
        FROM part, (VALUES (0, 'KRW-'), (1, 'BTC-')) AS entries(position, prefix)""",
    "first_quotes": f"""
        SELECT event_id, market, trade_price, trade_volume, "timestamp" FROM ({QUOTES})""",
    "encode_roundtrip": "SELECT event_id, user_id, event_type, value, props FROM events",
    "publish_messages": f"""
        SELECT market, name, trade_price, trade_volume, "timestamp" FROM ({QUOTES})""",
    "event_time": "SELECT event_id, date_trunc('millisecond', ts) AS event_time FROM events",
    "tick_notional": """
        SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS notional,
               floor(l_extendedprice * l_quantity) AS whole_notional
        FROM lineitem""",
    "partition_keys": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year,
               strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day
        FROM orders""",
    "prefix_filter": """
        SELECT p_name AS market, p_brand AS name, p_partkey
        FROM part WHERE starts_with(p_name, 'red')""",
    "common_keys": COMMON_KEYS,
    "common_keys_split": f"""
        SELECT o_custkey AS market, o_orderkey FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM ({BUILDERS}))""",
    "attach_name": ATTACH_NAME,
    "attach_name_split": ATTACH_NAME,
    "join_quotes": JOIN_QUOTES,
    "join_quotes_split": JOIN_QUOTES,
    "missing_quotes": MISSING_QUOTES,
    "missing_quotes_split": MISSING_QUOTES,
    "last_by_key": LAST_BY_KEY,
    "notional_minute": event_windows("minute"),
    "notional_day": SUPPLIER_DAYS,
    # Products from 2**10 up are whole multiples of 2**-43: exact as whole numbers of 2**-50.
    "notional_exact_day": """
        SELECT l_suppkey AS market, date_trunc('day', l_shipdate) AS window_start,
               date_trunc('day', l_shipdate) + INTERVAL 1 DAY AS window_end,
               (sum((l_extendedprice * l_quantity * 1125899906842624.0::DOUBLE)::HUGEINT)
                // 1125899906842624::HUGEINT)::DOUBLE AS one_m_trade_volume
        FROM lineitem GROUP BY ALL""",
    "rank_all_day": ranked(SUPPLIER_DAYS, "market"),
    "top5_minute": top5(event_windows("minute")),
    "top5_day": top5(SUPPLIER_DAYS, "market"),
    "top5_day_events": top5(event_windows("day")),
    "polled_top5_minute": published(top5(f"""
        SELECT 'KRW-' || user_id AS market, c_name AS name,
               date_trunc('minute', ts) AS window_start,
               date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
               floor(sum(value * {K})) AS one_m_trade_volume
        FROM events JOIN ({BUILDERS}) ON user_id = c_custkey GROUP BY ALL""")),
    "pushed_top5_minute": published(top5(f"""
        SELECT 'KRW-' || user_id AS market, c_name AS name,
               date_trunc('minute', ts) AS window_start,
               date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
               floor(sum(value * {K})) AS one_m_trade_volume
        FROM events LEFT JOIN ({BUILDERS}) ON user_id = c_custkey GROUP BY ALL""")),
    "sink_roundtrip": EVENT_RESULT,
    "sink_rewrite": EVENT_RESULT,
    "day_scan": LAST_DAY,
    "newest_window": f"""
        SELECT * FROM ({EVENT_RESULT})
        WHERE window_end = (SELECT date_trunc('minute', max(ts)) + INTERVAL 1 MINUTE FROM events)""",
    "newest_file": f"""
        SELECT name, market, window_start, window_end, one_m_trade_volume, row_num
        FROM ({LAST_DAY})""",
    "success_markers": """
        SELECT DISTINCT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
               strftime(ts, '%d') AS day
        FROM events""",
    "stream_top5_day": closed("day"),
    "stream_top5_chained_day": closed("day"),
    "stream_open_window_day": f"""
        SELECT * FROM ({event_windows("day", market="'KRW-' || user_id")})
        WHERE window_end > (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 SECOND FROM events)""",
    "stream_late_ticks": f"""
        WITH landed AS (
          SELECT *, event_id % 4 AS landing, date_trunc('millisecond', ts) AS event_time,
                 date_trunc('day', ts) + INTERVAL 1 DAY AS window_end
          FROM events
        ), landings AS (
          SELECT landing, max(event_time) AS newest FROM landed GROUP BY landing
        ), watermarks AS (
          SELECT l.landing, max(before.newest) - INTERVAL 1 SECOND AS watermark
          FROM landings l JOIN landings before ON before.landing < l.landing GROUP BY l.landing
        )
        SELECT 'KRW-' || user_id AS market, event_type AS name, value AS trade_price,
               CAST({K} AS DOUBLE) AS trade_volume, landing AS micro_batch, event_time,
               window_end, watermark
        FROM landed JOIN watermarks USING (landing) WHERE window_end <= watermark""",
    "stream_from_latest_day": closed("day").replace(
        "FROM events", "FROM (SELECT * FROM events WHERE event_id % 2 = 1)"
    ),
    "stream_resumed_top5_minute": closed("minute"),
    "polled_unchanged": odd_quotes("JOIN"),
    "pushed_unchanged": odd_quotes("LEFT JOIN"),
    "newest_listing": """
        SELECT 'KRW-' || p_partkey AS market, p_name AS name FROM part
        WHERE p_brand = (SELECT min(p_brand) FROM part)""",
    "polled_top5_day": published(top5(named_days("'KRW-' || user_id"))),
    "pushed_top5_day": published(top5(named_days("c_name"))),
    "top5_day_seoul": SEOUL_RESULT,
    "sink_top5_day": DAY_RESULT,
    "sink_compacted": DAY_RESULT,
    "newest_window_day": f"""
        SELECT * FROM ({DAY_RESULT})
        WHERE window_end = (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY FROM events)""",
    "stream_top5_day_seoul": f"""
        SELECT * FROM ({SEOUL_RESULT})
        WHERE window_end <= (SELECT max(ts) + INTERVAL 9 HOUR - INTERVAL 1 SECOND FROM events)""",
    "stream_pushed_top5_day": f"""
        SELECT * FROM ({published(top5(named_days("c_name")))})
        WHERE window_end <= (SELECT max(ts) - INTERVAL 1 SECOND FROM events)""",
    "stream_last_by_key": LAST_BY_KEY,
    "stream_publish_mixed": f"""
        SELECT market, name, trade_price, trade_volume, "timestamp" FROM ({QUOTES})""",
}
