"""The registered queries as SQL, in the join form wherever the Spark side uses one pass."""

from __future__ import annotations

from adpulse.model import KEYS
from adpulse.registry.dates import DAY, FIRST, GRACE_DAY, LAST

K = ", ".join(KEYS)

EVENTS = """
ev AS (
  SELECT c.c_mktsegment AS BRAND,
         'w' || CAST(e.user_id % 2 AS VARCHAR) AS WALL_ID,
         'g0' AS WALLGROUP_ID,
         CASE WHEN e.k % 3 <> 0 THEN 'c' || CAST(e.k % 3 AS VARCHAR) END AS CAMPAIGN_ID,
         CASE e.event_type WHEN 'view' THEN 'product-impression'
                           WHEN 'click' THEN 'product-click'
                           WHEN 'signup' THEN 'post-impression'
                           WHEN 'purchase' THEN 'post-click'
                           WHEN 'error' THEN 'wall-impression' END AS EVENT_TYPE,
         e.event_id, e.ts, CAST(e.ts AS DATE) AS event_date,
         strftime(e.ts, '%d') AS DAY,
         CAST(e.landed AS DATE) AS landing_date,
         CAST(hour(e.landed) AS INTEGER) AS landing_hour
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
               ts + to_minutes(event_id % 60) AS landed
        FROM events) e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
)"""


def _counts(kind: str, name: str, where: str = "TRUE") -> str:
    return f"""
SELECT {K}, EVENT_TYPE, event_date, count(*) AS {name}
FROM ev WHERE EVENT_TYPE = '{kind}' AND {where}
GROUP BY {K}, EVENT_TYPE, event_date"""


def _joined(family: str, where: str = "TRUE") -> str:
    """Count both sides, join them on keys and day, sum the halves again."""
    return f"""
imp AS ({_counts(family + "-impression", "impressions", where)}),
clk AS ({_counts(family + "-click", "clicks", where)}),
pairs AS (
  SELECT {K}, event_date, imp.impressions, clk.clicks,
         imp.EVENT_TYPE AS impression_type, clk.EVENT_TYPE AS click_type
  FROM imp FULL JOIN clk USING ({K}, event_date)
),
rates AS (
  SELECT {K}, event_date,
         CAST(sum(impressions) AS BIGINT) AS impressions,
         CAST(sum(clicks) AS BIGINT) AS clicks,
         CAST(sum(impressions) AS BIGINT) / CAST(sum(clicks) AS BIGINT) AS impressions_per_click
  FROM pairs GROUP BY {K}, event_date
)"""


def _rate(family: str, where: str = "TRUE") -> str:
    return f"WITH {EVENTS}, {_joined(family, where)} SELECT * FROM rates"


def _one_pass_rate(family: str) -> str:
    """The other way round for the queries that join on the Spark side."""
    return f"""
WITH {EVENTS}
SELECT {K}, event_date, impressions, clicks, impressions / clicks AS impressions_per_click
FROM (
  SELECT {K}, event_date,
         nullif(count(*) FILTER (WHERE EVENT_TYPE = '{family}-impression'), 0) AS impressions,
         nullif(count(*) FILTER (WHERE EVENT_TYPE = '{family}-click'), 0) AS clicks
  FROM ev WHERE EVENT_TYPE IN ('{family}-impression', '{family}-click')
  GROUP BY {K}, event_date
)"""


def _rate_change(family: str) -> str:
    return f"""
WITH {EVENTS}, {_joined(family)},
prev AS (SELECT {K}, impressions_per_click AS p FROM rates
         WHERE event_date = DATE '{DAY}' - INTERVAL 1 DAY),
cur AS (SELECT {K}, impressions_per_click AS c FROM rates WHERE event_date = DATE '{DAY}')
SELECT {K}, sum(p) AS previous, sum(c) AS "current",
       100 * (sum(c) - sum(p)) / sum(p) AS pct_change, DATE '{DAY}' AS event_date
FROM prev FULL JOIN cur USING ({K})
GROUP BY {K}"""


def _rate_changes(family: str) -> str:
    return f"""
WITH {EVENTS}, {_joined(family)},
prev AS (SELECT {K}, CAST(event_date + INTERVAL 1 DAY AS DATE) AS event_date,
                impressions_per_click AS p FROM rates),
cur AS (SELECT {K}, event_date, impressions_per_click AS c FROM rates)
SELECT {K}, event_date, sum(p) AS previous, sum(c) AS "current",
       100 * (sum(c) - sum(p)) / sum(p) AS pct_change
FROM prev FULL JOIN cur USING ({K}, event_date)
WHERE event_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
GROUP BY {K}, event_date"""


WALL = "wall-impression"
WALL_PAIRS = f"""
WITH {EVENTS},
daily AS ({_counts(WALL, "impressions")}),
prev AS (SELECT {K}, EVENT_TYPE AS previous_type, impressions AS p,
                CAST(event_date + INTERVAL 1 DAY AS DATE) AS event_date FROM daily),
cur AS (SELECT {K}, EVENT_TYPE, impressions AS c, event_date FROM daily),
compared AS (
  SELECT {K}, EVENT_TYPE, event_date, CAST(sum(p) AS BIGINT) AS previous,
         CAST(sum(c) AS BIGINT) AS "current",
         100 * (CAST(sum(c) AS BIGINT) - CAST(sum(p) AS BIGINT)) / CAST(sum(p) AS BIGINT)
           AS pct_change
  FROM prev FULL JOIN cur USING ({K}, event_date)
  WHERE EVENT_TYPE = previous_type
  GROUP BY {K}, EVENT_TYPE, event_date
)"""
WALL_CHANGE = f"""{WALL_PAIRS}
SELECT {K}, EVENT_TYPE, previous, "current", pct_change, event_date
FROM compared WHERE event_date = DATE '{DAY}'"""
WALL_COUNTS = f"WITH {EVENTS} {_counts(WALL, 'impressions')}"


def _final(columns: str, table: str, types: str) -> str:
    """Leave out the days still open when the last event has been seen."""
    return f"""
SELECT {columns} FROM {table}
WHERE event_date < (SELECT CAST(max(ts) - INTERVAL 60 MINUTE AS DATE) FROM ev
                    WHERE EVENT_TYPE IN ({types}))"""


ORACLES: dict[str, str] = {
    "scan_landing_day": f"""
WITH {EVENTS}
SELECT landing_date, count(*) AS events, count(DISTINCT landing_hour) AS hours
FROM ev GROUP BY landing_date""",
    "scan_with_grace": f"""
WITH {EVENTS}
SELECT EVENT_TYPE, event_date, count(*) AS events FROM ev
WHERE event_date = DATE '{GRACE_DAY}'
  AND (landing_date = DATE '{GRACE_DAY}'
       OR (landing_date = DATE '{GRACE_DAY}' - INTERVAL 1 DAY AND landing_hour = 23)
       OR (landing_date = DATE '{GRACE_DAY}' + INTERVAL 1 DAY AND landing_hour = 0))
GROUP BY EVENT_TYPE, event_date""",
    "scan_days_with_grace": f"""
WITH {EVENTS}
SELECT {K}, EVENT_TYPE, event_date, count(*) AS events FROM ev
WHERE landing_date = event_date
   OR (landing_date = event_date - INTERVAL 1 DAY AND landing_hour = 23)
   OR (landing_date = event_date + INTERVAL 1 DAY AND landing_hour = 0)
GROUP BY {K}, EVENT_TYPE, event_date""",
    "scan_landing_table": f"""
WITH {EVENTS}
SELECT EVENT_TYPE, landing_date, landing_hour, count(*) AS events FROM ev
WHERE event_date = DATE '{GRACE_DAY}'
  AND (landing_date = DATE '{GRACE_DAY}'
       OR (landing_date = DATE '{GRACE_DAY}' - INTERVAL 1 DAY AND landing_hour = 23)
       OR (landing_date = DATE '{GRACE_DAY}' + INTERVAL 1 DAY AND landing_hour = 0))
GROUP BY EVENT_TYPE, landing_date, landing_hour""",
    "scan_late_hours": f"""
WITH {EVENTS}
SELECT landing_date, landing_hour, count(*) AS events FROM ev
WHERE event_id % 7 = 0 AND landing_hour = 13 GROUP BY landing_date, landing_hour""",
    "count_late_hour": f"""
WITH {EVENTS}
SELECT {K}, EVENT_TYPE, event_date, count(*) AS impressions FROM ev
WHERE landing_date = event_date
   OR (landing_date = event_date - INTERVAL 1 DAY AND landing_hour = 23)
   OR (landing_date = event_date + INTERVAL 1 DAY AND landing_hour = 0)
GROUP BY {K}, EVENT_TYPE, event_date""",
    "json_schema_drift": f"""
WITH {EVENTS},
lines AS (SELECT *, event_id % 97 = 0 AS cut FROM ev),
seen AS (
  SELECT landing_date, landing_hour, 'DEVICE' AS field, 'OBJECT' AS seen, 'unknown' AS problem
  FROM lines WHERE NOT cut AND event_id % 50 = 0
  UNION ALL
  SELECT landing_date, landing_hour, 'DAY', 'BIGINT', 'type'
  FROM lines WHERE NOT cut AND event_id % 71 = 0
  UNION ALL
  SELECT landing_date, landing_hour, 'CAMPAIGN_ID', NULL, 'missing'
  FROM lines WHERE NOT cut AND (event_id % 89 = 0 OR CAMPAIGN_ID IS NULL)
  UNION ALL
  SELECT landing_date, landing_hour, NULL, NULL, 'unparsable' FROM lines WHERE cut
)
SELECT *, count(*) AS lines FROM seen GROUP BY ALL""",
    "json_schema_contract": f"""
WITH {EVENTS}
SELECT CASE WHEN NOT cut THEN BRAND END AS BRAND,
       CASE WHEN NOT cut THEN EVENT_TYPE END AS EVENT_TYPE,
       count(*) AS events, count(CAMPAIGN_ID) FILTER (WHERE NOT cut) AS with_campaign,
       count(ts) FILTER (WHERE NOT cut) AS with_time, count(*) FILTER (WHERE cut) AS malformed
FROM (SELECT *, event_id % 97 = 0 AS cut FROM ev) GROUP BY 1, 2""",
    "union_by_name_missing": f"""
WITH {EVENTS}, bag AS (
  SELECT BRAND, WALL_ID, WALLGROUP_ID, CAMPAIGN_ID, EVENT_TYPE
  FROM ev WHERE EVENT_TYPE LIKE 'product-%'
  UNION ALL BY NAME
  SELECT BRAND, WALL_ID, WALLGROUP_ID, EVENT_TYPE FROM ev WHERE EVENT_TYPE LIKE 'post-%'
  UNION ALL BY NAME
  SELECT BRAND, WALL_ID, CAMPAIGN_ID, EVENT_TYPE FROM ev WHERE EVENT_TYPE LIKE 'wall-%'
)
SELECT {K}, EVENT_TYPE, count(*) AS events FROM bag GROUP BY {K}, EVENT_TYPE""",
    "event_time_quality": f"""
WITH {EVENTS}
SELECT EVENT_TYPE, count(*) AS events,
       count(*) FILTER (WHERE event_id % 83 = 0 AND event_id % 89 <> 0) AS missing_time,
       count(*) FILTER (WHERE event_id % 89 = 0) AS malformed_time,
       count(*) FILTER (WHERE BRAND IS NULL OR WALL_ID IS NULL OR WALLGROUP_ID IS NULL
                           OR CAMPAIGN_ID IS NULL) AS null_key
FROM ev GROUP BY EVENT_TYPE""",
    "filter_type_day": f"""
WITH {EVENTS}
SELECT event_id, {K}, EVENT_TYPE, event_date FROM ev
WHERE EVENT_TYPE = 'product-impression' AND event_date = DATE '{DAY}'""",
    "filter_type_day_label": f"""
WITH {EVENTS}
SELECT event_id, {K}, EVENT_TYPE, DAY FROM ev
WHERE EVENT_TYPE = 'product-impression' AND DAY = '{DAY[-2:]}'""",
    "count_wall_daily": WALL_COUNTS,
    "window_wall_batch": f"""
WITH {EVENTS}
SELECT CAST(date_trunc('day', ts) AS DATE) AS event_date, {K}, EVENT_TYPE,
       count(*) AS impressions
FROM ev WHERE EVENT_TYPE = '{WALL}' GROUP BY ALL""",
    "count_product_impressions": f"WITH {EVENTS} {_counts('product-impression', 'impressions')}",
    "count_product_clicks": f"WITH {EVENTS} {_counts('product-click', 'clicks')}",
    "count_post_impressions": f"WITH {EVENTS} {_counts('post-impression', 'impressions')}",
    "count_post_clicks": f"WITH {EVENTS} {_counts('post-click', 'clicks')}",
    "count_pairs_join": f"WITH {EVENTS}, {_joined('product')} SELECT * FROM pairs",
    "rate_product": _rate("product"),
    "rate_post": _rate("post"),
    "rate_product_day": _rate("product", f"event_date = DATE '{DAY}'"),
    "rate_post_day": _rate("post", f"event_date = DATE '{DAY}'"),
    "rate_product_join": _one_pass_rate("product"),
    "rate_post_join": _one_pass_rate("post"),
    "rate_product_sql": f"""
SELECT {K}, event_date, impressions_per_click FROM ({_one_pass_rate("product")})""",
    "rate_product_from_counts": _rate("product"),
    "rate_post_from_counts": _rate("post"),
    "dod_rate_product": _rate_change("product"),
    "dod_rate_post": _rate_change("post"),
    "dod_rate_product_days": _rate_changes("product"),
    "dod_rate_post_days": _rate_changes("post"),
    "dod_rate_join": f"""
WITH {EVENTS},
one_pass AS (
  SELECT {K},
    nullif(count(*) FILTER (WHERE EVENT_TYPE = 'product-impression'
                            AND event_date = DATE '{DAY}' - INTERVAL 1 DAY), 0)
    / nullif(count(*) FILTER (WHERE EVENT_TYPE = 'product-click'
                              AND event_date = DATE '{DAY}' - INTERVAL 1 DAY), 0) AS previous,
    nullif(count(*) FILTER (WHERE EVENT_TYPE = 'product-impression'
                            AND event_date = DATE '{DAY}'), 0)
    / nullif(count(*) FILTER (WHERE EVENT_TYPE = 'product-click'
                              AND event_date = DATE '{DAY}'), 0) AS "current"
  FROM ev WHERE EVENT_TYPE LIKE 'product-%'
    AND event_date BETWEEN DATE '{DAY}' - INTERVAL 1 DAY AND DATE '{DAY}'
  GROUP BY {K}
)
SELECT *, 100 * ("current" - previous) / previous AS pct_change FROM one_pass""",
    "dod_wall": WALL_CHANGE,
    "dod_wall_days": f"""{WALL_PAIRS}
SELECT {K}, EVENT_TYPE, event_date, previous, "current", pct_change
FROM compared WHERE event_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'""",
    "dod_wall_join": f"""
SELECT {K}, EVENT_TYPE, previous, "current" FROM ({WALL_CHANGE})""",
    "sink_daily_idempotent": WALL_COUNTS,
    "sink_two_types": f"""
WITH {EVENTS} {_counts(WALL, 'impressions')}
UNION ALL {_counts('product-click', 'impressions')}""",
    "sink_replace_all": f"WITH {EVENTS} {_counts('post-impression', 'impressions')}",
    "catalog_replace": f"""
WITH {EVENTS} {_counts('post-impression', 'impressions')}
UNION ALL {_counts(WALL, 'impressions')}""",
    "sink_append": f"""
WITH {EVENTS} {_counts('product-impression', 'impressions')}
UNION ALL {_counts('post-impression', 'impressions')}""",
    "insight_rate_product": _rate_change("product"),
    "insight_count_wall": WALL_CHANGE,
    "insight_rate_by_key": _rate_change("product"),
    "insight_count_by_key": WALL_CHANGE,
    "stream_wall_daily": WALL_COUNTS,
    "stream_wall_final": f"""
WITH {EVENTS}, daily AS ({_counts(WALL, "impressions")})
{_final(f"event_date, {K}, EVENT_TYPE, impressions", "daily", f"'{WALL}'")}""",
    "stream_wall_upsert": WALL_COUNTS,
    "stream_wall_late": f"""
WITH {EVENTS},
hour_wait AS ({_counts(WALL, "impressions", f"landing_date > DATE '{FIRST}'")}),
no_limit AS ({_counts(WALL, "impressions")})
SELECT *, 'hour' AS waits FROM hour_wait
UNION ALL
SELECT *, 'forever' AS waits FROM no_limit""",
    "stream_wall_dropped": f"""
WITH {EVENTS} {_counts(WALL, "dropped", f"landing_date <= DATE '{FIRST}'")}""",
    "stream_counts": f"""
WITH {EVENTS}
SELECT event_date, {K}, EVENT_TYPE, count(*) AS events
FROM ev WHERE EVENT_TYPE <> '{WALL}' GROUP BY event_date, {K}, EVENT_TYPE""",
    "stream_rate_latest": _rate("product"),
    "stream_rate_post": _rate("post"),
    "stream_rate_join": f"""
WITH {EVENTS}, {_joined("product")}
{_final(f"{K}, event_date, impressions, clicks, impressions_per_click", "rates",
        "'product-impression', 'product-click'")}""",
}
