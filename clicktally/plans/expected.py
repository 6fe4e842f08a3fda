"""The registered queries in SQL, written for DuckDB and independent of the library."""

from __future__ import annotations

EVENTS = """
events_as_clicks AS (
  SELECT ts, event_type AS key_type, CAST(user_id AS VARCHAR) AS offer_id,
         CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) AS offer_advertiser_id,
         props AS destination_subid, value, user_id,
         strftime(ts, '%Y/%m/%d/%H') AS hour,
         strftime(ts, '%Y-%m-%d %H:%M') AS minute
  FROM events
)"""

CLICK_FIELDS = "key_type, offer_id, offer_advertiser_id, destination_subid"


def _from_events(sql: str, *views: str) -> str:
    return "WITH " + ", ".join((EVENTS, *views)) + sql


LOG = """
log AS (
  SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS received,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS paid,
         CAST(l_suppkey AS VARCHAR) AS offer_id, CAST(l_partkey AS VARCHAR) AS affiliate_id,
         l_returnflag AS geo_country, CASE l_linestatus WHEN 'O' THEN '' ELSE l_linestatus END AS subid4,
         l_shipdate AS conversion_time, l_shipdate + to_days(l_linenumber) AS redshift_time
  FROM lineitem
), tagged AS (
  SELECT 'C' AS key_type, conversion_time AS moment, * FROM log
  UNION ALL
  SELECT 'R' AS key_type, redshift_time AS moment, * FROM log
)"""

WINDOW = "BETWEEN TIMESTAMP '1995-06-01 00:00:00' AND TIMESTAMP '2001-06-30 12:00:00'"


def _from_log(sql: str, *views: str) -> str:
    return "WITH " + ", ".join((LOG, *views)) + sql


def _joined(column: str, name: str) -> str:
    return (
        f"coalesce(string_agg(DISTINCT nullif({column}, ''), '#'"
        f" ORDER BY nullif({column}, '')), '') AS {name}"
    )


SETS = ", ".join(
    (
        _joined("affiliate_id", "affiliates"),
        _joined("geo_country", "geo"),
        _joined("subid4", "zones"),
    )
)

MEASURES = """CAST(sum(received) AS DOUBLE) AS received_revenue,
  CAST(sum(paid) AS DOUBLE) AS paid_revenue,
  CAST(sum(received) - sum(paid) AS DOUBLE) AS roi"""

CATCH_UP = f"""
SELECT '2001-06-30 12:00' AS key_dt, key_type, offer_id AS offerid, {MEASURES},
       count(*) AS click_count, {SETS}
FROM tagged WHERE moment {WINDOW}
GROUP BY key_type, offer_id"""


WHOLE_LOG = f"""
SELECT '2100-01-01 00:00' AS key_dt, key_type, offer_id AS offerid, {MEASURES},
       count(*) AS click_count, {SETS}
FROM tagged GROUP BY key_type, offer_id"""


def _window(clock: str) -> str:
    return _from_log(f"""
SELECT CAST(received AS DOUBLE) AS received_revenue, offer_id,
       CAST(paid AS DOUBLE) AS paid_revenue, affiliate_id, geo_country, subid4
FROM log WHERE {clock} {WINDOW}""")


def _tag(key_type: str) -> str:
    return _from_log(f"""
SELECT '{key_type}' AS key_type, '2001-06-30 12:00' AS key_dt, CAST(1 AS BIGINT) AS click_count,
       CAST(received AS DOUBLE) AS received_revenue, offer_id,
       CAST(paid AS DOUBLE) AS paid_revenue, affiliate_id, geo_country, subid4
FROM log""")


def _counts(where: str = "true") -> str:
    return f"""
SELECT strftime(ts, '%Y-%m-%d %H') || ':59' AS key_dt, min(key_type) AS key_type,
       offer_id, offer_advertiser_id,
       CASE WHEN count(*) > 1 THEN 'NA' ELSE min(destination_subid) END AS destination_subid,
       count(*) AS count_of_clicks
FROM events_as_clicks
WHERE length(offer_id || '_' || offer_advertiser_id) > 3 AND {where}
GROUP BY strftime(ts, '%Y-%m-%d %H'), offer_id, offer_advertiser_id"""


CLICK_SNAPSHOTS = f"""
click_snapshots AS (
  SELECT minute AS key_dt, {CLICK_FIELDS}, CAST(floor(value) AS BIGINT) AS count_of_clicks
  FROM events_as_clicks
)"""

CONVERSION_SNAPSHOTS = """
conversion_snapshots AS (
  SELECT minute AS key_dt, key_type, offer_id AS offerid, value AS received_revenue,
         value / 2 AS paid_revenue, value - value / 2 AS roi, user_id AS click_count
  FROM events_as_clicks
)"""


def _latest_clicks(where: str) -> str:
    return f"""
SELECT day AS key_dt, key_type, offer_id, offer_advertiser_id, destination_subid, count_of_clicks
FROM (
  SELECT left(key_dt, 10) AS day, *,
         row_number() OVER (
           PARTITION BY left(key_dt, 10), offer_id
           ORDER BY key_dt DESC, key_type DESC, offer_advertiser_id DESC,
                    destination_subid DESC, count_of_clicks DESC) AS place
  FROM click_snapshots WHERE {where})
WHERE place = 1"""


def _latest_conversions(where: str) -> str:
    return f"""
SELECT day AS key_dt, key_type, offerid, received_revenue, paid_revenue, roi, click_count
FROM (
  SELECT left(key_dt, 10) AS day, *,
         row_number() OVER (
           PARTITION BY left(key_dt, 10), key_type, offerid
           ORDER BY key_dt DESC, received_revenue DESC, paid_revenue DESC, roi DESC,
                    click_count DESC) AS place
  FROM conversion_snapshots WHERE {where})
WHERE place = 1"""


EARLIER = "substr(key_dt, 12, 5) < '16:00'"
LATER = "substr(key_dt, 12, 5) >= '08:00'"

UPSERT_CLICKS = _from_events(
    f""", target AS ({_latest_clicks(EARLIER)}), updates AS ({_latest_clicks(LATER)})
SELECT t.key_dt, t.key_type, t.offer_id, t.offer_advertiser_id, t.destination_subid,
       CASE WHEN u.key_dt IS NULL THEN t.count_of_clicks ELSE u.count_of_clicks END AS count_of_clicks
FROM target t LEFT JOIN updates u
  ON t.key_dt = u.key_dt AND t.key_type = u.key_type AND t.offer_id = u.offer_id
UNION ALL
SELECT * FROM updates u WHERE NOT EXISTS (
  SELECT 1 FROM target t
  WHERE t.key_dt = u.key_dt AND t.key_type = u.key_type AND t.offer_id = u.offer_id)""",
    CLICK_SNAPSHOTS,
)

UPSERT_CONVERSIONS = _from_events(
    f""", target AS ({_latest_conversions(EARLIER)}), updates AS ({_latest_conversions(LATER)})
SELECT * FROM updates
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM updates u
  WHERE t.key_dt = u.key_dt AND t.key_type = u.key_type AND t.offerid = u.offerid)""",
    CONVERSION_SNAPSHOTS,
)

_WHOLE_LINES = "key_type <> 'error'"

EXPECTED: dict[str, str] = {
    "conversion_both_clocks": _from_log(f"""
SELECT strftime(moment, '%Y-%m-%d') || ' 23:59' AS key_dt, key_type, offer_id AS offerid,
       {MEASURES}, count(*) AS click_count, {SETS}
FROM tagged GROUP BY strftime(moment, '%Y-%m-%d'), key_type, offer_id"""),
    "conversion_catch_up": _from_log(CATCH_UP),
    "conversion_window_c": _window("conversion_time"),
    "conversion_window_r": _window("redshift_time"),
    "conversion_tag_c": _tag("C"),
    "conversion_tag_r": _tag("R"),
    "conversion_offer_totals": _from_log("""
SELECT offer_id, count(*) AS click_count, CAST(sum(received) AS DOUBLE) AS received,
       CAST(sum(paid) AS DOUBLE) AS paid
FROM log GROUP BY offer_id"""),
    "conversion_dimension_sets": _from_log(f"""
SELECT offer_id, {SETS} FROM log GROUP BY offer_id"""),
    "conversion_dimension_values": _from_log("""
SELECT DISTINCT offer_id, 'affiliates' AS dimension, affiliate_id AS value
FROM log WHERE affiliate_id <> ''
UNION ALL
SELECT DISTINCT offer_id, 'geo', geo_country FROM log WHERE geo_country <> ''
UNION ALL
SELECT DISTINCT offer_id, 'zones', subid4 FROM log WHERE subid4 <> ''"""),
    "conversion_net": _from_log(f"""
SELECT offer_id, {MEASURES} FROM log GROUP BY offer_id"""),
    "conversion_rejects": _from_log("""
SELECT affiliate_id, geo_country, subid4, conversion_time, redshift_time, 'no offer' AS reason
FROM log WHERE geo_country = 'R'"""),
    "click_parse": _from_events(f"""
SELECT hour, {CLICK_FIELDS} FROM events_as_clicks WHERE {_WHOLE_LINES}"""),
    "click_rejects": _from_events("""
SELECT hour, key_type || chr(9) || '-' || chr(9) || destination_subid AS value,
       'fewer than 7 tokens' AS reason
FROM events_as_clicks WHERE key_type = 'error'"""),
    "click_key_filter": _from_events(f"""
SELECT hour, {CLICK_FIELDS} FROM events_as_clicks
WHERE length(offer_id || '_' || offer_advertiser_id) > 3"""),
    "click_hour_scan": _from_events(f"""
SELECT hour, {CLICK_FIELDS} FROM events_as_clicks WHERE {_WHOLE_LINES}"""),
    "click_day_scan": _from_events("""
SELECT left(hour, 10) AS day, count(*) AS lines FROM events_as_clicks GROUP BY left(hour, 10)"""),
    "click_stream_parity": _from_events("""
SELECT CASE WHEN day(ts) % 2 = 1 THEN 'offer-stream-even/' ELSE 'offer-stream-odd/' END || hour
         AS folder, count(*) AS clicks
FROM events_as_clicks GROUP BY 1"""),
    "click_counts_hour": _from_events(_counts()),
    "click_search": _from_events("""
SELECT offer_id, offer_advertiser_id FROM events_as_clicks
WHERE destination_subid = '{"k": 69}'"""),
    "click_snapshot_today": _from_events(
        " SELECT * FROM click_snapshots WHERE key_dt >= '2024-01-08'", CLICK_SNAPSHOTS
    ),
    "conversion_snapshot_today": _from_events(
        " SELECT * FROM conversion_snapshots WHERE key_dt >= '2024-01-08'",
        CONVERSION_SNAPSHOTS,
    ),
    "latest_click_snapshot": _from_events(_latest_clicks("true"), CLICK_SNAPSHOTS),
    "latest_conversion_snapshot": _from_events(
        _latest_conversions("true"), CONVERSION_SNAPSHOTS
    ),
    "snapshot_rejects": _from_events(
        """
SELECT CASE key_type WHEN 'error' THEN left(key_dt, 10) ELSE key_dt END AS key_dt, key_type,
       CASE WHEN key_type <> 'view' THEN offer_id END AS offer_id, offer_advertiser_id,
       destination_subid, count_of_clicks,
       CASE key_type WHEN 'view' THEN 'no offer' ELSE 'key_dt is not a minute' END AS reason
FROM click_snapshots WHERE key_type IN ('error', 'view')""",
        CLICK_SNAPSHOTS,
    ),
    "upsert_click_consolidate": UPSERT_CLICKS,
    "upsert_conversion_consolidate": UPSERT_CONVERSIONS,
    "consolidate_clicks": UPSERT_CLICKS,
    "consolidate_conversions": UPSERT_CONVERSIONS,
    "consolidate_clicks_bucketed": UPSERT_CLICKS,
    "consolidate_conversions_bucketed": UPSERT_CONVERSIONS,
    "click_snapshot_append": _from_events(_counts(_WHOLE_LINES)),
    "conversion_snapshot_append": _from_log(f"""
SELECT *, CASE WHEN length(affiliates) > 500 THEN 'too long: affiliates' END AS reason
FROM ({WHOLE_LOG})"""),
    "key_violations": _from_events(f"""
SELECT key_dt, key_type, CASE WHEN key_type <> 'error' THEN offer_id END AS offer_id,
       count(*) AS rows,
       CASE WHEN key_type <> 'error' THEN 'repeated key' ELSE 'null in key' END AS reason
FROM ({_counts()})
GROUP BY 1, 2, 3, 5 HAVING count(*) > 1 OR key_type = 'error'"""),
    "width_violations": _from_log(f"""
SELECT key_dt, key_type, offerid, "column", CAST(width AS INTEGER) AS width,
       CAST(length AS INTEGER) AS length
FROM (
  SELECT *, 'affiliates' AS "column", 500 AS width, length(affiliates) AS length FROM named
  UNION ALL
  SELECT *, 'geo', 500, length(geo) FROM named
  UNION ALL
  SELECT *, 'zones', 500, length(zones) FROM named
  UNION ALL
  SELECT *, 'offerid', 30, length(offerid) FROM named)
WHERE length > width""", f"""
named AS (
  SELECT * REPLACE ('an offer with a long name, no. ' || offerid AS offerid) FROM ({WHOLE_LOG}))"""),
    "stream_click_counts": _from_events(_counts(_WHOLE_LINES)),
    "stream_click_rejects": _from_events("""
SELECT key_type || chr(9) || '-' || chr(9) || destination_subid AS value, hour,
       'fewer than 7 tokens' AS reason
FROM events_as_clicks WHERE key_type = 'error'"""),
    "click_statistics_job": _from_events(_counts(f"""{_WHOLE_LINES} AND ts >=
  (SELECT date_trunc('day', max(ts)) FROM events)""")),
    "click_search_job": _from_events(f"""
SELECT offer_id, offer_advertiser_id FROM events_as_clicks
WHERE destination_subid = '{{"k": 69}}' AND {_WHOLE_LINES}
  AND ts >= (SELECT date_trunc('day', max(ts)) FROM events)"""),
    "click_late_hours": _from_events(_counts(_WHOLE_LINES)),
    "click_copy_search": _from_events(f"""
SELECT offer_id, offer_advertiser_id FROM events_as_clicks
WHERE destination_subid = '{{"k": 69}}' AND {_WHOLE_LINES}"""),
    "conversion_refresh": _from_log(WHOLE_LOG),
    "conversion_distinct_counts": _from_log("""
SELECT offer_id, dimension, count(DISTINCT value) AS n_values
FROM (SELECT offer_id, 'affiliates' AS dimension, affiliate_id AS value FROM log
      UNION ALL SELECT offer_id, 'geo', geo_country FROM log
      UNION ALL SELECT offer_id, 'zones', subid4 FROM log)
WHERE value <> '' GROUP BY offer_id, dimension"""),
    "stream_stateful_counts": _from_events(_counts(_WHOLE_LINES)),
    "stream_latest_clicks": UPSERT_CLICKS,
    "stream_latest_conversions": UPSERT_CONVERSIONS,
}
