"""Oracle SQL: tables and windows kept up to date by change batches."""

from oracle import booking_sql, consumers_sql, lockers_sql, routes_sql

# One entry per bit of the key's decimal digits; the first of each eight brings the next character.
_BITS = "flatten([[ord(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR ch IN string_split({0}::VARCHAR, '')])"


def crc32(key: str) -> str:
    """The checksum of a key's decimal digits."""
    bits = _BITS.format(key)
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}),"
        " lambda crc, e: xor(xor(crc, e) >> 1, 3988292384 * (xor(crc, e) & 1))), 4294967295)"
    )


QUERIES = {
    "merge_touched_buckets": f"""
WITH newest AS (SELECT user_id, max((ts, event_id)) AS last FROM events GROUP BY 1),
touched AS (
  SELECT count(DISTINCT {crc32('user_id')} % 64) AS buckets FROM
    (SELECT DISTINCT user_id FROM events WHERE user_id % 16 = 3 AND event_id % 3 <> 0))
SELECT e.user_id, e.ts, e.event_id, e.event_type, e.value, CAST(buckets AS INTEGER) AS buckets_rewritten
FROM newest JOIN events e ON e.user_id = newest.user_id AND (e.ts, e.event_id) = last, touched
WHERE e.event_type <> 'error'""",
    "ecommerce_orders_from_partials": booking_sql.QUERIES["ecommerce_orders_per_day"],
    "box_orders_from_partials": booking_sql.QUERIES["box_orders_per_day"],
    "signups_from_partials": consumers_sql.QUERIES["signups_over_time_clamped"],
    "consumer_stats_from_partials": consumers_sql.QUERIES["consumer_order_stats"],
    "backlog_from_stored_log": lockers_sql.QUERIES["locker_backlog"],
    "due_vs_scanned_from_stored_log": routes_sql.QUERIES["due_vs_scanned"],
    "distinct_buyers_per_week": """
SELECT c_nationkey AS nation, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(DISTINCT o_custkey) AS buyers
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""",
    "events_within_minutes": """
SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id, a.event_type AS first_type, b.event_type AS second_type,
       date_diff('second', date_trunc('second', a.ts), date_trunc('second', b.ts)) AS seconds
FROM events a JOIN events b ON a.user_id = b.user_id AND (a.ts, a.event_id) < (b.ts, b.event_id)
WHERE b.ts <= a.ts + INTERVAL 15 MINUTE""",
    "event_props_columns": """
WITH given AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN substr(props, 1, 4) ELSE props END AS props FROM events),
parsed AS (SELECT event_id, CASE WHEN json_valid(props) THEN props::JSON END AS document FROM given)
SELECT event_id, CAST(document ->> '$.k' AS BIGINT) AS k, document ->> '$.k' AS k_text,
       document ->> '$.none.of' AS missing, document IS NULL AS malformed FROM parsed""",
}
