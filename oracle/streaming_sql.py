"""Oracle SQL: what the drained streams must show."""

QUERIES = {
    "events_per_hour_stream": """
SELECT date_trunc('hour', ts) AS hour, event_type AS kind, count(*) AS rows FROM events GROUP BY 1, 2""",
    "latest_event_stream": """
SELECT user_id, ts, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
}
