"""Oracle SQL: operators on the driver's own tables."""

_SECONDS = "(hour({0}) * 3600 + minute({0}) * 60 + CAST(floor(second({0})) AS BIGINT))"


def _local(ts: str, zone: str) -> str:
    return f"timezone('{zone}', timezone('UTC', {ts}))"


_COUNTRY_LOCAL = f"""CASE country WHEN 'SE' THEN {_local('ts', 'Europe/Stockholm')}
  WHEN 'NL' THEN {_local('ts', 'Europe/Amsterdam')} WHEN 'FI' THEN {_local('ts', 'Europe/Helsinki')}
  WHEN 'DK' THEN {_local('ts', 'Europe/Copenhagen')} WHEN 'BE' THEN {_local('ts', 'Europe/Brussels')}
  ELSE ts END"""


def _folded(text: str) -> str:
    return f"replace(replace(replace(upper(trim({text})), '-', ''), ' ', ''), '0', 'O')"


QUERIES = {
    "whole_table": "SELECT * FROM customer",
    "recent_key_bounds": """
SELECT min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM orders
WHERE o_orderdate > TIMESTAMP '1998-06-23'""",
    "range_split_counts": """
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders
           WHERE o_orderdate > TIMESTAMP '1998-06-23')
SELECT least((o_orderkey - lo) // greatest(hi // 16 - lo // 16, 1), 15) AS split, count(*) AS orders
FROM orders, b WHERE o_orderdate > TIMESTAMP '1998-06-23' GROUP BY 1""",
    "equal_share_reads": "SELECT count(*) AS orders, count(*) AS read_once, true AS balanced FROM orders",
    "day_limits": """
SELECT o_orderkey AS id, o_custkey AS merchant, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS state,
       o_orderpriority AS priority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-08-23'""",
    "text_predicates": """
SELECT p_brand, count(CASE WHEN lower(p_type) = 'promo' THEN 1 END) AS promo_any_case,
       count(CASE WHEN p_type = 'promo' THEN 1 END) AS promo_exact,
       count(CASE WHEN substr(p_name, 1, 3) = 'hot' THEN 1 END) AS prefix_hot,
       count(CASE WHEN p_name LIKE '% r%' THEN 1 END) AS like_r,
       count(CASE WHEN p_size BETWEEN 5 AND 10 THEN 1 END) AS mid_size
FROM part WHERE p_name NOT ILIKE '%bolt%' AND p_brand NOT IN ('Brand#1', 'Brand#2') GROUP BY p_brand""",
    "page_prefixes": """
SELECT substr(url, 1, 8) AS prefix, count(page_id) AS pages,
       count(CASE WHEN url ILIKE '%example.org/%' THEN 1 END) AS org_pages
FROM pages GROUP BY 1""",
    "booked_lines_by_nation_day": """
SELECT n_name AS nation, dayname(l_shipdate) AS day_of_week,
       count(DISTINCT l_orderkey) - count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS order_count,
       count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS cancelled_count,
       count(CASE WHEN l_linestatus <> 'F' THEN 1 END) > 0 AS any_open
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
WHERE l_shipdate BETWEEN TIMESTAMP '1998-08-23' AND TIMESTAMP '1998-08-28' GROUP BY 1, 2""",
    "cross_nation_lines": """
SELECT c_nationkey, s_nationkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders,
       count(*) AS lines
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey
WHERE l_shipdate BETWEEN TIMESTAMP '1998-07-24' AND TIMESTAMP '1998-08-23' AND c_nationkey <> s_nationkey
GROUP BY 1, 2""",
    "latest_line_per_part": """
SELECT p_partkey, l_orderkey, l_shipdate,
       CASE WHEN l_orderkey IS NULL AND p_type <> 'PROMO' THEN 1 WHEN p_type = 'PROMO' THEN 3
            WHEN l_returnflag = 'R' THEN 4 WHEN l_linestatus = 'O' THEN 2 ELSE 5 END AS state
FROM part LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
    l_linenumber DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) l
ON l.l_partkey = p_partkey AND rn = 1""",
    "customers_without_events": """
SELECT c_mktsegment, count(*) AS customers FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) GROUP BY 1""",
    "orders_never_returned": """
SELECT 'orders/' || o_orderkey AS order_link, CAST(o_orderdate AS DATE) AS created_date FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1998-07-24' AND TIMESTAMP '1998-08-18'
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
  AND EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)""",
    "customer_event_flags": """
WITH f AS (SELECT c_mktsegment, c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS p,
                  c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error') AS e FROM customer)
SELECT c_mktsegment, count(*) AS customers, count(CASE WHEN p THEN 1 END) AS with_purchase,
       count(CASE WHEN e THEN 1 END) AS with_error, count(CASE WHEN p AND NOT e THEN 1 END) AS clean_buyers
FROM f GROUP BY 1""",
    "late_events_after_signup": """
SELECT d.user_id % 7 AS terminal, count(DISTINCT d.event_id) AS due, count(DISTINCT d.user_id) AS users_due,
       count(DISTINCT e.user_id) AS users_seen_later
FROM events d LEFT JOIN events e ON e.user_id = d.user_id AND e.ts > d.ts + INTERVAL 1 DAY
WHERE d.event_type = 'signup' GROUP BY 1""",
    "cancellation_rate_by_ship_day": """
SELECT CAST(l_shipdate AS DATE) AS due_date, CASE WHEN l_returnflag = 'R' THEN 'Box' ELSE 'Home' END AS delivery_type,
       CAST(count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS DOUBLE)
         / count(DISTINCT l_orderkey) AS cancellation_rate,
       count(DISTINCT l_orderkey) AS orders
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-24' AND l_shipdate <= TIMESTAMP '1998-08-23'
GROUP BY 1, 2""",
    "event_type_pivot": """
SELECT user_id % 7 AS terminal, CAST(ts AS DATE) AS day,
       count(CASE WHEN event_type IN ('view', 'click') THEN 1 END) AS view,
       count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchase,
       count(CASE WHEN event_type = 'signup' THEN 1 END) AS signup,
       count(CASE WHEN event_type = 'error' THEN 1 END) AS error, count(*) AS total
FROM events GROUP BY 1, 2""",
    "priority_pivot_by_nation": """
SELECT c_nationkey, count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS p1,
       count(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END) AS p2,
       count(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 END) AS p3,
       count(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 END) AS p4,
       count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS p5, count(*) AS orders
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderdate BETWEEN TIMESTAMP '1998-07-24' AND TIMESTAMP '1998-08-23' GROUP BY 1""",
    "local_hour_buckets": f"""
WITH h AS (SELECT event_type, hour(CASE WHEN user_id % 2 = 0 THEN {_local('ts', 'Europe/Helsinki')}
  WHEN user_id % 3 = 0 THEN {_local('ts', 'America/New_York')} END) AS h FROM events)
SELECT event_type, count(CASE WHEN h <= 15 THEN 1 END) AS before_16,
       count(CASE WHEN h IN (16, 17) THEN 1 END) AS between_16_18,
       count(CASE WHEN h >= 18 THEN 1 END) AS after_18, count(*) AS events
FROM h GROUP BY 1""",
    "order_counts_with_total": """
WITH n AS (SELECT o_custkey, count(*) AS n FROM orders
           WHERE o_orderdate BETWEEN TIMESTAMP '1997-08-23' AND TIMESTAMP '1998-08-23' GROUP BY 1),
r AS (SELECT r_name AS region, n FROM n JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
      UNION ALL SELECT 'All', n FROM n)
SELECT region, count(*) AS customers, count(CASE WHEN n = 1 THEN 1 END) AS one_order,
       count(CASE WHEN n >= 3 THEN 1 END) AS three_or_more,
       CAST(count(CASE WHEN n = 1 THEN 1 END) AS DOUBLE) / count(*) * 100 AS one_order_percent
FROM r GROUP BY 1""",
    "brand_types": """
SELECT p_brand, string_agg(DISTINCT p_type, '   |   ' ORDER BY p_type) AS p_type FROM part GROUP BY 1""",
    "quantity_spread": """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS avg_quantity,
       round(stddev_pop(l_quantity), 6) AS std_quantity, sum(l_quantity) AS sum_quantity,
       count(CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 1 END) AS outliers, count(*) AS lines
FROM lineitem GROUP BY 1, 2""",
    "branches_distinct": """
SELECT delivery_type, l_returnflag, count(*) AS parcels FROM (
  SELECT l_orderkey, l_partkey, l_returnflag, 'Box' AS delivery_type FROM lineitem
  WHERE l_returnflag = 'R' AND l_shipdate BETWEEN TIMESTAMP '1998-08-16' AND TIMESTAMP '1998-08-23'
  UNION
  SELECT l_orderkey, l_partkey, l_returnflag, 'Home' FROM lineitem
  WHERE l_returnflag <> 'R' AND l_shipdate BETWEEN TIMESTAMP '1998-08-16' AND TIMESTAMP '1998-08-23')
GROUP BY 1, 2""",
    "signups_clamped_by_month": """
SELECT year(d) AS year, month(d) AS month, count(*) AS orders, min(d) AS date
FROM (SELECT greatest(CAST(o_orderdate AS DATE), DATE '1997-08-23') AS d FROM orders) GROUP BY 1, 2""",
    "ship_calendar": """
SELECT day, count(*) AS lines, max(upper(dayname(day))) AS weekday,
       max((CASE WHEN month(day) = 1 AND week(day) > 5 THEN year(day) - 1 ELSE year(day) END) || '-W' || week(day)) AS week,
       max(isoyear(day) || '-W' || week(day)) AS iso_week,
       max(CAST(day - INTERVAL 1 MONTH AS DATE)) AS month_before, max(year(day)) AS year
FROM (SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem) GROUP BY day""",
    "local_event_times": f"""
WITH e AS (SELECT *, (list_value('SE', 'NL', 'FI', 'DK', 'BE', 'US'))[user_id % 6 + 1] AS country FROM events),
l AS (SELECT *, {_COUNTRY_LOCAL} AS local FROM e)
SELECT event_type, country, max(ts - to_seconds(CAST(floor(value) AS BIGINT))) AS latest_cutoff,
       min(strftime(local, '%H:%M')) AS first_clock, max({_SECONDS.format('local')}) AS last_second,
       count(DISTINCT CAST(local AS DATE)) AS local_days
FROM l GROUP BY 1, 2""",
    "json_presence": """
SELECT event_type, count(json_extract_string(props, '$.k')) AS with_k,
       count(json_extract_string(props, '$.missing')) AS with_missing,
       count(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 1 END) AS small_k
FROM events GROUP BY 1""",
    "plate_folding": f"""
SELECT p_partkey, min(CASE WHEN a = b THEN 0 WHEN a < b THEN -1 ELSE 1 END) AS valid, max(a) AS plate,
       min(s_name) AS first_supplier
FROM (SELECT p_partkey, s_name, {_folded('p_brand')} AS a, {_folded("' br-and #' || (l_suppkey % 25)")} AS b
      FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey)
GROUP BY 1""",
    "embedding_points": """
SELECT vec_id, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings""",
    "previous_event": """
SELECT event_id, user_id, lag(event_id) OVER w AS prev_event_id, lag(ts) OVER w AS prev_ts,
       lag(event_type) OVER w AS prev_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "arrival_differences": f"""
WITH p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
d AS (SELECT CAST(ts AS DATE) AS day, event_type, {_SECONDS.format('ts')} - {_SECONDS.format('prev')} AS late FROM p)
SELECT day, event_type, round(avg(late) / 60, 6) AS avg_minutes, round(stddev_pop(late) / 60, 6) AS std_minutes,
       count(CASE WHEN abs(late) > 1800 THEN 1 END) AS count_fail, count(late) AS count_all
FROM d WHERE abs(late) < 10800 GROUP BY 1, 2""",
    "slot_misses": """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS f,
                  max(CASE WHEN event_type = 'purchase' THEN ts END) AS t FROM events GROUP BY 1, 2)
SELECT day, count(CASE WHEN t > f + INTERVAL 735 MINUTE OR t < f + INTERVAL 345 MINUTE THEN 1 END) AS not_ok,
       count(*) AS slots FROM d GROUP BY 1""",
    "replicate_latest": """
SELECT event_id, user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",
    "replicate_manifest": """
WITH newest AS (
  SELECT event_id % 2 AS side, user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL)
SELECT e.event_id, e.user_id, event_type, ts, if(side = 0, 'even_events', 'odd_events') AS table_name
FROM newest JOIN events e USING (event_id) WHERE event_type <> 'error'""",
    "merge_change_batch": """
SELECT event_id, user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",
}
