"""Oracle SQL: consumers."""

QUERIES = {
    "active_memberships": """
SELECT CAST(sum(CAST(ts.active AS INTEGER)) AS BIGINT) AS active_memberships,
       count(DISTINCT ts.consumer_id) AS signed_up
FROM t_timeslot_subscription ts JOIN t_consumer c ON c.id = ts.consumer_id
WHERE ts.valid_to > TIMESTAMP '1998-08-23 12:00:00'""",
    "consumer_order_stats": """
WITH placed AS (
  SELECT link.consumer_id AS person, delivery_postal_code_zone_id AS zone_id
  FROM t_orders JOIN t_consumer_order link ON link.order_id = t_orders.id WHERE created_at >= TIMESTAMP '1997-08-23'),
counted AS (
  SELECT consumer_id, if(grouping(country_code) = 1, 'All', country_code) AS country, count(*) AS n
  FROM placed JOIN t_consumer ON t_consumer.id = person LEFT JOIN t_postal_code_zones area ON area.id = zone_id
  GROUP BY GROUPING SETS ((consumer_id, country_code), (consumer_id))),
sized AS (
  SELECT country, count(*) AS consumers, count(*) FILTER (n = 1) AS one_order, count(*) FILTER (n = 2) AS two_orders,
         count(*) FILTER (n > 2) AS three_or_more_orders
  FROM counted WHERE country IS NOT NULL GROUP BY 1)
SELECT *, one_order::DOUBLE / consumers * 100 AS one_order_percent, two_orders::DOUBLE / consumers * 100 AS two_orders_percent,
       three_or_more_orders::DOUBLE / consumers * 100 AS three_or_more_orders_percent
FROM sized""",
    "signups_over_time_clamped": """
SELECT year(d) AS year, month(d) AS month, count(id) AS consumers, min(d) AS date
FROM (SELECT id, CASE WHEN created_at IS NULL OR CAST(created_at AS DATE) < DATE '1997-08-23'
                      THEN DATE '1997-08-23' ELSE CAST(created_at AS DATE) END AS d FROM t_consumer)
GROUP BY 1, 2""",
    "new_cancellations_per_day": """
SELECT CAST(cancelled_at AS DATE) AS cancelled_date, count(id) AS new_cancellations
FROM t_timeslot_subscription WHERE CAST(cancelled_at AS DATE) >= DATE '1997-08-23' GROUP BY 1""",
    "new_subscriptions_per_day": """
SELECT CAST(created_at AS DATE) AS created_date, count(id) AS new_subscriptions
FROM t_timeslot_subscription WHERE CAST(created_at AS DATE) >= DATE '1997-08-23' GROUP BY 1""",
    "on_demand_merchants": """
SELECT b.external_name, s.on_demand_pickup FROM t_buyers b JOIN t_buyer_settings s ON s.id = b.buyer_settings_id
WHERE s.on_demand_pickup""",
    "push_activated": """
SELECT count(push_notification_token) AS push_activated, count(id) AS consumers FROM t_consumer""",
    "push_delivered": """
SELECT CAST(sent AS DATE) AS date_sent, 'W' || week(sent) || '-' || year(sent) AS week_sent,
       count(CASE WHEN delivered IS NOT NULL THEN id END) AS push_delivered, count(id) AS push_sent
FROM t_sms_notifications
WHERE sent >= TIMESTAMP '1998-07-23' AND substr(message_id, 1, 9) = 'projects/'
GROUP BY 1, 2""",
    "consumer_orders_by_merchant": """
WITH contents AS (SELECT order_id, count(*) AS pieces FROM t_parcels GROUP BY 1),
shops AS (SELECT id AS buyer_id, external_name AS merchant FROM t_buyers WHERE deleted_at IS NULL),
bought AS (
  SELECT id AS order_id, buyer_id, delivery_postal_code_zone_id AS zone_id FROM t_orders WHERE created_at >= TIMESTAMP '1998-02-23')
SELECT person.consumer_id, merchant, country_code AS country, count(DISTINCT order_id) AS orders, CAST(sum(pieces) AS BIGINT) AS parcels
FROM contents JOIN bought USING (order_id) JOIN shops USING (buyer_id) JOIN t_consumer_order link USING (order_id)
JOIN t_consumer person ON person.id = link.consumer_id JOIN t_postal_code_zones area ON area.id = zone_id
GROUP BY ALL""",
}
