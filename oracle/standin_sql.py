"""The stand-in operational tables as DuckDB common table expressions."""

from __future__ import annotations

import re

NOW = "TIMESTAMP '1998-08-23 12:00:00'"
_DOOR = "(k % 2 = 0 AND k % 8 <> 0)"
_BOX = "(k % 2 = 1 AND k % 9 <> 0)"
_MERCHANT = f"(k % 20 = 2 AND {_DOOR})"


def _created(key: str) -> str:
    return (
        f"({NOW} - to_hours(CAST(CASE WHEN {key} % 3 = 0 THEN ({key} * 7919) % 9587"
        f" ELSE ({key} * 7919) % 967 END AS BIGINT)))"
    )


def _list(index: str, *values) -> str:
    return "(list_value(" + ", ".join(f"'{v}'" for v in values) + f"))[{index} + 1]"


_COUNTRY = ("SE", "NL", "FI", "DK", "BE")
_DAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")

_CANCEL = (
    "CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT",
    "CONSUMER_WANTS_TO_CANCEL_BOX_RESERVATION",
    "DAMAGED_PARCEL_BY_OPERATOR",
    "DAMAGED_PARCEL_BY_COURIER",
    "DELAYED_DRIVER",
    "DELAYED_FROM_MERCHANT",
    "ORDER_MOVED",
    "OTHER",
    "PARCEL_IN_WRONG_CITY",
    "REQUESTED_BY_MERCHANT",
    "REQUESTED_BY_TRANSPORT_BUYER",
    "WRONG_OR_INCOMPLETE_ADDRESS",
    "WRONG_SORTED_PARCEL",
    "CANCELLED_ROUTE",
    "PREMATURE_ROUTE_FINISH",
    "DOES_NOT_FIT_IN_VEHICLE",
    "CONVERTED_TO_HOME_DELIVERY",
    "CONSUMER_WANTS_TO_CHANGE_DELIVERY_TYPE",
    "PARCEL_NOT_ADDED_TO_ROUTE",
    "PARCEL_NEVER_ATTEMPTED_TO_ASSIGN",
    "PARCEL_NOT_PICKED_UP_BY_DRIVER",
    "PARCEL_TOO_LARGE",
    "RESERVATION_EXPIRED",
    "ROUTE_REACHED_MAX_CAPACITY",
    "LOCKER_IS_FULL",
    "DAMAGED_PARCEL_BY_MERCHANT",
    "VEHICLE_MALFUNCTION",
    "RECIPIENT_AGE_TOO_LOW",
    "BOX_WONT_OPEN",
    "BOX_IS_EMPTY",
)
_MISS = (
    "CANNOT_FIND_ADDRESS",
    "CANNOT_FIND_DOOR",
    "CANNOT_FIND_PARCEL",
    "CONSUMER_REJECTS_DELIVERY",
    "DOOR_CODE_DOES_NOT_WORK",
    "NOBODY_HOME",
    "OTHER",
    "WRONG_RECIPIENT",
    "OFFICE_ADDRESS_CLOSED",
)

# Table names get a t_ prefix: some equal the driver's own views.
TABLES = {
    "x_base": f"""
SELECT o_orderkey AS k, o_custkey AS buyer, o_custkey % 25 AS nk,
       o_orderpriority AS priority, {_created('o_orderkey')} AS created,
       CAST({_created('o_orderkey')} AS DATE) + CAST(1 + o_orderkey % 7 AS INTEGER) AS d
FROM orders""",
    "x_plan": f"""
SELECT *, CAST(date_diff('day', DATE '1990-01-01', d) AS BIGINT) * 100 + (nk % 7) * 2 + k % 2 AS route,
       CAST(date_diff('day', DATE '1990-01-01', d) AS BIGINT) * 100 + 50 + nk % 7 AS mroute,
       CAST(d AS TIMESTAMP) + to_hours(8 + k % 8) AS t0,
       CAST(d AS TIMESTAMP) + to_hours(10 + k % 8) AS t1
FROM x_base WHERE {_DOOR} OR {_BOX}""",
    "x_first": """
SELECT l_orderkey AS k, l_orderkey * 1000000 + min(l_partkey) AS parcel_id
FROM lineitem GROUP BY l_orderkey""",
    "x_events": """
SELECT event_id AS id, k, user_id,
       CAST(CAST(b.created AS DATE) + CAST((event_id * 31) % 9 AS INTEGER) AS TIMESTAMP)
         + (ts - date_trunc('day', ts)) AS date
FROM (SELECT *, event_id - event_id % 2 + (event_id // 2) % 2 AS k FROM events) e
JOIN x_base b USING (k)""",
    "x_nation": f"""
SELECT CAST(n_nationkey AS BIGINT) AS n, n_name, {_list('n_regionkey', *_COUNTRY)} AS country_code
FROM nation""",
    "x_days": """
SELECT n.*, w FROM x_nation n CROSS JOIN (SELECT unnest(range(7)) AS w)""",
    "t_orders": """
SELECT k AS id, buyer AS buyer_id, created AS created_at,
       200 + 2 * nk + k % 2 AS delivery_postal_code_zone_id,
       CASE WHEN k % 2 = 1 THEN k % 25 + 1 END AS locker_id,
       CASE WHEN k % 37 = 0 THEN k END AS cancellation_id,
       'T' || k AS token,
       CASE WHEN k % 7 = 0 THEN 'cart--Route' ELSE 'cart--Basket' END AS cart_id
FROM x_base""",
    "t_consignments": """
SELECT k AS id, k AS order_id, d AS date, CAST(d AS TIMESTAMP) - INTERVAL 12 HOUR AS deadline,
       CASE WHEN priority LIKE '1%' THEN 'RETURN' ELSE 'DELIVERY' END AS type,
       CASE WHEN k % 11 = 0 THEN k END AS cancellation_id,
       CASE WHEN k % 13 = 0 THEN k END AS miss_id, CASE WHEN k % 41 <> 0 THEN k END AS interval_id
FROM x_plan WHERE k % 2 = 0""",
    "t_locker_consignments": """
SELECT k AS id, k AS order_id, CASE WHEN k % 41 <> 0 THEN k END AS estimated_interval_id,
       CASE WHEN priority LIKE '1%' THEN 'RETURN' ELSE 'DELIVERY' END AS consignment_type,
       CASE WHEN k % 11 = 0 THEN k END AS cancellation_id,
       CASE WHEN k % 13 = 0 THEN k END AS miss_id,
       CASE WHEN k % 4 = 1 THEN k END AS parcel_box_assignment_id
FROM x_plan WHERE k % 2 = 1""",
    "t_cancellations": f"""
SELECT k AS id, {_list('(k // 11) % 30', *_CANCEL)} AS cancellation_category,
       CAST(d AS TIMESTAMP) + to_hours(k % 48 - 24) AS date
FROM x_base WHERE k % 37 = 0 OR (k % 11 = 0 AND ({_DOOR} OR {_BOX}))""",
    "t_misses": f"""
SELECT k AS id, {_list('(k // 13) % 9', *_MISS)} AS category FROM x_plan WHERE k % 13 = 0""",
    "t_intervals": """
SELECT k AS id, 2 * k AS start_timestamp_id, 2 * k + 1 AS stop_timestamp_id FROM x_plan""",
    "t_timestamps": """
SELECT 2 * k AS id, t0 AS date FROM x_plan UNION ALL SELECT 2 * k + 1, t1 FROM x_plan""",
    "t_parcels": f"""
SELECT l_orderkey * 1000000 + l_partkey AS id, l_orderkey AS order_id,
       CASE WHEN l_orderkey % 5 = 0 THEN 'RETURN' ELSE 'DELIVERY' END AS type,
       l_partkey % 10 <> 0 AS visible,
       CASE WHEN l_partkey % 17 = 0 THEN TIMESTAMP '1998-08-16 00:00:00' END AS recall_requested_at,
       CASE WHEN l_partkey % 17 = 0 THEN 'REQUESTED_BY_MERCHANT' END AS recall_reason,
       {_created('l_orderkey')} AS created_at,
       CASE WHEN l_partkey % 3 = 0 THEN l_orderkey * 1000000 + l_partkey END AS machine_dimensions_id
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)""",
    "t_parcel_consignments": """
SELECT p.id AS parcel_id, c.id AS consignment_id
FROM t_parcels p JOIN t_consignments c USING (order_id)""",
    "t_dimensions": """
SELECT id, CASE WHEN (id % 1000000) % 6 = 0 THEN 'HEAVY' END AS sorting_deviation
FROM t_parcels WHERE machine_dimensions_id IS NOT NULL""",
    "t_scanning_log": """
SELECT id, parcel_id, user_id, date FROM x_events JOIN x_first USING (k)""",
    "t_parcel_status_updates": """
SELECT id, k AS consignment_id, (list_value(2, 3, 8, 10, 3))[id % 5 + 1] AS parcel_status_id, date,
       user_id, id % 6 = 0 AS with_neighbour
FROM x_events""",
    "t_parcel_box_assignments": f"""
SELECT k AS id, parcel_id, k % 200 AS box_id,
       {_list('k % 3', 'PRESENT', 'PICKED_UP', 'RESERVED')} AS state,
       CASE WHEN k % 3 = 1 THEN CAST(d AS TIMESTAMP) + INTERVAL 24 HOUR END AS picked_up,
       CAST(d AS TIMESTAMP) + to_hours(24 * (k % 5)) AS reservation_expires_at
FROM x_base JOIN x_first USING (k) WHERE k % 4 = 1""",
    "t_ratings": f"""
SELECT k AS id, k AS consignment_id, 1 + k % 5 AS score,
       {_list('k % 3 + k % 2', 'DRIVER', 'TIME', 'PARCEL')} AS rating_category
FROM x_plan WHERE k % 2 = 0 AND k % 3 = 0""",
    "t_slot_payments": """
SELECT k AS consignment_id, CASE WHEN k % 4 = 0 THEN 'COMPLETED' ELSE 'PENDING' END AS status,
       CASE WHEN k % 12 = 0 THEN 'TIMESLOT' ELSE 'HOME' END AS purchase_type,
       CASE k % 10 WHEN 2 THEN '{"timeWindow": {"timeslotSpec": null}}'
                   WHEN 4 THEN '{"timeWindow": {}}'
                   WHEN 6 THEN '{timeWindow'
                   ELSE '{"timeWindow": {"timeslotSpec": "S' || (k % 5) || '"}}' END AS reference
FROM x_plan WHERE k % 2 = 0""",
    "t_on_demand_pickups": """
SELECT k AS order_id, 1 + k % 9 AS estimated_parcels FROM x_base WHERE k % 6 = 0""",
    "t_routes": f"""
SELECT id, d AS due_date, {_list('kind', 'DISTRIBUTION', 'LOCKER', 'MERCHANT')} AS type,
       'TERM' || t AS terminal, CASE WHEN t = 6 THEN 'OTHER' ELSE 'City ' || t END AS city,
       'Cage ' || id AS title, CASE WHEN id % 3 = 0 THEN 'TRUCK' ELSE 'VAN' END AS vehicle_type,
       id % 5 AS owner_operator_id, CASE WHEN t <> 5 THEN id END AS routeopt_route_id
FROM (SELECT DISTINCT route AS id, d, nk % 7 AS t, k % 2 AS kind FROM x_plan
      UNION SELECT DISTINCT mroute, d, nk % 7, 2 FROM x_plan WHERE {_MERCHANT})""",
    "t_consumer_stops": f"""
SELECT k AS id, route AS route_id, (k * 31) % 1009 AS sequence, 1000000000 + k % 200 AS address_id,
       CASE WHEN k % 43 <> 0 THEN k END AS estimated_interval_id FROM x_plan
UNION ALL
SELECT 4000000000000 + k, mroute, (k * 31) % 1009, 1000000000 + k % 200, k FROM x_plan WHERE {_MERCHANT}""",
    "t_consumer_stop_consignments": f"""
SELECT k AS id, k AS consumer_stop_id, k AS consignment_id, 'DELIVERY' AS type
FROM x_plan WHERE {_DOOR} AND k % 10 <> 2
UNION ALL
SELECT 4000000000000 + k, 4000000000000 + k, k,
       CASE WHEN k % 3 = 0 THEN 'LOADING_OF_PARCELS' ELSE 'UNLOADING_OF_PARCELS' END
FROM x_plan WHERE {_MERCHANT}""",
    "t_terminal_stops": f"""
SELECT r * 10 + s AS id, r AS route_id, s AS sequence, nk % 7 AS address_id, k AS estimated_interval_id
FROM (SELECT r, min(nk) AS nk, min(k) AS k
      FROM (SELECT route AS r, nk, k FROM x_plan
            UNION ALL SELECT mroute, nk, k FROM x_plan WHERE {_MERCHANT}) GROUP BY r)
CROSS JOIN (SELECT unnest([1, 2]) AS s)""",
    "t_terminal_stop_consignments": f"""
SELECT route * 10 + 1 AS terminal_stop_id, k AS consignment_id
FROM x_plan WHERE {_DOOR} AND k % 10 <> 2""",
    "t_locker_stops": "SELECT k AS stop_id, k % 25 + 1 AS locker_id FROM x_plan WHERE k % 2 = 1",
    "t_locker_pallets": """
SELECT DISTINCT route * 100 + k % 25 + 1 AS id, route AS route_id, k % 25 + 1 AS locker_id
FROM x_plan WHERE k % 2 = 1 AND k % 5 <> 0""",
    "t_locker_pallet_parcels": """
SELECT p.id, x.route * 100 + x.k % 25 + 1 AS locker_pallet_id, p.id AS parcel_id
FROM t_parcels p JOIN x_plan x ON x.k = p.order_id WHERE x.k % 2 = 1 AND x.k % 5 <> 0""",
    "t_pallets": f"""
SELECT c_custkey AS id, 'PAL-' || (c_custkey % 50) AS identifier,
       {NOW} - to_hours(24 * (c_custkey % 10)) AS created_at
FROM customer WHERE c_custkey % 3 = 0""",
    "t_pallet_parcels": """
SELECT x.buyer AS pallet_id, p.id AS parcel_id
FROM t_parcels p JOIN x_base x ON x.k = p.order_id WHERE x.k % 5 = 0""",
    "t_return_pallet_details": """
SELECT c_custkey AS merchant_id, CASE WHEN c_custkey % 4 = 0 THEN c_custkey END AS route_id,
       c_custkey AS pallet_id
FROM customer WHERE c_custkey % 3 = 0""",
    "t_user_routes": f"""
SELECT x.route AS route_id, e.user_id FROM x_events e JOIN x_plan x USING (k) WHERE e.id % 4 <> 3
UNION
SELECT x.mroute, e.user_id FROM x_events e JOIN x_plan x USING (k) WHERE e.id % 4 <> 3 AND {_MERCHANT}""",
    "t_route_history": "SELECT id, id AS route_child_id FROM t_routes WHERE id % 9 = 0",
    "t_route_vehicle_images": """
SELECT id AS route_id, CASE id % 4 WHEN 0 THEN 'ABO' || (id % 10)
                                   WHEN 1 THEN ' ab-0 ' || (id % 10) || ' '
                                   WHEN 2 THEN 'XYZ ' || (id % 10) END AS license_plate, id AS image_id
FROM t_routes WHERE type = 'DISTRIBUTION'""",
    "t_images": """
SELECT id, 'https://images.example/' || id || '.jpg' AS url FROM t_routes WHERE id % 3 <> 0""",
    "t_routeopt_service_time_data": """
SELECT route AS route_id, k AS consumer_stop_id, CAST(NULL AS BIGINT) AS terminal_stop_id,
       t0 + to_minutes((k * 17) % 91 - 45) AS arrival_time,
       t0 + to_minutes((k * 17) % 91 - 40) AS departure_time FROM x_plan
UNION ALL
SELECT route_id, NULL, id,
       CAST(DATE '1990-01-01' + CAST(route_id // 100 AS INTEGER) AS TIMESTAMP) + to_minutes(360 + 600 * (sequence - 1)),
       CAST(DATE '1990-01-01' + CAST(route_id // 100 AS INTEGER) AS TIMESTAMP) + to_minutes(390 + 600 * (sequence - 1))
FROM t_terminal_stops""",
    "t_routeopt_drive_time_data": f"""
SELECT route AS route_id, CASE WHEN k % 3 <> 0 THEN k END AS from_consumer_stop_id,
       CASE k % 3 WHEN 0 THEN k WHEN 2 THEN k + 2 END AS to_consumer_stop_id,
       CASE WHEN k % 3 < 2 THEN route * 10 + 1 + k % 3 END AS terminal_stop_id,
       CAST(60 + k % 900 AS DOUBLE) AS estimated_drive_time, CAST(100 + k % 7000 AS DOUBLE) AS distance
FROM x_plan WHERE {_DOOR} AND k % 10 <> 2""",
    "t_routeopt_routes": """
SELECT id, id % 7 AS optimization_id, id AS routeopt_vehicle_and_user_id FROM t_routes""",
    "t_routeopt_optimizations": f"""
SELECT n AS id, CASE WHEN n <> 6 THEN {_list('n % 6', 'Europe/Stockholm', 'Europe/Amsterdam',
    'Europe/Helsinki', 'Europe/Copenhagen', 'Europe/Brussels', 'UTC')} END AS timezone,
       n AS optimization_settings_id
FROM x_nation""",
    "t_routeopt_settings": "SELECT n AS id, n % 5 AS routeopt_graph_settings_id FROM x_nation",
    "t_routeopt_graph_settings": """
SELECT n AS id, n / 2.0::DOUBLE AS drive_time_factor, (n + 1) / 4.0::DOUBLE AS initial_drive_time_factor
FROM x_nation""",
    "t_routeopt_vehicles_and_users": """
SELECT id, id % 10 AS vehicle_id, id % 25 AS routeopt_vehicle_and_user_settings_id FROM t_routes""",
    "t_routeopt_vehicles_and_users_settings": """
SELECT n AS id, n % 4 AS user_optimization_settings_id FROM x_nation""",
    "t_user_optimization_settings": """
SELECT n AS id, CASE WHEN n = 3 THEN 'TRAINEE' ELSE 'LEVEL_' || n END AS user_type,
       (n + 2) / 2.0::DOUBLE AS drive_time_factor
FROM x_nation""",
    "t_vehicles": """
SELECT s_suppkey AS id, CASE WHEN s_suppkey % 10 = 9 THEN 'own fleet 9'
       ELSE ' ab-0' || s_suppkey || ' ' END AS license_plate FROM supplier""",
    "t_routeopt_groups": f"""
SELECT n * 7 + w AS id, 'Group ' || n || ' ' || w AS title,
       CASE WHEN n = 24 THEN 'OTHER' ELSE n_name END AS city, 'TERM' || (n % 7) AS terminal_code,
       n * 7 + w AS routeopt_group_settings_id, CASE WHEN n % 6 = 5 THEN {NOW} END AS deleted_at
FROM x_days""",
    "t_routeopt_group_settings": f"""
SELECT n * 7 + w AS id, {_list('w', *_DAYS)} AS delivery_day FROM x_days""",
    "t_routeopt_group_settings_consignment_types": """
SELECT n * 7 + w AS routeopt_group_settings_id, 'DELIVERY' AS consignment_type FROM x_days
UNION ALL SELECT n * 7 + w, 'RETURN' FROM x_days WHERE w % 2 = 0""",
    "t_collection_points": f"""
SELECT 2 * n + x AS id, CASE WHEN (2 * n + x) % 9 = 8 THEN {NOW} END AS deleted_at
FROM x_nation CROSS JOIN (SELECT unnest([0, 1]) AS x)""",
    "t_collection_point_intervals": f"""
SELECT (n * 7 + w) * 2 + x AS id, 2 * n + x AS collection_point_id, n * 7 + w AS routeopt_group_id,
       {_list('w', *_DAYS)} AS delivery_day, (8 + (n + x) % 8) * 3600 AS collection_start,
       600 * (n % 12) AS routing_cutoff_seconds, CASE WHEN n % 11 = 10 THEN {NOW} END AS deleted_at
FROM x_days CROSS JOIN (SELECT unnest([0, 1]) AS x)""",
    "t_buyer_collection_points": """
SELECT c_custkey AS buyer_id, c_custkey % 50 AS collection_point_id FROM customer""",
    "t_collection_point_schedules": f"""
SELECT n * 7 + w AS id, 2 * n AS pickup_collection_point_id, {_list('w', *_DAYS)} AS pickup_day,
       (14 + (n + w) % 6) * 3600 + 1800 * (w % 2) AS pickup_time_end FROM x_days""",
    "t_recurring_pickup_schedule": f"""
SELECT s_suppkey AS id, 'Round ' || s_suppkey AS name, s_suppkey % 7 AS start_terminal_id,
       CASE WHEN s_suppkey % 4 = 3 THEN {NOW} END AS deleted_at FROM supplier""",
    "t_recurring_pickup_schedule_merchant_schedules": """
SELECT (n * 7 + w) * 10 + x AS id, n * 7 + w AS collection_point_schedule_id,
       (n + x) % 10 AS recurring_pickup_route_id
FROM x_days CROSS JOIN (SELECT unnest([1, 2]) AS x) WHERE (n + w) % 5 <> 4""",
    "t_postal_code_zones": f"""
SELECT 200 + 2 * n + x AS id, CASE WHEN n = 24 THEN 'OTHER' ELSE n_name END AS title,
       CASE WHEN n = 24 THEN 'OTHER' ELSE n_name END AS city, country_code,
       CASE WHEN x = 0 THEN 'TO_DOOR' ELSE 'TO_LOCKER' END AS type, CASE WHEN n <> 17 THEN n % 7 END AS terminal_id,
       CASE WHEN n % 12 = 11 THEN {NOW} END AS deleted_at
FROM x_nation CROSS JOIN (SELECT unnest([0, 1]) AS x)""",
    "x_terminals": """
SELECT s_suppkey AS id, country_code, s_acctbal FROM supplier JOIN x_nation ON n = s_nationkey""",
    "t_warehouses": f"""
SELECT id, 'Terminal ' || id AS name, 'TERM' || id AS code,
       CASE WHEN id = 6 THEN 'OTHER' ELSE 'City ' || id END AS city, CASE WHEN id <> 4 THEN id END AS address_id,
       {NOW} - to_hours(2400 + 24 * id) AS created_at, CASE WHEN id = 5 THEN {NOW} END AS deleted_at,
       CASE WHEN id % 2 = 0 THEN 'LEFT' ELSE 'RIGHT' END AS sorting_machine_assign_direction,
       id % 3 = 0 AS sorting_machine_books_delivery,
       10 + id AS sorting_machine_maximum_routes_per_lane,
       1 + id % 3 AS sorting_machine_minimum_routes_per_lane
FROM x_terminals""",
    "t_addresses": f"""
SELECT id, 'Street ' || id AS street, 'P' || id AS postal_code, 'City ' || id AS city, country_code,
       s_acctbal / 100 AS x, s_acctbal / 200 AS y FROM x_terminals
UNION ALL
SELECT 1000000000 + vec_id, 'Street ' || vec_id, 'P' || (vec_id % 90), 'Town ' || (vec_id % 30),
       {_list('vec_id % 5', *_COUNTRY)}, CAST(embedding[1] AS DOUBLE), CAST(embedding[2] AS DOUBLE)
FROM embeddings""",
    "t_buyers": f"""
SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_custkey % 50 = 0 THEN 'Box Merchant ' || c_custkey ELSE c_name END AS external_name,
       c_custkey AS buyer_settings_id, CASE WHEN c_custkey % 41 = 0 THEN {NOW} END AS deleted_at
FROM customer""",
    "t_buyer_settings": "SELECT c_custkey AS id, c_custkey % 20 = 0 AS on_demand_pickup FROM customer",
    "t_buyer_tags": """
SELECT c_custkey AS buyer_id, 2 AS tag_id FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, 3 FROM customer WHERE c_custkey % 7 = 0""",
    "t_tags": "SELECT r_regionkey AS id, r_regionkey % 2 AS tag_type_id, r_name AS name FROM region",
    "t_lockers": f"""
SELECT id, 'L' || id AS identifier, 'Locker ' || id AS name, 'Town ' || n AS city,
       country_code AS country, 'Street ' || n AS street, id % 6 <> 0 AS enabled,
       id / 4.0::DOUBLE AS x, id / 8.0::DOUBLE AS y,
       DATE '1998-08-23' - CAST(30 * id AS INTEGER) AS installation_date,
       2 * (id % 25) AS collection_point_id, 200 + 2 * (id % 25) + 1 AS postal_code_zone_id,
       id % 7 AS location_partner_id, CASE WHEN id = 13 THEN {NOW} END AS deleted_at
FROM (SELECT *, n + 1 AS id FROM x_nation)""",
    "t_locker_boxes": f"""
SELECT p_partkey AS id, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS locker_id,
       p_size % 5 AS board_id, p_partkey % 10 AS slot_id,
       {_list('p_size % 4', 'BOX_265_100_600', 'BOX_265_150_600', 'BOX_265_225_600',
              'BOX_400_300_600')} AS size,
       CASE WHEN p_type = 'PROMO' THEN 'E' || p_size END AS error_code
FROM part""",
    "t_locker_location_partners": "SELECT r_regionkey AS id, r_name AS name FROM region",
    "t_users": """
SELECT user_id AS id, 'First' || user_id AS first_name, 'Last' || user_id AS last_name,
       '+46' || (1000 + user_id) AS phone_number, user_id AS user_settings_id
FROM (SELECT DISTINCT user_id FROM events)""",
    "t_user_settings": "SELECT DISTINCT user_id AS id, user_id % 7 AS warehouse_id FROM events",
    "t_owner_operators": "SELECT r_regionkey AS id, 'Courier ' || r_name AS name FROM region",
    "t_owner_operator_users": """
SELECT DISTINCT user_id, user_id % 5 AS owner_operator_id FROM events WHERE user_id % 8 <> 7""",
    "t_chrono_consignment_limits": """
SELECT id * 100 + i AS id, 'TERM' || id AS terminal, DATE '1998-08-20' + CAST(i AS INTEGER) AS date,
       100 + 10 * i AS maximum_number_of_consignments, i % 2 = 1 AS block_direct_checkout_merchants
FROM x_terminals CROSS JOIN (SELECT unnest(range(10)) AS i)""",
    "t_sms_notifications": f"""
SELECT event_id AS id, {_list('event_id % 3', 'projects/', 'Projects/', 'sms/')} || event_id AS message_id,
       ts - to_days(9291) AS sent,
       CASE WHEN value > 1 THEN ts - to_days(9291) + INTERVAL 1 HOUR END AS delivered
FROM events""",
    "t_consumer": """
SELECT c_custkey AS id, c_custkey + 500000 AS consumer_id,
       CASE WHEN c_custkey % 3 <> 0 THEN 'push-' || c_custkey END AS push_notification_token,
       CASE WHEN c_custkey % 29 <> 0 THEN
         CAST(DATE '1998-08-23' - CAST((c_custkey * 37) % 700 AS INTEGER) AS TIMESTAMP) END AS created_at
FROM customer""",
    "t_consumer_order": "SELECT o_custkey AS consumer_id, o_orderkey AS order_id FROM orders",
    "t_timeslot_subscription": f"""
SELECT event_id AS id, CASE WHEN event_id % 31 <> 0 THEN user_id END AS consumer_id, event_id % 3 <> 0 AS active,
       {NOW} + to_hours(24 * (event_id % 90 - 30)) AS valid_to,
       CASE WHEN event_id % 4 = 0 THEN
         ts - to_days(CAST(9291 + event_id % 500 - event_id % 200 AS INTEGER)) END AS cancelled_at,
       ts - to_days(CAST(9291 + event_id % 500 AS INTEGER)) AS created_at
FROM events WHERE event_type = 'signup'""",
}

_NAME = re.compile(r"\b([tx]_[a-z_]+)\b")


def with_tables(sql: str) -> str:
    """Prefix a query with the stand-in tables it names, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in TABLES and name not in ordered:
                visit(TABLES[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    parts = [f"{name} AS ({TABLES[name].strip()})" for name in ordered]
    body = sql.strip()
    head = "WITH " + ",\n".join(parts)
    if body.upper().startswith("WITH "):
        return head + ",\n" + body[5:]
    return head + "\n" + body
