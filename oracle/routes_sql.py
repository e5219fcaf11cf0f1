"""Oracle SQL: routes of the day."""

# Today's uncancelled attempts, one row per parcel they carry (or one without): hidden parcels have
# no number; `late` counts the parcel's scans after the attempt's deadline.
_DUE = """
places AS (
  SELECT area.id AS zone_id, area.type AS zone_type, area.country_code AS country, code AS terminal_code
  FROM t_warehouses house JOIN t_postal_code_zones area ON area.terminal_id = house.id),
scans AS (SELECT parcel_id, list(date) AS moments FROM t_scanning_log GROUP BY 1),
loads AS (
  SELECT consignment_id, shown.id AS parcel_id
  FROM t_parcel_consignments LEFT JOIN (SELECT id FROM t_parcels WHERE visible) shown ON shown.id = parcel_id),
due AS (
  SELECT today.id AS consignment_id, today.type, parcel_id, places.*,
         coalesce(len(list_filter(moments, lambda moment: moment > deadline)), 0) AS late
  FROM (FROM t_consignments WHERE cancellation_id IS NULL AND date = DATE '1998-08-23') today
  JOIN (SELECT id AS order_id, delivery_postal_code_zone_id AS zone_id FROM t_orders) USING (order_id)
  JOIN places USING (zone_id) LEFT JOIN loads ON consignment_id = today.id LEFT JOIN scans USING (parcel_id))
"""


def _plain(plate: str) -> str:
    return f"replace(replace(upper(trim({plate})), '-', ''), ' ', '')"


def _folded(plate: str) -> str:
    return f"replace({_plain(plate)}, '0', 'O')"


QUERIES = {
    "plate_compare": f"""
WITH photos AS (
  SELECT shot.route_id, shot.image_id, shot.license_plate AS seen, url
  FROM t_images picture RIGHT JOIN t_route_vehicle_images shot ON shot.image_id = picture.id),
vehicles AS (
  SELECT plan.id AS plan_id, car.license_plate AS planned
  FROM t_vehicles car JOIN t_routeopt_vehicles_and_users pair ON pair.vehicle_id = car.id
  JOIN t_routeopt_routes plan ON plan.routeopt_vehicle_and_user_id = pair.id
  WHERE lower(car.license_plate) NOT LIKE '%own fleet%'),
crews AS (
  SELECT route_id, id AS user_id, first_name || ' ' || last_name AS driver
  FROM t_users JOIN t_user_routes ON user_id = t_users.id),
cities AS (
  SELECT house.id AS terminal_id, house.city, place.country_code
  FROM t_warehouses house LEFT JOIN t_addresses place ON place.id = house.address_id)
SELECT r.id AS route_id, seen AS actual_plate, {_plain('planned')} AS routed_plate,
       CAST(if({_folded('planned')} = {_folded('seen')}, 0, if({_folded('planned')} < {_folded('seen')}, -1, 1)) AS INTEGER) AS valid,
       strftime(due_date, '%Y-%m-%d') AS route_date, 'https://admin.example/users/' || user_id AS user_link, driver,
       r.city, url AS image_url, firm.name AS courier, country_code AS country
FROM t_owner_operators firm JOIN t_routes r ON r.owner_operator_id = firm.id
JOIN vehicles ON vehicles.plan_id = r.routeopt_route_id JOIN crews ON crews.route_id = r.id
JOIN photos ON photos.route_id = r.id LEFT JOIN cities ON cities.city = r.city
WHERE due_date >= DATE '1998-08-21' AND due_date <= DATE '1998-08-23'
QUALIFY row_number() OVER (PARTITION BY r.id ORDER BY image_id, user_id, terminal_id) = 1""",
    "loading_inspection": """
WITH today AS (
  SELECT r.id AS route_id, title, r.city, terminal, plan.optimization_id
  FROM t_routeopt_routes plan JOIN t_routes r ON r.routeopt_route_id = plan.id
  WHERE due_date = DATE '1998-08-23' AND upper(r.type) = 'DISTRIBUTION'),
loads AS (
  SELECT stop.route_id, min(begin.date) AS moment
  FROM t_timestamps begin JOIN t_intervals span ON span.start_timestamp_id = begin.id
  JOIN t_terminal_stops stop ON stop.estimated_interval_id = span.id
  WHERE EXISTS (FROM t_terminal_stop_consignments put JOIN t_consignments con ON con.id = put.consignment_id
                WHERE put.terminal_stop_id = stop.id)
  GROUP BY 1),
crews AS (
  SELECT duty.route_id, u.id AS user_id, u.first_name || ' ' || u.last_name AS driver, u.phone_number, firm.name AS courier
  FROM t_user_routes duty JOIN t_users u ON u.id = duty.user_id
  LEFT JOIN t_owner_operator_users works ON works.user_id = u.id
  LEFT JOIN t_owner_operators firm ON firm.id = works.owner_operator_id
  QUALIFY row_number() OVER (PARTITION BY duty.route_id ORDER BY u.id, firm.id) = 1)
SELECT strftime(timezone('Europe/Stockholm', timezone('UTC', moment)), '%H:%M') AS loading_time, route_id,
       title AS cage_name, CAST(NULL AS VARCHAR) AS bay, user_id, driver, phone_number, courier,
       optimization_id, city, terminal
FROM loads JOIN today USING (route_id) LEFT JOIN crews USING (route_id)""",
    "ratings_in_routes_today": """
SELECT c.id AS consignment_id, rt.score, rt.rating_category, z.country_code AS country, z.city
FROM t_routes r JOIN t_consumer_stops cs ON cs.route_id = r.id
JOIN t_consumer_stop_consignments csc ON csc.consumer_stop_id = cs.id
JOIN t_consignments c ON c.id = csc.consignment_id JOIN t_orders o ON o.id = c.order_id
JOIN t_postal_code_zones z ON z.id = o.delivery_postal_code_zone_id
LEFT JOIN t_ratings rt ON rt.consignment_id = c.id
WHERE r.due_date = CAST(TIMESTAMP '1998-08-23 12:00:00' - INTERVAL 10 HOUR AS DATE) AND r.type = 'DISTRIBUTION'""",
    "due_vs_scanned": f"""
WITH {_DUE}
SELECT terminal_code, CAST(sum(greatest(late, 1)) AS BIGINT) AS consignments, count(DISTINCT parcel_id) AS parcels_due,
       count(DISTINCT parcel_id) FILTER (late > 0) AS scanned_parcels
FROM due WHERE zone_type = 'TO_DOOR' AND type IN ('DELIVERY', 'RETURN') GROUP BY 1""",
    "scanning_progress": f"""
WITH {_DUE}
SELECT terminal_code, min(country) AS country, count(DISTINCT consignment_id) AS consignments,
       count(DISTINCT parcel_id) AS parcels_due, count(DISTINCT parcel_id) FILTER (late > 0) AS scanned_parcels
FROM due GROUP BY 1""",
    "return_route_schedule": """
WITH departures AS (
  SELECT r.id AS route_id, r.terminal, firm.name AS courier, begin.date AS moment
  FROM t_timestamps begin JOIN t_intervals span ON span.start_timestamp_id = begin.id
  JOIN t_terminal_stops stop ON stop.estimated_interval_id = span.id AND stop.sequence = 1
  JOIN t_routes r ON r.id = stop.route_id JOIN t_owner_operators firm ON firm.id = r.owner_operator_id
  WHERE r.type = 'MERCHANT' AND begin.date >= TIMESTAMP '1998-08-23' AND begin.date <= TIMESTAMP '1998-08-24 12:00:00'),
unloadings AS (
  SELECT stop.route_id, country_code, b.id AS buyer_id, b.external_name AS merchant
  FROM t_buyers b JOIN t_orders o ON o.buyer_id = b.id JOIN t_consignments con ON con.order_id = o.id
  JOIN t_consumer_stop_consignments put ON put.consignment_id = con.id AND put.type = 'UNLOADING_OF_PARCELS'
  JOIN t_consumer_stops stop ON stop.id = put.consumer_stop_id JOIN t_addresses place ON place.id = stop.address_id),
free AS (
  SELECT detail.merchant_id AS buyer_id, pl.identifier
  FROM t_pallets pl JOIN t_return_pallet_details detail ON detail.pallet_id = pl.id
  WHERE detail.route_id IS NULL AND pl.created_at > TIMESTAMP '1998-08-16 12:00:00'
    AND pl.id IN (SELECT pallet_id FROM t_pallet_parcels WHERE parcel_id IS NOT NULL)),
crews AS (
  SELECT route_id, first_name || ' ' || last_name AS driver, phone_number
  FROM t_users u JOIN (SELECT route_id, min(user_id) AS user_id FROM t_user_routes GROUP BY 1) duty ON duty.user_id = u.id),
zones AS (
  FROM (VALUES ('SE', 'Europe/Stockholm'), ('NL', 'Europe/Amsterdam'), ('FI', 'Europe/Helsinki'),
               ('DK', 'Europe/Copenhagen'), ('BE', 'Europe/Brussels')) v(country_code, zone)),
calls AS (
  SELECT route_id, min(timezone(coalesce(zone, 'UTC'), timezone('UTC', moment))) AS loading_time,
         string_agg(DISTINCT merchant, '   |   ' ORDER BY merchant) AS merchants,
         string_agg(DISTINCT identifier, '   |   ' ORDER BY identifier) AS pallets
  FROM free JOIN unloadings USING (buyer_id) JOIN departures USING (route_id) LEFT JOIN zones USING (country_code)
  GROUP BY 1)
SELECT route_id, terminal, loading_time, merchants, pallets, driver, phone_number, true AS has_parcels, courier
FROM calls JOIN (SELECT DISTINCT route_id, terminal, courier FROM departures) USING (route_id) LEFT JOIN crews USING (route_id)""",
}
