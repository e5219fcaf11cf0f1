"""Oracle SQL: billing and volumes."""

_DOOR = """
FROM t_consignments con
JOIN t_orders o ON o.id = con.order_id
JOIN t_buyers b ON b.id = o.buyer_id
JOIN t_postal_code_zones z ON z.id = o.delivery_postal_code_zone_id
JOIN t_warehouses w ON w.id = z.terminal_id
JOIN t_addresses a ON a.id = w.address_id
LEFT JOIN t_cancellations c ON c.id = con.cancellation_id
"""
# The same without terminals, which these marts do not read.
_ZONED = "\n".join(x for x in _DOOR.split("\n") if "t_warehouses" not in x and "t_addresses" not in x)
_PARCELS = """
LEFT JOIN t_parcel_consignments pc ON pc.consignment_id = con.id
LEFT JOIN t_parcels p ON p.id = pc.parcel_id
"""
_TODAY = """con.date = DATE '1998-08-23' AND con.type IN ('DELIVERY', 'RETURN') AND z.city <> 'OTHER'
  AND z.type = 'TO_DOOR' AND (p.visible OR p.id IS NULL)"""
_COUNTS = """count(DISTINCT p.id) AS parcels, count(DISTINCT con.id) AS consignments,
       count(con.id) AS parcel_consignments"""

QUERIES = {
    "cross_country_billable": f"""
SELECT z.country_code AS destination_country, a.country_code AS terminal_country, {_COUNTS}
{_DOOR} {_PARCELS}
WHERE {_TODAY} AND (c.date > con.deadline OR c.id IS NULL)
GROUP BY 1, 2 HAVING z.country_code <> a.country_code""",
    "multi_country_terminals": f"""
SELECT w.name AS source_terminal, z.country_code AS destination_country, count(pc.parcel_id) AS parcels,
       max(n.countries) AS countries
{_DOOR} JOIN t_parcel_consignments pc ON pc.consignment_id = con.id
JOIN (SELECT terminal_id, count(DISTINCT country_code) AS countries FROM t_postal_code_zones
      WHERE deleted_at IS NULL AND type = 'TO_DOOR' GROUP BY terminal_id) n ON n.terminal_id = w.id
WHERE con.date = DATE '1998-08-23' AND z.type = 'TO_DOOR' AND z.country_code IN ('NL', 'BE')
  AND (c.date > con.deadline OR c.id IS NULL)
GROUP BY w.id, w.name, z.country_code HAVING max(n.countries) > 1""",
    "billable_by_country_merchant": f"""
SELECT z.country_code AS country, b.id AS merchant_id, b.external_name AS merchant, {_COUNTS}
{_ZONED} {_PARCELS}
WHERE {_TODAY} AND (c.id IS NULL OR (c.date > con.deadline AND c.cancellation_category IN
  ('REQUESTED_BY_TRANSPORT_BUYER', 'DELAYED_FROM_MERCHANT', 'CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT',
   'WRONG_OR_INCOMPLETE_ADDRESS', 'DAMAGED_PARCEL_BY_MERCHANT')))
GROUP BY 1, 2, 3""",
    "billable_returns_by_country": f"""
SELECT z.country_code AS country, count(p.id) AS parcels, count(DISTINCT con.id) AS consignments
{_ZONED} JOIN t_parcel_consignments pc ON pc.consignment_id = con.id JOIN t_parcels p ON p.id = pc.parcel_id
WHERE con.date = DATE '1998-08-23' AND con.type = 'RETURN' AND z.id <> 111
  AND (c.id IS NULL OR (c.date > con.deadline AND c.cancellation_category IN
  ('REQUESTED_BY_MERCHANT', 'REQUESTED_BY_TRANSPORT_BUYER', 'CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT')))
GROUP BY 1""",
    "returns_by_merchant_zone": f"""
SELECT o.buyer_id, b.external_name, z.id AS zone_id, z.title AS zone_title, z.country_code AS country,
       z.city AS zone_city, z.terminal_id, count(p.id) AS parcels, count(DISTINCT con.id) AS consignments
{_ZONED} JOIN t_parcel_consignments pc ON pc.consignment_id = con.id JOIN t_parcels p ON p.id = pc.parcel_id
WHERE con.date = DATE '1998-08-23' AND con.type = 'RETURN' AND con.cancellation_id IS NULL
  AND z.id <> 111 AND z.type = 'TO_DOOR'
GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "volume_statistics": """
WITH places AS (SELECT id AS zone_id, type, city, country_code AS country FROM t_postal_code_zones WHERE id > 111),
sold AS (
  SELECT o.id AS order_id, o.token, b.external_name, places.*
  FROM places JOIN t_orders o ON o.delivery_postal_code_zone_id = zone_id JOIN t_buyers b ON b.id = o.buyer_id
  WHERE o.cancellation_id IS NULL),
sent AS (
  SELECT order_id, pc.parcel_id, 'TO_DOOR' AS type, 'Home' AS delivery_type
  FROM t_parcel_consignments pc JOIN t_consignments con ON con.id = pc.consignment_id
  WHERE con.date = DATE '1998-08-23' AND con.type = 'DELIVERY' AND con.cancellation_id IS NULL
  UNION
  SELECT p.order_id, p.id, 'TO_LOCKER', 'Box'
  FROM t_timestamps begin JOIN t_intervals span ON span.start_timestamp_id = begin.id
  JOIN t_locker_consignments con ON con.estimated_interval_id = span.id JOIN t_parcels p ON p.order_id = con.order_id
  WHERE begin.date >= TIMESTAMP '1998-08-23' AND begin.date < TIMESTAMP '1998-08-24' AND con.cancellation_id IS NULL)
SELECT external_name, city, country, delivery_type, count(*) AS parcels, count(size.id) AS measured_parcels,
       count(size.sorting_deviation) AS heavy_parcels
FROM sold JOIN sent USING (order_id, type) JOIN t_parcels p ON p.id = sent.parcel_id
LEFT JOIN t_dimensions size ON size.id = p.machine_dimensions_id
GROUP BY external_name, city, country, delivery_type""",
}
