"""Oracle SQL: orders not assigned yet, one step per common table expression."""

_STEPS = """
WITH ends AS (
  SELECT house.id AS terminal_id, code AS terminal_code, country_code AS terminal_country
  FROM t_addresses place JOIN t_warehouses house ON house.address_id = place.id),
booked AS (
  SELECT o.id AS order_id, o.buyer_id, o.created_at, b.external_name AS merchant, z.title AS zone_title,
         z.country_code AS country, z.type = 'TO_DOOR' AS home, terminal_id, terminal_code, terminal_country
  FROM ends JOIN t_postal_code_zones z USING (terminal_id)
  JOIN t_orders o ON o.delivery_postal_code_zone_id = z.id JOIN t_buyers b ON b.id = o.buyer_id
  WHERE o.cancellation_id IS NULL AND o.created_at >= TIMESTAMP '1998-08-09'
    AND z.type IN ('TO_DOOR', 'TO_LOCKER')
    AND (z.type = 'TO_DOOR' OR o.buyer_id NOT IN (476, 1050, 1051, 1052, 1459))),
unplanned AS (
  SELECT * FROM booked WHERE home AND NOT EXISTS (
    FROM t_consignments c WHERE c.order_id = booked.order_id AND c.cancellation_id IS NULL)
  UNION ALL
  SELECT * FROM booked WHERE NOT home AND NOT EXISTS (
    FROM t_locker_consignments c WHERE c.order_id = booked.order_id)),
loaded_today AS (
  SELECT put.parcel_id FROM t_locker_pallet_parcels put JOIN t_locker_pallets pallet ON pallet.id = put.locker_pallet_id
  WHERE pallet.route_id IN (SELECT id FROM t_routes WHERE due_date = DATE '1998-08-23' AND type = 'LOCKER')),
placed AS (SELECT parcel_id FROM t_parcel_box_assignments UNION SELECT parcel_id FROM loaded_today),
waiting AS (
  SELECT unplanned.*, p.id AS parcel_id, p.visible
  FROM t_parcels p JOIN unplanned USING (order_id)
  WHERE (home AND p.recall_requested_at IS NULL)
     OR (NOT home AND NOT EXISTS (FROM placed WHERE placed.parcel_id = p.id)))
"""


def _counts(extra: str, where: str) -> str:
    keys = f"{extra} merchant, terminal_code, country, tag_id, waiting.buyer_id, delivery_type"
    return f"""{_STEPS},
log AS (
  SELECT DISTINCT parcel_id, ends.terminal_code AS at_code, ends.terminal_country AS at_country
  FROM t_scanning_log LEFT JOIN t_users u ON u.id = user_id
  LEFT JOIN t_user_settings s ON s.id = u.user_settings_id LEFT JOIN ends ON ends.terminal_id = s.warehouse_id),
seen AS (
  SELECT parcel_id, waiting.order_id, bool_or(log.parcel_id IS NOT NULL) AS anywhere,
         bool_or(at_code = terminal_code) AS at_own, bool_or(at_country = country) AS at_destination,
         bool_or(at_country IN ('NL', 'BE')) AS in_nl_be
  FROM waiting LEFT JOIN log USING (parcel_id) WHERE visible GROUP BY ALL)
SELECT {keys}, count(DISTINCT waiting.order_id) AS orders, count(DISTINCT waiting.parcel_id) AS parcels,
       count(DISTINCT waiting.parcel_id) FILTER (anywhere) AS scanned,
       count(DISTINCT waiting.parcel_id) FILTER (at_own) AS scanned_at_own_terminal,
       count(DISTINCT waiting.parcel_id) FILTER (at_destination) AS scanned_in_destination,
       count(DISTINCT waiting.parcel_id) FILTER (in_nl_be) AS scanned_in_nl_be
FROM (SELECT *, CAST(created_at AS DATE) AS created_date, if(home, 'HOME', 'BOX') AS delivery_type FROM waiting) waiting
LEFT JOIN seen ON seen.parcel_id = waiting.parcel_id AND seen.order_id = waiting.order_id
LEFT JOIN (SELECT DISTINCT buyer_id, CAST(tag_id AS INTEGER) AS tag_id FROM t_buyer_tags WHERE tag_id = 2) tagged
  ON tagged.buyer_id = waiting.buyer_id
WHERE {where} GROUP BY {keys}"""


QUERIES = {
    "orders_not_assigned": _counts("", "true"),
    "orders_not_assigned_one_terminal": _counts("created_date,", "terminal_code = 'TERM2'"),
    "orders_not_assigned_union": f"""{_STEPS},
listed AS (
  SELECT * FROM waiting
  UNION ALL
  SELECT *, NULL, NULL FROM unplanned WHERE home AND order_id NOT IN (SELECT order_id FROM t_parcels)),
labels AS (
  SELECT entry.buyer_id, tag.id AS tag_id, tag.name AS tag_name
  FROM t_tags tag JOIN t_buyer_tags entry ON entry.tag_id = tag.id WHERE tag.id = 2)
SELECT strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS order_created_date, merchant, zone_title, terminal_code,
       terminal_country, country, tag_id, tag_name, order_id, parcel_id, visible,
       if(home, 'HOME', 'BOX') AS delivery_type
FROM listed LEFT JOIN labels USING (buyer_id)""",
}
