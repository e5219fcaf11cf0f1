"""Oracle SQL: cancellations and misses, one step per common table expression."""

from oracle.standin_sql import _CANCEL, _MISS

_EXTERNAL = (
    "'REQUESTED_BY_TRANSPORT_BUYER', 'DELAYED_FROM_MERCHANT', 'CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT',"
    " 'WRONG_OR_INCOMPLETE_ADDRESS', 'DAMAGED_PARCEL_BY_MERCHANT', 'CONSUMER_WANTS_TO_CANCEL_BOX_RESERVATION'"
)
_OWN = (
    "'DAMAGED_PARCEL_BY_OPERATOR', 'DAMAGED_PARCEL_BY_COURIER', 'DELAYED_DRIVER', 'OTHER',"
    " 'PARCEL_IN_WRONG_CITY', 'CANCELLED_ROUTE', 'PREMATURE_ROUTE_FINISH', 'WRONG_SORTED_PARCEL',"
    " 'VEHICLE_MALFUNCTION', 'WRONG_OR_INCOMPLETE_ADDRESS'"
)


def _attempts(day: str) -> str:
    """Attempts of routes due as `day` says: home by stop, box by pallet parcel and call at the locker."""
    return f"""
WITH due AS (SELECT id AS route_id, type AS purpose, due_date, routeopt_route_id FROM t_routes WHERE due_date {day}),
zoned AS (
  SELECT o.id AS order_id, z.type AS zone_type, z.terminal_id
  FROM t_postal_code_zones z JOIN t_orders o ON o.delivery_postal_code_zone_id = z.id),
home AS (
  SELECT due.*, 'Home' AS delivery_type, con.id AS consignment_id, con.type AS kind, con.date,
         con.cancellation_id, con.miss_id, zoned.terminal_id, 1 AS weight
  FROM t_consignments con JOIN zoned ON zoned.order_id = con.order_id AND zone_type = 'TO_DOOR'
  JOIN t_consumer_stop_consignments put ON put.consignment_id = con.id
  JOIN t_consumer_stops stop ON stop.id = put.consumer_stop_id
  JOIN due ON due.route_id = stop.route_id AND purpose = 'DISTRIBUTION'),
calls AS (
  SELECT stop.route_id, halt.locker_id, count(*) AS times
  FROM t_locker_stops halt JOIN t_consumer_stops stop ON stop.id = halt.stop_id GROUP BY ALL),
carried AS (
  SELECT calls.route_id, p.order_id, sum(times) AS weight
  FROM t_parcels p JOIN t_locker_pallet_parcels put ON put.parcel_id = p.id
  JOIN t_locker_pallets pallet ON pallet.id = put.locker_pallet_id
  JOIN calls ON calls.route_id = pallet.route_id AND calls.locker_id = pallet.locker_id GROUP BY ALL),
box AS (
  SELECT due.*, 'Box' AS delivery_type, con.id AS consignment_id, con.consignment_type AS kind,
         CAST(begin.date AS DATE) AS date, con.cancellation_id, con.miss_id, zoned.terminal_id, carried.weight
  FROM carried JOIN due ON due.route_id = carried.route_id AND purpose = 'LOCKER'
  JOIN zoned ON zoned.order_id = carried.order_id AND zone_type = 'TO_LOCKER'
  JOIN t_locker_consignments con ON con.order_id = carried.order_id
  JOIN t_intervals span ON span.id = con.estimated_interval_id
  JOIN t_timestamps begin ON begin.id = span.start_timestamp_id),
attempts AS (FROM home UNION ALL FROM box)
"""


_PLACES = """, places AS (
  SELECT house.id AS terminal_id, house.name AS terminal_name, country_code AS terminal_country
  FROM t_addresses place JOIN t_warehouses house ON house.address_id = place.id)
"""


def _sum(condition: str, name: str) -> str:
    return f"CAST(coalesce(sum(weight) FILTER (WHERE {condition}), 0) AS BIGINT) AS {name}"


_BY_MISS = ", ".join(_sum(f"category = '{name}'", name.lower()) for name in _MISS)
_ALSO = {
    "CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT": "CONSUMER_WANTS_TO_CANCEL_BOX_RESERVATION",
    "CONSUMER_WANTS_TO_CHANGE_DELIVERY_TYPE": "CONVERTED_TO_HOME_DELIVERY",
}
_BY_REASON = ", ".join(
    _sum(f"reason IN ('{name}', '{_ALSO.get(name, name)}')", name.lower())
    for name in _CANCEL
    if name not in _ALSO.values()
)

QUERIES = {
    "cancellation_rate_per_day": f"""{_attempts("> DATE '1998-06-23'")}
, own AS (SELECT id FROM t_cancellations WHERE cancellation_category NOT IN ({_EXTERNAL}))
SELECT due_date, delivery_type,
       CAST(count(DISTINCT own.id) AS DOUBLE) / count(DISTINCT consignment_id) AS cancellation_rate
FROM attempts LEFT JOIN own ON own.id = attempts.cancellation_id GROUP BY due_date, delivery_type""",
    "miss_category_pivot": f"""{_attempts("= DATE '1998-08-23'")}{_PLACES}
SELECT DISTINCT * EXCLUDE (terminal_id) FROM (
  SELECT terminal_id, terminal_name, terminal_country, delivery_type, {_BY_MISS},
         CAST(sum(weight) AS BIGINT) AS consignment_total, {_sum("m.id IS NOT NULL", "miss_total")}, min(attempts.date) AS date
  FROM attempts JOIN places USING (terminal_id) LEFT JOIN t_misses m ON m.id = miss_id
  WHERE delivery_type = 'Box' OR kind IN ('DELIVERY', 'RETURN') GROUP BY ALL)""",
    "cancellation_category_pivot": f"""{_attempts("= DATE '1998-08-23'")}{_PLACES}
, reasons AS (
  SELECT attempts.*, c.cancellation_category AS reason,
         hour(timezone(run.timezone, timezone('UTC', c.date))) AS at_hour
  FROM attempts LEFT JOIN t_cancellations c ON c.id = cancellation_id
  LEFT JOIN t_routeopt_routes plan ON plan.id = attempts.routeopt_route_id
  LEFT JOIN t_routeopt_optimizations run ON run.id = plan.optimization_id)
SELECT DISTINCT * EXCLUDE (terminal_id) FROM (
  SELECT terminal_id, terminal_name, terminal_country, delivery_type, {_BY_REASON},
         {_sum("reason IS NOT NULL", "total_cancellations")}, CAST(sum(weight) AS BIGINT) AS total_consignments,
         min(reasons.date) AS date, {_sum(f"reason IN ({_OWN}) AND at_hour < 16", "own_before_16")},
         {_sum(f"reason IN ({_OWN}) AND at_hour IN (16, 17)", "own_between_16_18")},
         {_sum(f"reason IN ({_OWN}) AND at_hour > 17", "own_after_18")}
  FROM reasons JOIN places USING (terminal_id) GROUP BY ALL)""",
}
