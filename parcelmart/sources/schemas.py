"""Declared schemas of the operational and consumer tables (DDL strings)."""

POINT = "struct<x: double, y: double>"

OPERATIONS = {
    # Orders and parcels
    "orders": "id bigint, buyer_id bigint, locker_id bigint, delivery_postal_code_zone_id bigint,"
    " cancellation_id bigint, created_at timestamp_ntz, token string, cart_id string",
    "consignments": "id bigint, order_id bigint, date date, deadline timestamp_ntz, type string,"
    " cancellation_id bigint, miss_id bigint, interval_id bigint",
    "locker_consignments": "id bigint, order_id bigint, estimated_interval_id bigint,"
    " consignment_type string, cancellation_id bigint, miss_id bigint,"
    " parcel_box_assignment_id bigint",
    "parcels": "id bigint, order_id bigint, type string, visible boolean,"
    " recall_requested_at timestamp_ntz, recall_reason string, created_at timestamp_ntz,"
    " machine_dimensions_id bigint",
    "parcel_consignments": "parcel_id bigint, consignment_id bigint",
    "parcel_status_updates": "id bigint, consignment_id bigint, parcel_status_id int,"
    " date timestamp_ntz, user_id bigint, with_neighbour boolean",
    "parcel_box_assignments": "id bigint, parcel_id bigint, box_id bigint, state string,"
    " picked_up timestamp_ntz, reservation_expires_at timestamp_ntz",
    "scanning_log": "id bigint, parcel_id bigint, user_id bigint, date timestamp_ntz",
    "cancellations": "id bigint, cancellation_category string, date timestamp_ntz",
    "misses": "id bigint, category string",
    "ratings": "id bigint, consignment_id bigint, score int, rating_category string",
    "dimensions": "id bigint, sorting_deviation string",
    "on_demand_pickups": "order_id bigint, estimated_parcels int",
    "slot_payments": "consignment_id bigint, status string, purchase_type string,"
    " reference string",
    # Routes, stops, pallets
    "routes": "id bigint, due_date date, type string, terminal string, city string, title string,"
    " vehicle_type string, owner_operator_id bigint, routeopt_route_id bigint",
    "consumer_stops": "id bigint, route_id bigint, sequence int, address_id bigint,"
    " estimated_interval_id bigint",
    "terminal_stops": "id bigint, route_id bigint, sequence int, address_id bigint,"
    " estimated_interval_id bigint",
    "consumer_stop_consignments": "id bigint, consumer_stop_id bigint, consignment_id bigint,"
    " type string",
    "terminal_stop_consignments": "terminal_stop_id bigint, consignment_id bigint",
    "locker_stops": "stop_id bigint, locker_id bigint",
    "locker_pallets": "id bigint, route_id bigint, locker_id bigint",
    "locker_pallet_parcels": "id bigint, locker_pallet_id bigint, parcel_id bigint",
    "pallets": "id bigint, identifier string, created_at timestamp_ntz",
    "pallet_parcels": "pallet_id bigint, parcel_id bigint",
    "return_pallet_details": "merchant_id bigint, route_id bigint, pallet_id bigint",
    "intervals": "id bigint, start_timestamp_id bigint, stop_timestamp_id bigint",
    "timestamps": "id bigint, date timestamp_ntz",
    "user_routes": "route_id bigint, user_id bigint",
    "route_history": "id bigint, route_child_id bigint",
    "route_vehicle_images": "route_id bigint, license_plate string, image_id bigint",
    "images": "id bigint, url string",
    "routeopt_service_time_data": "route_id bigint, consumer_stop_id bigint,"
    " terminal_stop_id bigint, departure_time timestamp_ntz, arrival_time timestamp_ntz",
    "routeopt_drive_time_data": "route_id bigint, from_consumer_stop_id bigint,"
    " to_consumer_stop_id bigint, terminal_stop_id bigint, estimated_drive_time double,"
    " distance double",
    "routeopt_routes": "id bigint, optimization_id bigint, routeopt_vehicle_and_user_id bigint",
    "routeopt_optimizations": "id bigint, timezone string, optimization_settings_id bigint",
    "routeopt_settings": "id bigint, routeopt_graph_settings_id bigint",
    "routeopt_graph_settings": "id bigint, drive_time_factor double,"
    " initial_drive_time_factor double",
    "routeopt_vehicles_and_users": "id bigint, vehicle_id bigint,"
    " routeopt_vehicle_and_user_settings_id bigint",
    "routeopt_vehicles_and_users_settings": "id bigint, user_optimization_settings_id bigint",
    "user_optimization_settings": "id bigint, user_type string, drive_time_factor double",
    "vehicles": "id bigint, license_plate string",
    "routeopt_groups": "id bigint, title string, city string, terminal_code string,"
    " routeopt_group_settings_id bigint, deleted_at timestamp_ntz",
    "routeopt_group_settings": "id bigint, delivery_day string",
    "routeopt_group_settings_consignment_types": "routeopt_group_settings_id bigint,"
    " consignment_type string",
    # Master data
    "postal_code_zones": "id bigint, title string, city string, country_code string, type string,"
    " terminal_id bigint, deleted_at timestamp_ntz",
    "warehouses": "id bigint, name string, code string, city string, address_id bigint,"
    " created_at timestamp_ntz, deleted_at timestamp_ntz,"
    " sorting_machine_assign_direction string, sorting_machine_books_delivery boolean,"
    " sorting_machine_maximum_routes_per_lane int,"
    " sorting_machine_minimum_routes_per_lane int",
    "addresses": "id bigint, street string, postal_code string, city string,"
    f" country_code string, coordinate {POINT}",
    "buyers": "id bigint, name string, external_name string, buyer_settings_id bigint,"
    " deleted_at timestamp_ntz",
    "buyer_settings": "id bigint, on_demand_pickup boolean",
    "buyer_tags": "buyer_id bigint, tag_id bigint",
    "tags": "id bigint, tag_type_id bigint, name string",
    "lockers": "id bigint, identifier string, name string, city string, country string,"
    f" street string, enabled boolean, coordinate {POINT}, installation_date date,"
    " collection_point_id bigint, postal_code_zone_id bigint, location_partner_id bigint,"
    " deleted_at timestamp_ntz",
    "locker_boxes": "id bigint, locker_id bigint, board_id int, slot_id int, size string,"
    " error_code string",
    "locker_location_partners": "id bigint, name string",
    "users": "id bigint, first_name string, last_name string, phone_number string,"
    " user_settings_id bigint",
    "user_settings": "id bigint, warehouse_id bigint",
    "owner_operators": "id bigint, name string",
    "owner_operator_users": "user_id bigint, owner_operator_id bigint",
    "collection_points": "id bigint, deleted_at timestamp_ntz",
    "collection_point_intervals": "id bigint, collection_point_id bigint,"
    " routeopt_group_id bigint, delivery_day string, collection_start int,"
    " routing_cutoff_seconds int, deleted_at timestamp_ntz",
    "buyer_collection_points": "buyer_id bigint, collection_point_id bigint",
    "collection_point_schedules": "id bigint, pickup_collection_point_id bigint,"
    " pickup_day string, pickup_time_end int",
    "recurring_pickup_schedule": "id bigint, name string, start_terminal_id bigint,"
    " deleted_at timestamp_ntz",
    "recurring_pickup_schedule_merchant_schedules": "id bigint,"
    " collection_point_schedule_id bigint, recurring_pickup_route_id bigint",
    "chrono_consignment_limits": "id bigint, terminal string, date date,"
    " maximum_number_of_consignments int, block_direct_checkout_merchants boolean",
    "sms_notifications": "id bigint, message_id string, sent timestamp_ntz,"
    " delivered timestamp_ntz",
    # Kept beside the two lookup tables: interval ids with both ends resolved.
    "interval_bounds": "id bigint, start_ts timestamp_ntz, stop_ts timestamp_ntz",
}

CONSUMERS = {
    "consumer": "id bigint, consumer_id bigint, push_notification_token string,"
    " created_at timestamp_ntz",
    "consumer_order": "consumer_id bigint, order_id bigint",
    "timeslot_subscription": "id bigint, consumer_id bigint, active boolean,"
    " valid_to timestamp_ntz, cancelled_at timestamp_ntz, created_at timestamp_ntz",
}

DATABASES = {"operations": OPERATIONS, "consumers": CONSUMERS}


def schema_of(table: str) -> str:
    for tables in DATABASES.values():
        if table in tables:
            return tables[table]
    raise KeyError(table)


def database_of(table: str) -> str:
    for database, tables in DATABASES.items():
        if table in tables:
            return database
    raise KeyError(table)
