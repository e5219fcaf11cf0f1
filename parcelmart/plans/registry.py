"""The published marts and how often each is refreshed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from parcelmart.functions.clock import AsOf
from parcelmart.plans import (
    billing,
    booking,
    cancelled,
    consumers,
    legs,
    lockers,
    quality,
    routes,
    unassigned,
)
from parcelmart.sources.scratch import fresh_folder
from parcelmart.sources.sinks import stamped, write_files, write_table
from parcelmart.sources.tables import Tables, with_intervals

MINUTE, TEN_MINUTES, HOUR, FOUR_HOURS, DAY = "1 minute", "10 minutes", "1 hour", "4 hours", "daily"
REPORTS, FEATURES = "reports", "features"


@dataclass(frozen=True)
class Mart:
    """One published table: plan, table name, cadence and refresh stamp."""

    key: str
    table: str
    cadence: str
    plan: Callable[[Tables, AsOf], DataFrame]
    stamp: bool = True
    schema: str = REPORTS


def _mart(plan, table: str, cadence: str, stamp: bool = True, schema: str = REPORTS) -> Mart:
    return Mart(plan.__name__, table, cadence, plan, stamp, schema)


MARTS: dict[str, Mart] = {
    mart.key: mart
    for mart in (
        _mart(booking.orders_booked_by_terminal_day, "generalized_orders_booked", MINUTE),
        _mart(booking.limits_from_today, "consignment_limit", MINUTE, stamp=False),
        _mart(booking.routes_saved_today, "routes_saved_today", MINUTE),
        _mart(booking.cutoff_by_group, "routing_deadline_today_all_zones", MINUTE),
        _mart(booking.planned_attempts_by_terminal_day, "e_commerce_todos", TEN_MINUTES),
        _mart(booking.planned_box_attempts, "planned_box_attempts", TEN_MINUTES),
        _mart(
            booking.events_last_48h_by_hour,
            "orders_created_last_48_hours_per_day_in_ecommerce",
            TEN_MINUTES,
        ),
        _mart(booking.orders_per_day_per_city, "orders_created_per_day_per_city", TEN_MINUTES),
        _mart(cancelled.cancellation_rate_per_day, "cancellation_per_day", TEN_MINUTES),
        _mart(cancelled.miss_category_pivot, "miss_category_per_city", TEN_MINUTES),
        _mart(
            cancelled.cancellation_category_pivot,
            "cancellation_category_per_date_and_city",
            TEN_MINUTES,
        ),
        _mart(billing.cross_country_billable, "billable_cross_country_per_country", TEN_MINUTES),
        _mart(
            booking.scheduled_by_group_merchant,
            "scheduled_orders_by_group_and_buyer",
            TEN_MINUTES,
        ),
        _mart(routes.plate_compare, "license_plate_validation", TEN_MINUTES, stamp=False),
        _mart(billing.multi_country_terminals, "nl_be_terminals_by_country_today", TEN_MINUTES),
        _mart(
            billing.billable_by_country_merchant,
            "billable_today_per_country_merchant",
            TEN_MINUTES,
        ),
        _mart(
            billing.billable_returns_by_country,
            "billable_returns_attempts_today_per_country",
            TEN_MINUTES,
        ),
        _mart(billing.returns_by_merchant_zone, "consumer_returns_today", TEN_MINUTES),
        _mart(quality.timeslots_due, "timeslots_due_today", TEN_MINUTES),
        _mart(lockers.new_events_last_24h, "new_locker_orders_last_24_hours", TEN_MINUTES),
        _mart(lockers.returns_present_vs_picked, "box_returns_today", TEN_MINUTES),
        _mart(lockers.returns_present, "box_returns_present_all_time", TEN_MINUTES),
        _mart(lockers.order_progress_over_time, "box_order_progress_over_time", TEN_MINUTES),
        _mart(lockers.lockers_with_info, "lockers_with_info", TEN_MINUTES),
        _mart(lockers.lockers_with_errors, "lockers_with_errors", TEN_MINUTES),
        _mart(routes.loading_inspection, "loading_inspection", TEN_MINUTES),
        _mart(lockers.box_status, "current_locker_status", TEN_MINUTES),
        _mart(lockers.boxes_per_locker, "boxes_per_locker", TEN_MINUTES),
        _mart(
            routes.ratings_in_routes_today,
            "ratings_per_country_in_routes_today",
            TEN_MINUTES,
            stamp=False,
        ),
        _mart(routes.due_vs_scanned, "parcel_due_today_vs_scanned", TEN_MINUTES),
        _mart(
            routes.scanning_progress,
            "scanning_progress_status_by_city_with_country_code",
            TEN_MINUTES,
        ),
        _mart(unassigned.orders_not_assigned, "orders_in_na", TEN_MINUTES),
        _mart(unassigned.orders_not_assigned_one_terminal, "orders_in_na_one_terminal", TEN_MINUTES),
        _mart(consumers.active_memberships, "counting_number_of_plus_membership", HOUR),
        _mart(consumers.consumer_order_stats, "app_consumer_orders_stats_by_country", HOUR),
        _mart(booking.ecommerce_orders_per_day, "orders_created_per_day_in_ecommerce", HOUR),
        _mart(
            routes.return_route_schedule,
            "schedule_of_return_merchant_routes_per_terminal_today",
            HOUR,
        ),
        _mart(booking.box_orders_per_day, "box_orders_created_per_day", HOUR),
        _mart(lockers.locker_information, "locker_information", HOUR),
        _mart(consumers.signups_over_time_clamped, "consumers_with_app_over_time", HOUR),
        _mart(consumers.new_cancellations_per_day, "counting_new_cancellations", HOUR),
        _mart(consumers.new_subscriptions_per_day, "counting_new_subscriptions", HOUR),
        _mart(billing.volume_statistics, "volume_statistics_today_per_country_and_city", HOUR),
        _mart(
            lockers.failed_attempts_by_locker,
            "failed_delivery_attempts_grouped_by_locker",
            HOUR,
            stamp=False,
        ),
        _mart(lockers.locker_fill_ratio, "lockers_current_degree_of_filling", HOUR),
        _mart(booking.on_demand_pickups, "on_demand_pickups", FOUR_HOURS),
        _mart(booking.on_demand_returns, "on_demand_returns", FOUR_HOURS),
        _mart(quality.terminal_list, "terminal_list", DAY),
        _mart(consumers.on_demand_merchants, "merchants_with_on_demand_pickups", DAY),
        _mart(consumers.push_activated, "consumers_push_activated", DAY),
        _mart(quality.avg_rating_merchant_zone, "average_rating_per_merchant_zone", DAY),
        _mart(quality.neighbour_deliveries_per_day, "deliveries_done_to_neighbours", DAY),
        _mart(lockers.old_undelivered, "old_box_parcels_that_are_not_delivered", DAY),
        _mart(quality.timeslot_success, "timeslot_success_over_time", DAY),
        _mart(quality.eta_vs_arrival, "eta_vs_time_of_arrival", DAY),
        _mart(quality.eta_vs_arrival_city, "eta_vs_time_of_arrival_per_city_last_week", DAY),
        _mart(
            quality.avg_rating_week, "average_rating_per_week_per_merchant_last_12_months", DAY
        ),
        _mart(
            quality.avg_rating_day, "average_rating_per_day_and_ecommerce_buyer_last_week", DAY
        ),
        _mart(consumers.push_delivered, "push_notification_delivered", DAY),
        _mart(lockers.due_vs_palletized, "box_parcel_due_today_added_to_pallet", TEN_MINUTES),
        _mart(lockers.locker_backlog, "locker_orders_backlog_by_locker", TEN_MINUTES),
        _mart(
            consumers.consumer_orders_by_merchant,
            "consumer_orders_by_merchant",
            DAY,
            stamp=False,
            schema=FEATURES,
        ),
        _mart(legs.stop_pairs, "start_stop_coordinates", DAY, stamp=False, schema=FEATURES),
        _mart(
            legs.drive_legs, "parcel_consignment_status_update", DAY, stamp=False, schema=FEATURES
        ),
    )
}

# Computed like marts but not published under a name of their own.
EXTRAS: dict[str, Callable[[Tables, AsOf], DataFrame]] = {
    plan.__name__: plan
    for plan in (unassigned.orders_not_assigned_union, legs.leg_time_features)
}


# Marts made of one extract, and how: a refresh of several computes it once.
SHARED: dict[str, tuple[Callable[[Tables, AsOf], DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "orders_not_assigned": (unassigned.not_assigned_by_day, unassigned.over_days),
    "orders_not_assigned_one_terminal": (unassigned.not_assigned_by_day, unassigned.of_terminal),
    "planned_attempts_by_terminal_day": (booking.planned_attempts_by_terminal_day, lambda df: df),
    "planned_box_attempts": (booking.planned_attempts_by_terminal_day, lambda df: df),
}


def _results(keys: Iterable[str], tables: Tables, as_of: AsOf) -> Iterator[tuple[str, DataFrame]]:
    """The marts as published; intervals and shared extracts are stored once for all of them."""
    keys = list(keys)
    tables.begin_refresh()
    tables = with_intervals(tables, fresh_folder(tables.spark, "interval-bounds"))
    uses = Counter(SHARED[key][0] for key in keys if key in SHARED)
    stored: dict[Callable, DataFrame] = {}
    for key in keys:
        extract, finish = SHARED.get(key, (None, None))
        if uses[extract] < 2:
            yield key, build(key, tables, as_of)
            continue
        if extract not in stored:
            path = fresh_folder(tables.spark, extract.__name__)
            extract(tables, as_of).write.parquet(path)
            stored[extract] = tables.spark.read.parquet(path)
        result = finish(stored[extract])
        yield key, stamped(result, as_of.now) if MARTS[key].stamp else result


def build(key: str, tables: Tables, as_of: AsOf) -> DataFrame:
    """A mart as it is published, with its refresh stamp if it carries one."""
    mart = MARTS[key]
    result = mart.plan(tables, as_of)
    return stamped(result, as_of.now) if mart.stamp else result


def refresh_files(
    keys: Iterable[str], tables: Tables, as_of: AsOf, root: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Publish a new version of the given marts' folders; returns them (read with ``sinks.published``).

    The source holds ``intervals`` and ``timestamps``; their bounds are resolved once for all marts.
    """
    return {
        key: write_files(result, f"{root}/{MARTS[key].schema}", MARTS[key].table, fmt)
        for key, result in _results(keys, tables, as_of)
    }


def refresh_tables(
    keys: Iterable[str], tables: Tables, as_of: AsOf, namespaces: dict[str, str]
) -> dict[str, str]:
    """Publish the given marts as catalog tables behind views, likewise."""
    return {
        key: write_table(result, MARTS[key].table, namespaces[MARTS[key].schema])
        for key, result in _results(keys, tables, as_of)
    }


def due(cadence: str) -> list[str]:
    return [key for key, mart in MARTS.items() if mart.cadence == cadence]
