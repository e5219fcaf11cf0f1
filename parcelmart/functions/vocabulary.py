"""Fixed values of the delivery domain."""

TO_DOOR = "TO_DOOR"
TO_LOCKER = "TO_LOCKER"
DISTRIBUTION = "DISTRIBUTION"
LOCKER = "LOCKER"
MERCHANT = "MERCHANT"
DELIVERY = "DELIVERY"
RETURN = "RETURN"
ATTEMPT_TYPES = (DELIVERY, RETURN)
PRESENT = "PRESENT"
PICKED_UP = "PICKED_UP"
RESERVED = "RESERVED"

E_COMMERCE_TAG = 2
TEST_ZONE = 111
TEST_CITY = "OTHER"
INTERNAL_BUYER = 11
UNASSIGNED_EXCLUDED_BUYERS = (476, 1050, 1051, 1052, 1459)

# Parcel status codes.
COLLECTED = 2
DELIVERED = 3
MISSED = 8
RETURN_LABEL_COLLECTED = 10

# Fixed list: why a delivery attempt was missed.
MISS_CATEGORIES = (
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

# Deployment setting: the category of parcels the operator has damaged, which
# carries the operator's name; real rows count only once it is set.
OPERATOR_DAMAGE = "DAMAGED_PARCEL_BY_OPERATOR"

# Fixed list: why an order or attempt was cancelled.
CANCELLATION_CATEGORIES = (
    "CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT",
    "CONSUMER_WANTS_TO_CANCEL_BOX_RESERVATION",
    OPERATOR_DAMAGE,
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

# Fixed list: categories reported under another category's column.
MERGED_CANCELLATIONS = {
    "CONSUMER_WANTS_TO_CANCEL_BOX_RESERVATION": "CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT",
    "CONVERTED_TO_HOME_DELIVERY": "CONSUMER_WANTS_TO_CHANGE_DELIVERY_TYPE",
}

# Fixed list: cancellations that are not the operator's doing (left out of the rate).
EXTERNAL_CANCELLATIONS = (
    "REQUESTED_BY_TRANSPORT_BUYER",
    "DELAYED_FROM_MERCHANT",
    "CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT",
    "WRONG_OR_INCOMPLETE_ADDRESS",
    "DAMAGED_PARCEL_BY_MERCHANT",
    "CONSUMER_WANTS_TO_CANCEL_BOX_RESERVATION",
)

# Fixed list: cancellations the operator answers for (hour-of-day buckets).
OPERATOR_CANCELLATIONS = (
    OPERATOR_DAMAGE,
    "DAMAGED_PARCEL_BY_COURIER",
    "DELAYED_DRIVER",
    "OTHER",
    "PARCEL_IN_WRONG_CITY",
    "CANCELLED_ROUTE",
    "PREMATURE_ROUTE_FINISH",
    "WRONG_SORTED_PARCEL",
    "VEHICLE_MALFUNCTION",
    "WRONG_OR_INCOMPLETE_ADDRESS",
)

# Fixed list: late cancellations that are still billed to the merchant.
BILLABLE_CANCELLATIONS = (
    "REQUESTED_BY_TRANSPORT_BUYER",
    "DELAYED_FROM_MERCHANT",
    "CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT",
    "WRONG_OR_INCOMPLETE_ADDRESS",
    "DAMAGED_PARCEL_BY_MERCHANT",
)

# Fixed list: late cancellations of returns that are still billed.
BILLABLE_RETURN_CANCELLATIONS = (
    "REQUESTED_BY_MERCHANT",
    "REQUESTED_BY_TRANSPORT_BUYER",
    "CONSUMER_WANTS_TO_CANCEL_CONSIGNMENT",
)

# Locker box sizes in millimetres.
BOX_SIZES = (
    "BOX_265_100_600",
    "BOX_265_150_600",
    "BOX_265_225_600",
    "BOX_400_300_600",
)

# Local time zone by country.
COUNTRY_ZONES = {
    "SE": "Europe/Stockholm",
    "NL": "Europe/Amsterdam",
    "FI": "Europe/Helsinki",
    "DK": "Europe/Copenhagen",
    "BE": "Europe/Brussels",
}

TIMESLOT_JSON_PATH = "$.timeWindow.timeslotSpec"
LIST_SEPARATOR = "   |   "
UNLOADING = "UNLOADING_OF_PARCELS"
PUSH_PREFIX = "projects/"

# Deployment settings: text patterns and link prefix of the operator, and the
# terminal that the one-terminal listing is for (none: it cannot be built).
UNASSIGNED_TERMINAL: str | None = None
BOX_MERCHANT_PATTERN = "%Box Merchant%"
OWN_FLEET_PATTERN = "%own fleet%"
ADMIN_URL = "https://admin.example/"
