"""Names, cut points and codes that results depend on."""

from __future__ import annotations

# Temperature bands (degrees F), coldest first, left-closed cuts.
TEMP_BANDS = ("Freezing", "Cold", "Mild", "Warm", "Hot")
TEMP_CUTS = (32, 50, 68, 85)

# Flat-rate airport rate codes, guard and passenger limits.
AIRPORT_RATECODES = (2, 3)
MIN_DURATION_MIN = 1.0
PASSENGERS_MIN, PASSENGERS_MAX, PASSENGERS_DEFAULT = 1, 6, 1

# Dashboard caps per service (dollars, miles).
DASHBOARD_CAPS = {
    "Green": {"fare": 46.0, "distance": 14.19},
    "Yellow": {"fare": 52.0, "distance": 18.76},
}

# Sphere radii for great-circle distances.
EARTH_RADIUS_M = 6_371_000.0
EARTH_RADIUS_MI = 3_959.0

# The 22 columns of a prepared sample, in order.
MODEL_COLUMNS = (
    "tripid", "pickup_datetime", "fare_capped", "fare_amount", "trip_distance",
    "distance_capped", "trip_duration_min", "passenger_count", "temperature",
    "pickup_hour", "pickup_dow", "service_type", "pickup_borough",
    "dropoff_borough", "pickup_zone", "dropoff_zone", "temp_band",
    "is_airport_trip", "ratecodeid", "humidity", "windSpeed", "visibility",
)

# Columns a model must not read, by reason.
LEAKAGE_COLUMNS = (
    "tip_amount", "total_amount", "mta_tax", "tolls_amount",
    "improvement_surcharge", "extra", "revenue_per_mile", "has_tip",
    "tip_pct_of_fare", "payment_type", "payment_type_description",
)
SUPERSEDED_COLUMNS = (
    "fare_amount", "trip_distance", "temperature", "ratecodeid", "pickup_zone",
    "dropoff_zone",
)
IDENTIFIER_COLUMNS = (
    "tripid", "pickup_datetime", "vendorid", "store_and_fwd_flag",
    "climate_date", "mjd", "pickup_locationid", "dropoff_locationid",
    "pickup_date",
)

# Model column groups.
TARGET = "fare_capped"
CORRIDOR = "od_corridor"
CLIMATE_DECIMALS = ("humidity", "windSpeed", "visibility")
NUMERIC_FEATURES = (
    "distance_capped", "trip_duration_min", "passenger_count", "pickup_dow",
    "humidity", "windSpeed", "visibility", "pickup_hour_sin",
    "pickup_hour_cos", "temp_band_ord",
)
BINARY_FEATURES = ("is_airport_trip",)
ONE_HOT_FEATURES = ("service_type", "pickup_borough", "dropoff_borough")
TARGET_ENCODED_FEATURES = (CORRIDOR,)

# Money columns of a trip, fare first, total last.
MONEY_COLUMNS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount",
)

# Defaults of the modelling protocol.
SEED = 42
FOLDS = 5
SMOOTHING = 5.0
HOLDOUT_FRACTION = 0.2
STRATA = ("service_type", "temp_band")
