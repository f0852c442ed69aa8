"""Target schemas and name rules of the trip-record tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

from weftline.operators.conform import Contract

# Column names, types and order of the trip table; synonyms of the raw files.

TRIP_COLUMNS = """
    taxi_type string NOT NULL,
    year int NOT NULL,
    filename string NOT NULL,
    dispatching_base_num string,
    hvfhs_license_num string,
    vendor_id string,
    vendor_name string,
    request_datetime timestamp,
    on_scene_datetime timestamp,
    pickup_datetime timestamp,
    pickup_location_id string,
    pickup_latitude decimal(9,5),
    pickup_longitude decimal(9,5),
    dropoff_datetime timestamp,
    dropoff_location_id string,
    dropoff_latitude decimal(9,5),
    dropoff_longitude decimal(9,5),
    passenger_count int,
    trip_distance decimal(9,5),
    trip_type string,
    payment_type string,
    rate_code string,
    shared_ride string,
    shared_match string,
    store_and_forward string,
    access_a_ride string,
    wav_request string,
    wav_match string,
    fare_amount decimal(8,2),
    extra decimal(8,2),
    mta_tax decimal(8,2),
    tip_amount decimal(8,2),
    tolls_amount decimal(8,2),
    improvement_surcharge decimal(8,2),
    congestion_surcharge decimal(8,2),
    airport_fee decimal(8,2),
    ehail_fee decimal(8,2),
    total_amount decimal(8,2),
    driver_pay decimal(8,2)
"""

TRIP_SYNONYMS = {
    "dolocationid": "dropoff_location_id",
    "end_lat": "dropoff_latitude",
    "end_lon": "dropoff_longitude",
    "fare_amt": "fare_amount",
    "locationid": "pickup_location_id",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "pickup_date": "pickup_datetime",
    "pulocationid": "pickup_location_id",
    "ratecodeid": "rate_code",
    "sr_flag": "shared_ride",
    "start_lat": "pickup_latitude",
    "start_lon": "pickup_longitude",
    "store_and_fwd_flag": "store_and_forward",
    "surcharge": "improvement_surcharge",
    "tip_amt": "tip_amount",
    "tolls_amt": "tolls_amount",
    "total_amt": "total_amount",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "tpep_pickup_datetime": "pickup_datetime",
    "trip_dropoff_datetime": "dropoff_datetime",
    "trip_pickup_datetime": "pickup_datetime",
    "vendorid": "vendor_id",
    "trip_miles": "trip_distance",
    "base_passenger_fare": "fare_amount",
    "tolls": "tolls_amount",
    "sales_tax": "mta_tax",
    "tips": "tip_amount",
    "shared_request_flag": "shared_ride",
    "shared_match_flag": "shared_match",
    "access_a_ride_flag": "access_a_ride",
    "wav_request_flag": "wav_request",
    "wav_match_flag": "wav_match",
}

# Columns of the older, CSV-fed table; it calls the surcharge column ``surcharge``.
OLDER_TRIP_COLUMNS = """
    taxi_type string NOT NULL,
    year int NOT NULL,
    filename string NOT NULL,
    dispatching_base_num string,
    vendor_id string,
    vendor_name string,
    pickup_datetime timestamp,
    pickup_location_id string,
    pickup_latitude decimal(9,5),
    pickup_longitude decimal(9,5),
    dropoff_datetime timestamp,
    dropoff_location_id string,
    dropoff_latitude decimal(9,5),
    dropoff_longitude decimal(9,5),
    passenger_count int,
    trip_distance decimal(9,5),
    trip_type string,
    payment_type string,
    rate_code string,
    shared_ride string,
    store_and_forward string,
    fare_amount decimal(8,2),
    extra decimal(8,2),
    mta_tax decimal(8,2),
    tip_amount decimal(8,2),
    tolls_amount decimal(8,2),
    surcharge decimal(8,2),
    ehail_fee decimal(8,2),
    total_amount decimal(8,2)
"""

# Names that only the newer table's map has.
_NEWER_ONLY = {
    "surcharge",
    "trip_miles",
    "base_passenger_fare",
    "tolls",
    "sales_tax",
    "tips",
    "shared_request_flag",
    "shared_match_flag",
    "access_a_ride_flag",
    "wav_request_flag",
    "wav_match_flag",
}
# End of fixed values.

OLDER_TRIP_SYNONYMS = {k: v for k, v in TRIP_SYNONYMS.items() if k not in _NEWER_ONLY} | {
    "improvement_surcharge": "surcharge"
}


def _contract(columns: str, synonyms: dict[str, str]) -> Contract:
    return Contract(
        schema=T.StructType.fromDDL(columns),
        synonyms=synonyms,
        partition_by=("taxi_type", "year"),
        year_of=("year", "pickup_datetime"),
    )


@cache
def trips() -> Contract:
    """The trip table; needs a running session, which parses the column list."""
    return _contract(TRIP_COLUMNS, TRIP_SYNONYMS)


@cache
def older_trips() -> Contract:
    """The older trip table fed from CSV files."""
    return _contract(OLDER_TRIP_COLUMNS, OLDER_TRIP_SYNONYMS)
