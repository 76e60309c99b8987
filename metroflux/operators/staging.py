"""Staging layer: typed, cleaned projections of one bronze table each.

Each function is ``DataFrame -> DataFrame`` and lazy (a staging "view").
Casts are ``try_cast``-style: a malformed string becomes NULL instead of
aborting the whole job under ANSI mode; ``quality.cast_failures`` reports
such rows for the quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.functions import exprs as X

C = F.col


def stg_vehicle_positions(bronze: DataFrame, tz: str = X.LOCAL_TZ, keep_utc: bool = False) -> DataFrame:
    """Required ids/coords kept, speed to km/h (NULL unless finite), UTC instant to local time.

    ``keep_utc`` adds ``_event_timestamp_utc`` so a caller can deduplicate
    on the instant instead of the local wall clock (which repeats in the
    autumn DST fold).
    """
    kept = bronze.where(C("bus_id").isNotNull() & C("latitude").isNotNull() & C("longitude").isNotNull())
    # Localise once; date and hour derive from the local wall clock.
    local = kept.select("*", X.to_local(C("event_timestamp"), tz).alias("_local_ts"))
    return local.select(
        "bus_id", "trip_id", "route_id", "start_time", "start_date",
        "latitude", "longitude",
        X.mps_to_kmh(X.finite(C("speed"))).alias("speed"),
        "bearing", "current_status", "occupancy_status",
        C("_local_ts").alias("event_timestamp"),
        C("_local_ts").cast("date").alias("event_date"),
        F.hour("_local_ts").alias("event_hour"),
        C("ingestion_file").alias("_source_file"),
        C("ingestion_timestamp").alias("_ingestion_timestamp"),
        C("ingestion_date").alias("_ingestion_date"),
        C("batch_id").alias("_batch_id"),
        *([C("event_timestamp").alias("_event_timestamp_utc")] if keep_utc else []),
    )


def stg_weather(bronze: DataFrame) -> DataFrame:
    obs = X.to_ts(C("observation_time"))
    code = X.to_int(C("weather_code"))
    return bronze.where(C("observation_time").isNotNull()).select(
        obs.alias("observation_time"),
        C("observation_time").try_cast("date").alias("observation_date"),
        F.hour(obs).alias("observation_hour"),
        X.to_double(C("temperature")).alias("temperature_c"),
        X.to_double(C("feels_like")).alias("feels_like_c"),
        X.to_int(C("humidity")).alias("humidity_pct"),
        X.to_double(C("wind_speed")).alias("wind_speed_kmh"),
        X.to_int(C("wind_direction")).alias("wind_direction_deg"),
        X.to_double(C("precipitation")).alias("precipitation_mm"),
        code.alias("weather_code"),
        "weather_description",
        X.weather_category(code).alias("weather_category"),
        "_source_file", "_ingestion_timestamp", "_ingestion_date",
    )


def stg_routes(bronze: DataFrame) -> DataFrame:
    return bronze.where(C("route_id").isNotNull()).select(
        "route_id", "agency_id", "route_short_name", "route_long_name",
        X.to_int(C("route_type")).alias("route_type"),
        "route_url",
        X.hex_color(C("route_color")).alias("route_color_hex"),
        X.hex_color(C("route_text_color")).alias("route_text_color_hex"),
        "_source_file", "_ingestion_timestamp",
    )


def stg_stops(bronze: DataFrame) -> DataFrame:
    return bronze.where(C("stop_id").isNotNull()).select(
        "stop_id", "stop_code", "stop_name",
        X.to_double(C("stop_lat")).alias("stop_lat"),
        X.to_double(C("stop_lon")).alias("stop_lon"),
        "stop_url",
        X.to_int(C("location_type")).alias("location_type"),
        F.nullif(C("parent_station"), F.lit("")).alias("parent_station"),
        X.to_int(C("wheelchair_boarding")).alias("wheelchair_boarding"),
        "_source_file", "_ingestion_timestamp",
    )


def stg_trips(bronze: DataFrame) -> DataFrame:
    return bronze.where(C("trip_id").isNotNull()).select(
        "trip_id", "route_id", "service_id", "shape_id", "trip_headsign",
        X.to_int(C("direction_id")).alias("direction_id"),
        "note_en", "note_fr", "_source_file", "_ingestion_timestamp",
    )


def stg_stop_times(bronze: DataFrame) -> DataFrame:
    """Clock times stay strings: GTFS allows 25:10:00 for after-midnight runs."""
    return bronze.where(C("trip_id").isNotNull() & C("stop_id").isNotNull()).select(
        "trip_id", "stop_id", "arrival_time", "departure_time",
        X.to_int(C("stop_sequence")).alias("stop_sequence"),
        X.to_int(C("pickup_type")).alias("pickup_type"),
        X.to_int(C("drop_off_type")).alias("drop_off_type"),
        "_source_file", "_ingestion_timestamp",
    )


DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def stg_calendar(bronze: DataFrame) -> DataFrame:
    return bronze.where(C("service_id").isNotNull()).select(
        "service_id",
        *[X.to_int(C(d)).alias(d) for d in DAYS],
        X.to_date_fmt(C("start_date")).alias("start_date"),
        X.to_date_fmt(C("end_date")).alias("end_date"),
        "_source_file", "_ingestion_timestamp",
    )


def stg_calendar_dates(bronze: DataFrame) -> DataFrame:
    return bronze.where(C("service_id").isNotNull()).select(
        "service_id",
        X.to_date_fmt(C("date")).alias("exception_date"),
        X.to_int(C("exception_type")).alias("exception_type"),
        "_source_file", "_ingestion_timestamp",
    )


def stg_shapes(bronze: DataFrame) -> DataFrame:
    return bronze.where(C("shape_id").isNotNull()).select(
        "shape_id",
        X.to_double(C("shape_pt_lat")).alias("shape_pt_lat"),
        X.to_double(C("shape_pt_lon")).alias("shape_pt_lon"),
        X.to_int(C("shape_pt_sequence")).alias("shape_pt_sequence"),
        "_source_file", "_ingestion_timestamp",
    )


def stg_agency(bronze: DataFrame) -> DataFrame:
    return bronze.where(C("agency_id").isNotNull()).select(
        "agency_id", "agency_name", "agency_url", "agency_timezone",
        "agency_lang", "agency_phone", "_source_file", "_ingestion_timestamp",
    )


def staging_casts() -> dict:
    """bronze table -> (record key, {column: staging cast}) for cast-failure reports."""
    to_int, to_dbl = X.to_int, X.to_double
    return {
        "weather": ("observation_time", {
            "observation_time": X.to_ts, "temperature": to_dbl, "feels_like": to_dbl, "humidity": to_int,
            "wind_speed": to_dbl, "wind_direction": to_int, "precipitation": to_dbl, "weather_code": to_int}),
        "gtfs_routes": ("route_id", {"route_type": to_int}),
        "gtfs_stops": ("stop_id", {"stop_lat": to_dbl, "stop_lon": to_dbl, "location_type": to_int,
                                   "wheelchair_boarding": to_int}),
        "gtfs_trips": ("trip_id", {"direction_id": to_int}),
        "gtfs_stop_times": ("trip_id", {"stop_sequence": to_int, "pickup_type": to_int, "drop_off_type": to_int}),
        "gtfs_calendar": ("service_id", {**{d: to_int for d in DAYS}, "start_date": X.to_date_fmt,
                                         "end_date": X.to_date_fmt}),
        "gtfs_calendar_dates": ("service_id", {"date": X.to_date_fmt, "exception_type": to_int}),
        "gtfs_shapes": ("shape_id", {"shape_pt_lat": to_dbl, "shape_pt_lon": to_dbl, "shape_pt_sequence": to_int}),
    }
