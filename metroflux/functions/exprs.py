"""Scalar column library: every derived domain expression of the warehouse.

All functions take and return ``Column`` objects built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source system's codes and labels.
# ---------------------------------------------------------------------------

# Weather category from a WMO weather code (inclusive ranges, first match wins).
WEATHER_CATEGORY_RULES = [
    ("Clear", [0, 1], None),
    ("Cloudy", [2, 3], None),
    ("Fog", [45, 48], None),
    ("Drizzle", None, (51, 57)),
    ("Rain", None, (61, 67)),
    ("Snow", None, (71, 77)),
    ("Rain Showers", None, (80, 82)),
    ("Snow Showers", None, (85, 86)),
    ("Thunderstorm", None, (95, None)),
]
WEATHER_CATEGORIES = ["Clear", "Cloudy", "Fog", "Drizzle", "Rain", "Snow",
                      "Rain Showers", "Snow Showers", "Thunderstorm", "Unknown"]

# GTFS route_type codes.
ROUTE_TYPE_DESC = {0: "Tram/Streetcar", 1: "Subway/Metro", 2: "Rail", 3: "Bus",
                   4: "Ferry", 5: "Cable Tram", 6: "Aerial Lift", 7: "Funicular",
                   11: "Trolleybus", 12: "Monorail"}
ROUTE_TYPE_OTHER = "Other"

# GTFS-realtime VehicleStopStatus and OccupancyStatus codes.
VEHICLE_STATUS_DESC = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
OCCUPANCY_DESC = {0: "EMPTY", 1: "MANY_SEATS", 2: "FEW_SEATS", 3: "STANDING_ONLY",
                  4: "CRUSHED", 5: "FULL", 6: "NOT_ACCEPTING"}
UNKNOWN = "UNKNOWN"

# GTFS direction_id.
DIRECTION_LABEL = {0: "Outbound", 1: "Inbound"}
DIRECTION_OTHER = "Unknown"

# Occupancy buckets: name -> occupancy codes counted.  4 and 6 are in none.
OCCUPANCY_BUCKETS = [
    ("empty_count", [0]),
    ("many_seats_count", [1]),
    ("few_seats_count", [2]),
    ("standing_count", [3]),
    ("full_count", [5]),
    ("overcrowded_count", [3, 5]),
    ("underused_count", [0, 1]),
]
OVERCROWDED_CODES = [3, 5]
UNDERUSED_CODES = [0, 1]

# Peak periods by local hour (inclusive).
AM_PEAK_HOURS = (6, 9)
PM_PEAK_HOURS = (15, 18)
TIME_PERIODS = ["AM Peak", "PM Peak", "Off Peak"]

# Day type: Spark dayofweek Sunday=1 ... Saturday=7.
WEEKEND_DAYS = [1, 7]

# Surrogate-key null token and separator of the public dbt_utils macro.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# Local zone of the network.
LOCAL_TZ = "America/Montreal"


# ---------------------------------------------------------------------------
# Decoders
# ---------------------------------------------------------------------------

def decode(c: Column, mapping: dict, default: str) -> Column:
    """Simple CASE x WHEN k THEN v ... ELSE default."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def weather_category(code: Column) -> Column:
    """Category label of a numeric weather code; gaps and NULL are Unknown."""
    out = None
    for label, members, rng in WEATHER_CATEGORY_RULES:
        if members is not None:
            cond = code.isin(members)
        elif rng[1] is None:
            cond = code >= F.lit(rng[0])
        else:
            cond = code.between(rng[0], rng[1])
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit("Unknown"))


def route_type_desc(route_type: Column) -> Column:
    return decode(route_type, ROUTE_TYPE_DESC, ROUTE_TYPE_OTHER)


def vehicle_status_desc(status: Column) -> Column:
    return decode(status, VEHICLE_STATUS_DESC, UNKNOWN)


def occupancy_desc(occ: Column) -> Column:
    return decode(occ, OCCUPANCY_DESC, UNKNOWN)


def direction_label(direction_id: Column) -> Column:
    return decode(direction_id, DIRECTION_LABEL, DIRECTION_OTHER)


def hex_color(c: Column) -> Column:
    """'#'+upper(colour) for a non-empty colour, else NULL."""
    return F.when(c.isNotNull() & (c != F.lit("")), F.concat(F.lit("#"), F.upper(c)))


def mps_to_kmh(speed: Column) -> Column:
    """Metres per second to km/h, one decimal (half-up)."""
    return F.round(speed * F.lit(3.6), 1)


def service_pattern(mon, tue, wed, thu, fri, sat, sun) -> Column:
    weekdays = mon + tue + wed + thu + fri
    weekend = sat + sun
    return (F.when((weekdays == 5) & (weekend == 0), F.lit("Weekday"))
            .when((weekdays == 0) & (weekend > 0), F.lit("Weekend"))
            .when(weekdays + weekend == 7, F.lit("Daily"))
            .otherwise(F.lit("Custom")))


def time_period(hour: Column) -> Column:
    return (F.when(hour.between(*AM_PEAK_HOURS), F.lit("AM Peak"))
            .when(hour.between(*PM_PEAK_HOURS), F.lit("PM Peak"))
            .otherwise(F.lit("Off Peak")))


def day_type(date: Column) -> Column:
    return F.when(F.dayofweek(date).isin(WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(WEEKEND_DAYS)


def to_local(ts_utc: Column, tz: str = LOCAL_TZ) -> Column:
    """UTC instant -> local wall clock (timestamp_ntz).  Needs a UTC session."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts_utc)


def surrogate_key(*cols: Column) -> Column:
    """md5 of the '-'-joined string casts, NULL replaced by a fixed token."""
    parts = [F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


# ---------------------------------------------------------------------------
# Safe casts (ANSI mode stays on: malformed strings become NULL, not errors)
# ---------------------------------------------------------------------------

def to_int(c: Column) -> Column:
    return c.try_cast("int")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_ts(c: Column) -> Column:
    return c.try_cast("timestamp")


def finite(c: Column) -> Column:
    """The number, or NULL for NaN and infinities (NaN compares above all numbers)."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_date_fmt(c: Column, fmt: str = "yyyyMMdd") -> Column:
    return F.try_to_date(c, fmt)


# ---------------------------------------------------------------------------
# Aggregate building blocks (additive measures)
# ---------------------------------------------------------------------------

def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as a bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def occupancy_bucket_aggs(occ: Column) -> list[Column]:
    return [count_if(occ.isin(codes)).alias(name) for name, codes in OCCUPANCY_BUCKETS]


def exact_sum_1dp(c: Column) -> Column:
    """Sum of a one-decimal measure, computed exactly in tenths.

    Speeds are rounded to one decimal in staging, so the sum is a whole
    number of tenths.  Summing integers makes the result independent of
    partitioning and task order (a double sum drifts with both).
    """
    return F.sum(F.round(c * F.lit(10)).cast("long")) / F.lit(10.0)


def rounded_avg(c: Column, scale: int) -> Column:
    """round(avg, scale) made stable at near-ties: snap to 6 dp first."""
    return F.round(F.round(F.avg(c), 6), scale)


def ratio(num: Column, den: Column) -> Column:
    """num/den as double, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))
