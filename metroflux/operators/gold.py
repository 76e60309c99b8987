"""Gold layer: additive facts for BI plus their reusable sub-operators.

Only counts and sums are stored; ratios are computed by readers
(``metrics``) so they stay correct at any roll-up level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.functions import exprs as X

C = F.col

# HAVING thresholds of the source models.
FLEET_MIN_POSITIONS = 10
HOURLY_MIN_POSITIONS = 5


# ---------------------------------------------------------------------------
# Weather sub-operators (D6-D8), fused into one daily frame
# ---------------------------------------------------------------------------

def dominant_weather(stg_weather: DataFrame) -> DataFrame:
    """Most frequent category per day; ties go to the alphabetically first.

    Counting per (day, category) then picking ``min_by(category,
    (-count, category))`` is one aggregate per level, no window sort.
    """
    counts = stg_weather.groupBy("observation_date", "weather_category").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.groupBy("observation_date").agg(
        F.min_by("weather_category", F.struct(-C("cnt"), C("weather_category"))).alias("dominant_weather"))


def snow_hours(stg_weather: DataFrame) -> DataFrame:
    """Observation rows per day whose category is exactly 'Snow'."""
    return stg_weather.groupBy("observation_date").agg(
        X.count_if(C("weather_category") == "Snow").alias("snow_hours"))


def daily_weather(stg_weather: DataFrame) -> DataFrame:
    """Weather averages per day (temperature/wind 1 dp, humidity 0 dp, precipitation sum 1 dp)."""
    return stg_weather.groupBy("observation_date").agg(
        X.rounded_avg(C("temperature_c"), 1).alias("avg_temperature_c"),
        X.rounded_avg(C("humidity_pct"), 0).alias("avg_humidity_pct"),
        X.rounded_avg(C("wind_speed_kmh"), 1).alias("avg_wind_speed_kmh"),
        F.round(F.round(F.sum("precipitation_mm"), 6), 1).alias("total_precipitation_mm"),
    )


def weather_day_context(stg_weather: DataFrame) -> DataFrame:
    """Dominant category, averages and snow hours per day in one frame.

    Weather is scanned once: a (day, category) partial aggregate carries the
    counts the mode needs and the partial sums the averages need; a second
    aggregate on day combines them.  Output is one row per observed day.
    """
    per_cat = stg_weather.groupBy("observation_date", "weather_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("temperature_c").alias("s_t"), F.count("temperature_c").alias("n_t"),
        F.sum("humidity_pct").alias("s_h"), F.count("humidity_pct").alias("n_h"),
        F.sum("wind_speed_kmh").alias("s_w"), F.count("wind_speed_kmh").alias("n_w"),
        F.sum("precipitation_mm").alias("s_p"),
    )
    avg = lambda s, n: F.try_divide(F.sum(s), F.sum(n).cast("double"))
    return per_cat.groupBy("observation_date").agg(
        F.min_by("weather_category", F.struct(-C("n"), C("weather_category"))).alias("dominant_weather"),
        F.round(F.round(avg("s_t", "n_t"), 6), 1).alias("avg_temperature_c"),
        F.round(F.round(avg("s_h", "n_h"), 6), 0).alias("avg_humidity_pct"),
        F.round(F.round(avg("s_w", "n_w"), 6), 1).alias("avg_wind_speed_kmh"),
        F.round(F.round(F.sum("s_p"), 6), 1).alias("total_precipitation_mm"),
        F.sum(F.when(C("weather_category") == "Snow", C("n")).otherwise(0)).cast("long").alias("snow_hours"),
    )


# ---------------------------------------------------------------------------
# Position measures
# ---------------------------------------------------------------------------

def speed_aggs() -> list[Column]:
    return [X.exact_sum_1dp(C("speed")).alias("sum_speed"),
            F.count("speed").alias("count_speed_readings")]


def peak_aggs(period: Column, occ: Column) -> list[Column]:
    crowded = occ.isin(X.OVERCROWDED_CODES)
    out = []
    for label, name in (("AM Peak", "am_peak"), ("PM Peak", "pm_peak"), ("Off Peak", "off_peak")):
        out.append(X.count_if(period == label).alias(f"{name}_count"))
        out.append(X.count_if((period == label) & crowded).alias(f"{name}_overcrowded_count"))
    return out


def peak_speed_aggs(period: Column, speed: Column) -> list[Column]:
    """Speed per peak: ELSE 0 in the sum, so no peak row gives 0.0, not NULL."""
    out = []
    for label, name in (("AM Peak", "am_peak"), ("PM Peak", "pm_peak")):
        in_p = period == label
        tenths = F.when(in_p, F.round(speed * 10)).otherwise(F.lit(0.0))
        out.append((F.sum(tenths.cast("long")) / F.lit(10.0)).alias(f"sum_speed_{name}"))
        out.append(X.count_if(in_p & speed.isNotNull()).alias(f"count_speed_{name}"))
    return out


def bbox_aggs() -> list[Column]:
    return [F.min("latitude").alias("min_latitude"), F.max("latitude").alias("max_latitude"),
            F.min("longitude").alias("min_longitude"), F.max("longitude").alias("max_longitude")]


def occupancy_buckets(positions: DataFrame, keys=("route_id", "event_date")) -> DataFrame:
    """The seven occupancy bucket counts per key."""
    return positions.groupBy(*keys).agg(*X.occupancy_bucket_aggs(C("occupancy_status")))


def peak_counts(stg_positions: DataFrame, keys=("route_id", "event_date")) -> DataFrame:
    """AM/PM/off-peak counts and overcrowded counts per key."""
    p = stg_positions.where(C("occupancy_status").isNotNull())
    return p.groupBy(*keys).agg(*peak_aggs(X.time_period(C("event_hour")), C("occupancy_status")))


def speed_measures(positions: DataFrame, keys=("route_id", "event_date")) -> DataFrame:
    """Additive speed measures: sum, readings, max."""
    return positions.groupBy(*keys).agg(*speed_aggs(), F.round(F.max("speed"), 1).alias("max_speed"))


def service_window(positions: DataFrame, keys=("route_id", "event_date")) -> DataFrame:
    """First/last position and hours between them, 1 dp."""
    return positions.groupBy(*keys).agg(
        F.min("event_timestamp").alias("first_position_at"),
        F.max("event_timestamp").alias("last_position_at"),
    ).withColumn("service_hours", _hours_between(C("first_position_at"), C("last_position_at")))


def _hours_between(a: Column, b: Column) -> Column:
    secs = F.unix_timestamp(b.cast("timestamp")) - F.unix_timestamp(a.cast("timestamp"))
    return F.round(secs.cast("double") / 3600, 1)


def bbox(stg_positions: DataFrame, keys=("route_id", "event_date")) -> DataFrame:
    """Geographic bounding box per key."""
    return stg_positions.groupBy(*keys).agg(*bbox_aggs())


# ---------------------------------------------------------------------------
# Gold models
# ---------------------------------------------------------------------------

def fct_daily_performance(fact_positions: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """Route x day measures over deduplicated positions + that day's weather."""
    daily = fact_positions.groupBy("event_date", "route_id").agg(
        F.count(F.lit(1)).alias("total_positions"),
        F.countDistinct("bus_id").alias("unique_vehicles"),
        F.countDistinct("trip_id").alias("unique_trips"),
        *speed_aggs(),
        F.round(F.max("speed"), 1).alias("max_speed"),
        *X.occupancy_bucket_aggs(C("occupancy_status")),
        F.min("event_timestamp").alias("first_position_at"),
        F.max("event_timestamp").alias("last_position_at"),
    )
    w = weather_day_context(stg_weather).withColumnRenamed("observation_date", "event_date")
    return (daily.join(w, "event_date", "left")
            .select(
                "event_date", "route_id", "total_positions", "unique_vehicles", "unique_trips",
                "sum_speed", "count_speed_readings", "max_speed",
                *[name for name, _ in X.OCCUPANCY_BUCKETS],
                "first_position_at", "last_position_at",
                _hours_between(C("first_position_at"), C("last_position_at")).alias("service_hours"),
                F.coalesce(C("dominant_weather"), F.lit("Unknown")).alias("dominant_weather"),
                "avg_temperature_c", "avg_humidity_pct", "avg_wind_speed_kmh", "total_precipitation_mm",
                F.coalesce(C("snow_hours"), F.lit(0).cast("long")).alias("snow_hours"),
                F.current_timestamp().alias("_dbt_updated_at"),
            ))


def enrich_positions(stg_positions: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """Positions with occupancy, plus day weather, day type and time period."""
    w = (weather_day_context(stg_weather)
         .select(C("observation_date").alias("event_date"), "dominant_weather", "snow_hours"))
    p = stg_positions.where(C("occupancy_status").isNotNull()).select(
        "route_id", "bus_id", "event_date", "event_hour", "occupancy_status", "speed", "latitude", "longitude")
    return (p.join(w, "event_date", "left")
            .select("route_id", "bus_id", "event_date", "event_hour", "occupancy_status", "speed",
                    "latitude", "longitude",
                    F.coalesce(C("dominant_weather"), F.lit("Unknown")).alias("dominant_weather"),
                    F.coalesce(C("snow_hours"), F.lit(0).cast("long")).alias("snow_hours"),
                    X.day_type(C("event_date")).alias("day_type"),
                    X.time_period(C("event_hour")).alias("time_period")))


def fct_fleet_optimization(stg_positions: DataFrame, stg_weather: DataFrame,
                           min_positions: int = FLEET_MIN_POSITIONS) -> DataFrame:
    """Route x day fleet measures over non-deduplicated positions, HAVING >= 10.

    Dominant weather, snow hours and day type depend on the date only, so
    positions are aggregated per (route, day) first and the one-row-per-day
    weather context is joined to the aggregates, not to every position row:
    the join touches routes x days rows instead of all positions.
    """
    p = stg_positions.where(C("occupancy_status").isNotNull())
    period, occ = X.time_period(C("event_hour")), C("occupancy_status")
    g = p.groupBy("route_id", "event_date").agg(
        F.count(F.lit(1)).alias("total_positions"),
        F.countDistinct("bus_id").alias("distinct_buses"),
        *X.occupancy_bucket_aggs(occ),
        *peak_aggs(period, occ),
        *speed_aggs(),
        *peak_speed_aggs(period, C("speed")),
        *bbox_aggs(),
    ).where(C("total_positions") >= min_positions)
    w = (weather_day_context(stg_weather)
         .select(C("observation_date").alias("event_date"), "dominant_weather", "snow_hours"))
    measures = [c for c in g.columns if c not in ("route_id", "event_date")]
    return (g.join(w, "event_date", "left")
            .select("route_id", "event_date",
                    F.coalesce(C("dominant_weather"), F.lit("Unknown")).alias("dominant_weather"),
                    F.coalesce(C("snow_hours"), F.lit(0).cast("long")).alias("snow_hours"),
                    X.day_type(C("event_date")).alias("day_type"),
                    *measures))


def fct_occupancy_by_hour(stg_positions: DataFrame, min_positions: int = HOURLY_MIN_POSITIONS) -> DataFrame:
    p = stg_positions.where(C("occupancy_status").isNotNull())
    g = p.groupBy("route_id", "event_date", "event_hour").agg(
        F.count(F.lit(1)).alias("total_positions"),
        F.countDistinct("bus_id").alias("active_buses"),
        *speed_aggs(),
        *X.occupancy_bucket_aggs(C("occupancy_status")),
    )
    return (g.where(C("total_positions") >= min_positions)
            .withColumn("time_period", X.time_period(C("event_hour"))))


def trips_by_direction(fact_trips: DataFrame) -> DataFrame:
    """Distinct trips per route and direction."""
    return fact_trips.groupBy("route_id", "direction_label").agg(F.countDistinct("trip_id").alias("total_trips"))


def stop_coverage(fact_stop_times: DataFrame) -> DataFrame:
    """Distinct stops per route."""
    return fact_stop_times.groupBy("route_id").agg(F.countDistinct("stop_id").alias("total_stops"))


def avg_max_sequence(fact_stop_times: DataFrame) -> DataFrame:
    """Average over trips of the highest stop_sequence, per route."""
    per_trip = fact_stop_times.groupBy("route_id", "trip_id").agg(F.max("stop_sequence").alias("max_seq"))
    return per_trip.groupBy("route_id").agg(X.rounded_avg(C("max_seq"), 1).alias("avg_stops_per_trip"))


def route_stop_measures(fact_stop_times: DataFrame) -> DataFrame:
    """Distinct stops and average max stop sequence per route from ONE shuffle.

    A grouping-sets aggregate emits (route, stop) and (route, trip) groups
    from a single Expand + exchange; a second, small aggregate per route
    counts the stop groups and averages the per-trip maxima.  Both measures
    thus read the stop-time fact once instead of once each.
    """
    sets = (fact_stop_times.groupingSets([["route_id", "stop_id"], ["route_id", "trip_id"]],
                                         "route_id", "stop_id", "trip_id")
            .agg(F.max("stop_sequence").alias("max_seq"), F.grouping_id().alias("gid")))
    # grouping_id bits (route, stop, trip): 1 = (route, stop) set, 2 = (route, trip) set.
    by_stop, by_trip = C("gid") == 1, C("gid") == 2
    return sets.groupBy("route_id").agg(
        F.count(F.when(by_stop & C("stop_id").isNotNull(), F.lit(1))).alias("total_stops"),
        F.round(F.round(F.avg(F.when(by_trip, C("max_seq"))), 6), 1).alias("avg_stops_per_trip"))


def fct_route_analytics(fact_trips: DataFrame, fact_stop_times: DataFrame) -> DataFrame:
    """Per route with outbound trips: trips by direction, stops, avg max sequence.

    The outbound/inbound self-join is one pivoting aggregate; routes without
    an outbound trip are dropped, as the outbound-driven join does, and trips
    without a route match no inbound trips, as equality on NULL does.
    """
    return route_summary(fact_trips, route_stop_measures(fact_stop_times))


def route_summary(fact_trips: DataFrame, stops: DataFrame) -> DataFrame:
    """Route analytics from the trips and the stop measures per route."""
    td = trips_by_direction(fact_trips).groupBy("route_id").agg(
        F.max(F.when(C("direction_label") == "Outbound", C("total_trips"))).alias("out_trips"),
        F.max(F.when((C("direction_label") == "Inbound") & C("route_id").isNotNull(), C("total_trips"))).alias("in_trips"),
    ).where(C("out_trips").isNotNull())
    out = F.coalesce(C("out_trips"), F.lit(0).cast("long"))
    inb = F.coalesce(C("in_trips"), F.lit(0).cast("long"))
    return (td.join(stops, "route_id", "left")
            .select("route_id", out.alias("outbound_trips"), inb.alias("inbound_trips"),
                    (out + inb).alias("total_trips"), "total_stops", "avg_stops_per_trip",
                    F.current_timestamp().alias("_dbt_updated_at")))


def obt_positions_wide(fact_positions: DataFrame, dim_routes: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """Every deduplicated position with route attributes and that hour's weather.

    Weather is matched on (date, hour); duplicate observations fan out.
    """
    r = dim_routes.select("route_id", "route_short_name", "route_long_name", "route_type_desc", "route_color_hex")
    w = stg_weather.select(C("observation_date").alias("event_date"), C("observation_hour").alias("event_hour"),
                           "temperature_c", "feels_like_c", "humidity_pct", "wind_speed_kmh",
                           "precipitation_mm", "weather_description", "weather_category")
    p = fact_positions.select("bus_id", "trip_id", "route_id", "latitude", "longitude", "speed", "bearing",
                              "current_status", "occupancy_status", "event_timestamp", "event_date", "event_hour")
    return p.join(r, "route_id", "left").join(w, ["event_date", "event_hour"], "left").select(
        "bus_id", "trip_id", "route_id", "latitude", "longitude", "speed", "bearing", "current_status",
        "occupancy_status", "event_timestamp", "event_date", "event_hour",
        "route_short_name", "route_long_name", "route_type_desc", "route_color_hex",
        "temperature_c", "feels_like_c", "humidity_pct", "wind_speed_kmh", "precipitation_mm",
        "weather_description", "weather_category")
