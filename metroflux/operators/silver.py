"""Silver layer: star-schema dimensions and facts.

Joins against small dimensions are plain equi-joins: Spark's own size check
(``autoBroadcastJoinThreshold`` at planning, AQE's runtime threshold after a
shuffle) decides between a broadcast and a sort-merge join, so a dimension
that outgrows the threshold falls back to a shuffle join instead of being
forced into every executor's memory.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroflux.functions import exprs as X

C = F.col

# The date dimension window and fiscal year start of the source.
DATE_SPINE_START = "2025-12-01"
DATE_SPINE_END = "2027-12-31"
FISCAL_START_MONTH = 7


def dim_routes(stg_routes: DataFrame) -> DataFrame:
    return stg_routes.select(
        X.surrogate_key(C("route_id")).alias("route_key"),
        "route_id", "agency_id", "route_short_name", "route_long_name", "route_type",
        X.route_type_desc(C("route_type")).alias("route_type_desc"),
        "route_color_hex", "route_text_color_hex", "route_url",
        "_source_file", "_ingestion_timestamp",
        F.current_timestamp().alias("_dbt_updated_at"),
    )


def dim_stops(stg_stops: DataFrame) -> DataFrame:
    return stg_stops.select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "stop_code", "wheelchair_boarding",
        X.surrogate_key(C("stop_id")).alias("stop_sk"),
    )


def dim_calendar(stg_calendar: DataFrame, stg_calendar_dates: DataFrame) -> DataFrame:
    """Calendar flags + exception counts + service pattern.

    Additions and removals come from ONE conditional aggregate over the
    exceptions (one scan, one shuffle) instead of two filtered scans.
    """
    exc = (stg_calendar_dates
           .groupBy("service_id")
           .agg(X.count_if(C("exception_type") == 1).alias("additions"),
                X.count_if(C("exception_type") == 2).alias("removals")))
    days = [C(f"c.{d}") for d in ("monday", "tuesday", "wednesday", "thursday",
                                  "friday", "saturday", "sunday")]
    return (stg_calendar.alias("c")
            .join(exc.alias("x"), C("c.service_id") == C("x.service_id"), "left")
            .select(
                C("c.service_id").alias("service_id"),
                *[C(f"c.{d}").alias(d) for d in ("monday", "tuesday", "wednesday", "thursday",
                                                 "friday", "saturday", "sunday")],
                C("c.start_date").alias("start_date"), C("c.end_date").alias("end_date"),
                F.coalesce(C("x.additions"), F.lit(0).cast("long")).alias("service_additions"),
                F.coalesce(C("x.removals"), F.lit(0).cast("long")).alias("service_removals"),
                X.service_pattern(*days).alias("service_pattern"),
            ))


def fiscal_shift_months(fiscal_start_month: int) -> int:
    """Months to add to a date so its year is the fiscal year (July -> 6)."""
    return 12 - ((fiscal_start_month + 10) % 12 + 1)


def date_spine(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """One row per day in [start, end] (a generator, no input scan)."""
    return spark.range(1).select(
        F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("date_key"))


def dim_date_columns(d: Column, as_of: Column, fiscal_start_month: int = FISCAL_START_MONTH) -> list[Column]:
    """The 36 calendar columns for a date column ``d`` relative to ``as_of``."""
    shift = fiscal_shift_months(fiscal_start_month)
    fis = F.add_months(d, shift)
    yy = lambda c: F.date_format(c, "yy")
    week = F.date_trunc("WEEK", d)
    return [
        d.alias("date_key"),
        F.datediff(d, as_of).alias("date_relative_num"),
        F.year(d).alias("year"),
        F.date_trunc("YEAR", d).alias("year_start_date"),
        (F.year(d) - F.year(as_of)).alias("year_relative_num"),
        F.year(fis).alias("fis_year"),
        F.concat(F.lit("FY"), yy(fis)).alias("fis_year_label"),
        F.add_months(F.date_trunc("YEAR", fis), -shift).alias("fis_year_start_date"),
        F.quarter(fis).alias("fis_qtr_num"),
        F.concat(F.lit("Q"), F.quarter(fis)).alias("fis_qtr"),
        F.concat(F.lit("Q"), F.quarter(fis), F.lit("-"), yy(fis)).alias("fis_qtr_label"),
        F.month(fis).alias("fis_month_num"),
        F.date_format(d, "MMM").alias("fis_month"),
        F.concat(F.date_format(d, "MMM"), F.lit("-"), F.date_format(fis, "yyyy")).alias("fis_month_label"),
        F.date_trunc("MONTH", d).alias("fis_month_start_date"),
        F.quarter(d).alias("qtr_num"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("qtr"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit("-"), yy(d)).alias("qtr_label"),
        F.date_trunc("QUARTER", d).alias("qtr_start_date"),
        ((F.year(d) * 4 + F.quarter(d)) - (F.year(as_of) * 4 + F.quarter(as_of))).alias("qtr_relative_num"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM-yyyy").alias("month_label"),
        F.date_trunc("MONTH", d).alias("month_start_date"),
        ((F.year(d) * 12 + F.month(d)) - (F.year(as_of) * 12 + F.month(as_of))).alias("month_relative_num"),
        F.weekofyear(d).alias("week_of_year"),
        week.alias("week_start_date"),
        F.floor(F.datediff(week, F.date_trunc("WEEK", as_of)) / 7).alias("week_relative_num"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week_num"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short"),
        F.dayofyear(d).alias("day_of_year"),
        X.is_weekend(d).alias("is_weekend"),
        X.day_type(d).alias("weekday_label"),
    ]


def dim_date(spark: SparkSession, start=DATE_SPINE_START, end=DATE_SPINE_END,
             fiscal_start_month: int = FISCAL_START_MONTH, as_of=None) -> DataFrame:
    """Calendar dimension over a fixed window.

    ``as_of`` (a date, ISO string or Column) replaces CURRENT_DATE so the
    relative columns are reproducible; default is the current date.
    """
    def lit_date(v):
        if isinstance(v, Column):
            return v
        if isinstance(v, (_dt.date, str)):
            return F.lit(str(v)).cast("date")
        raise TypeError(v)
    as_of_c = F.current_date() if as_of is None else lit_date(as_of)
    spine = date_spine(spark, lit_date(start), lit_date(end))
    return spine.select(*dim_date_columns(C("date_key"), as_of_c, fiscal_start_month))


def dim_date_as_of_events(events: DataFrame, date_col: str = "event_date", start=DATE_SPINE_START, end=DATE_SPINE_END,
                          fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """Date dimension over the configured window, as of the latest event date inside it.

    Events outside the window have no dimension row, so the relationship rules on
    event dates report them, and a bad future date does not move the relative
    columns.  Without an event in the window the current date is taken.
    """
    lo, hi = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    as_of = events.where(C(date_col).between(lo, hi)).agg(F.coalesce(F.max(date_col), F.current_date()).alias("as_of"))
    spine = as_of.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("date_key"), "as_of")
    return spine.select(*dim_date_columns(C("date_key"), C("as_of"), fiscal_start_month))


def fact_trips(stg_trips: DataFrame, dim_routes: DataFrame) -> DataFrame:
    r = dim_routes.select("route_id", "route_short_name", "route_long_name", "route_type_desc")
    return (stg_trips.join(r, "route_id", "left")
            .select("trip_id", "route_id", "service_id", "shape_id", "trip_headsign",
                    "direction_id", "note_en", "note_fr",
                    X.direction_label(C("direction_id")).alias("direction_label"),
                    "route_short_name", "route_long_name", "route_type_desc"))


def fact_stop_times(stg_stop_times: DataFrame, dim_stops: DataFrame, fact_trips: DataFrame) -> DataFrame:
    s = dim_stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
    t = fact_trips.select("trip_id", "route_id", "route_short_name", "direction_label", "trip_headsign")
    return (stg_stop_times.join(s, "stop_id", "left").join(t, "trip_id", "left")
            .select("trip_id", "stop_id", "arrival_time", "departure_time", "stop_sequence",
                    "pickup_type", "drop_off_type", "stop_name", "stop_lat", "stop_lon",
                    "route_id", "route_short_name", "direction_label", "trip_headsign"))


# Latest-wins order for duplicate (bus, time) rows.  The load time decides;
# the rest only makes ties (same batch, same load time) deterministic.
def dedup_order() -> list[Column]:
    return [
    C("_ingestion_timestamp").desc_nulls_last(),
    C("_source_file").desc_nulls_last(),
    C("_batch_id").desc_nulls_last(),
    C("trip_id").asc_nulls_first(), C("route_id").asc_nulls_first(),
    C("speed").asc_nulls_first(), C("latitude").asc_nulls_first(),
    C("longitude").asc_nulls_first(), C("bearing").asc_nulls_first(),
    C("current_status").asc_nulls_first(), C("occupancy_status").asc_nulls_first(),
    ]


def latest_positions(stg_positions: DataFrame, keys=("bus_id", "event_timestamp")) -> DataFrame:
    """Keep the most recently loaded row per key.

    ``row_number() == 1`` plans as a map-side WindowGroupLimit before the
    shuffle, so a key repeated in many input partitions ships at most one
    row per partition: a hot key cannot pile its duplicates onto one task.
    """
    w = Window.partitionBy(*keys).orderBy(*dedup_order())
    return (stg_positions.withColumn("_rn", F.row_number().over(w))
            .where(C("_rn") == 1).drop("_rn"))


def fact_vehicle_positions(stg_positions: DataFrame, dim_routes: DataFrame, dedup_on: str = "local") -> DataFrame:
    """Latest row per (bus, time) with keys and status labels.

    ``dedup_on="local"`` keys on the local wall clock (two instants an hour
    apart in the DST fold collapse, as in the source); ``"utc"`` keys on the
    instant and needs ``stg_vehicle_positions(..., keep_utc=True)``.
    """
    if dedup_on == "utc":
        dedup = latest_positions(stg_positions, ("bus_id", "_event_timestamp_utc")).drop("_event_timestamp_utc")
    elif dedup_on == "local":
        dedup = latest_positions(stg_positions)
    else:
        raise ValueError(dedup_on)
    r = dim_routes.select("route_id", "route_key")
    return (dedup.join(r, "route_id", "left")
            .select(
                X.surrogate_key(C("bus_id"), C("event_timestamp")).alias("position_key"),
                "bus_id", "trip_id", "route_id", "route_key", "start_time", "start_date",
                "latitude", "longitude", "speed", "bearing",
                "current_status", X.vehicle_status_desc(C("current_status")).alias("current_status_desc"),
                "occupancy_status", X.occupancy_desc(C("occupancy_status")).alias("occupancy_status_desc"),
                "event_timestamp",
                C("event_timestamp").cast("date").alias("event_date"),
                F.hour("event_timestamp").alias("event_hour"),
                "_source_file", "_ingestion_timestamp", "_batch_id",
                F.current_timestamp().alias("_dbt_updated_at"),
            ))
