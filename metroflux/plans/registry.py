"""Registered queries: name -> (spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, rebuilds the bronze inputs from
the driver tables of ``sf_dir`` and runs the warehouse code on them.
Build-time stamps (``_dbt_updated_at``) are dropped from compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metroflux.operators import gold
from metroflux.plans import oracle
from metroflux.plans.warehouse import GOLD_MODELS, SILVER_MODELS, STAGING_MODELS, Warehouse

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_driver(spark, sf_dir)


def _model_query(name: str) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _wh(spark, sf_dir).model(name)
        return df.drop("_dbt_updated_at")
    build.__name__ = f"q_{name}"
    build.__doc__ = f"The {name} model rebuilt from the driver tables."
    return build


for _name in STAGING_MODELS + SILVER_MODELS + GOLD_MODELS:
    REGISTRY[_name] = (_model_query(_name), oracle.model_sql(_name))


# --- gold sub-operators (D6-D17) -------------------------------------------

@register("daily_weather", oracle.model_sql("daily_weather"))
def q_daily_weather(spark, sf_dir):
    """Weather averages per day."""
    return gold.daily_weather(_wh(spark, sf_dir).stg_weather)


@register("dominant_weather", oracle.model_sql("dominant_weather"))
def q_dominant_weather(spark, sf_dir):
    """Most frequent weather category per day (ties: alphabetical)."""
    return gold.dominant_weather(_wh(spark, sf_dir).stg_weather)


@register("snow_hours", oracle.model_sql("snow_hours"))
def q_snow_hours(spark, sf_dir):
    """Snow observation rows per day."""
    return gold.snow_hours(_wh(spark, sf_dir).stg_weather)


@register("occupancy_buckets", oracle.query(f"""
SELECT route_id, event_date, {oracle.OCC}
FROM fact_vehicle_positions GROUP BY route_id, event_date"""))
def q_occupancy_buckets(spark, sf_dir):
    """Occupancy bucket counts per route-day over deduplicated positions."""
    return gold.occupancy_buckets(_wh(spark, sf_dir).fact_vehicle_positions)


@register("peak_counts", oracle.query("""
SELECT route_id, event_date,
  CAST(SUM(CASE WHEN time_period = 'AM Peak' THEN 1 ELSE 0 END) AS BIGINT) AS am_peak_count,
  CAST(SUM(CASE WHEN time_period = 'AM Peak' AND occupancy_status IN (3, 5) THEN 1 ELSE 0 END) AS BIGINT)
    AS am_peak_overcrowded_count,
  CAST(SUM(CASE WHEN time_period = 'PM Peak' THEN 1 ELSE 0 END) AS BIGINT) AS pm_peak_count,
  CAST(SUM(CASE WHEN time_period = 'PM Peak' AND occupancy_status IN (3, 5) THEN 1 ELSE 0 END) AS BIGINT)
    AS pm_peak_overcrowded_count,
  CAST(SUM(CASE WHEN time_period = 'Off Peak' THEN 1 ELSE 0 END) AS BIGINT) AS off_peak_count,
  CAST(SUM(CASE WHEN time_period = 'Off Peak' AND occupancy_status IN (3, 5) THEN 1 ELSE 0 END) AS BIGINT)
    AS off_peak_overcrowded_count
FROM enriched_positions GROUP BY route_id, event_date"""))
def q_peak_counts(spark, sf_dir):
    """Peak-period and overcrowded-in-period counts per route-day."""
    return gold.peak_counts(_wh(spark, sf_dir).stg_vehicle_positions)


@register("speed_measures", oracle.query("""
SELECT route_id, event_date, round(SUM(speed), 1) AS sum_speed,
  CAST(COUNT(speed) AS BIGINT) AS count_speed_readings, round(MAX(speed), 1) AS max_speed
FROM fact_vehicle_positions GROUP BY route_id, event_date"""))
def q_speed_measures(spark, sf_dir):
    """Additive speed measures per route-day."""
    return gold.speed_measures(_wh(spark, sf_dir).fact_vehicle_positions)


@register("service_window", oracle.query("""
SELECT route_id, event_date, first_position_at, last_position_at,
  round(CAST(datediff('second', first_position_at, last_position_at) AS DOUBLE) / 3600, 1) AS service_hours
FROM (SELECT route_id, event_date, MIN(event_timestamp) AS first_position_at,
        MAX(event_timestamp) AS last_position_at
      FROM fact_vehicle_positions GROUP BY route_id, event_date) s"""))
def q_service_window(spark, sf_dir):
    """first/last position and service hours per route-day."""
    return gold.service_window(_wh(spark, sf_dir).fact_vehicle_positions)


@register("bbox", oracle.query("""
SELECT route_id, event_date, MIN(latitude) AS min_latitude, MAX(latitude) AS max_latitude,
  MIN(longitude) AS min_longitude, MAX(longitude) AS max_longitude
FROM stg_vehicle_positions GROUP BY route_id, event_date"""))
def q_bbox(spark, sf_dir):
    """Bounding box per route-day."""
    return gold.bbox(_wh(spark, sf_dir).stg_vehicle_positions)


@register("enriched_positions", oracle.model_sql("enriched_positions"))
def q_enriched_positions(spark, sf_dir):
    """Positions with day weather, snow hours, day type and time period."""
    wh = _wh(spark, sf_dir)
    return gold.enrich_positions(wh.stg_vehicle_positions, wh.stg_weather)


@register("trips_by_direction", oracle.model_sql("trips_by_direction"))
def q_trips_by_direction(spark, sf_dir):
    """Distinct trips per route and direction."""
    return gold.trips_by_direction(_wh(spark, sf_dir).fact_trips)


@register("stop_coverage", oracle.model_sql("stop_coverage"))
def q_stop_coverage(spark, sf_dir):
    """Distinct stops per route."""
    return gold.stop_coverage(_wh(spark, sf_dir).fact_stop_times)


@register("avg_max_sequence", oracle.model_sql("avg_max_sequence"))
def q_avg_max_sequence(spark, sf_dir):
    """Average over trips of the max stop sequence, per route."""
    return gold.avg_max_sequence(_wh(spark, sf_dir).fact_stop_times)


def _refreshed(spark, sf_dir):
    """The refreshed tables of the date-grain models, by name.

    The first build sees bronze without the ingestion-date partitions
    2026-01-10..13 (they land late) and with rows of 2026-02-10 that are later
    withdrawn (copies of 2026-01-20).  ``refresh_dates`` then rebuilds only the
    local dates these partitions touch from all bronze and replaces their
    partitions; the withdrawn dates end up without one.
    """
    import uuid

    from pyspark.sql import functions as F

    from metroflux.plans.warehouse import (DATE_GRAIN_MODELS, DATE_PARTITIONS, local_dates_touched, materialize,
                                           refresh_dates)
    from metroflux.session import checkpoint_dir
    from metroflux.sources import fixtures

    full = fixtures.Bronze(spark, sf_dir)
    day = F.col("ingestion_date")
    late = day.between(F.lit("2026-01-10").cast("date"), F.lit("2026-01-13").cast("date"))
    positions = full["vehicle_positions"]
    withdrawn = positions.where(day == F.lit("2026-01-20").cast("date")).withColumns({
        "event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 21 DAY"), "ingestion_date": F.date_add(day, 21)})
    early = {name: full[name] for name in fixtures.ADAPTERS}
    early["vehicle_positions"] = positions.where(~late).unionByName(withdrawn)
    path = f"{checkpoint_dir(spark).rstrip('/')}/incr-{uuid.uuid4().hex}"
    materialize(Warehouse(spark, early), path, DATE_GRAIN_MODELS, partition_by=DATE_PARTITIONS)
    refresh_dates(spark, full, path, *local_dates_touched("2026-01-10", "2026-01-13"))
    return refresh_dates(spark, full, path, *local_dates_touched("2026-02-10", "2026-02-10"))


@register("gold_incremental_refresh", oracle.model_sql("fct_daily_performance"))
def q_gold_incremental_refresh(spark, sf_dir):
    """Late and withdrawn data, then date-window refreshes: the refreshed table equals a full build."""
    return _refreshed(spark, sf_dir)["fct_daily_performance"].drop("_dbt_updated_at")


REFRESHED = ["fact_vehicle_positions", "fct_daily_performance", "fct_fleet_optimization", "fct_occupancy_by_hour",
             "obt_positions_wide"]


@register("gold_refresh_models", oracle.query("\nUNION ALL\n".join(
    f"SELECT '{m}' AS model, event_date, COUNT(*) AS n_rows, COUNT(DISTINCT route_id) AS routes FROM {m} GROUP BY event_date"
    for m in REFRESHED)))
def q_gold_refresh_models(spark, sf_dir):
    """Rows and routes per date of every refreshed model."""
    from pyspark.sql import functions as F

    tables = _refreshed(spark, sf_dir)
    parts = [tables[m].groupBy("event_date").agg(F.count("*").alias("n_rows"), F.countDistinct("route_id").alias("routes"))
             .select(F.lit(m).alias("model"), "event_date", "n_rows", "routes") for m in REFRESHED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_extensions() -> None:
    """Import the modules that register more queries (quality, BI, bronze, streaming)."""
    import importlib
    for mod in ("metroflux.plans.q_quality", "metroflux.plans.q_metrics",
                "metroflux.plans.q_bronze", "metroflux.plans.q_ingest", "metroflux.plans.q_streaming",
                "metroflux.plans.q_incremental"):
        importlib.import_module(mod)


def queries() -> dict[str, Builder]:
    load_extensions()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    load_extensions()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
