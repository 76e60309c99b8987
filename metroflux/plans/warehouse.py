"""Model DAG: bronze tables -> staging views -> silver -> gold.

``Warehouse`` composes the model functions lazily; each property is a
DataFrame whose plan Catalyst optimises end to end (views are inlined,
columns pruned, filters pushed to the scans).  ``materialize`` writes the
table models, cutting lineage at each written table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metroflux.functions.exprs import LOCAL_TZ
from metroflux.operators import gold, silver, staging
from metroflux.session import require_utc
from metroflux.sources import fixtures
from metroflux.sources.partitions import cluster_by_date, dates_between, replace_dates

STAGING_MODELS = ["stg_vehicle_positions", "stg_weather", "stg_routes", "stg_stops", "stg_trips",
                  "stg_stop_times", "stg_calendar", "stg_calendar_dates", "stg_shapes", "stg_agency"]
SILVER_MODELS = ["dim_routes", "dim_stops", "dim_calendar", "dim_date", "fact_trips",
                 "fact_stop_times", "fact_vehicle_positions"]
GOLD_MODELS = ["fct_daily_performance", "fct_fleet_optimization", "fct_occupancy_by_hour",
               "fct_route_analytics", "obt_positions_wide"]


class Warehouse:
    """Every model of the warehouse as a lazily built DataFrame."""

    def __init__(self, spark: SparkSession, bronze: Mapping[str, DataFrame], tz: str = LOCAL_TZ,
                 as_of=None, dedup_on: str = "local"):
        # Bronze instants are UTC; localisation assumes a UTC session.
        require_utc(spark)
        self.spark = spark
        self.bronze = bronze
        self.tz = tz
        self.as_of = as_of
        self.dedup_on = dedup_on

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(spark, fixtures.Bronze(spark, sf_dir), **kw)

    # staging (views)
    @cached_property
    def stg_vehicle_positions(self):
        return staging.stg_vehicle_positions(self.bronze["vehicle_positions"], self.tz)

    @cached_property
    def _stg_positions_utc(self):
        return staging.stg_vehicle_positions(self.bronze["vehicle_positions"], self.tz, keep_utc=True)

    @cached_property
    def stg_weather(self):
        return staging.stg_weather(self.bronze["weather"])

    @cached_property
    def stg_routes(self):
        return staging.stg_routes(self.bronze["gtfs_routes"])

    @cached_property
    def stg_stops(self):
        return staging.stg_stops(self.bronze["gtfs_stops"])

    @cached_property
    def stg_trips(self):
        return staging.stg_trips(self.bronze["gtfs_trips"])

    @cached_property
    def stg_stop_times(self):
        return staging.stg_stop_times(self.bronze["gtfs_stop_times"])

    @cached_property
    def stg_calendar(self):
        return staging.stg_calendar(self.bronze["gtfs_calendar"])

    @cached_property
    def stg_calendar_dates(self):
        return staging.stg_calendar_dates(self.bronze["gtfs_calendar_dates"])

    @cached_property
    def stg_shapes(self):
        return staging.stg_shapes(self.bronze["gtfs_shapes"])

    @cached_property
    def stg_agency(self):
        return staging.stg_agency(self.bronze["gtfs_agency"])

    # silver
    @cached_property
    def dim_routes(self):
        return silver.dim_routes(self.stg_routes)

    @cached_property
    def dim_stops(self):
        return silver.dim_stops(self.stg_stops)

    @cached_property
    def dim_calendar(self):
        return silver.dim_calendar(self.stg_calendar, self.stg_calendar_dates)

    @cached_property
    def dim_date(self):
        if self.as_of is not None:
            return silver.dim_date(self.spark, as_of=self.as_of)
        return silver.dim_date_as_of_events(self.stg_vehicle_positions)

    @cached_property
    def fact_trips(self):
        return silver.fact_trips(self.stg_trips, self.dim_routes)

    @cached_property
    def fact_stop_times(self):
        return silver.fact_stop_times(self.stg_stop_times, self.dim_stops, self.fact_trips)

    @cached_property
    def fact_vehicle_positions(self):
        if self.dedup_on == "utc":
            return silver.fact_vehicle_positions(self._stg_positions_utc, self.dim_routes, "utc")
        return silver.fact_vehicle_positions(self.stg_vehicle_positions, self.dim_routes)

    # gold
    @cached_property
    def fct_daily_performance(self):
        return gold.fct_daily_performance(self.fact_vehicle_positions, self.stg_weather)

    @cached_property
    def fct_fleet_optimization(self):
        return gold.fct_fleet_optimization(self.stg_vehicle_positions, self.stg_weather)

    @cached_property
    def fct_occupancy_by_hour(self):
        return gold.fct_occupancy_by_hour(self.stg_vehicle_positions)

    @cached_property
    def fct_route_analytics(self):
        return gold.fct_route_analytics(self.fact_trips, self.fact_stop_times)

    @cached_property
    def obt_positions_wide(self):
        return gold.obt_positions_wide(self.fact_vehicle_positions, self.dim_routes, self.stg_weather)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)


# Upstream table models of each model (staging views read bronze directly).
DEPENDS = {
    "dim_routes": [], "dim_stops": [], "dim_calendar": [], "dim_date": [],
    "fact_trips": ["dim_routes"],
    "fact_vehicle_positions": ["dim_routes"],
    "fact_stop_times": ["dim_stops", "fact_trips"],
    "fct_daily_performance": ["fact_vehicle_positions"],
    "fct_fleet_optimization": [],
    "fct_occupancy_by_hour": [],
    "fct_route_analytics": ["fact_trips", "fact_stop_times"],
    "obt_positions_wide": ["fact_vehicle_positions", "dim_routes"],
}


def materialize(wh: Warehouse, out_dir: str, models: list[str] | None = None,
                partition_by: Mapping[str, list[str]] | None = None, parallel: bool = True,
                measures: Mapping[str, list[Column]] | None = None, found: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """Write table models as parquet under ``out_dir`` and return re-read frames.

    ``measures`` are aggregates to be counted in the write of a model itself; their values by model come
    back in ``found``.

    Models are written in dependency waves; later models are rebuilt on the
    written tables, so each write is a lineage cut (a lost executor re-runs
    only the current model's stages, never the whole DAG).  Models of one
    wave are independent and are submitted as concurrent Spark jobs.
    ``out_dir`` must be shared storage on a cluster.
    """
    from concurrent.futures import ThreadPoolExecutor

    names = list(models or (SILVER_MODELS + GOLD_MODELS))
    partition_by = dict(partition_by or {})
    out: dict[str, DataFrame] = {}
    remaining = list(names)
    while remaining:
        wave = [m for m in remaining
                if all(d in out or d not in names for d in DEPENDS.get(m, []))]
        frames = {m: wh.model(m) for m in wave}  # plans are built on this thread

        def write(name: str) -> None:
            df = frames[name]
            if name in partition_by:
                # Each task writes a few contiguous dates (not one file per task
                # and date), and a heavy date is split over several tasks.
                df = cluster_by_date(df, *partition_by[name])
            seen = None
            if measures and measures.get(name):
                # On top of the plan: the sampling of the range partitioning must not count rows twice.
                seen = Observation(f"{name}-{uuid.uuid4().hex}")
                df = df.observe(seen, *measures[name])
            # Full rebuild: static overwrite drops partitions that no longer exist.
            w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
            if name in partition_by:
                w = w.partitionBy(*partition_by[name])
            w.parquet(f"{out_dir.rstrip('/')}/{name}")
            if seen is not None and found is not None:
                found[name] = seen.get

        if parallel and len(wave) > 1:
            with ThreadPoolExecutor(max_workers=len(wave)) as pool:
                list(pool.map(write, wave))
        else:
            for m in wave:
                write(m)
        for m in wave:
            # Declared schema on read: partition columns keep their types and order.
            out[m] = (wh.spark.read.schema(frames[m].schema).parquet(f"{out_dir.rstrip('/')}/{m}")
                      .select(*frames[m].columns))
            # Downstream models read the written table, not the lineage.
            wh.__dict__[m] = out[m]
        remaining = [m for m in remaining if m not in out]
    return out


# Database per layer, as routed by the source project: staging and silver
# share one schema, gold has its own.
LAYER_OF = {**{m: "staging" for m in STAGING_MODELS}, **{m: "silver" for m in SILVER_MODELS},
            **{m: "gold" for m in GOLD_MODELS}}


def target_schema(model: str, default_schema: str, custom: Mapping[str, str] | None = None) -> str:
    """Custom schema of the model's layer verbatim when configured, else the default."""
    return (custom or {}).get(LAYER_OF[model]) or default_schema


def publish(wh: Warehouse, default_schema: str, custom: Mapping[str, str] | None = None,
            views=STAGING_MODELS, tables=SILVER_MODELS + GOLD_MODELS) -> dict[str, str]:
    """Register staging models as temp views and save table models into their databases.

    Tables are full rebuilds (overwrite); build stamps come from the models.
    Returns model -> qualified name.
    """
    names = {}
    for m in views:
        wh.model(m).createOrReplaceTempView(m)
        names[m] = m
    for m in tables:
        db = target_schema(m, default_schema, custom)
        wh.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        wh.model(m).write.mode("overwrite").saveAsTable(f"`{db}`.`{m}`")
        wh.__dict__[m] = wh.spark.table(f"`{db}`.`{m}`")
        names[m] = f"{db}.{m}"
    return names


# Models whose rows depend only on the positions of their own local day.
DATE_GRAIN_MODELS = ["fact_vehicle_positions", "fct_daily_performance", "fct_fleet_optimization",
                     "fct_occupancy_by_hour", "obt_positions_wide"]
DATE_PARTITIONS = {m: ["event_date"] for m in DATE_GRAIN_MODELS}


def local_dates_touched(first_ingestion_date: str, last_ingestion_date: str) -> tuple[str, str]:
    """Local dates whose rows can sit in bronze partitions [first, last] (event-derived UTC dates).

    West of UTC a UTC date also holds the evening of the previous local date,
    so late partitions [a, b] require refreshing local dates [a - 1, b].
    """
    import datetime as dt

    return ((dt.date.fromisoformat(first_ingestion_date) - dt.timedelta(days=1)).isoformat(), last_ingestion_date)


def refresh_dates(spark: SparkSession, bronze: Mapping[str, DataFrame], out_dir: str, start: str, end: str,
                  models=DATE_GRAIN_MODELS, tz: str = LOCAL_TZ) -> dict[str, DataFrame]:
    """Rebuild the date-grain models for local dates [start, end] and replace only those partitions.

    Exactness: duplicates share (bus, local time), hence one local date, and
    every measure of these models is per local date, so the rows of a date
    depend only on positions of that date.  A local date spans two UTC
    dates, so bronze is read for ingestion_date in [start - 1, end + 1]
    (partition pruning on the event-derived ingestion date) and results are
    cut back to [start, end].  Tables must be partitioned by event_date
    (``materialize(..., partition_by=DATE_PARTITIONS)``); a date that lost all
    its rows loses its partition.
    """
    import datetime as dt

    lo = (dt.date.fromisoformat(start) - dt.timedelta(days=1)).isoformat()
    hi = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
    window = dict(bronze)
    window["vehicle_positions"] = bronze["vehicle_positions"].where(
        F.col("ingestion_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    wh = Warehouse(spark, window, tz=tz)
    out = {}
    for name in models:
        df = cluster_by_date(wh.model(name).where(
            F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))), "event_date")
        path = f"{out_dir.rstrip('/')}/{name}"
        replace_dates(df, path, "event_date", dates_between(start, end))
        out[name] = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    return out
