"""Registered queries of incremental work: sketches, stateful streams, levelled log, refresh by key, co-located joins, two-output casts."""

from __future__ import annotations

import contextlib
import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from metroflux.operators import casts, quality, sketches, staging
from metroflux.plans import colocated, keyed, oracle
from metroflux.plans.q_quality import _cast_failures_sql
from metroflux.plans.registry import _wh, register
from metroflux.plans.warehouse import Warehouse
from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures
from metroflux.streaming import feeds, late, levels

C = F.col


def _root(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _union(frames) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


# --- mergeable distinct counts

def _rollup_sql() -> str:
    parts = []
    for level, keys in sketches.LEVELS.items():
        group = f"GROUP BY {', '.join(keys)}" if keys else "HAVING COUNT(*) > 0"
        columns = ", ".join(f"{c} AS {c}" if c in keys else f"CAST(NULL AS {t}) AS {c}" for c, t in (("route_id", "VARCHAR"), ("month", "DATE")))
        parts.append(f"SELECT '{level}' AS level, {columns}, COUNT(*) AS total_positions, COUNT(DISTINCT bus_id) AS unique_vehicles, "
                     f"COUNT(DISTINCT trip_id) AS unique_trips, true AS vehicles_in_bound, true AS trips_in_bound FROM m {group}")
    return ("SELECT * FROM (WITH m AS (SELECT *, CAST(date_trunc('month', event_date) AS DATE) AS month FROM fact_vehicle_positions)\n"
            + "\nUNION ALL ".join(parts) + ") r")


@register("gold_distinct_rollups", oracle.query(_rollup_sql()))
def q_gold_distinct_rollups(spark, sf_dir):
    """Buses and trips per network, month, route and route-month from the daily sketches alone.

    Beside each exact count: whether the estimate from the sketches is within three standard errors.
    """
    fact = _wh(spark, sf_dir).fact_vehicle_positions
    path = _root(spark, "sketches")
    sketches.fct_daily_sketches(fact).write.parquet(path)
    daily = spark.read.parquet(path)
    keys, named = ["level", "route_id", "month"], list(sketches.SKETCHED)
    # Both counts of a key side by side by a grouping, in which NULL keys meet too.
    sides = [df.select(*keys, F.lit(side).alias("side"), "total_positions", *named) for level in sketches.LEVELS
             for side, df in (("exact", sketches.exact_rollup(fact, level)), ("estimate", sketches.distinct_rollup(daily, level)))]
    of = lambda side, c: F.max(F.when(C("side") == side, C(c)))
    both = _union(sides).groupBy(*keys).agg(of("estimate", "total_positions").alias("total_positions"), *[of("exact", c).alias(c) for c in named],
                                            *[of("estimate", c).alias(f"{c}_estimate") for c in named])
    good = lambda c: F.coalesce(sketches.within_bound(C(f"{c}_estimate"), C(c)), F.lit(False))
    return both.select(*keys, "total_positions", *named, good("unique_vehicles").alias("vehicles_in_bound"),
                       good("unique_trips").alias("trips_in_bound"))


# --- stateful streams

ARRIVAL_DAYS = 5
_ARRIVED = f"""
SELECT *, least(event_timestamp, _ingestion_timestamp) AS _at, date_diff('day', DATE '1970-01-01', CAST(_ingestion_timestamp AS DATE)) // {ARRIVAL_DAYS} AS arrival
FROM stg_vehicle_positions"""
_SPLIT = f"""
SELECT a.*, coalesce(a._at <= h.high - INTERVAL {late.DELAY}, false) AS behind FROM ({_ARRIVED}) a LEFT JOIN (
  SELECT b.arrival, (SELECT max(c._at) FROM ({_ARRIVED}) c WHERE c.arrival < b.arrival) AS high FROM ({_ARRIVED}) b GROUP BY b.arrival) h
ON a.arrival = h.arrival"""


@contextlib.contextmanager
def _data_batches_only(spark):
    """Streams started inside run no batch without data: a watermark moves with the next arrival, not between two runs."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _arrivals(spark, sf_dir, root: str, stateful) -> DataFrame:
    """Land the bronze positions in the order of their load days, some days each, and run the streams on each arrival.

    An arrival is as many files as its rows need.  ``split_late`` and the ``stateful`` stream (of staging rows) go on
    from their checkpoints and take all that is new, a micro-batch an arrival.  Returns the staging rows.
    """
    table = fixtures.bronze_table(spark, sf_dir, "vehicle_positions")
    stg = staging.stg_vehicle_positions(table)
    arrival = F.floor(F.datediff(C("ingestion_timestamp").cast("date"), F.lit("1970-01-01").cast("date")) / ARRIVAL_DAYS)
    held = f"{root}/held"
    table.withColumn("arrival", arrival).write.partitionBy("arrival").parquet(held)
    rows = spark.read.schema(StructType([*B.BRONZE_TABLE_SCHEMA.fields, StructField("arrival", LongType())])).parquet(held)
    with _data_batches_only(spark):
        for r in rows.select("arrival").distinct().orderBy("arrival").collect():  # some days a time: a few
            landed = rows.where(C("arrival") == r["arrival"]).drop("arrival")
            fixtures.spread(landed, "ingestion_timestamp", "bus_id").write.mode("append").parquet(f"{root}/positions")
            stream = staging.stg_vehicle_positions(feeds.positions_stream(spark, f"{root}/positions"))
            feeds.await_all(late.split_late(stream, f"{root}/split", f"{root}/_split"))
            feeds.await_all(stateful(stg))
    return stg


@register("stream_stateful_dedup", oracle.query(f"""
SELECT DISTINCT bus_id, event_timestamp, 'kept' AS fate, NULL AS _source_file, NULL AS _batch_id FROM ({_SPLIT}) s WHERE NOT behind
UNION ALL SELECT bus_id, event_timestamp, 'late', _source_file, _batch_id FROM ({_SPLIT}) s WHERE behind"""))
def q_stream_stateful_dedup(spark, sf_dir):
    """One row per (bus, time) by watermarked state; rows behind the watermark go to their own table."""
    root = _root(spark, "stateful")
    stg = _arrivals(spark, sf_dir, root, lambda stg: late.dedup_stream(spark, f"{root}/split", stg, f"{root}/kept", f"{root}/_kept"))
    kept = spark.read.parquet(f"{root}/kept").select("bus_id", "event_timestamp", F.lit("kept").alias("fate"),
                                                     F.lit(None).cast("string").alias("_source_file"), F.lit(None).cast("string").alias("_batch_id"))
    behind = late.late_rows(spark, f"{root}/split", stg).select("bus_id", "event_timestamp", F.lit("late").alias("fate"), "_source_file", "_batch_id")
    return kept.unionByName(behind)


@register("stream_windows_with_late_rows", oracle.query("SELECT * FROM fct_occupancy_by_hour"))
def q_stream_windows_with_late_rows(spark, sf_dir):
    """Hourly windows over several triggers, state bounded by the watermark, late rows merged: the totals of all rows."""
    root = _root(spark, "windows")
    stg = _arrivals(spark, sf_dir, root, lambda stg: late.window_stream(spark, f"{root}/split", stg, f"{root}/hours", f"{root}/_hours"))
    return late.merged_hours(spark, f"{root}/hours", late.late_rows(spark, f"{root}/split", stg))


@register("stream_dedup_levels", oracle.query(f"""
SELECT * EXCLUDE (rn), true AS few_runs FROM (
  SELECT *, row_number() OVER (PARTITION BY bus_id, event_timestamp ORDER BY {oracle.DEDUP_ORDER_SQL}) AS rn
  FROM stg_vehicle_positions) d
WHERE rn = 1"""))
def q_stream_dedup_levels(spark, sf_dir):
    """Latest-wins dedup of many micro-batches in levels of merged runs; reading merges few of them."""
    root = _root(spark, "levels")
    fixtures.bronze_table(spark, sf_dir, "vehicle_positions").repartition(9).write.parquet(f"{root}/positions")
    stg = staging.stg_vehicle_positions(feeds.positions_stream(spark, f"{root}/positions", max_files_per_trigger=1))
    feeds.await_all(levels.levelled_log_stream(stg, f"{root}/log", f"{root}/_log"))
    few = len(levels.live_runs(spark, f"{root}/log")) <= 2 * levels.FANOUT
    return levels.latest(spark, f"{root}/log", stg.schema).withColumn("few_runs", F.lit(few))


# --- refresh by key

def _late_part(positions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(early, late, withdrawn) bronze positions: rows of some buses on four days come late, copies of a day are withdrawn."""
    day = C("ingestion_date")
    comes_late = (F.pmod(F.crc32(F.coalesce("bus_id", F.lit("")).cast("binary")), F.lit(5)) == 0) & day.between(
        F.lit("2026-01-10").cast("date"), F.lit("2026-01-13").cast("date"))
    withdrawn = positions.where(day == F.lit("2026-01-20").cast("date")).withColumns({
        "event_timestamp": C("event_timestamp") + F.expr("INTERVAL 41 DAY"), "ingestion_date": F.date_add(day, 41)})
    return positions.where(~F.coalesce(comes_late, F.lit(False))), positions.where(comes_late), withdrawn


def refreshed_by_key(spark, sf_dir, model: str) -> keyed.KeyedTable:
    """A table built without the late rows and with rows withdrawn later, then refreshed by the keys they touch."""
    full = fixtures.Bronze(spark, sf_dir)
    early, behind, withdrawn = _late_part(full["vehicle_positions"])
    first = {name: full[name] for name in fixtures.ADAPTERS} | {"vehicle_positions": early.unionByName(withdrawn)}
    table = keyed.KeyedTable(spark, _root(spark, f"keyed-{model}"), model)
    table.create(Warehouse(spark, first))
    changed = keyed.staged_positions(behind.unionByName(withdrawn))
    everything = keyed.staged_positions(first["vehicle_positions"].unionByName(behind))
    table.refresh(full, keyed.changed_keys(changed, model, everything), version=1)
    return table


def _register_keyed(model: str) -> None:
    @register(f"gold_key_refresh_{model.removeprefix('fct_')}", oracle.model_sql(model))
    def refresh(spark, sf_dir):
        return refreshed_by_key(spark, sf_dir, model).read().drop("_dbt_updated_at")

    refresh.__doc__ = f"D1-D3/A19: {model} after late and withdrawn rows, of which only the keys are rewritten, equals a full build."


for _model in keyed.KEYED_MODELS:
    _register_keyed(_model)


# --- co-located joins

def _bucketed(spark, sf_dir):
    wh, database = _wh(spark, sf_dir), f"colocated_{uuid.uuid4().hex[:12]}"
    colocated.publish_bucketed(wh, database)
    return wh, database


@register("fact_stop_times_colocated", oracle.model_sql("fact_stop_times"))
def q_fact_stop_times_colocated(spark, sf_dir):
    """The stop-time fact from bucketed tables, without a shuffle on the trip."""
    wh, database = _bucketed(spark, sf_dir)
    return colocated.fact_stop_times(spark, database, wh.dim_stops)


@register("route_analytics_colocated", oracle.model_sql("fct_route_analytics"))
def q_route_analytics_colocated(spark, sf_dir):
    """Route analytics from bucketed tables; per-trip maxima need no shuffle."""
    wh, database = _bucketed(spark, sf_dir)
    return colocated.fct_route_analytics(spark, database, wh.dim_stops).drop("_dbt_updated_at")


# --- two-output casts

@register("staging_rejects", oracle.query(_cast_failures_sql()))
def q_staging_rejects(spark, sf_dir):
    """Static tables loaded with two outputs; what the casts reject, read back from the quarantine, and non-finite speeds."""
    root, bronze = _root(spark, "casts"), fixtures.Bronze(spark, sf_dir)
    for table in casts.STAGE:
        casts.load_cast(spark, bronze[table], table, f"{root}/{table}", f"{root}/quarantine")
    return casts.read_rejects(spark, f"{root}/quarantine").unionByName(
        quality.non_finite(bronze["vehicle_positions"], "speed", "bus_id", "vehicle_positions"))
