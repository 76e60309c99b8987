"""Registered streaming queries.

Each query lands stand-in input files under the session's shared
checkpoint folder, runs a Structured Streaming job to completion with an
AvailableNow trigger, and returns the sink read back as a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from metroflux.operators import staging
from metroflux.plans import oracle
from metroflux.plans.q_bronze import LOADED_AT, sql as bronze_sql
from metroflux.plans.registry import register
from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures
from metroflux.streaming import feeds as S

C = F.col


def _root(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"


def _ingest(spark, sf_dir) -> str:
    root = _root(spark)
    fixtures.write_landing(fixtures.feed_landing(spark, sf_dir), f"{root}/landing")
    files = S.landing_stream(spark, f"{root}/landing", max_files_per_trigger=360)
    q = S.ingest_stream(files, f"{root}/bronze", f"{root}/quarantine", f"{root}/_chk",
                        loaded_at=F.lit(LOADED_AT).cast("timestamp"))
    S.await_all(q)
    return root


def _positions_stream(spark, sf_dir):
    root = _root(spark)
    (fixtures.bronze_table(spark, sf_dir, "vehicle_positions").repartition(8)
     .write.parquet(f"{root}/positions"))
    stream = S.positions_stream(spark, f"{root}/positions", max_files_per_trigger=2)
    return root, staging.stg_vehicle_positions(stream)


def _landed_in(spark, root, rows, file_col):
    """Rows with the folder of their landed file, found by its name, and whether their batch is the micro-batch that wrote them.

    The stand-in writer names the files, so a file is known by its folder, which holds one.
    """
    files = B.discover_files(spark, f"{root}/landing", "*.txt").select(
        C("file_name").alias(file_col), C("date").alias("landing_date"), C("hour").alias("landing_hour"))
    own = C("batch_id") == F.concat(F.lit("stream-"), C("micro_batch").cast("string"))
    return rows.withColumn("own_batch", own).join(files, file_col, "left").drop(file_col, "batch_id", "micro_batch")


@register("stream_ingest", bronze_sql("""
SELECT * EXCLUDE (_landing_date, _landing_hour, ingestion_file, batch_id), _landing_date AS landing_date,
  _landing_hour AS landing_hour, true AS own_batch FROM enr"""))
def q_stream_ingest(spark, sf_dir):
    """Landed snapshot files streamed once each into bronze rows (AvailableNow)."""
    root = _ingest(spark, sf_dir)
    return _landed_in(spark, root, spark.read.parquet(f"{root}/bronze"), "ingestion_file")


@register("stream_quarantine", bronze_sql(f"""
SELECT source_table, error_type, error_message, raw_record, raw_entity, TIMESTAMP '{LOADED_AT}' AS created_at,
  _landing_date AS landing_date, _landing_hour AS landing_hour, true AS own_batch FROM errs"""))
def q_stream_quarantine(spark, sf_dir):
    """I4: the quarantine sink of the same stream (second output of each micro-batch)."""
    root = _ingest(spark, sf_dir)
    return _landed_in(spark, root, spark.read.parquet(f"{root}/quarantine"), "source_file")


@register("stream_dedup", oracle.query(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY bus_id, event_timestamp ORDER BY {oracle.DEDUP_ORDER_SQL}) AS rn
  FROM stg_vehicle_positions) d
WHERE rn = 1"""))
def q_stream_dedup(spark, sf_dir):
    """Latest-wins (bus, time) dedup over a multi-batch position stream."""
    root, stg = _positions_stream(spark, sf_dir)
    S.await_all(S.latest_log_stream(stg, f"{root}/log", f"{root}/_chk"))
    return S.compact_latest(spark, f"{root}/log")


@register("stream_hourly_occupancy", oracle.query(
    "SELECT * FROM fct_occupancy_by_hour"))
def q_stream_hourly_occupancy(spark, sf_dir):
    """Hourly occupancy from per-batch partials per bus."""
    root, stg = _positions_stream(spark, sf_dir)
    S.await_all(S.hourly_partials_stream(stg, f"{root}/partials", f"{root}/_chk"))
    return S.hourly_from_partials(spark, f"{root}/partials")
