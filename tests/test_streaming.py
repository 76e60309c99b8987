"""Structured Streaming behaviour: exactly-once files, batch parity, watermark windows."""

import uuid

from pyspark.sql import functions as F

from metroflux.operators import gold, staging
from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures
from metroflux.streaming import feeds as S
from tests.conftest import SMOKE


def _root(spark):
    return f"{checkpoint_dir(spark)}/st-{uuid.uuid4().hex}"


def test_each_landed_file_is_ingested_once(spark):
    root = _root(spark)
    fixtures.write_landing(fixtures.feed_landing(spark, SMOKE), f"{root}/landing")
    for _ in range(2):  # second run with the same checkpoint finds nothing new
        files = S.landing_stream(spark, f"{root}/landing", max_files_per_trigger=200)
        S.await_all(S.ingest_stream(files, f"{root}/bronze", f"{root}/q", f"{root}/_chk"))
    got = spark.read.parquet(f"{root}/bronze").count()
    want = B.records(B.decode(fixtures.feed_landing(spark, SMOKE))).count()
    assert got == want


def test_stream_hourly_equals_batch(spark):
    root = _root(spark)
    fixtures.bronze_table(spark, SMOKE, "vehicle_positions").repartition(4).write.parquet(f"{root}/pos")
    stg = staging.stg_vehicle_positions(S.positions_stream(spark, f"{root}/pos", max_files_per_trigger=1))
    S.await_all(S.hourly_partials_stream(stg, f"{root}/parts", f"{root}/_chk"))
    streamed = S.hourly_from_partials(spark, f"{root}/parts")
    batch = gold.fct_occupancy_by_hour(staging.stg_vehicle_positions(
        fixtures.bronze_table(spark, SMOKE, "vehicle_positions")))
    streamed = streamed.select(*batch.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_windowed_occupancy_emits_closed_windows(spark):
    root = _root(spark)
    fixtures.bronze_table(spark, SMOKE, "vehicle_positions").repartition(4).write.parquet(f"{root}/pos")
    # One data batch: the watermark moves only after it, so no row is late.
    stg = staging.stg_vehicle_positions(S.positions_stream(spark, f"{root}/pos"))
    q = (S.windowed_occupancy(stg).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{root}/_chk").trigger(availableNow=True).start(f"{root}/win"))
    S.await_all(q)
    win = spark.read.parquet(f"{root}/win")
    stg_batch = (staging.stg_vehicle_positions(fixtures.bronze_table(spark, SMOKE, "vehicle_positions"))
                 .where(F.col("occupancy_status").isNotNull()))
    batch = (stg_batch.groupBy(F.window(F.col("event_timestamp").cast("timestamp"), "1 hour").alias("window"),
                               "route_id").agg(F.count(F.lit(1)).alias("total_positions")))
    watermark = stg_batch.agg(F.max(F.col("event_timestamp").cast("timestamp"))).first()[0]
    import datetime as dt
    closed = batch.where(F.col("window.end") <= F.lit(watermark - dt.timedelta(hours=1)))
    # Exactly the windows closed by the watermark are emitted, each with its full count.
    assert win.count() == closed.count() > 0
    assert win.select("window", "route_id", "total_positions").exceptAll(closed).count() == 0
