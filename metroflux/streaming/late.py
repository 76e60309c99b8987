"""Stateful streams that lose no late row: dedup within a watermark, and hourly event-time windows.

``split_late`` deals every micro-batch by the watermark that the batches before it left:
rows behind it go to a table of their own, all others on to the stateful streams, whose state
the watermark bounds.  A row's time is its event time, but not after its load time, so a clock that
runs ahead cannot move the watermark.  Each batch writes its highest time, its late and its on-time
rows under ``micro_batch=N``, so a replayed batch replaces its own output and sees the same watermark.

A batch is as many files as it has tasks.  Its on-time rows appear as one folder, renamed when complete, and
a trigger of a stateful stream takes the folders that are there, so it never splits a batch: rows of
a batch split over two triggers could fall behind the watermark of the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from metroflux.functions import exprs as X
from metroflux.operators import gold
from metroflux.sources.ledger import read_or_none
from metroflux.streaming.feeds import HOURLY_KEYS
from metroflux.streaming.levels import filesystem

C = F.col
DELAY = "2 days"
AT = "_at"


def event_time() -> Column:
    """Event time, bounded by the load time."""
    return F.least(C("event_timestamp").cast("timestamp"), C("_ingestion_timestamp"))


def _folder(root: str, name: str, batch_id: int) -> str:
    return f"{root}/{name}/micro_batch={batch_id}"


def _publish(spark: SparkSession, staged: str, folder: str) -> None:
    """Rename a written folder into its place, in that of an earlier try."""
    fs, target = filesystem(spark, folder)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(filesystem(spark, staged)[1], target):
        raise OSError(f"{staged} was not renamed to {folder}")


def split_late(stg_positions: DataFrame, root: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """On-time rows to ``root/on_time``, rows behind the watermark to ``root/late``; both keep all columns and ``_at``."""
    root = root.rstrip("/")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        highs = read_or_none(spark, "high timestamp, micro_batch int", f"{root}/highs")
        high = None if highs is None else highs.where(C("micro_batch") < batch_id).agg(F.max("high")).first()[0]
        rows = batch.withColumn(AT, event_time()).persist()
        try:
            # A row at the watermark itself is late to the stateful operators, too.
            behind = F.lit(False) if high is None else F.coalesce(C(AT) <= F.lit(high) - F.expr(f"INTERVAL {delay}"), F.lit(False))
            rows.where(behind).write.mode("overwrite").parquet(_folder(root, "late", batch_id))
            rows.where(~behind).write.mode("overwrite").parquet(_folder(root, "staged", batch_id))
            rows.agg(F.max(AT).alias("high")).write.mode("overwrite").parquet(_folder(root, "highs", batch_id))
            _publish(spark, _folder(root, "staged", batch_id), _folder(root, "on_time", batch_id))
        finally:
            rows.unpersist()

    return (stg_positions.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _split_schema(stg_positions: DataFrame) -> StructType:
    return StructType([*stg_positions.schema.fields, StructField(AT, TimestampType())])


def on_time_stream(spark: SparkSession, root: str, stg_positions: DataFrame, delay: str = DELAY) -> DataFrame:
    """The on-time rows as a stream with its watermark, whole micro-batches of the split at a time."""
    folder = f"{root.rstrip('/')}/on_time"
    schema = StructType([*_split_schema(stg_positions).fields, StructField("micro_batch", IntegerType())])
    return spark.readStream.schema(schema).parquet(folder).withWatermark(AT, delay)


def late_rows(spark: SparkSession, root: str, stg_positions: DataFrame) -> DataFrame:
    return spark.read.schema(_split_schema(stg_positions)).parquet(f"{root.rstrip('/')}/late")


def dedup_stream(spark: SparkSession, root: str, stg_positions: DataFrame, out: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """The first row of each (bus, time), by state that the watermark bounds; exactly once through the file sink."""
    rows = on_time_stream(spark, root, stg_positions, delay).dropDuplicatesWithinWatermark(["bus_id", "event_timestamp"])
    return (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


def _hourly_aggs() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_positions"), F.sum(F.round(C("speed") * 10).cast("long")).alias("speed_tenths"),
            F.count("speed").alias("count_speed_readings"), *X.occupancy_bucket_aggs(C("occupancy_status"))]


WINDOW_KEYS = ["window_start", *HOURLY_KEYS, "bus_id"]


def window_stream(spark: SparkSession, root: str, stg_positions: DataFrame, out: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """Hourly windows per route and bus, held as state until the watermark passes them.

    Update mode: each trigger writes the windows it changed with their totals so far.  Distinct buses are exact as
    the bus is a key; the window is on the bounded time, so the state is too.
    """
    rows = on_time_stream(spark, root, stg_positions, delay).where(C("occupancy_status").isNotNull())
    windows = (rows.groupBy(F.window(AT, "1 hour").alias("window"), *HOURLY_KEYS, "bus_id").agg(*_hourly_aggs())
               .select(C("window.start").alias("window_start"), *HOURLY_KEYS, "bus_id", "total_positions", "speed_tenths",
                       "count_speed_readings", *[name for name, _ in X.OCCUPANCY_BUCKETS]))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/micro_batch={batch_id}")

    return (windows.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def merged_hours(spark: SparkSession, windows: str, late: DataFrame, min_positions: int = gold.HOURLY_MIN_POSITIONS) -> DataFrame:
    """The hourly fact of all rows: the last version of each window, and the late rows' share."""
    sums = ["total_positions", "speed_tenths", "count_speed_readings", *[name for name, _ in X.OCCUPANCY_BUCKETS]]
    versions = spark.read.parquet(windows)
    last = (versions.groupBy(*WINDOW_KEYS).agg(F.max_by(F.struct(*sums), "micro_batch").alias("s"))
            .select(*HOURLY_KEYS, "bus_id", "s.*"))
    behind = late.where(C("occupancy_status").isNotNull()).groupBy(*HOURLY_KEYS, "bus_id").agg(*_hourly_aggs())
    hours = last.unionByName(behind.select(*last.columns)).groupBy(*HOURLY_KEYS).agg(
        F.sum("total_positions").cast("long").alias("total_positions"), F.countDistinct("bus_id").alias("active_buses"),
        (F.sum("speed_tenths") / F.lit(10.0)).alias("sum_speed"), *[F.sum(c).cast("long").alias(c) for c in sums[2:]])
    return hours.where(C("total_positions") >= min_positions).withColumn("time_period", X.time_period(C("event_hour")))
