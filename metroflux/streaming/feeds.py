"""Structured Streaming forms of the ingestion and hourly measures.

* ``ingest_stream``        landed snapshots -> bronze rows + quarantine, each
                           file exactly once (file source + checkpoint), two
                           sinks per micro-batch via ``foreachBatch``.
* ``latest_log_stream``    latest-wins dedup: every micro-batch is reduced to
                           its latest row per (bus, time) and appended to a
                           log; ``compact_latest`` resolves across batches.
* ``hourly_partials_stream`` additive hourly measures per micro-batch; the
                           reader sums the partials (the measures are
                           additive, so any batching gives the same totals).
* ``windowed_occupancy``   event-time windows with a watermark for
                           continuously running jobs (late rows beyond the
                           watermark are dropped, state stays bounded).

Every micro-batch writes under ``.../micro_batch=N`` with overwrite, so a
replayed batch after a failure replaces its own output instead of
duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metroflux.functions import exprs as X
from metroflux.operators import gold, silver
from metroflux.sources import bronze as B

C = F.col


def landing_stream(spark: SparkSession, base_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream landed JSON-lines snapshots (``date=/hour=`` folders) as file rows."""
    r = spark.readStream.format("text").schema(B.LANDING_LINE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(base_path)
    return df.select(B.landed_name(C("_metadata.file_path")).alias("file_name"), "date", "hour",
                     F.octet_length("value").cast("long").alias("length"), C("value").alias("content"))


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/micro_batch={batch_id}"


def ingest_stream(files: DataFrame, bronze_path: str, quarantine_path: str, checkpoint: str,
                  source_system: str = "GTFS_RT", loaded_at=None) -> StreamingQuery:
    """I1 + I4: decode each micro-batch once, write records and quarantine rows.

    Quarantine is written first so errors are kept even if the record write
    fails; both writes are idempotent per batch id.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        decoded = B.decode(batch).persist()
        try:
            tag = f"stream-{batch_id}"
            B.quarantine_rows(B.errors(decoded, tag), loaded_at).write.mode("overwrite") \
                .parquet(_batch_path(quarantine_path, batch_id))
            B.enrich(B.records(decoded), tag, source_system, loaded_at).write.mode("overwrite") \
                .partitionBy("ingestion_date").parquet(_batch_path(bronze_path, batch_id))
        finally:
            decoded.unpersist()

    return (files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def positions_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream bronze position files (parquet) with the bronze schema."""
    r = spark.readStream.schema(B.BRONZE_TABLE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def latest_log_stream(stg_positions: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch's latest row per (bus, local time) to a log.

    Within a batch the same ``row_number`` reduction as the batch fact runs;
    across batches ``compact_latest`` picks the winner, so the result is
    exactly latest-wins however the input is split into batches.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        silver.latest_positions(batch).write.mode("overwrite").parquet(_batch_path(log_path, batch_id))

    return (stg_positions.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def compact_latest(spark: SparkSession, log_path: str) -> DataFrame:
    """Latest row per (bus, time) over every logged micro-batch."""
    return silver.latest_positions(spark.read.parquet(log_path).drop("micro_batch"))


def compact_log(spark: SparkSession, log_path: str, compacted_path: str) -> DataFrame:
    """Write the log's latest rows to ``compacted_path`` and return them.

    A later ``latest_log_stream`` starts a new log; ``latest_positions`` over the
    union of the compacted table and that log gives the same rows as over all
    batches, since the latest of the latest is the latest.
    """
    compact_latest(spark, log_path).write.mode("overwrite").parquet(compacted_path)
    return spark.read.parquet(compacted_path)


HOURLY_KEYS = ["route_id", "event_date", "event_hour"]


def hourly_partials_stream(stg_positions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Additive hourly measures of each micro-batch per bus (positions with occupancy).

    Partials keep the bus, so distinct buses are exact on read; their number is
    bounded by the buses on the road in an hour.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        p = batch.where(C("occupancy_status").isNotNull())
        part = p.groupBy(*HOURLY_KEYS, "bus_id").agg(
            F.count(F.lit(1)).alias("total_positions"),
            F.sum(F.round(C("speed") * 10).cast("long")).alias("speed_tenths"),
            F.count("speed").alias("count_speed_readings"),
            *X.occupancy_bucket_aggs(C("occupancy_status")))
        part.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return (stg_positions.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def hourly_from_partials(spark: SparkSession, path: str,
                         min_positions: int = gold.HOURLY_MIN_POSITIONS) -> DataFrame:
    """Sum the per-batch partials and apply the hourly HAVING threshold."""
    buckets = [name for name, _ in X.OCCUPANCY_BUCKETS]
    parts = spark.read.parquet(path)
    g = parts.groupBy(*HOURLY_KEYS).agg(
        F.sum("total_positions").cast("long").alias("total_positions"),
        F.countDistinct("bus_id").alias("active_buses"),
        (F.sum("speed_tenths") / F.lit(10.0)).alias("sum_speed"),
        F.sum("count_speed_readings").cast("long").alias("count_speed_readings"),
        *[F.sum(b).cast("long").alias(b) for b in buckets])
    return (g.where(C("total_positions") >= min_positions)
            .withColumn("time_period", X.time_period(C("event_hour"))))


def windowed_occupancy(positions: DataFrame, delay: str = "1 hour", ts_col: str = "event_timestamp") -> DataFrame:
    """Hourly event-time windows per route with a watermark (continuous runs).

    Exact distinct counts are not available on streams; active buses use
    ``approx_count_distinct``.  Timestamps must be TIMESTAMP (not _NTZ) for
    the watermark, so local wall-clock times are cast first.
    """
    p = positions.where(C("occupancy_status").isNotNull()).withColumn("_ts", C(ts_col).cast("timestamp"))
    return (p.withWatermark("_ts", delay)
            .groupBy(F.window("_ts", "1 hour").alias("window"), "route_id")
            .agg(F.count(F.lit(1)).alias("total_positions"),
                 F.approx_count_distinct("bus_id").alias("active_buses_approx"),
                 *X.occupancy_bucket_aggs(C("occupancy_status"))))


def await_all(*queries: StreamingQuery, timeout_s: float | None = None) -> None:
    for q in queries:
        q.awaitTermination(timeout_s)
        if q.exception() is not None:
            raise q.exception()
