"""Registered bronze-ingestion queries.

Inputs are landed feed snapshots rebuilt from ``events`` by
``fixtures.feed_landing``; every query runs the library's decode /
quarantine / enrich / sink code on all of them.  The oracle derives the
expected rows straight from ``events`` with the same fixed construction
rules, without parsing any JSON.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from metroflux.operators import quality
from metroflux.plans import oracle
from metroflux.plans.registry import register
from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures

C = F.col
BATCH = "b-test"
LOADED_AT = "2026-02-01 07:00:00"
RELOAD_DATE = "2026-01-10"
LOADED_BEFORE = "2026-01-16"

EV = """ev0 AS (
  SELECT *,
    CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'corrupt'
         WHEN value < 1 THEN 'tiny'
         WHEN event_type = 'purchase' AND event_id % 7 = 0 AND event_id % 211 <> 0 THEN 'bad_entity'
         ELSE 'feed' END AS kind,
    concat('feed_', lpad(CAST(event_id AS VARCHAR), 9, '0'), '.pb') AS file_name,
    CAST(CAST(ts + INTERVAL 731 DAY AS DATE) AS VARCHAR) AS date,
    lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hour
  FROM events),
ev1 AS (
  SELECT *,
    concat('{"id":"e', CAST(event_id AS VARCHAR), '","vehicle":{"vehicle":{"id":"',
      CASE WHEN event_id % 101 <> 0 THEN CAST(user_id AS VARCHAR) END, '"}',
      CASE WHEN event_id % 23 <> 0 THEN concat(',"trip":{',
        CASE WHEN event_id % 29 <> 0 THEN concat('"trip_id":"', CAST(event_id % 500 AS VARCHAR), '",') END, '"route_id":"',
        CASE WHEN user_id % 30 < 12 THEN '1' WHEN user_id % 30 < 18 THEN '2' ELSE CAST(user_id % 30 AS VARCHAR) END,
        '","start_time":"', lpad(CAST(hour(ts) AS VARCHAR), 2, '0'), ':00:00","start_date":"', strftime(ts, '%Y%m%d'), '"}') END,
      CASE WHEN event_id % 211 <> 0 THEN concat(',"position":{"latitude":',
        CASE WHEN event_type = 'purchase' AND event_id % 7 = 0 THEN '"n/a"' ELSE CAST(45.4e0 + (event_id % 1000) / 5000e0 AS VARCHAR) END,
        ',"longitude":', CAST(-73.9e0 + (event_id % 700) / 2000e0 AS VARCHAR),
        CASE WHEN event_id % 17 <> 0 THEN concat(',"speed":', CAST(value / 10 AS VARCHAR)) END,
        ',"bearing":', CAST(CAST(event_id % 360 AS DOUBLE) AS VARCHAR), '}') END,
      CASE WHEN event_id % 5 <> 4 THEN concat(',"current_status":', CAST(event_id % 5 AS VARCHAR)) END,
      CASE WHEN event_id % 9 <> 8 THEN concat(',"occupancy_status":', CAST(event_id % 9 AS VARCHAR)) END,
      CASE WHEN event_id % 997 <> 0 THEN concat(',"timestamp":',
        CAST(datediff('second', TIMESTAMP '1970-01-01 00:00:00', ts + INTERVAL 731 DAY) AS VARCHAR)) END, '}}') AS entity
  FROM ev0),
ev AS (
  SELECT *, CAST(length(CASE kind
      WHEN 'corrupt' THEN concat('{"header":{"gtfs_realtime_version":"2.0"},"entity":[', repeat('#', 120))
      WHEN 'tiny' THEN '{"entity":[]}'
      ELSE concat('{"header":{"gtfs_realtime_version":"2.0","timestamp":',
        CAST(datediff('second', TIMESTAMP '1970-01-01 00:00:00', ts + INTERVAL 731 DAY) AS VARCHAR), '},"entity":[', entity,
        CASE WHEN event_type = 'click' THEN concat(',{"id":"a', CAST(event_id AS VARCHAR), '","alert":{"header_text":"detour"}}') END,
        ']}') END) AS BIGINT) AS length
  FROM ev1)"""

RECORDS = """recs AS (
  SELECT
    CASE WHEN event_id % 101 = 0 THEN concat('e', CAST(event_id AS VARCHAR)) ELSE CAST(user_id AS VARCHAR) END
      AS bus_id,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '' ELSE CAST(event_id % 500 AS VARCHAR) END
      AS trip_id,
    CASE WHEN event_id % 23 = 0 THEN NULL
         WHEN user_id % 30 < 12 THEN '1' WHEN user_id % 30 < 18 THEN '2'
         ELSE CAST(user_id % 30 AS VARCHAR) END AS route_id,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE concat(lpad(CAST(hour(ts) AS VARCHAR), 2, '0'), ':00:00') END
      AS start_time,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE replace(substr(CAST(ts AS VARCHAR), 1, 10), '-', '') END
      AS start_date,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE 45.4e0 + (event_id % 1000) / 5000e0 END AS latitude,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE -73.9e0 + (event_id % 700) / 2000e0 END AS longitude,
    CASE WHEN event_id % 211 = 0 OR event_id % 17 = 0 THEN NULL ELSE value / 10 END AS speed,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END AS bearing,
    CASE WHEN event_id % 5 = 4 THEN NULL ELSE CAST(event_id % 5 AS INTEGER) END AS current_status,
    CASE WHEN event_id % 9 = 8 THEN NULL ELSE CAST(event_id % 9 AS INTEGER) END AS occupancy_status,
    CASE WHEN event_id % 997 = 0 THEN CAST(0 AS BIGINT)
         ELSE datediff('second', TIMESTAMP '1970-01-01 00:00:00', ts + INTERVAL 731 DAY) END AS event_timestamp_raw,
    file_name AS ingestion_file, date AS _landing_date, hour AS _landing_hour
  FROM ev WHERE kind = 'feed')"""

ENRICHED = f"""enr AS (
  SELECT bus_id, trip_id, route_id, start_time, start_date, latitude, longitude, speed, bearing,
    current_status, occupancy_status, event_timestamp_raw, ingestion_file,
    TIMESTAMP '1970-01-01 00:00:00' + event_timestamp_raw * INTERVAL 1 SECOND AS event_timestamp,
    TIMESTAMP '{LOADED_AT}' AS ingestion_timestamp,
    CAST(TIMESTAMP '1970-01-01 00:00:00' + event_timestamp_raw * INTERVAL 1 SECOND AS DATE) AS ingestion_date,
    'GTFS_RT' AS source_system, '{BATCH}' AS batch_id, _landing_date, _landing_hour
  FROM recs)"""

ERRORS = f"""errs AS (
  SELECT 'vehicle_positions' AS source_table, file_name AS source_file,
    CASE WHEN kind = 'corrupt' THEN 'FILE_READ_ERROR' ELSE 'RECORD_PARSE_ERROR' END AS error_type,
    CASE WHEN kind = 'corrupt' THEN concat('malformed feed document (', CAST(length AS VARCHAR), ' bytes)')
         ELSE 'malformed entity #0' END AS error_message,
    CASE WHEN kind <> 'corrupt' THEN left(entity, 1000) END AS raw_record,
    CASE WHEN kind <> 'corrupt' THEN entity END AS raw_entity,
    '{BATCH}' AS batch_id, date AS _landing_date, hour AS _landing_hour
  FROM ev WHERE kind IN ('corrupt', 'bad_entity'))"""


def sql(select: str) -> str:
    # The oracle needs only the driver views, not the warehouse CTEs.
    return f"WITH {EV},\n{RECORDS},\n{ENRICHED},\n{ERRORS}\n{select}"


def _decoded(spark, sf_dir):
    return B.decode(fixtures.feed_landing(spark, sf_dir))


def _enriched(spark, sf_dir):
    return B.enrich(B.records(_decoded(spark, sf_dir)), BATCH, "GTFS_RT",
                    loaded_at=F.lit(LOADED_AT).cast("timestamp"))


@register("bronze_feed_explode", sql("SELECT * EXCLUDE (_landing_date, _landing_hour) FROM recs"))
def q_bronze_feed_explode(spark, sf_dir):
    """Decode every landed snapshot and flatten vehicle entities to bronze rows."""
    return B.records(_decoded(spark, sf_dir))


@register("bronze_quarantine_split", sql("SELECT * EXCLUDE (_landing_date, _landing_hour) FROM errs"))
def q_bronze_quarantine_split(spark, sf_dir):
    """Undecodable files and entities as dead-letter rows, with their raw text."""
    return B.errors(_decoded(spark, sf_dir), BATCH)


@register("bronze_enrich", sql("SELECT * EXCLUDE (_landing_date, _landing_hour) FROM enr"))
def q_bronze_enrich(spark, sf_dir):
    """Event time from epoch seconds, load stamp, event date, source and batch."""
    return _enriched(spark, sf_dir)


@register("bronze_payload_check", sql("""
SELECT file_name, length, CASE WHEN kind = 'tiny' THEN 'too_small' ELSE 'ok' END AS payload_status FROM ev"""))
def q_bronze_payload_check(spark, sf_dir):
    """Flag landed payloads under 100 bytes."""
    return B.payload_check(fixtures.feed_landing(spark, sf_dir))


@register("bronze_run_status", sql("""
SELECT date, file_count, record_count, error_count,
  CASE WHEN file_count = 0 THEN 'NO_NEW_FILES'
       WHEN record_count = 0 AND error_count > 0 THEN 'FAILED'
       WHEN record_count = 0 THEN 'NO_DATA'
       WHEN error_count = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
  record_count = 0 AND file_count > 0 AS silent_failure
FROM (SELECT date, COUNT(*) AS file_count,
        CAST(SUM(CASE WHEN kind = 'feed' THEN 1 ELSE 0 END) AS BIGINT) AS record_count,
        CAST(SUM(CASE WHEN kind IN ('corrupt', 'bad_entity') THEN 1 ELSE 0 END) AS BIGINT) AS error_count
      FROM ev GROUP BY date) g"""))
def q_bronze_run_status(spark, sf_dir):
    """Files, records, errors, run status and silent-failure flag per landing date."""
    return B.run_summary(_decoded(spark, sf_dir), ["date"])


@register("bronze_error_breakdown", sql("""
SELECT error_type, COUNT(*) AS errors FROM errs GROUP BY error_type"""))
def q_bronze_error_breakdown(spark, sf_dir):
    """Quarantined rows per error type."""
    return B.error_breakdown(B.errors(_decoded(spark, sf_dir), BATCH))


@register("bronze_profile", sql("""
SELECT ingestion_date, COUNT(*) AS records, COUNT(DISTINCT bus_id) AS unique_buses,
  COUNT(DISTINCT ingestion_file) AS files, MIN(event_timestamp) AS earliest, MAX(event_timestamp) AS latest
FROM enr GROUP BY ingestion_date ORDER BY ingestion_date DESC LIMIT 7"""))
def q_bronze_profile(spark, sf_dir):
    """Per-ingestion-date profile of the bronze table, newest 7 dates."""
    return B.profile(_enriched(spark, sf_dir))


@register("bronze_table_counts", sql("""
SELECT 'vehicle_positions' AS table_name, COUNT(*) AS rows FROM enr
UNION ALL SELECT 'quarantine' AS table_name, COUNT(*) AS rows FROM errs"""))
def q_bronze_table_counts(spark, sf_dir):
    """Total rows of the bronze and quarantine tables."""
    d = _decoded(spark, sf_dir)
    recs = B.enrich(B.records(d), BATCH, "GTFS_RT", loaded_at=F.lit(LOADED_AT).cast("timestamp"))
    return B.table_count(recs, "vehicle_positions").unionByName(B.table_count(B.errors(d, BATCH), "quarantine"))


@register("bronze_quarantine_preview", sql(f"""
SELECT source_file, error_type, left(error_message, 50) AS error_preview, TIMESTAMP '{LOADED_AT}' AS created_at
FROM errs ORDER BY source_file DESC, error_type ASC LIMIT 5"""))
def q_bronze_quarantine_preview(spark, sf_dir):
    """Newest five quarantine rows with a 50-character message preview."""
    q = B.quarantine_rows(B.errors(_decoded(spark, sf_dir), BATCH), F.lit(LOADED_AT).cast("timestamp"))
    return B.quarantine_preview(q)


@register("bronze_batch_sample", sql(f"""
SELECT bus_id, route_id, latitude, longitude, speed, event_timestamp, ingestion_file
FROM enr WHERE batch_id = '{BATCH}' ORDER BY event_timestamp, bus_id, ingestion_file LIMIT 10"""))
def q_bronze_batch_sample(spark, sf_dir):
    """Ten rows of one batch, ordered by event time."""
    return B.batch_sample(_enriched(spark, sf_dir), BATCH)


@register("bronze_newest_files", sql("""
SELECT file_name, date, hour, size_kb, files FROM (
  SELECT * FROM (SELECT file_name, date, hour, round(length / 1024e0, 1) AS size_kb, CAST(NULL AS BIGINT) AS files
                 FROM ev ORDER BY file_name DESC LIMIT 5) n
  UNION ALL SELECT NULL, NULL, NULL, NULL, COUNT(*) FROM ev) r"""))
def q_bronze_newest_files(spark, sf_dir):
    """Newest five landed files by name with their size, and a row that tells how many files there are."""
    files = fixtures.feed_landing(spark, sf_dir)
    total = B.table_count(files, "landing").select(C("rows").alias("files"))
    return B.newest_files(files).unionByName(total, allowMissingColumns=True)


@register("bronze_incremental_files", sql(f"""
SELECT file_name, date, hour FROM ev
WHERE file_name NOT IN (SELECT ingestion_file FROM recs WHERE _landing_date < '{LOADED_BEFORE}')"""))
def q_bronze_incremental_files(spark, sf_dir):
    """A3-A5: files still to load = landed files minus the bronze watermark.

    Stand-in state: an earlier run already loaded the snapshots landed
    before 2026-01-16.  Files that produced no rows (corrupt or empty) are
    never in the watermark, so they are selected again.
    """
    files = fixtures.feed_landing(spark, sf_dir)
    loaded = B.records(B.decode(files.where(C("date") < LOADED_BEFORE)))
    return B.select_files(files, loaded, "incremental").select("file_name", "date", "hour")


@register("bronze_partition_overwrite", sql(f"""
SELECT ingestion_date, CASE WHEN ingestion_date = DATE '{RELOAD_DATE}' THEN 'reload' ELSE '{BATCH}' END
  AS batch_id, COUNT(*) AS records
FROM enr GROUP BY 1, 2"""))
def q_bronze_partition_overwrite(spark, sf_dir):
    """Full overwrite, then replace one ingestion_date partition, read back.

    Tables are written under the session's shared checkpoint folder.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/bronze-{uuid.uuid4().hex}"
    rows = _enriched(spark, sf_dir)
    B.write_bronze(rows, path, "overwrite")
    reload = rows.where(C("ingestion_date") == F.lit(RELOAD_DATE).cast("date")).withColumn("batch_id", F.lit("reload"))
    B.write_bronze(reload, path, "overwrite", process_date=RELOAD_DATE)
    table = B.read_bronze(spark, path)
    return table.groupBy("ingestion_date", "batch_id").agg(F.count(F.lit(1)).alias("records"))


LINEAGE = f"1 AS from_landed_file, TIMESTAMP '{LOADED_AT}' AS _ingestion_timestamp"


def _lineage(spark, loaded, path):
    """Rows with the source file checked against the files of ``path``: how many carry its name."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("_source_file")))
    seen = files.groupBy("_source_file").agg(F.count("*").cast("int").alias("from_landed_file"))
    return loaded.join(seen, "_source_file", "left").drop("_source_file")


@register("bronze_gtfs_csv_load", oracle.query(
    f"SELECT trip_id, route_id, service_id, shape_id, trip_headsign, direction_id, note_en, note_fr, {LINEAGE} FROM gtfs_trips"))
def q_bronze_gtfs_csv_load(spark, sf_dir):
    """Static trips written as a GTFS text file and loaded back as all-STRING columns."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/gtfs-{uuid.uuid4().hex}/trips"
    src = fixtures.bronze_table(spark, sf_dir, "gtfs_trips").select(*B.GTFS_COLUMNS["gtfs_trips"])
    src.write.option("header", True).csv(path)
    return _lineage(spark, B.read_gtfs_csv(spark, path, "gtfs_trips", loaded_at=F.lit(LOADED_AT).cast("timestamp")), path)


@register("bronze_weather_json_load", oracle.query(f"""
SELECT observation_time, temperature, feels_like, humidity, wind_speed, wind_direction, precipitation,
  weather_code, weather_description, {LINEAGE}, CAST(TIMESTAMP '{LOADED_AT}' AS DATE) AS _ingestion_date FROM weather"""))
def q_bronze_weather_json_load(spark, sf_dir):
    """Hourly weather written as per-day documents of parallel arrays, loaded back to rows."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/weather-{uuid.uuid4().hex}"
    fixtures.write_weather_documents(fixtures.bronze_table(spark, sf_dir, "weather"), path)
    return _lineage(spark, B.read_weather_json(spark, path, loaded_at=F.lit(LOADED_AT).cast("timestamp")), path)


@register("bronze_landing_listing", sql("""
SELECT date, hour, CAST(1 AS BIGINT) AS files, COUNT(*) AS snapshots FROM ev GROUP BY date, hour"""))
def q_bronze_landing_listing(spark, sf_dir):
    """A1/A2: landed date=/hour= folders listed with binaryFile, snapshots counted per folder.

    The stand-in writer puts one JSON-lines file in each folder.
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    fixtures.write_landing(fixtures.feed_landing(spark, sf_dir), base)
    files = B.discover_files(spark, base, glob="*.txt").groupBy("date", "hour").agg(
        F.count(F.lit(1)).alias("files"))
    lines = B.read_landing_lines(spark, base).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("snapshots"))
    return files.join(lines, ["date", "hour"], "full")


@register("bronze_ingest_run", sql("""
SELECT 'run-1' AS batch_id, file_count, record_count, error_count,
  CASE WHEN file_count = 0 THEN 'NO_NEW_FILES'
       WHEN record_count = 0 AND error_count > 0 THEN 'FAILED'
       WHEN record_count = 0 THEN 'NO_DATA'
       WHEN error_count = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
  record_count = 0 AND file_count > 0 AS silent_failure,
  record_count AS bronze_rows_written, error_count AS quarantine_rows_written
FROM (SELECT COUNT(*) AS file_count,
        CAST(SUM(CASE WHEN kind = 'feed' THEN 1 ELSE 0 END) AS BIGINT) AS record_count,
        CAST(SUM(CASE WHEN kind IN ('corrupt', 'bad_entity') THEN 1 ELSE 0 END) AS BIGINT) AS error_count
      FROM ev) t"""))
def q_bronze_ingest_run(spark, sf_dir):
    """One full ingest batch (decode once, quarantine first, write), its run summary.

    Written row counts are read back from the bronze and quarantine tables.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    summary = B.ingest(spark, fixtures.feed_landing(spark, sf_dir), f"{root}/bronze", f"{root}/quarantine",
                       batch_id="run-1", mode="full")
    written_rows = B.read_bronze(spark, f"{root}/bronze").count()
    quarantined = B.read_quarantine(spark, f"{root}/quarantine").count()
    return summary.withColumns({"bronze_rows_written": F.lit(written_rows).cast("long"),
                                "quarantine_rows_written": F.lit(quarantined).cast("long")})


@register("bronze_incremental_rerun", sql("""
SELECT batch_id, file_count, record_count, error_count, bronze_rows, quarantine_rows FROM (
  SELECT 'run-1' AS batch_id, COUNT(*) AS file_count, COUNT(*) FILTER (WHERE kind = 'feed') AS record_count,
    COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) AS error_count,
    COUNT(*) FILTER (WHERE kind = 'feed') AS bronze_rows,
    COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) AS quarantine_rows FROM ev
  UNION ALL SELECT 'run-2', 0, 0, 0, 0, 0) r"""))
def q_bronze_incremental_rerun(spark, sf_dir):
    """Two identical incremental runs; the second finds every file in the manifest and writes nothing."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/rerun-{uuid.uuid4().hex}"
    files = fixtures.feed_landing(spark, sf_dir)
    runs = [B.ingest(spark, files, f"{root}/bronze", f"{root}/quarantine", batch_id=f"run-{k}") for k in (1, 2)]
    runs = runs[0].unionByName(runs[1]).select("batch_id", "file_count", "record_count", "error_count")
    bronze = B.read_bronze(spark, f"{root}/bronze").groupBy("batch_id").agg(F.count("*").alias("bronze_rows"))
    bad = B.read_quarantine(spark, f"{root}/quarantine").groupBy("batch_id").agg(F.count("*").alias("quarantine_rows"))
    return runs.join(bronze, "batch_id", "left").join(bad, "batch_id", "left").fillna(0, ["bronze_rows", "quarantine_rows"])


@register("bronze_reprocess_date", sql(f"""
SELECT 'bronze' AS target, COUNT(*) AS rows FROM enr
  WHERE _landing_date = '{RELOAD_DATE}' AND CAST(ingestion_date AS VARCHAR) = '{RELOAD_DATE}'
UNION ALL SELECT 'out_of_range', COUNT(*) FROM enr
  WHERE _landing_date = '{RELOAD_DATE}' AND CAST(ingestion_date AS VARCHAR) <> '{RELOAD_DATE}'
UNION ALL SELECT 'errors', COUNT(*) FROM ev WHERE date = '{RELOAD_DATE}' AND kind IN ('corrupt', 'bad_entity')"""))
def q_bronze_reprocess_date(spark, sf_dir):
    """One landing date reprocessed from an unfiltered landing; rows of other event dates are quarantined."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/redo-{uuid.uuid4().hex}"
    B.ingest(spark, fixtures.feed_landing(spark, sf_dir), f"{root}/bronze", f"{root}/quarantine", batch_id="redo",
             mode="full", process_date=RELOAD_DATE)
    bad = B.read_quarantine(spark, f"{root}/quarantine")
    late = C("error_type") == "DATE_OUT_OF_RANGE"
    return (B.table_count(B.read_bronze(spark, f"{root}/bronze"), "bronze")
            .unionByName(B.table_count(bad.where(late), "out_of_range"))
            .unionByName(B.table_count(bad.where(~late), "errors")).withColumnRenamed("table_name", "target"))


@register("bronze_run_accounting", sql("""
SELECT * FROM (WITH days AS (
  SELECT date, COUNT(*) FILTER (WHERE kind = 'feed') AS records,
    COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) AS errors FROM ev GROUP BY date),
runs AS (
  SELECT 'full' AS batch_id, SUM(records) AS records, SUM(errors) AS errors, false AS silent FROM days
  UNION ALL SELECT 'again', 0, 0, false
  UNION ALL SELECT 'corrupt', 0, (SELECT COUNT(*) FROM ev WHERE kind = 'corrupt'), (SELECT COUNT(*) FROM ev WHERE kind = 'corrupt') > 0)
SELECT batch_id, status, CAST(record_count AS BIGINT) AS record_count, error_message, has_metadata FROM (
  SELECT batch_id, CASE WHEN batch_id = 'again' OR (batch_id = 'corrupt' AND errors = 0) THEN 'NO_NEW_FILES'
      WHEN records = 0 AND errors > 0 THEN 'FAILED' WHEN records = 0 THEN 'NO_DATA'
      WHEN errors = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status, records AS record_count,
    CASE WHEN errors > 0 THEN concat(CAST(errors AS VARCHAR), ' errors') END AS error_message, true AS has_metadata
  FROM runs
  UNION ALL SELECT batch_id, 'ALERT', 0, concat(CAST(errors AS VARCHAR), ' files gave no record'), true FROM runs WHERE silent
  UNION ALL SELECT 'poll', 'SUCCESS', NULL, NULL, false) r) a"""))
def q_bronze_run_accounting(spark, sf_dir):
    """Run-log rows of a full run, a run without new files, a run of corrupt files only, and a poller's row.

    The metadata table has a row for each ingest run.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"
    files = fixtures.feed_landing(spark, sf_dir)
    corrupt = files.where(F.col("content").cast("string").endswith("####"))
    log = f"{root}/log"
    B.ingest(spark, files, f"{root}/bronze", f"{root}/quarantine", batch_id="full", mode="full", accounting=log)
    B.ingest(spark, files, f"{root}/bronze", f"{root}/quarantine", batch_id="again", accounting=log)
    B.ingest(spark, corrupt, f"{root}/b2", f"{root}/q2", batch_id="corrupt", accounting=log)
    B.write_log(B.run_log_row(spark, "poll", "vehicle_positions", "feed.pb", "/landing", None, "SUCCESS", None, None), log)
    runs = B.read_log(spark, log)
    kept = B.read_metadata(spark, log).select("batch_id", F.lit(True).alias("has_metadata")).distinct()
    return (runs.join(kept, "batch_id", "left")
            .select("batch_id", "status", "record_count", "error_message", F.coalesce("has_metadata", F.lit(False)).alias("has_metadata")))


@register("dq_epoch_times", sql("""
SELECT ingestion_file AS source_file, COUNT(*) AS positions FROM recs WHERE event_timestamp_raw = 0 GROUP BY ingestion_file"""))
def q_dq_epoch_times(spark, sf_dir):
    """Landed positions without a time, which reads as the epoch."""
    return quality.epoch_times(B.records(_decoded(spark, sf_dir)))


def _register_csv_load(table: str) -> None:
    cols = B.GTFS_COLUMNS[table]

    @register(f"bronze_{table}_csv_load", oracle.query(
        f"SELECT {', '.join(f'nullif({c}, {chr(39) * 2}) AS {c}' for c in cols)}, {LINEAGE} FROM {table}"))
    def load(spark, sf_dir):
        path = f"{checkpoint_dir(spark).rstrip('/')}/gtfs-{uuid.uuid4().hex}/{table}"
        fixtures.bronze_table(spark, sf_dir, table).select(*cols).write.option("header", True).csv(path)
        return _lineage(spark, B.read_gtfs_csv(spark, path, table, loaded_at=F.lit(LOADED_AT).cast("timestamp")), path)

    load.__doc__ = f"A33: {table} written as a GTFS text file and loaded back as all-STRING columns; empty fields are NULL."


for _table in B.GTFS_COLUMNS:
    if _table != "gtfs_trips":
        _register_csv_load(_table)
