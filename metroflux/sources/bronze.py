"""Bronze ingestion: landed feed snapshots -> typed position rows + quarantine.

Each landed file is one decoded feed snapshot (a document holding a list of
entities).  Files are listed and read by Spark (``binaryFile``), decoded
with ``from_json`` and flattened with ``posexplode`` on the executors, so
parsing scales with the number of files instead of running in one driver
loop.  Undecodable files and entities are routed to a quarantine frame
instead of failing the batch.

Binary protobuf snapshots need a descriptor-based decoder (the Spark
protobuf connector); this module consumes the JSON rendering of the same
message, which is what ``decode`` expects in ``content``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflux.session import checkpoint_dir
from metroflux.sources.ledger import Ledger, replace_batch
from metroflux.sources.partitions import cluster_by_date, drop_partitions, inside, partition_names

C = F.col

# Bronze record schema (13 columns, all nullable).
BRONZE_RECORD_SCHEMA = T.StructType([
    T.StructField("bus_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("bearing", T.DoubleType()),
    T.StructField("current_status", T.IntegerType()),
    T.StructField("occupancy_status", T.IntegerType()),
    T.StructField("event_timestamp_raw", T.LongType()),
    T.StructField("ingestion_file", T.StringType()),
])
RECORD_COLUMNS = [f.name for f in BRONZE_RECORD_SCHEMA.fields]

QUARANTINE_COLUMNS = ["source_table", "source_file", "error_type", "error_message", "raw_record", "batch_id"]
RUN_LOG_COLUMNS = ["batch_id", "source_name", "file_name", "file_path", "record_count", "status",
                   "error_message", "started_at", "finished_at", "duration_s"]
METADATA_COLUMNS = ["batch_id", "job_name", "job_version", "layer", "status", "run_by", "run_at", "params_json"]

# Decoded feed message (GTFS-realtime FeedMessage rendered as JSON).
FEED_SCHEMA = ("header STRUCT<gtfs_realtime_version: STRING, incrementality: STRING, timestamp: BIGINT>, "
               "entity ARRAY<STRING>, _corrupt_record STRING")
ENTITY_SCHEMA = ("id STRING, vehicle STRUCT<"
                 "vehicle: STRUCT<id: STRING, label: STRING>, "
                 "trip: STRUCT<trip_id: STRING, route_id: STRING, start_time: STRING, start_date: STRING>, "
                 "position: STRUCT<latitude: DOUBLE, longitude: DOUBLE, speed: DOUBLE, bearing: DOUBLE>, "
                 "current_status: INT, occupancy_status: INT, timestamp: BIGINT>, _corrupt_record STRING")
JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}

# Landing partitions stay strings (hour=08, not 8).
LANDING_LINE_SCHEMA = "value STRING, date STRING, hour STRING"

SELECTION_COLUMNS = ["file_name", "full_path", "date", "hour", "length", "modificationTime"]
SELECTION_SCHEMA = "file_name string, full_path string, date string, hour string, length long, modificationTime timestamp"

MIN_PAYLOAD_BYTES = 100
MESSAGE_CHARS = 500
RAW_RECORD_CHARS = 1000


# ---------------------------------------------------------------------------
# Landing zone: discovery, watermark, incremental selection
# ---------------------------------------------------------------------------

def landed_name(path: Column) -> Column:
    """A landed file's name with its date and hour folders, which makes it unique; the bare name elsewhere."""
    return F.regexp_extract(path, r"((?:date=[^/]+/)?(?:hour=[^/]+/)?[^/]+)$", 1)


def discover_files(spark: SparkSession, base_path: str, glob: str = "*.pb", date: str | None = None,
                   with_content: bool = False) -> DataFrame:
    """List landed files under ``base/date=YYYY-MM-DD/hour=HH/`` (A1, A2).

    Partition values stay strings (``hour=08``).  A ``date`` filter prunes
    partition directories before any file is opened; without
    ``with_content`` only file metadata is read.
    """
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # binaryFile takes no schema: keep hour=08 a string
    try:
        df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "false").load(base_path))
    finally:
        spark.conf.set(key, before)
    if date is not None:
        df = df.where(C("date") == F.lit(date))
    cols = [C("path").alias("full_path"), landed_name(C("path")).alias("file_name"),
            "date", "hour", "length", "modificationTime"]
    if with_content:
        cols.append("content")
    return df.select(*cols)


def read_landing_lines(spark: SparkSession, base_path: str, date: str | None = None) -> DataFrame:
    """Landed JSON-lines snapshots (one document per line) with file metadata.

    ``file_name`` is the landed file; each line is decoded on its own, so a
    file of many snapshots is split across tasks like any text input.
    """
    df = spark.read.schema(LANDING_LINE_SCHEMA).text(base_path)
    if date is not None:
        df = df.where(C("date") == F.lit(date))
    return df.select(landed_name(C("_metadata.file_path")).alias("file_name"), "date", "hour",
                     F.octet_length("value").cast("long").alias("length"), C("value").alias("content"))


def watermark(bronze: DataFrame, since_date: str | None = None) -> DataFrame:
    """Files already loaded: distinct ``ingestion_file`` of the bronze table (A3).

    ``since_date`` limits the scan to recent ``ingestion_date`` partitions
    (partition pruning) when landed files older than that are never replayed.
    """
    if since_date is not None:
        bronze = bronze.where(C("ingestion_date") >= F.lit(since_date).cast("date"))
    return bronze.select("ingestion_file").distinct()


def select_files(files: DataFrame, bronze: DataFrame | None = None, mode: str = "incremental",
                 since_date: str | None = None) -> DataFrame:
    """Files to process: all (full) or those missing from the watermark (A4, A5).

    The watermark is joined, never collected: a left-anti join scales with
    millions of loaded file names.
    """
    if mode == "full" or bronze is None:
        return files
    if mode != "incremental":
        raise ValueError(f"mode must be 'full' or 'incremental', got {mode!r}")
    done = watermark(bronze, since_date)
    return files.join(done, files["file_name"] == done["ingestion_file"], "left_anti")


def newest_files(files: DataFrame, n: int = 5) -> DataFrame:
    """Newest ``n`` files by name with size in KB (A6); count them with ``table_count``.

    Top-k by name plans as TakeOrderedAndProject: each task keeps its own
    n best rows, so only n rows per task reach the final merge.
    """
    return (files.select("file_name", "date", "hour", F.round(C("length") / 1024, 1).alias("size_kb"))
            .orderBy(C("file_name").desc()).limit(n))


def payload_check(files: DataFrame, min_bytes: int = MIN_PAYLOAD_BYTES) -> DataFrame:
    """Flag payloads shorter than ``min_bytes`` (A7): ok / too_small."""
    return files.select("file_name", "length",
                        F.when(C("length") < min_bytes, F.lit("too_small")).otherwise(F.lit("ok"))
                        .alias("payload_status"))


# ---------------------------------------------------------------------------
# Decode + flatten
# ---------------------------------------------------------------------------

def decode(files: DataFrame) -> DataFrame:
    """One row per (file, entity) with an ``outcome``.

    outcome: ``record`` (entity with a vehicle), ``skipped`` (entity without
    vehicle), ``empty`` (file without entities), ``RECORD_PARSE_ERROR`` and
    ``FILE_READ_ERROR``.  ``files`` needs file_name, date, hour, length and
    content (binary or string).

    Parsing is two-level on purpose: the document is parsed with entities
    kept as raw JSON text, then each entity is parsed on its own, so one bad
    entity is quarantined alone instead of failing its whole snapshot.
    """
    doc = F.from_json(C("content").cast("string"), FEED_SCHEMA, JSON_OPTS)
    d = files.select("file_name", "date", "hour", "length", doc.alias("doc"))
    bad_file = C("doc._corrupt_record").isNotNull()
    exploded = d.select("file_name", "date", "hour", "length", bad_file.alias("_bad_file"),
                        F.posexplode_outer(F.when(~bad_file, C("doc.entity"))).alias("entity_pos", "entity_json"))
    e = exploded.select("*", F.from_json("entity_json", ENTITY_SCHEMA, JSON_OPTS).alias("e"))
    outcome = (F.when(C("_bad_file"), F.lit("FILE_READ_ERROR"))
               .when(C("entity_json").isNull(), F.lit("empty"))
               .when(C("e._corrupt_record").isNotNull(), F.lit("RECORD_PARSE_ERROR"))
               .when(C("e.vehicle").isNull(), F.lit("skipped"))
               .otherwise(F.lit("record")))
    return e.withColumn("outcome", outcome).drop("_bad_file")


def _present(struct: Column, field: str, default) -> Column:
    """Protobuf-like read: a field of a present message defaults, absent message gives NULL."""
    return F.when(struct.isNotNull(), F.coalesce(struct[field], F.lit(default)))


def records(decoded: DataFrame) -> DataFrame:
    """Typed bronze rows for entities carrying a vehicle."""
    v, trip, pos = C("e.vehicle"), C("e.vehicle.trip"), C("e.vehicle.position")
    return decoded.where(C("outcome") == "record").select(
        F.coalesce(F.nullif(v["vehicle"]["id"], F.lit("")), C("e.id")).alias("bus_id"),
        _present(trip, "trip_id", "").alias("trip_id"),
        _present(trip, "route_id", "").alias("route_id"),
        _present(trip, "start_time", "").alias("start_time"),
        _present(trip, "start_date", "").alias("start_date"),
        _present(pos, "latitude", 0.0).cast("double").alias("latitude"),
        _present(pos, "longitude", 0.0).cast("double").alias("longitude"),
        pos["speed"].cast("double").alias("speed"),
        pos["bearing"].cast("double").alias("bearing"),
        v["current_status"].cast("int").alias("current_status"),
        v["occupancy_status"].cast("int").alias("occupancy_status"),
        F.coalesce(v["timestamp"], F.lit(0)).cast("long").alias("event_timestamp_raw"),
        C("file_name").alias("ingestion_file"),
    )


def errors(decoded: DataFrame, batch_id: str, source_table: str = "vehicle_positions") -> DataFrame:
    """Dead-letter rows for undecodable files and entities."""
    bad = decoded.where(C("outcome").isin("RECORD_PARSE_ERROR", "FILE_READ_ERROR"))
    file_err = C("outcome") == "FILE_READ_ERROR"
    msg = (F.when(file_err, F.concat(F.lit("malformed feed document ("), C("length").cast("string"), F.lit(" bytes)")))
           .otherwise(F.concat(F.lit("malformed entity #"), C("entity_pos").cast("string"))))
    return bad.select(
        F.lit(source_table).alias("source_table"),
        C("file_name").alias("source_file"),
        C("outcome").alias("error_type"),
        F.substring(msg, 1, MESSAGE_CHARS).alias("error_message"),
        F.when(~file_err, F.substring("entity_json", 1, RAW_RECORD_CHARS)).alias("raw_record"),
        F.lit(batch_id).alias("batch_id"),
        # The contract cuts raw_record; the whole entity is kept beside it for replay.
        F.when(~file_err, C("entity_json")).alias("raw_entity"),
    )


def out_of_range(rows: DataFrame, process_date: str, batch_id: str, source_table: str = "vehicle_positions") -> DataFrame:
    """Dead-letter rows for records whose event date is not the date being replaced."""
    outside = rows.where(~inside(C("ingestion_date"), [process_date]))
    raw = F.to_json(F.struct(*RECORD_COLUMNS))
    return outside.select(
        F.lit(source_table).alias("source_table"), C("ingestion_file").alias("source_file"),
        F.lit("DATE_OUT_OF_RANGE").alias("error_type"),
        F.concat(F.lit("event date "), F.coalesce(C("ingestion_date").cast("string"), F.lit("missing")),
                 F.lit(f" is not {process_date}")).alias("error_message"),
        F.substring(raw, 1, RAW_RECORD_CHARS).alias("raw_record"), F.lit(batch_id).alias("batch_id"),
        raw.alias("raw_entity"))


def enrich(recs: DataFrame, batch_id: str, source_system: str = "GTFS_RT",
           loaded_at: Column | None = None) -> DataFrame:
    """Event time from epoch seconds, load stamp, event date, source, batch."""
    ts = F.timestamp_seconds(C("event_timestamp_raw"))
    return recs.withColumns({
        "event_timestamp": ts,
        "ingestion_timestamp": F.current_timestamp() if loaded_at is None else loaded_at,
        "ingestion_date": F.to_date(ts),
        "source_system": F.lit(source_system),
        "batch_id": F.lit(batch_id),
    })


# ---------------------------------------------------------------------------
# Sinks (A17-A20)
# ---------------------------------------------------------------------------

LOAD = "load_id"


def write_bronze(df: DataFrame, path: str, mode: str = "append", process_date: str | None = None) -> None:
    """Append, full overwrite, or replace one ``ingestion_date`` partition.

    Rows lie under ``ingestion_date=/load_id=``, the load being their batch, so an append that is run
    again replaces its own folders.  Replacing a date writes the new load and then drops the date's other
    loads; without rows the date ends up without a folder.  Every row is checked against
    ``process_date`` inside the write job itself: a row of another date raises, the job fails before commit
    and no partition is touched.  One pass over the data, no separate validation scan.
    """
    df = df.withColumn(LOAD, C("batch_id"))
    if mode == "append" or (mode == "overwrite" and process_date is not None):
        if process_date is not None:
            target = F.lit(process_date).cast("date")
            ok = C("ingestion_date").isNotNull() & (C("ingestion_date") == target)
            df = df.withColumn("ingestion_date", F.when(ok, C("ingestion_date")).otherwise(
                F.raise_error(F.concat(F.lit(f"row outside ingestion_date={process_date}: "),
                                       F.coalesce(C("ingestion_date").cast("string"), F.lit("NULL"))))))
        folder = f"{path.rstrip('/')}/ingestion_date={process_date}"
        before = partition_names(df.sparkSession, folder) if mode == "overwrite" else {}
        (df.write.partitionBy("ingestion_date", LOAD).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(path))
        if mode == "overwrite":
            # What the write left as it was belongs to other loads, or to an earlier try without rows now.
            after = partition_names(df.sparkSession, folder)
            old = [n for n, files in after.items() if before.get(n) == files]
            drop_partitions(df.sparkSession, folder, old)
            if after and len(old) == len(after):
                drop_partitions(df.sparkSession, path, [f"ingestion_date={process_date}"])
    elif mode == "overwrite":
        # A full reload spans many dates: files ~ tasks, not tasks x dates, and a heavy date takes several.
        (cluster_by_date(df, "ingestion_date").write.partitionBy("ingestion_date", LOAD).mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(path))
    else:
        raise ValueError(mode)


BRONZE_TABLE_SCHEMA = T.StructType(BRONZE_RECORD_SCHEMA.fields + [
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("ingestion_date", T.DateType()),
])


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Read the bronze table with its declared schema (partition column typed as DATE)."""
    return spark.read.schema(BRONZE_TABLE_SCHEMA).parquet(path).select(*BRONZE_TABLE_SCHEMA.names)


def quarantine_rows(errs: DataFrame, created_at: Column | None = None) -> DataFrame:
    return errs.withColumn("created_at", F.current_timestamp() if created_at is None else created_at)


def write_quarantine(errs: DataFrame, path: str, created_at: Column | None = None) -> None:
    """Write a batch's dead-letter rows with ``created_at`` (A20); a repeated batch replaces its own rows."""
    replace_batch(quarantine_rows(errs, created_at), path)


QUARANTINE_SCHEMA = ("source_table string, source_file string, error_type string, error_message string, raw_record string, "
                     "raw_entity string, created_at timestamp, batch_id string")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(path)


# ---------------------------------------------------------------------------
# Selection of landed files (A3-A5)
# ---------------------------------------------------------------------------

def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The processed files: those of finished batches."""
    return Ledger(spark, path).processed()


def unprocessed(names: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Listed files that no finished run has processed; ``names`` carries no content."""
    if manifest is None:
        return names
    return names.join(manifest.select("file_name").distinct(), "file_name", "left_anti")


def by_name(files: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """The ``files`` whose name is among ``names`` (``left_semi``) or is not (``left_anti``); contents stay where they are.

    Names alone are joined first.  A landing date of which every file is wanted is then a filter, one without any is not
    read; only files of dates that hold both kinds, or without a date, are joined with their content.  The driver
    learns a row a date.
    """
    seen = names.select("file_name").distinct()
    wanted = C("_seen").isNotNull() if how == "left_semi" else C("_seen").isNull()
    days = (files.select("file_name", "date").join(seen.withColumn("_seen", F.lit(True)), "file_name", "left")
            .groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.count_if(wanted).alias("wanted")).where(C("wanted") > 0).collect())
    whole = [r["date"] for r in days if r["date"] is not None and r["wanted"] == r["n"]]
    mixed = [r["date"] for r in days if r["date"] is not None and r["wanted"] < r["n"]]
    found = files.where(C("date").isin(whole))
    if mixed:
        found = found.unionByName(files.where(C("date").isin(mixed)).join(seen, "file_name", how).select(*files.columns))
    if any(r["date"] is None for r in days):
        found = found.unionByName(files.where(C("date").isNull()).join(seen, "file_name", how).select(*files.columns))
    return found


def open_selected(spark: SparkSession, base_path: str, selected: DataFrame, glob: str = "*.pb") -> DataFrame:
    """The ``selected`` files (of ``discover_files``) with content, opened on the executors.

    No path passes through the driver.  It learns the landing dates of the selection, a row a day, and the
    span of their modification times; both are filters of the scan (partition pruning, and a pushed filter
    that skips a file before its content is read).  What remains is semi-joined with the names, unless the
    dates hold nothing else.
    """
    dates = selected.groupBy("date").agg(F.count("*").alias("n"), F.min("modificationTime").alias("low"),
                                         F.max("modificationTime").alias("high")).collect()
    files = discover_files(spark, base_path, glob, with_content=True)
    low, high = min((r["low"] for r in dates), default=None), max((r["high"] for r in dates), default=None)
    files = files.where(C("date").isin([r["date"] for r in dates]) & C("modificationTime").between(F.lit(low), F.lit(high)))
    whole = files.select("full_path").count() == sum(r["n"] for r in dates)
    return files if whole else files.join(selected.select("full_path"), "full_path", "left_semi")


def ingest_landing(spark: SparkSession, base_path: str, bronze_path: str, quarantine_path: str, glob: str = "*.pb",
                   process_date: str | None = None, mode: str = "incremental", lines: bool = False, **options) -> DataFrame:
    """Ingest the files under ``base/date=/hour=``; in incremental mode only the new ones are opened.

    Names are listed without content and anti-joined with the finished batches; the selection is written,
    so all later steps see the same files.  ``lines``: a file holds a snapshot a line.
    """
    manifest_path = options.pop("manifest_path", None) or f"{bronze_path.rstrip('/')}_files"
    listed = discover_files(spark, base_path, glob, process_date)
    if mode == "full":
        files = discover_files(spark, base_path, glob, process_date, with_content=True)
    else:
        path = f"{checkpoint_dir(spark).rstrip('/')}/landing-selection-{uuid.uuid4().hex}"
        unprocessed(listed, read_manifest(spark, manifest_path)).select(*SELECTION_COLUMNS).write.parquet(path)
        files = open_selected(spark, base_path, spark.read.schema(SELECTION_SCHEMA).parquet(path), glob)
    if lines:
        files = (files.withColumn("content", F.explode(F.split(F.rtrim(C("content").cast("string"), F.lit("\n")), "\n")))
                 .withColumn("length", F.octet_length("content").cast("long")))
    return ingest(spark, files, bronze_path, quarantine_path, mode=mode, process_date=process_date,
                  manifest_path=manifest_path, **options)


# ---------------------------------------------------------------------------
# Run accounting
# ---------------------------------------------------------------------------

def run_summary(decoded: DataFrame, keys=("date",)) -> DataFrame:
    """Files, records, errors, status and silent-failure flag per batch key.

    Status: NO_NEW_FILES, FAILED (errors only), NO_DATA, SUCCESS, PARTIAL.
    Unlike a check-then-exit flow, errors are counted before deciding, so
    FAILED is reachable and quarantined rows are never lost.
    """
    is_err = C("outcome").isin("RECORD_PARSE_ERROR", "FILE_READ_ERROR")
    g = decoded.groupBy(*keys).agg(
        F.countDistinct("file_name").alias("file_count"),
        F.count_if(C("outcome") == "record").alias("record_count"),
        F.count_if(is_err).alias("error_count"),
    )
    return g.select("*", run_status(C("file_count"), C("record_count"), C("error_count")).alias("status"),
                    ((C("record_count") == 0) & (C("file_count") > 0)).alias("silent_failure"))


def run_status(files: Column, recs: Column, errs: Column) -> Column:
    return (F.when(files == 0, F.lit("NO_NEW_FILES"))
            .when((recs == 0) & (errs > 0), F.lit("FAILED"))
            .when(recs == 0, F.lit("NO_DATA"))
            .when(errs == 0, F.lit("SUCCESS"))
            .otherwise(F.lit("PARTIAL")))


def error_breakdown(errs: DataFrame) -> DataFrame:
    """Quarantined rows per error type."""
    return errs.groupBy("error_type").agg(F.count(F.lit(1)).alias("errors"))


def profile(bronze: DataFrame, n: int = 7) -> DataFrame:
    """Rows, distinct buses, distinct files and time range per ingestion date, newest n."""
    return (bronze.groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("bus_id").alias("unique_buses"),
        F.countDistinct("ingestion_file").alias("files"),
        F.min("event_timestamp").alias("earliest"), F.max("event_timestamp").alias("latest"))
        .orderBy(C("ingestion_date").desc()).limit(n))


def table_count(df: DataFrame, name: str) -> DataFrame:
    """Total row count of a table as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")


def quarantine_preview(quarantine: DataFrame, n: int = 5) -> DataFrame:
    """Newest n quarantine rows with a 50-character message preview.

    Ties on ``created_at`` are broken by file, type and message so the
    preview is deterministic.
    """
    return (quarantine.select("source_file", "error_type", F.left("error_message", F.lit(50)).alias("error_preview"),
                              "created_at")
            .orderBy(C("created_at").desc(), C("source_file").desc(), C("error_type").asc(),
                     C("error_preview").asc())
            .limit(n))


def batch_sample(bronze: DataFrame, batch_id: str, n: int = 10) -> DataFrame:
    """First n rows of one batch, ordered by event time then bus."""
    return (bronze.where(C("batch_id") == batch_id)
            .select("bus_id", "route_id", "latitude", "longitude", "speed", "event_timestamp", "ingestion_file")
            .orderBy("event_timestamp", "bus_id", "ingestion_file").limit(n))


def run_log_row(spark: SparkSession, batch_id: str, source_name: str, file_name: str, file_path: str,
                record_count: int | None, status: str, error_message: str | None,
                duration_s: float | None) -> DataFrame:
    """One ingestion-log row; start = finish - duration.

    Built as a DataFrame (no SQL string), so quotes in messages need no
    escaping.  A poller's row has no record count and no duration: NULL, and
    start = finish.
    """
    row = spark.createDataFrame(
        [(batch_id, source_name, file_name, file_path, None if record_count is None else int(record_count), status,
          None if error_message is None else error_message[:MESSAGE_CHARS],
          None if duration_s is None else float(duration_s))],
        "batch_id string, source_name string, file_name string, file_path string, record_count long, "
        "status string, error_message string, duration_s double")
    finished = F.current_timestamp()
    started = finished - F.make_dt_interval(secs=F.coalesce(F.floor(C("duration_s")).cast("int"), F.lit(0)))
    return row.select("batch_id", "source_name", "file_name", "file_path", "record_count", "status",
                      "error_message", started.alias("started_at"), finished.alias("finished_at"), "duration_s")


def metadata_row(spark: SparkSession, batch_id: str, job_name: str, job_version: str, status: str,
                 params: dict, layer: str = "BRONZE") -> DataFrame:
    """One pipeline-metadata row with the run user and JSON parameters.

    Parameters are rendered by ``to_json(struct(...))``, so quotes inside
    values are escaped by the JSON writer, not by string pasting.
    """
    row = spark.createDataFrame([(batch_id, job_name, job_version, layer, status)],
                                "batch_id string, job_name string, job_version string, layer string, status string")
    params_json = F.to_json(F.struct(*[F.lit(None if v is None else str(v)).cast("string").alias(k)
                                       for k, v in params.items()]))
    return row.select("batch_id", "job_name", "job_version", "layer", "status",
                      F.current_user().alias("run_by"), F.current_timestamp().alias("run_at"),
                      params_json.alias("params_json"))


LOG_SCHEMA = ("source_name string, file_name string, file_path string, record_count long, status string, error_message string, "
              "started_at timestamp, finished_at timestamp, duration_s double, batch_id string")
METADATA_SCHEMA = ("job_name string, job_version string, layer string, status string, run_by string, run_at timestamp, "
                   "params_json string, batch_id string")


def write_log(rows: DataFrame, root: str) -> None:
    """Run-log rows; those of a batch that is run again replace its first ones."""
    replace_batch(rows, f"{root.rstrip('/')}/ingestion_log")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root.rstrip('/')}/ingestion_log")


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).parquet(f"{root.rstrip('/')}/pipeline_metadata")


def account(spark: SparkSession, root: str, batch_id: str, summary, duration_s: float, params: dict,
            alerts: bool = True, source_name: str = "vehicle_positions_bronze") -> None:
    """Write a run's log and metadata rows, and an ALERT row when files gave no record.

    ``summary`` is the run-summary row.  Tables: ``ingestion_log`` and ``pipeline_metadata`` under ``root``.
    """
    rows = [run_log_row(spark, batch_id, source_name, f"batch_{batch_id}", "", summary.record_count, summary.status,
                        f"{summary.error_count} errors" if summary.error_count else None, duration_s)]
    if alerts and summary.silent_failure:
        rows.append(run_log_row(spark, batch_id, source_name, f"batch_{batch_id}", "", 0, "ALERT",
                                f"{summary.file_count} files gave no record", duration_s))
    write_log(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]), root)
    replace_batch(metadata_row(spark, batch_id, "bronze_vehicle_positions", "2.0", summary.status, params),
                  f"{root.rstrip('/')}/pipeline_metadata")


def too_small(decoded: DataFrame, min_bytes: int, batch_id: str) -> DataFrame:
    """Dead-letter rows for files shorter than ``min_bytes``."""
    return (decoded.where(C("length") < min_bytes).select("file_name", "length").distinct()
            .select(F.lit("vehicle_positions").alias("source_table"), C("file_name").alias("source_file"),
                    F.lit("PAYLOAD_TOO_SMALL").alias("error_type"),
                    F.concat(C("length").cast("string"), F.lit(" bytes")).alias("error_message"),
                    F.lit(None).cast("string").alias("raw_record"), F.lit(batch_id).alias("batch_id"),
                    F.lit(None).cast("string").alias("raw_entity")))


class IngestBatch:
    """One batch: its outputs, in the order in which they are written.

    The decoded frame is persisted (a lost block is recomputed from the files) because several outputs read it.
    Every write replaces what the same batch wrote before, so a batch that was cut off between any two
    of them can be run again from the start.
    """

    def __init__(self, spark: SparkSession, files: DataFrame, bronze_path: str, quarantine_path: str, ledger: Ledger, batch_id: str,
                 mode: str, process_date: str | None, accounting: str | None, alerts: bool, min_bytes: int | None):
        self.spark, self.ledger, self.batch_id, self.mode, self.process_date = spark, ledger, batch_id, mode, process_date
        self.files, self.bronze_path, self.quarantine_path = files, bronze_path, quarantine_path
        self.accounting, self.alerts, self.min_bytes = accounting, alerts, min_bytes
        self.began = time.monotonic()
        self.summary: DataFrame | None = None

    def writes(self, decoded: DataFrame) -> Iterator[tuple[str, Callable[[], None]]]:
        """(name, write) of every output: intent, quarantine, records, accounting, commit."""
        # A file that is neither empty nor readable is an error already; a short one is set aside whole.
        kept = decoded if self.min_bytes is None else decoded.where(C("length") >= self.min_bytes)
        rows, bad = enrich(records(kept), self.batch_id), errors(kept, self.batch_id)
        if self.min_bytes is not None:
            bad = bad.unionByName(too_small(decoded, self.min_bytes, self.batch_id))
        replacing = self.mode == "full" and self.process_date is not None
        if replacing:
            bad = bad.unionByName(out_of_range(rows, self.process_date, self.batch_id))
            rows = rows.where(inside(C("ingestion_date"), [self.process_date]))
        yield "intent", lambda: self.ledger.begin(decoded.select("file_name"), self.batch_id, self.mode, self.process_date)
        yield "quarantine", lambda: write_quarantine(bad, self.quarantine_path)
        yield "records", lambda: write_bronze(rows, self.bronze_path, "append" if self.mode == "incremental" else "overwrite",
                                              self.process_date if replacing else None)
        yield "accounting", lambda: self._account(decoded)
        yield "commit", lambda: self.ledger.commit(self.batch_id, self.mode, self.process_date)

    def _account(self, decoded: DataFrame) -> None:
        summary = run_summary(decoded.withColumn("batch_id", F.lit(self.batch_id)), ["batch_id"])
        # One row per batch, none without files.
        found = summary.collect() or [(self.batch_id, 0, 0, 0, "NO_NEW_FILES", False)]
        self.summary = self.spark.createDataFrame(found, summary.schema)
        if self.accounting:
            account(self.spark, self.accounting, self.batch_id, self.summary.first(), time.monotonic() - self.began,
                    {"mode": self.mode, "process_date": self.process_date}, self.alerts)

    def run(self, until: str | None = None) -> DataFrame | None:
        """Write all outputs and return the one-row summary; ``until`` ends after that output, as a crash would."""
        decoded = decode(self.files).persist()
        try:
            for name, write in self.writes(decoded):
                write()
                if name == until:
                    return None
            return self.summary
        finally:
            decoded.unpersist()


def ingest(spark: SparkSession, files: DataFrame, bronze_path: str, quarantine_path: str,
           batch_id: str | None = None, mode: str = "incremental", process_date: str | None = None,
           existing: DataFrame | None = None, manifest_path: str | None = None,
           accounting: str | None = None, alerts: bool = True, min_bytes: int | None = None,
           until: str | None = None) -> DataFrame | None:
    """Whole bronze batch: finish what was cut off, select files, decode once, quarantine, write, account, commit.

    Incremental mode skips the files of finished batches (``manifest_path``, by default beside
    ``bronze_path``), also empty and corrupt ones, so a repeated run writes nothing; ``existing`` skips files
    by a bronze table's watermark instead.  ``process_date`` takes only that landing date; with
    ``mode="full"`` it replaces that date's partition, and rows of another event date go to the quarantine.
    ``min_bytes`` quarantines shorter files.  ``accounting`` names the folder of the run log and the metadata
    table.  ``files`` comes with its content; for landed binary files ``ingest_landing`` selects by name first.

    A batch that an earlier run began and did not commit is run again first, under its own id with its own
    files and mode; a full run with the same target takes its place.  ``until`` ends the new batch
    after the named output, to try that out.  Returns the one-row run summary: of the new batch, or of
    the last one finished if that left no file.
    """
    ledger = Ledger(spark, manifest_path or f"{bronze_path.rstrip('/')}_files")

    def batch(todo, name, how, date) -> IngestBatch:
        return IngestBatch(spark, todo, bronze_path, quarantine_path, ledger, name, how, date, accounting, alerts, min_bytes)

    finished = None
    for p in ledger.pending():
        if mode == "full" and (p.mode, p.process_date) == (mode, process_date):
            batch_id = p.batch_id
            continue
        mine = by_name(files, ledger.files_of(p.batch_id), "left_semi")
        finished = batch(mine, p.batch_id, p.mode, p.process_date).run()
    if process_date is not None:
        files = files.where(C("date") == F.lit(process_date))
    if mode == "incremental" and existing is None:
        done = ledger.processed()
        todo = files if done.isEmpty() else by_name(files, done, "left_anti")
        if finished is not None and todo.select("file_name").isEmpty():
            return finished
    else:
        todo = select_files(files, existing, mode)
    return batch(todo, batch_id or uuid.uuid4().hex, mode, process_date).run(until)


# ---------------------------------------------------------------------------
# Static schedule and weather loaders
# ---------------------------------------------------------------------------

SOURCE_TABLES = ["vehicle_positions", "gtfs_agency", "gtfs_routes", "gtfs_stops", "gtfs_trips", "gtfs_stop_times",
                 "gtfs_calendar", "gtfs_calendar_dates", "gtfs_shapes", "weather"]


def bronze_sources(spark: SparkSession, root: str, names=SOURCE_TABLES) -> dict[str, DataFrame]:
    """The named bronze tables stored as parquet under ``root/<name>``.

    Each table is checked for the columns the staging models read, so a
    missing column fails at load time with its name, not deep in a plan.
    """
    out = {}
    for name in names:
        df = read_bronze(spark, f"{root}/{name}") if name == "vehicle_positions" else spark.read.parquet(f"{root}/{name}")
        required = RECORD_COLUMNS if name == "vehicle_positions" else GTFS_COLUMNS.get(name, ["observation_time"])
        missing = sorted(set(required) - set(df.columns))
        if missing:
            raise ValueError(f"bronze table {name} lacks columns {missing}")
        out[name] = df
    return out


GTFS_COLUMNS = {
    "gtfs_agency": ["agency_id", "agency_name", "agency_url", "agency_timezone", "agency_lang", "agency_phone"],
    "gtfs_routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type", "route_url",
                    "route_color", "route_text_color"],
    "gtfs_stops": ["stop_id", "stop_code", "stop_name", "stop_lat", "stop_lon", "stop_url", "location_type",
                   "parent_station", "wheelchair_boarding"],
    "gtfs_trips": ["trip_id", "route_id", "service_id", "shape_id", "trip_headsign", "direction_id", "note_en",
                   "note_fr"],
    "gtfs_stop_times": ["trip_id", "stop_id", "arrival_time", "departure_time", "stop_sequence", "pickup_type",
                        "drop_off_type"],
    "gtfs_calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
                      "start_date", "end_date"],
    "gtfs_calendar_dates": ["service_id", "date", "exception_type"],
    "gtfs_shapes": ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"],
}


def read_gtfs_csv(spark: SparkSession, path: str, table: str, loaded_at: Column | None = None) -> DataFrame:
    """Static GTFS text file(s) with every column as STRING plus file metadata.

    No schema inference (one pass, no type surprises); missing optional
    columns and empty fields come back as NULL.
    """
    cols = GTFS_COLUMNS[table]
    df = (spark.read.option("header", True).option("inferSchema", False).option("emptyValue", "")
          .option("mode", "PERMISSIVE").csv(path))
    present = set(df.columns)
    out = [C(c).cast("string").alias(c) if c in present else F.lit(None).cast("string").alias(c) for c in cols]
    return df.select(*out, C("_metadata.file_name").alias("_source_file"),
                     (F.current_timestamp() if loaded_at is None else loaded_at).alias("_ingestion_timestamp"))


WEATHER_FIELDS = [("temperature", "temperature_2m"), ("feels_like", "apparent_temperature"),
                  ("humidity", "relative_humidity_2m"), ("wind_speed", "wind_speed_10m"),
                  ("wind_direction", "wind_direction_10m"), ("precipitation", "precipitation"),
                  ("weather_code", "weather_code")]


def read_weather_json(spark: SparkSession, path: str, loaded_at: Column | None = None,
                      multi_line: bool = False) -> DataFrame:
    """Hourly weather documents (parallel arrays per variable) -> one STRING row per hour.

    ``arrays_zip`` + ``inline`` flatten the arrays of each document on the
    executors; a description is derived from the code.  ``multi_line`` reads
    one pretty-printed document per file instead of JSON lines.
    """
    schema = T.StructType([T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))] +
        [T.StructField(src, T.ArrayType(T.StringType())) for _, src in WEATHER_FIELDS]))])
    docs = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    h = C("hourly")
    zipped = F.arrays_zip(h["time"].alias("observation_time"),
                          *[h[src].alias(name) for name, src in WEATHER_FIELDS])
    rows = docs.select(F.inline(zipped), C("_metadata.file_name").alias("_source_file"))
    ts = F.current_timestamp() if loaded_at is None else loaded_at
    return rows.select("observation_time", *[name for name, _ in WEATHER_FIELDS],
                       F.concat(F.lit("code "), C("weather_code")).alias("weather_description"),
                       "_source_file", ts.alias("_ingestion_timestamp"), F.to_date(ts).alias("_ingestion_date"))
