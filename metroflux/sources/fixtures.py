"""Stand-in bronze inputs derived from the driver's test tables.

The driver ships TPC-H-like tables plus an ``events`` stream; the warehouse
expects bronze vehicle positions, static-schedule tables (all STRING) and
hourly weather (all STRING).  Each adapter below only reshapes driver rows
into the bronze schema; none of the warehouse's work happens here.

The adapters are SQL text that Spark SQL and DuckDB both accept, so the
DuckDB oracle starts from byte-identical inputs.  Table placeholders are
written ``{name}``: Spark binds them to DataFrames via ``spark.sql(text,
name=df)``; the oracle substitutes the view name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD_TS = "TIMESTAMP '2026-02-01 07:00:00'"
ROWS_PER_TASK = 100_000


def _epoch_seconds(expr: str, dialect: str) -> str:
    if dialect == "spark":
        return f"unix_timestamp({expr})"
    return f"datediff('second', TIMESTAMP '1970-01-01 00:00:00', {expr})"


def _positions(dialect: str) -> str:
    # Some events fall outside the date window: some 200 days before it, some 800 after.
    shift = ("CASE WHEN e.event_id % 463 = 7 THEN interval '1531' day WHEN e.event_id % 467 = 7 THEN interval '531' day "
             "ELSE interval '731' day END")
    event_ts = f"cast(e.ts + {shift} as timestamp)"
    return f"""
SELECT
  CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE cast(e.user_id as string) END AS bus_id,
  cast(e.event_id % 500 as string) AS trip_id,
  CASE WHEN e.user_id % 30 < 12 THEN '1'
       WHEN e.user_id % 30 < 18 THEN '2'
       ELSE cast(e.user_id % 30 as string) END AS route_id,
  concat(lpad(cast(hour(e.ts) as string), 2, '0'), ':00:00') AS start_time,
  replace(substr(cast(e.ts as string), 1, 10), '-', '') AS start_date,
  CASE WHEN e.event_id % 211 = 0 THEN NULL ELSE 45.4e0 + (e.event_id % 1000) / 5000e0 END AS latitude,
  -73.9e0 + (e.event_id % 700) / 2000e0 AS longitude,
  CASE WHEN e.event_id % 17 = 0 THEN NULL WHEN e.event_id % 331 = 5 THEN cast('NaN' as double)
       WHEN e.event_id % 331 = 6 THEN cast('Infinity' as double) ELSE e.value / 10 + e.dup END AS speed,
  cast(e.event_id % 360 as double) AS bearing,
  CASE WHEN e.event_id % 5 = 4 THEN NULL ELSE cast(e.event_id % 5 as int) END AS current_status,
  CASE WHEN e.event_id % 9 = 8 THEN NULL ELSE cast(e.event_id % 9 as int) END AS occupancy_status,
  {_epoch_seconds(event_ts, dialect)} AS event_timestamp_raw,
  concat('feed_', substr(cast(e.ts as string), 1, 13), '.pb') AS ingestion_file,
  {event_ts} AS event_timestamp,
  cast(e.ts + interval '731' day
       + CASE WHEN e.dup = 1 THEN interval '1' hour ELSE interval '0' hour END as timestamp) AS ingestion_timestamp,
  cast(e.ts + {shift} as date) AS ingestion_date,
  'SYNTH' AS source_system,
  concat('b', cast(e.dup as string)) AS batch_id
FROM (
  SELECT event_id, ts, user_id, value, 0 AS dup FROM {{events}}
  UNION ALL
  SELECT event_id, ts, user_id, value, 1 AS dup FROM {{events}} WHERE event_id % 10 = 0
) e
"""


def _weather(dialect: str) -> str:
    return f"""
SELECT
  replace(substr(cast(w.h as string), 1, 16), ' ', 'T') AS observation_time,
  cast(-15 + (w.i * 13 % 300) / 10e0 as string) AS temperature,
  cast(-20 + (w.i * 7 % 250) / 10e0 as string) AS feels_like,
  CASE WHEN w.i % 97 = 0 THEN 'n/a' ELSE cast(40 + w.i % 60 as string) END AS humidity,
  cast((w.i * 11 % 400) / 10e0 as string) AS wind_speed,
  cast(w.i * 37 % 360 as string) AS wind_direction,
  cast((w.i * 3 % 25) / 10e0 as string) AS precipitation,
  CASE w.k WHEN 0 THEN '0' WHEN 1 THEN '2' WHEN 2 THEN '45' WHEN 3 THEN '55'
           WHEN 4 THEN '61' WHEN 5 THEN '71' WHEN 6 THEN '75' WHEN 7 THEN '80'
           WHEN 8 THEN '85' WHEN 9 THEN '95' WHEN 10 THEN '58' ELSE '3' END AS weather_code,
  concat('code ', CASE w.k WHEN 0 THEN '0' WHEN 1 THEN '2' WHEN 2 THEN '45' WHEN 3 THEN '55'
           WHEN 4 THEN '61' WHEN 5 THEN '71' WHEN 6 THEN '75' WHEN 7 THEN '80'
           WHEN 8 THEN '85' WHEN 9 THEN '95' WHEN 10 THEN '58' ELSE '3' END) AS weather_description,
  'weather.json' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp,
  DATE '2026-02-01' AS _ingestion_date
FROM (
  SELECT h, day(h) * 24 + hour(h) AS i, (day(h) * 5 + hour(h) * hour(h)) % 12 AS k
  FROM (SELECT DISTINCT date_trunc('hour', ts + interval '731' day) AS h FROM {{events}}) d
) w
"""


def _routes(dialect: str) -> str:
    return f"""
SELECT
  cast(n_nationkey as string) AS route_id,
  cast(n_regionkey as string) AS agency_id,
  cast(n_nationkey as string) AS route_short_name,
  n_name AS route_long_name,
  CASE WHEN n_nationkey % 5 = 0 THEN '1' ELSE '3' END AS route_type,
  concat('route-', cast(n_nationkey as string)) AS route_url,
  CASE WHEN n_nationkey % 4 = 0 THEN ''
       WHEN n_nationkey % 4 = 1 THEN CAST(NULL AS string)
       ELSE concat('a1b2c', cast(n_nationkey % 10 as string)) END AS route_color,
  CASE WHEN n_nationkey % 2 = 0 THEN 'ffffff' ELSE '00000a' END AS route_text_color,
  'routes.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM {{nation}}
"""


def _stops(dialect: str) -> str:
    return f"""
SELECT
  cast(s_suppkey as string) AS stop_id,
  cast(50000 + s_suppkey as string) AS stop_code,
  s_name AS stop_name,
  cast(45.4e0 + s_suppkey / 1000e0 as string) AS stop_lat,
  cast(-73.9e0 + (s_suppkey % 97) / 1000e0 as string) AS stop_lon,
  concat('stop-', cast(s_suppkey as string)) AS stop_url,
  '0' AS location_type,
  CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE cast(s_suppkey % 10 as string) END AS parent_station,
  CASE WHEN s_suppkey % 11 = 0 THEN 'unknown' WHEN s_suppkey % 7 = 0 THEN ''
       ELSE cast(s_suppkey % 3 as string) END AS wheelchair_boarding,
  'stops.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM {{supplier}}
"""


def _trips(dialect: str) -> str:
    return f"""
SELECT
  cast(o.o_orderkey as string) AS trip_id,
  CASE WHEN o.o_orderkey % 41 = 0 THEN CAST(NULL AS string) ELSE cast(c.c_nationkey as string) END AS route_id,
  concat(substr(o.o_orderpriority, 1, 1), '-', o.o_orderstatus) AS service_id,
  cast(o.o_orderkey % 50 as string) AS shape_id,
  concat('Direction ', o.o_orderstatus) AS trip_headsign,
  CASE WHEN c.c_nationkey = 24 THEN '1' ELSE cast(o.o_orderkey % 2 as string) END AS direction_id,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 'Detour' ELSE CAST(NULL AS string) END AS note_en,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 'Deviation' ELSE CAST(NULL AS string) END AS note_fr,
  'trips.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
"""


def _stop_times(dialect: str) -> str:
    return f"""
SELECT
  cast(l_orderkey as string) AS trip_id,
  cast(l_suppkey as string) AS stop_id,
  concat(lpad(cast(l_linenumber + 20 as string), 2, '0'), ':00:00') AS arrival_time,
  concat(lpad(cast(l_linenumber + 20 as string), 2, '0'), ':01:30') AS departure_time,
  cast(l_linenumber as string) AS stop_sequence,
  cast(l_linenumber % 2 as string) AS pickup_type,
  '0' AS drop_off_type,
  'stop_times.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM {{lineitem}}
"""


def _calendar(dialect: str) -> str:
    wk = "CASE WHEN substr(d.p, 1, 1) IN ('1', '3', '5') THEN '1' ELSE '0' END"
    return f"""
SELECT
  concat(substr(d.p, 1, 1), '-', d.s) AS service_id,
  CASE WHEN substr(d.p, 1, 1) IN ('1', '3', '4', '5') THEN '1' ELSE '0' END AS monday,
  {wk} AS tuesday,
  {wk} AS wednesday,
  {wk} AS thursday,
  {wk} AS friday,
  CASE WHEN substr(d.p, 1, 1) IN ('2', '3', '5') THEN '1' ELSE '0' END AS saturday,
  CASE WHEN substr(d.p, 1, 1) IN ('2', '3') THEN '1' ELSE '0' END AS sunday,
  '20260101' AS start_date,
  '20261231' AS end_date,
  'calendar.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM (SELECT DISTINCT o_orderpriority AS p, o_orderstatus AS s FROM {{orders}}) d
"""


def _calendar_dates(dialect: str) -> str:
    return f"""
SELECT
  concat(substr(o_orderpriority, 1, 1), '-', o_orderstatus) AS service_id,
  replace(substr(cast(o_orderdate as string), 1, 10), '-', '') AS date,
  cast(1 + o_orderkey % 2 as string) AS exception_type,
  'calendar_dates.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM {{orders}}
"""


def _shapes(dialect: str) -> str:
    return f"""
SELECT
  cast(p_size as string) AS shape_id,
  cast(45.4e0 + p_retailprice / 10000e0 as string) AS shape_pt_lat,
  cast(-73.6e0 - p_retailprice / 20000e0 as string) AS shape_pt_lon,
  cast(p_partkey as string) AS shape_pt_sequence,
  'shapes.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM {{part}}
"""


def _agency(dialect: str) -> str:
    return f"""
SELECT
  cast(r_regionkey as string) AS agency_id,
  r_name AS agency_name,
  concat('agency-', cast(r_regionkey as string)) AS agency_url,
  'America/Montreal' AS agency_timezone,
  'fr' AS agency_lang,
  concat('514-555-000', cast(r_regionkey as string)) AS agency_phone,
  'agency.txt' AS _source_file,
  {LOAD_TS} AS _ingestion_timestamp
FROM {{region}}
"""


# bronze table -> (SQL builder, driver tables it reads)
ADAPTERS = {
    "vehicle_positions": (_positions, ["events"]),
    "weather": (_weather, ["events"]),
    "gtfs_routes": (_routes, ["nation"]),
    "gtfs_stops": (_stops, ["supplier"]),
    "gtfs_trips": (_trips, ["orders", "customer"]),
    "gtfs_stop_times": (_stop_times, ["lineitem"]),
    "gtfs_calendar": (_calendar, ["orders"]),
    "gtfs_calendar_dates": (_calendar_dates, ["orders"]),
    "gtfs_shapes": (_shapes, ["part"]),
    "gtfs_agency": (_agency, ["region"]),
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The adapters turn wall-clock driver timestamps into UTC instants.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One bronze table rebuilt from the driver tables (lazy)."""
    build, inputs = ADAPTERS[name]
    frames = {t: driver_table(spark, sf_dir, t) for t in inputs}
    return spark.sql(build("spark"), **frames)


class Bronze(Mapping):
    """Lazy mapping of the bronze tables of one driver directory."""

    def __iter__(self):
        return iter(ADAPTERS)

    def __len__(self) -> int:
        return len(ADAPTERS)

    def __init__(self, spark: SparkSession, sf_dir: str):
        # The adapters turn wall-clock driver timestamps into UTC instants.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = bronze_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def duckdb_ctes() -> list[str]:
    """The same adapters as DuckDB CTE definitions over the driver views."""
    out = []
    for name, (build, inputs) in ADAPTERS.items():
        text = build("duckdb").format(**{t: t for t in inputs})
        out.append(f"{name} AS ({text})")
    return out


# ---------------------------------------------------------------------------
# Landed feed snapshots (decoded feed messages as JSON), one file per event.
#
# Kinds of file, chosen by fixed rules on the event row:
#   event_type = 'error' and event_id % 4 = 0 -> corrupt document (>= 100 bytes)
#   value < 1                               -> tiny valid feed without entities
#   otherwise                               -> feed with one vehicle entity, plus a
#                                              non-vehicle alert entity when
#                                              event_type = 'click'
# Inside a vehicle entity: vehicle id '' when event_id % 101 = 0 (falls back to
# the entity id), no trip when % 23 = 0, trip without trip_id when % 29 = 0, no
# position when % 211 = 0, no speed when % 17 = 0, no status when % 5 = 4, no
# occupancy when % 9 = 8, no timestamp when % 997 = 0, and an undecodable
# latitude when event_type = 'purchase' and event_id % 7 = 0 (only entities that
# carry a position have a latitude to corrupt).
# ---------------------------------------------------------------------------

FEED_KIND_SQL = """CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'corrupt'
     WHEN value < 1 THEN 'tiny' ELSE 'feed' END"""


def _feed_sql() -> str:
    route = """CASE WHEN user_id % 30 < 12 THEN '1' WHEN user_id % 30 < 18 THEN '2'
                  ELSE cast(user_id % 30 as string) END"""
    return f"""
SELECT
  concat('landing/date=', d, '/hour=', h, '/', file_name) AS path,
  cast(et as timestamp) AS modificationTime,
  cast(length(content) as bigint) AS length,
  cast(content as binary) AS content,
  d AS date, h AS hour, file_name
FROM (
  SELECT *,
    CASE kind
      WHEN 'corrupt' THEN concat('{{"header":{{"gtfs_realtime_version":"2.0"}},"entity":[', repeat('#', 120))
      WHEN 'tiny' THEN '{{"entity":[]}}'
      ELSE concat('{{"header":{{"gtfs_realtime_version":"2.0","timestamp":', cast(unix_timestamp(et) as string),
                  '}},"entity":[', concat_ws(',', vehicle_json, alert_json), ']}}')
    END AS content
  FROM (
    SELECT *,
      CASE WHEN event_type = 'purchase' AND event_id % 7 = 0
           THEN regexp_replace(vj, '"latitude":[-0-9.E]+', '"latitude":"n/a"') ELSE vj END AS vehicle_json,
      CASE WHEN event_type = 'click'
           THEN to_json(named_struct('id', concat('a', cast(event_id as string)),
                                     'alert', named_struct('header_text', 'detour')))
           END AS alert_json
    FROM (
      SELECT *,
        to_json(named_struct(
          'id', concat('e', cast(event_id as string)),
          'vehicle', named_struct(
            'vehicle', named_struct('id', CASE WHEN event_id % 101 = 0 THEN '' ELSE cast(user_id as string) END),
            'trip', CASE WHEN event_id % 23 = 0 THEN NULL ELSE named_struct(
                'trip_id', CASE WHEN event_id % 29 = 0 THEN NULL ELSE cast(event_id % 500 as string) END,
                'route_id', {route},
                'start_time', concat(lpad(cast(hour(ts) as string), 2, '0'), ':00:00'),
                'start_date', replace(substr(cast(ts as string), 1, 10), '-', '')) END,
            'position', CASE WHEN event_id % 211 = 0 THEN NULL ELSE named_struct(
                'latitude', 45.4e0 + (event_id % 1000) / 5000e0,
                'longitude', -73.9e0 + (event_id % 700) / 2000e0,
                'speed', CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 10 END,
                'bearing', cast(event_id % 360 as double)) END,
            'current_status', CASE WHEN event_id % 5 = 4 THEN NULL ELSE cast(event_id % 5 as int) END,
            'occupancy_status', CASE WHEN event_id % 9 = 8 THEN NULL ELSE cast(event_id % 9 as int) END,
            'timestamp', CASE WHEN event_id % 997 = 0 THEN NULL ELSE unix_timestamp(et) END))) AS vj
      FROM (
        SELECT *, cast(ts + interval '731' day as timestamp) AS et,
          cast(cast(ts + interval '731' day as date) as string) AS d,
          lpad(cast(hour(ts) as string), 2, '0') AS h,
          concat('feed_', lpad(cast(event_id as string), 9, '0'), '.pb') AS file_name,
          {FEED_KIND_SQL} AS kind
        FROM {{events}}) e0) e1) e2) e3
"""


def feed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed feed files as ``binaryFile`` would list them (path, length, content, date, hour)."""
    # JSON literals contain braces: escape them for the DataFrame-binding formatter.
    text = _feed_sql().replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}")
    return spark.sql(text, events=spread(driver_table(spark, sf_dir, "events"), "ts", "event_id"))


def spread(rows: DataFrame, *order: str) -> DataFrame:
    """Rows in ranges of the named columns, about ``ROWS_PER_TASK`` a task however many there are.

    A listing of many landed files is split across tasks, folder by folder; the stand-in files are built
    in such tasks, too, so neither what a task reads nor the folders it writes grow with the input.
    """
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))
    return rows.repartitionByRange(n, *order)


def landed_files(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """``feed_landing`` written once below ``path``, a folder a date: what several runs over one landing read.

    Uncompressed, as landed files are: scan tasks are cut by bytes on disk, and these hold as many bytes of content.
    """
    files = feed_landing(spark, sf_dir)
    files.write.partitionBy("date").option("compression", "uncompressed").parquet(path)
    return spark.read.schema(files.schema).parquet(path).select(*files.columns)


def write_landing(files: DataFrame, base_path: str, mode: str = "overwrite") -> None:
    """Materialise landed snapshots under ``base/date=/hour=/`` as JSON-lines files.

    Many snapshots share one file (one document per line), the layout a
    line-oriented landing writer produces; ``bronze.read_landing_lines``
    reads it back.
    """
    # Cluster by folder first: one file per (date, hour) instead of one per task and folder.
    (files.select(F.col("content").cast("string").alias("value"), "date", "hour")
     .repartition("date", "hour")
     .write.mode(mode).partitionBy("date", "hour").text(base_path))


def write_weather_documents(weather: DataFrame, path: str) -> None:
    """Group hourly weather rows into one document per day (parallel arrays per variable).

    A day holds at most a fixed number of hourly observations, so each
    group is small; the documents are written as JSON lines.
    """
    fields = [("temperature", "temperature_2m"), ("feels_like", "apparent_temperature"),
              ("humidity", "relative_humidity_2m"), ("wind_speed", "wind_speed_10m"),
              ("wind_direction", "wind_direction_10m"), ("precipitation", "precipitation"),
              ("weather_code", "weather_code")]
    obs = F.struct("observation_time", *[F.col(a).alias(b) for a, b in fields])
    per_day = (weather.groupBy(F.substring("observation_time", 1, 10).alias("day"))
               .agg(F.sort_array(F.collect_list(obs)).alias("h")))
    hourly = F.struct(F.col("h.observation_time").alias("time"), *[F.col(f"h.{b}").alias(b) for _, b in fields])
    per_day.select(hourly.alias("hourly")).write.mode("overwrite").json(path)
