"""Casts with two outputs: the rows, and what could not be cast.

Each raw row carries an array of its rejects beside the staged columns, so rows and rejects come from one pass over
the source; ``load_cast`` writes that pass once and splits it.  In strict mode any reject fails the load before the
rows are published; otherwise the value is NULL in the row and the reject lies in the quarantine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.operators import staging

C = F.col
REJECTS = "_rejects"
REJECT_COLUMNS = ["source_table", "record_key", "column_name", "raw_value"]


class CastRejected(RuntimeError):
    """A strict load met values that cannot be cast."""


def with_rejects(raw: DataFrame, table: str) -> DataFrame:
    """``raw`` with an array of (column_name, raw_value) of the values that its staging casts turn into NULL."""
    key, casts = staging.staging_casts()[table]
    checks = [F.when(C(c).isNotNull() & (F.trim(C(c)) != "") & cast(C(c)).isNull(),
                     F.struct(F.lit(c).alias("column_name"), C(c).cast("string").alias("raw_value"))) for c, cast in casts.items()]
    return raw.withColumn(REJECTS, F.struct(C(key).cast("string").alias("record_key"), F.array_compact(F.array(*checks)).alias("found")))


def rejects_of(carried: DataFrame, table: str) -> DataFrame:
    return (carried.where(F.size(f"{REJECTS}.found") > 0)
            .select(F.lit(table).alias("source_table"), C(f"{REJECTS}.record_key").alias("record_key"), F.inline(f"{REJECTS}.found")))


STAGE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "weather": staging.stg_weather, "gtfs_routes": staging.stg_routes, "gtfs_stops": staging.stg_stops,
    "gtfs_trips": staging.stg_trips, "gtfs_stop_times": staging.stg_stop_times, "gtfs_calendar": staging.stg_calendar,
    "gtfs_calendar_dates": staging.stg_calendar_dates, "gtfs_shapes": staging.stg_shapes,
}


def load_cast(spark: SparkSession, raw: DataFrame, table: str, rows_path: str, quarantine_path: str, strict: bool = False) -> DataFrame:
    """Write the staged rows and the rejects of a table from one pass over ``raw``; returns the rows.

    The pass is written beside the rows and read for both outputs.  Rejects are written first, in a folder of the table
    that a repeated load replaces; then ``strict`` raises if there are any, and no row is published.
    """
    held = f"{rows_path.rstrip('/')}_raw"
    with_rejects(raw, table).write.mode("overwrite").parquet(held)
    carried = spark.read.parquet(held)
    quarantine = f"{quarantine_path.rstrip('/')}/source_table={table}"
    rejects_of(carried, table).drop("source_table").write.mode("overwrite").parquet(quarantine)
    if strict:
        some = spark.read.parquet(quarantine).groupBy("column_name").agg(F.count("*").alias("n")).orderBy("column_name").collect()
        if some:  # one row a column
            raise CastRejected(f"{table}: " + ", ".join(f"{r['column_name']} {r['n']}" for r in some))
    rows = STAGE[table](carried.drop(REJECTS))
    rows.write.mode("overwrite").parquet(rows_path)
    return spark.read.schema(rows.schema).parquet(rows_path)


def read_rejects(spark: SparkSession, quarantine_path: str) -> DataFrame:
    return (spark.read.schema("record_key string, column_name string, raw_value string, source_table string")
            .parquet(quarantine_path).select(*REJECT_COLUMNS))
