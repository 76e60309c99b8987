"""Schedule facts on bucketed tables, so that joins and aggregates on the trip need no shuffle.

Stop times and trips are saved once in the same number of buckets of the trip, sorted by it.  Each later build joins
bucket with bucket.  Buckets follow the number of rows (``bucket_count``), as a bucket is one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.functions import exprs as X
from metroflux.operators import gold, silver
from metroflux.plans.warehouse import Warehouse

C = F.col
ROWS_PER_BUCKET = 5_000_000


def bucket_count(rows: int, least: int = 8) -> int:
    """A power of two with at most about ``ROWS_PER_BUCKET`` rows a bucket."""
    return max(least, 1 << math.ceil(math.log2(max(rows, 1) / ROWS_PER_BUCKET)) if rows > ROWS_PER_BUCKET else least)


def publish_bucketed(wh: Warehouse, database: str, buckets: int | None = None) -> int:
    """Save stop times and trips bucketed and sorted by trip_id in ``database``; returns the number of buckets."""
    wh.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    buckets = buckets or bucket_count(wh.stg_stop_times.count())
    for name in ("stg_stop_times", "fact_trips"):
        (wh.model(name).repartition(buckets, "trip_id").write.mode("overwrite").bucketBy(buckets, "trip_id").sortBy("trip_id")
         .saveAsTable(f"`{database}`.`{name}`"))
    return buckets


def fact_stop_times(spark: SparkSession, database: str, dim_stops: DataFrame) -> DataFrame:
    """The stop-time fact: trips joined bucket by bucket, stops by their size."""
    return silver.fact_stop_times(spark.table(f"`{database}`.stg_stop_times"), dim_stops, spark.table(f"`{database}`.fact_trips"))


def fct_route_analytics(spark: SparkSession, database: str, dim_stops: DataFrame) -> DataFrame:
    """Route analytics of the bucketed tables: the highest sequence of a trip is found within its bucket.

    Only distinct stops per route, and rows per route and trip, are shuffled.
    """
    stop_times = fact_stop_times(spark, database, dim_stops)
    per_trip = stop_times.groupBy("trip_id", "route_id").agg(F.max("stop_sequence").alias("max_seq"))
    lengths = per_trip.groupBy("route_id").agg(X.rounded_avg(C("max_seq"), 1).alias("avg_stops_per_trip"))
    stops = gold.stop_coverage(stop_times).join(lengths, "route_id", "left")
    return gold.route_summary(spark.table(f"`{database}`.fact_trips"), stops)
