"""A key holding a third of all rows: AQE splits it and results stay exact."""

from pyspark.sql import functions as F

from metroflux.operators import gold, silver


def _fixture(spark, n=30000):
    # Trip "hot" carries a third of all stop times; the rest spread over 2,000 trips.
    st = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 2000).cast("string")).alias("trip_id"),
        (F.col("id") % 97).cast("string").alias("stop_id"),
        F.lit("08:00:00").alias("arrival_time"), F.lit("08:01:00").alias("departure_time"),
        (F.col("id") % 40).cast("int").alias("stop_sequence"), F.lit(0).alias("pickup_type"),
        F.lit(0).alias("drop_off_type"))
    trips = spark.range(2000).select(F.col("id").cast("string").alias("trip_id"),
                                     (F.col("id") % 7).cast("string").alias("route_id"),
                                     F.lit(0).alias("direction_id"))
    trips = trips.unionByName(spark.createDataFrame([("hot", "H", 1)], "trip_id string, route_id string, direction_id int"))
    trips = trips.select("trip_id", "route_id", F.lit("s").alias("service_id"), F.lit("sh").alias("shape_id"),
                         F.lit("x").alias("trip_headsign"), "direction_id", F.lit(None).cast("string").alias("note_en"),
                         F.lit(None).cast("string").alias("note_fr"))
    routes = spark.createDataFrame([(str(i), str(i), "n", "Bus") for i in range(7)] + [("H", "H", "n", "Bus")],
                                   "route_id string, route_short_name string, route_long_name string, "
                                   "route_type_desc string")
    stops = spark.createDataFrame([(str(i), f"s{i}", 45.0, -73.0) for i in range(97)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double")
    return st, silver.fact_trips(trips, routes), stops


def _run(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        st, ft, stops = _fixture(spark)
        fst = silver.fact_stop_times(st, stops, ft)
        rows = sorted(map(tuple, gold.route_stop_measures(fst).collect()), key=str)
        fst.collect()  # runs this DataFrame's own adaptive plan to its final form
        plan = fst._jdf.queryExecution().executedPlan().toString()
        return rows, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_trip_is_split_and_results_are_exact(spark):
    skewed, plan = _run(spark, {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    assert "SortMergeJoin" in plan and "skew=true" in plan
    broadcast, _ = _run(spark, {"spark.sql.adaptive.skewJoin.enabled": "false"})
    assert skewed == broadcast
    hot = [r for r in skewed if r[0] == "H"][0]
    assert hot[1] == 97  # the hot route still sees every stop
