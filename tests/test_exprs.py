"""Literal unit tests for the scalar library and the parity traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metroflux.functions import exprs as X
from metroflux.operators import gold, silver, staging


def one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_weather_codes_and_gaps(spark):
    codes = [0, 1, 2, 3, 45, 48, 50, 51, 57, 58, 61, 67, 71, 77, 78, 80, 82, 85, 86, 90, 95, 99, None]
    got = one_col(spark, codes, "int", X.weather_category)
    want = ["Clear", "Clear", "Cloudy", "Cloudy", "Fog", "Fog", "Unknown", "Drizzle", "Drizzle", "Unknown",
            "Rain", "Rain", "Snow", "Snow", "Unknown", "Rain Showers", "Rain Showers", "Snow Showers",
            "Snow Showers", "Unknown", "Thunderstorm", "Thunderstorm", "Unknown"]
    assert got == want


def test_time_period_boundaries(spark):
    got = one_col(spark, [5, 6, 9, 10, 14, 15, 18, 19], "int", X.time_period)
    assert got == ["Off Peak", "AM Peak", "AM Peak", "Off Peak", "Off Peak", "PM Peak", "PM Peak", "Off Peak"]


def test_colours(spark):
    assert one_col(spark, [None, "", "ff00aa"], "string", X.hex_color) == [None, None, "#FF00AA"]


def test_mixed_validity_casts_do_not_abort(spark):
    assert one_col(spark, ["", "x", "7", None], "string", X.to_int) == [None, None, 7, None]


def test_surrogate_key_null_token(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    got = df.select(X.surrogate_key(F.col("a"), F.col("b"))).first()[0]
    import hashlib
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_fiscal_year_labels(spark):
    dates = ["2025-12-31", "2026-01-01", "2026-06-30", "2026-07-01"]
    d = spark.createDataFrame([(x,) for x in dates], "d string").select(F.col("d").cast("date").alias("d"))
    cols = silver.dim_date_columns(F.col("d"), F.lit("2026-01-15").cast("date"))
    got = [r.fis_year_label for r in d.select(*cols).orderBy("date_key").collect()]
    assert got == ["FY26", "FY26", "FY26", "FY27"]


def test_dim_date_window_and_month_end_clamp(spark):
    dd = silver.dim_date(spark, as_of="2026-01-15")
    assert dd.count() == 761
    r = dd.where(F.col("date_key") == F.lit("2026-08-31").cast("date")).first()
    assert r.fis_month_num == 2  # 2026-08-31 + 6 months clamps to 2027-02-28
    assert r.week_start_date.weekday() == 0  # Monday-based week


def _positions(spark, rows):
    schema = ("bus_id string, trip_id string, route_id string, start_time string, start_date string, "
              "latitude double, longitude double, speed double, bearing double, current_status int, "
              "occupancy_status int, event_timestamp_raw long, ingestion_file string, event_timestamp timestamp, "
              "ingestion_timestamp timestamp, ingestion_date date, source_system string, batch_id string")
    return spark.createDataFrame(rows, schema)


def _row(bus, ts, occ=1, speed=1.0, ing=None, file="f", batch="b", route="r1"):
    ts = dt.datetime.fromisoformat(ts)
    return (bus, "t", route, "00:00:00", "20260101", 45.5, -73.6, speed, 0.0, 1, occ, 0, file,
            ts, ing or ts, ts.date(), "S", batch)


def test_fold_hour_local_dedup_collapses(spark):
    # 05:30Z and 06:30Z on 2026-11-01 are both 01:30 local (DST fold).
    rows = [_row("b1", "2026-11-01 05:30:00"), _row("b1", "2026-11-01 06:30:00")]
    stg = staging.stg_vehicle_positions(_positions(spark, rows))
    local = stg.select("event_timestamp").distinct().collect()
    assert len(local) == 1 and str(local[0][0]) == "2026-11-01 01:30:00"
    assert silver.latest_positions(stg).count() == 1


def test_same_batch_dedup_tie_is_deterministic(spark):
    rows = [_row("b1", "2026-01-05 10:00:00", speed=2.0, file="a"),
            _row("b1", "2026-01-05 10:00:00", speed=1.0, file="a")]
    for order in (rows, rows[::-1]):
        stg = staging.stg_vehicle_positions(_positions(spark, order))
        assert silver.latest_positions(stg).first().speed == round(1.0 * 3.6, 1)


def test_latest_load_wins(spark):
    rows = [_row("b1", "2026-01-05 10:00:00", speed=2.0, ing=dt.datetime(2026, 1, 5, 12)),
            _row("b1", "2026-01-05 10:00:00", speed=1.0, ing=dt.datetime(2026, 1, 5, 11))]
    stg = staging.stg_vehicle_positions(_positions(spark, rows))
    assert silver.latest_positions(stg).first().speed == 7.2


def test_occupancy_buckets_skip_crushed_and_not_accepting(spark):
    rows = [_row(f"b{i}", f"2026-01-05 10:0{i}:00", occ=o) for i, o in enumerate([0, 1, 2, 3, 4, 5, 6, 7, None])]
    stg = staging.stg_vehicle_positions(_positions(spark, rows))
    r = gold.occupancy_buckets(stg).first()
    assert (r.overcrowded_count, r.underused_count, r.standing_count, r.full_count) == (2, 2, 1, 1)


def _weather(spark, rows):
    return staging.stg_weather(spark.createDataFrame(
        rows, "observation_time string, temperature string, feels_like string, humidity string, "
              "wind_speed string, wind_direction string, precipitation string, weather_code string, "
              "weather_description string, _source_file string, _ingestion_timestamp timestamp, "
              "_ingestion_date date"))


def test_having_edges(spark):
    rows = ([_row(f"b{i}", f"2026-01-05 10:{i:02d}:00", route="r10") for i in range(10)]
            + [_row(f"b{i}", f"2026-01-05 10:{i:02d}:00", route="r9") for i in range(9)])
    stg = staging.stg_vehicle_positions(_positions(spark, rows))
    w = _weather(spark, [("2026-01-05T05:00", "1", "1", "50", "1", "1", "0", "71", "d", "f", None, None)])
    fleet = gold.fct_fleet_optimization(stg, w)
    assert [r.route_id for r in fleet.collect()] == ["r10"]
    rows5 = ([_row(f"b{i}", f"2026-01-05 10:{i:02d}:00", route="h5") for i in range(5)]
             + [_row(f"b{i}", f"2026-01-05 10:{i:02d}:00", route="h4") for i in range(4)])
    hourly = gold.fct_occupancy_by_hour(staging.stg_vehicle_positions(_positions(spark, rows5)))
    assert [r.route_id for r in hourly.collect()] == ["h5"]


def test_all_null_speeds_and_peak_zero(spark):
    rows = [_row(f"b{i}", f"2026-01-05 03:{i:02d}:00", speed=None) for i in range(10)]  # 22:xx local, off peak
    stg = staging.stg_vehicle_positions(_positions(spark, rows))
    w = _weather(spark, [("2026-01-04T05:00", "1", "1", "50", "1", "1", "0", "71", "d", "f", None, None)])
    r = gold.fct_fleet_optimization(stg, w).first()
    assert r.sum_speed is None and r.count_speed_readings == 0
    assert r.sum_speed_am_peak == 0.0 and r.count_speed_am_peak == 0


def test_rounded_average_near_tie(spark):
    # 24 readings averaging -0.35 and a group averaging -0.003.
    vals = [-0.3] * 12 + [-0.4] * 12
    rows = [(f"2026-01-05T{h:02d}:00", str(v), "0", "50", "1", "1", "0", "0", "d", "f", None, None)
            for h, v in enumerate(vals)]
    rows += [("2026-01-06T00:00", "-0.003", "0", "50", "1", "1", "0", "0", "d", "f", None, None)]
    w = _weather(spark, rows)
    got = {str(r.observation_date): r.avg_temperature_c for r in gold.daily_weather(w).collect()}
    assert got == {"2026-01-05": -0.4, "2026-01-06": 0.0}


def test_dominant_weather_tie_breaks_alphabetically(spark):
    rows = [("2026-01-05T00:00", "1", "1", "50", "1", "1", "0", c, "d", "f", None, None) for c in ("71", "0")]
    w = _weather(spark, rows)
    assert gold.dominant_weather(w).first().dominant_weather == "Clear"
    assert gold.weather_day_context(w).first().dominant_weather == "Clear"


def test_snow_hours_counts_snow_only(spark):
    rows = [(f"2026-01-05T{h:02d}:00", "1", "1", "50", "1", "1", "0", c, "d", "f", None, None)
            for h, c in enumerate(["71", "73", "85", "86", "0"])]
    assert gold.snow_hours(_weather(spark, rows)).first().snow_hours == 2


def test_inbound_only_route_is_dropped(spark):
    trips = spark.createDataFrame(
        [("t1", "A", 0, "Outbound"), ("t2", "A", 1, "Inbound"), ("t3", "B", 1, "Inbound")],
        "trip_id string, route_id string, direction_id int, direction_label string")
    st = spark.createDataFrame([("t1", "s1", 1, "A"), ("t1", "s2", 3, "A"), ("t2", "s1", 2, "A"), ("t3", "s3", 1, "B")],
                               "trip_id string, stop_id string, stop_sequence int, route_id string")
    out = {r.route_id: r for r in gold.fct_route_analytics(trips, st).collect()}
    assert set(out) == {"A"}
    assert (out["A"].outbound_trips, out["A"].inbound_trips, out["A"].total_trips) == (1, 1, 2)
    assert out["A"].avg_stops_per_trip == 2.5  # mean of max sequence 3 and 2


def test_exact_speed_sum_is_order_free(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "speed double")
    assert df.agg(X.exact_sum_1dp(F.col("speed"))).first()[0] == 0.6


def test_fold_hour_utc_dedup_keeps_both(spark):
    rows = [_row("b1", "2026-11-01 05:30:00"), _row("b1", "2026-11-01 06:30:00")]
    stg = staging.stg_vehicle_positions(_positions(spark, rows), keep_utc=True)
    routes = spark.createDataFrame([("r1", "k1")], "route_id string, route_key string")
    assert silver.fact_vehicle_positions(stg, routes, dedup_on="utc").count() == 2
    stg_local = staging.stg_vehicle_positions(_positions(spark, rows))
    assert silver.fact_vehicle_positions(stg_local, routes).count() == 1


def test_sizing_scales_partitions():
    from metroflux.session import sizing
    conf = sizing(100 * 10**12, 8000)
    assert 2 * 8000 <= int(conf["spark.sql.shuffle.partitions"]) <= 20_000
    assert int(sizing(100 * 10**12, 8000, shuffle_bytes=10**14)["spark.sql.shuffle.partitions"]) > 90_000
    assert sizing(10**6, 8)["spark.sql.shuffle.partitions"] == "16"


def test_session_zone_must_be_utc(spark):
    from metroflux.session import require_utc
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "America/Montreal")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duplicate_weather_hours_fan_out_in_wide_table(spark):
    rows = [_row("b1", "2026-01-05 15:10:00")]  # 10:10 local
    stg = staging.stg_vehicle_positions(_positions(spark, rows))
    routes = spark.createDataFrame([("r1", "k", "1", "One", "Bus", "#FFF")],
                                   "route_id string, route_key string, route_short_name string, "
                                   "route_long_name string, route_type_desc string, route_color_hex string")
    obs = ("2026-01-05T10:00", "1", "1", "50", "1", "1", "0", "71", "d", "f", None, None)
    w = _weather(spark, [obs, obs])
    fact = silver.fact_vehicle_positions(stg, routes)
    assert gold.obt_positions_wide(fact, routes, w).count() == 2
