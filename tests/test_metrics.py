"""Literal tests for reader-side measures (thresholds, rule order, additive roll-ups)."""

from pyspark.sql import functions as F

from metroflux.operators import metrics as M

FLEET_COLS = ("route_id string, event_date date, day_type string, snow_hours long, dominant_weather string, "
              "total_positions long, overcrowded_count long, underused_count long, am_peak_count long, "
              "am_peak_overcrowded_count long, pm_peak_count long, pm_peak_overcrowded_count long")


def fleet(spark, rows):
    import datetime as dt
    full = [(r, dt.date(2026, 1, 5), "Weekday", s, "Snow", t, o, u, a, ao, p, po)
            for r, s, t, o, u, a, ao, p, po in rows]
    return spark.createDataFrame(full, FLEET_COLS)


def test_recommendation_rule_order(spark):
    rows = [
        ("add", 0, 100, 30, 0, 10, 0, 10, 0),        # 30% overcrowded -> Add Buses
        ("monitor", 0, 100, 20, 0, 10, 0, 10, 0),    # 20% -> Monitor
        ("review", 0, 100, 10, 0, 20, 5, 10, 0),     # AM peak 25% with overall 10% -> Schedule Review
        ("reduce", 0, 100, 0, 90, 10, 0, 10, 0),     # underused 90% -> Reduce
        ("optimal", 0, 100, 19, 50, 10, 1, 10, 1),   # none of the above
    ]
    got = {r.route_id: r.recommendation for r in M.fleet_recommendation(fleet(spark, rows)).collect()}
    assert got == {"add": "Add Buses", "monitor": "Monitor", "review": "Schedule Review", "reduce": "Reduce",
                   "optimal": "Optimal"}


def test_corridor_rate_is_ratio_of_sums(spark):
    rows = [("a", 0, 100, 50, 0, 0, 0, 0, 0), ("b", 0, 900, 90, 0, 0, 0, 0, 0)]
    corridors = spark.createDataFrame([("a", "C"), ("b", "C")], "route_id string, corridor string")
    r = M.corridor_rollup(fleet(spark, rows), corridors).first()
    assert r.corridor == "C" and r.routes == 2
    assert r.overcrowded_rate == 140 / 1000  # not (0.5 + 0.1) / 2
    assert r.recommendation == "Optimal"


def test_snow_sensitivity_delta(spark):
    rows = [("r", 4, 100, 47, 0, 0, 0, 0, 0), ("r", 3, 1000, 394, 0, 0, 0, 0, 0)]
    r = M.snow_sensitivity(fleet(spark, rows)).first()
    assert (r.snow_positions, r.other_positions) == (100, 1000)
    assert abs(r.delta_points - 7.6) < 1e-9


def test_frequency_class_boundaries(spark):
    ra = spark.createDataFrame([("h", 300, 10), ("m", 100, 10), ("l", 99, 10), ("z", 5, 0)],
                               "route_id string, total_trips long, total_stops long")
    got = {r.route_id: (r.frequency_class, r.trips_per_stop) for r in M.service_frequency(ra).collect()}
    assert got["h"][0] == "High" and got["m"][0] == "Medium" and got["l"][0] == "Low"
    assert got["z"] == ("Low", None)  # no stops: ratio undefined


def test_fleet_mirror_top_n_and_volume_filter(spark):
    rows = [(f"r{i}", 0, 100 + i, i, 100 - i, 0, 0, 0, 0) for i in range(10)] + [("tiny", 0, 1, 1, 0, 0, 0, 0, 0)]
    m = M.fleet_mirror(fleet(spark, rows), top_n=3, min_volume_share=0.01)
    over = [r.route_id for r in m.where(F.col("side") == "overcrowded").orderBy("rank").collect()]
    under = [r.route_id for r in m.where(F.col("side") == "underused").orderBy("rank").collect()]
    assert over == ["r9", "r8", "r7"] and under == ["r0", "r1", "r2"]  # 'tiny' has < 1% of volume
