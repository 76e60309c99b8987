"""Property tests: additive roll-ups and idempotent dedup."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metroflux.operators import metrics as M
from metroflux.operators import silver, staging
from tests.test_exprs import _positions, _row

rows_st = st.lists(st.tuples(st.sampled_from(["r1", "r2", "r3"]), st.sampled_from(["Weekday", "Weekend"]),
                             st.integers(1, 50), st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None)
@given(rows_st)
def test_rollup_rate_equals_raw_rate(spark, rows):
    rows = [(r, d, t, min(o, t), min(u, t - min(o, t))) for r, d, t, o, u in rows]
    fleet = spark.createDataFrame(rows, "route_id string, day_type string, total_positions long, "
                                        "overcrowded_count long, underused_count long")
    net = M.rate_rollup(fleet).where(F.col("grouping_level") == 3).first()
    tot = sum(r[2] for r in rows)
    assert net.total_positions == tot
    assert net.overcrowded_rate == sum(r[3] for r in rows) / tot


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=20))
def test_dedup_idempotent(spark, keys):
    rows = [_row(f"b{b}", f"2026-01-05 10:0{m}:00", ing=dt.datetime(2026, 1, 5, 12, l), speed=float(l))
            for b, m, l in keys]
    stg = staging.stg_vehicle_positions(_positions(spark, rows))
    once = silver.latest_positions(stg)
    twice = silver.latest_positions(once)
    assert once.count() == len({(b, m) for b, m, _ in keys})
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
