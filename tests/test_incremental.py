"""Cut-off ingest, stateful streams, levels of runs, sketches, refresh by key, co-located joins, two-output casts."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from metroflux.operators import casts, quality, sketches, staging
from metroflux.plans import colocated, keyed
from metroflux.plans.warehouse import Warehouse, materialize
from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures
from metroflux.sources.ledger import Ledger
from metroflux.streaming import feeds, late, levels
from tests.conftest import SMOKE


def _tmp(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- ingest

def _files(spark, *dates):
    files = fixtures.feed_landing(spark, SMOKE)
    return files.where(F.col("date").isin(*dates)) if dates else files


@pytest.mark.parametrize("cut", ["intent", "quarantine", "records", "accounting"])
def test_cut_off_batch_is_finished_by_the_next_run(spark, cut):
    root = _tmp(spark, "cut")
    paths = dict(bronze_path=f"{root}/b", quarantine_path=f"{root}/q", accounting=f"{root}/log")
    files = _files(spark)
    assert B.ingest(spark, files, batch_id="one", until=cut, **paths) is None
    assert [p.batch_id for p in Ledger(spark, f"{root}/b_files").pending()] == ["one"]
    summary = B.ingest(spark, files, batch_id="two", **paths).first()  # nothing is left for a batch of its own
    clean = _tmp(spark, "clean")
    want = B.ingest(spark, files, f"{clean}/b", f"{clean}/q", batch_id="one").first()
    assert summary == want and Ledger(spark, f"{root}/b_files").pending() == []
    cols = B.RECORD_COLUMNS + ["batch_id"]
    got, full = (B.read_bronze(spark, f"{r}/b").select(*cols) for r in (root, clean))
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()
    assert B.read_quarantine(spark, f"{root}/q").count() == B.read_quarantine(spark, f"{clean}/q").count() == want.error_count
    log = B.read_log(spark, f"{root}/log").collect()
    assert [(r.batch_id, r.status) for r in log] == [("one", want.status)] and B.read_metadata(spark, f"{root}/log").count() == 1


def test_full_run_resets_what_counts_as_processed(spark):
    root = _tmp(spark, "full")
    days = sorted(r.date for r in _files(spark).select("date").distinct().collect())
    B.ingest(spark, _files(spark), f"{root}/b", f"{root}/q", batch_id="all")
    B.ingest(spark, _files(spark, *days[:3]), f"{root}/b", f"{root}/q", batch_id="full", mode="full")
    left = B.ingest(spark, _files(spark), f"{root}/b", f"{root}/q", batch_id="rest").first()
    assert left.file_count == _files(spark, *days[3:]).count()
    assert B.read_bronze(spark, f"{root}/b").count() == B.records(B.decode(_files(spark))).count()


def test_replacing_a_date_drops_its_other_loads_and_an_emptied_date(spark):
    rows = B.enrich(B.records(B.decode(_files(spark))), "first")
    path = _tmp(spark, "bronze")
    day = rows.groupBy("ingestion_date").count().orderBy(F.desc("count")).first().ingestion_date
    B.write_bronze(rows, path)
    B.write_bronze(rows.withColumn("batch_id", F.lit("second")), path)  # another load of the same rows
    target = rows.where(F.col("ingestion_date") == F.lit(day))
    for _ in range(2):  # again, as after a crash
        B.write_bronze(target.withColumn("batch_id", F.lit("third")), path, "overwrite", str(day))
    table = B.read_bronze(spark, path)
    assert {r.batch_id for r in table.where(F.col("ingestion_date") == F.lit(day)).select("batch_id").distinct().collect()} == {"third"}
    assert table.count() == 2 * rows.count() - target.count()
    B.write_bronze(target.limit(0), path, "overwrite", str(day))
    assert B.read_bronze(spark, path).where(F.col("ingestion_date") == F.lit(day)).isEmpty()


def test_selected_files_are_opened_by_partition_and_time_without_a_path_list(spark):
    base = _tmp(spark, "landing")
    days = sorted(r.date for r in _files(spark).select("date").distinct().collect())
    fixtures.write_landing(_files(spark, *days[:4]), base)
    listed = B.discover_files(spark, base, "*.txt")
    chosen = listed.where(F.col("date") == days[1])
    some = chosen.where(F.col("hour") == chosen.agg(F.min("hour")).first()[0])
    got = B.open_selected(spark, base, some, "*.txt")
    assert {r.full_path for r in got.select("full_path").collect()} == {r.full_path for r in some.collect()}
    text = plan(got)
    assert "PartitionFilters: [isnotnull(date" in text or "PartitionFilters: [date" in text
    assert "modificationTime" in text.split("PushedFilters")[1]


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_files_are_picked_by_name_without_moving_whole_dates(spark, how):
    rows = [("d1", "a"), ("d1", "b"), ("d2", "c"), ("d2", "d"), ("d2", "d"), (None, "e"), (None, "f"), ("d3", None), ("d4", "g")]
    path = _tmp(spark, "named")
    spark.createDataFrame([(d, n, f"{n} content") for d, n in rows], "date string, file_name string, content string").write.parquet(path)
    files = spark.read.parquet(path)
    names = spark.createDataFrame([("a",), ("b",), ("d",), ("d",), ("e",), (None,)], "file_name string")
    want = sorted(map(str, files.join(names, "file_name", how).select(*files.columns).collect()))
    assert sorted(map(str, B.by_name(files, names, how).collect())) == want
    whole = B.by_name(files.where("date in ('d1', 'd4')"), names, how)
    assert "Join" not in plan(whole) and {r.date for r in whole.collect()} == ({"d1"} if how == "left_semi" else {"d4"})


def test_stand_in_landing_is_built_in_tasks_of_bounded_size(spark, monkeypatch):
    files = lambda: fixtures.feed_landing(spark, SMOKE)
    want = files()
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 50)
    got = files()
    assert got.rdd.getNumPartitions() == -(-want.count() // 50)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    landed = fixtures.landed_files(spark, SMOKE, _tmp(spark, "landed"))
    assert not any("snappy" in f for f in landed.inputFiles())
    assert landed.schema == want.schema and landed.exceptAll(want).isEmpty() and want.exceptAll(landed).isEmpty()


# ---- casts

def test_rejects_go_to_the_quarantine_and_strict_loads_fail(spark):
    raw = spark.createDataFrame([("r1", "3"), ("r2", "x3"), ("r3", None), ("r4", " ")], "route_id string, route_type string").select(
        "route_id", "route_type", *[F.lit(None).cast("string").alias(c) for c in
                                    ("agency_id", "route_short_name", "route_long_name", "route_url", "route_color", "route_text_color", "_source_file")],
        F.lit(None).cast("timestamp").alias("_ingestion_timestamp"))
    root = _tmp(spark, "casts")
    rows = casts.load_cast(spark, raw, "gtfs_routes", f"{root}/rows", f"{root}/q")
    assert {(r.route_id, r.route_type) for r in rows.collect()} == {("r1", 3), ("r2", None), ("r3", None), ("r4", None)}
    assert [tuple(r) for r in casts.read_rejects(spark, f"{root}/q").collect()] == [("gtfs_routes", "r2", "route_type", "x3")]
    with pytest.raises(casts.CastRejected, match="route_type 1"):
        casts.load_cast(spark, raw, "gtfs_routes", f"{root}/strict", f"{root}/q", strict=True)
    fine = casts.load_cast(spark, raw.where("route_id <> 'r2'"), "gtfs_routes", f"{root}/strict", f"{root}/q", strict=True)
    assert fine.count() == 3 and casts.read_rejects(spark, f"{root}/q").isEmpty()
    want = staging.stg_routes(raw.where("route_id <> 'r2'"))
    assert fine.exceptAll(want).isEmpty()


# ---- streams

def _stg(spark, rows):
    """Staging rows (bus, minutes after midnight, load minutes) of one route."""
    start = dt.datetime(2026, 1, 1)
    at = lambda m: start + dt.timedelta(minutes=m)
    like = staging.stg_vehicle_positions(fixtures.bronze_table(spark, SMOKE, "vehicle_positions")).schema
    schema = StructType([StructField(f.name, f.dataType) for f in like.fields])
    data = []
    for bus, minute, loaded in rows:
        row = {f.name: None for f in schema.fields}
        row |= {"bus_id": bus, "route_id": "1", "event_timestamp": at(minute), "event_date": at(minute).date(), "event_hour": at(minute).hour,
                "_ingestion_timestamp": at(loaded), "occupancy_status": 1, "speed": 1.5}
        data.append(tuple(row.values()))
    return spark.createDataFrame(data, schema)


def _stream(spark, batches, root):
    for rows in batches:
        df = _stg(spark, rows)
        df.coalesce(1).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"), df


def test_late_rows_are_kept_apart_and_state_keeps_one_row_a_key(spark):
    root = _tmp(spark, "late")
    stream, like = _stream(spark, [[("a", 600, 600), ("a", 600, 601), ("b", 900, 610)], [("a", 600, 700), ("c", 30, 700)],
                                   [("d", 550, 720), ("e", 490, 720)]], root)
    # The watermark is 610 - 120 after the first batch: a clock ahead (b at 900) counts as its load time.
    feeds.await_all(late.split_late(stream, f"{root}/split", f"{root}/_a", delay="2 hours"))
    # After the second it is 610 - 120 still, as that batch held nothing newer; e lies on it and counts as late.
    assert sorted(r.bus_id for r in late.late_rows(spark, f"{root}/split", like).collect()) == ["c", "e"]
    feeds.await_all(late.dedup_stream(spark, f"{root}/split", like, f"{root}/kept", f"{root}/_b", delay="2 hours"))
    kept = [(r.bus_id, r.event_timestamp.hour) for r in spark.read.parquet(f"{root}/kept").collect()]
    assert sorted(b for b, _ in kept) == ["a", "b", "d"]


def test_a_trigger_takes_a_batch_of_the_split_whole(spark):
    root = _tmp(spark, "whole")
    # Two files a batch; the second batch's later file would put its earlier one behind the watermark.
    days = [[(f"a{k}", 600 + k, 600 + k) for k in range(40)], [(f"b{k}", 640 + 30 * k, 640 + 30 * k) for k in range(40)]]
    for k, rows in enumerate(days):
        df = _stg(spark, rows)
        df.repartitionByRange(2, "event_timestamp").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
        feeds.await_all(late.split_late(stream, f"{root}/split", f"{root}/_a", delay="1 hour"))
        assert spark.read.parquet(f"{root}/split/on_time/micro_batch={k}").select(F.countDistinct("_metadata.file_path")).first()[0] == 2
        feeds.await_all(late.dedup_stream(spark, f"{root}/split", df, f"{root}/kept", f"{root}/_b", delay="1 hour"))
    assert late.late_rows(spark, f"{root}/split", df).isEmpty()
    assert sorted(r.bus_id for r in spark.read.parquet(f"{root}/kept").collect()) == sorted(b for rows in days for b, _, _ in rows)


def test_windows_with_late_rows_equal_the_batch_fact(spark):
    from metroflux.operators import gold
    root = _tmp(spark, "windows")
    batches = [[(f"b{k}", 600 + k, 700) for k in range(9)], [("b1", 605, 1300), ("x", 20, 1300), ("x", 21, 1300)] + [("y", 1260 + k, 1300) for k in range(6)],
               [("x", 22 + k, 1400) for k in range(4)] + [("b9", 610, 1400)]]
    stream, like = _stream(spark, batches, root)
    feeds.await_all(late.split_late(stream, f"{root}/split", f"{root}/_a", delay="1 hour"))
    feeds.await_all(late.window_stream(spark, f"{root}/split", like, f"{root}/hours", f"{root}/_b", delay="1 hour"))
    behind = late.late_rows(spark, f"{root}/split", like)
    assert behind.count() >= 6
    got = late.merged_hours(spark, f"{root}/hours", behind)
    want = gold.fct_occupancy_by_hour(_stg(spark, sum(batches, [])))
    assert got.select(*want.columns).exceptAll(want).isEmpty() and want.exceptAll(got.select(*want.columns)).isEmpty()


def test_levels_read_few_runs_and_survive_replays(spark):
    root = _tmp(spark, "levels")
    rows = [[("a", 600 + n % 3, n), (f"b{n}", 600, n)] for n in range(22)]
    schema = _stg(spark, rows[0]).schema
    for n, batch in enumerate(rows):
        levels.write_run(_stg(spark, batch), f"{root}/log", levels.Run(0, n, n))
        levels.merge_full_levels(spark, f"{root}/log", schema)
    live = levels.live_runs(spark, f"{root}/log")
    assert len(live) <= 3 * 3 and live[0].level == 0 and max(r.level for r in live) == 2
    assert sorted(x for r in live for x in range(r.low, r.high + 1)) == list(range(22))
    # What a crash leaves behind, a run that a merged one covers, does not count.
    levels.write_run(_stg(spark, [("ghost", 1, 1)]), f"{root}/log", levels.Run(0, 3, 3))
    got = levels.latest(spark, f"{root}/log", schema)
    from metroflux.operators import silver
    want = silver.latest_positions(_stg(spark, sum(rows, [])))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


# ---- sketches

def test_sketches_roll_up_within_their_error(spark):
    rows = spark.range(300_000).select(F.expr("date_add(date'2026-01-01', cast(id % 59 as int))").alias("event_date"), (F.col("id") % 7).cast("string").alias("route_id"),
                                       (F.hash("id") % 40_000).cast("string").alias("bus_id"), (F.col("id") % 90).cast("string").alias("trip_id"))
    daily = sketches.fct_daily_sketches(rows)
    for level in sketches.LEVELS:
        exact = {(r.route_id, r.month): r for r in sketches.exact_rollup(rows, level).collect()}
        estimate = {(r.route_id, r.month): r for r in sketches.distinct_rollup(daily, level).collect()}
        assert exact.keys() == estimate.keys()
        for k, x in exact.items():
            e = estimate[k]
            assert e.total_positions == x.total_positions
            for c in sketches.SKETCHED:
                assert abs(e[c] - x[c]) <= max(1, sketches.BOUND * x[c]), (level, k, c, e[c], x[c])


# ---- refresh by key

def test_one_late_row_rewrites_its_own_key(spark):
    full = fixtures.Bronze(spark, SMOKE)
    positions = full["vehicle_positions"].where("bus_id is not null and latitude is not null and occupancy_status is not null")
    row = positions.where(F.col("ingestion_date") == F.lit("2026-01-12").cast("date")).orderBy("ingestion_timestamp", "bus_id").limit(1)
    late_row = spark.createDataFrame(row.collect(), positions.schema)
    early = {name: full[name] for name in fixtures.ADAPTERS} | {"vehicle_positions": positions}
    table = keyed.KeyedTable(spark, _tmp(spark, "keyed"), "fct_occupancy_by_hour")
    table.create(Warehouse(spark, early))
    both = early | {"vehicle_positions": positions.unionByName(late_row)}
    keys = keyed.changed_keys(keyed.staged_positions(late_row), "fct_occupancy_by_hour")
    table.refresh(both, keys, version=1)
    assert spark.read.parquet(f"{table.path}/version=1").count() == 1 == keys.count()
    want = Warehouse(spark, both).fct_occupancy_by_hour
    got = table.read().select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    folded = table.compact(_tmp(spark, "folded")).read().select(*want.columns)
    assert folded.exceptAll(want).isEmpty() and want.exceptAll(folded).isEmpty()


def test_a_key_without_rows_gets_a_tombstone(spark):
    full = fixtures.Bronze(spark, SMOKE)
    wh = Warehouse(spark, full)
    table = keyed.KeyedTable(spark, _tmp(spark, "keyed"), "fct_fleet_optimization")
    table.create(wh)
    gone = table.read().select("route_id", "event_date").orderBy("event_date", "route_id").first()
    stg = wh.stg_vehicle_positions.where((F.col("route_id") == gone.route_id) & (F.col("event_date") == F.lit(gone.event_date)))
    left = full["vehicle_positions"].where(~((F.col("route_id") == gone.route_id) & (
        F.from_utc_timestamp("event_timestamp", "America/Montreal").cast("date") == F.lit(gone.event_date))))
    table.refresh({name: full[name] for name in fixtures.ADAPTERS} | {"vehicle_positions": left}, keyed.changed_keys(stg, "fct_fleet_optimization"), 1)
    assert table.read().where((F.col("route_id") == gone.route_id) & (F.col("event_date") == F.lit(gone.event_date))).isEmpty()


# ---- co-located joins

def test_bucketed_facts_join_without_a_shuffle_on_the_trip(spark):
    wh = Warehouse.from_driver(spark, SMOKE)
    database = f"colocated_{uuid.uuid4().hex[:8]}"
    assert colocated.publish_bucketed(wh, database) == 8
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    stops = spark.createDataFrame(wh.dim_stops.collect(), wh.dim_stops.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(colocated.fact_stop_times(spark, database, F.broadcast(stops)))
        assert "SortMergeJoin" in text and "hashpartitioning(trip_id" not in text
        text = plan(colocated.fct_route_analytics(spark, database, F.broadcast(stops)))
        assert "hashpartitioning(trip_id" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


# ---- checks counted while writing

def test_rules_counted_in_the_write_equal_a_scan(spark):
    wh = Warehouse.from_driver(spark, SMOKE)
    tables = ["fact_trips", "fact_vehicle_positions", "fct_daily_performance", "dim_routes"]
    rules = [r for r in quality.RULES if r.model in tables and r.test in ("not_null", "accepted_values")]
    found = {}
    materialize(wh, _tmp(spark, "observed"), tables, partition_by={"fct_daily_performance": ["event_date"]},
                measures=quality.measures(rules, tables), found=found)
    assert set(found) == {r.model for r in rules}
    scanned, counted = quality.run_rules(wh.model, rules), quality.run_rules(wh.model, rules, found)
    assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, counted.collect()))
