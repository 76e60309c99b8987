"""Bronze ingestion behaviour beyond the oracle: sinks, logs, incremental runs."""

import uuid

import pytest
from pyspark.sql import functions as F

from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures
from tests.conftest import SMOKE


def _tmp(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def test_partition_overwrite_refuses_stray_dates(spark):
    files = fixtures.feed_landing(spark, SMOKE)
    rows = B.enrich(B.records(B.decode(files)), "b1")
    path = _tmp(spark, "bronze")
    B.write_bronze(rows, path, "overwrite")
    before = B.read_bronze(spark, path).groupBy("ingestion_date").count().collect()
    with pytest.raises(Exception, match="outside ingestion_date"):
        B.write_bronze(rows.withColumn("batch_id", F.lit("b2")), path, "overwrite", process_date="2026-01-10")
    # The failed job committed nothing: every partition is as before.
    assert B.read_bronze(spark, path).groupBy("ingestion_date").count().collect() == before
    assert B.read_bronze(spark, path).where(F.col("batch_id") == "b2").count() == 0


def test_incremental_equals_full_reload(spark):
    files = fixtures.feed_landing(spark, SMOKE)
    path = _tmp(spark, "bronze")
    first = files.where(F.col("date") < "2026-01-12")
    B.write_bronze(B.enrich(B.records(B.decode(first)), "b1"), path, "append")
    loaded = B.read_bronze(spark, path)
    todo = B.select_files(files, loaded, "incremental")
    B.write_bronze(B.enrich(B.records(B.decode(todo)), "b2"), path, "append")
    # Files without rows are re-selected, so only rows count: the table equals a full load.
    full = B.records(B.decode(files)).select(*B.RECORD_COLUMNS)
    got = B.read_bronze(spark, path).select(*B.RECORD_COLUMNS)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_good_plus_quarantined_equals_entities(spark):
    dec = B.decode(fixtures.feed_landing(spark, SMOKE))
    counts = {r.outcome: r["count"] for r in dec.groupBy("outcome").count().collect()}
    assert B.records(dec).count() == counts["record"]
    assert B.errors(dec, "b").count() == counts.get("RECORD_PARSE_ERROR", 0) + counts.get("FILE_READ_ERROR", 0)


def test_ingest_writes_quarantine_and_summary(spark):
    files = fixtures.feed_landing(spark, SMOKE)
    bpath, qpath = _tmp(spark, "bronze"), _tmp(spark, "quarantine")
    summary = B.ingest(spark, files, bpath, qpath, batch_id="run1", mode="full").first()
    assert summary.status == "PARTIAL" and summary.error_count > 0
    assert spark.read.parquet(qpath).count() == summary.error_count
    assert B.read_bronze(spark, bpath).count() == summary.record_count
    # A second incremental run finds only files that produced no rows.
    # The manifest holds every file, also those without records: a second run finds nothing and writes nothing.
    again = B.ingest(spark, files, bpath, qpath, batch_id="run2").first()
    assert (again.status, again.file_count) == ("NO_NEW_FILES", 0)
    assert B.read_bronze(spark, bpath).count() == summary.record_count
    assert B.read_quarantine(spark, qpath).count() == summary.error_count
    # The watermark of a bronze table instead: files without rows are selected again.
    third = B.ingest(spark, files, bpath, qpath, batch_id="run3", existing=B.read_bronze(spark, bpath)).first()
    assert third.record_count == 0 and third.file_count > 0
    # A repeated batch id replaces its own quarantine rows.
    B.ingest(spark, files, bpath, qpath, batch_id="run3", existing=B.read_bronze(spark, bpath))
    assert B.read_quarantine(spark, qpath).where(F.col("batch_id") == "run3").count() == third.error_count
    # A first incremental run into an empty location takes every file.
    fresh = B.ingest(spark, files, _tmp(spark, "b"), _tmp(spark, "q"), batch_id="run4").first()
    assert fresh.record_count == summary.record_count


def test_short_payloads_are_set_aside(spark):
    files = fixtures.feed_landing(spark, SMOKE)
    short = files.where(F.col("length") < B.MIN_PAYLOAD_BYTES).count()
    qpath = _tmp(spark, "q")
    B.ingest(spark, files, _tmp(spark, "b"), qpath, batch_id="b", min_bytes=B.MIN_PAYLOAD_BYTES)
    bad = B.read_quarantine(spark, qpath).where(F.col("error_type") == "PAYLOAD_TOO_SMALL")
    assert bad.count() == short > 0


def test_only_new_landed_paths_are_read(spark):
    base, bpath, qpath = (_tmp(spark, n) for n in ("landing", "bronze", "quarantine"))
    files = fixtures.feed_landing(spark, SMOKE).limit(20)
    fixtures.write_landing(files, base)
    first = B.ingest_landing(spark, base, bpath, qpath, glob="*.txt", batch_id="one").first()
    second = B.ingest_landing(spark, base, bpath, qpath, glob="*.txt", batch_id="two").first()
    assert first.file_count > 0 and (second.file_count, second.status) == (0, "NO_NEW_FILES")
    listing = B.unprocessed(B.discover_files(spark, base, glob="*.txt"), B.read_manifest(spark, f"{bpath}_files"))
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()


def test_heavy_date_is_split_and_emptied_date_is_dropped(spark):
    from metroflux.sources.partitions import cluster_by_date, replace_dates
    day = F.when(F.col("id") < 50_000, F.lit("2026-01-01")).otherwise(F.lit("2026-01-02")).cast("date")
    df = spark.range(50_100).withColumn("event_date", day)
    path = _tmp(spark, "dates")
    # These dates are small: without AQE's merging, as with large ones, the heavy date takes several tasks.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cluster_by_date(df, "event_date").write.partitionBy("event_date").parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per = spark.read.parquet(path).groupBy("event_date").agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"))
    assert {str(r.event_date): r.files for r in per.collect()}["2026-01-01"] > 1
    emptied = replace_dates(df.where("event_date = date'2026-01-02'").limit(5), path, "event_date", ["2026-01-01", "2026-01-02"])
    assert emptied == ["2026-01-01"] and spark.read.parquet(path).count() == 5


def test_run_log_and_metadata_rows(spark):
    log = B.run_log_row(spark, "b1", "vehicle_positions_bronze", "batch_b1", "/landing", 10, "SUCCESS",
                        "it's fine", 12.7).first()
    assert log.error_message == "it's fine"
    assert (log.finished_at - log.started_at).total_seconds() == 12
    md = B.metadata_row(spark, "b1", "bronze", "2.0", "SUCCESS", {"mode": "full", "note": 'it\'s "x"'}).first()
    import json
    assert json.loads(md.params_json) == {"mode": "full", "note": 'it\'s "x"'} and md.run_by


def test_landing_files_roundtrip(spark):
    base = _tmp(spark, "landing")
    fixtures.write_landing(fixtures.feed_landing(spark, SMOKE), base)
    lines = B.read_landing_lines(spark, base)
    listed = B.discover_files(spark, base, glob="*.txt")
    assert lines.select("date", "hour").distinct().count() == listed.select("date", "hour").distinct().count()
    one_day = B.discover_files(spark, base, glob="*.txt", date="2026-01-03")
    assert one_day.select("date").distinct().collect()[0][0] == "2026-01-03"
    dec = B.decode(lines)
    assert B.records(dec).count() == B.records(B.decode(fixtures.feed_landing(spark, SMOKE))).count()


def test_bronze_sources_and_publish(spark):
    from metroflux.plans.warehouse import Warehouse, publish, target_schema
    root = _tmp(spark, "bronze-root")
    for name in B.SOURCE_TABLES:
        fixtures.bronze_table(spark, SMOKE, name).write.parquet(f"{root}/{name}")
    src = B.bronze_sources(spark, root)
    wh = Warehouse(spark, src)
    assert target_schema("fct_daily_performance", "silver_db", {"gold": "gold_db"}) == "gold_db"
    assert target_schema("dim_routes", "silver_db", {"gold": "gold_db"}) == "silver_db"
    names = publish(wh, "mf_silver", {"gold": "mf_gold"}, tables=["dim_routes", "fct_route_analytics"])
    assert names["fct_route_analytics"] == "mf_gold.fct_route_analytics"
    assert spark.table("mf_gold.fct_route_analytics").count() > 0
    assert spark.sql("SELECT count(*) FROM stg_routes").first()[0] == 25


def test_build_then_test_run(spark):
    from metroflux.plans.build import build_all
    root = _tmp(spark, "bronze-root")
    for name in B.SOURCE_TABLES:
        fixtures.bronze_table(spark, SMOKE, name).write.parquet(f"{root}/{name}")
    res = build_all(spark, root, _tmp(spark, "wh"), enforce=False)
    by = {(r.model, r.column_name, r.test): r for r in res.collect()}
    assert len(by) == 104
    # Orphan routes are a warning, never an error.
    rel = by[("fact_vehicle_positions", "route_id", "relationships")]
    assert rel.severity == "warn" and rel.status in ("pass", "warn")
    # Events outside the date window fail the rules on event dates; trips without a route, and the stops
    # that the join finds for them, fail not_null.
    failed = {k for k, r in by.items() if r.status == "fail"}
    assert failed and all(k[1] in ("event_date", "route_id", "total_stops") for k in failed)


def test_build_refresh_equals_full_build(spark):
    from metroflux.plans.build import build_all
    from metroflux.plans.warehouse import Warehouse, local_dates_touched
    root_all, root_early = _tmp(spark, "bronze-all"), _tmp(spark, "bronze-early")
    late = (F.col("ingestion_date") >= F.lit("2026-01-10").cast("date")) & \
        (F.col("ingestion_date") <= F.lit("2026-01-12").cast("date"))
    for name in B.SOURCE_TABLES:
        df = fixtures.bronze_table(spark, SMOKE, name)
        df.write.parquet(f"{root_all}/{name}")
        (df.where(~late) if name == "vehicle_positions" else df).write.parquet(f"{root_early}/{name}")
    out = _tmp(spark, "wh")
    build_all(spark, root_early, out, run_tests=False)
    res = build_all(spark, root_all, out, enforce=False, refresh=local_dates_touched("2026-01-10", "2026-01-12"))
    assert res.count() == 104
    want = Warehouse(spark, B.bronze_sources(spark, root_all)).fct_daily_performance.drop("_dbt_updated_at")
    got = spark.read.parquet(f"{out}/fct_daily_performance").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
