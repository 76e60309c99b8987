"""Plan guards: the physical plans keep the properties the design relies on."""

import re
import uuid

import pytest

from metroflux.plans import registry
from metroflux.plans.warehouse import Warehouse
from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures
from tests.conftest import SMOKE

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]
SIDE_EFFECTS = ("stream_", "bronze_partition_overwrite", "bronze_gtfs_", "bronze_weather_json_load",
                "bronze_landing_listing", "bronze_ingest_run", "bronze_incremental_rerun", "bronze_reprocess_date",
                "bronze_run_accounting", "gold_refresh_models", "dq_")
QUERIES = registry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.startswith(SIDE_EFFECTS)))
def test_no_cartesian_no_python_udf(spark, name):
    text = plan(QUERIES[name](spark, SMOKE))
    for bad in FORBIDDEN:
        assert bad not in text, f"{name}: {bad}"


def test_dedup_limits_rows_before_the_shuffle(spark):
    text = plan(Warehouse.from_driver(spark, SMOKE).fact_vehicle_positions)
    # WindowGroupLimit appears twice: partial (map side, below the Exchange) and final.
    assert text.count("WindowGroupLimit") >= 2
    first_limit, first_exchange = text.rfind("WindowGroupLimit"), text.rfind("Exchange hashpartitioning(bus_id")
    assert first_exchange != -1 and first_limit > first_exchange  # printed below = executed before


def test_staging_filters_and_columns_reach_the_bronze_scan(spark):
    root = f"{checkpoint_dir(spark)}/plan-{uuid.uuid4().hex}"
    fixtures.bronze_table(spark, SMOKE, "vehicle_positions").write.parquet(f"{root}/vehicle_positions")
    wh = Warehouse(spark, {"vehicle_positions": B.read_bronze(spark, f"{root}/vehicle_positions")})
    text = plan(wh.fct_occupancy_by_hour)
    scan = [line for line in text.splitlines() if "FileScan parquet" in line][0]
    for col in ("bus_id", "latitude", "longitude", "occupancy_status"):
        assert f"IsNotNull({col})" in scan
    read_cols = {c.split("#")[0] for c in re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1).split(",")}
    assert "bearing" not in read_cols and "source_system" not in read_cols and "occupancy_status" in read_cols


def test_refresh_window_prunes_bronze_partitions(spark):
    from pyspark.sql import functions as F
    root = f"{checkpoint_dir(spark)}/prune-{uuid.uuid4().hex}"
    (fixtures.bronze_table(spark, SMOKE, "vehicle_positions").write.partitionBy("ingestion_date")
     .parquet(f"{root}/vehicle_positions"))
    bronze = B.read_bronze(spark, f"{root}/vehicle_positions")
    window = bronze.where(F.col("ingestion_date").between(F.lit("2026-01-09").cast("date"),
                                                          F.lit("2026-01-14").cast("date")))
    inputs = dict(fixtures.Bronze(spark, SMOKE))
    inputs["vehicle_positions"] = window
    text = plan(Warehouse(spark, inputs).fact_vehicle_positions)
    scan = [line for line in text.splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(ingestion_date" in scan and "ingestion_date" in scan


def test_full_rebuild_drops_stale_partitions(spark):
    from pyspark.sql import functions as F

    from metroflux.plans.warehouse import DATE_PARTITIONS, materialize
    from metroflux.sources.fixtures import Bronze
    out = f"{checkpoint_dir(spark)}/rebuild-{uuid.uuid4().hex}"
    full = Bronze(spark, SMOKE)
    materialize(Warehouse(spark, full), out, ["fact_vehicle_positions"], partition_by=DATE_PARTITIONS)
    fewer = dict(full)
    fewer["vehicle_positions"] = full["vehicle_positions"].where(F.col("ingestion_date") < F.lit("2026-01-15").cast("date"))
    materialize(Warehouse(spark, fewer), out, ["fact_vehicle_positions"], partition_by=DATE_PARTITIONS)
    dates = spark.read.parquet(f"{out}/fact_vehicle_positions").agg(F.max("event_date")).first()[0]
    assert str(dates) <= "2026-01-14"
