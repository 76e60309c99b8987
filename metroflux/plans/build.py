"""Build-then-test run of the whole warehouse (the scheduled daily job).

    python -m metroflux.plans.build --bronze /lake/bronze --out /lake/warehouse [--refresh START END]

reads the named bronze tables, writes every silver and gold model in
dependency waves, runs the 104 data-quality assertions on the written
tables, appends the results to ``<out>/_dq_results`` and fails only on
error-severity violations.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.operators import quality
from metroflux.plans.warehouse import (DATE_GRAIN_MODELS, DATE_PARTITIONS, GOLD_MODELS, SILVER_MODELS, Warehouse,
                                       materialize, refresh_dates)
from metroflux.session import get_session, sizing
from metroflux.sources import bronze as B

# Date-partitioned facts: readers filtering on dates prune whole folders, and
# ``warehouse.refresh_dates`` can replace single dates.
PARTITIONS = DATE_PARTITIONS


def build_all(spark: SparkSession, bronze_root: str, out_dir: str, run_tests: bool = True,
              enforce: bool = True, as_of=None, refresh: tuple[str, str] | None = None) -> DataFrame | None:
    """Full build, or with ``refresh=(start, end)`` an incremental one.

    Incremental: date-grain models (positions fact, daily/fleet/hourly
    facts, wide table) replace only the local dates in the window; the
    schedule-based models (dimensions, trips, stop times, route analytics)
    are small and rebuilt in full.  Tests then run on the complete tables.
    """
    bronze = B.bronze_sources(spark, bronze_root)
    wh = Warehouse(spark, bronze, as_of=as_of)
    # Full writes count the bad rows of their own rules; a refresh writes part of its tables, so those are scanned.
    counted: dict[str, dict] = {}
    written = SILVER_MODELS + GOLD_MODELS if refresh is None else [m for m in SILVER_MODELS + GOLD_MODELS if m not in DATE_GRAIN_MODELS]
    measures = quality.measures(quality.RULES, written) if run_tests else None
    materialize(wh, out_dir, written, partition_by=PARTITIONS if refresh is None else None, measures=measures, found=counted)
    if refresh is not None:
        for name, table in refresh_dates(spark, bronze, out_dir, *refresh).items():
            wh.__dict__[name] = table
    if not run_tests:
        return None
    run_id = uuid.uuid4().hex
    results = quality.run_rules(wh.model, counted=counted).withColumns({"run_id": F.lit(run_id), "run_at": F.current_timestamp()})
    path = f"{out_dir.rstrip('/')}/_dq_results"
    results.write.mode("append").parquet(path)
    written = spark.read.parquet(path).where(F.col("run_id") == run_id)
    return quality.enforce(written) if enforce else written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--skip-tests", action="store_true")
    ap.add_argument("--no-enforce", action="store_true")
    ap.add_argument("--refresh", nargs=2, metavar=("START", "END"),
                    help="replace only local dates START..END of the date-grain models")
    ap.add_argument("--input-bytes", type=int, help="size of the bronze tables, for the shuffle and scan settings")
    ap.add_argument("--cores", type=int, default=8, help="total executor cores")
    a = ap.parse_args(argv)
    spark = get_session(extra=sizing(a.input_bytes, a.cores) if a.input_bytes else None)
    build_all(spark, a.bronze, a.out, run_tests=not a.skip_tests, enforce=not a.no_enforce,
              refresh=tuple(a.refresh) if a.refresh else None)


if __name__ == "__main__":
    main()
