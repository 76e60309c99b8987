"""Registered queries of ingest as a whole: cut-off runs, landed files, metadata, named sources, publishing."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.plans import oracle
from metroflux.plans.q_bronze import sql
from metroflux.plans.registry import register
from metroflux.plans.warehouse import STAGING_MODELS, Warehouse, publish
from metroflux.session import checkpoint_dir
from metroflux.sources import bronze as B
from metroflux.sources import fixtures
from metroflux.sources.ledger import Ledger

C = F.col
#: Landing dates of the first poll end before the first, those of the second before the second.
POLLS = ("2026-01-10", "2026-01-20")
CUTS = ("intent", "quarantine", "records", "accounting")


def _root(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _union(frames) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


_POLL = f"CASE WHEN date < '{POLLS[0]}' THEN 'poll-1' WHEN date < '{POLLS[1]}' THEN 'poll-2' ELSE 'poll-3' END"


@register("bronze_cut_off_runs", sql(f"""
SELECT c.cut, t.* FROM (VALUES {', '.join(f"('{c}')" for c in CUTS)}) c(cut), (
  SELECT 'bronze' AS target, {_POLL} AS batch_id, file_name, COUNT(*) AS n_rows FROM ev WHERE kind = 'feed' GROUP BY ALL
  UNION ALL SELECT 'quarantine', {_POLL}, file_name, COUNT(*) FROM ev WHERE kind IN ('corrupt', 'bad_entity') GROUP BY ALL
  UNION ALL SELECT 'processed', {_POLL}, file_name, 1 FROM ev
  UNION ALL SELECT 'log', {_POLL}, concat('batch_', {_POLL}), 1 FROM ev GROUP BY ALL) t"""))
def q_bronze_cut_off_runs(spark, sf_dir):
    """A poll ends after each of its writes, as a crash would end it; the next poll finishes it.

    Three polls; the second is cut off.  Rows per file and batch in every table equal those of three clean runs.
    """
    files = fixtures.landed_files(spark, sf_dir, _root(spark, "cut-landing"))
    out = []
    for cut in CUTS:
        root = _root(spark, f"cut-{cut}")
        run = functools.partial(B.ingest, spark, bronze_path=f"{root}/bronze", quarantine_path=f"{root}/quarantine",
                                accounting=f"{root}/log")
        run(files.where(C("date") < POLLS[0]), batch_id="poll-1")
        run(files.where(C("date") < POLLS[1]), batch_id="poll-2", until=cut)
        run(files, batch_id="poll-3")
        tables = {
            "bronze": B.read_bronze(spark, f"{root}/bronze").withColumnRenamed("ingestion_file", "file_name"),
            "quarantine": B.read_quarantine(spark, f"{root}/quarantine").withColumnRenamed("source_file", "file_name"),
            "processed": Ledger(spark, f"{root}/bronze_files").processed(),
            "log": B.read_log(spark, f"{root}/log"),
        }
        out += [df.groupBy("batch_id", "file_name").agg(F.count("*").alias("n_rows"))
                .select(F.lit(cut).alias("cut"), F.lit(name).alias("target"), "batch_id", "file_name", "n_rows")
                for name, df in tables.items()]
    return _union(out)


@register("bronze_full_after_increments", sql("""
SELECT 'again' AS batch_id, file_name, COUNT(*) FILTER (WHERE kind = 'feed') AS bronze_rows FROM ev GROUP BY file_name"""))
def q_bronze_full_after_increments(spark, sf_dir):
    """A full run of part of the landing replaces the table; the files outside it count as new again.

    Poll, full run of the first dates (cut off once, then run again), poll: every file is loaded once.
    """
    root = _root(spark, "full")
    files = fixtures.landed_files(spark, sf_dir, f"{root}/landing")
    run = functools.partial(B.ingest, spark, bronze_path=f"{root}/bronze", quarantine_path=f"{root}/quarantine")
    run(files, batch_id="first")
    early = files.where(C("date") < POLLS[0])
    run(early, batch_id="again", mode="full", until="records")
    run(early, batch_id="later", mode="full")  # takes the place of the run that was cut off
    run(files, batch_id="again-2")
    rows = B.read_bronze(spark, f"{root}/bronze").groupBy(C("ingestion_file").alias("file_name")).agg(F.count("*").alias("bronze_rows"))
    done = Ledger(spark, f"{root}/bronze_files").processed()
    return (done.select(F.when(C("batch_id").isin("again", "again-2"), "again").otherwise(C("batch_id")).alias("batch_id"), "file_name")
            .join(rows, "file_name", "left").fillna(0, ["bronze_rows"]))


@register("bronze_landing_polls", sql(f"""
SELECT batch_id, file_count, record_count, error_count, status, record_count AS bronze_rows, error_count AS quarantine_rows FROM (
  SELECT batch_id, COUNT(DISTINCT (date, hour)) AS file_count, COUNT(*) FILTER (WHERE kind = 'feed') AS record_count,
    COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) AS error_count,
    CASE WHEN COUNT(*) FILTER (WHERE kind = 'feed') = 0 THEN CASE WHEN COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) > 0
        THEN 'FAILED' ELSE 'NO_DATA' END
      WHEN COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status
  FROM (SELECT *, CASE WHEN date < '{POLLS[0]}' THEN 'poll-1' ELSE 'poll-2' END AS batch_id FROM ev) p GROUP BY batch_id
  UNION ALL SELECT 'poll-3', 0, 0, 0, 'NO_NEW_FILES') r"""))
def q_bronze_landing_polls(spark, sf_dir):
    """A1/A3-A5: three polls of a growing landing folder; names select the files, the executors open them.

    The stand-in files hold one snapshot a line.
    """
    files, root = fixtures.feed_landing(spark, sf_dir), _root(spark, "polls")
    landing, out = f"{root}/landing", []
    for k, part in enumerate((files.where(C("date") < POLLS[0]), files.where(C("date") >= POLLS[0]), None), 1):
        if part is not None:
            fixtures.write_landing(part, landing, mode="append")
        out.append(B.ingest_landing(spark, landing, f"{root}/bronze", f"{root}/quarantine", glob="*.txt", lines=True, batch_id=f"poll-{k}"))
    bronze = B.read_bronze(spark, f"{root}/bronze").groupBy("batch_id").agg(F.count("*").alias("bronze_rows"))
    bad = B.read_quarantine(spark, f"{root}/quarantine").groupBy("batch_id").agg(F.count("*").alias("quarantine_rows"))
    return (_union(out).select("batch_id", "file_count", "record_count", "error_count", "status")
            .join(bronze, "batch_id", "left").join(bad, "batch_id", "left").fillna(0, ["bronze_rows", "quarantine_rows"]))


@register("bronze_run_metadata", sql("""
SELECT batch_id, 'bronze_vehicle_positions' AS job_name, '2.0' AS job_version, 'BRONZE' AS layer, status,
  concat('{"mode":"', mode, '"', CASE WHEN d IS NOT NULL THEN concat(',"process_date":"', d, '"') END, '}') AS params_json,
  true AS by_session_user, true AS run_in_time FROM (
  SELECT 'all' AS batch_id, 'full' AS mode, NULL AS d, CASE WHEN COUNT(*) FILTER (WHERE kind = 'feed') = 0 THEN 'NO_DATA'
      WHEN COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status FROM ev
  UNION ALL SELECT 'day', 'full', '2026-01-10', CASE WHEN COUNT(*) = 0 THEN 'NO_NEW_FILES'
      WHEN COUNT(*) FILTER (WHERE kind = 'feed') = 0 THEN 'NO_DATA'
      WHEN COUNT(*) FILTER (WHERE kind IN ('corrupt', 'bad_entity')) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END FROM ev WHERE date = '2026-01-10'
  UNION ALL SELECT 'none', 'incremental', NULL, 'NO_NEW_FILES') r"""))
def q_bronze_run_metadata(spark, sf_dir):
    """Metadata rows of three runs: name, version, layer, status, JSON parameters, run user and time."""
    files, root = fixtures.feed_landing(spark, sf_dir), _root(spark, "metadata")
    began = spark.sql("SELECT current_timestamp()").first()[0]
    run = functools.partial(B.ingest, spark, files, f"{root}/bronze", f"{root}/quarantine", accounting=f"{root}/log")
    run(batch_id="all", mode="full")
    run(batch_id="day", mode="full", process_date="2026-01-10")
    run(batch_id="none")
    return B.read_metadata(spark, f"{root}/log").select(
        "batch_id", "job_name", "job_version", "layer", "status", "params_json", (C("run_by") == F.current_user()).alias("by_session_user"),
        C("run_at").between(F.lit(began), F.current_timestamp()).alias("run_in_time"))


@register("bronze_named_sources", oracle.query("\nUNION ALL\n".join(
    f"SELECT '{t}' AS source_name, COUNT(*) AS n_rows FROM {t}" for t in B.SOURCE_TABLES)))
def q_bronze_named_sources(spark, sf_dir):
    """The ten bronze tables written under one root and opened by name, columns checked."""
    root = _root(spark, "sources")
    for name in B.SOURCE_TABLES:
        fixtures.bronze_table(spark, sf_dir, name).write.parquet(f"{root}/{name}")
    return _union([B.table_count(df, name) for name, df in B.bronze_sources(spark, root).items()]).select(
        C("table_name").alias("source_name"), C("rows").alias("n_rows"))


PUBLISHED = {"dim_routes": "warehouse", "fact_trips": "warehouse", "fct_route_analytics": "marts", "fct_occupancy_by_hour": "marts"}


@register("warehouse_publish", oracle.query("\nUNION ALL\n".join(
    [f"SELECT 'view' AS kind, NULL AS layer_database, '{m}' AS model, COUNT(*) AS n_rows FROM {m}" for m in STAGING_MODELS]
    + [f"SELECT 'table', '{db}', '{m}', COUNT(*) FROM {m}" for m, db in PUBLISHED.items()])))
def q_warehouse_publish(spark, sf_dir):
    """Staging models published as views, tables into the database of their layer, all read back by name."""
    tag = uuid.uuid4().hex[:12]
    names = publish(Warehouse.from_driver(spark, sf_dir), f"warehouse_{tag}", {"gold": f"marts_{tag}"}, tables=list(PUBLISHED))
    counts = []
    for model, name in names.items():
        database = F.lit(name.split(f"_{tag}.")[0] if "." in name else None).cast("string")
        counts.append(spark.table(name).agg(F.count("*").alias("n_rows")).select(
            F.lit("table" if "." in name else "view").alias("kind"), database.alias("layer_database"), F.lit(model).alias("model"), "n_rows"))
    return _union(counts)
