"""Levels of runs for the dedup log, so that reading merges few of them.

Every micro-batch leaves one run at level 0: its latest row per (bus, time), dealt by bus and sorted.
When a level holds ``FANOUT`` runs they are merged into one run of the next, so after N batches at most
(FANOUT - 1) * log(N) / log(FANOUT) + FANOUT runs are read.  A run is named by the batches it covers; one that
lies inside another finished run no longer counts, so a crash between writing a merged run and
dropping its parts changes nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from metroflux.operators import silver

FANOUT = 4


class Run(NamedTuple):
    level: int
    low: int
    high: int

    @property
    def folder(self) -> str:
        return f"level={self.level}/run={self.low}-{self.high}"


def filesystem(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def finished_runs(spark: SparkSession, log: str) -> list[Run]:
    """All finished runs; a listing of folder names, a few per level."""
    fs, top = filesystem(spark, log)
    out = []
    for level in (fs.listStatus(top) if fs.exists(top) else []):
        for run in fs.listStatus(level.getPath()):
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(run.getPath(), "_SUCCESS")):
                low, _, high = run.getPath().getName().removeprefix("run=").partition("-")
                out.append(Run(int(level.getPath().getName().removeprefix("level=")), int(low), int(high)))
    return sorted(out)


def live_runs(spark: SparkSession, log: str) -> list[Run]:
    """The finished runs that no run of a higher level covers."""
    runs = finished_runs(spark, log)
    return [r for r in runs if not any(s.level > r.level and s.low <= r.low and r.high <= s.high for s in runs)]


def write_run(rows: DataFrame, log: str, run: Run) -> None:
    (silver.latest_positions(rows).repartition("bus_id").sortWithinPartitions("bus_id", "event_timestamp")
     .write.mode("overwrite").parquet(f"{log.rstrip('/')}/{run.folder}"))


def read_runs(spark: SparkSession, log: str, runs: list[Run], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{log.rstrip('/')}/{r.folder}" for r in runs])


def merge_full_levels(spark: SparkSession, log: str, schema, fanout: int = FANOUT) -> None:
    """Merge each level that is full into one run of the next, and drop the runs it covers."""
    level = 0
    while True:
        live = live_runs(spark, log)
        own = [r for r in live if r.level == level]
        if len(own) >= fanout:
            write_run(read_runs(spark, log, own, schema), log, Run(level + 1, min(r.low for r in own), max(r.high for r in own)))
        elif level >= max((r.level for r in live), default=0):
            break
        level += 1
    live = set(live_runs(spark, log))
    for r in finished_runs(spark, log):
        if r not in live:
            fs, path = filesystem(spark, f"{log.rstrip('/')}/{r.folder}")
            fs.delete(path, True)


def levelled_log_stream(stg_positions: DataFrame, log: str, checkpoint: str, fanout: int = FANOUT) -> StreamingQuery:
    """Latest-wins dedup of a stream into levels of runs; a replayed batch replaces its run, or is covered by a merged one."""
    schema = stg_positions.schema

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not any(r.low <= batch_id <= r.high and r.level > 0 for r in finished_runs(spark, log)):
            write_run(batch, log, Run(0, batch_id, batch_id))
        merge_full_levels(spark, log, schema, fanout)

    return (stg_positions.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest(spark: SparkSession, log: str, schema) -> DataFrame:
    """The latest row per (bus, time) over the live runs."""
    return silver.latest_positions(read_runs(spark, log, live_runs(spark, log), schema))
