"""What ingest batches were begun with, and which of them are done.

A batch first writes its files under ``begun/batch_id=``, then its outputs, each in
a folder of its own, and last one row under ``done/batch_id=``.  Only the files of
done batches count as processed.  A batch without that row was cut off: it is run
again under its own id with the files it was begun with, and every output
replaces what the first attempt left.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BEGUN_SCHEMA = "file_name string, mode string, process_date string, begun_at timestamp, batch_id string"
DONE_SCHEMA = "mode string, process_date string, committed_at timestamp, batch_id string"


def read_or_none(spark: SparkSession, schema, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written yet."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def replace_batch(rows: DataFrame, path: str) -> None:
    """Write rows of one ``batch_id``; what the batch wrote there before is replaced, other batches stay."""
    (rows.write.partitionBy("batch_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


class Pending(NamedTuple):
    """A batch that was begun and not finished."""

    batch_id: str
    mode: str
    process_date: str | None


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        found = read_or_none(self.spark, schema, f"{self.path}/{name}")
        return self.spark.createDataFrame([], schema) if found is None else found

    def begin(self, names: DataFrame, batch_id: str, mode: str, process_date: str | None) -> None:
        """``names`` has file_name."""
        replace_batch(names.select("file_name").distinct().select(
            "file_name", F.lit(mode).alias("mode"), F.lit(process_date).cast("string").alias("process_date"),
            F.current_timestamp().alias("begun_at"), F.lit(batch_id).alias("batch_id")), f"{self.path}/begun")

    def commit(self, batch_id: str, mode: str, process_date: str | None) -> None:
        row = self.spark.range(1).select(F.lit(mode).alias("mode"), F.lit(process_date).cast("string").alias("process_date"),
                                         F.current_timestamp().alias("committed_at"), F.lit(batch_id).alias("batch_id"))
        replace_batch(row.coalesce(1), f"{self.path}/done")

    def pending(self) -> list[Pending]:
        """Batches to run again, oldest first: those of runs that were cut off, so a few at most."""
        begun, done = self._table("begun", BEGUN_SCHEMA), self._table("done", DONE_SCHEMA)
        cut = (begun.groupBy("batch_id", "mode", "process_date").agg(F.min("begun_at").alias("begun_at"))
               .join(done.select("batch_id"), "batch_id", "left_anti").orderBy("begun_at", "batch_id"))
        return [Pending(r["batch_id"], r["mode"], r["process_date"]) for r in cut.collect()]

    def files_of(self, batch_id: str) -> DataFrame:
        return self._table("begun", BEGUN_SCHEMA).where(F.col("batch_id") == batch_id).select("file_name")

    def processed(self) -> DataFrame:
        """(file_name, batch_id, processed_at) of done batches.

        A full run of the whole landing replaced the table, so only it and what came after it count.
        """
        done = self._table("done", DONE_SCHEMA)
        whole = (F.col("mode") == "full") & F.col("process_date").isNull()
        floor = done.agg(F.max(F.when(whole, F.col("committed_at"))).alias("floor")).first()["floor"]
        if floor is not None:
            done = done.where(F.col("committed_at") >= F.lit(floor))
        return (self._table("begun", BEGUN_SCHEMA).select("file_name", "batch_id")
                .join(done.select("batch_id", F.col("committed_at").alias("processed_at")), "batch_id")
                .select("file_name", "batch_id", "processed_at"))
