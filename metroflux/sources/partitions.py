"""Replacing date partitions of Parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def cluster_by_date(df: DataFrame, *dates: str) -> DataFrame:
    """Range partitions on the date columns plus a hash of the row.

    Equal dates alone never cross a range border, so a date would be one task and
    one file; the hash lets the borders fall inside a heavy date.
    """
    rest = [c for c in df.columns if c not in dates]
    return df.repartitionByRange(*dates, F.xxhash64(*rest)) if rest else df.repartitionByRange(*dates)


def dates_between(start: str, end: str) -> list[str]:
    lo, hi = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [(lo + dt.timedelta(days=k)).isoformat() for k in range((hi - lo).days + 1)]


def partition_names(spark: SparkSession, folder: str) -> dict[str, frozenset[str]]:
    """The partition folders right below ``folder``, each with the names of its data files."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(conf)
    if not fs.exists(top):
        return {}
    return {f.getPath().getName(): frozenset(x.getPath().getName() for x in fs.listStatus(f.getPath()))
            for f in fs.listStatus(top) if f.isDirectory()}


def drop_partitions(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Remove partition folders below ``folder``."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(jvm.org.apache.hadoop.fs.Path(folder), name)
        path.getFileSystem(conf).delete(path, True)


def _listing(spark: SparkSession, path: str, column: str, dates: list[str]) -> dict[str, set[str]]:
    """Data files of each target partition; only those folders are listed."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = {}
    for d in dates:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={d}")
        fs = folder.getFileSystem(conf)
        out[d] = {f.getPath().getName() for f in fs.listStatus(folder)} if fs.exists(folder) else set()
    return out


def replace_dates(df: DataFrame, path: str, column: str, dates: list[str]) -> list[str]:
    """Replace the partitions ``dates`` of the table by ``df``'s rows; returns the dates emptied.

    Dynamic overwrite replaces the dates that have rows; a target date whose
    files are still the old ones has none, and its partition is dropped.
    """
    spark = df.sparkSession
    before = _listing(spark, path, column, dates)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    after = _listing(spark, path, column, dates)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    emptied = [d for d in dates if before[d] & after[d]]
    for d in emptied:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={d}")
        folder.getFileSystem(conf).delete(folder, True)
    return emptied


def inside(column: Column, dates: list[str]) -> Column:
    return F.coalesce(column.between(F.lit(dates[0]).cast("date"), F.lit(dates[-1]).cast("date")), F.lit(False))
