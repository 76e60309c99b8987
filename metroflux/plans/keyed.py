"""Gold tables refreshed by key: a late row rewrites the rows of its keys, not its whole dates.

A table is a set of versions.  A refresh names the changed keys, recomputes the model for them only (semi-joins with the
key table; bronze is read for the days around them) and writes one more version, in which a key without rows has a
tombstone.  Reading takes each key's highest version.  ``compact`` folds the versions into one.  A version is written
under its number with overwrite, so a refresh that was cut off is simply run again.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.functions.exprs import LOCAL_TZ
from metroflux.operators import gold, staging
from metroflux.plans.warehouse import Warehouse

C = F.col
GONE = "_gone"


class KeyedModel(NamedTuple):
    """Keys of a model, and how it is built from a warehouse for the rows of some of them."""

    keys: tuple[str, ...]
    build: Callable[[Warehouse, Callable[[DataFrame], DataFrame]], DataFrame]
    deduplicated: bool


KEYED_MODELS = {
    "fct_occupancy_by_hour": KeyedModel(("route_id", "event_date", "event_hour"),
                                        lambda wh, only: gold.fct_occupancy_by_hour(only(wh.stg_vehicle_positions)), False),
    "fct_fleet_optimization": KeyedModel(("route_id", "event_date"),
                                         lambda wh, only: gold.fct_fleet_optimization(only(wh.stg_vehicle_positions), wh.stg_weather), False),
    "fct_daily_performance": KeyedModel(("route_id", "event_date"),
                                        lambda wh, only: gold.fct_daily_performance(only(wh.fact_vehicle_positions), wh.stg_weather), True),
}


def same(left: DataFrame, right: DataFrame, keys) -> Column:
    """Equality of keys in which NULL equals NULL."""
    return functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def changed_keys(changed: DataFrame, model: str, stg_positions: DataFrame | None = None) -> DataFrame:
    """The keys of ``changed`` staging rows, those added, withdrawn or corrected.

    For deduplicated models also the keys of all rows that share a bus and time with them (``stg_positions``):
    which of those rows counts may change.
    """
    spec = KEYED_MODELS[model]
    keys = changed.select(*spec.keys)
    if spec.deduplicated and stg_positions is not None:
        times = changed.select("bus_id", "event_timestamp").distinct()
        keys = keys.unionByName(stg_positions.join(times, ["bus_id", "event_timestamp"], "left_semi").select(*spec.keys))
    return keys.distinct()


def _around(keys: DataFrame) -> tuple[list[str], list[str]]:
    """The keys' local dates (a row a day) and the UTC dates that hold their rows."""
    days = sorted(r["event_date"] for r in keys.select("event_date").distinct().collect() if r["event_date"] is not None)
    utc = sorted({d + dt.timedelta(days=k) for d in days for k in (0, 1)})
    return [str(d) for d in days], [str(d) for d in utc]


def days_of(bronze: Mapping[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    """Bronze with only the positions whose day can hold rows of the keys (partition pruning)."""
    _, utc = _around(keys)
    positions = bronze["vehicle_positions"]
    # A Mapping may build its tables on access; only the positions are replaced.
    return _Narrowed(bronze, positions.where(C("ingestion_date").isin([F.lit(d).cast("date") for d in utc])))


class _Narrowed(dict):
    def __init__(self, bronze: Mapping[str, DataFrame], positions: DataFrame):
        super().__init__(vehicle_positions=positions)
        self.bronze = bronze

    def __missing__(self, name: str) -> DataFrame:
        return self.bronze[name]


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, model: str):
        self.spark, self.path, self.model, self.keys = spark, path.rstrip("/"), model, KEYED_MODELS[model].keys

    def _version(self, n: int) -> str:
        return f"{self.path}/version={n}"

    def create(self, wh: Warehouse) -> None:
        """Version 0: the whole model."""
        rows = KEYED_MODELS[self.model].build(wh, lambda df: df)
        rows.withColumn(GONE, F.lit(False)).write.mode("overwrite").parquet(self._version(0))

    def _all(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/version=*")

    def refresh(self, bronze: Mapping[str, DataFrame], keys: DataFrame, version: int, tz: str = LOCAL_TZ) -> None:
        """Write ``version`` with the present rows of the keys, and tombstones for those that have none."""
        wh = Warehouse(self.spark, days_of(bronze, keys), tz=tz)
        keys = keys.select(*self.keys).distinct()

        def only(df: DataFrame) -> DataFrame:
            return df.join(keys, same(df, keys, self.keys), "left_semi")

        rows = KEYED_MODELS[self.model].build(wh, only)
        gone = keys.join(rows, same(keys, rows, self.keys), "left_anti")
        (rows.withColumn(GONE, F.lit(False)).unionByName(gone.withColumn(GONE, F.lit(True)), allowMissingColumns=True)
         .write.mode("overwrite").parquet(self._version(version)))

    def read(self) -> DataFrame:
        """Each key's rows of its highest version."""
        rows = self._all()
        names = [c for c in rows.columns if c not in (*self.keys, "version")]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*names), "version").alias("_row"))
        return last.where(~C(f"_row.{GONE}")).select(*self.keys, *[C(f"_row.{c}").alias(c) for c in names if c != GONE])

    def compact(self, path: str) -> KeyedTable:
        """The table's present rows as version 0 of a table at ``path``."""
        self.read().withColumn(GONE, F.lit(False)).write.mode("overwrite").parquet(f"{path.rstrip('/')}/version=0")
        return KeyedTable(self.spark, path, self.model)


def staged_positions(positions: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Staging rows of some bronze positions, from which ``changed_keys`` takes the keys."""
    return staging.stg_vehicle_positions(positions, tz)
