"""Distinct buses and trips that roll up over days, by HyperLogLog sketches in the gold tables.

A distinct count of a day cannot be added to another's.  ``fct_daily_sketches`` keeps a sketch beside each day's
exact counts (a few kilobytes at most); unions of sketches give the distinct count of any set of routes and
days without reading the positions again.  The relative standard error is 1.04 / sqrt(2**LG_K); an estimate is
called good within ``BOUND`` = three of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = F.col
LG_K = 12
ERROR = 1.04 / math.sqrt(2**LG_K)
BOUND = 3 * ERROR
SKETCHED = {"unique_vehicles": "bus_id", "unique_trips": "trip_id"}


def fct_daily_sketches(fact_positions: DataFrame) -> DataFrame:
    """One row per route and day: positions, and a sketch of its buses and of its trips."""
    return fact_positions.groupBy("event_date", "route_id").agg(
        F.count(F.lit(1)).alias("total_positions"),
        *[F.hll_sketch_agg(c, F.lit(LG_K)).alias(f"{name}_sketch") for name, c in SKETCHED.items()])


#: Level of a roll-up -> the columns it groups by.
LEVELS = {"network": [], "month": ["month"], "route": ["route_id"], "route_month": ["route_id", "month"]}


def _month() -> Column:
    return F.trunc("event_date", "month")


def distinct_rollup(daily: DataFrame, level: str) -> DataFrame:
    """(route_id, month, total_positions, unique_vehicles, unique_trips) of a level, estimated from the daily sketches."""
    keys = LEVELS[level]
    united = daily.withColumn("month", _month()).groupBy(*keys).agg(
        F.sum("total_positions").cast("long").alias("total_positions"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch")).alias(name) for name in SKETCHED])
    return _named(united, level)


def exact_rollup(fact_positions: DataFrame, level: str) -> DataFrame:
    """The same from the positions."""
    counted = fact_positions.withColumn("month", _month()).groupBy(*LEVELS[level]).agg(
        F.count(F.lit(1)).alias("total_positions"), *[F.countDistinct(c).alias(name) for name, c in SKETCHED.items()])
    return _named(counted, level)


def _named(df: DataFrame, level: str) -> DataFrame:
    missing = {"route_id": "string", "month": "date"}
    columns = [C(c) if c in LEVELS[level] else F.lit(None).cast(t).alias(c) for c, t in missing.items()]
    return df.select(F.lit(level).alias("level"), *columns, "total_positions", *SKETCHED)


def within_bound(estimate: Column, exact: Column, bound: float = BOUND) -> Column:
    """Whether an estimate is within the bound, or within one for small counts."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), bound * exact)
