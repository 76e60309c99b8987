"""Data-quality suite: not_null, unique, accepted_values, relationships.

A test "fails" with the number of violating records, with the usual
generic-test semantics:

* not_null          rows where the column is NULL;
* unique            distinct non-NULL values occurring more than once;
* accepted_values   distinct non-NULL values outside the list (NULL passes);
* relationships     child rows whose non-NULL key has no parent row.

Execution: all not_null / accepted_values rules of one model are answered
by ONE aggregate pass over that model; unique is one grouped count per
column; relationships count child rows per key first (map-side partial
aggregate) and anti-join only the distinct keys against the parent.
Results of all rules are a single DataFrame (a union of small aggregates),
so the whole suite is one Spark action.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.functions.exprs import WEATHER_CATEGORIES

C = F.col


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values | relationships
    values: tuple = ()             # accepted_values
    to: str | None = None          # relationships parent model
    field: str | None = None       # relationships parent column
    severity: str = "error"        # error | warn


def _nn(model, *cols):
    return [Rule(model, c, "not_null") for c in cols]


# ---------------------------------------------------------------------------
# The declared assertions of the source project, in file order.
# ---------------------------------------------------------------------------
WEATHER = tuple(WEATHER_CATEGORIES)
RULES: list[Rule] = [
    # stg_weather
    *_nn("stg_weather", "observation_time", "observation_date", "observation_hour", "temperature_c",
         "weather_category"),
    Rule("stg_weather", "weather_category", "accepted_values", WEATHER),
    # stg_routes
    Rule("stg_routes", "route_id", "not_null"), Rule("stg_routes", "route_id", "unique"),
    Rule("stg_routes", "route_type", "not_null"),
    Rule("stg_routes", "route_type", "accepted_values", (1, 3)),
    # stg_stops
    Rule("stg_stops", "stop_id", "not_null"), Rule("stg_stops", "stop_id", "unique"),
    *_nn("stg_stops", "stop_lat", "stop_lon"),
    # stg_vehicle_positions
    *_nn("stg_vehicle_positions", "bus_id", "event_timestamp", "latitude", "longitude", "route_id",
         "event_date", "event_hour"),
    # stg_trips
    Rule("stg_trips", "trip_id", "not_null"), Rule("stg_trips", "trip_id", "unique"),
    *_nn("stg_trips", "route_id", "service_id"),
    # stg_stop_times
    *_nn("stg_stop_times", "trip_id", "stop_id", "stop_sequence"),
    # stg_calendar
    Rule("stg_calendar", "service_id", "not_null"), Rule("stg_calendar", "service_id", "unique"),
    *_nn("stg_calendar", "start_date", "end_date"),
    # stg_calendar_dates
    *_nn("stg_calendar_dates", "service_id", "exception_date", "exception_type"),
    Rule("stg_calendar_dates", "exception_type", "accepted_values", (1, 2)),
    # stg_shapes
    *_nn("stg_shapes", "shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"),
    # stg_agency
    Rule("stg_agency", "agency_id", "not_null"),
    # dim_routes
    Rule("dim_routes", "route_id", "not_null"), Rule("dim_routes", "route_id", "unique"),
    Rule("dim_routes", "route_short_name", "not_null"),
    Rule("dim_routes", "route_type_desc", "not_null"),
    Rule("dim_routes", "route_type_desc", "accepted_values", ("Subway/Metro", "Bus")),
    # dim_stops
    Rule("dim_stops", "stop_id", "not_null"), Rule("dim_stops", "stop_id", "unique"),
    # dim_calendar
    Rule("dim_calendar", "service_id", "not_null"), Rule("dim_calendar", "service_id", "unique"),
    Rule("dim_calendar", "service_pattern", "accepted_values", ("Weekday", "Weekend", "Daily", "Custom")),
    # dim_date
    Rule("dim_date", "date_key", "not_null"), Rule("dim_date", "date_key", "unique"),
    Rule("dim_date", "weekday_label", "not_null"),
    Rule("dim_date", "weekday_label", "accepted_values", ("Weekday", "Weekend")),
    # fact_vehicle_positions
    *_nn("fact_vehicle_positions", "bus_id", "event_timestamp", "route_id"),
    Rule("fact_vehicle_positions", "route_id", "relationships", to="dim_routes", field="route_id",
         severity="warn"),
    # fact_trips
    Rule("fact_trips", "trip_id", "not_null"), Rule("fact_trips", "trip_id", "unique"),
    Rule("fact_trips", "route_id", "not_null"),
    Rule("fact_trips", "route_id", "relationships", to="dim_routes", field="route_id"),
    Rule("fact_trips", "direction_label", "accepted_values", ("Outbound", "Inbound")),
    # fact_stop_times
    *_nn("fact_stop_times", "trip_id", "stop_id"),
    Rule("fact_stop_times", "stop_id", "relationships", to="dim_stops", field="stop_id"),
    # fct_daily_performance
    Rule("fct_daily_performance", "event_date", "not_null"),
    Rule("fct_daily_performance", "event_date", "relationships", to="dim_date", field="date_key"),
    Rule("fct_daily_performance", "route_id", "not_null"),
    Rule("fct_daily_performance", "route_id", "relationships", to="dim_routes", field="route_id",
         severity="warn"),
    *_nn("fct_daily_performance", "total_positions", "overcrowded_count", "dominant_weather"),
    Rule("fct_daily_performance", "dominant_weather", "accepted_values", WEATHER),
    # fct_fleet_optimization
    Rule("fct_fleet_optimization", "event_date", "not_null"),
    Rule("fct_fleet_optimization", "event_date", "relationships", to="dim_date", field="date_key"),
    Rule("fct_fleet_optimization", "route_id", "not_null"),
    Rule("fct_fleet_optimization", "route_id", "relationships", to="dim_routes", field="route_id",
         severity="warn"),
    *_nn("fct_fleet_optimization", "total_positions", "overcrowded_count", "underused_count",
         "dominant_weather"),
    Rule("fct_fleet_optimization", "dominant_weather", "accepted_values", WEATHER),
    Rule("fct_fleet_optimization", "day_type", "not_null"),
    Rule("fct_fleet_optimization", "day_type", "accepted_values", ("Weekday", "Weekend")),
    # fct_occupancy_by_hour
    Rule("fct_occupancy_by_hour", "event_date", "not_null"),
    Rule("fct_occupancy_by_hour", "event_date", "relationships", to="dim_date", field="date_key"),
    Rule("fct_occupancy_by_hour", "route_id", "not_null"),
    Rule("fct_occupancy_by_hour", "route_id", "relationships", to="dim_routes", field="route_id",
         severity="warn"),
    *_nn("fct_occupancy_by_hour", "event_hour", "total_positions", "overcrowded_count", "time_period"),
    Rule("fct_occupancy_by_hour", "time_period", "accepted_values", ("AM Peak", "PM Peak", "Off Peak")),
    # fct_route_analytics
    Rule("fct_route_analytics", "route_id", "not_null"), Rule("fct_route_analytics", "route_id", "unique"),
    Rule("fct_route_analytics", "route_id", "relationships", to="dim_routes", field="route_id",
         severity="warn"),
    *_nn("fct_route_analytics", "total_trips", "total_stops"),
    # obt_positions_wide
    *_nn("obt_positions_wide", "bus_id", "event_timestamp", "route_id", "event_date"),
]

RESULT_COLUMNS = ["model", "column_name", "test", "severity", "failures"]


def _row(rule: Rule, failures: Column) -> Column:
    return F.struct(F.lit(rule.model).alias("model"), F.lit(rule.column).alias("column_name"),
                    F.lit(rule.test).alias("test"), F.lit(rule.severity).alias("severity"),
                    failures.cast("long").alias("failures"))


def _single_pass(model: DataFrame, rules: list[Rule]) -> DataFrame:
    """not_null and accepted_values rules of one model in one aggregate."""
    aggs = []
    for i, r in enumerate(rules):
        c = C(r.column)
        if r.test == "not_null":
            aggs.append(F.sum(F.when(c.isNull(), 1).otherwise(0)).alias(f"r{i}"))
        else:
            bad = F.when(c.isNotNull() & ~c.isin(list(r.values)), c)
            aggs.append(F.count_distinct(bad).alias(f"r{i}"))
    one = model.agg(*aggs)
    return one.select(F.inline(F.array(*[_row(r, F.coalesce(C(f"r{i}"), F.lit(0))) for i, r in enumerate(rules)])))


def _unique(model: DataFrame, rule: Rule) -> DataFrame:
    dup = (model.where(C(rule.column).isNotNull()).groupBy(rule.column).count()
           .where(C("count") > 1))
    return dup.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(_row(rule, C("n")))))


def _orphans_per_key(model: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows per foreign key whose key has no parent.

    Child rows are counted per key first (a partial aggregate on the map
    side), so only distinct keys reach the anti-join: a key carrying a third
    of all rows becomes one row per task, not a hot join partition.
    """
    per_key = model.where(C(fk).isNotNull()).groupBy(C(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("rows"))
    keys = parent.select(C(pk).alias("_pk"))
    return per_key.join(keys, C("_fk") == C("_pk"), "left_anti")


def _relationship(model: DataFrame, parent: DataFrame, rule: Rule) -> DataFrame:
    orphans = _orphans_per_key(model, parent, rule.column, rule.field)
    failures = F.coalesce(F.sum("rows"), F.lit(0))
    return orphans.agg(failures.alias("n")).select(F.inline(F.array(_row(rule, C("n")))))


def _rule_name(rule: Rule) -> str:
    return f"{rule.test}_{rule.column}"


def measures(rules: list[Rule], models) -> dict[str, list[Column]]:
    """Aggregates per model that a write can count on its way: bad rows of not_null and accepted_values rules."""
    out: dict[str, list[Column]] = {}
    for r in rules:
        if r.model in models and r.test in ("not_null", "accepted_values"):
            c = C(r.column)
            bad = c.isNull() if r.test == "not_null" else c.isNotNull() & ~c.isin(list(r.values))
            out.setdefault(r.model, []).append(F.count_if(bad).alias(_rule_name(r)))
    return out


def run_rules(resolve: Callable[[str], DataFrame], rules: list[Rule] | None = None,
              counted: dict[str, dict] | None = None) -> DataFrame:
    """Evaluate rules; ``resolve(name)`` returns a model DataFrame.

    ``counted`` has the values of ``measures`` by model, from the write of the model: its rules are then
    answered without a scan, but for accepted values of which some are bad (the count of distinct ones).

    Output: model, column_name, test, severity, failures, status
    (pass / warn / fail).
    """
    rules = RULES if rules is None else rules
    parts: list[DataFrame] = []
    by_model: dict[str, list[Rule]] = {}
    known: list[tuple] = []
    for r in rules:
        if r.test in ("not_null", "accepted_values"):
            n = (counted or {}).get(r.model, {}).get(_rule_name(r))
            if n is not None and (r.test == "not_null" or n == 0):
                known.append((r.model, r.column, r.test, r.severity, int(n)))
            else:
                by_model.setdefault(r.model, []).append(r)
    if known:
        spark = resolve(known[0][0]).sparkSession
        parts.append(spark.createDataFrame(known, "model string, column_name string, test string, severity string, failures long"))
    for model, rs in by_model.items():
        parts.append(_single_pass(resolve(model), rs))
    for r in rules:
        if r.test == "unique":
            parts.append(_unique(resolve(r.model), r))
        elif r.test == "relationships":
            parts.append(_relationship(resolve(r.model), resolve(r.to), r))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(C("failures") == 0, F.lit("pass"))
              .when(C("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return out.withColumn("status", status)


class DataQualityError(RuntimeError):
    pass


def enforce(results: DataFrame) -> DataFrame:
    """Raise if any error-severity rule failed; warnings only report.

    Collects the (bounded, one row per rule) result table to the driver.
    """
    failed = results.where(C("status") == "fail").select("model", "column_name", "test", "failures").collect()
    if failed:
        raise DataQualityError("; ".join(f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in failed))
    return results


def orphan_keys(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Which child keys have no parent, and how many rows carry each (K6)."""
    return _orphans_per_key(child, parent, fk, pk).select(C("_fk").alias(fk), "rows")


def cast_failures(raw: DataFrame, casts: dict, key: str, source_table: str) -> DataFrame:
    """Values present in a bronze table that its staging cast turns into NULL.

    ``casts`` maps column -> the staging cast (Column -> Column).  One scan
    of the raw table: every row carries an array of per-column checks that
    ``inline`` unnests, and only failed checks are kept (no join back to
    the staged rows, no shuffle).  Output rows are quarantine candidates:
    source_table, record_key, column_name, raw_value.
    """
    checks = F.array(*[
        F.struct(F.lit(col).alias("column_name"), C(col).cast("string").alias("raw_value"),
                 (C(col).isNotNull() & (F.trim(C(col)) != "") & fn(C(col)).isNull()).alias("failed"))
        for col, fn in casts.items()])
    return (raw.select(F.lit(source_table).alias("source_table"), C(key).cast("string").alias("record_key"),
                       F.inline(checks))
            .where(C("failed")).drop("failed"))


def non_finite(raw: DataFrame, column: str, key: str, source_table: str) -> DataFrame:
    """NaN and infinite values of a double column, which staging turns into NULL; columns of ``cast_failures``."""
    value = C(column)
    name = F.when(F.isnan(value), "NaN").when(value > 0, "Infinity").otherwise("-Infinity")
    return (raw.where(value.isNotNull() & ~F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False)))
            .select(F.lit(source_table).alias("source_table"), C(key).cast("string").alias("record_key"),
                    F.lit(column).alias("column_name"), name.alias("raw_value")))


def repeated_hours(stg_weather: DataFrame) -> DataFrame:
    """Hours with several weather observations: each of their positions stands that often in the wide table."""
    return (stg_weather.groupBy("observation_date", "observation_hour").agg(F.count(F.lit(1)).alias("observations"))
            .where(C("observations") > 1))


def epoch_times(bronze_positions: DataFrame) -> DataFrame:
    """Positions whose feed gave no time, which reads as the epoch, per landed file: they keep it and fall on its date."""
    return (bronze_positions.where(C("event_timestamp_raw") == 0).groupBy(C("ingestion_file").alias("source_file"))
            .agg(F.count(F.lit(1)).alias("positions")))


# ---------------------------------------------------------------------------
# Oracle text of the same rules (plain SQL per rule).
# ---------------------------------------------------------------------------

def _sql_lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def rule_sql(r: Rule) -> str:
    head = (f"SELECT '{r.model}' AS model, '{r.column}' AS column_name, '{r.test}' AS test, "
            f"'{r.severity}' AS severity, CAST(COUNT(*) AS BIGINT) AS failures")
    if r.test == "not_null":
        return f"{head} FROM {r.model} WHERE {r.column} IS NULL"
    if r.test == "unique":
        return (f"{head} FROM (SELECT {r.column} FROM {r.model} WHERE {r.column} IS NOT NULL "
                f"GROUP BY {r.column} HAVING COUNT(*) > 1) d")
    if r.test == "accepted_values":
        vals = ", ".join(_sql_lit(v) for v in r.values)
        return (f"{head} FROM (SELECT {r.column} FROM {r.model} WHERE {r.column} IS NOT NULL "
                f"AND {r.column} NOT IN ({vals}) GROUP BY {r.column}) d")
    return (f"{head} FROM {r.model} c LEFT JOIN {r.to} p ON c.{r.column} = p.{r.field} "
            f"WHERE c.{r.column} IS NOT NULL AND p.{r.field} IS NULL")


def rules_sql(rules: list[Rule]) -> str:
    body = "\nUNION ALL\n".join(rule_sql(r) for r in rules)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
            f"ELSE 'fail' END AS status FROM (\n{body}\n) r")
