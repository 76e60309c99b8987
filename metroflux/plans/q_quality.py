"""Registered data-quality queries (K1-K7)."""

from __future__ import annotations

import uuid

from metroflux.operators import quality, staging
from metroflux.plans import oracle
from metroflux.plans.registry import _wh, register
from metroflux.plans.warehouse import GOLD_MODELS, SILVER_MODELS, materialize
from metroflux.session import checkpoint_dir


def _subset(test: str):
    return [r for r in quality.RULES if r.test == test]


def _suite(spark, sf_dir, rules):
    """Build the fact and gold models the rules touch once, then test them.

    Like a build-then-test run: facts and gold models are written once, and the
    write counts the bad rows of its not_null and accepted_values rules on its way
    (``quality.measures``); the other rules scan the written table instead of
    recomputing the model and all its upstream shuffles from bronze.  Staging
    models stay views and the small dimensions are rebuilt where used.
    """
    needed = {r.model for r in rules} | {r.to for r in rules if r.to}
    # Facts, gold and the date dimension (its window comes from a scan of all
    # positions) are expensive and read by several rules; the schedule
    # dimensions are small and cheap to rebuild.
    cheap = {"dim_routes", "dim_stops", "dim_calendar"}
    tables = [m for m in SILVER_MODELS + GOLD_MODELS if m in needed and m not in cheap]
    wh = _wh(spark, sf_dir)
    counted: dict[str, dict] = {}
    if tables:
        materialize(wh, f"{checkpoint_dir(spark).rstrip('/')}/dq-{uuid.uuid4().hex}", tables,
                    measures=quality.measures(rules, tables), found=counted)
    return quality.run_rules(wh.model, rules, counted)


@register("dq_not_null", oracle.query(quality.rules_sql(_subset("not_null"))))
def q_dq_not_null(spark, sf_dir):
    """K1: every declared not_null assertion (one aggregate pass per model)."""
    return _suite(spark, sf_dir, _subset("not_null"))


@register("dq_unique", oracle.query(quality.rules_sql(_subset("unique"))))
def q_dq_unique(spark, sf_dir):
    """K2: every declared unique assertion (duplicated non-NULL values)."""
    return _suite(spark, sf_dir, _subset("unique"))


@register("dq_accepted_values", oracle.query(quality.rules_sql(_subset("accepted_values"))))
def q_dq_accepted_values(spark, sf_dir):
    """K3: every declared accepted_values assertion (distinct bad values)."""
    return _suite(spark, sf_dir, _subset("accepted_values"))


@register("dq_relationships", oracle.query(quality.rules_sql(_subset("relationships"))))
def q_dq_relationships(spark, sf_dir):
    """K4/K5: every declared relationships assertion, warn or error severity."""
    return _suite(spark, sf_dir, _subset("relationships"))


@register("dq_orphan_routes", oracle.query("""
SELECT p.route_id, CAST(COUNT(*) AS BIGINT) AS rows
FROM fact_vehicle_positions p LEFT JOIN dim_routes r ON p.route_id = r.route_id
WHERE p.route_id IS NOT NULL AND r.route_id IS NULL
GROUP BY p.route_id"""))
def q_dq_orphan_routes(spark, sf_dir):
    """K6: route ids of deduplicated positions missing from dim_routes, with row counts."""
    wh = _wh(spark, sf_dir)
    return quality.orphan_keys(wh.fact_vehicle_positions, wh.dim_routes, "route_id", "route_id")


@register("dq_suite", oracle.query(quality.rules_sql(quality.RULES)))
def q_dq_suite(spark, sf_dir):
    """K7: the full 104-assertion suite as one result table with status."""
    return _suite(spark, sf_dir, quality.RULES)


_DUCK_CAST = {"to_int": "TRY_CAST({c} AS INTEGER)", "to_double": "TRY_CAST({c} AS DOUBLE)",
              "to_ts": "TRY_CAST({c} AS TIMESTAMP)", "to_date_fmt": "try_strptime({c}, '%Y%m%d')"}


def _cast_failures_sql() -> str:
    parts = []
    for table, (key, casts) in staging.staging_casts().items():
        for col, fn in casts.items():
            cast = _DUCK_CAST[fn.__name__].format(c=col)
            parts.append(f"SELECT '{table}' AS source_table, CAST({key} AS VARCHAR) AS record_key, "
                         f"'{col}' AS column_name, CAST({col} AS VARCHAR) AS raw_value FROM {table} "
                         f"WHERE {col} IS NOT NULL AND trim({col}) <> '' AND {cast} IS NULL")
    parts.append("SELECT 'vehicle_positions' AS source_table, bus_id AS record_key, 'speed' AS column_name, "
                 "CASE WHEN isnan(speed) THEN 'NaN' WHEN speed > 0 THEN 'Infinity' ELSE '-Infinity' END AS raw_value "
                 "FROM vehicle_positions WHERE isnan(speed) OR isinf(speed)")
    return "\nUNION ALL\n".join(parts)


@register("dq_cast_failures", oracle.query(_cast_failures_sql()))
def q_dq_cast_failures(spark, sf_dir):
    """Bronze values the staging casts would turn into NULL, for the quarantine."""
    wh = _wh(spark, sf_dir)
    out = None
    for table, (key, casts) in staging.staging_casts().items():
        part = quality.cast_failures(wh.bronze[table], casts, key, table)
        out = part if out is None else out.unionByName(part)
    return out.unionByName(quality.non_finite(wh.bronze["vehicle_positions"], "speed", "bus_id", "vehicle_positions"))


@register("dq_repeated_weather_hours", oracle.query("""
SELECT observation_date, observation_hour, COUNT(*) AS observations FROM stg_weather
GROUP BY observation_date, observation_hour HAVING COUNT(*) > 1"""))
def q_dq_repeated_weather_hours(spark, sf_dir):
    """Weather hours that would fan out the wide table."""
    return quality.repeated_hours(_wh(spark, sf_dir).stg_weather)
