"""Registered BI measures (L1-L18) over the gold facts, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from metroflux.operators import metrics as M
from metroflux.plans import oracle
from metroflux.plans.registry import _wh, register

C = F.col


def rat(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / ({b}) END"


def fleet_level_sql(keys: str, source: str) -> str:
    return f"""
SELECT {keys}, total_positions, overcrowded_count, underused_count,
  {rat('overcrowded_count', 'total_positions')} AS overcrowded_rate,
  {rat('underused_count', 'total_positions')} AS underused_rate,
  am AS am_peak_rate, pm AS pm_peak_rate,
  CASE WHEN {rat('overcrowded_count', 'total_positions')} >= 0.30e0 THEN 'Add Buses'
       WHEN {rat('overcrowded_count', 'total_positions')} >= 0.20e0 THEN 'Monitor'
       WHEN am >= 0.20e0 OR pm >= 0.20e0 THEN 'Schedule Review'
       WHEN {rat('underused_count', 'total_positions')} >= 0.90e0 THEN 'Reduce'
       ELSE 'Optimal' END AS recommendation
FROM (SELECT *, {rat('am_peak_overcrowded_count', 'am_peak_count')} AS am,
        {rat('pm_peak_overcrowded_count', 'pm_peak_count')} AS pm
      FROM (SELECT {keys},
              CAST(SUM(total_positions) AS BIGINT) AS total_positions,
              CAST(SUM(overcrowded_count) AS BIGINT) AS overcrowded_count,
              CAST(SUM(underused_count) AS BIGINT) AS underused_count,
              CAST(SUM(am_peak_count) AS BIGINT) AS am_peak_count,
              CAST(SUM(am_peak_overcrowded_count) AS BIGINT) AS am_peak_overcrowded_count,
              CAST(SUM(pm_peak_count) AS BIGINT) AS pm_peak_count,
              CAST(SUM(pm_peak_overcrowded_count) AS BIGINT) AS pm_peak_overcrowded_count
            FROM {source} GROUP BY {keys}) s) r"""


EXTRA = {
    "fleet_route": fleet_level_sql("route_id", "fct_fleet_optimization"),
    "corridor_map": """
SELECT route_id, upper(split_part(route_long_name, ' ', 1)) AS corridor FROM dim_routes""",
    "fleet_corridor_src": """
SELECT f.*, coalesce(m.corridor, f.route_id) AS corridor
FROM fct_fleet_optimization f LEFT JOIN corridor_map m ON f.route_id = m.route_id""",
}
EXTRA["fleet_corridor"] = fleet_level_sql("corridor", "fleet_corridor_src")


def q(select: str) -> str:
    return oracle.query(select, EXTRA)


def hour_cols(expr) -> str:
    return ",\n  ".join(f"{expr(h)} AS h{h:02d}" for h in range(24))


@register("bi_rate_rollup", q(f"""
SELECT route_id, day_type, grouping_level, total_positions, overcrowded_count, underused_count,
  {rat('overcrowded_count', 'total_positions')} AS overcrowded_rate,
  {rat('underused_count', 'total_positions')} AS underused_rate
FROM (SELECT route_id, day_type, CAST(GROUPING_ID(route_id, day_type) AS INTEGER) AS grouping_level,
        CAST(SUM(total_positions) AS BIGINT) AS total_positions,
        CAST(SUM(overcrowded_count) AS BIGINT) AS overcrowded_count,
        CAST(SUM(underused_count) AS BIGINT) AS underused_count
      FROM fct_fleet_optimization GROUP BY CUBE (route_id, day_type)) c"""))
def q_bi_rate_rollup(spark, sf_dir):
    """L1: overcrowded/underused rates at every level of route x day type (cube)."""
    return M.rate_rollup(_wh(spark, sf_dir).fct_fleet_optimization)


@register("bi_fleet_recommendation", q("SELECT * FROM fleet_route"))
def q_bi_fleet_recommendation(spark, sf_dir):
    """L2: fleet recommendation per route from additive counts."""
    return M.fleet_recommendation(_wh(spark, sf_dir).fct_fleet_optimization)


@register("bi_recommendation_mix", q("""
SELECT recommendation, COUNT(*) AS routes,
  CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS route_share
FROM fleet_route GROUP BY recommendation"""))
def q_bi_recommendation_mix(spark, sf_dir):
    """L3: number of routes per recommendation and share of the network."""
    return M.recommendation_mix(_wh(spark, sf_dir).fct_fleet_optimization)


@register("bi_fleet_mirror", q(f"""
SELECT side, rank, route_id, rate, volume_share FROM (
  SELECT 'overcrowded' AS side,
    CAST(row_number() OVER (ORDER BY overcrowded_rate DESC NULLS LAST, route_id ASC) AS INTEGER) AS rank,
    route_id, overcrowded_rate AS rate, volume_share
  FROM (SELECT *, {rat('total_positions', 'SUM(total_positions) OVER ()')} AS volume_share FROM fleet_route) p
  WHERE volume_share >= 0.01e0
  UNION ALL
  SELECT 'underused' AS side,
    CAST(row_number() OVER (ORDER BY underused_rate DESC NULLS LAST, route_id ASC) AS INTEGER) AS rank,
    route_id, underused_rate AS rate, volume_share
  FROM (SELECT *, {rat('total_positions', 'SUM(total_positions) OVER ()')} AS volume_share FROM fleet_route) p
  WHERE volume_share >= 0.01e0) m
WHERE rank <= 5"""))
def q_bi_fleet_mirror(spark, sf_dir):
    """L4: top-5 overcrowded vs top-5 underused routes among routes with >= 1% of volume."""
    return M.fleet_mirror(_wh(spark, sf_dir).fct_fleet_optimization)


@register("bi_snow_sensitivity", q(f"""
SELECT route_id, snow_positions, snow_overcrowded, other_positions, other_overcrowded,
  s AS snow_rate, o AS other_rate, (s - o) * 100 AS delta_points
FROM (SELECT *, {rat('snow_overcrowded', 'snow_positions')} AS s, {rat('other_overcrowded', 'other_positions')} AS o
      FROM (SELECT route_id,
              CAST(SUM(CASE WHEN snow_hours >= 4 THEN total_positions ELSE 0 END) AS BIGINT) AS snow_positions,
              CAST(SUM(CASE WHEN snow_hours >= 4 THEN overcrowded_count ELSE 0 END) AS BIGINT) AS snow_overcrowded,
              CAST(SUM(CASE WHEN NOT (snow_hours >= 4) THEN total_positions ELSE 0 END) AS BIGINT) AS other_positions,
              CAST(SUM(CASE WHEN NOT (snow_hours >= 4) THEN overcrowded_count ELSE 0 END) AS BIGINT)
                AS other_overcrowded
            FROM fct_fleet_optimization GROUP BY route_id) g) r"""))
def q_bi_snow_sensitivity(spark, sf_dir):
    """Overcrowding rate on days with >= 4 snow hours vs other days, per route."""
    return M.snow_sensitivity(_wh(spark, sf_dir).fct_fleet_optimization)


_days = ",\n  ".join(
    f"{rat(f'SUM(CASE WHEN d.day_name = {chr(39)}{n}{chr(39)} THEN f.overcrowded_count END)', f'SUM(CASE WHEN d.day_name = {chr(39)}{n}{chr(39)} THEN f.total_positions END)')} AS {n}"
    for n in M.DAY_NAMES)


@register("bi_weather_weekday", q(f"""
SELECT f.dominant_weather,
  {_days}
FROM fct_fleet_optimization f LEFT JOIN dim_date d ON f.event_date = d.date_key
GROUP BY f.dominant_weather"""))
def q_bi_weather_weekday(spark, sf_dir):
    """Overcrowding rate matrix, dominant weather x day name."""
    wh = _wh(spark, sf_dir)
    return M.weather_weekday(wh.fct_fleet_optimization, wh.dim_date)


@register("bi_volume_temperature", q("""
SELECT event_date, CAST(SUM(total_positions) AS BIGINT) AS total_positions,
  MAX(avg_temperature_c) AS avg_temperature_c
FROM fct_daily_performance GROUP BY event_date"""))
def q_bi_volume_temperature(spark, sf_dir):
    """Daily network volume with the day's average temperature."""
    return M.volume_temperature(_wh(spark, sf_dir).fct_daily_performance)


@register("bi_hourly_volume", q("""
SELECT event_hour, total_positions, total_positions = MAX(total_positions) OVER () AS is_peak_hour
FROM (SELECT event_hour, CAST(SUM(total_positions) AS BIGINT) AS total_positions
      FROM fct_occupancy_by_hour GROUP BY event_hour) h"""))
def q_bi_hourly_volume(spark, sf_dir):
    """Positions per hour of day with the peak hour flagged."""
    return M.hourly_volume(_wh(spark, sf_dir).fct_occupancy_by_hour)


@register("bi_weekday_share", q(f"""
SELECT day_of_week_num, day_name, weekday_label, total_positions, service_days,
  {rat('total_positions', 'service_days')} AS avg_positions_per_day,
  {rat('total_positions', 'SUM(total_positions) OVER ()')} AS volume_share
FROM (SELECT d.day_of_week_num, d.day_name, d.weekday_label,
        CAST(SUM(f.total_positions) AS BIGINT) AS total_positions, COUNT(DISTINCT f.event_date) AS service_days
      FROM fct_daily_performance f LEFT JOIN dim_date d ON f.event_date = d.date_key
      GROUP BY d.day_of_week_num, d.day_name, d.weekday_label) g"""))
def q_bi_weekday_share(spark, sf_dir):
    """Volume share and average per service day, by day of week."""
    wh = _wh(spark, sf_dir)
    return M.weekday_share(wh.fct_daily_performance, wh.dim_date)


@register("bi_time_band", q(f"""
SELECT time_period, total_positions, overcrowded_count, underused_count,
  {rat('overcrowded_count', 'total_positions')} AS overcrowded_rate,
  {rat('underused_count', 'total_positions')} AS underused_rate,
  {rat('total_positions', 'SUM(total_positions) OVER ()')} AS volume_share
FROM (SELECT time_period, CAST(SUM(total_positions) AS BIGINT) AS total_positions,
        CAST(SUM(overcrowded_count) AS BIGINT) AS overcrowded_count,
        CAST(SUM(underused_count) AS BIGINT) AS underused_count
      FROM fct_occupancy_by_hour GROUP BY time_period) g"""))
def q_bi_time_band(spark, sf_dir):
    """Totals, rates and volume share per time band."""
    return M.time_band(_wh(spark, sf_dir).fct_occupancy_by_hour)


@register("bi_day_hour_heatmap", q(f"""
SELECT d.day_of_week_num, d.day_name,
  {hour_cols(lambda h: f'CAST(SUM(CASE WHEN f.event_hour = {h} THEN f.total_positions END) AS BIGINT)')}
FROM fct_occupancy_by_hour f LEFT JOIN dim_date d ON f.event_date = d.date_key
GROUP BY d.day_of_week_num, d.day_name"""))
def q_bi_day_hour_heatmap(spark, sf_dir):
    """Positions heatmap, day of week x hour."""
    wh = _wh(spark, sf_dir)
    return M.day_hour_heatmap(wh.fct_occupancy_by_hour, wh.dim_date)


@register("bi_route_hour_heatmap", q(f"""
SELECT route_id,
  {hour_cols(lambda h: rat(f'SUM(CASE WHEN event_hour = {h} THEN overcrowded_count END)', f'SUM(CASE WHEN event_hour = {h} THEN total_positions END)'))}
FROM fct_occupancy_by_hour GROUP BY route_id"""))
def q_bi_route_hour_heatmap(spark, sf_dir):
    """Overcrowding-rate heatmap, route x hour."""
    return M.route_hour_heatmap(_wh(spark, sf_dir).fct_occupancy_by_hour)


@register("bi_corridor_rollup", q("""
SELECT c.*, r.routes FROM fleet_corridor c
JOIN (SELECT corridor, COUNT(DISTINCT route_id) AS routes FROM fleet_corridor_src GROUP BY corridor) r
  ON c.corridor = r.corridor"""))
def q_bi_corridor_rollup(spark, sf_dir):
    """Fleet measures and recommendation per corridor.

    Stand-in corridor map for the driver data: routes whose long name
    starts with the same word share a corridor.
    """
    wh = _wh(spark, sf_dir)
    corridors = wh.dim_routes.select(
        "route_id", F.upper(F.split(C("route_long_name"), " ").getItem(0)).alias("corridor"))
    return M.corridor_rollup(wh.fct_fleet_optimization, corridors)


@register("bi_service_frequency", q(f"""
SELECT route_id, total_trips, total_stops, {rat('total_trips', 'total_stops')} AS trips_per_stop,
  CASE WHEN {rat('total_trips', 'total_stops')} >= 30 THEN 'High'
       WHEN {rat('total_trips', 'total_stops')} >= 10 THEN 'Medium' ELSE 'Low' END AS frequency_class
FROM fct_route_analytics"""))
def q_bi_service_frequency(spark, sf_dir):
    """Trips per stop and frequency class per route."""
    return M.service_frequency(_wh(spark, sf_dir).fct_route_analytics)


@register("bi_direction_balance", q(f"""
SELECT route_id, outbound_trips, inbound_trips,
  {rat('inbound_trips', 'outbound_trips')} AS inbound_per_outbound,
  {rat('outbound_trips', 'total_trips')} AS outbound_share
FROM fct_route_analytics"""))
def q_bi_direction_balance(spark, sf_dir):
    """Inbound vs outbound balance per route."""
    return M.direction_balance(_wh(spark, sf_dir).fct_route_analytics)


@register("bi_network_kpis", q("""
SELECT COUNT(*) AS total_positions, COUNT(DISTINCT bus_id) AS unique_buses,
  COUNT(DISTINCT route_id) AS routes, round(SUM(speed), 1) / COUNT(speed) AS avg_speed_kmh
FROM fact_vehicle_positions"""))
def q_bi_network_kpis(spark, sf_dir):
    """Network totals, distinct buses and average speed."""
    return M.network_kpis(_wh(spark, sf_dir).fact_vehicle_positions)


@register("bi_active_buses_by_hour", q("""
SELECT event_hour, AVG(active_buses) AS avg_active_buses FROM fct_occupancy_by_hour GROUP BY event_hour"""))
def q_bi_active_buses_by_hour(spark, sf_dir):
    """Average active buses per hour of day."""
    return M.active_buses_by_hour(_wh(spark, sf_dir).fct_occupancy_by_hour)


@register("bi_relative_period", q("""
SELECT f.route_id,
  CAST(SUM(CASE WHEN d.date_relative_num BETWEEN -6 AND 0 THEN f.total_positions ELSE 0 END) AS BIGINT)
    AS positions_last_7d,
  CAST(SUM(CASE WHEN d.date_relative_num BETWEEN -6 AND 0 THEN f.overcrowded_count ELSE 0 END) AS BIGINT)
    AS overcrowded_last_7d,
  CAST(SUM(CASE WHEN d.month_relative_num = 0 THEN f.total_positions ELSE 0 END) AS BIGINT)
    AS positions_this_month,
  CAST(SUM(CASE WHEN d.week_relative_num = -1 THEN f.total_positions ELSE 0 END) AS BIGINT)
    AS positions_prev_week
FROM fct_daily_performance f LEFT JOIN dim_date d ON f.event_date = d.date_key
GROUP BY f.route_id"""))
def q_bi_relative_period(spark, sf_dir):
    """Per-route volume in relative periods of the date dimension."""
    wh = _wh(spark, sf_dir)
    return M.relative_period(wh.fct_daily_performance, wh.dim_date)
