"""Reader-side measures over the additive gold facts.

Every rate is SUM(numerator) / SUM(denominator) at the requested level,
never an average of ratios, so the same function is right per route, per
corridor or for the whole network.  Inputs are gold tables (already
aggregated to route x day or route x day x hour), so the groupings here
shuffle small data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.functions import exprs as X

C = F.col

# Recommendation and frequency thresholds.
ADD_BUSES_RATE = 0.30
MONITOR_RATE = 0.20
SCHEDULE_REVIEW_PEAK_RATE = 0.20
REDUCE_UNDERUSED_RATE = 0.90
SNOW_DAY_HOURS = 4
HIGH_FREQUENCY = 30
MEDIUM_FREQUENCY = 10
RECOMMENDATIONS = ["Add Buses", "Monitor", "Schedule Review", "Reduce", "Optimal"]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def rates(total: str = "total_positions") -> list[Column]:
    return [X.ratio(C("overcrowded_count"), C(total)).alias("overcrowded_rate"),
            X.ratio(C("underused_count"), C(total)).alias("underused_rate")]


def additive_sums(cols=("total_positions", "overcrowded_count", "underused_count")) -> list[Column]:
    return [F.sum(c).cast("long").alias(c) for c in cols]


def rate_rollup(fleet: DataFrame) -> DataFrame:
    """L1: rates at route x day-type, route, day-type and network level (cube)."""
    g = (fleet.cube("route_id", "day_type")
         .agg(F.grouping_id().cast("int").alias("grouping_level"), *additive_sums()))
    return g.select("route_id", "day_type", "grouping_level", "total_positions", "overcrowded_count",
                    "underused_count", *rates())


def recommendation(over_rate: Column, under_rate: Column, am_rate: Column, pm_rate: Column) -> Column:
    """Fleet label from additive rates; the first matching rule wins."""
    peak_hot = (am_rate >= SCHEDULE_REVIEW_PEAK_RATE) | (pm_rate >= SCHEDULE_REVIEW_PEAK_RATE)
    return (F.when(over_rate >= ADD_BUSES_RATE, F.lit("Add Buses"))
            .when(over_rate >= MONITOR_RATE, F.lit("Monitor"))
            .when(peak_hot, F.lit("Schedule Review"))
            .when(under_rate >= REDUCE_UNDERUSED_RATE, F.lit("Reduce"))
            .otherwise(F.lit("Optimal")))


def _fleet_level(fleet: DataFrame, keys: list[str], more: tuple[Column, ...] = (), names: tuple[str, ...] = ()) -> DataFrame:
    g = fleet.groupBy(*keys).agg(*more,
        *additive_sums(("total_positions", "overcrowded_count", "underused_count", "am_peak_count",
                        "am_peak_overcrowded_count", "pm_peak_count", "pm_peak_overcrowded_count")))
    am = X.ratio(C("am_peak_overcrowded_count"), C("am_peak_count"))
    pm = X.ratio(C("pm_peak_overcrowded_count"), C("pm_peak_count"))
    return g.select(*keys, *names, "total_positions", "overcrowded_count", "underused_count", *rates(),
                    am.alias("am_peak_rate"), pm.alias("pm_peak_rate"),
                    recommendation(X.ratio(C("overcrowded_count"), C("total_positions")),
                                   X.ratio(C("underused_count"), C("total_positions")), am, pm)
                    .alias("recommendation"))


def fleet_recommendation(fleet: DataFrame) -> DataFrame:
    """L2: one recommendation per route over the whole period."""
    return _fleet_level(fleet, ["route_id"])


def recommendation_mix(fleet: DataFrame) -> DataFrame:
    """L3: routes per recommendation and share of the network.

    The share window runs over at most five label rows.
    """
    per = fleet_recommendation(fleet).groupBy("recommendation").agg(F.count(F.lit(1)).alias("routes"))
    return per.withColumn("route_share", X.ratio(C("routes"), F.sum("routes").over(Window.partitionBy())))


def _with_volume_share(per_route: DataFrame) -> DataFrame:
    # One row per route: the network total over this bounded set is cheap.
    total = F.sum("total_positions").over(Window.partitionBy())
    return per_route.withColumn("volume_share", X.ratio(C("total_positions"), total))


def fleet_mirror(fleet: DataFrame, top_n: int = 5, min_volume_share: float = 0.01) -> DataFrame:
    """L4: top-N overcrowded next to top-N underused routes, major routes only.

    Ranked by rate, ties by route_id; the ``top_n`` limit is the report.
    """
    per = _with_volume_share(fleet_recommendation(fleet)).where(C("volume_share") >= min_volume_share)
    sides = []
    for side, rate in (("overcrowded", "overcrowded_rate"), ("underused", "underused_rate")):
        w = Window.orderBy(C(rate).desc(), C("route_id").asc())
        sides.append(per.select(F.lit(side).alias("side"), F.row_number().over(w).alias("rank"),
                                "route_id", C(rate).alias("rate"), "volume_share")
                     .where(C("rank") <= top_n))
    return sides[0].unionByName(sides[1])


def snow_sensitivity(fleet: DataFrame, snow_hours: int = SNOW_DAY_HOURS) -> DataFrame:
    """Overcrowding on snow days (>= snow_hours) vs other days, per route."""
    snow = C("snow_hours") >= snow_hours
    g = fleet.groupBy("route_id").agg(
        F.sum(F.when(snow, C("total_positions")).otherwise(0)).cast("long").alias("snow_positions"),
        F.sum(F.when(snow, C("overcrowded_count")).otherwise(0)).cast("long").alias("snow_overcrowded"),
        F.sum(F.when(~snow, C("total_positions")).otherwise(0)).cast("long").alias("other_positions"),
        F.sum(F.when(~snow, C("overcrowded_count")).otherwise(0)).cast("long").alias("other_overcrowded"),
    )
    s = X.ratio(C("snow_overcrowded"), C("snow_positions"))
    o = X.ratio(C("other_overcrowded"), C("other_positions"))
    return g.select("*", s.alias("snow_rate"), o.alias("other_rate"), ((s - o) * 100).alias("delta_points"))


def weather_weekday(fleet: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Overcrowding rate by dominant weather x day name (pivot)."""
    d = dim_date.select(C("date_key").alias("event_date"), "day_name")
    j = fleet.join(d, "event_date", "left")
    return (j.groupBy("dominant_weather").pivot("day_name", DAY_NAMES)
            .agg(X.ratio(F.sum("overcrowded_count"), F.sum("total_positions"))))


def volume_temperature(daily: DataFrame) -> DataFrame:
    """Network positions per day next to that day's average temperature."""
    return daily.groupBy("event_date").agg(F.sum("total_positions").cast("long").alias("total_positions"),
                                           F.max("avg_temperature_c").alias("avg_temperature_c"))


def hourly_volume(hourly: DataFrame) -> DataFrame:
    """Positions per local hour and the peak hour(s) (24 rows)."""
    g = hourly.groupBy("event_hour").agg(F.sum("total_positions").cast("long").alias("total_positions"))
    top = F.max("total_positions").over(Window.partitionBy())
    return g.withColumn("is_peak_hour", C("total_positions") == top)


def weekday_share(daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Volume, service days, average per day and share, by day of week."""
    d = dim_date.select(C("date_key").alias("event_date"), "day_of_week_num", "day_name", "weekday_label")
    g = (daily.join(d, "event_date", "left")
         .groupBy("day_of_week_num", "day_name", "weekday_label")
         .agg(F.sum("total_positions").cast("long").alias("total_positions"),
              F.countDistinct("event_date").alias("service_days")))
    return g.select("*", X.ratio(C("total_positions"), C("service_days")).alias("avg_positions_per_day"),
                    X.ratio(C("total_positions"), F.sum("total_positions").over(Window.partitionBy()))
                    .alias("volume_share"))


def time_band(hourly: DataFrame) -> DataFrame:
    """Positions and overcrowding per time band."""
    g = hourly.groupBy("time_period").agg(*additive_sums())
    return g.select("*", *rates(),
                    X.ratio(C("total_positions"), F.sum("total_positions").over(Window.partitionBy()))
                    .alias("volume_share"))


def _hour_pivot(df: DataFrame, keys: list[str], agg: Column) -> DataFrame:
    p = df.groupBy(*keys).pivot("event_hour", list(range(24))).agg(agg)
    return p.select(*keys, *[C(str(h)).alias(f"h{h:02d}") for h in range(24)])


def day_hour_heatmap(hourly: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Positions by day of week x hour (7 x 24)."""
    d = dim_date.select(C("date_key").alias("event_date"), "day_of_week_num", "day_name")
    j = hourly.join(d, "event_date", "left")
    return _hour_pivot(j, ["day_of_week_num", "day_name"], F.sum("total_positions").cast("long"))


def route_hour_heatmap(hourly: DataFrame) -> DataFrame:
    """Overcrowding rate by route x hour."""
    return _hour_pivot(hourly, ["route_id"], X.ratio(F.sum("overcrowded_count"), F.sum("total_positions")))


def corridor_rollup(fleet: DataFrame, corridors: DataFrame) -> DataFrame:
    """Fleet measures and recommendation per corridor (route_id -> corridor).

    Routes without a corridor form their own corridor (their route id).
    """
    m = corridors.select("route_id", "corridor")
    f = fleet.join(m, "route_id", "left").withColumn("corridor", F.coalesce(C("corridor"), C("route_id")))
    return _fleet_level(f, ["corridor"], (F.countDistinct("route_id").alias("routes"),), ("routes",))


def service_frequency(route_analytics: DataFrame) -> DataFrame:
    """Trips per stop and its class (High >= 30, Medium >= 10, else Low)."""
    tps = X.ratio(C("total_trips"), C("total_stops"))
    cls = (F.when(tps >= HIGH_FREQUENCY, F.lit("High")).when(tps >= MEDIUM_FREQUENCY, F.lit("Medium"))
           .otherwise(F.lit("Low")))
    return route_analytics.select("route_id", "total_trips", "total_stops", tps.alias("trips_per_stop"),
                                  cls.alias("frequency_class"))


def direction_balance(route_analytics: DataFrame) -> DataFrame:
    """Inbound vs outbound trips per route."""
    return route_analytics.select(
        "route_id", "outbound_trips", "inbound_trips",
        X.ratio(C("inbound_trips"), C("outbound_trips")).alias("inbound_per_outbound"),
        X.ratio(C("outbound_trips"), C("total_trips")).alias("outbound_share"))


def network_kpis(fact_positions: DataFrame) -> DataFrame:
    """Positions, distinct buses, routes and average speed (one row).

    Distinct buses are counted on the fact itself: summing per-day distinct
    counts from gold would count a bus once per day.
    """
    return fact_positions.agg(
        F.count(F.lit(1)).alias("total_positions"),
        F.countDistinct("bus_id").alias("unique_buses"),
        F.countDistinct("route_id").alias("routes"),
        (X.exact_sum_1dp(C("speed")) / F.count("speed")).alias("avg_speed_kmh"),
    )


def active_buses_by_hour(hourly: DataFrame) -> DataFrame:
    """Average active buses per route-day at each hour."""
    return hourly.groupBy("event_hour").agg(F.avg("active_buses").alias("avg_active_buses"))


def relative_period(daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per-route volume in the last 7 days, this month and previous week."""
    d = dim_date.select(C("date_key").alias("event_date"), "date_relative_num", "month_relative_num",
                        "week_relative_num")
    j = daily.join(d, "event_date", "left")
    last7 = C("date_relative_num").between(-6, 0)

    def s(cond, col):
        return F.sum(F.when(cond, C(col)).otherwise(0)).cast("long")
    return j.groupBy("route_id").agg(
        s(last7, "total_positions").alias("positions_last_7d"),
        s(last7, "overcrowded_count").alias("overcrowded_last_7d"),
        s(C("month_relative_num") == 0, "total_positions").alias("positions_this_month"),
        s(C("week_relative_num") == -1, "total_positions").alias("positions_prev_week"),
    )
