"""metroflux: a Spark-native transit analytics warehouse.

Bronze vehicle positions, static schedules and hourly weather become typed
staging frames, a star schema and additive gold facts, all expressed with the
public DataFrame API so Catalyst plans every step.

Typical use::

    from metroflux import get_session, Warehouse, materialize
    from metroflux.sources.bronze import bronze_sources

    spark = get_session()
    wh = Warehouse(spark, bronze_sources(spark, "/lake/bronze"))
    materialize(wh, "/lake/warehouse")
"""

from metroflux.plans.warehouse import Warehouse, materialize, refresh_dates
from metroflux.session import checkpoint_dir, get_session, sizing

__all__ = ["Warehouse", "checkpoint_dir", "get_session", "materialize", "refresh_dates", "sizing"]
