"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python -m tests.oracle_check /root/testdata/sf0.01 [name ...]
Rows are compared as multisets of canonicalised tuples over name-sorted
columns (the driver's rule), with exact float equality.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v == 0:
            v = 0.0
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return canon(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows(df: pd.DataFrame) -> Counter:
    cols = sorted(df.columns)
    df = df[cols].astype(object).where(pd.notna(df[cols]), None)
    return Counter(tuple(canon(v) for v in r) for r in df.itertuples(index=False, name=None))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_mismatches(sdf_spark, rel) -> list:
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in sdf_spark.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            out.append((f.name, f.dataType.simpleString(), got))
    return out


def compare(spark, con, name, builder, sql, sf_dir):
    t = time.time()
    sdf_spark = builder(spark, sf_dir)
    types_bad = type_mismatches(sdf_spark, con.sql(sql))
    sdf = sdf_spark.toPandas()
    ts = time.time() - t
    ddf = con.execute(sql).df()
    res = {"name": name, "spark_rows": len(sdf), "oracle_rows": len(ddf), "sec": round(ts, 2)}
    if sorted(sdf.columns) != sorted(ddf.columns):
        res["ok"] = False
        res["why"] = f"columns differ: spark-only {sorted(set(sdf.columns)-set(ddf.columns))} oracle-only {sorted(set(ddf.columns)-set(sdf.columns))}"
        return res
    a, b = rows(sdf), rows(ddf)
    res["ok"] = a == b and not types_bad
    if types_bad:
        res["why"] = f"type mismatches (column, spark, duckdb): {types_bad}"
        return res
    if not res["ok"]:
        only_s = list((a - b).elements())[:3]
        only_o = list((b - a).elements())[:3]
        res["why"] = f"cols={sorted(sdf.columns)}\n spark-only={only_s}\n oracle-only={only_o}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from metroflux.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or list(qs):
        if n not in os_:
            print(f"-- {n}: no oracle")
            continue
        try:
            r = compare(spark, con, n, qs[n], os_[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + n, {k: v for k, v in r.items() if k not in ("name", "ok", "why")})
        if not r["ok"]:
            print("   ", r.get("why"))
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
