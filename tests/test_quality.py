"""The data-quality suite finds seeded violations and reports severities."""

from pyspark.sql import functions as F

from metroflux.operators import quality as Q


def test_declared_rule_counts():
    from collections import Counter
    assert len(Q.RULES) == 104
    assert Counter(r.test for r in Q.RULES) == {"not_null": 73, "accepted_values": 11, "unique": 10,
                                                 "relationships": 10}
    assert sum(r.severity == "warn" for r in Q.RULES) == 5


def test_seeded_violations(spark):
    child = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), (None, 3, "bad"), ("z", 3, "x")],
                                  "k string, v int, cat string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    models = {"child": child, "parent": parent}
    rules = [Q.Rule("child", "v", "not_null"), Q.Rule("child", "k", "unique"),
             Q.Rule("child", "cat", "accepted_values", ("x", "y")),
             Q.Rule("child", "k", "relationships", to="parent", field="k", severity="warn")]
    res = {r.test: r for r in Q.run_rules(models.__getitem__, rules).collect()}
    assert res["not_null"].failures == 1 and res["not_null"].status == "fail"
    assert res["unique"].failures == 1          # 'a' twice, NULL ignored
    assert res["accepted_values"].failures == 1  # 'bad'
    assert res["relationships"].failures == 1 and res["relationships"].status == "warn"  # 'z'


def test_enforce_raises_only_on_errors(spark):
    ok = spark.createDataFrame([("m", "c", "relationships", "warn", 3, "warn")],
                               "model string, column_name string, test string, severity string, failures long, "
                               "status string")
    Q.enforce(ok)
    bad = ok.withColumn("status", F.lit("fail"))
    try:
        Q.enforce(bad)
    except Q.DataQualityError:
        pass
    else:
        raise AssertionError("expected DataQualityError")


def test_cast_failures_report_bad_strings(spark):
    from metroflux.functions import exprs as X
    raw = spark.createDataFrame([("1", "7", "20260101"), ("2", "x", "2026-01-01"), ("3", "", ""), ("4", None, None)],
                                "id string, n string, d string")
    bad = Q.cast_failures(raw, {"n": X.to_int, "d": X.to_date_fmt}, "id", "t").collect()
    assert sorted((r.record_key, r.column_name, r.raw_value) for r in bad) == [("2", "d", "2026-01-01"),
                                                                                 ("2", "n", "x")]
