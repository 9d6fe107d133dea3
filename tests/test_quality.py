from pyspark.sql import functions as F

from marquee.operators import quality


def test_suite_counts(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (9, "z")], "k long, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    out = {r.test_name: (r.failures, r.status) for r in quality.run_suite([
        quality.Check("nn", quality.not_null_failures(child, "v")),
        quality.Check("uq", quality.unique_failures(child, "k")),
        quality.Check("av", quality.accepted_values_failures(child, "v", ["a", "b"])),
        quality.Check("rel", quality.relationship_failures(child, "k", parent, "k")),
        quality.Check("rule", quality.predicate_failures(child, F.col("k") > 100)),
    ]).collect()}
    assert out == {"nn": (1, "fail"), "uq": (1, "fail"), "av": (1, "fail"), "rel": (1, "fail"), "rule": (0, "pass")}


def test_schema_suite_counts_failures(spark):
    from marquee.plans.quality_suite import schema_suite
    m = spark.createDataFrame([(1, "a", True), (1, "zz", None), (None, "zz", False), (3, "yy", True)],
                              "k long, v string, f boolean")
    p = spark.createDataFrame([(1,)], "k long")
    tests = [("m", "k", "not_null", None), ("m", "k", "unique", None), ("m", "v", "accepted_values", ["a"]),
             ("m", "f", "accepted_values", [True, False]), ("m", "k", "relationships", ("p", "k"))]
    got = {r.test_name: r.failures for r in schema_suite({"m": m, "p": p}, tests).collect()}
    assert got == {"not_null_m_k": 1, "unique_m_k": 1, "accepted_values_m_v": 2, "accepted_values_m_f": 0,
                   "relationships_m_k": 1}


def test_count_check_totals(spark):
    from marquee.operators.quality import count_check_totals, expected_count_checks
    one = lambda **m: spark.createDataFrame([tuple(m.values())], ", ".join(f"{k} long" for k in m))
    checks = expected_count_checks({"a": one(x=0, y=3, z=0), "b": one(x=1)})
    assert {r.dataset: (r.passed, r.warned) for r in count_check_totals(checks).collect()} == {"a": (2, 1), "b": (0, 1)}


def test_rules_of_a_model_share_a_scan(spark):
    a = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "k int, v int")
    b = spark.createDataFrame([], "k int")
    out = quality.run_rules({"low": (a, F.col("v") < 6), "gone": (b, F.col("k") > 0), "unknown": (a, ~F.col("v").eqNullSafe(5))})
    assert {r.test_name: (r.failures, r.status) for r in out.collect()} == {"low": (1, "fail"), "gone": (0, "pass"), "unknown": (2, "fail")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + out._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") <= 2
