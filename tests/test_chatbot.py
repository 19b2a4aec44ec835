"""Scalable surrogate keys equal a global row_number; marts basics."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from carepulse.operators import chatbot


def test_dense_keys_match_row_number(spark):
    vals = spark.createDataFrame([(f"v{i % 37:03d}",) for i in range(500)] + [(None,)], "v string")
    got = sorted(tuple(r) for r in chatbot.dense_keys(vals, "v", "k", num_partitions=5).collect())
    ref = (vals.filter(F.col("v").isNotNull()).distinct()
           .select(F.row_number().over(Window.orderBy("v")).alias("k"), "v"))
    assert got == sorted(tuple(r) for r in ref.collect())
    assert [k for k, _ in got] == list(range(1, 38))


def test_top_tenants_tie_break(spark):
    t = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "TENANT_NAME string, TOTAL_CONVERSATIONS long")
    got = [r.TENANT_NAME for r in chatbot.top_tenants(t, 3).collect()]
    assert got == ["c", "a", "b"]


def test_bridge_diff_multiset(spark):
    a = spark.createDataFrame([("t", "x"), ("t", "x"), ("t", "y")], "TRANSCRIPT_ID string, PERSONA string")
    b = spark.createDataFrame([("t", "x"), ("t", "z")], "TRANSCRIPT_ID string, PERSONA string")
    got = sorted(tuple(r) for r in chatbot.bridge_diff(a, b).collect())
    assert got == [("t", "x", "only_rebuilt"), ("t", "y", "only_rebuilt"), ("t", "z", "only_existing")]
