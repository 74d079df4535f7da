"""JSON of a table in one row group is walked by many tasks; a guard's walk gives only denied keys."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import nested as N
from ledgerloom.plans import nested_plans

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("made", [nested_plans._docs, nested_plans._nodes])
def test_rows_of_one_file_are_dealt_out(spark, made):
    assert spark.read.parquet(f"{SF}/customer.parquet").rdd.getNumPartitions() == 1
    tasks = made(spark, SF).groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("c_custkey").alias("n")).collect()
    assert len(tasks) > 4 and max(r.n for r in tasks) < 50


def test_walk_of_named_keys_only(spark):
    text = '{"a": {"K-pi": 1, "kpis": 2, "x": [{"KPI": [1, {"k_p_i": null}]}]}, "Ключ": 3, "": 4}'
    df = spark.createDataFrame([(1, text), (2, None), (3, "{oops"), (4, '{"b": 1}')], "k int, j string")
    got = N.walk_rows(df, ["k"], "j", named=["K.P.I"])
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "a.K-pi", "K-pi", "number", "1"), (1, "a.x[0].KPI", "KPI", "array", None), (1, "a.x[0].KPI[1].k_p_i", "k_p_i", "null", None)]
    whole = N.forbidden_fields(N.walk_rows(df, [], "j"), ["K.P.I"]).collect()
    assert sorted(whole) == sorted(N.forbidden_fields(N.walk_rows(df, [], "j", named=["K.P.I"]), ["K.P.I"]).collect()) and len(whole) == 3
