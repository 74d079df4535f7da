"""Lines of one file that agree in number, teams and goals, but are of different seasons."""

from pyspark.sql import functions as F

from ledgerloom.plans import ledger_plans


def test_cutoff_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    # file 1 keeps one line, all of its 40 lines tie
    rows = spark.range(40).select(
        F.lit(1).cast("long").alias("l_orderkey"), F.lit(3).cast("long").alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"), F.lit(2).alias("l_linenumber"),
        F.lit(4.0).alias("l_quantity"), F.lit("A").alias("l_returnflag"), F.make_date(F.lit(1990) + F.col("id").cast("int"), F.lit(1), F.lit(1)).cast("timestamp").alias("l_shipdate"))
    for name, order in (("up", F.asc("l_shipdate")), ("down", F.desc("l_shipdate"))):
        rows.orderBy(order).coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
    got = [[tuple(r) for r in ledger_plans.regular_season_cutoff(spark, f"{tmp_path}/{name}").collect()] for name in ("up", "down")]
    assert got[0] == got[1] == [(1990, "A", 1, 4)]
