"""Lines without a number or goals come after the others of their file, as in the SQL."""

import datetime

import duckdb

from ledgerloom.plans import catalog
from tests.oracle import same


def test_cutoff_with_nulls_equals_its_sql(spark, tmp_path):
    # every file has the same six lines of six years, one without a number, two without goals; no two tie
    rows = []
    for file_id in range(1, 41):
        for i, (line_no, quantity) in enumerate([(None, 4.0), (2, 1.0), (2, None), (3, 2.0), (1, None), (1, 3.0)]):
            rows.append((file_id, 3, 1, line_no, quantity, "ARN"[i % 3], datetime.datetime(1990 + i, 1, 1)))
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.sql(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    query, sql = (x["regular_season_cutoff"] for x in catalog.load()[:2])
    same(query(spark, str(tmp_path)), con, sql)
