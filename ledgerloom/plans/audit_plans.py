"""Snapshot, audit, window, limit and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import audit, snapshots
from ledgerloom.sources.shared import work_folder
from .common import table

_SNAP = """p_size AS snapshot_year, p_brand AS association, p_name AS club, p_partkey AS id, p_retailprice AS points,
  CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE 900.0 + p_partkey % 50 END AS floor_points"""


def _snap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_size AS snapshot_year", "p_brand AS association", "p_name AS club", "p_partkey AS id", "p_retailprice AS points",
        "CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE cast(900.0 + p_partkey % 50 AS double) END AS floor_points",
    )


_COMP = """l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS c1,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount END AS c2, l_tax AS c3,
  l_quantity + l_discount + l_tax + (l_partkey % 3) * 0.004 AS total"""


def component_sum_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag", "if(l_partkey % 7 = 0, NULL, l_quantity) AS c1", "if(l_partkey % 11 = 0, NULL, l_discount) AS c2", "l_tax AS c3",
        "l_quantity + l_discount + l_tax + (l_partkey % 3) * 0.01D AS total")
    return snapshots.component_sum(rows, ["c1", "c2", "c3"], "total", 0.0051).groupBy("l_returnflag", "n_components", "within").agg(F.count("*").alias("n"))


def coefficient_max_floor(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.with_floor(_snap(spark, sf), "points", "floor_points").select("id", "coefficient", "uses_floor")


def rank_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    coarse = _snap(spark, sf).withColumn("points", F.floor(F.col("points") / 10) * 10.0)
    return snapshots.rank_with_ties(coarse, ["snapshot_year"], "points").select("snapshot_year", "id", "rank")


def rank_by_gap(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.rank_by_gap(_snap(spark, sf), ["snapshot_year"], "points", ["id"], gap=4.05).select("snapshot_year", "id", "rank")


def ordering_check(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.out_of_order(_snap(spark, sf), ["snapshot_year"], "id", "points").select("snapshot_year", "id", "points", "before")


def snapshot_audit(spark: SparkSession, sf: str) -> DataFrame:
    df = snapshots.with_floor(_snap(spark, sf), "points", "floor_points")
    return snapshots.named_checks(df, ["snapshot_year"], {
        "min_rows": F.count("*") >= 40, "no_duplicates": F.count_distinct("club") == F.count("*"),
        "formula": F.bool_and(F.col("coefficient") >= F.col("points")), "flag": F.bool_and(F.col("uses_floor") == (F.col("coefficient") != F.col("points"))),
    })


def topn_crosscheck(spark: SparkSession, sf: str) -> DataFrame:
    order = Window.partitionBy("snapshot_year").orderBy(F.desc("points"), "id")
    ranked = _snap(spark, sf).withColumn("rank", F.row_number().over(order))
    wrong = F.when(F.col("snapshot_year") % 4 == 0, F.col("points") + 1).otherwise(F.col("points"))
    expected = ranked.where("rank <= 5").select("snapshot_year", "rank", "club", wrong.alias("points"))
    return snapshots.crosscheck_top(ranked.where("rank <= 5"), expected, ["snapshot_year"], "club", "points", "rank")


def snapshot_table_parse(spark: SparkSession, sf: str) -> DataFrame:
    cells = F.array(
        F.col("id").cast("string"), F.col("club"), F.upper(F.substring("club", 1, 3)), F.when(F.col("id") % 4 == 0, "-").otherwise("1.5"), F.lit("2,000.25"),
        F.lit(""), F.lit("0"), F.lit("3"), F.when(F.col("id") % 5 == 0, "n/a").otherwise(F.concat(F.lit("1,"), F.lpad((F.col("id") % 1000).cast("string"), 3, "0"))), F.lit("12.5"))
    rows = _snap(spark, sf).select("id", F.when(F.col("id") % 9 == 0, F.slice(cells, 4, 5)).otherwise(cells).alias("cells"))
    return snapshots.parse_cells(rows)


def strict_number(spark: SparkSession, sf: str) -> DataFrame:
    text = "CASE p_partkey % 6 WHEN 0 THEN p_type WHEN 1 THEN concat('1,', lpad(p_size, 3, '0')) WHEN 2 THEN concat('-', p_size, '.50') WHEN 3 THEN concat(p_size, '.') WHEN 4 THEN NULL ELSE cast(p_size AS string) END"
    return table(spark, sf, "part").select("p_partkey", snapshots.strict_number(F.expr(text)).alias("value"))


def numeric_or_zero(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr("CASE p_partkey % 5 WHEN 0 THEN p_type WHEN 1 THEN 'NaN' WHEN 2 THEN 'Infinity' WHEN 3 THEN NULL ELSE concat(p_size, '.25') END")
    return table(spark, sf, "part").select("p_partkey", snapshots.number_or_zero(text).alias("value"))


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.status_counts(table(spark, sf, "orders").selectExpr("nullif(o_orderstatus, 'P') AS s"), "s")


def status_pivot(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders", "o_custkey", "o_orderstatus").join(
        table(spark, sf, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return audit.status_pivot(df, "c_nationkey", "o_orderstatus", ["O", "F", "X"])


def coverage_grouping(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").selectExpr("event_type", "user_id", "nullif(value > 10, false) AS high", "get_json_object(props, '$.k') AS k")
    return audit.coverage(df, ["high", "k"], [[], ["event_type"], ["user_id"]])


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Exact counts, and whether the united sketches of all days are within 6 % of them, or off by one."""
    events, sets = table(spark, sf, "events"), {"users": ["user_id"], "identities": ["user_id", "props"]}
    path = work_folder(spark, "sketches")
    audit.distinct_sketches(events.withColumn("day", F.to_date("ts")), ["event_type", "day"], sets).write.partitionBy("day").parquet(path)
    near = audit.united_counts(spark.read.parquet(path), ["event_type"], list(sets)).toDF("event_type", *[f"_{n}" for n in sets])
    return audit.distinct_counts(events, ["event_type"], sets).join(near, "event_type").select(
        "event_type", *sets, *[(F.abs(F.col(n) - F.col(f"_{n}")) <= F.greatest(F.col(n) * 0.06, F.lit(1.0))).alias(f"{n}_close") for n in sets])


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return audit.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def duplicate_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.duplicate_summary(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def bounded_examples(spark: SparkSession, sf: str) -> DataFrame:
    bad = table(spark, sf, "lineitem").where("l_quantity > 45")
    return audit.bounded_examples(bad, ["l_returnflag", "l_linestatus"], ["l_orderkey", "l_linenumber", "l_partkey"], "l_orderkey", 5)


def coverage_gate(spark: SparkSession, sf: str) -> DataFrame:
    have = table(spark, sf, "lineitem", "l_orderkey").distinct().withColumn("ok", F.lit(True))
    orders = table(spark, sf, "orders", "o_orderkey").join(have, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return audit.gate(orders, F.col("ok"), 0.9, 100)


def provider_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.suffix_counts(table(spark, sf, "orders"), "o_orderpriority", r"^(\d+)-", F.col("o_orderstatus") != "P")


def first_seen_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return audit.first_seen(table(spark, sf, "events", "user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"])


def page_manifest(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").selectExpr("event_type AS scope", "date_format(ts, 'yyyy-MM-dd') AS page", "user_id", "event_id")
    return audit.page_manifest(df, ["scope"], "user_id", "page", ["event_id"])


def duplicate_payload_flag(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("sha"))
    return audit.repeated_payload(rows, "sha", ["source", "doc_id"]).select("doc_id", "duplicate")


def prior_seasons(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").selectExpr("o_custkey", "year(o_orderdate) AS season", "o_orderkey")
    return audit.prior_scopes(df, "o_custkey", "season", "o_orderkey").groupBy("o_custkey", "season").agg(F.count("*").alias("rows"))


def argmax_root(spark: SparkSession, sf: str) -> DataFrame:
    return audit.argmax(table(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity", ["l_linenumber", "l_partkey"])


def stat_leaf_pick(spark: SparkSession, sf: str) -> DataFrame:
    return audit.pick_leaf(table(spark, sf, "events"), ["user_id", "event_type"], F.when(F.col("value") > 20, F.col("value")), "event_id", "stat")


def global_index_shard(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    indexed = audit.global_index(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return indexed.select("l_orderkey", "l_linenumber", "l_partkey", "global_index", F.floor(F.col("global_index") / 1000).alias("shard"))


def ordered_distinct(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey")
    return audit.ordered_distinct(rows, "o_custkey", "y", "o_orderkey", "seasons")


def union_aligned(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    return audit.union_aligned([customers, table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")])


def union_distinct_fields(spark: SparkSession, sf: str) -> DataFrame:
    return audit.union_fields([table(spark, sf, "customer"), table(spark, sf, "supplier")])


def intersect_dates(spark: SparkSession, sf: str) -> DataFrame:
    ordered = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("g"), F.to_date("o_orderdate").alias("d"))
    shipped = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 50).alias("g"), F.to_date("l_shipdate").alias("d"))
    return audit.common_values(ordered, shipped, "g", "d")


def except_contracts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderkey")
    return audit.new_rows(o.where("o_orderkey % 3 <> 0").drop("o_orderkey"), o.where("o_orderkey % 3 = 1").drop("o_orderkey"))


def dedupe_structs(spark: SparkSession, sf: str) -> DataFrame:
    return audit.first_structs(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey")


def sorted_review(spark: SparkSession, sf: str) -> DataFrame:
    return audit.locale_position(_snap(spark, sf), ["association"], "club", "id").select("association", "club", "id", "position")


def dob_precision_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 40 = 0 THEN 9 WHEN o_orderkey % 90 = 1 THEN 10 ELSE 11 END AS precision")
    counts = audit.precision_counts(rows, "precision", "o_orderkey")
    listed = audit.other_precisions(rows, "precision", "o_orderkey").select("precision", F.lit(1).cast("long").alias("n"), F.col("o_orderkey").alias("first_subject"))
    return counts.withColumn("kind", F.lit("count")).unionByName(listed.withColumn("kind", F.lit("row")))


def attempt_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.attempt_counts(table(spark, sf, "events").select(F.col("user_id").alias("subject"), F.col("event_type").alias("status")), "subject", "status")


_S = f"WITH s AS (SELECT {_SNAP} FROM part)"
QUERIES = {
    "component_sum_check": (component_sum_check, """WITH r AS (SELECT l_returnflag, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS c1,
        CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount END AS c2, l_tax AS c3, l_quantity + l_discount + l_tax + (l_partkey % 3) * 0.01::DOUBLE AS total FROM lineitem),
      n AS (SELECT *, ((c1 IS NOT NULL)::INT + (c2 IS NOT NULL)::INT + (c3 IS NOT NULL)::INT) AS k, coalesce(c1, 0) + coalesce(c2, 0) + coalesce(c3, 0) AS v FROM r)
      SELECT l_returnflag, k::INTEGER AS n_components, abs(v - total) <= 0.0051::DOUBLE * k + 1e-9::DOUBLE AS within, count(*) AS n FROM n GROUP BY ALL"""),
    "coefficient_max_floor": (coefficient_max_floor, _S + " SELECT id, greatest(points, floor_points)::DOUBLE AS coefficient, floor_points > points + 1e-9 AS uses_floor FROM s"),
    "rank_with_ties": (rank_with_ties, _S + " SELECT snapshot_year, id, rank() OVER (PARTITION BY snapshot_year ORDER BY floor(points / 10) DESC)::INTEGER AS rank FROM s"),
    "rank_by_gap": (rank_by_gap, _S + """, a AS (SELECT *, row_number() OVER w AS p, coalesce(lag(points) OVER w - points > 4.05::DOUBLE, true) AS new FROM s
      WINDOW w AS (PARTITION BY snapshot_year ORDER BY points DESC, id))
      SELECT snapshot_year, id, max(CASE WHEN new THEN p END) OVER (PARTITION BY snapshot_year ORDER BY p)::INTEGER AS rank FROM a"""),
    "ordering_check": (ordering_check, _S + ", a AS (SELECT *, lag(points) OVER (PARTITION BY snapshot_year ORDER BY id) AS before FROM s) SELECT snapshot_year, id, points, before FROM a WHERE points > before"),
    "snapshot_audit": (snapshot_audit, _S + """, c AS (SELECT *, greatest(points, floor_points) AS k, floor_points > points + 1e-9 AS u FROM s),
      w AS (SELECT snapshot_year, count(*) >= 40 AS min_rows, count(DISTINCT club) = count(*) AS no_duplicates, bool_and(k >= points) AS formula, bool_and(u = (k <> points)) AS flag FROM c GROUP BY 1)
      SELECT snapshot_year, "check", passed FROM w UNPIVOT (passed FOR "check" IN (min_rows, no_duplicates, formula, flag))"""),
    "topn_crosscheck": (topn_crosscheck, "SELECT p_size AS snapshot_year, least(count(*), 5) AS expected, p_size % 4 <> 0 AS passed FROM part GROUP BY p_size"),
    "snapshot_table_parse": (snapshot_table_parse, """SELECT p_partkey AS id, p_name AS club, upper(substr(p_name, 1, 3)) AS association,
      CASE WHEN p_partkey % 4 <> 0 THEN 1.5 END::DOUBLE AS s1, 2000.25::DOUBLE AS s2, NULL::DOUBLE AS s3, 0::DOUBLE AS s4, 3::DOUBLE AS s5,
      (1000 + p_partkey % 1000)::DOUBLE AS points, 12.5::DOUBLE AS floor FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 5 <> 0"""),
    "strict_number": (strict_number, "SELECT p_partkey, CASE p_partkey % 6 WHEN 1 THEN 1000 + p_size WHEN 2 THEN -p_size - 0.5 WHEN 5 THEN p_size END::DOUBLE AS value FROM part"),
    "numeric_or_zero": (numeric_or_zero, "SELECT p_partkey, CASE p_partkey % 5 WHEN 4 THEN p_size + 0.25 ELSE 0 END::DOUBLE AS value FROM part"),
    "status_counts": (status_counts, "SELECT coalesce(nullif(o_orderstatus, 'P'), 'NULL') AS status, count(*) AS n FROM orders GROUP BY 1"),
    "status_pivot": (status_pivot, "SELECT c_nationkey, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'X') AS x FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"),
    "coverage_grouping": (coverage_grouping, """WITH e AS (SELECT event_type, user_id, CASE WHEN value > 10 THEN true END AS high, props ->> '$.k' AS k FROM events),
      g AS (SELECT event_type, user_id, grouping_id(event_type, user_id) AS b, count(*) AS records, count(high) AS high, count(k) AS k FROM e GROUP BY GROUPING SETS ((), (event_type), (user_id)))
      SELECT CASE b WHEN 3 THEN 'all' WHEN 1 THEN 'event_type' ELSE 'user_id' END AS level, concat_ws('|', event_type, user_id::VARCHAR) AS key, field, observed, records, observed / records AS ratio
      FROM g UNPIVOT (observed FOR field IN (high, k))"""),
    "distinct_counts": (distinct_counts, "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT (user_id, props)) AS identities, true AS users_close, true AS identities_close FROM events GROUP BY 1"),
    "duplicate_keys": (duplicate_keys, "SELECT l_orderkey, l_linenumber, count(*) - 1 AS extra FROM lineitem GROUP BY ALL HAVING count(*) > 1"),
    "duplicate_summary": (duplicate_summary, """WITH d AS (SELECT l_orderkey, l_linenumber, count(*) - 1 AS extra FROM lineitem GROUP BY ALL HAVING count(*) > 1),
      f AS (SELECT l_orderkey || '|' || l_linenumber AS t FROM d ORDER BY l_orderkey, l_linenumber LIMIT 25)
      SELECT (SELECT count(*) FROM d) AS keys, (SELECT coalesce(sum(extra), 0)::BIGINT FROM d) AS extra, (SELECT coalesce(string_agg(t, ',' ORDER BY t), '') FROM f) AS examples"""),
    "bounded_examples": (bounded_examples, """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_orderkey, l_linenumber, l_partkey) AS k FROM lineitem WHERE l_quantity > 45)
      SELECT l_returnflag, l_linestatus, string_agg(l_orderkey::VARCHAR, ',' ORDER BY k) AS examples FROM r WHERE k <= 5 GROUP BY ALL"""),
    "coverage_gate": (coverage_gate, """WITH r AS (SELECT count(*) AS expected, count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS ok FROM orders)
      SELECT expected, ok, ok / expected AS ratio, CASE WHEN ok / expected >= 0.9 AND expected >= 100 THEN 'PASS' ELSE 'FAIL' END AS status FROM r"""),
    "provider_counts": (provider_counts, "SELECT regexp_extract(o_orderpriority, '^(\\d+)-', 1) AS provider, count(*) AS rows, count(*) FILTER (o_orderstatus <> 'P') AS non_empty FROM orders GROUP BY 1"),
    "first_seen_dedupe": (first_seen_dedupe, "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2"),
    "page_manifest": (page_manifest, """WITH e AS (SELECT event_type AS scope, strftime(ts, '%Y-%m-%d') AS page, row_number() OVER (PARTITION BY event_type, user_id ORDER BY strftime(ts, '%Y-%m-%d'), event_id) AS k FROM events),
      p AS (SELECT scope, page, count(*) AS rows, count(*) FILTER (k = 1) AS new_items FROM e GROUP BY ALL),
      q AS (SELECT *, min(CASE WHEN new_items = 0 THEN page END) OVER (PARTITION BY scope) AS end_page FROM p)
      SELECT *, end_page IS NULL OR page < end_page AS used FROM q"""),
    "duplicate_payload_flag": (duplicate_payload_flag, "SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) > 1 AS duplicate FROM documents"),
    "prior_seasons": (prior_seasons, """WITH f AS (SELECT o_custkey, year(o_orderdate)::INTEGER AS season, min(o_orderkey) AS a, count(*) AS rows FROM orders GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY a) AS k FROM f) SELECT o_custkey, season, rows FROM r WHERE k BETWEEN 2 AND 6"""),
    "argmax_root": (argmax_root, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey) = 1"),
    "stat_leaf_pick": (stat_leaf_pick, "SELECT user_id, event_type, event_id, CASE WHEN value > 20 THEN value END AS stat FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY coalesce(value, 0) <= 20, event_id) = 1"),
    "global_index_shard": (global_index_shard, """WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS global_index FROM lineitem)
      SELECT *, global_index // 1000 AS shard FROM g"""),
    "ordered_distinct": (ordered_distinct, "WITH f AS (SELECT o_custkey, year(o_orderdate) AS y, min(o_orderkey) AS a FROM orders GROUP BY ALL) SELECT o_custkey, string_agg(y::VARCHAR, ',' ORDER BY a) AS seasons FROM f GROUP BY 1"),
    "union_aligned": (union_aligned, "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier"),
    "union_distinct_fields": (union_distinct_fields, "SELECT DISTINCT column_name AS field FROM (DESCRIBE customer) UNION SELECT column_name FROM (DESCRIBE supplier)"),
    "intersect_dates": (intersect_dates, """WITH a AS (SELECT DISTINCT o_custkey % 50 AS g, o_orderdate::DATE AS d FROM orders), b AS (SELECT DISTINCT l_suppkey % 50 AS g, l_shipdate::DATE AS d FROM lineitem),
      c AS (SELECT a.g, a.d FROM a JOIN b USING (g, d)) SELECT g, count(d)::INTEGER AS common, min(d) AS "first" FROM (SELECT DISTINCT g FROM a SEMI JOIN b USING (g)) LEFT JOIN c USING (g) GROUP BY g"""),
    "except_contracts": (except_contracts, "SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 1"),
    "dedupe_structs": (dedupe_structs, """SELECT '{"c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}' AS canonical, min(c_custkey) AS "first" FROM customer GROUP BY 1"""),
    "sorted_review": (sorted_review, _S + " SELECT association, club, id, row_number() OVER (PARTITION BY association ORDER BY club, id)::INTEGER AS position FROM s"),
    "dob_precision_audit": (dob_precision_audit, "SELECT CASE WHEN o_orderkey % 40 = 0 THEN 9 WHEN o_orderkey % 90 = 1 THEN 10 ELSE 11 END AS precision, count(*) AS n, min(o_orderkey) AS first_subject, 'count' AS kind FROM orders GROUP BY 1 UNION ALL SELECT CASE WHEN o_orderkey % 40 = 0 THEN 9 ELSE 10 END, 1, o_orderkey, 'row' FROM orders WHERE o_orderkey % 40 = 0 OR o_orderkey % 90 = 1"),
    "attempt_status_counts": (attempt_status_counts, "SELECT user_id AS subject, event_type AS status, count(*) AS n FROM events GROUP BY GROUPING SETS ((user_id, event_type), (event_type))"),
}
