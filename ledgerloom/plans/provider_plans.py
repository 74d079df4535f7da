"""Projection, filter, join and provider queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import scan
from ledgerloom.operators import identity, providers, records, requests, similar
from .common import table

def player_index(spark: SparkSession, sf: str) -> DataFrame:
    c = providers.to_index(table(spark, sf, "customer"), "alpha", {
        "competition": F.col("c_mktsegment"), "provider_player_id": F.col("c_custkey"), "player_name": F.col("c_name"), "team": F.col("c_nationkey")})
    s = providers.to_index(table(spark, sf, "supplier"), "beta", {"provider_player_id": F.col("s_suppkey"), "player_name": F.col("s_name")}, "club")
    return c.unionByName(s).drop("provider_fields_json", "source_url", "source_local_path", "source_sha256")


def player_index_payload(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    return providers.to_index(c, "gamma", {"provider_player_id": F.col("c_custkey")}).select("provider_player_id", "provider_fields_json")


def coalesce_identity(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").selectExpr("c_custkey", "c_custkey % 3 AS a", "if(c_custkey % 2 = 0, ' ', c_mktsegment) AS b", "concat(c_name, '  x ') AS c")
    return df.select("c_custkey", providers.clean_name(F.col("a"), F.col("b"), F.col("c")).alias("name"))


def required_keys_check(spark: SparkSession, sf: str) -> DataFrame:
    return records.missing_keys(table(spark, sf, "events"), "props", ["k", "m"], ["event_type"])


def scalar_projection(spark: SparkSession, sf: str) -> DataFrame:
    return records.scalar_columns(table(spark, sf, "orders").selectExpr("o_orderkey", "struct(o_custkey) AS s", "array(o_custkey) AS a", "map('k', o_custkey) AS m", "o_orderstatus"))


def allowlist_projection(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"subject": [F.col("c_custkey")], "status": [F.nullif("c_mktsegment", F.lit("MACHINERY")), F.col("c_name")]}
    return records.allowlist(table(spark, sf, "customer"), columns, ("locator", [F.lit("person"), F.col("c_nationkey"), F.col("c_custkey")]))


def open_records(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS mapping", "if(o_orderkey % 4 = 0, NULL, 'F') AS dob")
    return records.open_records(df, {"mapping": "F", "dob": "F"})


def route_residuals(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").selectExpr("l_returnflag AS scope", "l_linestatus", "l_orderkey", "if(l_partkey % 3 = 0, NULL, l_partkey) AS bridge")
    verified, bridged = F.col("l_linestatus") == "F", F.col("bridge").isNotNull()
    return records.route_residuals(df, "scope", "l_orderkey", {"identity": ~verified, "with_bridge": verified & bridged, "without_bridge": verified & ~bridged})


def availability_status(spark: SparkSession, sf: str) -> DataFrame:
    status = records.availability(F.col("o_orderstatus") == "P", F.startswith("o_orderpriority", F.lit("1")), F.col("o_totalprice") < 5000)
    return table(spark, sf, "orders").groupBy(status.alias("status"), F.substring("o_orderpriority", 1, 1).alias("policy")).agg(F.count("*").alias("n"))


def scope_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return records.scope_snapshots(table(spark, sf, "orders"), "o_custkey", F.year("o_orderdate"), F.col("o_orderstatus") != "P", [F.count("*").alias("n")])


def regex_id_extract(spark: SparkSession, sf: str) -> DataFrame:
    row = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit("user/"), "user_id", F.lit("/x")))
    return table(spark, sf, "events").select("event_id", records.extract_id(row, ["id", "k"], [r"user/(\d+)"]).alias("id"))


def competition_class(spark: SparkSession, sf: str) -> DataFrame:
    kind = records.classify(F.col("p_type"), {"league": ["economy", "standard"]}, {"P": "cup"})
    return table(spark, sf, "part").groupBy("p_type", kind.alias("class")).agg(F.count("*").alias("n"))


def bridge_key(spark: SparkSession, sf: str) -> DataFrame:
    own = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("key-"), "c_nationkey"))
    given = F.when(F.col("c_custkey") % 4 == 1, F.col("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey", records.bridge_key(own, given, F.col("c_name"), r"#0*(\d+)$").alias("bridge"))


def technical_id_check(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 50 == 0, "bad").otherwise(F.col("c_name")).alias("given"))
    return records.technical_ids(df, F.concat(F.lit("Customer#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")), "given")


def record_checks(spark: SparkSession, sf: str) -> DataFrame:
    checks = {"priced": F.col("o_totalprice") > 1000, "final": F.col("o_orderstatus") == "F", "dated": F.year("o_orderdate") >= 1995}
    return records.record_checks(table(spark, sf, "orders"), checks).groupBy(*checks, "status").agg(F.count("*").alias("n"))


def dim_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr("c_custkey", "if(c_custkey % 10 = 0, 999, c_nationkey) AS team", "if(c_custkey % 4 = 0, 3, NULL) AS own")
    c = providers.dim_lookup(c, table(spark, sf, "nation"), "team", "n_nationkey")
    c = c.withColumn("league", F.coalesce("own", "n_regionkey")).select("c_custkey", "n_name", "league")
    return providers.dim_lookup(c, table(spark, sf, "region"), "league", "r_regionkey").select("c_custkey", "n_name", "r_name")


def missing_entities_anti(spark: SparkSession, sf: str) -> DataFrame:
    return requests.missing_entities(table(spark, sf, "orders", "o_orderkey"), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


def grid_cross(spark: SparkSession, sf: str) -> DataFrame:
    """Every nation and status: cells are kept, the first status with enough orders is chosen."""
    orders = table(spark, sf, "orders", "o_custkey", "o_orderstatus")
    nation = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    got = orders.join(nation, "o_custkey").groupBy("n_nationkey", "o_orderstatus").agg(F.count("*").alias("n"))
    return requests.grid(table(spark, sf, "nation"), orders, got, "n_nationkey", "o_orderstatus", "n", F.col("n") >= 200)


def season_request_plan(spark: SparkSession, sf: str) -> DataFrame:
    seasons = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("season"))
    return requests.request_plan(seasons, "o_custkey", "season", [1996, 1998], ["summary", "reports"])


def observation_route_expand(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "orders").select((F.col("o_custkey") % 100).alias("subject"), F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("season"))
    return requests.observation_routes(links, "subject", "id", "season")


def coverage_match_join(spark: SparkSession, sf: str) -> DataFrame:
    asked = table(spark, sf, "orders").selectExpr("o_orderkey", "year(o_orderdate) AS y").where("o_orderkey % 3 > 0")
    got = table(spark, sf, "lineitem").selectExpr("l_orderkey AS o_orderkey", "year(l_shipdate) AS y")
    return requests.coverage_rate(asked, got, ["o_orderkey", "y"], ["y"])


def payload_diff(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").selectExpr("nullif(o_orderstatus, 'P') AS s", "o_custkey % 50 AS c", "o_orderkey")
    return providers.null_safe_difference(o.where("o_orderkey % 2 = 0").drop("o_orderkey").distinct(), o.where("o_orderkey % 97 = 1").drop("o_orderkey"), ["s", "c"])


def response_echo_check(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min(F.year("l_shipdate")).alias("echoed"))
    df = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("asked")).join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return df.groupBy("asked", providers.echo_check(df, "asked", "echoed").alias("status")).agg(F.count("*").alias("n"))


def control_payload_compare(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), "source")
    return providers.control_compare(d, d.where("doc_id % 2 = 0 AND source <> 'src3'"), "source", "sha").select("doc_id", "comparison")


def name_contains_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Parts whose name holds, whatever its case, a target of a table: three texts and the last words of some names."""
    words = table(spark, sf, "part").where("p_partkey % 100 = 7").select(F.upper(F.element_at(F.split("p_name", " "), -1)).alias("target"))
    targets = words.union(spark.range(1).selectExpr("explode(array('RING', 'gear', 'blue w'))"))
    return scan.contains_any(table(spark, sf, "part", "p_partkey", "p_name"), "p_name", targets)


def provenance_reach(spark: SparkSession, sf: str) -> DataFrame:
    """Pages spread from customers to orders to parts (order 7 of every 10 links back to a customer)."""
    orders, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    edges = orders.selectExpr("concat('c', o_custkey) AS parent", "concat('o', o_orderkey) AS child").unionByName(
        li.selectExpr("concat('o', l_orderkey)", "concat('p', l_partkey)").toDF("parent", "child")).unionByName(
        orders.where("o_orderkey % 10 = 7").selectExpr("concat('o', o_orderkey)", "concat('c', o_custkey)").toDF("parent", "child")).distinct()
    seeds = table(spark, sf, "customer").selectExpr("concat('c', c_custkey) AS node", "concat('page', c_nationkey) AS page")
    return providers.reach(seeds, edges).groupBy("page", "depth").agg(F.count("*").alias("nodes"))


def subject_backjoin(spark: SparkSession, sf: str) -> DataFrame:
    later = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("subject"), "l_linestatus")
    earlier = table(spark, sf, "orders").select(F.col("o_orderkey").alias("subject"), "o_orderstatus")
    return requests.backjoin(later, earlier, "subject", "o_orderstatus").groupBy("l_linestatus", "earlier").agg(F.count("*").alias("n"))


def payload_version_groups(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select((F.col("doc_id") % 200).alias("entity"), F.col("doc_id").alias("param"), F.sha2(
        F.when(F.col("doc_id") % 200 < 50, "same").otherwise(F.col("text")), 256).alias("sha"))
    return providers.payload_versions(d, "entity", "param", "sha").select("entity", "representative", "params", "version")


def season_snapshot_join(spark: SparkSession, sf: str) -> DataFrame:
    label = F.concat(F.year("o_orderdate"), F.lit("-"), F.lpad(((F.year("o_orderdate") + 1) % 100).cast("string"), 2, "0"))
    seasons = table(spark, sf, "orders").select("o_custkey", identity.snapshot_year(label).alias("snapshot_year"))
    clubs = table(spark, sf, "part").selectExpr("1990 + p_size % 12 AS snapshot_year", "p_retailprice").groupBy("snapshot_year").agg(F.max("p_retailprice").alias("top"))
    return seasons.join(clubs, "snapshot_year").groupBy("snapshot_year", "top").agg(F.count("*").alias("n"))


_NORM = "lower(regexp_replace(p_name, '[^a-z0-9]+', ' '))"


def _identity(spark: SparkSession, sf: str):
    part = table(spark, sf, "part")
    clubs = part.where("p_partkey % 3 <> 0").selectExpr("p_size % 6 AS snapshot_year", "substr(p_brand, 7) AS association", "p_name AS norm", "concat(p_name, '#', p_partkey) AS club", "p_retailprice AS coefficient", "cast(p_partkey AS long) AS rank")
    facts = part.selectExpr("(p_size + p_partkey) % 6 AS snapshot_year", "substr(p_brand, 7) AS association", "p_name AS norm", "p_partkey AS id")
    names = part.selectExpr("substr(p_brand, 7) AS association", "p_name AS norm", "p_partkey")
    aliases = names.where("p_partkey % 5 = 0").selectExpr("association", "norm", "if(p_partkey % 10 = 0, 'small ring', concat('gone ', p_partkey)) AS target")
    return facts, clubs, aliases, names.where("p_partkey % 7 < 3").select("association", "norm")


def identity_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return identity.cascade(*_identity(spark, sf))


def exact_surface_match(spark: SparkSession, sf: str) -> DataFrame:
    facts, clubs, _, _ = _identity(spark, sf)
    return identity.exact_match(facts, clubs).select("id", "club", "coefficient")


def registry_validate(spark: SparkSession, sf: str) -> DataFrame:
    _, clubs, aliases, none = _identity(spark, sf)
    return identity.registry_errors(aliases, none, clubs)


def _pairs(spark: SparkSession, sf: str):
    part = table(spark, sf, "part")
    return (part.where("p_partkey % 4 = 0").selectExpr("p_size % 6 AS y", "p_brand AS a", "p_name AS name"),
            part.where("p_partkey % 4 <> 0").selectExpr("p_size % 6 AS y", "p_brand AS a", "concat(p_name, ' s') AS other"))


def topk_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return similar.top_k_similar(*_pairs(spark, sf), ["y", "a"], "name", "other")


def candidate_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return identity.candidate_rollup(topk_candidates(spark, sf), ["a", "name"], "other")


def review_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a match by association and name, with the three most similar clubs of each season's snapshot."""
    facts, clubs, aliases, none = _identity(spark, sf)
    review = identity.cascade(facts, clubs, aliases, none).where("status = 'REVIEW_REQUIRED'")
    best = similar.top_k_similar(review, clubs.withColumnRenamed("norm", "other"), ["snapshot_year", "association"], "norm", "other", 3)
    found = identity.review_groups(review, ["association", "norm"], "snapshot_year", best)
    seasons = F.transform("candidates", lambda c: F.concat_ws(":", c["snapshot_year"].cast("string"), F.array_join(c["names"], "/")))
    return found.select("association", "norm", F.array_join("seasons", ",").alias("seasons"), "rows", F.coalesce(F.array_join(seasons, ","), F.lit("")).alias("candidates"))


def short_name_match(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_brand", F.split("p_name", " ").alias("t")).distinct()
    short = part.select("p_brand", F.array(F.col("t")[1], F.concat(F.substring(F.col("t")[0], 1, 1), F.lit("."))).alias("tokens")).distinct()
    found = identity.short_name_match(short, part.select("p_brand", F.col("t").alias("full_tokens")), ["p_brand"])
    return found.select("p_brand", F.array_join("tokens", " ").alias("short"), F.array_join("full_tokens", " ").alias("full"))


_ID = """f AS (SELECT (p_size + p_partkey) % 6 AS snapshot_year, substr(p_brand, 7) AS association, p_name AS norm, p_partkey AS id FROM part),
  c AS (SELECT p_size % 6 AS snapshot_year, substr(p_brand, 7) AS association, p_name AS norm, arg_min(p_name || '#' || p_partkey, p_partkey) AS club, arg_min(p_retailprice, p_partkey) AS coefficient, min(p_partkey) AS rank FROM part WHERE p_partkey % 3 <> 0 GROUP BY ALL),
  al0 AS (SELECT substr(p_brand, 7) AS association, p_name AS norm, CASE WHEN p_partkey % 10 = 0 THEN 'small ring' ELSE 'gone ' || p_partkey END AS target FROM part WHERE p_partkey % 5 = 0),
  al AS (SELECT association, norm, min(target) AS target FROM al0 GROUP BY ALL),
  g AS (SELECT association, norm, arg_min(club, (snapshot_year, rank)) AS gc FROM c GROUP BY ALL),
  nh AS (SELECT DISTINCT substr(p_brand, 7) AS association, p_name AS norm FROM part WHERE p_partkey % 7 < 3)"""
_CASCADE = f"""WITH {_ID}, j AS (SELECT f.*, e.club AS ec, e.coefficient AS ev, t.club AS ac, t.coefficient AS av, al.target, gc, nh.norm IS NOT NULL AS none FROM f
    LEFT JOIN c e USING (snapshot_year, association, norm) LEFT JOIN al ON al.association = f.association AND al.norm = f.norm
    LEFT JOIN c t ON t.snapshot_year = f.snapshot_year AND t.association = f.association AND t.norm = al.target
    LEFT JOIN g ON g.association = f.association AND g.norm = f.norm LEFT JOIN nh ON nh.association = f.association AND nh.norm = f.norm),
  m AS (SELECT *, CASE WHEN ec IS NOT NULL THEN 'EXACT' WHEN ac IS NOT NULL THEN 'ALIAS' WHEN target IS NOT NULL THEN 'ALIAS_ABSENT' WHEN gc IS NOT NULL THEN 'GLOBAL_EXACT_ABSENT' WHEN none THEN 'NO_HISTORY' ELSE 'REVIEW_REQUIRED' END AS method FROM j),
  r AS (SELECT snapshot_year, association, norm, id, method, CASE WHEN method IN ('EXACT', 'ALIAS') THEN 'MATCHED' WHEN method = 'REVIEW_REQUIRED' THEN method ELSE 'NO_COEFFICIENT' END AS status,
    coalesce(ec, ac, CASE WHEN method = 'GLOBAL_EXACT_ABSENT' THEN gc END) AS club, coalesce(ev, av) AS coefficient FROM m)"""
_SIM = """l AS (SELECT DISTINCT p_size % 6 AS y, p_brand AS a, p_name AS name FROM part WHERE p_partkey % 4 = 0), r AS (SELECT DISTINCT p_size % 6 AS y, p_brand AS a, p_name || ' s' AS other FROM part WHERE p_partkey % 4 <> 0),
  p AS (SELECT y, a, name, other, greatest(length(name), length(other)) AS m, least(length(name), length(other)) AS s, list_distinct(string_split(name, ' ')) AS ta, list_distinct(string_split(other, ' ')) AS tb FROM l JOIN r USING (y, a)),
  s AS (SELECT y, a, name, other, greatest(1.0::DOUBLE - levenshtein(name, other) / m, len(list_intersect(ta, tb)) / len(list_distinct(ta || tb)), CASE WHEN contains(name, other) OR contains(other, name) THEN s / m ELSE 0 END)::DOUBLE AS score FROM p),
  k AS (SELECT *, row_number() OVER (PARTITION BY y, a, name ORDER BY score DESC, other)::INTEGER AS place FROM s QUALIFY place <= 5)"""
_Y = "year(o_orderdate)::INTEGER"

QUERIES = {
    "player_index": (player_index, """SELECT 'alpha' AS provider, c_mktsegment AS competition, NULL::VARCHAR AS season, c_custkey::VARCHAR AS provider_player_id, c_name AS player_name, c_nationkey::VARCHAR AS team, 'player' AS record_type FROM customer
      UNION ALL SELECT 'beta', NULL, NULL, s_suppkey::VARCHAR, s_name, NULL, 'club' FROM supplier"""),
    "player_index_payload": (player_index_payload, """SELECT c_custkey::VARCHAR AS provider_player_id, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}' AS provider_fields_json FROM customer"""),
    "coalesce_identity": (coalesce_identity, "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 3)::VARCHAR WHEN c_custkey % 2 <> 0 THEN c_mktsegment ELSE c_name || ' x' END AS name FROM customer"),
    "required_keys_check": (required_keys_check, """SELECT event_type, missing, count(*) AS rows FROM events, (SELECT unnest(['k', 'm']) AS missing) WHERE NOT list_contains(json_keys(props), missing) GROUP BY ALL"""),
    "scalar_projection": (scalar_projection, "SELECT o_orderkey, o_orderstatus FROM orders"),
    "allowlist_projection": (allowlist_projection, "SELECT c_custkey AS subject, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name ELSE c_mktsegment END AS status, 'person/' || c_nationkey || '/' || c_custkey AS locator FROM customer"),
    "open_records": (open_records, "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS mapping, CASE WHEN o_orderkey % 4 <> 0 THEN 'F' END AS dob FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 4 <> 0)"),
    "route_residuals": (route_residuals, "SELECT l_returnflag AS scope, count(*) FILTER (l_linestatus = 'O') AS identity, count(*) FILTER (l_linestatus = 'F' AND l_partkey % 3 <> 0) AS with_bridge, count(*) FILTER (l_linestatus = 'F' AND l_partkey % 3 = 0) AS without_bridge, count(DISTINCT l_orderkey) AS subjects FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())"),
    "availability_status": (availability_status, "SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority LIKE '1%' THEN 'FAILED_REQUIRED' WHEN o_orderstatus = 'P' THEN 'UNAVAILABLE_OPTIONAL' WHEN o_totalprice < 5000 THEN 'CORRUPT' ELSE 'AVAILABLE' END AS status, substr(o_orderpriority, 1, 1) AS policy, count(*) AS n FROM orders GROUP BY 1, 2"),
    "scope_snapshots": (scope_snapshots, f"SELECT o_custkey, 'total' AS scope, NULL::INTEGER AS round, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 UNION ALL SELECT o_custkey, 'round', {_Y}, count(*) FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 3"),
    "regex_id_extract": (regex_id_extract, "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN (props ->> '$.k')::BIGINT ELSE user_id END AS id FROM events"),
    "competition_class": (competition_class, "SELECT p_type, CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'league' WHEN p_type LIKE 'P%' THEN 'cup' ELSE 'other' END AS class, count(*) AS n FROM part GROUP BY 1, 2"),
    "bridge_key": (bridge_key, "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'key-' || c_nationkey ELSE 'provider:' || c_custkey END AS bridge FROM customer"),
    "technical_id_check": (technical_id_check, "SELECT count(*) AS rows, count(*) FILTER (c_custkey % 50 = 0) AS not_canonical, count(DISTINCT c_custkey) = count(*) AS \"unique\" FROM customer"),
    "record_checks": (record_checks, "WITH c AS (SELECT o_totalprice > 1000 AS priced, o_orderstatus = 'F' AS final, year(o_orderdate) >= 1995 AS dated FROM orders) SELECT *, CASE WHEN priced AND final AND dated THEN 'VERIFIED' ELSE 'REVIEW' END AS status, count(*) AS n FROM c GROUP BY ALL"),
    "dim_lookup": (dim_lookup, """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 999 ELSE c_nationkey END AS team, CASE WHEN c_custkey % 4 = 0 THEN 3 END AS own FROM customer)
      SELECT c_custkey, n_name, r_name FROM c LEFT JOIN nation ON team = n_nationkey LEFT JOIN region ON r_regionkey = coalesce(own, n_regionkey)"""),
    "missing_entities_anti": (missing_entities_anti, "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"),
    "grid_cross": (grid_cross, """WITH g AS (SELECT c_nationkey, o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), m AS (SELECT DISTINCT o_orderstatus FROM orders),
      c AS (SELECT n_nationkey, m.o_orderstatus, coalesce(n, 0) AS n, coalesce(n, 0) >= 200 AS valid FROM nation CROSS JOIN m LEFT JOIN g ON c_nationkey = n_nationkey AND g.o_orderstatus = m.o_orderstatus)
      SELECT *, min(CASE WHEN valid THEN o_orderstatus END) OVER (PARTITION BY n_nationkey) AS mode FROM c"""),
    "season_request_plan": (season_request_plan, f"SELECT DISTINCT {_Y} AS season, o_custkey, mode FROM orders, (SELECT unnest(['summary', 'reports']) AS mode) WHERE year(o_orderdate) IN (1996, 1998)"),
    "observation_route_expand": (observation_route_expand, f"SELECT subject, id, season FROM (SELECT DISTINCT o_custkey % 100 AS subject, o_custkey AS id FROM orders) JOIN (SELECT DISTINCT o_custkey % 100 AS subject, {_Y} AS season FROM orders) USING (subject)"),
    "coverage_match_join": (coverage_match_join, f"""WITH g AS (SELECT DISTINCT l_orderkey, year(l_shipdate) AS y FROM lineitem) SELECT {_Y} AS y, count(*) AS expected, count(l_orderkey) AS matched, count(l_orderkey) / count(*) AS rate
      FROM orders LEFT JOIN g ON l_orderkey = o_orderkey AND g.y = year(o_orderdate) WHERE o_orderkey % 3 > 0 GROUP BY 1"""),
    "payload_diff": (payload_diff, "SELECT nullif(o_orderstatus, 'P') AS s, o_custkey % 50 AS c FROM orders WHERE o_orderkey % 2 = 0 EXCEPT SELECT nullif(o_orderstatus, 'P'), o_custkey % 50 FROM orders WHERE o_orderkey % 97 = 1"),
    "response_echo_check": (response_echo_check, f"""WITH l AS (SELECT l_orderkey, min(year(l_shipdate)) AS e FROM lineitem GROUP BY 1) SELECT {_Y} AS asked, CASE WHEN e IS NULL THEN 'not_echoed' WHEN e = year(o_orderdate) THEN 'verified' ELSE 'mismatch' END AS status, count(*) AS n
      FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1, 2"""),
    "control_payload_compare": (control_payload_compare, """WITH c AS (SELECT source, min(sha256(text)) AS c FROM documents WHERE doc_id % 2 = 0 AND source <> 'src3' GROUP BY 1)
      SELECT doc_id, CASE WHEN c IS NULL THEN 'failed' WHEN c = sha256(text) THEN 'same_payload' ELSE 'distinct' END AS comparison FROM documents LEFT JOIN c USING (source)"""),
    "name_contains_filter": (name_contains_filter, """WITH t AS (SELECT lower(string_split(p_name, ' ')[-1]) AS t FROM part WHERE p_partkey % 100 = 7 UNION SELECT unnest(['ring', 'gear', 'blue w']))
      SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM t WHERE contains(lower(p_name), t))"""),
    "provenance_reach": (provenance_reach, """WITH RECURSIVE e AS (SELECT 'c' || o_custkey AS p, 'o' || o_orderkey AS c FROM orders UNION SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem UNION SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders WHERE o_orderkey % 10 = 7),
      r AS (SELECT 'c' || c_custkey AS node, 'page' || c_nationkey AS page, 0 AS depth FROM customer UNION SELECT e.c, page, depth + 1 FROM r JOIN e ON node = e.p WHERE depth < 5),
      m AS (SELECT node, page, min(depth)::INTEGER AS depth FROM r GROUP BY ALL) SELECT page, depth, count(*) AS nodes FROM m GROUP BY ALL"""),
    "subject_backjoin": (subject_backjoin, "SELECT l_linestatus, coalesce(o_orderstatus, 'MISSING') AS earlier, count(*) AS n FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"),
    "payload_version_groups": (payload_version_groups, """WITH d AS (SELECT doc_id % 200 AS entity, doc_id AS param, CASE WHEN doc_id % 200 < 50 THEN 'same' ELSE text END AS body FROM documents),
      g AS (SELECT entity, body, min(param) AS representative, count(DISTINCT param) AS params FROM d GROUP BY ALL)
      SELECT entity, representative, params, CASE WHEN count(*) OVER (PARTITION BY entity) = 1 AND params > 1 THEN 'UNVERSIONED_CURRENT' ELSE 'PARAM_' || representative END AS version FROM g"""),
    "season_snapshot_join": (season_snapshot_join, f"WITH c AS (SELECT 1990 + p_size % 12 AS snapshot_year, max(p_retailprice) AS top FROM part GROUP BY 1) SELECT snapshot_year, top, count(*) AS n FROM orders JOIN c ON snapshot_year = {_Y} GROUP BY ALL"),
    "identity_cascade": (identity_cascade, _CASCADE + " SELECT * FROM r"),
    "exact_surface_match": (exact_surface_match, f"WITH {_ID} SELECT id, club, coefficient FROM f LEFT JOIN c USING (snapshot_year, association, norm)"),
    "registry_validate": (registry_validate, f"""WITH {_ID} SELECT 'duplicate_alias' AS error, association, norm FROM al0 GROUP BY ALL HAVING count(*) > 1
      UNION ALL SELECT DISTINCT 'alias_target_absent', association, norm FROM al0 WHERE (association, target) NOT IN (SELECT (association, norm) FROM c)
      UNION ALL SELECT DISTINCT 'in_both', association, norm FROM al0 SEMI JOIN nh USING (association, norm) UNION ALL SELECT 'no_history_matches', association, norm FROM nh SEMI JOIN c USING (association, norm)"""),
    "topk_candidates": (topk_candidates, f"WITH {_SIM} SELECT * FROM k"),
    "candidate_rollup": (candidate_rollup, f"""WITH {_SIM}, g AS (SELECT a, name, other, count(*) AS appearances, max(score) AS best, sum(round(score * 1000000)::BIGINT) / count(*) AS m FROM k GROUP BY ALL)
      SELECT a, name, other, appearances, best, row_number() OVER (PARTITION BY a, name ORDER BY best DESC, appearances DESC, m DESC, other)::INTEGER AS place FROM g QUALIFY place <= 8"""),
    "review_groups": (review_groups, _CASCADE + """, q AS (SELECT association, norm, string_agg(DISTINCT snapshot_year::VARCHAR, ',' ORDER BY snapshot_year::VARCHAR) AS seasons, count(*) AS rows FROM r WHERE status = 'REVIEW_REQUIRED' GROUP BY ALL),
      n AS (SELECT DISTINCT snapshot_year, association, norm FROM r WHERE status = 'REVIEW_REQUIRED'), o AS (SELECT DISTINCT snapshot_year, association, norm AS other FROM c),
      x AS (SELECT *, string_split(norm, ' ') AS tn, string_split(other, ' ') AS ot, greatest(length(norm), length(other)) AS l, least(length(norm), length(other)) AS m FROM n JOIN o USING (snapshot_year, association)),
      z AS (SELECT snapshot_year, association, norm, other, CASE WHEN norm = other THEN 1.0 ELSE greatest(1.0::DOUBLE - levenshtein(norm, other) / l, len(list_intersect(tn, ot)) / len(list_distinct(tn || ot)), CASE WHEN contains(norm, other) OR contains(other, norm) THEN m / l ELSE 0 END)::DOUBLE END AS score FROM x),
      k AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY snapshot_year, association, norm ORDER BY score DESC, other) <= 3),
      w AS (SELECT snapshot_year, association, norm, string_agg(other, '/' ORDER BY score DESC, other) AS names FROM k GROUP BY ALL)
      SELECT association, norm, seasons, rows, coalesce(v.candidates, '') AS candidates FROM q LEFT JOIN (SELECT association, norm, string_agg(snapshot_year || ':' || names, ',' ORDER BY snapshot_year) AS candidates FROM w GROUP BY ALL) v USING (association, norm)"""),
    "short_name_match": (short_name_match, """WITH p AS (SELECT DISTINCT p_brand, string_split(p_name, ' ') AS t FROM part), s AS (SELECT DISTINCT p_brand, t[2] AS b, t[1][1] AS i FROM p)
      SELECT s.p_brand, b || ' ' || i || '.' AS short, array_to_string(t, ' ') AS full FROM s JOIN p ON p.p_brand = s.p_brand AND list_contains(t, b) AND len(list_filter(t, lambda x: x <> b AND starts_with(x, i))) > 0"""),
}
