"""Evidence, identity master, source and sink queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import evidence, ledger, master
from ledgerloom.sources import files, publish, rounds
from ledgerloom.sources.shared import work_folder
from .common import STANDINGS, matches, table


def name_candidate_join(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    subjects = part.selectExpr("p_partkey AS subject", "p_partkey % 50 = 0 AS failed", "array(concat(split(p_name, ' ')[0], p_size), p_name) AS names")
    entities = part.selectExpr("concat('Q', p_partkey) AS entity", "array(concat(split(p_name, ' ')[0], p_size % 40, if(p_partkey % 9 = 0, '', 'x'))) AS names",
                               "if(p_partkey % 2 = 1, array('human', 'footballer'), array('human')) AS claims")
    return evidence.name_candidates(subjects, entities, ["human", "footballer"])


def club_context_resolve(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    cand = li.selectExpr("l_orderkey AS subject", "l_suppkey AS entity").distinct()
    clubs = table(spark, sf, "orders").selectExpr("o_orderkey AS subject", "o_custkey % 40 AS club").distinct()
    own = li.selectExpr("l_suppkey AS entity", "l_partkey % 40 AS club").where("l_linenumber = 1 AND l_quantity > 40").distinct()
    return evidence.context_resolve(cand, clubs, own)


def dob_statement_choice(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").selectExpr(
        "o_custkey AS subject", "o_orderkey AS statement", "CASE o_orderstatus WHEN 'P' THEN 'preferred' WHEN 'O' THEN 'deprecated' ELSE 'normal' END AS rank",
        "year(o_orderdate) % 3 AS time", "CASE WHEN o_orderkey % 20 = 0 THEN 9 ELSE 11 END AS precision")
    return evidence.choose_statement(s)


def day_dates_of_statements(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").selectExpr("o_custkey AS subject", "concat('+', date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00Z') AS time", "if(o_orderkey % 3 = 0, 9, 11) AS precision")
    return evidence.day_dates(s, "time", "precision")


def _attempts(spark: SparkSession, sf: str) -> DataFrame:
    days = F.slice(F.array(F.date_format("l_shipdate", "yyyy-MM"), F.lit("x")), F.lit(1), (F.col("l_linenumber") % 3).cast("int"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("subject"), F.when(F.col("l_partkey") % 13 == 0, 404).otherwise(200).alias("http"), (F.col("l_suppkey") % 7 != 0).alias("bound"),
        F.when(F.col("l_quantity") > 3, F.col("l_returnflag")).alias("name"), (F.col("l_returnflag") != "R").alias("matches"), days.alias("days"), F.date_format("l_shipdate", "yyyy").alias("day"))


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    c = [F.col(x) for x in ("http", "bound", "name", "matches", "days")]
    return _attempts(spark, sf).withColumn("status", evidence.observation_status(*c))


def observation_status(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


def observation_consensus(spark: SparkSession, sf: str) -> DataFrame:
    subjects = table(spark, sf, "orders").select(F.col("o_orderkey").alias("subject"))
    return evidence.consensus(subjects, _judged(spark, sf), F.col("status") == "ACCEPTED", "day")


def conflict_resolution(spark: SparkSession, sf: str) -> DataFrame:
    obs = _judged(spark, sf).where("status = 'ACCEPTED'").groupBy("subject").agg(F.collect_set("day").alias("observed"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("subject"), F.array(F.year("o_orderdate").cast("string"), (F.year("o_orderdate") + 1).cast("string")).alias("existing"))
    j = o.join(obs, "subject", "left").withColumn("observed", F.coalesce("observed", F.array().cast("array<string>")))
    return j.select("subject", evidence.resolve_conflict(F.col("observed"), F.col("existing")).alias("status"))


def signature_clusters(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").selectExpr("p_partkey % 300 AS provider", "split(p_name, ' ') AS tokens", "cast(p_size % 3 AS string) AS day", "p_partkey % 4 = 0 AS v")
    return evidence.signature_clusters(rows, "provider", "tokens", "day", F.col("v"))


def cross_scope_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey").where("y IN (1995, 1996)")
    return evidence.cross_scope(rows, "o_custkey", "y", "o_orderkey")


def _pass(spark: SparkSession, sf: str, where: str, status: str) -> DataFrame:
    day = "cast(NULL AS string)" if status == "DOB_CONFLICT" else f"'{status.lower()}'"
    return table(spark, sf, "orders").where(where).selectExpr("o_orderkey AS subject", f"'{status}' AS status", f"{day} AS day")


def override_precedence(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "orders").selectExpr("o_orderkey AS subject", "if(o_orderstatus = 'P', NULL, 'FIRST') AS status", "if(o_orderstatus = 'P', NULL, date_format(o_orderdate, 'yyyy-MM-dd')) AS day")
    return master.apply_overrides(base, [_pass(spark, sf, f"o_orderkey % {m} = 0", s) for m, s in ((3, "NONDAY"), (5, "OPEN"), (7, "DOB_CONFLICT"))])


def _people(spark: SparkSession, sf: str):
    c = table(spark, sf, "customer")
    current = c.selectExpr("concat('s', c_custkey) AS subject", "if(c_custkey % 4 = 0, concat('p', c_custkey % 100), NULL) AS bridge", "if(c_custkey % 3 = 0, concat('Q', c_custkey % 500), NULL) AS entity")
    historical = c.selectExpr("concat('p', c_custkey % 700) AS person", "if(c_nationkey % 2 = 0, concat('Q', c_custkey % 350), NULL) AS entity")
    return current, historical


def person_key_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return master.person_keys(*_people(spark, sf))


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of persons: customers as subjects, their orders' priorities as aliases, which repeat."""
    keys = person_key_cascade(spark, sf).select("subject", "person", F.col("method").alias("key_method"))
    c = table(spark, sf, "customer").selectExpr(
        "concat('s', c_custkey) AS subject", "c_custkey AS seq", "if(c_custkey % 2 = 0, 'current', 'historical') AS scope", "c_mktsegment AS name", "'IDENTITY_VERIFIED' AS source_status",
        "CASE WHEN c_custkey % 41 = 0 THEN 'CONFLICT' WHEN c_custkey % 5 = 0 THEN 'OPEN' ELSE 'VERIFIED' END AS status", "concat('1990-01-0', c_custkey % 2 + 1) AS day", "'PASS' AS dob_method")
    rows = c.join(keys, "subject").withColumnRenamed("key_method", "method")
    o = table(spark, sf, "orders").selectExpr("concat('s', o_custkey) AS subject", "cast(o_custkey AS long) AS seq", "'orders' AS provider", "o_orderpriority AS provider_id", "'ENTITY' AS scope")
    return master.person_facts(rows, o.join(keys.select("subject", "person"), "subject"))


def identity_master(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions of all persons, and what the parts of their documents hold."""
    facts = _facts(spark, sf)
    docs = master.person_documents(facts, 50)
    lists = docs.groupBy("person").agg(
        F.array_join(F.array_sort(F.flatten(F.collect_list(F.transform("alias", lambda x: x["provider_id"])))), ",").alias("alias_ids"),
        F.array_join(F.array_sort(F.flatten(F.collect_list(F.transform("name", lambda x: x["name"])))), ",").alias("name_list"),
        F.sum(F.size("evidence")).alias("listed_evidence"))
    return master.identity_master(facts).join(lists, "person")


def provider_units(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").selectExpr("s_suppkey % 60 AS unit", "concat('n', s_suppkey % 120) AS name", "if(s_suppkey % 60 < 20, concat('d', s_suppkey % 7), 'd') AS day")
    return master.provider_units(rows, "unit", "name", "day", "unit-v1-")


def registry_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by scope and status (key null), and the open rows of each scope by their keys."""
    persons, over, units = master.identity_master(_facts(spark, sf)), override_precedence(spark, sf), provider_units(spark, sf)
    counts = master.registry_counts({"persons": persons, "overrides": over, "units": units})
    open_ = master.registry_residuals({"persons": (persons, "person", ["CONFLICT", "ERROR"]), "overrides": (over, "subject", ["UNACCOUNTED"]), "units": (units, "unit_key", ["NO_CONSENSUS"])})
    return counts.withColumn("key", F.lit(None).cast("string")).unionByName(open_.withColumn("n", F.lit(1).cast("long")))


def src_json_records(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes of a few hundred customers each, written and read back."""
    path = work_folder(spark, "envelopes")
    files.write_records(table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey"), path, ["c_nationkey"], ["c_custkey", "c_name"])
    return files.read_records(spark, path, "c_custkey long, c_name string")


def _round_files(spark: SparkSession, sf: str) -> str:
    """A CSV file for each year and line number; odd ones have their columns in another order and one more."""
    path = work_folder(spark, "rounds")
    li = table(spark, sf, "lineitem").withColumn("slot", F.concat(F.year("l_shipdate"), F.lit("-"), "l_linenumber"))
    for name, odd, columns in (("a", 0, ["l_orderkey", "l_partkey"]), ("b", 1, ["l_partkey", "l_suppkey", "l_orderkey"])):
        rows = li.where(F.col("l_linenumber") % 2 == odd).select("slot", *columns)
        rows.repartition("slot").write.partitionBy("slot").option("header", True).csv(f"{path}/{name}")
    return f"{path}/*/*"


_SLOT = r"slot=(\d{4})-(\d+)"


def src_csv_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return rounds.read_round_csv(spark, _round_files(spark, sf), _SLOT).groupBy("year", "round").agg(
        F.count("*").alias("rows"), F.count_distinct("l_partkey").alias("ids"), F.sum(F.col("l_orderkey").cast("long")).alias("orders"),
        F.sum(F.col("l_partkey").cast("long")).alias("parts"), F.count("l_suppkey").alias("with_supplier"))


def year_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of the years of the files, and of a year for which there is none."""
    path = _round_files(spark, sf)
    years = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")).union(spark.range(1).selectExpr("1900 AS year"))
    return rounds.year_profile(rounds.read_round_csv(spark, path, _SLOT), rounds.csv_inventory(spark, path, _SLOT), ["id", "l_partkey"], years)


def src_json_legacy_charset(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of a hundred customers each, one indented JSON text a file, every second one in Latin-1."""
    path = work_folder(spark, "legacy")
    lines = table(spark, sf, "customer").selectExpr(
        "cast(c_custkey div 100 AS int) AS slot", "c_custkey", "concat('  {\n    \"k\": ', c_custkey, ',\n    \"n\": \"é', c_name, '\"\n  }') AS line")
    docs = lines.groupBy("slot").agg(F.array_join(F.array_sort(F.collect_list("line")), ",\n").alias("body"))
    text = F.concat(F.lit('{"atletas": [\n'), "body", F.lit("\n]}"))
    latin = F.encode(text, "ISO-8859-1").cast("string")
    docs.select("slot", F.when(F.col("slot") % 2 == 0, latin).otherwise(text).alias("value")).repartition("slot").write.partitionBy("slot").text(path)
    found = rounds.read_legacy_json(spark, f"{path}/slot=*", "atletas array<struct<k:int,n:string>>", "slot=()(\\d+)")
    return found.where("parsed").select("round", "utf8", F.explode("record.atletas").alias("a")).select("a.k", "a.n", "utf8", F.col("round").alias("slot"))


def src_chunked_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Chunked texts and the manifest of their hashes; some have a damaged or a lost chunk, another hash or none."""
    d = table(spark, sf, "documents").select("doc_id", files.packed("text").alias("p"), F.sha2("text", 256).alias("sha"), (F.col("doc_id") % 10).alias("_k"))
    manifest = d.where("_k <> 6").select("doc_id", F.when(F.col("_k") == 5, F.sha2("sha", 256)).otherwise(F.col("sha")).alias("payload_sha256"))
    chunks = files.chunk(d, "doc_id", "p", 500).withColumn("_k", F.col("doc_id") % 10).where("_k <> 4 OR idx > 0")
    chunks = chunks.withColumn("chunk", F.when((F.col("_k") == 3) & (F.col("idx") == 0), F.reverse("chunk")).otherwise(F.col("chunk"))).drop("_k")
    return files.assemble(chunks, "doc_id", manifest).select("doc_id", "state", F.sha2("content", 256).alias("sha256"))


def src_archive_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Zip archives of customers' names, sixteen a nation, written to the shared folder and listed; those of one nation are cut short."""
    path = work_folder(spark, "archives")
    members = table(spark, sf, "customer").select(
        F.concat_ws("-", F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 16).cast("string")).alias("archive"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("/"), "c_name", F.lit(".txt")).alias("member"), F.col("c_name").alias("body"))
    cut = F.when(F.startswith("path", F.lit("3-")), F.expr("substring(content, 1, cast(octet_length(content) / 2 AS int))")).otherwise(F.col("content"))
    files.zipped(members, "archive", "member", "body").withColumn("content", cut).write.parquet(path)
    return files.archive_members(spark.read.parquet(path))


def sink_csv_fixed(spark: SparkSession, sf: str) -> DataFrame:
    path = work_folder(spark, "csv")
    s = ledger.standings(matches(spark, sf)).withColumn("note", F.when(F.col("wins") % 2 == 0, F.concat(F.lit('a "b", '), "team")))
    files.write_csv(s, path, ["season", "competition", "team", "points", "note"])
    return files.read_csv(spark, path, "season int, competition string, team string, points long, note string")


def sink_csv_union(spark: SparkSession, sf: str) -> DataFrame:
    path = work_folder(spark, "union")
    a = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    files.write_csv(a.unionByName(table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_nationkey AS nation"), allowMissingColumns=True), path)
    return files.read_csv(spark, path, "id long, name string, nation int")


def sink_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    path = work_folder(spark, "jsonl")
    table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment").write.json(path)
    return spark.read.schema("c_custkey long, c_name string, c_mktsegment string").json(path)


def sink_audit_and_status(spark: SparkSession, sf: str) -> DataFrame:
    """Three attempts: the standings, the same rows again (no new version) and rows that fail their audit."""
    path = work_folder(spark, "audited")
    s = ledger.standings(matches(spark, sf))

    def audit(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("rows"), F.when(F.sum("goals_for") == F.sum("goals_against"), "PASS").otherwise("FAIL").alias("status"))

    publish.publish(s, path, audit)
    publish.publish(s.repartition(3), path, audit)
    try:
        publish.publish(s.withColumn("goals_for", F.col("goals_for") + 1), path, audit)
    except publish.AuditFailed:
        pass
    counts = publish.read_published(spark, path).agg(F.count("*").alias("visible_rows"))
    tried = publish.audits(spark, path).agg(F.count("*").alias("attempts"), F.count_if(F.col("status") == "FAIL").alias("failed"))
    return publish.manifests(spark, path).select("version", "rows", "status").crossJoin(counts).crossJoin(tried)


def _digest(trailing: bool):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        d = table(spark, sf, "documents")
        return files.bundle_digest(d, "source", F.col("doc_id").cast("string"), F.octet_length("text"), F.sha2("text", 256), trailing)

    return run


def freeze_compare(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    frozen = d.where("doc_id % 10 <> 0").select(F.when(F.col("doc_id") % 10 == 1, -F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"),
                                                F.when(F.col("doc_id") % 10 == 2, "old").otherwise(F.col("sha")).alias("sha"))
    return files.freeze_compare(d, frozen, "doc_id", "sha")


_LINE = "doc_id || chr(9) || strlen(text) || chr(9) || sha256(text)"
_OBS = """a AS (SELECT l_orderkey AS subject, strftime(l_shipdate, '%Y') AS day, CASE WHEN l_partkey % 13 = 0 THEN 'NOT_FOUND' WHEN l_suppkey % 7 = 0 THEN 'NOT_BOUND' WHEN l_quantity <= 3 THEN 'NO_NAME'
  WHEN l_returnflag = 'R' THEN 'NAME_MISMATCH' WHEN l_linenumber % 3 = 0 THEN 'NO_DATE' WHEN l_linenumber % 3 = 2 THEN 'AMBIGUOUS_DATE' ELSE 'ACCEPTED' END AS status FROM lineitem)"""
_KEYS = """cur AS (SELECT c_custkey, 's' || c_custkey AS subject, CASE WHEN c_custkey % 4 = 0 THEN 'p' || (c_custkey % 100) END AS bridge, CASE WHEN c_custkey % 3 = 0 THEN 'Q' || (c_custkey % 500) END AS entity FROM customer),
  own AS (SELECT 'Q' || (c_custkey % 350) AS entity, min('p' || (c_custkey % 700)) AS owner FROM customer WHERE c_nationkey % 2 = 0 GROUP BY 1 HAVING count(DISTINCT c_custkey % 700) = 1),
  keys AS (SELECT c_custkey, subject, coalesce(bridge, owner, 'entity:' || entity, 'self:' || subject) AS person, CASE WHEN bridge IS NOT NULL THEN 'BRIDGE' WHEN owner IS NOT NULL THEN 'UNIQUE_ENTITY' WHEN entity IS NOT NULL THEN 'ENTITY' ELSE 'OWN' END AS method FROM cur LEFT JOIN own USING (entity))"""
_MASTER = _KEYS + """, mr AS (SELECT person, method, c_custkey, c_custkey % 2 AS scope, subject, c_mktsegment AS name, CASE WHEN c_custkey % 41 = 0 THEN 'CONFLICT' WHEN c_custkey % 5 = 0 THEN 'OPEN' ELSE 'VERIFIED' END AS st, '1990-01-0' || (c_custkey % 2 + 1) AS d FROM keys JOIN customer USING (c_custkey)),
  al AS (SELECT person, count(DISTINCT o_orderpriority) AS aliases, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS alias_ids FROM keys JOIN orders ON o_custkey = c_custkey GROUP BY 1),
  ma AS (SELECT person, count(DISTINCT scope) AS scopes, count(*) AS subjects, count(DISTINCT name) AS names, arg_min(name, (c_custkey, name)) AS first_name, string_agg(DISTINCT name, ',' ORDER BY name) AS name_list, bool_or(st = 'CONFLICT') AS c,
    count(DISTINCT d) FILTER (st = 'VERIFIED') AS n, min(d) FILTER (st = 'VERIFIED') AS f FROM mr GROUP BY 1),
  m AS (SELECT person, scopes, subjects, names, coalesce(aliases, 0) AS aliases, subjects AS evidence, first_name, CASE WHEN c THEN 'CONFLICT' WHEN n > 1 THEN 'ERROR' WHEN n = 1 THEN 'VERIFIED' ELSE 'MISSING' END AS status, CASE WHEN NOT c AND n = 1 THEN f END AS day,
    coalesce(alias_ids, '') AS alias_ids, name_list, subjects AS listed_evidence FROM ma LEFT JOIN al USING (person))"""
_OVER = """o AS (SELECT o_orderkey AS subject, CASE WHEN o_orderkey % 7 = 0 THEN 'DOB_CONFLICT' WHEN o_orderkey % 5 = 0 THEN 'OPEN' WHEN o_orderkey % 3 = 0 THEN 'NONDAY' WHEN o_orderstatus = 'P' THEN 'UNACCOUNTED' ELSE 'FIRST' END AS status,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'open' WHEN o_orderkey % 3 = 0 THEN 'nonday' WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderkey % 7 = 0 THEN 3 WHEN o_orderkey % 5 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS origin FROM orders)"""
_UNITS = """u0 AS (SELECT s_suppkey % 60 AS unit, 'n' || (s_suppkey % 120) AS name, CASE WHEN s_suppkey % 60 < 20 THEN 'd' || (s_suppkey % 7) ELSE 'd' END AS d FROM supplier),
  u AS (SELECT unit, 'unit-v1-' || substr(sha256(unit::VARCHAR), 1, 24) AS unit_key, count(DISTINCT name) AS names, CASE WHEN count(DISTINCT d) <> 1 THEN 'NO_CONSENSUS' WHEN count(DISTINCT name) > 1 THEN 'MULTIPLE_NAMES_SAME_DATE' ELSE 'SINGLE' END AS status, CASE WHEN count(DISTINCT d) = 1 THEN min(d) END AS day FROM u0 GROUP BY unit)"""

QUERIES = {
    "name_candidate_join": (name_candidate_join, """WITH s AS (SELECT p_partkey AS subject, p_partkey % 50 = 0 AS failed, unnest([split_part(p_name, ' ', 1) || p_size, p_name]) AS name FROM part),
      e AS (SELECT 'Q' || p_partkey AS entity, split_part(p_name, ' ', 1) || (p_size % 40) || CASE WHEN p_partkey % 9 = 0 THEN '' ELSE 'x' END AS name FROM part WHERE p_partkey % 2 = 1),
      a AS (SELECT subject, failed, count(DISTINCT entity) AS n, min(entity) AS e FROM s LEFT JOIN e USING (name) GROUP BY ALL)
      SELECT subject, n, CASE WHEN n = 1 THEN e END AS entity, CASE WHEN failed THEN 'TECHNICAL_FAILURE' WHEN n = 1 THEN 'VERIFIED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS status FROM a"""),
    "club_context_resolve": (club_context_resolve, """WITH c AS (SELECT DISTINCT l_orderkey AS subject, l_suppkey AS entity FROM lineitem), s AS (SELECT DISTINCT o_orderkey AS subject, o_custkey % 40 AS club FROM orders),
      o AS (SELECT DISTINCT l_suppkey AS entity, l_partkey % 40 AS club FROM lineitem WHERE l_linenumber = 1 AND l_quantity > 40), x AS (SELECT DISTINCT subject, entity FROM c JOIN s USING (subject) JOIN o USING (entity, club)),
      g AS (SELECT subject, count(*) AS k, min(entity) AS e FROM x GROUP BY 1)
      SELECT subject, coalesce(k, 0) AS in_context, CASE WHEN k = 1 THEN e END AS entity, CASE WHEN k = 1 THEN 'RESOLVED' ELSE 'AMBIGUOUS' END AS status FROM (SELECT DISTINCT subject FROM c) LEFT JOIN g USING (subject)"""),
    "dob_statement_choice": (dob_statement_choice, """WITH s AS (SELECT o_custkey AS subject, o_orderkey AS statement, CASE o_orderstatus WHEN 'P' THEN 'preferred' WHEN 'O' THEN 'deprecated' ELSE 'normal' END AS rank, (year(o_orderdate) % 3)::INTEGER AS time, CASE WHEN o_orderkey % 20 = 0 THEN 9 ELSE 11 END AS precision,
        bool_or(o_orderstatus = 'P') OVER (PARTITION BY o_custkey) AS p FROM orders), u AS (SELECT * FROM s WHERE CASE WHEN p THEN rank = 'preferred' ELSE rank <> 'deprecated' END),
      g AS (SELECT subject, count(DISTINCT (time, precision)) AS n, min(statement) AS statement, arg_min(time, statement) AS time, arg_min(precision, statement) AS precision FROM u GROUP BY 1)
      SELECT subject, CASE WHEN n = 1 THEN 'VERIFIED' WHEN n > 1 THEN 'CONFLICT' ELSE 'MISSING' END AS status, CASE WHEN n = 1 THEN statement END AS statement, CASE WHEN n = 1 THEN time END AS time, CASE WHEN n = 1 THEN precision END AS precision
      FROM (SELECT DISTINCT subject FROM s) LEFT JOIN g USING (subject)"""),
    "day_dates_of_statements": (day_dates_of_statements, "SELECT o_custkey AS subject, string_agg(DISTINCT strftime(o_orderdate, '%Y-%m-%d'), ',' ORDER BY strftime(o_orderdate, '%Y-%m-%d')) AS days FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1"),
    "observation_status": (observation_status, f"WITH {_OBS} SELECT status, count(*) AS n FROM a GROUP BY 1"),
    "observation_consensus": (observation_consensus, f"""WITH {_OBS}, g AS (SELECT subject, count(*) AS c, count(*) FILTER (status = 'ACCEPTED') AS k, count(DISTINCT day) FILTER (status = 'ACCEPTED') AS n, min(day) FILTER (status = 'ACCEPTED') AS d FROM a GROUP BY 1)
      SELECT o_orderkey AS subject, coalesce(c, 0) AS observations, coalesce(k, 0) AS accepted, CASE WHEN n = 1 THEN d END AS day, CASE WHEN n = 1 THEN 'VERIFIED' WHEN n > 1 THEN 'CONFLICT' ELSE 'UNRESOLVED' END AS status FROM orders LEFT JOIN g ON subject = o_orderkey"""),
    "conflict_resolution": (conflict_resolution, f"""WITH {_OBS}, g AS (SELECT subject, list(DISTINCT day) AS d FROM a WHERE status = 'ACCEPTED' GROUP BY 1)
      SELECT o_orderkey AS subject, CASE WHEN d IS NULL THEN 'UNRESOLVED' WHEN len(d) > 1 THEN 'CONFLICT_REMAINS' WHEN d[1]::INT - year(o_orderdate) IN (0, 1) THEN 'RESOLVED' ELSE 'NEW_CONFLICT' END AS status FROM orders LEFT JOIN g ON subject = o_orderkey"""),
    "signature_clusters": (signature_clusters, """WITH r AS (SELECT p_partkey % 300 AS provider, p_partkey % 4 = 0 AS v, CASE WHEN p_partkey % 4 = 0 THEN array_to_string(list_sort(string_split(p_name, ' ')), ' ') || '|' || (p_size % 3) END AS s FROM part)
      SELECT provider, count(*) AS rows, count(*) FILTER (v) AS verified, count(DISTINCT s) AS signatures, CASE count(DISTINCT s) WHEN 0 THEN 'NONE' WHEN 1 THEN 'SINGLE' ELSE 'MULTIPLE' END AS cluster FROM r GROUP BY 1"""),
    "cross_scope_overlap": (cross_scope_overlap, "SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS scopes, count(DISTINCT o_orderkey) AS members, min(o_orderkey) AS first_member FROM orders WHERE year(o_orderdate) IN (1995, 1996) GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) > 1"),
    "override_precedence": (override_precedence, f"WITH {_OVER} SELECT * FROM o"),
    "person_key_cascade": (person_key_cascade, f"WITH {_KEYS} SELECT subject, person, method FROM keys"),
    "identity_master": (identity_master, f"WITH {_MASTER} SELECT * FROM m"),
    "provider_units": (provider_units, f"WITH {_UNITS} SELECT * FROM u"),
    "registry_counts": (registry_counts, f"""WITH {_MASTER}, {_OVER}, {_UNITS} SELECT 'persons' AS scope, status, count(*) AS n, NULL AS key FROM m GROUP BY ALL UNION ALL SELECT 'overrides', status, count(*), NULL FROM o GROUP BY ALL UNION ALL SELECT 'units', status, count(*), NULL FROM u GROUP BY ALL
      UNION ALL SELECT 'persons', status, 1, person FROM m WHERE status IN ('CONFLICT', 'ERROR') UNION ALL SELECT 'overrides', status, 1, subject::VARCHAR FROM o WHERE status = 'UNACCOUNTED' UNION ALL SELECT 'units', status, 1, unit_key FROM u WHERE status = 'NO_CONSENSUS'"""),
    "src_json_records": (src_json_records, "SELECT c_custkey, c_name FROM customer"),
    "src_csv_rounds": (src_csv_rounds, """SELECT year(l_shipdate)::INTEGER AS year, l_linenumber AS round, count(*) AS rows, count(DISTINCT l_partkey) AS ids, sum(l_orderkey)::BIGINT AS orders, sum(l_partkey)::BIGINT AS parts,
      count(*) FILTER (l_linenumber % 2 = 1) AS with_supplier FROM lineitem GROUP BY ALL"""),
    "year_profile": (year_profile, """SELECT year(l_shipdate)::INTEGER AS year, count(DISTINCT l_linenumber) AS files, count(*) AS rows, count(DISTINCT l_partkey) AS ids, min(l_linenumber) AS min_round, max(l_linenumber) AS max_round,
      CASE WHEN bool_or(l_linenumber % 2 = 1) THEN 'l_orderkey,l_partkey,l_suppkey' ELSE 'l_orderkey,l_partkey' END AS columns, 'CSV_ROUND_SNAPSHOT' AS format FROM lineitem GROUP BY 1 UNION ALL SELECT 1900, 0, 0, 0, NULL, NULL, '', 'UNRECOGNIZED'"""),
    "src_json_legacy_charset": (src_json_legacy_charset, "SELECT c_custkey::INTEGER AS k, 'é' || c_name AS n, (c_custkey // 100) % 2 = 1 AS utf8, (c_custkey // 100)::INTEGER AS slot FROM customer"),
    "src_chunked_payload": (src_chunked_payload, """SELECT doc_id, CASE doc_id % 10 WHEN 3 THEN 'CHUNK_DAMAGED' WHEN 4 THEN 'CHUNK_MISSING' WHEN 5 THEN 'HASH_DIFFERS' WHEN 6 THEN 'UNLISTED' ELSE 'INTACT' END AS state,
      CASE WHEN doc_id % 10 NOT BETWEEN 3 AND 6 THEN sha256(text) END AS sha256 FROM documents"""),
    "src_archive_inventory": (src_archive_inventory, """SELECT c_nationkey || '-' || c_custkey % 16 AS archive, c_nationkey || '/' || c_name || '.txt' AS member, strlen(c_name) AS size, sha256(c_name) AS sha256, 'OK' AS state FROM customer WHERE c_nationkey <> 3
      UNION ALL SELECT DISTINCT '3-' || c_custkey % 16, NULL, NULL, NULL, 'NO_ARCHIVE' FROM customer WHERE c_nationkey = 3"""),
    "sink_csv_fixed": (sink_csv_fixed, f"WITH {STANDINGS} SELECT season, competition, team, points, CASE WHEN wins % 2 = 0 THEN 'a \"b\", ' || team END AS note FROM standings"),
    "sink_csv_union": (sink_csv_union, "SELECT c_custkey AS id, c_name AS name, NULL::INTEGER AS nation FROM customer UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier"),
    "sink_jsonl": (sink_jsonl, "SELECT c_custkey, c_name, c_mktsegment FROM customer"),
    "sink_audit_and_status": (sink_audit_and_status, f"WITH {STANDINGS} SELECT 1 AS version, count(*) AS rows, 'PASS' AS status, count(*) AS visible_rows, 3 AS attempts, 1 AS failed FROM standings"),
    "file_manifest": (_digest(False), f"SELECT source, count(*) AS files, sha256(string_agg({_LINE}, chr(10) ORDER BY doc_id::VARCHAR)) AS digest FROM documents GROUP BY 1"),
    "file_manifest_trailing": (_digest(True), f"SELECT source, count(*) AS files, sha256(string_agg({_LINE}, chr(10) ORDER BY doc_id::VARCHAR) || chr(10)) AS digest FROM documents GROUP BY 1"),
    "freeze_compare": (freeze_compare, "SELECT doc_id, CASE WHEN doc_id % 10 IN (0, 1) THEN 'new' WHEN doc_id % 10 = 2 THEN 'changed' ELSE 'unchanged' END AS state FROM documents UNION ALL SELECT -doc_id, 'missing' FROM documents WHERE doc_id % 10 = 1"),
}
