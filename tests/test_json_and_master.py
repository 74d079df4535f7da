"""Streamed JSON nodes, shapes of payloads, sketches, the identity master in parts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import nested as N
from ledgerloom.operators import audit, master


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_stream_gives_the_nodes_of_the_tree():
    r = random.Random(0)

    def make(depth):
        k = r.randint(0, 7 if depth else 5)
        if k == 6:
            return {"a" * r.randint(1, 3) + str(i): make(depth - 1) for i in range(r.randint(0, 4))}
        if k == 7:
            return [make(depth - 1) for _ in range(r.randint(0, 4))]
        return r.choice([None, True, False, 0, -1, 1.5, 1e300, -2e-7, "", 'é\n"\\', "x" * 20, 10**30])

    for _ in range(1500):
        node = make(4)
        text = json.dumps(node, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1]))
        assert list(N.stream(text)) == list(N.walk(node))
        if len(text) > 2:
            i = r.randrange(len(text))
            broken = text[:i] + r.choice('{}[],:"x1 ') + text[i + r.randint(0, 1) :]
            try:
                json.loads(broken)
            except ValueError:
                with pytest.raises(ValueError):
                    list(N.stream(broken))
            else:
                list(N.stream(broken))


def test_rows_of_nodes(spark):
    deep = "[" * 3000 + "]" * 3000
    df = spark.createDataFrame([(1, "a", '{"k": [1, {"k": null}], "k": "é"}'), (2, None, "oops"), (3, "c", None), (4, "d", '"root"'), (5, "e", deep)], "id int, path string, j string").withColumnRenamed("path", "mark")
    got = N.walk_rows(df.where("id < 5"), ["id", "mark"], "j", rows=2).collect()
    assert [tuple(r) for r in got] == [(1, "a", "k", "k", "array", None), (1, "a", "k[0]", None, "number", "1"), (1, "a", "k[1]", None, "object", None), (1, "a", "k[1].k", "k", "null", None), (1, "a", "k", "k", "string", "é")]
    assert N.walk_rows(df.where("id = 5"), ["id"], "j").count() == 2999
    assert N.walk_rows(df.limit(0), ["id"], "j").collect() == []


def test_a_long_document_leaves_in_batches(spark):
    """A document of some megabytes: its nodes are never one row."""
    one = '{"id": 1, "name": "player", "tags": ["a", "b"]}'
    df = spark.range(1).select(F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit(one), 60_000), ","), F.lit("]")).alias("j"))
    got = N.walk_rows(df, [], "j").groupBy("kind").agg(F.count("*").alias("n"))
    assert rows(got) == [("array", 60_000), ("number", 60_000), ("object", 60_000), ("string", 180_000)]


def test_shapes(spark):
    df = spark.createDataFrame([("g", '{"l":[{"x":[1],"a":2},2],"p":[],"q":"s","z":null}'), ("g", "[true]"), ("h", "bad"), ("h", None), ("h", '"s"'), ("g", '{"l":[1.5]}'), ("g", '{"l":[1.5]}')], "g string, j string")
    got = rows(N.schema_profile(df, "j", ["l", "p", "q", "z", "no"], ["g"]))
    assert got == sorted([
        ("g", "$", "object", 4, None, "l,p,q,z", None, 1), ("g", "$", "array", 1, "boolean", None, None, 1), ("g", "$", "object", 1, None, "l", None, 2),
        ("g", "l", "array", 2, "object", "a,x", "ARRAY<VARIANT>", 1), ("g", "l", "array", 1, "number", None, "ARRAY<DECIMAL(2,1)>", 2), ("g", "p", "array", 0, None, None, "ARRAY<VOID>", 1),
        ("g", "q", "string", None, None, None, "STRING", 1), ("g", "z", "null", None, None, None, "VOID", 1),
        ("h", "$", "invalid", None, None, None, None, 1), ("h", "$", "missing", None, None, None, None, 1), ("h", "$", "string", None, None, None, None, 1)], key=str)
    df = spark.createDataFrame([('{"a":1,"b":{"c":"x"}}',), ('{"a":2.5,"b":{"c":[1]}}',), ("bad",)], "j string").withColumn("g", F.lit("all"))
    assert rows(N.merged_schema(df, "j", ["g"])) == [("all", "OBJECT<a: DECIMAL(11,1), b: OBJECT<c: VARIANT>>", 2, 1)] or rows(N.merged_schema(df, "j", ["g"]), "g", "payloads", "conflicts") == [("all", 2, 1)]


def test_sketches_within_their_error(spark):
    days = spark.range(40_000).selectExpr("id % 4 AS g", "id % 10 AS day", "cast(id % 9000 AS int) AS a", "if(id % 7 = 0, null, cast(id % 30 AS string)) AS b")
    sketches = audit.distinct_sketches(days, ["g", "day"], {"one": ["a"], "two": ["a", "b"]})
    assert sketches.count() == 20  # g and day share a parity
    exact = {r.g: r for r in audit.distinct_counts(days, ["g"], {"one": ["a"], "two": ["a", "b"]}).collect()}
    for r in audit.united_counts(sketches, ["g"], ["one", "two"]).collect():
        assert abs(r.one - exact[r.g].one) <= 0.05 * exact[r.g].one and abs(r.two - exact[r.g].two) <= 0.05 * exact[r.g].two
    plan = sketches._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


FACTS = "person string, seq long, scope string, subject string, name string, method string, source_status string, status string, day string, dob_method string"
ALIASES = "person string, seq long, provider string, provider_id string, scope string"


def test_master_rules(spark):
    data = [
        ("p", 2, "cur", "s2", "Second", "KEY", "OK", "VERIFIED", "1990-01-01", "m"), ("p", 1, "his", "s1", "First", "KEY", "OK", "OPEN", None, None), ("p", 3, "his", "s1", "First", "KEY", "OK", "OPEN", None, None),
        ("q", 1, "cur", "s3", "", "KEY", "OK", "VERIFIED", "1990-01-01", "m"), ("q", 2, "cur", "s4", None, "KEY", None, "VERIFIED", "1990-01-02", "m"),
        ("r", 1, "cur", "s5", "R", "KEY", "OK", "CONFLICT", None, "m"), ("r", 1, "cur", "s6", "R", "KEY", "OK", "VERIFIED", "1990-01-02", "m"), ("t", 1, "cur", "s7", "T", "KEY", "OK", None, None, None),
    ]
    alias = [("p", 5, "W", "Q1", "ENTITY"), ("p", 4, "W", "Q1", "ENTITY"), ("p", 6, "U", "7", "BRIDGE"), ("q", 1, "W", None, "ENTITY")]
    facts = master.person_facts(spark.createDataFrame(data, FACTS), spark.createDataFrame(alias, ALIASES))
    assert rows(master.identity_master(facts)) == sorted([
        ("p", 2, 2, 2, 2, 2, "First", "VERIFIED", "1990-01-01"), ("q", 1, 2, 0, 0, 2, None, "ERROR", None), ("r", 1, 2, 1, 0, 2, "R", "CONFLICT", None), ("t", 1, 1, 1, 0, 1, "T", "MISSING", None)], key=str)
    doc = {r.person: r for r in master.person_documents(facts).collect()}["p"]
    assert [a.provider_id for a in doc.alias] == ["Q1", "7"] and [n.name for n in doc.name] == ["First", "Second"] and [e.seq for e in doc.evidence] == [1, 2] and doc.parts == 1
    assert doc.ref[0].asDict() == {"scope": "his", "subject": "s1", "method": "KEY", "source_status": "OK", "seq": 1}
    assert master.identity_master(facts.limit(0)).collect() == master.person_documents(facts.limit(0)).collect() == []


def test_a_person_of_many_rows_is_many_parts(spark):
    many = spark.range(30_000).selectExpr("'hot' AS person", "id AS seq", "'cur' AS scope", "concat('s', id % 5000) AS subject", "'n' AS name", "'k' AS method", "'ok' AS source_status",
                                          "'OPEN' AS status", "cast(null AS string) AS day", "'m' AS dob_method")
    none = spark.createDataFrame([], ALIASES)
    facts = master.person_facts(many, none)
    assert facts.count() == 10_002
    docs = master.person_documents(facts, 1000)
    sizes = [r[0] for r in docs.select(F.size("evidence") + F.size("ref")).collect()]
    assert len(sizes) == 11 and sum(sizes) == 10_000 and max(sizes) < 1200
    assert rows(master.identity_master(facts)) == [("hot", 1, 5000, 1, 0, 5000, "n", "MISSING", None)]
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1  # facts are combined before they are shuffled


def test_residual_lists(spark):
    a = spark.createDataFrame([(1, "OK"), (2, "BAD"), (3, None)], "k int, status string")
    assert rows(master.registry_residuals({"x": (a, "k", ["BAD", "WORSE"]), "y": (a, "k", [])})) == [("x", "BAD", "2")]
