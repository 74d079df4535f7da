"""Small cases of the record, request, audit, text and source operators: nulls, ties, repeated rows, empty tables."""

import gzip
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import nested as N
from ledgerloom.functions import text as T
from ledgerloom.operators import audit, evidence, ledger, providers, records, requests
from ledgerloom.sources import files, shared


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_missing_keys(spark):
    df = spark.createDataFrame([("a", '{"k":1}'), ("a", '{"k":1,"m":null}'), ("b", "[1]"), ("b", None)], "g string, j string")
    assert rows(records.missing_keys(df, "j", ["k", "m"], ["g"])) == [("a", "m", 1), ("b", "k", 2), ("b", "m", 2)]


def test_projections(spark):
    df = spark.createDataFrame([(1, [2], (3,), {"k": 4}, "x.y", None), (2, None, None, None, None, "z")], "a int, b array<int>, c struct<d:int>, m map<string,int>, `e.f` string, g string")
    assert records.scalar_columns(df).columns == ["a", "e.f", "g"]
    out = records.allowlist(df, {"id": [F.col("a")], "status": [F.col("`e.f`"), F.col("g")]}, ("path", [F.lit("p"), F.col("a"), F.col("`e.f`")]))
    assert rows(out) == [(1, "x.y", "p/1/x.y"), (2, "z", None)]


def test_open_records_keep_nulls(spark):
    df = spark.createDataFrame([(1, "V", "V"), (2, "V", None), (3, None, "V"), (4, "W", "V")], "id int, a string, b string")
    assert [r[0] for r in rows(records.open_records(df, {"a": "V", "b": "V"}))] == [2, 3, 4]


def test_residuals(spark):
    df = spark.createDataFrame([("x", 1, True), ("x", 1, None), ("y", 2, False)], "scope string, s int, t boolean")
    got = rows(records.route_residuals(df, "scope", "s", {"yes": F.col("t"), "no": ~F.col("t")}))
    assert got == sorted([("x", 1, 0, 1), ("y", 0, 1, 1), (None, 1, 1, 2)], key=str)


def test_availability_in_order(spark):
    df = spark.createDataFrame([(True, True, True, True), (True, False, True, True), (False, True, True, True), (False, True, True, False), (False, False, False, False)],
                               "missing boolean, required boolean, corrupt boolean, mismatch boolean")
    status = records.availability(*[F.col(c) for c in df.columns])
    assert [r[0] for r in df.select(status).collect()] == ["FAILED_REQUIRED", "UNAVAILABLE_OPTIONAL", "NAME_MISMATCH", "CORRUPT", "AVAILABLE"]


def test_scope_snapshots(spark):
    df = spark.createDataFrame([(1, 1, 5, True), (1, 2, 6, True), (1, 2, 9, False)], "e int, r int, v int, ok boolean")
    got = rows(records.scope_snapshots(df, "e", F.col("r"), F.col("ok"), [F.sum("v").alias("v")]), "e", "scope", "round", "v")
    assert got == sorted([(1, "total", None, 11), (1, "round", 1, 5), (1, "round", 2, 6)], key=str)


def test_ids_and_keys(spark):
    df = spark.createDataFrame([('{"id":"x","pid":7}',), ("go/user/12/x",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(records.extract_id(F.col("t"), ["id", "pid"], [r"user/(\d+)"])).collect()] == [7, 12, None, None]
    df = spark.createDataFrame([("own", "5", "s#9"), (None, "5", "s#9"), (None, "5a", "s#009"), (None, None, "s")], "a string, b string, c string")
    assert [r[0] for r in df.select(records.bridge_key(F.col("a"), F.col("b"), F.col("c"), r"#0*(\d+)$")).collect()] == ["own", "provider:5", "provider:9", None]
    df = spark.createDataFrame([("League",), ("P1",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(records.classify(F.col("t"), {"league": ["league"]}, {"P": "cup"})).collect()] == ["league", "cup", "other", "other"]
    df = spark.createDataFrame([(1, "k1"), (2, None), (2, "k2")], "n int, given string")
    assert tuple(records.technical_ids(df, F.concat(F.lit("k"), "n"), "given").first()) == (3, 1, False)
    assert tuple(records.technical_ids(df.where("false"), F.concat(F.lit("k"), "n"), "given").first()) == (0, 0, True)


def test_checks_and_filters(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    assert rows(records.record_checks(df, {"x": F.col("a") > 0, "y": F.col("b") > 0}), "a", "x", "y", "status") == [(1, True, False, "REVIEW"), (2, True, True, "VERIFIED")]
    df = spark.createDataFrame([("http://h/en/12/x?y=3",), ("http://h/en/123",)], "u string")
    assert [r[0] for r in df.select(records.expected_path(F.col("u"), [F.lit("en"), F.lit("12")])).collect()] == [True, False]
    df = spark.createDataFrame([("England",), ("Malta",), (None,)], "n string")
    assert [r[0] for r in df.select(records.country_codes(F.col("n"), {"England": "ENG"})).collect()] == ["ENG", "MAL", None]


def test_requests(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    assert rows(requests.missing_entities(a, b, "k")) == [(2,), (None,)]
    assert rows(requests.backjoin(a, b.where("v <> 'y'"), "k", "v"), "k", "earlier") == [(1, "x"), (2, "MISSING"), (None, "MISSING")]
    e, m = spark.createDataFrame([(1,), (2,), (2,)], "e int"), spark.createDataFrame([("p",), ("q",)], "m string")
    got = spark.createDataFrame([(1, "q", 5), (2, "p", 1)], "e int, m string, n int")
    assert rows(requests.grid(e, m, got, "e", "m", "n", F.col("n") >= 2), "e", "m", "n", "valid", "mode") == [
        (1, "p", 0, False, "q"), (1, "q", 5, True, "q"), (2, "p", 1, False, None), (2, "q", 0, False, None)]
    s = spark.createDataFrame([(1, 1996), (1, 1996), (1, 1997), (2, None)], "p int, y int")
    assert rows(requests.request_plan(s, "p", "y", [1996], ["a", "b"])) == [(1, 1996, "a"), (1, 1996, "b")]
    li = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "c", 5), (2, "c", 5)], "s int, i string, y int")
    assert rows(requests.observation_routes(li, "s", "i", "y")) == [(1, "a", 5), (1, "a", 6), (1, "b", 5), (1, "b", 6), (2, "c", 5)]
    want = requests.coverage_rate(li, spark.createDataFrame([("a", 5), ("a", 5)], "i string, y int"), ["i", "y"], ["s"])
    assert rows(want) == [(1, 2, 1, 0.5), (2, 2, 0, 0.0)]


def test_audit_counts(spark):
    df = spark.createDataFrame([("1-a", 1, 1, 5), ("1-b", 1, 2, 6), ("2-a", None, 3, 5)], "p string, u int, i int, o int")
    assert rows(audit.distinct_counts(df.withColumn("g", F.lit(1)), ["g"], {"users": ["u"], "pairs": ["u", "i"]})) == [(1, 1, 2)]
    assert rows(audit.suffix_counts(df, "p", r"^(\d+)-", F.col("u").isNotNull())) == [("1", 2, 2), ("2", 1, 0)]
    assert rows(audit.precision_counts(df, "o", "i")) == [(5, 2, 1), (6, 1, 2)]
    assert rows(audit.attempt_counts(df, "u", "o")) == sorted([(1, 5, 1), (1, 6, 1), (None, 5, 1), (None, 5, 2), (None, 6, 1)], key=str)


def test_audit_picks(spark):
    df = spark.createDataFrame([("s", "b", 2), ("s", "a", 3), ("t", "a", 1), (None, "a", 0), (None, "b", 9)], "sha string, src string, id int")
    assert rows(audit.repeated_payload(df, "sha", ["src", "id"]), "id", "duplicate") == [(0, False), (1, False), (2, True), (3, False), (9, False)]
    df = spark.createDataFrame([("e", s, i) for i, s in enumerate("aabbcacddeefg")], "e string, s string, o int")
    assert rows(audit.prior_scopes(df, "e", "s", "o").groupBy("s").count()) == [("b", 2), ("c", 2), ("d", 2), ("e", 2), ("f", 1)]
    assert rows(audit.ordered_distinct(df, "e", "s", "o", "x")) == [("e", "a,b,c,d,e,f,g")]
    df = spark.createDataFrame([(1, 1, None), (1, 2, 7), (1, 3, 8), (2, 4, None), (2, 5, None)], "k int, o int, v int")
    assert rows(audit.pick_leaf(df, ["k"], F.col("v"), "o", "stat")) == [(1, 2, 7), (2, 4, None)]
    df = spark.createDataFrame([(1, 5, 3, 1), (1, 5, 2, 9), (1, 4, 1, 1)], "k int, s int, a int, b int")
    assert rows(audit.argmax(df, ["k"], "s", ["a", "b"])) == [(1, 2, 9)]


def test_audit_sets(spark):
    a, b = spark.createDataFrame([(1, "x", None)], "id int, n string, never string"), spark.createDataFrame([(2, 0.5)], "id int, v double")
    assert rows(audit.union_aligned([a, b])) == [(1, "x", None, None), (2, None, None, 0.5)]
    assert rows(audit.union_fields([a, b])) == [("id",), ("n",), ("v",)]
    left, right = (spark.createDataFrame(r, "g int, d int") for r in ([(1, 1), (1, 2), (1, 2), (2, 5), (3, 1)], [(1, 2), (1, 3), (2, 6), (4, 1)]))
    assert rows(audit.common_values(left, right, "g", "d")) == [(1, 1, 2), (2, 0, None)]
    assert rows(audit.new_rows(left, right)) == [(1, 1), (1, 2), (2, 5), (3, 1)]
    df = spark.createDataFrame([(1, None, 7), (2, "x", 8), (1, None, 3)], "b int, a string, o int")
    assert rows(audit.first_structs(df, ["b", "a"], "o")) == [('{"a":"x","b":2}', 8), ('{"a":null,"b":1}', 3)]
    df = spark.createDataFrame([(1, "b"), (2, "É"), (3, "a"), (4, "f"), (5, "a")], "id int, n string").withColumn("g", F.lit(0))
    assert rows(audit.locale_position(df, ["g"], "n", "id"), "position", "id") == [(1, 3), (2, 5), (3, 1), (4, 2), (5, 4)]


@pytest.mark.parametrize("n", [0, 1, 700])
def test_global_index_has_no_gaps(spark, n):
    df = spark.range(n).select((F.col("id") % 7).alias("g"), (F.col("id") * 31 % 101).alias("w"), "id")
    got = audit.global_index(df, ["g"], ["w", "id"]).orderBy("global_index").collect()
    assert [r.global_index for r in got] == list(range(n)) and [(r.g, r.w, r.id) for r in got] == sorted((r.g, r.w, r.id) for r in got)


def test_duplicate_summary(spark):
    df = spark.createDataFrame([(i % 40, i % 3) for i in range(120)] + [(99, 1)] * 4, "a int, b int")
    r = audit.duplicate_summary(df, ["a", "b"], 2).first()
    assert (r["keys"], r.extra, r.examples) == (1, 3, "99|1")
    df = df.where("a < 40").unionByName(df.where("a < 40"))
    r = audit.duplicate_summary(df, ["a", "b"], 3).first()
    assert (r["keys"], r.extra, r.examples) == (120, 120, "0|0,0|1,0|2")
    assert tuple(audit.duplicate_summary(df.where("false"), ["a", "b"]).first()) == (0, 0, "")


def test_evidence(spark):
    s = spark.createDataFrame([(1, "+1990-01-02T00:00:00Z", 11), (1, "+1990-01-02T00:00:00Z", 11), (1, "1989-05-05T00:00:00Z", 11), (1, "+1991-00-00T00:00:00Z", 9), (2, "x", 11)], "subject int, t string, p int")
    assert rows(evidence.day_dates(s, "t", "p")) == [(1, "1989-05-05,1990-01-02"), (2, "")]
    subjects = spark.createDataFrame([(1, False, ["A", "B"]), (2, False, ["B", "A"]), (3, True, ["C"]), (4, False, []), (5, False, None), (6, False, ["D"])], "subject int, failed boolean, names array<string>")
    entities = spark.createDataFrame([("Q1", ["A", "B"], ["h"]), ("Q2", ["C", "C"], ["h"]), ("Q3", ["D"], ["x"])] + [(f"E{i}", ["D"], ["h"]) for i in range(50)], "entity string, names array<string>, claims array<string>")
    got = rows(evidence.name_candidates(subjects, entities, ["h"]))
    assert got == [(1, 1, "Q1", "VERIFIED"), (2, 1, "Q1", "VERIFIED"), (3, 1, "Q2", "TECHNICAL_FAILURE"), (4, 0, None, "UNRESOLVED"), (5, 0, None, "UNRESOLVED"), (6, 50, None, "AMBIGUOUS")]


def test_reach_ends_on_cycles(spark):
    seeds = spark.createDataFrame([("a", "p"), ("x", "q")], "node string, page string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("a", "d"), ("a", "b")], "parent string, child string")
    assert rows(providers.reach(seeds, edges)) == sorted([("a", "p", 0), ("b", "p", 1), ("d", "p", 1), ("c", "p", 2), ("x", "q", 0)], key=str)
    assert rows(providers.reach(seeds, edges, 1)) == [("a", "p", 0), ("b", "p", 1), ("d", "p", 1), ("x", "q", 0)]


def test_season_labels(spark):
    df = spark.createDataFrame([(2000,), (2010,)], "y int").select(ledger.season_label(F.col("y")).alias("l"))
    assert rows(df.select("l", ledger.season_start("l"), ledger.season_slug(F.lit("1999/00")))) == [("1999-00", 1999, "1999-00"), ("2009-10", 2009, "1999-00")]
    assert spark.createDataFrame([("1999/00",)], "l string").select(ledger.season_start("l")).first()[0] is None


def test_canonical_json(spark):
    texts = ['{"b": {"z": 1, "a": [ {"y": null, "x": "é"} ]}, "a": 1.0}', "null", "[3, 1]", "no json", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(N.canonical_json("t")).collect()] == ['{"a":1.0,"b":{"a":[{"x":"é","y":null}],"z":1}}', "null", "[3,1]", None, None]
    got = df.select(T.row_id(F.when(F.col("t") == "null", "17").when(F.col("t") == "no json", "x9"), N.canonical_json("t"))).collect()
    assert [r[0] for r in got] == [hashlib.sha1('{"a":1.0,"b":{"a":[{"x":"é","y":null}],"z":1}}'.encode()).hexdigest(), "17", hashlib.sha1(b"[3,1]").hexdigest(), None, None]


def test_json_shapes(spark):
    df = spark.createDataFrame([("g", '{"a.b":1,"a":{"b":2,"c":{}},"l":[{"x":[1]},2],"p":[{"k":1},{"q":2}]}'), ("g", "[1]"), ("h", "bad"), ("h", None)], "g string, j string")
    assert df.select(N.json_flatten_dotted("j")).first()[0] == {"a.b": "2", "l": '[{"x":[1]},2]', "p": '[{"k":1},{"q":2}]'}
    assert df.select(N.json_flatten_indexed("j")).first()[0] == {"a.b": "2", "l[0].x[0]": "1", "l[1]": "2", "p[0].k": "1", "p[1].q": "2"}
    assert [r[0] for r in df.select(N.deep_list(["p"])("j")).collect()] == ["p", None, None, None]
    assert rows(N.field_inventory(df, "j", ["g"])) == [("g", "a,a.b,l,p")]
    assert rows(N.key_presence(df, "j", ["p", "zz"])) == [("a", 1), ("a.b", 1), ("l", 1), ("p", 1), ("p[].k", 1)]
    df = spark.createDataFrame([(1, '[{"n":"a","id":5},{"n":"b"}]'), (2, '{"77":{"n":"c"}}'), (3, "x"), (4, None)], "k int, j string")
    got = df.select("k", F.explode(N.map_or_list(F.col("j"), "n:string,id:long")).alias("e")).select("k", "e.key", "e.value.n", "e.value.id")
    assert rows(got) == sorted([(1, None, "a", 5), (1, None, "b", None), (2, "77", "c", None)], key=str)
    df = spark.createDataFrame([('[{"t":"a"},{"t":"b"}]', '{"x":1}'), ('{"t":"a"}', None), (None, '{"x":1}')], "r string, m string")
    assert rows(N.value_inventory(df, "r", "t", "m")) == [("key", "x", 2), ("t", None, 1), ("t", "a", 2), ("t", "b", 1)] or rows(N.value_inventory(df, "r", "t", "m").where("value IS NOT NULL")) == [("key", "x", 2), ("t", "a", 2), ("t", "b", 1)]


def test_hosts_and_days(spark):
    urls = spark.createDataFrame([("http://A.x/1 http://a.x/1 https://b.y", "http://b.y/2"), (None, None)], "a string, b string")
    assert rows(T.domain_counts(urls, [F.col("a"), F.coalesce("b", F.lit(""))], 5))[:1] == [("a.x", 2)]
    df = spark.createDataFrame([(-1,), (86399,), (86400,)], "s long")
    assert [str(r[0]) for r in df.select(T.utc_day(F.col("s"))).collect()] == ["1969-12-31", "1970-01-01", "1970-01-02"]


def test_pages_and_archives_from_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    latin = '<meta charset="iso-8859-1"><p>é</p>'.encode("latin-1")
    (tmp_path / "p/a.html").write_bytes("<p>é</p>".encode())
    (tmp_path / "p/b.html.gz").write_bytes(gzip.compress(latin))
    (tmp_path / "p/c.html").write_bytes(b"\xe9")
    got = {r.path.rsplit("/", 1)[1]: r for r in files.read_pages(spark, f"file://{tmp_path}/p").collect()}
    assert {k: (r.html, r.bytes, r.charset) for k, r in got.items()} == {"a.html": ("<p>é</p>", 9, "UTF-8"), "b.html.gz": (latin.decode("latin-1"), len(latin), "ISO-8859-1"), "c.html": ("é", 1, "ISO-8859-1")}
    assert got["b.html.gz"].sha256 == hashlib.sha256(latin).hexdigest()
    (tmp_path / "z").mkdir()
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("b.txt", "two")
        z.writestr("a/é.txt", "")
    (tmp_path / "z/x.zip").write_bytes(b.getvalue())
    want = [("a/é.txt", 0, hashlib.sha256(b"").hexdigest()), ("b.txt", 3, hashlib.sha256(b"two").hexdigest())]
    assert rows(files.archive_inventory(spark, f"file://{tmp_path}/z"), "member", "size", "sha256") == want
    members = spark.createDataFrame([("x", "b.txt", "two"), ("x", "a/é.txt", None)], "a string, m string, t string")
    assert rows(files.archive_members(files.zipped(members, "a", "m", "t")), "member", "size", "sha256") == want


def test_envelopes_are_bounded(spark, tmp_path):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    files.write_records(df, f"{tmp_path}/e", ["k"], ["id"], rows=100)
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/e").collect()]
    assert len(lines) == 10 and max(len(e["records"]) for e in lines) < 200
    assert [r[0] for r in rows(files.read_records(spark, f"{tmp_path}/e", "id long").orderBy("id"))] == sorted(range(1000), key=lambda i: str((i,)))


def test_shared_folder_is_required_off_this_machine(spark, monkeypatch):
    before = spark.conf.get("spark.checkpoint.dir", None)

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(Cluster)
    assert spark.conf.get("spark.checkpoint.dir", None) == before
