"""Round files, chunked payloads, archives and staged publication."""

import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import files, publish, rounds
from ledgerloom.sources.shared import work_folder


def put(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    put(tmp_path, "2022/rodada-2022-1.csv", "﻿id,team\n1,Roma\n2,\"Inter, Milano\"\n")
    put(tmp_path, "2022/rodada-2022-2.csv", "team,id,extra\nLazio,3,x\nTorino,4,\"say \"\"hi\"\"\"\n")
    put(tmp_path, "2023/rodada-2023-1.csv", "ID,year,id,,team\n5,1999,dup,blank,Pisa\n6,short\n")
    put(tmp_path, "2023/rodada-2023-2.csv", "")
    put(tmp_path, "2023/a b-2023-3.csv", "\nteam\nBari\n")
    path = f"file://{tmp_path}/*"
    rows = rounds.read_round_csv(spark, path)
    got = {r.id: r.asDict() for r in rows.collect()}
    assert {k: (v["team"], v["extra"], v["year"], v["round"]) for k, v in got.items()} == {
        "1": ("Roma", None, 2022, 1), "2": ("Inter, Milano", None, 2022, 1), "3": ("Lazio", "x", 2022, 2), "4": ("Torino", 'say "hi"', 2022, 2),
        "5": ("Pisa", None, 2023, 1), "6": (None, None, 2023, 1), None: ("Bari", None, 2023, 3)}
    assert got["5"]["year_1"] == "1999" and got["5"]["id_2"] == "dup" and got["5"]["_c3"] == "blank" and got["6"]["year_1"] == "short"
    inventory = rounds.csv_inventory(spark, path)
    assert {(r.year, r.round): r.columns for r in inventory.collect()} == {
        (2022, 1): ["id", "team"], (2022, 2): ["team", "id", "extra"], (2023, 1): ["ID", "year_1", "id_2", "_c3", "team"], (2023, 3): ["team"]}
    assert {r.bytes for r in inventory.where("year = 2022 AND round = 2").collect()} == {46}
    profile = rounds.year_profile(rows, inventory, ["missing", "id"], spark.createDataFrame([(2022,), (2023,), (2024,)], "year int"))
    assert sorted((r.year, r.files, r.rows, r.ids, r.min_round, r.max_round, r.format) for r in profile.collect()) == [
        (2022, 2, 4, 4, 1, 2, "CSV_ROUND_SNAPSHOT"), (2023, 2, 3, 2, 1, 3, "CSV_ROUND_SNAPSHOT"), (2024, 0, 0, 0, None, None, "UNRECOGNIZED")]
    assert {r.year: r.columns for r in profile.collect()} == {2022: "extra,id,team", 2023: "ID,_c3,id_2,team,year_1", 2024: ""}


def test_headers_of_no_files(spark, tmp_path):
    put(tmp_path, "x-2022-1.csv", "")
    assert rounds.read_round_csv(spark, f"file://{tmp_path}").count() == 0
    assert rounds.csv_inventory(spark, f"file://{tmp_path}").count() == 0


def test_only_the_columns_asked_for_are_read(spark, tmp_path):
    put(tmp_path, "x-2022-1.csv", "a,b,c\n1,2,3\n")
    put(tmp_path, "x-2022-2.csv", "c,a\n4,5\n")
    rows = rounds.read_round_csv(spark, f"file://{tmp_path}").select("c")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.c for r in rows.collect()) == ["3", "4"] and "ReadSchema: struct<c:string>" in plan and "struct<a" not in plan


def test_legacy_documents_are_whole_files(spark, tmp_path):
    put(tmp_path, "2021/Mercado-2021-1.txt", '{\n "atletas": [\n  {"k": 1,\n   "n": "Zé"}\n ]\n}\n')
    put(tmp_path, "2021/Mercado-2021-2.txt", '{\n "atletas": [{"k": 2, "n": "João"}]}', "latin-1")
    put(tmp_path, "2021/Mercado-2021-3.txt", '{"atletas": [')
    got = rounds.read_legacy_json(spark, f"file://{tmp_path}/*", "atletas array<struct<k:int,n:string>>")
    assert sorted((r.round, r.utf8, r.parsed, r.record and r.record.atletas[0].n) for r in got.collect()) == [
        (1, True, True, "Zé"), (2, False, True, "João"), (3, True, False, None)]
    inventory = got.select("file", "year", "round", "bytes", F.lit(rounds.LEGACY_FORMAT).alias("format"), F.array(F.lit("k"), F.lit("n")).alias("columns"))
    rows = got.select("year", F.explode("record.atletas").alias("a")).select("year", "a.*")
    (r,) = rounds.year_profile(rows, inventory, ["k"]).collect()
    assert (r.year, r.files, r.rows, r.ids, r.min_round, r.max_round, r.columns, r.format) == (2021, 3, 2, 2, 1, 3, "k,n", "LEGACY_MARKET_JSON_TXT")


def test_payload_states(spark):
    texts = {k: f"hello world {k} " * 50 for k in range(8)}
    d = spark.createDataFrame(list(texts.items()), "k int, t string").select("k", files.packed("t").alias("p"))
    chunks = files.chunk(d, "k", "p", 10)
    damaged = F.when((F.col("k") == 1) & (F.col("idx") == 1), "xxxxxxxxxx").otherwise(F.col("chunk"))
    chunks = chunks.withColumn("chunk", damaged).where("NOT (k = 2 AND idx = 1)")
    last = chunks.where("k = 3 AND idx = 0").unionByName(chunks)
    no_base64 = spark.createDataFrame([(8, "***")], "k int, t string")
    broken_gzip = spark.createDataFrame([(9, "H4sIAAAA")], "k int, t string")
    extra = files.chunk(no_base64.union(broken_gzip), "k", "t", 10)
    manifest = spark.createDataFrame([(k, hashlib.sha256((t if k != 4 else "other").encode()).hexdigest().upper()) for k, t in texts.items() if k != 5] + [(8, "x"), (9, "x"), (10, "x")], "k int, payload_sha256 string")
    got = {r.k: r for r in files.assemble(last.unionByName(extra), "k", manifest).collect()}
    assert {k: r.state for k, r in got.items()} == {
        0: "INTACT", 1: "CHUNK_DAMAGED", 2: "CHUNK_MISSING", 3: "CHUNK_MISSING", 4: "HASH_DIFFERS", 5: "UNLISTED", 6: "INTACT", 7: "INTACT",
        8: "NOT_DECODED", 9: "NOT_DECODED", 10: "CHUNK_MISSING"}
    assert bytes(got[6].content).decode() == texts[6] and got[4].content is None and got[10].chunks == 0
    assert {r.state for r in files.assemble(chunks.where("k IN (0, 5)"), "k").collect()} == {"INTACT"}


def test_damaged_archives_are_rows(spark):
    def archive(*members):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            for name, body in members:
                z.writestr(name, body)
        return b.getvalue()

    good = archive(("b.txt", "two"), ("a.txt", "one"), ("dir/", ""))
    bad = bytearray(archive(("x.txt", "payload here"), ("y.txt", "fine")))
    bad[bad.index(b"payload")] ^= 1
    rows = [("good", bytearray(good)), ("bad", bad), ("cut", bytearray(good[:40])), ("none", None), ("gz", bytearray(gzip.compress(b"x"))), ("empty", bytearray(archive()))]
    members = files.archive_members(spark.createDataFrame(rows, "path string, content binary"))
    got = sorted(((r.archive, r.member, r.size, r.state) for r in members.collect()), key=str)
    assert got == sorted([("good", "a.txt", 3, "OK"), ("good", "b.txt", 3, "OK"), ("bad", "x.txt", 12, "DAMAGED"), ("bad", "y.txt", 4, "OK"), ("cut", None, None, "NO_ARCHIVE"),
                          ("none", None, None, "NO_ARCHIVE"), ("gz", None, None, "NO_ARCHIVE")], key=str)
    digests = {r.archive: (r.members, r.bytes, r.digest) for r in files.inventory_digest(members).collect()}
    lines = "\n".join(f"{n}\t3\t{hashlib.sha256(t.encode()).hexdigest()}" for n, t in (("a.txt", "one"), ("b.txt", "two")))
    assert digests["good"] == (2, 6, hashlib.sha256(lines.encode()).hexdigest()) and digests["bad"][2] is None


def passing(df):
    return df.selectExpr("count(*) AS rows", "'PASS' AS status")


def test_versions_by_content(spark):
    path = work_folder(spark, "t")
    assert publish.latest(spark, path) is None
    with pytest.raises(LookupError):
        publish.read_published(spark, path)
    one = publish.publish(spark.range(5), path, passing)
    same = publish.publish(spark.range(5).orderBy(F.desc("id")).repartition(3), path, passing)
    two = publish.publish(spark.range(5).union(spark.range(1)), path, passing)
    assert (one.version, one.new, same.version, same.new, two.version) == (1, True, 1, False, 2)
    assert publish.read_published(spark, path).count() == 6 and publish.read_published(spark, path, 1).count() == 5
    with pytest.raises(LookupError):
        publish.read_published(spark, path, 3)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):  # another publisher was first
        spark.range(1).write.mode("error").json(f"{path}/manifests/version=2")


def test_readers_never_see_a_failed_version(spark):
    path = work_folder(spark, "t")
    publish.publish(spark.range(5), path, passing)

    def failing(df):
        return df.selectExpr("'FAIL' AS status").limit(1)

    def silent(df):
        return df.selectExpr("'PASS' AS status").limit(0)

    def breaking(df):
        return df.selectExpr("raise_error('audit broke') AS status").limit(1)

    for audit, error in ((failing, publish.AuditFailed), (silent, publish.AuditFailed), (breaking, Exception)):
        with pytest.raises(error):
            publish.publish(spark.range(9), path, audit)
        assert publish.read_published(spark, path).count() == 5
    with pytest.raises(Exception, match="before"):  # the write itself fails
        publish.publish(spark.range(9).selectExpr("raise_error('before') AS id"), path, passing)
    assert publish.read_published(spark, path).count() == 5
    tried = sorted((r.status or "", r.published) for r in publish.audits(spark, path).collect())
    assert tried == [("FAIL", False), ("PASS", True)]
    after = publish.publish(spark.range(9), path, passing)
    assert after.version == 2 and publish.read_published(spark, path).count() == 9


def test_a_crash_after_the_audit_publishes_nothing(spark, monkeypatch):
    path = work_folder(spark, "t")
    publish.publish(spark.range(5), path, passing)

    def crash(df):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(publish, "content_digest", crash)
        with pytest.raises(RuntimeError):
            publish.publish(spark.range(7), path, passing)
    assert publish.read_published(spark, path).count() == 5 and publish.publish(spark.range(7), path, passing).version == 2


def test_digest_tells_bags_apart(spark):
    def digest(rows):
        return publish.content_digest(spark.createDataFrame(rows, "a int, b string"))[1]

    assert digest([(1, "x"), (2, None)]) == digest([(2, None), (1, "x")])
    assert len({digest(r) for r in ([(1, "x"), (2, None)], [(1, "x"), (2, "")], [(1, "x")], [(1, "x"), (1, "x")], [(2, "x"), (1, None)])}) == 5
