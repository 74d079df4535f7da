"""Archive, packing, search and classifiers: round trips, the tokenizer itself, brute force, held-out accuracy."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import langid, packing, quality, queries, samples, topk, toxicity, warc
from ledgerloom.llm.scratch import Scratch
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name])


def test_archive_round_trip(spark):
    rows = [(1, "http://a", "<p>é</p>", "x"), (2, None, "<p>é</p>", "x"), (3, "http://c", None, "x"), (4, "http://d", "", None), (5, "u", "z" * 300000, "x"), (5, "u", "z" * 300000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = Scratch(spark, "t").path("a")
    warc.write_archive(pages, path)
    got = {}
    for r in warc.read_records(spark, path).collect():
        got.setdefault(r.record_id, r)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    for page, _, html, _ in rows:
        r, body = got[page], (html or "").encode()
        assert bytes(r.payload) == body and r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode() == r.declared_sha1
        assert bytes(r.record) == bytes(r.header) + (body if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert r.content_length == (len(body) if r.record_type == "response" else 0)
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 2, 3, 4, 5)] == [("revisit", 2), ("response", None), ("revisit", 4), ("response", None), ("response", None)]


def test_archive_min_bytes_and_damage(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    path = Scratch(spark, "t").path("a")
    warc.write_archive(pages, path, min_bytes=3)
    assert {r.record_type for r in warc.read_headers(spark, path).collect()} == {"response"}
    spark.createDataFrame([("00", 1, bytearray(b"x"))], "digest string, response_id long, payload binary").write.mode("append").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_payloads(spark, path).collect()


def test_archive_headers_keep_their_lines(spark):
    bad = "http://a/\r\nWARC-Refers-To: <urn:page:9>\r\nWARC-Payload-Digest: sha1:X\x00\x7f"
    pages = spark.createDataFrame([(1, bad, "same"), (2, "é ü", "same"), (None, None, "alone")], "page_id long, url string, html string")
    pages = pages.withColumn("at", F.timestamp_millis(F.lit(1_000_000_000_000)))
    path = Scratch(spark, "t").path("a")
    warc.write_archive(pages, path, date_col="at")
    got = {r.record_id: r for r in warc.read_records(spark, path).collect()}
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 2, None)] == [("revisit", 2), ("response", None), ("response", None)]
    lines = bytes(got[1].header).decode().split("\r\n")
    assert "WARC-Target-URI: http://a/%0D%0AWARC-Refers-To: <urn:page:9>%0D%0AWARC-Payload-Digest: sha1:X%00%7F" in lines
    assert "WARC-Date: 2001-09-09T01:46:40Z" in lines and f"WARC-Profile: {warc.REVISIT_PROFILE}" in lines and lines[-2:] == ["", ""]
    assert all(line == "WARC/1.1" or ": " in line for line in lines[:-2])
    assert "WARC-Target-URI: é ü" in bytes(got[2].header).decode().split("\r\n")


def test_archive_finds_a_swapped_payload(spark):
    pages = spark.createDataFrame([(1, "u", "ab")], "page_id long, url string, html string")
    path = Scratch(spark, "t").path("a")
    warc.write_archive(pages, path)
    other = spark.read.parquet(f"{path}/headers").withColumn("header", F.regexp_replace(F.col("header").cast("string"), "sha1:.", "sha1:Q").cast("binary"))
    Scratch(spark, "t").write(other).write.mode("overwrite").parquet(f"{path}/headers")
    with pytest.raises(Exception, match="record without its payload 1"):
        warc.read_records(spark, path).collect()


def test_archive_of_nothing(spark):
    path = Scratch(spark, "t").path("a")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_records(spark, path).collect() == []


ODD = [None, "", " ", "<|endoftext|> a <|startoftext|>b", "a\x1cb  x\x1f", "É é ß ﬁ İ 日本語 ½ ²", "it's we'll 12,5 !!??", "a\xa0b c", "x" * 9000, "word " * 9000, "Σας ΟΔΟΣ ςσ"]


def test_packing_against_the_tokenizer(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)] + [(None, "null id", 7), (3, "again", 7)], "doc_id long, text string, piece int")
    got = packing.pack(docs.repartition(2), PATH, with_ids=True).collect()
    tok = Tokenizer.from_file(PATH)
    want = sorted((-1 if i is None else i, tok.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in [*enumerate(ODD), (None, "null id"), (3, "again")])
    whole = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.start == 4096 * r.piece and (r.length == 4096 or r.length < 4096)
    pieces = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.start), []).append(r.ids)
    rebuilt = []
    for d in {r.doc_id for r in got}:
        if d == 3:
            rebuilt += [(3, ids) for ids in pieces[3, 0]]
        else:
            rebuilt.append((-1 if d is None else d, [x for s in sorted(s for k, s in pieces if k == d) for x in pieces[d, s][0]]))
    assert sorted(rebuilt) == want
    for r in got:
        whole.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in whole.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 8, 7)] == [(0, 0), (1, 0), (2, 0)]
    assert fit.place(2) == (2, 7) and fit.place(2) == (0, 6)  # bin 1, the fullest, is closed


def test_packing_is_near_the_bound(spark):
    r = np.random.default_rng(0)
    fit = packing.BestFit(4096, 1024)
    sizes = r.integers(1, 3000, 20000)
    for n in sizes:
        fit.place(int(n))
    assert fit.made <= 1.02 * -(-sizes.sum() // 4096) + 1


def test_top_k_against_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(0, 0.2, 16)], i) for i in range(400)]
    rows += [(1000 + i, rows[100][1], 0) for i in range(30)] + [(2000, None, 0), (2050, [1.0, None], 0), (2100, [float("nan")] * 16, 0), (2150, [], 0), (2200, [0.5], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = [tuple(x) for x in topk.top_k(df.where("vec_id % 50 = 0"), df).collect()]
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in ok:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, u)), i) for i, u in ok if i != q)[:5]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert sorted(got) == sorted(want)
    assert topk.top_k(df.where("false"), df).collect() == [] and topk.top_k(df.where("vec_id = 0"), df.where("false")).collect() == []


def test_queries_of_one_id_share_a_ranking(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.5, 0.1]), (2, [0.1, 0.75]), (2, [0.1, 0.75]), (3, [0.25, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df.where("vec_id = 0"), df, k=4).collect())
    assert got == [(0, 1, 2, 256 * 192), (0, 2, 2, 256 * 192), (0, 3, 1, 256 * 128), (0, 4, 3, 256 * 64)]


def test_factorisation_identity():
    r = np.random.default_rng(1)
    m = quality.Machine(0.3, r.normal(size=quality.DIMS), r.normal(size=(quality.DIMS, 3)))
    idx, x = r.choice(quality.DIMS, 7, replace=False), r.normal(size=7)
    pairs = sum(m.factors[idx[i]] @ m.factors[idx[j]] * x[i] * x[j] for i in range(7) for j in range(i))
    got = m.margin(1, np.zeros(7, int), idx, x)[0]
    assert got == pytest.approx(0.3 + m.linear[idx] @ x + pairs)


@pytest.mark.parametrize("name,label,least", [("op4_quality_classifier", "quality", 0.95), ("op6_toxicity", "toxic", 0.95)])
def test_classifier_on_held_out_rows(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got[label]).mean() >= least and got.score.between(0, 1).all()


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.QUERIES["op3_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.95


def test_language_edges(spark):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("der hund und die katze " * 3, "de"), ("the dog and the cat " * 3, "en")] * 8 + [(None, "en"), ("", "en"), ("123 !!", "de"), ("日本", None)])],
                                 "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = {r.doc_id: r for r in langid.predict(docs, model, None).collect()}
    assert [got[i].lang_pred for i in (16, 17, 18)] == ["und"] * 3 and got[0].lang_pred == "de" and got[1].lang_pred == "en"
    assert got[19].lang_pred in ("de", "en") and got[19].rejected
    assert {r.lang_pred for r in langid.predict(docs, langid.train(docs.where("false")), None).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model).collect() == []


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, None, 1, 2.0), (2, "", 0, 1, 2.0), (2, "a", None, 1, 2.0), (None, "x " * 50000, 3, 1, 2.0), (5, "you idiot", 3, 1, 2.0)], "doc_id long, text string, n_chars long, _y int, score double")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (5, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for which in (labels, labels.where("false")):
        m = quality.train(docs, which)
        got = quality.score(docs, m)
        assert got.columns == ["doc_id", "text", "n_chars", "_y", "score"] and got.count() == 5
        assert all(0 <= r.score <= 1 for r in got.collect())
        t = toxicity.score(docs, toxicity.train(docs, which)).collect()
        assert len(t) == 5 and all(0 <= r.score <= 1 for r in t)
    assert quality.score(docs.where("false"), m).collect() == []


def test_samples_leave_the_held_out_rows(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("_id"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("y"))
    got = samples.labelled_sample(docs, labels, "y", 5, 30, 20).collect()
    assert len(got) == 50 and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in got)


def test_search_of_large_components(spark):
    """Finite components of any size are ranked exactly; what passes 64 bits has no score."""
    rng = np.random.default_rng(4)
    vectors = [(i, [float(v) for v in rng.choice([1e12, -1e12, 1e300, -1e300, 3.5, -2.25, 1e9 + 0.1, 0.0], 4)]) for i in range(40)]
    vectors += [(100, [1e12, 1.0, 0.0, 0.0]), (101, [1e12, 1.0, 0.0, 0.0]), (102, [1.7e308] * 4), (103, [7e6, 1e7, 1e6, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    whole = {i: [int(min(max(np.floor(256 * np.float64(c)), -1.7976931348623157e308), 1.7976931348623157e308)) for c in v] for i, v in vectors}
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df.where("vec_id % 10 = 0 OR vec_id > 90"), df, k=6).collect())
    want = []
    for q in whole:
        if q % 10 == 0 or q > 90:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:6]
            want += [(q, k, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for k, (s, i) in enumerate(scores, 1)]
    assert got == sorted(want)


def test_languages_are_bounded(spark):
    """Of a column that holds noise only the languages of the most rows are learned."""
    rows = [(i, f"some words of text {i}", f"noise{i}") for i in range(200)] + [(1000 + i, "der die das und ist", "de") for i in range(40)] + [(2000 + i, "the of and is to", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, languages=2)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs.where("doc_id >= 1000"), model).collect()}
    assert all(got[i] == ("de" if i < 2000 else "en") for i in got)


def test_language_ties_repeated_rows_and_other_columns(spark):
    """Equal cosines give the language that sorts first; repeated rows and clashing columns change nothing."""
    rows = [(i, "same words here", lang, 1, "x") for i, lang in enumerate(["b", "a"] * 20)] + [(90, "same words here", None, 2, "y"), (90, "same words here", None, 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, lang_pred string")
    found = langid.predict(docs, langid.train(docs, clusters=1), reject_as=None).collect()
    assert len(found) == 42 and {r.lang_pred for r in found} == {"a"} and len({round(r.score, 6) for r in found}) == 1


def test_nearest_centroid_against_a_plain_version(spark):
    """Predictions and cosines are those of vectors made gram by gram."""
    rng = np.random.default_rng(0)
    words = {"de": "der die und ist nicht ein Haus Baum".split(), "en": "the and is not a house tree of".split(), "fr": "le la et est pas une maison arbre".split()}
    rows = [(i, " ".join(rng.choice(words[lang], 12)), lang) for i, lang in enumerate(["de", "en", "fr"] * 30)] + [(900, "x" * 3000 + " the house", None), (901, "", None), (902, "12 !", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model, reject_as=None).collect()}
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        data = langid._FOLD[np.frombuffer(text.encode(), np.uint8)]
        tf = np.zeros(langid.DIMS)
        for n in langid.GRAMS:
            for a in range(len(data) - n + 1):
                h = sum(int(langid.W._stream(71, 256)[data[a + j]]) * int(langid.W.coefficients(0, 64)[j]) for j in range(n))
                tf[((h * 0x9E3779B97F4A7C15) % (1 << 64)) >> 52] += 1
        (v,) = langid.vectors(tf[None, :], model.idf)
        cosines = [float(c @ v) for c in model.centroids]
        best = int(np.argmax(cosines))
        assert got[i][0] == model.languages[model.owner[best]] and abs(got[i][1] - min(max(cosines[best], 0), 1)) < 1e-6
