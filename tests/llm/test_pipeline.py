"""Each stage against brute force over what it was given."""

import corpus_pipeline as P
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(P.STAGES) == 5
    kept = P.quality(spark, docs, SF)
    assert kept.columns == P.COLUMNS and kept.count() > 0.6 * docs.count()

    deduped = P.line_dedup(spark, kept, SF)
    want = {d: t for d, n, k, t in brute.line_dedup(_rows(kept), 1) if not k or k < n}
    assert dict(_rows(deduped)) == want and deduped.columns == P.COLUMNS
    assert all(r.n_chars == len(r.text) for r in deduped.collect())

    single = P.jaccard(spark, deduped, SF)
    assert {d for d, _ in _rows(single)} == {d for d, _, c in brute.jaccard_groups(_rows(deduped)) if d == c}

    clean = P.decontaminate(spark, single, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute.leaks(_rows(single), items)}
    assert {d for d, _ in _rows(clean)} == {d for d, _ in _rows(single)} - bad

    packed = P.packing(spark, clean, SF)
    assert {r.doc_id for r in packed.collect()} == {d for d, _ in _rows(clean)}


def test_run_and_empty_input(spark):
    assert P.run(spark, SF).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_stages_with_nulls_and_repeated_rows(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, line + "\nfirst own line here", "en", None, None), (1, line + "\nfirst own line here", "en", None, None), (2, line + "\nsecond own line here", None, "s", 7),
            (None, line, "en", "s", 1), (3, None, "en", "s", None), (4, "", None, None, 0), (5, line, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    deduped = P.line_dedup(spark, docs, SF)
    got = sorted(((r.doc_id or -1, r.text, r.n_chars) for r in deduped.collect()), key=str)
    want = [(1, rows[0][1], None), (1, rows[0][1], None), (2, "second own line here", 20), (-1, line, 1), (3, None, None), (4, "", 0)]
    assert got == sorted(want, key=str)
    single = P.jaccard(spark, docs, SF)
    assert sorted(r.doc_id or -1 for r in single.collect()) == [-1, 1, 1, 2, 3, 4, 5]
    assert P.decontaminate(spark, single, SF).count() == 7
    assert P.packing(spark, single, SF).count() == 7
    assert P.quality(spark, docs, SF).columns == P.COLUMNS
