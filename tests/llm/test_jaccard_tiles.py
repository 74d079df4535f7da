"""Tiles of large Jaccard groups."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard
from tests.llm import brute
from tests.llm.test_text_operators import frame


@pytest.mark.parametrize("step", [1, 20, 1 << 33, -20])
def test_tiles_are_even_for_ids_of_one_residue(spark, step):
    n, rows = 2000, 100
    members = spark.range(n).select(F.lit(0).cast("long").alias("leader"), F.lit(n).cast("long").alias("size"), (F.col("id") * step).alias("doc_id"))
    held = Counter(r.tile for r in jaccard.deal(members, rows).collect())
    assert len(held) == 20 and max(held.values()) < 2 * rows and sum(held.values()) == n + 19


def test_a_family_travels_once(spark):
    """20,000 near copies and 5 other members: a member of the family has one row in each round."""
    n, rows = 20_005, 1000
    members = spark.range(n).select(F.lit(0).cast("long").alias("leader"), F.lit(n).cast("long").alias("size"), F.col("id").alias("doc_id"))
    assert jaccard.deal(members, rows).count() == n + 20
    found = spark.range(1, 20_000).select(F.col("id").alias("u"), F.lit(0).cast("long").alias("component"))
    split = jaccard.apart(members, found)
    again = jaccard.deal_again(split, rows)
    assert again.count() == 20_000 + 5 * 21
    together = Counter((r.doc_id, o.doc_id) for t in [again.where("doc_id >= 19990").collect()] for r in t for o in t if r.tile == o.tile and r.doc_id > o.doc_id)
    assert {(a, b) for a, b in together if a >= 20_000} == {(a, b) for a in range(20_000, n) for b in range(19_990, a)}
    assert jaccard.apart(members.where("doc_id < 20000"), found).count() == 0


@pytest.mark.parametrize("rows, size", [(3, 64 << 20), (17, 64 << 20), (256, 900)])
def test_two_families_and_strangers_in_tiles(spark, rows, size):
    r = random.Random(rows)
    one, two = [f"a{i}" for i in range(40)], [f"a{i}" if i < 20 else f"b{i}" for i in range(40)]
    docs = []
    for i in range(70):
        ws = list(one if i % 3 else two)
        if i % 5 == 0:
            ws = ws[: r.randrange(8, 40)]
        elif i % 2:
            ws[r.randrange(40)] = f"z{i}"
        docs.append((i * 20, " ".join(ws)))
    got = sorted(tuple(x) for x in jaccard.jaccard_groups(frame(spark, docs), block_rows=rows, tile_bytes=size).collect())
    assert got == brute.jaccard_groups(docs)


def test_tiles_are_bounded_by_bytes(spark):
    """40 long sets of one group: few rows, many bytes."""
    members = spark.range(40).select(F.lit(0).cast("long").alias("leader"), F.col("id").alias("doc_id"), F.lit(8_000_000).cast("long").alias("bytes"))
    size = members.groupBy("leader").agg(jaccard.rows_or_bytes(256, 64 << 20).alias("size"))
    dealt = jaccard.deal(members.join(size, "leader"), 256)
    held = Counter()
    for r in dealt.collect():
        held[r.tile] += r.bytes
    assert len(held) == 5 and max(held.values()) < 3 * (64 << 20)
    found = spark.range(1, 30).select(F.col("id").alias("u"), F.lit(0).cast("long").alias("component"))
    split = jaccard.apart(members.join(size, "leader"), found, jaccard.rows_or_bytes(256, 64 << 20))
    assert {(r.main, r.others) for r in split.collect()} == {(916, 310)}


def test_several_texts_of_one_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, a), (2, a + " tail"), (3, b), (2, b), (4, "x y z"), (4, None)]
    got = sorted(tuple(x) for x in jaccard.jaccard_groups(frame(spark, rows)).collect())
    assert got == [(1, 26, 1), (2, 26, 1), (2, 27, 1), (3, 26, 1), (4, 0, 4), (4, 1, 4)]
