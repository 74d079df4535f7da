"""Toxicity: n-grams of code points, ratios and scores against plain versions."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import toxicity

TEXTS = ["you scum", "", "ein blöder trottel", "日本語のばか者だよ", "é" * 9, "a nice day", None, "x" * 100_000]


def grams(text):
    return {(n, text[i : i + n]) for n in toxicity.GRAMS for i in range(len(text) - n + 1)}


def test_one_bucket_for_every_run_of_characters():
    seen = {}
    for i, index in toxicity.presences(pa.array(TEXTS)):
        want = grams(TEXTS[i] or "")
        assert len(index) == len(want) and len(set(index.tolist())) == len(index)
        for g in want:
            (one,) = [ix.tolist() for _, ix in toxicity.presences(pa.array([g[1]]))] if g[0] == 4 else [None]
            if one:
                assert seen.setdefault(g, one[0]) == one[0] and one[0] in index


@pytest.mark.parametrize("n", [0, 3, 8191, 8192, 200_000])
def test_packed_rows_unpack(n):
    index = np.random.default_rng(n).permutation(toxicity.DIMS)[:n]
    row = toxicity.packed(index)
    assert toxicity.unpacked(row).tolist() == sorted(index.tolist()) and len(row[1]) <= toxicity.DIMS // 8


def test_ratios_and_margins():
    rows = [np.array(x) for x in ([1, 2, 3], [2, 3], [3, 9], [9], [2, 9])]
    y = np.array([1, 1, 0, 0, 0.0])
    ratio = toxicity.ratios(y, [toxicity.packed(r) for r in rows], 0.5)
    ones, zeros = Counter(i for r, k in zip(rows, y) for i in r.tolist() if k), Counter(i for r, k in zip(rows, y) for i in r.tolist() if not k)
    for i in range(12):
        assert ratio[i] == pytest.approx(math.log(ones[i] / 2 + 0.25) - math.log(zeros[i] / 3 + 0.25))
    assert ratio[0] == 0 and ratio[1] > 0 > ratio[9]


def test_scores_add_up_the_table(spark):
    rng = np.random.default_rng(3)
    model = toxicity.Model(0.25, rng.normal(0, 0.1, toxicity.DIMS))
    rows = [(i, t, 9.0, "x") for i, t in enumerate(TEXTS)] + [(None, "you scum", 1.0, "y"), (0, "you scum", 1.0, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, idx string")
    got = Counter((r.doc_id, round(r.score, 5)) for r in toxicity.score(docs, model).collect())
    want = Counter()
    for doc, text, *_ in rows:
        ((_, index),) = toxicity.presences(pa.array([(text or "").lower()]))
        want[doc, round(1 / (1 + math.exp(-0.25 - model.table[index].sum())), 5)] += 1
    assert got == want
    assert toxicity.score(docs.where("false"), model).collect() == []


def test_small_and_one_sided_samples():
    row = toxicity.packed(np.array([5, 6]))
    other = toxicity.packed(np.array([7]))
    assert toxicity.fit(np.array([]), []).bias == 0
    assert toxicity.fit(np.array([1.0]), [row]).bias == 4 and toxicity.fit(np.array([0.0, 0.0]), [row, row]).bias == -4
    m = toxicity.fit(np.array([0.0, 1.0] * 10), [other, row] * 10)
    assert m.bias + m.table[[5, 6]].sum() > 0 > m.bias + m.table[7]
