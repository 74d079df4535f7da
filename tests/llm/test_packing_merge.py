"""Packing against a plain best-fit, and the number of sequences for several layouts."""

import random
from collections import Counter

import public_tokenizers
import pytest

from ledgerloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(sizes, capacity, limit):
    """Bin number of every piece by linear search; of equally tight bins the one used last."""
    free, used, out = {}, {}, []
    for at, size in enumerate(sizes):
        fits = [b for b in free if free[b] >= size]
        if fits:
            b = min(fits, key=lambda b: (free[b], -used[b]))
        else:
            b = len(used)
            if size < capacity and len(free) >= limit:
                del free[min(free, key=lambda b: (free[b], -used[b]))]
            free[b] = capacity
        out.append(b)
        free[b] -= size
        used[b] = at
        if not free[b]:
            del free[b]
    return out


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_plain_best_fit(limit):
    r = random.Random(limit)
    sizes = [r.randrange(1, 41) for _ in range(3000)]
    fit = packing.BestFit(40, limit)
    assert [fit.place(s)[0] for s in sizes] == plain_best_fit(sizes, 40, limit)


@pytest.mark.parametrize("parts", [1, 32, 211])
def test_layouts_need_about_the_least_number_of_sequences(spark, parts):
    r = random.Random(2)
    words = [min(400, int(r.expovariate(1 / 30))) for _ in range(4000)]
    docs = spark.createDataFrame([(i, "the " * n) for i, n in enumerate(words)], "doc_id long, text string").repartition(parts)
    got = packing.pack(docs, PATH, capacity=256, open_bins=64).collect()
    assert Counter(g.doc_id for g in got) == {i: -(-(n + 1) // 256) for i, n in enumerate(words)}
    spans = {}
    for g in got:
        spans.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for s in spans.values():
        ends = 0
        for offset, length in sorted(s):
            assert offset == ends
            ends += length
        assert ends <= 256
    least = -(-sum(n + 1 for n in words) // 256)
    assert len(spans) <= 1.01 * least + 1


def test_ids_come_through_the_merge(spark):
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(40)], "doc_id long, text string").repartition(8)
    got = packing.pack(docs, PATH, with_ids=True).collect()
    assert len({g.sequence_id for g in got}) == 1 and all(g.length == len(g.ids) and g.ids[-1] == 1 for g in got)
