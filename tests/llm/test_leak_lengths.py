"""Documents that hold one item and part of another item of a different length."""

import random

from ledgerloom.llm import decontaminate
from tests.llm import brute
from tests.llm.test_text_operators import frame


def test_a_whole_item_beside_parts_of_longer_and_shorter_ones(spark):
    r = random.Random(6)
    # 12 to 50 words: of an item of 50 words a window needs 40 of 46 shingles, the parts give 0 to 46
    items = [(i, " ".join(f"i{i}x{j}" for j in range(n))) for i, n in enumerate((50, 40, 30, 20, 12))]
    docs = []
    for i in range(120):
        (_, whole), (_, other) = r.sample(items, 2)
        part = other.split()[: r.randrange(2, 51)]
        docs.append((i, " ".join([*(f"a{i}b{j}" for j in range(30)), *whole.split(), *(f"c{i}d{j}" for j in range(30)), *part])))
    got = decontaminate.find_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == brute.leaks(docs, items)


def test_no_window_is_dense_among_too_few_places():
    import numpy as np

    for n in range(12):
        for least in range(n + 1, 25):
            assert decontaminate.dense_starts(np.arange(n), 24, least, 100).tolist() == []
