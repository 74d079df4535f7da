"""Dedup, decontamination and join operators against brute force, with edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, jaccard, lines, passages
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, block int, score double, fp string, leader long"


def corpus(seed=3, n=60):
    """Random short documents with copies, near copies, shared passages and shared lines."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(n):
        ws = [r.choice(vocab) for _ in range(r.choice([3, 8, 30, 90]))]
        if i % 4 == 1 and rows:
            ws = rows[r.randrange(len(rows))][1].split()
            for _ in range(r.choice([0, 0, 1, 3, 8])):
                if ws:
                    ws[r.randrange(len(ws))] = r.choice(vocab)
        elif i % 4 == 2:
            a = r.randrange(20)
            ws[len(ws) // 2 : len(ws) // 2] = passage[a : a + r.choice([12, 13, 14, 30])]
        text = ""
        for j, w in enumerate(ws):
            text += w + ("\n" if j % 9 == 8 else "  " if j % 5 == 0 else " ")
        rows.append((i, text.upper() if i % 17 == 0 else text))
    edge = [(100, None), (101, ""), (102, " \t\r\n\x0b\x0c"), (103, "one"), (104, "one"), (105, "One two"), (106, "long " * 20000 + "end"), (107, "long " * 20000 + "end"), (108, "é\xa0ü   x")]
    return rows + edge


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, "s", None, 1, 2, None, "x", None) for d, t in rows], SCHEMA)


def test_jaccard_groups(spark):
    rows = corpus()
    got = sorted(tuple(r) for r in jaccard.jaccard_groups(frame(spark, rows)).collect())
    assert got == brute.jaccard_groups(rows)


def test_jaccard_large_groups_are_tiled(spark):
    rows = corpus(5, 50)
    got = sorted(tuple(r) for r in jaccard.jaccard_groups(frame(spark, rows), block_rows=3).collect())
    assert got == brute.jaccard_groups(rows)


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_trie_finds_all_links(percent):
    import numpy as np

    r = np.random.default_rng(percent)
    base = np.arange(40, dtype=np.uint64)
    sets = [np.sort(r.choice(base, r.integers(1, 40), replace=False)) for _ in range(80)]
    edges = jaccard.block_edges(list(range(80)), sets, percent)
    def groups(links):
        root = list(range(80))
        for a, b in links:
            root = [min(root[a], root[b]) if x in (root[a], root[b]) else x for x in root]
        return root

    def linked(i, j):
        o = len(np.intersect1d(sets[i], sets[j]))
        return 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o)

    want = groups([(i, j) for i in range(80) for j in range(i) if linked(i, j)])
    assert groups(edges) == want
    assert all(b == want[a] < a for a, b in edges)
    bits = [jaccard.parity_bits(s) for s in sets]
    sifted = groups(jaccard.sift(list(range(80)), np.array([len(s) for s in sets]), bits, percent))
    assert all(sifted[i] == sifted[j] for i in range(80) for j in range(i) if linked(i, j))


def test_sift_folds_bitmaps():
    import numpy as np

    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 2200, dtype=np.uint64)
    sets = [base[:2000], base[:2100], base[:1500], np.append(base[:2000], r.integers(0, 2**63, 100, dtype=np.uint64)), r.integers(0, 2**63, 2090, dtype=np.uint64), r.integers(0, 2**63, 1990, dtype=np.uint64)]
    bits = [jaccard.parity_bits(s) for s in sets]
    assert len({len(b) for b in bits}) == 2
    got = jaccard.sift([10, 11, 12, 13, 14, 15], np.array([len(s) for s in sets]), bits, 75)
    assert got == [(11, 10), (12, 10), (13, 10)]


def test_passages(spark):
    rows = corpus(7)
    got = sorted(tuple(r) for r in passages.drop_repeated_passages(frame(spark, rows), block_docs=8).collect())
    assert got == brute.passages(rows)


def test_passages_null_and_repeated_ids(spark):
    text = " ".join(f"a{i}" for i in range(20))
    got = passages.drop_repeated_passages(frame(spark, [(None, text), (1, text), (1, text), (2, text + " tail")])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 20)]


def test_difference_cover():
    for v in range(1, 12):
        c = passages.difference_cover(v)
        assert {(a - b) % v for a in c for b in c} == set(range(v))


def test_lines(spark):
    rows = corpus(9)
    more = [(200, "alpha beta gamma\nshared one two\nshared three four\nx y z"), (201, "new line here\nshared one two\nshared three four\n\nlast one here"), (202, "shared three four\nshared one two"), (203, None)]
    got = sorted(tuple(r) for r in lines.dedupe_lines(frame(spark, rows + more)).collect())
    assert got == brute.line_dedup(rows + more)


def test_patience_against_recursion():
    r = random.Random(1)
    for _ in range(300):
        a, b = [[r.randrange(9) for _ in range(r.randrange(12))] for _ in range(2)]
        got = sorted((i + k, j + k) for i, j, n in lines.patience_blocks(a, b) for k in range(n))
        assert got == sorted(brute.patience(a, b)), (a, b)


def test_leaks(spark):
    r = random.Random(4)
    vocab = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([6, 14, 30, 50])))) for i in range(30)] + [(90, None), (91, ""), (92, "two words"), (93, "V1 v2 v3 v4 v5")]
    docs = corpus(11, 30)
    for i in range(30):
        ws = items[i % 30][1].split()
        if i % 3 == 1:
            ws[len(ws) // 2] = "changed"
        docs.append((300 + i, " ".join([*(r.choice(vocab) for _ in range(40)), *ws, *(r.choice(vocab) for _ in range(25))]).upper()))
    docs += [(400, "v1 v2 V3 v4 v5"), (401, "x two words y"), (402, items[2][1]), (403, " ".join(items[3][1].split()[:-1]))]
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(docs, items)
    got = decontaminate.find_leaks(frame(spark, docs), b)
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want
    sliced = decontaminate.find_leaks(frame(spark, docs), b, slice_items=8)
    assert {(x.doc_id, x.item_id) for x in sliced.collect()} == want


def test_index_gives_every_pair_within_the_radius():
    import numpy as np

    r = np.random.default_rng(0)
    items = [(str(i), " ".join(f"t{x}" for x in r.integers(0, 50, 12))) for i in range(60)]
    for radius in (0, 3, 7, 17, 18, 19):
        index = decontaminate.Index(items, 5, radius)
        near = index.prints[r.integers(0, 60, 200)]
        for _ in range(12):
            near = near ^ (np.uint64(1) << r.integers(0, 64, 200).astype(np.uint64))
        near[:20] = index.prints[:20]
        w, i = index.near(12, near)
        want = {(a, b) for a in range(200) for b in range(60) if bin(int(near[a] ^ index.prints[b])).count("1") <= radius}
        assert set(zip(w.tolist(), i.tolist())) == want and want


def test_tables_give_few_of_many_items():
    import numpy as np

    r = np.random.default_rng(1)
    items = [(str(i), " ".join(f"t{x}" for x in r.integers(0, 5000, 20 + i % 30))) for i in range(2000)]
    index = decontaminate.Index(items, 5, decontaminate.RADIUS)
    prints = r.integers(0, 2**64, 200, dtype=np.uint64)
    w, i = index.candidates(prints)
    given = {(a, b) for a, b in zip(w.tolist(), i.tolist())}
    assert len(given) < 0.13 * 200 * 2000


def test_recall_of_borderline_windows():
    """Of windows at a similarity of 0.75 to 0.85 the radius keeps 99 of 100."""
    import numpy as np

    r = np.random.default_rng(2)
    seen = kept = 0
    for _ in range(3000):
        n = int(r.integers(24, 80))
        ws = r.integers(0, 1 << 40, n)
        other = ws.copy()
        at = r.integers(0, n)
        other[at : at + r.integers(1, 4)] += 1
        a, b = (decontaminate.W.window_hashes(decontaminate.W.mix64(x.astype(np.uint64)), 5) for x in (ws, other))
        both = len(np.intersect1d(a, b))
        if 0.75 <= both / (len(a) + len(b) - both) < 0.85:
            seen += 1
            kept += bin(int(decontaminate.fingerprint(a) ^ decontaminate.fingerprint(b))).count("1") <= decontaminate.RADIUS
    assert seen > 500 and kept >= 0.99 * seen


def test_leaks_in_a_long_text_and_repeated_rows(spark):
    item = " ".join(f"q{i}" for i in range(30))
    long = " ".join(["filler words go here"] * 100_000 + [item] + ["and go on"] * 100_000)
    docs = frame(spark, [(1, long), (1, item), (1, item), (None, item), (2, "q1 q2 q3")])
    b = spark.createDataFrame([(7, item), (7, item), (None, item.upper()), (8, "other words of an item")], "item_id long, text string")
    got = sorted((x.doc_id or 0, x.item_id or 0, x.start_word) for x in decontaminate.find_leaks(docs, b).collect())
    want = [(d, i, s) for d, s in ((1, 400_000), (1, 0), (1, 0), (0, 0)) for i in (7, 7, 0)]
    assert got == sorted(want)


def test_starts_of_dense_windows():
    import numpy as np

    r = np.random.default_rng(7)
    for _ in range(200):
        n, width = int(r.integers(1, 40)), int(r.integers(1, 12))
        at = np.flatnonzero(r.random(n) < 0.5)
        least, last = int(r.integers(1, width + 1)), n - width
        want = [s for s in range(last + 1) if ((at >= s) & (at < s + width)).sum() >= least]
        got = decontaminate.dense_starts(at, width, least, last).tolist() if len(at) >= least else []
        assert got == want


def test_windows_are_summed_over_bounded_spans(monkeypatch):
    import numpy as np

    grams = np.random.default_rng(4).integers(0, 2**63, 4000, dtype=np.uint64)
    starts = np.unique(np.random.default_rng(5).integers(0, 3960, 900))
    want = [decontaminate.fingerprint(grams[a : a + 40]) for a in starts]
    for span in (1, 64, 1 << 14):
        monkeypatch.setattr(decontaminate, "SPAN", span)
        assert decontaminate.window_prints(grams, starts, 40).tolist() == want


def test_words_of_long_rows_are_hashed_in_pieces():
    import numpy as np
    import pyarrow as pa

    column = pa.array(["é  long\tword " * 300 + "x" * 3000 + " y", "short one", None, "", "z" * 900])
    whole = [(s.first, s.rows, s.starts.tolist(), s.ends.tolist(), s.hashes.tolist(), s.bounds.tolist()) for s in decontaminate.W.word_slices(column, limit=1 << 20)]
    cut = list(decontaminate.W.word_slices(column, limit=64))
    assert np.concatenate([s.hashes for s in cut]).tolist() == whole[0][4]
    assert [int(n) for s in cut for n in np.diff(s.bounds)] == np.diff(whole[0][5]).tolist()


@pytest.mark.parametrize("run", [jaccard.jaccard_groups, passages.drop_repeated_passages, lines.dedupe_lines])
def test_empty_table(spark, run):
    assert run(frame(spark, [])).collect() == []
    assert len(run(frame(spark, [(1, None), (2, ""), (2, "")])).collect()) == 3


def test_leaks_of_empty_tables(spark):
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.find_leaks(frame(spark, []), b).collect() == []
    assert decontaminate.find_leaks(frame(spark, [(1, "a b c d e f")]), b.where("false")).collect() == []


def test_components_of_a_path(spark):
    from ledgerloom.llm.components import components
    from ledgerloom.llm.scratch import Scratch

    e = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = components(e, Scratch(spark, "t")).collect()
    assert {r.component for r in got} == {0} and len(got) >= 200
