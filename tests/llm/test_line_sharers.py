"""Line dedup against every earlier document that shares a line."""

import random

import corpus_pipeline as P
import pytest

from ledgerloom.llm import lines
from tests.llm import brute
from tests.llm.test_text_operators import frame


def every_sharer(docs, min_words):
    """(doc_id, n_lines, n_removed) by alignment with every earlier document that shares a nominating line."""
    own = {d: [x for x in t.split("\n") if brute.words(x)] for d, t in docs}
    marks = {d: {x for x in ls if len(brute.words(x)) >= min_words} for d, ls in own.items()}
    out = []
    for d in own:
        gone = {i for e in own if e < d and marks[e] & marks[d] for i, _ in brute.patience(own[d], own[e])}
        out.append((d, len(own[d]), len(gone)))
    return sorted(out)


def removed(spark, rows, **args):
    return sorted((r.doc_id, r.n_lines, r.n_removed) for r in lines.dedupe_lines(frame(spark, rows), **args).collect())


def texts(*docs):
    return [(i, "\n".join(f"{x} second third" for x in d)) for i, d in enumerate(docs, 1)]


def test_a_later_holder_aligns_where_the_first_does_not(spark):
    rows = texts("xLyLz", "rLs", "pLq")
    assert removed(spark, rows) == [(1, 5, 0), (2, 3, 0), (3, 3, 1)] == every_sharer(rows, 3)


def test_a_copy_of_a_reordered_document(spark):
    rows = texts("abcdef", "fdbeca", "fdbeca")
    assert removed(spark, rows)[2] == (3, 6, 6) and removed(spark, rows) == every_sharer(rows, 3)


@pytest.mark.parametrize("rounds", [lines.ROUNDS, (1, None), (None,)])
def test_every_sharer(spark, monkeypatch, rounds):
    monkeypatch.setattr(lines, "ROUNDS", rounds)
    r = random.Random(5)
    rows = texts(*("".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 9))) for _ in range(120)))
    assert removed(spark, rows) == every_sharer(rows, 3)


def test_short_lines(spark, tmp_path):
    rows = [(1, "one\ntwo words\nthree"), (2, "one\ntwo words\nthree"), (3, "一二三。\n四五六。"), (4, "一二三。\n四五六。\nx"), (5, "three\nmore")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.n_lines, r.n_removed) for r in lines.op2_line_dedup(spark, str(tmp_path)).collect())
    assert got == [(1, 3, 0), (2, 3, 3), (3, 2, 0), (4, 3, 2), (5, 2, 1)] == every_sharer(rows, 1)
    left = {r.doc_id: r.text for r in P.line_dedup(spark, frame(spark, rows), "").collect()}
    assert left == {1: rows[0][1], 3: rows[2][1], 4: "x", 5: "more"}


def test_every_sharer_of_short_lines(spark):
    r = random.Random(8)
    rows = [(i, "\n".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 9)))) for i in range(120)]
    assert removed(spark, rows, min_words=1) == every_sharer(rows, 1)


def counted_pairs(spark, monkeypatch, rows):
    counts, write = [], lines.Scratch.write

    def counting(self, df, name=None):
        out = write(self, df, name)
        if name and name.endswith("_pairs"):
            counts.append(out.count())
        return out

    monkeypatch.setattr(lines.Scratch, "write", counting)
    return removed(spark, rows, min_words=1), sum(counts)


def test_separators_nominate_nobody(spark, monkeypatch):
    rows = [(i, f"a{i}\n---\nb{i}\nc{i}\n---\nd{i}") for i in range(2000)]
    got, pairs = counted_pairs(spark, monkeypatch, rows)
    assert got == [(i, 6, 0) for i in range(2000)] and pairs < 40_000


def test_separators_between_shared_lines(spark, monkeypatch):
    """A repeated line between anchors goes, however many documents hold it."""
    rows = [(i, f"head\n---\nb{i}\n---\n{'tail' if i % 2 else f't{i}'}\ne{i}") for i in range(60)]
    got, _ = counted_pairs(spark, monkeypatch, rows)
    assert got == every_sharer(rows, 1)


def test_rows_of_one_id_keep_their_own_lines(spark):
    rows = [(1, "shared line here\nx"), (2, "shared line here\nown two a"), (2, "totally other text\nown two b"), (2, "shared line here\nown two a")]
    got = sorted((r.doc_id, r.n_removed, r.kept_text) for r in lines.dedupe_lines(frame(spark, rows)).collect())
    assert got == [(1, 0, rows[0][1]), (2, 0, rows[2][1]), (2, 1, "own two a"), (2, 1, "own two a")]


def test_many_lines(spark):
    long = "\n".join(f"line number {i % 4000}" for i in range(20_000))
    rows = [(1, long), (2, long + "\nlast line here"), (3, "\n" * 50_000), (4, "w " * 100_000)]
    assert removed(spark, rows) == [(1, 20_000, 0), (2, 20_001, 20_000), (3, 0, 0), (4, 1, 0)]
