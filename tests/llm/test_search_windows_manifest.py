"""Ranked search, sum-of-squares packing and the Merkle manifest against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import lexical, manifest, windows
from ledgerloom.llm import words as W
from tests.llm import brute

BYTES = public_tokenizers.path("byte_bpe_50k.json")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k):
    """Scores of all documents for every item, sorted; null ids count but are not ranked."""
    bags = [(d, TERM.findall(brute.fold(t))) for d, t in docs]
    bags = [(d, ts) for d, ts in bags if ts]
    n_docs, length = len(bags), sum(len(ts) for _, ts in bags)
    df = Counter(t for _, ts in bags for t in set(ts))
    out = []
    for item, text in items:
        scores = []
        for d, ts in bags:
            tf, m = Counter(ts), 100 - 50 + (50 * len(ts) * n_docs) // length
            score = 0
            for t in set(TERM.findall(brute.fold(text))):
                if tf[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0 and d is not None:
                scores.append((-score, d))
        out += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def test_ranked_search(spark):
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma-1", "é", "É", "x_y", "10", "of", "the", "日本", "zz" * 40]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for i in range(120)]
    docs += [(5, "alpha beta"), (5, "alpha beta"), (None, "alpha alpha"), (900, None), (901, ""), (902, " -- !"), (903, "the " * 20000 + "rare")]
    items = [(1, "Alpha of the 10 É"), (1, "Alpha of the 10 É"), (2, None), (3, ""), (None, "rare beta"), (4, "nowhere"), (5, "--"), (6, "x_y " * 3 + "gamma")]
    table = spark.createDataFrame([(d, t, 7, "x") for d, t in docs], "doc_id long, text string, n long, term string").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    for k, most in ((4, 20_000), (50, 2)):
        got = sorted([tuple(r) for r in lexical.rank_documents(table, asked, k, slice_items=most).collect()], key=str)
        assert got == ranked(docs, [x for x in items if x[1] is not None], k)
    for a, b in ((table.limit(0), asked), (table, asked.limit(0))):
        assert lexical.rank_documents(a, b).collect() == []
    assert lexical.rank_documents(table, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_nra_reads_until_ties_are_resolved(monkeypatch):
    rng = np.random.default_rng(0)
    for _ in range(150):
        docs, terms, k = int(rng.integers(1, 300)), int(rng.integers(1, 12)), int(rng.integers(1, 8))
        values = rng.integers(1, int(rng.choice([3, 50, 100000])), (terms, docs)) * (rng.random((terms, docs)) < rng.random((terms, 1)))
        t, d = np.nonzero(values)
        ids = rng.permutation(docs).astype(np.int64) * 3 - 50
        monkeypatch.setattr(lexical, "FIRST_READ", int(rng.integers(1, 30)))
        own = np.sort(rng.choice(terms, size=int(rng.integers(1, terms + 1)), replace=False))
        want = sorted((-s, i) for s, i in zip(values[own].sum(axis=0).tolist(), ids.tolist()) if s > 0)[:k]
        found, score = lexical.Shard(ids, d, t, values[t, d], terms).nra(own, k)
        assert [(-s, i) for s, i in zip(score.tolist(), found.tolist())] == want


def test_nra_gives_up_early():
    """Documents that cannot be among the best are not read to their end."""
    n = 50_000
    impacts = np.concatenate([np.full(n, 5), [1000], np.arange(n) % 7 + 1])
    docs = np.concatenate([np.arange(n), [n - 1], np.arange(n)])
    terms = np.concatenate([np.zeros(n, int), [1], np.full(n, 2)])
    shard = lexical.Shard(np.arange(n), docs, terms, impacts, 3)
    found, score = shard.nra(np.array([0, 1, 2]), 1)
    assert found.tolist() == [n - 1] and score.tolist() == [1005 + (n - 1) % 7 + 1]


@pytest.fixture(scope="module")
def chunks():
    return windows.ByteChunks(BYTES)


def test_chunks_give_the_ids_of_the_tokenizer(chunks):
    rng = random.Random(1)
    letters = list("ab'st L1 9.,!  \n\n\t\r\x0b\x0c\x85\xa0é ß_中́😀\x1c\x00<|") + ["<|endoftext|>", " ", " ", "'s", "'ll", "​", "　", " "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(12_000)]
    texts += ["", " ", "\n ", "a" * 5000, "\n" * 3000 + "a", "x " * 3000 + " " * 3000, "word " * 30_000]
    got = [x for a in range(0, len(texts), 1024) for x in chunks.texts(texts[a : a + 1024])]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(BYTES).encode_batch_fast(texts, add_special_tokens=False)]
    assert got == want


def test_sum_of_squares_level():
    rng = random.Random(2)
    fit = windows.SumOfSquares(24, 1000)
    for i in range(400):
        size = rng.randint(1, 24)
        counts = {level: len(w) for level, w in fit.at.items()}

        def squares(level):
            new = Counter(counts)
            new[level] -= bool(level)
            new[level + size] += 1
            return sum(n * n for x, n in new.items() if 0 < x < 24)

        allowed = [0, *(x for x in counts if x + size <= 24)]
        level = fit.level_for(size)
        assert level in allowed and squares(level) == min(map(squares, allowed))
        assert level == max(x for x in allowed if squares(x) == squares(level))
        fit.place((i, 0, bytes(4 * size), size))
    assert fit.n_open == sum(map(len, fit.at.values()))


def test_window_packing(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices(["lorem", "ipsum,", "Dolor\n", "sit", "naïve", "中文"], k=rng.choice([0, 3, 40, 300, 900])))) for i in range(150)]
    docs += [(1, "again"), (1, "again"), (None, "no id"), (None, None), (500, ""), (501, "long word " * 6000)]
    table = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, offset int").repartition(5)
    encode = Tokenizer.from_file(BYTES)
    bodies = Counter((d, np.array([*encode.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for d, t in docs)
    for open_windows in (512, 3):
        rows = windows.pack_windows(table, BYTES, open_windows=open_windows, with_ids=True).collect()
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length > 0 for r in rows)
        held = {}
        for r in rows:
            held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        sizes = []
        for own in held.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            sizes.append(at)
        total = sum(len(b) // 4 * n for (_, b), n in bodies.items())
        assert sum(sizes) == total and all(s == 2048 or not s & (s - 1) for s in sizes)
        assert len(sizes) <= total // 2048 + 12 * 7
        pieces = Counter((r.doc_id, r.start, r.ids, r.doc_tokens) for r in rows)
        want = Counter()
        for (d, body), n in bodies.items():  # rows of one id and text may be cut at different places
            assert sum(m * len(p[2]) for p, m in pieces.items() if p[0] == d and body[4 * p[1] : 4 * p[1] + len(p[2])] == p[2] and p[3] == len(body) // 4) == n * len(body)
            want[d] += n * len(body)
        assert want == Counter({d: sum(m * len(p[2]) for p, m in pieces.items() if p[0] == d) for d in want})
    assert windows.pack_windows(table.limit(0), BYTES).collect() == []


def test_windows_survive_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(windows, "MERGED_TASKS", 2)
    table = spark.range(0, 300, 1, 9).selectExpr("id AS doc_id", "repeat('abc def ', cast(id % 50 AS int)) AS text")
    rows = windows.pack_windows(table, BYTES).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    assert all(s == 2048 or not s & (s - 1) for s in sizes.values())
    assert Counter({r.doc_id: r.doc_tokens for r in rows}) == Counter(sum((Counter({r.doc_id: r.length}) for r in rows), Counter()))


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def merkle(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        own = sorted(by[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[x] = own, levels([leaf(r) for r in own])
    top, out = levels([trees[x][1][-1][0] for x in langs]), []
    for k, x in enumerate(langs):
        own, tree = trees[x]
        for i, r in enumerate(own):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            h, siblings = leaf((*r[:3], r[3] + 1, r[4]) if tampered else r), []
            for nodes, at in ((tree, i), (top, k)):
                for level in nodes[:-1]:
                    pair = level[at // 2 * 2 : at // 2 * 2 + 2]
                    siblings += [p for j, p in enumerate(pair) if j != at % 2]
                    pair[at % 2] = h
                    h, at = H("".join(pair)), at // 2
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], H("".join(siblings)), h, h == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, langs, height", [(0, 1, 10), (1, 1, 10), (2, 2, 1), (3, 1, 10), (41, 9, 2), (300, 3, 2), (300, 3, 10)])
def test_manifest(spark, n, langs, height):
    rng = random.Random(n)
    rows = [
        (rng.choice([None, i, i // 2, -i]), rng.choice([None, "a", "é"]), rng.choice([None, "", "en", *map(str, range(langs))]) if langs > 1 else "x",
         rng.choice([None, 5, 7]), rng.choice([None, "", "text " * i, "ü"]), "more") for i in range(n)
    ]
    rows += rows[:2]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, tree string")
    got = manifest.merkle_manifest(table.repartition(3) if n else table, block_levels=height)
    assert sorted([tuple(r) for r in got.collect()], key=str) == merkle([r[:5] for r in rows])


def test_manifest_of_a_long_text(spark):
    rows = [(1, "s", "x", 2, "é" * 3_000_000), (2, "s", "x", None, "")]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted([tuple(r) for r in manifest.merkle_manifest(table).collect()], key=str) == merkle(rows)


def test_words_in_thue_morse_order(spark):
    """Sequences that collide under any polynomial hash with a power of two as modulus."""
    from ledgerloom.llm import jaccard, lines, passages

    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    (s,) = W.word_slices(pa.array([one, two]))
    assert len(set(s.hashes.tolist())) == len(set(W.word_hashes(s.data, s.starts, s.ends, 1).tolist())) == 2
    lead = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{lead} {one}"), (2, f"{lead} {two}")], "doc_id long, text string")
    assert [tuple(r)[:3] for r in passages.drop_repeated_passages(docs).orderBy("doc_id").collect()] == [(1, 13, 0), (2, 13, 0)]
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert [r.component_id for r in jaccard.jaccard_groups(docs).orderBy("doc_id").collect()] == [1, 2]
    assert [r.n_removed for r in lines.dedupe_lines(docs, 1).orderBy("doc_id").collect()] == [0, 0]


def test_word_hashes_by_length():
    words = ["x" * n for n in range(1, 40)] + ["y" * 2048, "y" * 2049, "Y" * 2048, "Y" * 2049, "é" * 5000]
    (s,) = W.word_slices(pa.array([" ".join(words)]), lower=True, limit=1 << 20)
    assert len(set(s.hashes.tolist())) == len(words) - 2
    alone = [next(iter(W.word_slices(pa.array([w]), lower=True))).hashes[0] for w in words]
    assert s.hashes.tolist() == [int(x) for x in alone]


def test_long_windows(spark):
    from ledgerloom.llm import passages

    text = " ".join(f"w{i}" for i in range(120))
    docs = spark.createDataFrame([(1, text), (2, text + " end")], "doc_id long, text string")
    got = passages.drop_repeated_passages(docs, window=100).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [0, 120]
