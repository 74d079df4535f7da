"""The exact top-k similarity join against all pairs."""

import random

from ledgerloom.functions.text import name_similarity
from ledgerloom.operators import similar
from pyspark.sql import functions as F


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def similarity(a, b):
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    m, n, x, y = max(len(a), len(b)), min(len(a), len(b)), set(a.split(" ")), set(b.split(" "))
    return max(1 - levenshtein(a, b) / m, len(x & y) / len(x | y), n / m if a in b or b in a else 0.0)


def test_distances():
    r = random.Random(1)
    for _ in range(200):
        letters = r.choice(["ab", "abcdefgh", "aé😀x"])
        a = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 5, 63, 64, 65, 90])))
        others = ["".join(r.choice(letters) for _ in range(r.choice([0, 1, 7, 64, 70]))) for _ in range(4)]
        (code, *_), codes = similar._codes([a])[0], similar._codes(others)
        assert similar.edit_distances(code[: len(a)], *codes).tolist() == [levenshtein(a, b) for b in others]


def test_best_of_a_tile():
    r = random.Random(0)
    for _ in range(60):
        letters = r.choice(["ab ", "abcdefgh ", "aé😀 x"])
        names = sorted({"".join(r.choice(letters) for _ in range(r.randint(0, 9))) for _ in range(r.randint(1, 60))})
        index = similar.NameIndex(names)
        for name in names[:5] + ["".join(r.choice(letters) for _ in range(r.randint(0, 9))) for _ in range(5)]:
            k = r.randint(1, 6)
            want = sorted((-similarity(name, n), n) for n in names)[:k]
            assert [(-s, n) for s, n in index.best(name, k)] == want


def test_join(spark):
    r = random.Random(3)
    words = ["real", "club", "atletico", "madrid", "roma", "as", "fc", "inter"]
    known = [(r.choice(["x", "y"]), " ".join(r.sample(words, r.randint(1, 4))) + r.choice(["", "a", " s"])) for _ in range(150)] + [("x", ""), ("x", None), (None, "roma"), ("x", "roma"), ("x", "roma")]
    asked = [(b, n[1:] if n else n) for b, n in known[::3]] + [("z", "roma"), ("x", "")]
    left, right = spark.createDataFrame(asked, "b string, n string"), spark.createDataFrame(known, "b string, o string")
    for tile in (8192, 7):
        got = similar.top_k_similar(left, right, ["b"], "n", "o", 3, tile)
        pairs = left.dropna().distinct().join(right.dropna().distinct(), "b").withColumn("score", name_similarity(F.col("n"), F.col("o")))
        want = {}
        for p in pairs.collect():
            want.setdefault((p.b, p.n), []).append((-p.score, p.o))
        found = {}
        for g in got.collect():
            found.setdefault((g.b, g.n), []).append((g.place, -g.score, g.o))
        assert {k: [x[1:] for x in sorted(v)] for k, v in found.items()} == {k: sorted(v)[:3] for k, v in want.items()}
        assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in found.values())
    assert similar.top_k_similar(left.limit(0), right, ["b"], "n", "o").count() == similar.top_k_similar(left, right.limit(0), ["b"], "n", "o").count() == 0


def test_a_block_of_many_names(spark):
    """Aliases of a large block are found without a distance to most of its names."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(4000)]
    names = list({" ".join(r.sample(words, r.randint(2, 4))) for _ in range(20_000)})
    index = similar.NameIndex(names)
    for n in names[:40]:
        alias = n[:-1] + "x"
        assert index.best(alias, 1)[0][1] == n
    assert index.distances.computed < 0.1 * 40 * len(names)
    known = spark.createDataFrame([("b", n) for n in names], "b string, o string")
    asked = spark.createDataFrame([("b", n[:-1] + "x") for n in names[:60]], "b string, n string")
    got = {g.n: g.o for g in similar.top_k_similar(asked, known, ["b"], "n", "o", 1, 4096).collect()}
    assert got == {n[:-1] + "x": n for n in names[:60]}
