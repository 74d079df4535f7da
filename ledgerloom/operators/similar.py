"""Exact top-k similarity join of names, by an index of letters and words with bounds.

The similarity of two names is the best of edit, word and containment similarity
(``ledgerloom.functions.text.name_similarity``).  For a name, the names of its block are grouped by their
profile: length, counts of letters and of pairs of letters, words.  None of the three parts can pass a
bound that the profiles alone give: two names of lengths m >= n that share c letters and p pairs have an
edit distance of m - c and of half of m - 1 - p at least, as an edit destroys one letter and two pairs;
contained names differ by nothing but length; word similarity follows from the words.  Names are visited
in the order of their bound, and the search stops when no unseen name can enter the best k.  Where the
edit bound is not above the word similarity, no distance is computed; and distances of names that
meet in several blocks of a task are remembered, up to a bounded number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Names of a block that one task indexes at once, classes of letters and of pairs, names scored in the first and in any later step.
TILE, LETTERS, PAIRS, STEP, MOST = 8192, 64, 128, 4, 256


def _codes(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all names on a row each, filled with 0; lengths)."""
    size = np.array([len(n) for n in names], np.int64)
    out = np.zeros((len(names), max(int(size.max(initial=0)), 1)), np.uint32)
    for i, n in enumerate(names):
        out[i, : len(n)] = np.frombuffer(n.encode("utf-32-le", "surrogatepass"), "<u4")
    return out, size


def _counts(values: np.ndarray, there: np.ndarray, classes: int) -> np.ndarray:
    """How often each class occurs in every row."""
    rows = np.repeat(np.arange(len(values)), there.sum(axis=1))
    return np.bincount(rows * classes + values[there] % classes, minlength=len(values) * classes).reshape(len(values), classes).astype(np.int32)


def _profiles(codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of letters (code point modulo ``LETTERS``) and of pairs of letters of every name."""
    there = np.arange(codes.shape[1])[None, :] < size[:, None]
    pairs = codes[:, :-1] * np.uint32(31) + codes[:, 1:]
    return _counts(codes, there, LETTERS), _counts(pairs, there[:, 1:], PAIRS)


def edit_distances(a: np.ndarray, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Levenshtein distances of one name to many at once.

    Up to 64 letters a column of the table is two words of bits, the rises and the falls from row to row
    (Myers' form), and a step takes a column of all names; longer names take the table row by row.
    """
    m = len(a)
    if m == 0:
        return size.copy()
    if m > 64:
        return _long_distances(a, codes, size)
    u, one = np.uint64, np.uint64(1)
    letters, at = np.unique(a, return_inverse=True)
    masks = np.zeros(len(letters) + 1, u)
    np.bitwise_or.at(masks, at, one << np.arange(m, dtype=u))
    found = np.minimum(np.searchsorted(letters, codes), len(letters) - 1)
    equal = masks[np.where(letters[found] == codes, found, len(letters))]
    rise, fall = np.full(len(codes), ~u(0)), np.zeros(len(codes), u)
    score, top = np.full(len(codes), m, np.int64), u(m - 1)
    with np.errstate(over="ignore"):
        for j in range(int(size.max(initial=0))):
            eq = equal[:, j]
            vertical = eq | fall
            across = (((eq & rise) + rise) ^ rise) | eq
            up, down = fall | ~(across | rise), rise & across
            live = size > j
            score += live & ((up >> top) & one).astype(bool)
            score -= live & ((down >> top) & one).astype(bool)
            up, down = (up << one) | one, down << one
            rise, fall = down | ~(vertical | up), up & vertical
    return score


def _long_distances(a: np.ndarray, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    n = codes.shape[1]
    steps = np.arange(n + 1, dtype=np.int32)
    row = np.broadcast_to(steps, (len(codes), n + 1)).copy()
    for i, c in enumerate(a.tolist(), 1):
        new = np.empty_like(row)
        new[:, 0] = i
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (codes != c), out=new[:, 1:])
        # an insertion costs one a step: the least of all that stand before, less their distance
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row[np.arange(len(codes)), size]


class Distances:
    """Edit distances that a task has computed; the oldest half goes when there are too many."""

    def __init__(self, most: int = 400_000):
        self.most, self.known, self.computed = most, {}, 0

    def of(self, name: str, code: np.ndarray, others: list[str], codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        keys = [(name, o) for o in others]
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if new:
            self.computed += len(new)
            self.known.update(zip((keys[i] for i in new), edit_distances(code, codes[new], size[new]).tolist()))
        out = np.array([self.known[key] for key in keys])
        if len(self.known) > self.most:
            for key in list(self.known)[: self.most // 2]:
                del self.known[key]
        return out


class NameIndex:
    """The distinct names of one tile of a block."""

    def __init__(self, names: list[str], distances: Distances | None = None):
        self.names = names
        self.distances = distances or Distances()
        self.order = np.argsort(np.array(names, dtype=object), kind="stable")  # ties go by name
        self.place = np.empty(len(names), np.int64)
        self.place[self.order] = np.arange(len(names))
        self.codes, self.size = _codes(names)
        self.letters, self.pairs = _profiles(self.codes, self.size)
        self.words = [set(n.split(" ")) for n in names]
        self.count = np.array([len(w) for w in self.words])
        self.holders: dict[str, list[int]] = {}
        for i, own in enumerate(self.words):
            for w in own:
                self.holders.setdefault(w, []).append(i)

    def best(self, name: str, k: int) -> list[tuple[float, str]]:
        """The k most similar names, best first, ties by name."""
        m = len(name)
        if m == 0 or not self.names:
            return [(0.0, self.names[i]) for i in self.order[:k].tolist()]
        codes, size = _codes([name])
        longest, shortest = np.maximum(self.size, m), np.minimum(self.size, m)
        letters, pairs = _profiles(codes, size)
        common = np.minimum(letters, self.letters).sum(axis=1)
        least = np.maximum(longest - common, (longest - np.minimum(pairs, self.pairs).sum(axis=1)) // 2)  # (longest - 1 - pairs) / 2, rounded up
        own = set(name.split(" "))
        both = np.zeros(len(self.names), np.int64)
        for w in own:
            both[self.holders.get(w, [])] += 1
        tokens = both / (len(own) + self.count - both)
        # a contained name has all its letters in the other one
        within = np.where((common == shortest) & (self.size > 0), shortest / longest, 0.0)
        edit_bound = 1.0 - least / longest
        bound = np.where(self.size == 0, 0.0, np.maximum(np.maximum(edit_bound, tokens), within))
        order = np.lexsort((self.place, -bound))
        found: list[tuple[float, int]] = []
        at, step = 0, STEP
        while at < len(order) and not (len(found) == k and (-bound[order[at]], self.place[order[at]]) > found[-1]):
            part = order[at : at + step]
            at, step = at + step, min(2 * step, MOST)
            value = np.maximum(tokens[part], 0.0)
            asked = np.flatnonzero(edit_bound[part] > value)
            if len(asked):
                i = part[asked]
                edits = self.distances.of(name, codes[0], [self.names[x] for x in i.tolist()], self.codes[i], self.size[i])
                value[asked] = np.maximum(value[asked], 1.0 - edits / longest[i])
            for i, v in zip(part.tolist(), value.tolist()):
                other = self.names[i]
                inside = float(shortest[i] / longest[i]) if within[i] and (other in name or name in other) else 0.0
                found.append((-(0.0 if other == "" else 1.0 if other == name else max(v, inside)), int(self.place[i])))
            found = sorted(found)[:k]
        return [(-s, self.names[self.order[p]]) for s, p in found]


def _search(k: int, key: str):
    """Rows sorted by tile, the tile's names first: the best k of the tile for each asked name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, index, distances = None, [], None, Distances()
        for batch in batches:
            blocks = batch.column(0)
            found: list[tuple[int, str, str, float]] = []
            for i, (at, asked, name) in enumerate(zip(*(batch.column(j).to_pylist() for j in (1, 2, 3)))):
                block = blocks[i].as_py()
                if (block, at) != tile:
                    tile, held, index = (block, at), [], None
                if not asked:
                    held.append(name)
                    continue
                if index is None:
                    index = NameIndex(held, distances)
                found += [(i, name, other, score) for score, other in index.best(name, k)]
            if found:
                rows, names, others, scores = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [blocks.take(pa.array(rows)), pa.array(names), pa.array(others), pa.array(scores, pa.float64())], [key, "name", "other", "score"],
                )

    return run


def top_k_similar(asked: DataFrame, known: DataFrame, block: list[str], name: str, other: str, k: int = 5, tile: int = TILE) -> DataFrame:
    """(block, name, other, score, place): for every distinct asked name of a block the k most similar known names of the block.

    Exact; ties go by name.  A block's names are dealt into tiles of about ``tile`` names by a hash, so no
    task holds a large block; asked names meet each tile of their block, and the best k of the tiles are
    ranked again.  Null names or blocks take no part; an empty name is like nothing (score 0).
    """
    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = asked.select(*block, F.col(name).alias("_n")).dropna().distinct()
    right = known.select(*block, F.col(other).alias("_n")).dropna().distinct()
    sizes = right.groupBy(*block).agg(F.ceil(F.count("*") / tile).cast("int").alias("_t"))
    dealt = right.join(sizes, block).withColumn("_tile", F.pmod(F.xxhash64("_n"), F.col("_t")).cast("int"))
    meets = left.join(sizes, block).withColumn("_tile", F.explode(F.sequence(F.lit(0), F.col("_t") - 1)))
    key = F.struct(*block).alias("_b")
    both = dealt.select(key, "_tile", F.lit(False).alias("_asked"), "_n").unionByName(meets.select(key, "_tile", F.lit(True).alias("_asked"), "_n"))
    schema = f"_b {both.schema['_b'].dataType.simpleString()}, name string, other string, score double"
    found = both.repartition(parts, "_b", "_tile").sortWithinPartitions("_b", "_tile", "_asked", "_n").mapInArrow(_search(k, "_b"), schema)
    flat = found.select("_b.*", F.col("name").alias(name), F.col("other").alias(other), "score")
    at = F.row_number().over(Window.partitionBy(*block, name).orderBy(F.desc("score"), other))
    return flat.withColumn("place", at).where(F.col("place") <= k)
