"""Benchmark decontamination with SimHash windows.

Every benchmark item is compared with the windows of a document that have as many words as the item
(a shorter document is one window).  A window's SimHash is taken over its word shingles.  The 64 bits
are split into four blocks of 16: of two fingerprints within ``radius`` some block differs in at most
``radius // 4`` bits (in one bit less from the block ``radius % 4 + 2`` on), so looking up every block
with all such changes gives each pair within the radius.  These are verified by the exact weighted
similarity of their shingles, sum(min) / sum(max) of their counts.

A window is fingerprinted only if enough of its shingles occur in any item of its length: fewer than
t (a + b) / (1 + t) shared ones of a and b cannot reach the similarity t, so this loses nothing.

Distinct item texts are held in memory in slices of at most ``slice_items`` texts and ``slice_bytes``
bytes (or one text); every slice is one pass over the documents.  Fingerprints are summed over spans
of bounded length, so memory follows the longest item, not the longest document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .scratch import Scratch

WORDS, THRESHOLD, RADIUS, SLICE_ITEMS, SLICE_BYTES = 5, 0.75, 18, 20_000, 64 << 20
BLOCKS, BLOCK_BITS = 4, 16
#: Shingles whose signs are held at once, besides one window.
SPAN = 1 << 14
_U = np.uint64


def signs(grams: np.ndarray) -> np.ndarray:
    """n x 64 matrix of +1 and -1, the bits of re-mixed shingle hashes."""
    bits = np.unpackbits(W.mix64(grams ^ _U(0x6A09E667F3BCC909)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(totals: np.ndarray) -> np.ndarray:
    return np.packbits(totals > 0, axis=1, bitorder="little").view(_U).ravel()


def fingerprint(grams: np.ndarray) -> np.uint64:
    """SimHash of all shingles."""
    total = sum(signs(grams[a : a + SPAN]).sum(axis=0, keepdims=True, dtype=np.int64) for a in range(0, len(grams), SPAN))
    return fingerprints(total)[0]


def window_prints(grams: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows of ``width`` shingles at ascending ``starts``."""
    out = np.empty(len(starts), _U)
    new = (np.diff(starts) > width) | (np.diff(starts // SPAN) > 0)
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(starts)]
    for a, b in zip(edges, edges[1:]):
        at = starts[a:b] - starts[a]
        sums = np.zeros((int(at[-1]) + width + 1, 64), np.int32)
        np.cumsum(signs(grams[starts[a] : starts[a] + len(sums) - 1]), axis=0, out=sums[1:])
        out[a:b] = fingerprints(sums[at + width] - sums[at])
    return out


class Index:
    """Item texts of one slice with their keys."""

    def __init__(self, items: list[tuple[str, str]], k: int, radius: int):
        self.radius = radius
        self.keys, self.grams, self.weights = [], [], []
        words, prints = [], []
        gates: dict[int, list[np.ndarray]] = defaultdict(list)
        for s in W.word_slices(pa.array([t for _, t in items], pa.string())):
            for i in range(s.rows):
                h = s.hashes[s.bounds[i] : s.bounds[i + 1]]
                if len(h) == 0:
                    continue
                size = min(k, len(h))
                grams = W.window_hashes(h, size)
                g, w = np.unique(grams, return_counts=True)
                words.append(len(h))
                self.keys.append(items[s.first + i][0])
                self.grams.append(g)
                self.weights.append(w)
                gates[size].append(g)
                prints.append(fingerprint(grams))
        self.words, self.prints = np.array(words, np.int64), np.array(prints, _U)
        self.lengths = sorted(set(words))
        own: dict[int, list[np.ndarray]] = defaultdict(list)
        for m, g in zip(words, self.grams):
            own[m].append(g)
        self.gates = {size: np.unique(np.concatenate(g)) for size, g in gates.items()}
        self.sieves = {}
        for size, gate in self.gates.items():
            sieve = np.zeros(1 << 20, bool)
            sieve[(gate >> _U(44)).astype(np.int64)] = True
            self.sieves[size] = sieve
        #: places in the gate of the shingles that items of a length have
        self.own = {m: np.unique(np.searchsorted(self.gates[min(k, m)], np.concatenate(g))) for m, g in own.items()}
        changed = np.bitwise_count(np.arange(1 << BLOCK_BITS, dtype=np.uint16))
        self.tables = []
        for b in range(BLOCKS):
            within = radius // BLOCKS - (b > radius % BLOCKS)
            value = self._block(self.prints, b)
            order = np.argsort(value, kind="stable").astype(np.int32)
            cuts = np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int32)
            self.tables.append((order, cuts, np.flatnonzero(changed <= within) if within >= 0 else np.zeros(0, np.int64)))

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> _U(b * BLOCK_BITS)) & _U((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def gate(self, grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, place in the gate) of the shingles that occur in an item."""
        maybe = np.flatnonzero(self.sieves[size][(grams >> _U(44)).astype(np.int64)])
        gate = self.gates[size]
        at = np.minimum(np.searchsorted(gate, grams[maybe]), len(gate) - 1)
        hit = gate[at] == grams[maybe]
        return maybe[hit], at[hit]

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs that the block tables give, repeated ones included."""
        windows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b, (order, cuts, changes) in enumerate(self.tables):
            value = self._block(prints, b)[:, None] ^ changes[None, :]
            first, size = cuts[value].ravel(), (cuts[value + 1] - cuts[value]).ravel()
            hit = np.flatnonzero(size)
            first, size = first[hit], size[hit]
            at = np.arange(size.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            windows.append(np.repeat(hit // max(len(changes), 1), size))
            found.append(order[at.astype(np.int64)])
        return np.concatenate(windows), np.concatenate(found)

    def near(self, m: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius among items of m words."""
        pairs = [np.zeros((2, 0), np.int64)]
        for a in range(0, len(prints), 32):
            part = prints[a : a + 32]
            w, i = self.candidates(part)
            close = (self.words[i] == m) & (np.bitwise_count(part[w] ^ self.prints[i]) <= self.radius)
            pairs.append(np.unique(np.stack([w[close] + a, i[close]]), axis=1))
        return tuple(np.concatenate(pairs, axis=1))

    def similarity(self, grams: np.ndarray, item: int) -> float:
        g, w = np.unique(grams, return_counts=True)
        _, a, b = np.intersect1d(g, self.grams[item], assume_unique=True, return_indices=True)
        own = self.weights[item]
        both = int(np.minimum(w[a], own[b]).sum())
        return both / (int(w.sum()) + int(own.sum()) - both)

    def matches(self, h: np.ndarray, hits: dict[int, tuple[np.ndarray, np.ndarray]], k: int, threshold: float) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, first word, words) of its best window in one document.

        ``hits`` has the (positions, places in the gate) of item shingles per shingle size.
        """
        best: dict[int, tuple[float, int, int]] = {}
        grams: dict[int, np.ndarray] = {}
        for m in self.lengths:
            size = min(k, m)
            at, place = hits[size]
            if len(at) == 0 or len(h) < size:
                continue
            own, total = m - size + 1, len(h) - size + 1
            width = min(own, total)
            least = max(int(np.ceil(threshold * (own + width) / (1 + threshold) - 1e-9)), 1)
            if len(at) < least:
                continue
            among = self.own[m]
            at = at[among[np.minimum(np.searchsorted(among, place), len(among) - 1)] == place]
            starts = dense_starts(at, width, least, total - width)
            if len(starts) == 0:
                continue
            if size not in grams:
                grams[size] = W.window_hashes(h, size)
            w, items = self.near(m, window_prints(grams[size], starts, width))
            for a, item in zip(starts[w].tolist(), items.tolist()):
                sim = self.similarity(grams[size][a : a + width], item)
                if sim >= threshold and (item not in best or sim > best[item][0]):
                    best[item] = (sim, a, min(m, len(h)))
        return best


def dense_starts(at: np.ndarray, width: int, least: int, last: int) -> np.ndarray:
    """Starts from 0 to ``last`` of windows of ``width`` places that hold at least ``least`` of the ascending places."""
    if len(at) < least:
        return np.zeros(0, np.int64)
    low = np.maximum(at[least - 1 :] - width + 1, 0)
    high = np.minimum(at[: len(at) - least + 1], last)
    ok = low <= high
    low, size = low[ok], (high - low + 1)[ok]
    return np.unique(np.arange(size.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size))


def _scan(index, k: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = index.value
        for batch in batches:
            ids, out = batch.column(0), []
            for s in W.word_slices(batch.column(1)):
                marked, rows = {}, [np.zeros(0, np.int64)]
                for size in ix.gates:
                    at, place = ix.gate(W.window_hashes(s.hashes, size), size)
                    row = np.searchsorted(s.bounds, at, side="right") - 1
                    whole = at + size <= s.bounds[row + 1]
                    marked[size] = at[whole], place[whole]
                    rows.append(row[whole])
                for i in np.unique(np.concatenate(rows)).tolist():
                    a, b = int(s.bounds[i]), int(s.bounds[i + 1])
                    hits = {}
                    for size, (at, place) in marked.items():
                        x, y = np.searchsorted(at, [a, b])
                        hits[size] = at[x:y] - a, place[x:y]
                    for item, (sim, start, n) in ix.matches(s.hashes[a:b], hits, k, threshold).items():
                        out.append((ids[s.first + i].as_py(), ix.keys[item], sim, start, n))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()))],
                    ["doc_id", "key", "similarity", "start_word", "n_words"],
                )

    return run


def text_slices(texts: DataFrame, most_items: int, most_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """(key, text) rows as lists of bounded number and size."""
    part, size = [], 0
    for r in texts.toLocalIterator():
        own = len(r.text.encode())
        if part and (len(part) == most_items or size + own > most_bytes):
            yield part
            part, size = [], 0
        part.append((r.key, r.text))
        size += own
    if part:
        yield part


def find_leaks(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, radius: int = RADIUS,
               slice_items: int = SLICE_ITEMS, slice_bytes: int = SLICE_BYTES, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words) of every contaminated document and item.

    One row per row of ``docs`` and row of ``benchmark`` whose best window reaches the threshold; of
    equal windows the first counts.  Both texts are lower-cased.  Texts with fewer than ``words`` words
    are one shingle; texts of any length are searched whole.  Null and empty texts and items match
    nothing; a null doc_id or item_id stays null in its rows; repeated rows give repeated rows.  Empty
    tables give an empty result.  Extra columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"lower(cast(`{text_col}` AS string)) AS text").where("text IS NOT NULL")
    items = benchmark.selectExpr(f"cast(`{item_col}` AS long) AS item_id", f"lower(cast(`{item_text_col}` AS string)) AS text").where("text IS NOT NULL")
    key = F.sha2("text", 256).alias("key")
    schema = "doc_id long, key string, similarity double, start_word long, n_words long"
    # an empty table of the JVM's own; one made of Python rows would start more Python workers
    found = [spark.range(0).selectExpr("id AS doc_id", "cast(NULL AS string) AS key", "cast(NULL AS double) AS similarity", "id AS start_word", "id AS n_words")]
    for part in text_slices(items.select("text").distinct().select(key, "text"), slice_items, slice_bytes):
        index = Index(part, words, radius)
        if index.keys:
            shared = spark.sparkContext.broadcast(index)
            found.append(scratch.write(rows.mapInArrow(_scan(shared, words, threshold), schema)))
            shared.destroy()
    return reduce(DataFrame.unionByName, found).join(items.select("item_id", key), "key").select("doc_id", "item_id", "similarity", "start_word", "n_words")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
