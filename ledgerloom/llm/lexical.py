"""Ranked lexical search by NRA (no random access) over impact-sorted postings.

One pass over the documents writes, for every document, its number of terms and the occurrences of
the terms that any benchmark item asks for; corpus statistics are aggregates of that table.  What a
term adds to a document's score does not depend on the item, so a posting is (document, impact).

The table is then searched in shards of bounded size.  A shard's postings are sorted by impact, and
for each item the lists of its terms are read in step, each further read going deeper.  A document's
lower bound is the sum of the impacts read so far; its upper bound adds, for every list in which it
has not been met, the largest impact that is still unread there.  Documents whose upper bound is below
the k-th lower bound are given up.  Reading goes on until the two bounds are equal for every document
that is left, so membership, ties and scores are final; a list in which all of them have been met is
read no further.  The best k of the shards are merged, first in each task, then by two ranking steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .decontaminate import text_slices
from .scratch import Scratch

K, SLICE_ITEMS, SLICE_BYTES = 50, 20_000, 64 << 20
SHARD_DOCS, SHARD_POSTINGS, SHARD_CELLS = 16_384, 1 << 21, 1 << 24
#: Postings that the first read takes from every list, and how much deeper each further read goes.
FIRST_READ, DEEPER = 256, 4
#: Ranking tasks that share an item before the last ranking.
SALTS = 64
#: Bytes that no term holds: all of ASCII but digits and letters.
IS_BREAK = np.ones(256, bool)
IS_BREAK[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    IS_BREAK[_a:_b] = False
_U = np.uint64


class Terms:
    """The distinct terms of a slice of item texts, numbered, and the terms of every item."""

    def __init__(self, items: list[tuple[str, str]]):
        self.keys = [key for key, _ in items]
        own, one, two = [np.zeros(0, np.int64)] * len(items), [np.zeros(0, _U)], [np.zeros(0, _U)]
        for s in W.word_slices(pa.array([text for _, text in items], pa.string()), lower=True, separators=IS_BREAK):
            one.append(s.hashes)
            two.append(W.word_hashes(s.data, s.starts, s.ends, 1, lower=True))
            for i in range(s.rows):
                own[s.first + i] = s.hashes[s.bounds[i] : s.bounds[i + 1]]
        self.hashes, at = np.unique(np.concatenate(one), return_index=True)
        self.check = np.concatenate(two)[at]
        self.items = [np.unique(np.searchsorted(self.hashes, h)) for h in own]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.hashes >> _U(44)).astype(np.int64)] = True

    def find(self, s: W.Slice) -> tuple[np.ndarray, np.ndarray]:
        """(places of words that are terms, their numbers); 128 bits of a word decide."""
        if len(self.hashes) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.sieve[(s.hashes >> _U(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, s.hashes[maybe]), len(self.hashes) - 1)
        same = self.hashes[at] == s.hashes[maybe]
        maybe, at = maybe[same], at[same]
        same = self.check[at] == W.word_hashes(s.data, s.starts[maybe], s.ends[maybe], 1, lower=True)
        return maybe[same], at[same]


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])


def _count_terms(shared):
    """(doc_id, n, terms, tf) of every row that has a term at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: Terms = shared.value
        width = max(len(terms.hashes), 1)
        for batch in batches:
            ids = batch.column(0)
            for s in W.word_slices(batch.column(1), lower=True, separators=IS_BREAK):
                n = np.diff(s.bounds)
                at, number = terms.find(s)
                row = np.searchsorted(s.bounds, at, side="right") - 1
                pair, tf = np.unique(row * width + number, return_counts=True)
                cuts = np.searchsorted(pair, np.arange(s.rows + 1) * width).astype(np.int32)
                rows = pa.RecordBatch.from_arrays([
                    ids.slice(s.first, s.rows), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array((pair % width).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(tf.astype(np.int64))),
                ], schema=_COUNTS)
                yield rows.filter(pa.array(n > 0))

    return run


class Shard:
    """Impact-sorted posting lists of some documents; ``ids`` ascend, so an earlier document wins a tie."""

    def __init__(self, ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        rank = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[rank] = np.arange(len(ids))
        self.ids = ids[rank]
        docs = place[docs]
        order = np.lexsort((-impacts, terms))
        self.docs, self.impacts = docs[order], impacts[order]
        self.cuts = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def nra(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(doc_ids, scores) of the k best documents with a score above 0, the best first."""
        begin, size = self.cuts[terms], self.cuts[terms + 1] - self.cuts[terms]
        begin, size = begin[size > 0], size[size > 0]
        n_lists = len(size)
        lower = np.zeros(len(self.ids), np.int64)
        met = np.zeros((n_lists, len(self.ids)), bool)
        left = np.arange(len(self.ids))  # documents that may still be among the best
        slot = None  # place in ``left`` of every document once some have been given up
        read, depth = np.zeros(n_lists, np.int64), FIRST_READ
        reading = np.arange(n_lists)
        while len(reading):
            for i in reading.tolist():
                a, b = begin[i] + read[i], begin[i] + min(depth, size[i])
                docs, impacts = self.docs[a:b], self.impacts[a:b]
                if slot is not None:
                    at = slot[docs]
                    docs, impacts = at[at >= 0], impacts[at >= 0]
                lower[docs] += impacts
                met[i, docs] = True
            read[reading] = np.minimum(depth, size[reading])
            depth *= DEEPER
            ahead = np.where(read < size, self.impacts[np.minimum(begin + read, len(self.impacts) - 1)], 0)
            upper = lower + ahead.sum() - ahead @ met
            bar = max(int(np.partition(lower, len(lower) - k)[len(lower) - k]), 1) if len(lower) > k else 1
            keep = upper >= bar
            if 2 * keep.sum() < len(left):
                left, lower, met, upper = left[keep], lower[keep], np.ascontiguousarray(met[:, keep]), upper[keep]
                slot = np.full(len(self.ids), -1)
                slot[left] = np.arange(len(left))
                keep = np.ones(len(left), bool)
            open_ = keep & (upper > lower)
            reading = np.flatnonzero((read < size) & ~met[:, open_].all(axis=1)) if open_.any() else reading[:0]
        best = np.flatnonzero(lower > 0)
        best = best[np.lexsort((left[best], -lower[best]))[:k]]
        return self.ids[left[best]], lower[best]


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What a term of ``weight`` adds to documents with ``n`` terms, all integers."""
    m = 100 - 50 + (50 * n * docs) // length
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _search(shared, k: int):
    """(key, doc_id, score): the k best of every item over the rows of a task, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, docs, length = shared.value
        most = min(SHARD_DOCS, max(SHARD_CELLS // max((len(t) for _, t in items), default=1), 64))
        best = {key: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for key, _ in items}
        waiting: list[tuple] = []

        def search() -> None:
            ids, n, size, terms, tf = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            owner = np.repeat(np.arange(len(ids)), size)
            value = impacts(tf, n[owner], weights[terms], docs, length)
            some = value > 0
            shard = Shard(ids, owner[some], terms[some], value[some], len(weights))
            for key, own in items:
                found, score = shard.nra(own, k)
                if len(found):
                    found, score = np.concatenate([best[key][0], found]), np.concatenate([best[key][1], score])
                    top = np.lexsort((found, -score))[:k]
                    best[key] = found[top], score[top]

        held = 0
        for batch in batches:
            at = 0
            cuts = batch.column("terms").offsets.to_numpy()
            while at < batch.num_rows:
                rows = min(batch.num_rows - at, most - sum(len(w[0]) for w in waiting))
                rows = min(rows, max(int(np.searchsorted(cuts, cuts[at] + SHARD_POSTINGS - held, side="right")) - 1 - at, 1))
                part = batch.slice(at, rows)
                terms, tf = part.column("terms"), part.column("tf")
                waiting.append((
                    part.column("doc_id").to_numpy(zero_copy_only=False), part.column("n").to_numpy(zero_copy_only=False), np.diff(terms.offsets.to_numpy()),
                    terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64), tf.flatten().to_numpy(zero_copy_only=False),
                ))
                held += len(waiting[-1][3])
                at += rows
                if held >= SHARD_POSTINGS or sum(len(w[0]) for w in waiting) >= most:
                    search()
                    held = 0
        if waiting:
            search()
        for key, (found, score) in best.items():
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(found)), pa.array(found, pa.int64()), pa.array(score, pa.int64())], ["key", "doc_id", "score"],
                )

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, slice_items: int = SLICE_ITEMS, slice_bytes: int = SLICE_BYTES,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of every item with the highest scores above 0.

    Terms are runs of digits, letters and all bytes beyond ASCII, A-Z lower-cased, of whole texts of
    any length.  With N documents that have a term, L terms in all, n in a document and df documents
    with a term, its weight is floor(1000 * ln((2N + 2) / (2df + 1))) and it adds
    weight * (10**9 tf div (1000 tf + 20 m)) for m = 50 + (50 n N) div L.  Equal scores go by ascending
    doc_id.  Null and empty texts have no terms: such items get no rows, such documents do not count.
    A document with a null doc_id counts for N, L and df but is not ranked.  Rows that share a doc_id
    are documents of their own; repeated items, or items with a null item_id, each get their rows.
    Empty tables give an empty result; extra columns are ignored.  Distinct item texts are searched in
    slices of at most ``slice_items`` texts and ``slice_bytes`` bytes (or one text), each with a pass of its own.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"cast(`{text_col}` AS string) AS text").where("text IS NOT NULL")
    asked = items.selectExpr(f"cast(`{item_col}` AS long) AS item_id", f"cast(`{item_text_col}` AS string) AS text").where("text IS NOT NULL")
    key = F.sha2("text", 256).alias("key")
    ranked = [spark.range(0).selectExpr("cast(NULL AS string) AS key", "id AS doc_id", "id AS score")]
    names = []
    for part in text_slices(asked.select("text").distinct().select(key, "text"), slice_items, slice_bytes):
        terms = Terms(part)
        if len(terms.hashes) == 0:
            continue
        shared = spark.sparkContext.broadcast(terms)
        counts = scratch.write(rows.mapInArrow(_count_terms(shared), "doc_id long, n long, terms array<int>, tf array<long>"))
        counted = scratch.names[-1]
        shared.destroy()
        total, length = counts.agg(F.count("*"), F.sum("n")).first()
        if total:
            weights = np.zeros(len(terms.hashes), np.int64)
            for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
                weights[r.term] = math.floor(1000 * math.log((2 * total + 2) / (2 * r["count"] + 1)))
            wanted = [(name, own[weights[own] > 0]) for name, own in zip(terms.keys, terms.items)]
            shared = spark.sparkContext.broadcast(([x for x in wanted if len(x[1])], weights, total, length))
            found = counts.where("doc_id IS NOT NULL").mapInArrow(_search(shared, k), "key string, doc_id long, score long")
            ranked.append(scratch.write(_best(_best(found.withColumn("salt", F.spark_partition_id() % SALTS), k, "key", "salt"), k, "key").select("key", "doc_id", "score")))
            names.append(scratch.names[-1])
            shared.destroy()
        scratch.drop(counted)
    scratch.keep(*names)
    order = Window.partitionBy("item_id", "_row").orderBy(F.desc("score"), "doc_id")
    own = asked.withColumn("_row", F.monotonically_increasing_id()).select("item_id", "_row", key)
    return reduce(DataFrame.unionByName, ranked).join(own, "key").withColumn("rank", F.row_number().over(order)).select("item_id", "rank", "doc_id", "score")


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k).drop("_at")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
),
s AS (SELECT doc_id, ts, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM s),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
),
p AS (
  SELECT doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(ts) AS t FROM s) WHERE t IN (SELECT t FROM q) GROUP BY ALL
),
w AS (
  SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*)::BIGINT AS df FROM p GROUP BY t), total
),
score AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t), total GROUP BY ALL
),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
