"""Remove passages that repeat across documents, found by difference-cover anchors.

Take a period v and a difference cover C of it.  Two equal runs of ``window`` words, wherever they
start, have some offset below v at which both positions are in C modulo v, so it is enough to hash
the ``window - v + 1`` words that start at cover positions.  Anchors found in two documents or more
are extended: the windows around them are compared as a whole, by 95 bits of two hashes that are computed
from the bytes, each with its own mixing.

Documents are dealt into blocks of a few hundred, or of a few megabytes, by a hash of their id, and everything that shuffles
by content is combined per block first: a hash that a third of all documents hold is one row per
block, with the smallest document of the block.  The rows of a hash meet in a sorted partition that
is read as a stream, so no group is ever held in memory, and answers go back to blocks, not to
documents.  Exact copies of a smaller document are known by their digest and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .scratch import Scratch

WINDOW, BLOCK_DOCS, BLOCK_BYTES = 13, 256, 4 << 20


def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set of residues whose differences are all residues."""
    for size in range(1, period + 1):
        for c in combinations(range(period), size):
            if len({(a - b) % period for a in c for b in c}) == period:
                return c
    return (0,)


class Plan:
    def __init__(self, window: int):
        self.window = window
        self.period = min((window + 1) // 2, 13)
        self.anchor = window - self.period + 1
        self.mask = np.zeros(self.period, bool)
        self.mask[list(difference_cover(self.period))] = True


def _anchors(s: W.Slice, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word positions, rows, hashes) of the cover positions of rows that have a whole window."""
    total = len(s.hashes)
    row = s.row_of_word()
    size = np.diff(s.bounds)
    place = np.arange(total) - s.bounds[row]
    ok = (size[row] >= plan.window) & (place <= size[row] - plan.anchor) & plan.mask[place % plan.period]
    at = np.flatnonzero(ok)
    return at, row[at], W.window_hashes(s.hashes, plan.anchor)[at] if len(at) else np.zeros(0, np.uint64)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Index into sorted ``among`` of each value, or -1."""
    if len(among) == 0:
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return np.where(among[at] == values, at, -1)


def _least(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the first row of every key, with the smallest document; whether it has several)."""
    if len(docs) == 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    order = np.lexsort((docs, *reversed(keys)))
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order)) - 1
    return order[first], docs[order[last]] != docs[order[first]]


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().to_numpy(zero_copy_only=False)


def _block_anchors(plan: Plan):
    """Every anchor of a block once: (h, lo, many)."""

    def run(table: pa.Table) -> pa.Table:
        ids = _column(table, "doc_id")
        hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for s in W.word_slices(table["text"]):
            _, row, h = _anchors(s, plan)
            hashes.append(h)
            docs.append(ids[s.first + row])
        h, d = np.concatenate(hashes), np.concatenate(docs)
        at, many = _least([h], d)
        return pa.table({"h": _longs(h[at]), "lo": _longs(d[at]), "many": pa.array(many)})

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by h those whose anchor more than one document holds: (h, lo)."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        h, many = _column(table, "h"), _column(table, "many").astype(bool)
        same = h[1:] == h[:-1]
        keep = many.copy()
        keep[1:] |= same
        keep[:-1] |= same
        # the last row waits for the next batch; it is marked if its group is known to be larger
        tail = table.slice(len(h) - 1, 1)
        if keep[-1]:
            tail = tail.set_column(2, "many", pa.array([True]))
        held = tail.to_batches()[0]
        keep[-1] = False
        yield from table.filter(pa.array(keep)).select(["h", "lo"]).to_batches()
    if held is not None and held.column(2)[0].as_py():
        yield held.select(["h", "lo"])


def _window_keys(s: W.Slice, a: int, b: int, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    one = W.window_hashes(s.hashes[a:b], plan.window)
    two = W.window_hashes(W.word_hashes(s.data, s.starts[a:b], s.ends[a:b], 1), plan.window, 1) >> np.uint64(33)
    return one, two.astype(np.int64)


def _copies_of(right: pa.Table) -> set[tuple[int, int]]:
    copies = right.filter(pc.is_valid(right["copy_id"]))
    return set(zip(copies["copy_id"].to_pylist(), copies["copy_fp"].to_pylist()))


def _block_windows(plan: Plan):
    """Windows that hold a repeated anchor at an offset below the period, once per block."""

    def run(texts: pa.Table, right: pa.Table) -> pa.Table:
        out = {"w": [np.zeros(0, np.uint64)], "x": [np.zeros(0, np.int64)], "d": [np.zeros(0, np.int64)]}
        marks = right["h"].combine_chunks().drop_null()
        if len(marks) and texts.num_rows:
            among = np.sort(marks.to_numpy(zero_copy_only=False).view(np.uint64))
            copies = _copies_of(right)
            keys = list(zip(texts["doc_id"].to_pylist(), texts["fp"].to_pylist()))
            for s in W.word_slices(texts["text"]):
                at, row, h = _anchors(s, plan)
                hit = np.zeros(len(s.hashes) + 1, np.int64)
                hit[at[_member(h, among) >= 0] + 1] = 1
                upto = np.cumsum(hit)
                for i in range(s.rows):
                    a, b = int(s.bounds[i]), int(s.bounds[i + 1])
                    n = b - a - plan.window + 1
                    if n < 1 or upto[b] == upto[a] or keys[s.first + i] in copies:
                        continue
                    starts = np.flatnonzero(upto[a + plan.period : a + plan.period + n] > upto[a : a + n])
                    if len(starts):
                        one, two = _window_keys(s, a, b, plan)
                        out["w"].append(one[starts])
                        out["x"].append(two[starts])
                        out["d"].append(np.full(len(starts), keys[s.first + i][0]))
        w, x, d = (np.concatenate(out[c]) for c in "wxd")
        at, many = _least([w, x], d)
        return pa.table({"w": _longs(w[at]), "x": pa.array(x[at].astype(np.int32)), "lo": _longs(d[at]), "many": pa.array(many)})

    return run


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (w, x, lo): (w, x, lo, first) where a document after ``first`` is in lo's block."""
    key, lead = (None, None), None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        w, x, lo, many = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (x[1:] != x[:-1])
        if (w[0], x[0]) == key:
            new[0] = False
        begin = np.maximum.accumulate(np.where(new, np.arange(len(w)), -1))
        first = np.where(begin >= 0, lo[begin], lo[0] if lead is None else lead)
        key, lead = (w[-1], x[-1]), first[-1]
        keep = (first < lo) | many.astype(bool)
        yield pa.RecordBatch.from_arrays(
            [_longs(w[keep]), pa.array(x[keep].astype(np.int32)), _longs(lo[keep]), _longs(first[keep])], ["w", "x", "lo", "first"],
        )


def _joined(s: W.Slice, i: int, keep: np.ndarray) -> bytes:
    """The kept words of a row, joined by one space."""
    first, body = int(s.offsets[i]), s.data[s.offsets[i] : s.offsets[i + 1]]
    own = slice(int(s.bounds[i]), int(s.bounds[i + 1]))
    edge = np.zeros(len(body) + 2, np.int8)
    edge[s.starts[own][keep] - first] += 1
    edge[s.ends[own][keep] - first + 1] -= 1  # a word takes the separator behind it along
    out = body[np.cumsum(edge, dtype=np.int8)[: len(body)] > 0]
    return bytes(np.where(W.IS_SPACE[out], np.uint8(32), out)).rstrip(b" ")


def _rewrite(plan: Plan):
    def run(texts: pa.Table, right: pa.Table) -> pa.Table:
        ids, prints = texts["doc_id"].to_pylist(), texts["fp"].to_pylist()
        copies = _copies_of(right)
        cuts = right.filter(pc.is_valid(right["w"]))
        ws, xs, first = _column(cuts, "w").view(np.uint64), _column(cuts, "x").astype(np.int64), _column(cuts, "first")
        order = np.lexsort((xs, ws))
        ws, xs, first = ws[order], xs[order], first[order]
        n_words, n_cut, kept = [0] * len(ids), [0] * len(ids), [""] * len(ids)
        for s in W.word_slices(texts["text"]):
            for i in range(s.rows):
                at, a, b = s.first + i, int(s.bounds[i]), int(s.bounds[i + 1])
                keep = np.ones(b - a, bool)
                n_words[at] = b - a
                if b - a >= plan.window and ids[at] is not None:
                    if (ids[at], prints[at]) in copies:
                        n_cut[at], keep = b - a, ~keep
                    elif len(ws):
                        one, two = _window_keys(s, a, b, plan)
                        found = _member(one, ws)
                        hit = np.flatnonzero((found >= 0) & (xs[found] == two) & (first[found] < ids[at]))
                        if len(hit):
                            edge = np.zeros(b - a + 1, np.int64)
                            np.add.at(edge, hit, 1)
                            np.add.at(edge, hit + plan.window, -1)
                            keep = np.cumsum(edge[:-1]) == 0
                            n_cut[at] = int((~keep).sum())
                kept[at] = _joined(s, i, keep).decode("utf-8", "replace")
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_cut, pa.int64()), "kept_text": pa.array(kept, pa.string()),
        })

    return run


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                           block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row.

    Every word is removed that a run of ``window`` consecutive words covers if the same run also
    starts in a document with a smaller id; runs are judged on the input.  Kept words are joined by
    one space.  A null text has no words.  A document with a null id keeps its words and counts for
    no other.  Texts of any length are compared whole, a block holding a few megabytes or one text.
    Rows that share an id are one document for the comparison, and each gives its row.
    Ties cannot occur, since only a smaller id removes.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    plan = Plan(window)
    scratch = Scratch(spark, "passages")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()
    blocks = max(parts, n // block_docs + 1, size // block_bytes + 1)

    def block(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block")

    fp = F.xxhash64("text").alias("fp")
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"cast(`{text_col}` AS string) AS text")
    # rows with a null id are compared with nothing and may lie in any block
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).select(F.when(F.col("doc_id").isNull(), block("_row")).otherwise(block("doc_id")).alias("block"), "doc_id", "text", fp)
    given = dealt.where("doc_id IS NOT NULL AND text IS NOT NULL")

    digests = scratch.write(given.select("doc_id", "fp", F.sha2("text", 256).alias("sha")), "digests")
    least = scratch.write(digests.groupBy("sha").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").drop("hi"), "least")
    copies = scratch.write(digests.join(least, "sha").where("lo < doc_id").select("doc_id", "fp").distinct(), "copies")
    copies = copies.select(block("doc_id"), F.col("doc_id").alias("copy_id"), F.col("fp").alias("copy_fp"))

    marks = scratch.write(
        given.groupBy("block").applyInArrow(_block_anchors(plan), "h long, lo long, many boolean")
        .repartition(parts, "h").sortWithinPartitions("h").mapInArrow(_repeated, "h long, lo long")
        .select(block("lo"), "h"), "marks",
    )
    cuts = scratch.write(
        given.groupBy("block").cogroup(marks.unionByName(copies, allowMissingColumns=True).groupBy("block"))
        .applyInArrow(_block_windows(plan), "w long, x int, lo long, many boolean")
        .repartition(parts, "w").sortWithinPartitions("w", "x", "lo")
        .mapInArrow(_firsts, "w long, x int, lo long, first long").select(block("lo"), "w", "x", "first"), "cuts",
    )
    scratch.keep("copies", "cuts")
    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    return dealt.groupBy("block").cogroup(cuts.unionByName(copies, allowMissingColumns=True).groupBy("block")).applyInArrow(_rewrite(plan), schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d WHERE len(ws) >= 13)
),
hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS lo FROM w) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, p + o AS q FROM hit, range(0, 13) t(o)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM d),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY q) FILTER (g.q IS NULL) AS body, count(g.q) AS n_removed
  FROM words w LEFT JOIN gone g USING (doc_id, q) GROUP BY w.doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
