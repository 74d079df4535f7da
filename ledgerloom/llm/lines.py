"""Line dedup by pairwise alignment.

A document is compared with the earlier ones that share a line of at least ``min_words`` words: the
pair is aligned by patience diff over line hashes, and blocks of aligned lines are deleted from the
later document.  Only line hashes travel for the alignment; texts are read again for the rewrite.

Pairs that can delete no further nominating line are left out.  Each line first nominates its earliest
holder, and the first document with an equal line sequence is nominated too.  For lines that no
alignment has deleted, rare marks count: patience diff pairs nothing at all unless two documents share
an anchor, a line that each of them holds once, or their first or last line.  A standing line nominates
its other holders, a few at a time, or the documents that share an anchor with its own, whichever are
fewer; so separators and braces of documents that share no anchor nominate nobody.  Copies of earlier
documents are left out as holders.  Shorter lines nominate nothing and go where a nominated pair aligns them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import words as W
from .scratch import Scratch

MIN_WORDS = 3
#: Holders that a line still standing nominates in each round; the last round takes all that are left.
ROUNDS = (16, 512, None)
#: Parts that the holders of one mark are dealt to.
SALTS = 32
_PAIR = ("doc_id", "fp", "partner", "partner_fp")
#: Salts of the first and the last line.
_EDGES = np.array([0x452821E638D01377, 0xBE5466CF34E90C6C], np.uint64)


def _lines(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each non-blank line from there, its 128-bit hash as two columns, its words) by slices."""
    for ln, ws in zip(W.word_slices(column, separators=W.IS_NEWLINE), W.word_slices(column)):
        n = np.searchsorted(ws.starts, ln.ends) - np.searchsorted(ws.starts, ln.starts)
        keep = n > 0
        both = np.stack([ln.hashes, W.word_hashes(ln.data, ln.starts, ln.ends, 1)], axis=1)
        yield ln.first, ln.rows, ln.row_of_word()[keep], both[keep], n[keep]


def _once(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which lines their document holds once, the place of the first line of every hash of a document)."""
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    once = np.empty(len(order), bool)
    once[order] = new[:-1] & new[1:]
    return once, order[new[:-1]]


def _edges(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the first and of the last line of every document, as such."""
    if len(row) == 0:
        return row, h
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    last = np.append(first[1:] - 1, len(row) - 1)
    with np.errstate(over="ignore"):
        return np.tile(row[first], 2), W.mix64(np.concatenate([h[first] + _EDGES[0], h[last] + _EDGES[1]]))


def _marks(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, anchor) of the distinct lines of each document, and of its edges."""
    once, distinct = _once(row, h)
    edge_row, edge = _edges(row, h)
    return np.concatenate([row[distinct], edge_row]), np.concatenate([h[distinct], edge]), np.append(once[distinct], np.ones(len(edge), bool))


def patience_blocks(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the common blocks that patience diff aligns."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        unique = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place]
        # longest run of anchors that rises in both: patience piles with back pointers
        tops: list[int] = []
        last: list[int] = []
        back = [-1] * len(unique)
        for n, (_, j) in enumerate(unique):
            pile = bisect_left(tops, j)
            if pile == len(tops):
                tops.append(j)
                last.append(n)
            else:
                tops[pile], last[pile] = j, n
            back[n] = last[pile - 1] if pile else -1
        n, anchors = (last[-1] if last else -1), []
        while n >= 0:
            anchors.append(unique[n])
            n = back[n]
        if not anchors:
            continue
        i0, j0 = a0, b0
        for i, j in reversed(anchors):
            todo.append((i0, i, j0, j))
            pairs.append((i, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, a1, j0, b1))
    blocks: list[tuple[int, int, int]] = []
    for i, j in sorted(pairs):
        if blocks and (i, j) == (blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]):
            blocks[-1] = (blocks[-1][0], blocks[-1][1], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, digest of the text) of the rows."""
    return tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))


def _joined(parts: list[tuple], *kinds: str) -> list[np.ndarray]:
    """The columns of tuples of arrays, also of none."""
    return [np.concatenate([np.zeros(0, kind), *column]) for kind, column in zip(kinds, list(zip(*parts)) or [()] * len(kinds))]


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a batch knows of each mark: first and last document, their number, and that of documents where it is an anchor."""
    for batch in batches:
        ids, prints = _keys(batch)
        parts = []
        for first, _, row, both, _ in _lines(batch.column(2)):
            r, h, anchor = _marks(row, both[:, 0])
            parts.append((r + first, h, anchor))
        r, h, anchor = _joined(parts, "i8", "u8", "?")
        if len(h) == 0:
            continue
        h, own, fp = h.view(np.int64), ids[r], prints[r]
        order = np.lexsort((fp, own, h))
        h, own, fp, anchor = h[order], own[order], fp[order], anchor[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        count = np.diff(np.append(first, len(h)))
        anchored = np.minimum.reduceat(np.where(anchor, own, np.iinfo(np.int64).max), first)
        columns = [h[first], own[first], fp[first], own[first + count - 1], count, anchored, np.add.reduceat(anchor.astype(np.int64), first)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["h", "lo", "lo_fp", "hi", "n", "lo_anchor", "n_anchor"])


def _places(min_words: int):
    """(h, doc_id, fp, line, anchor) of every line that nominates, and of every other anchor as line -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = _keys(batch)
            parts = []
            for first, rows, row, both, n in _lines(batch.column(2)):
                h = both[:, 0]
                once, _ = _once(row, h)
                line = np.where(n >= min_words, np.arange(len(row)) - np.searchsorted(row, np.arange(rows))[row], -1)
                keep = once | (line >= 0)
                edge_row, edge = _edges(row, h)
                none = np.full(len(edge), -1)
                parts.append((np.append(row[keep], edge_row) + first, np.append(h[keep], edge), np.append(line[keep], none), np.append(once[keep], none < 0)))
            r, h, line, once = _joined(parts, "i8", "u8", "i8", "?")
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(ids[r]), pa.array(prints[r]), pa.array(line.astype(np.int32)), pa.array(once)], ["h", "doc_id", "fp", "line", "anchor"],
            )

    return run


def _sequences(min_words: int):
    """(doc_id, fp, seq, whole): ``whole`` is a digest of the sequence, null where no line nominates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, whole = [], []
            for _, rows, row, both, n in _lines(batch.column(2)):
                raw, cuts = both.tobytes(), np.searchsorted(row, np.arange(rows + 1)).tolist()
                nominating = np.bincount(row, n >= min_words, rows) > 0
                for i in range(rows):
                    seqs.append(raw[16 * cuts[i] : 16 * cuts[i + 1]])
                    whole.append(blake2b(seqs[-1], digest_size=16).digest() if nominating[i] else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(seqs, pa.binary()), pa.array(whole, pa.binary())], ["doc_id", "fp", "seq", "whole"],
            )

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, partner, partner_fp, anchor) of every mark of line sequences."""
    for batch in batches:
        ids, prints = _keys(batch)
        seqs = batch.column(2).to_pylist()
        row = np.repeat(np.arange(len(seqs)), [len(x) // 16 for x in seqs])
        r, h, anchor = _marks(row, np.frombuffer(b"".join(seqs), np.uint64)[::2])
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[r]), pa.array(prints[r]), pa.array(anchor)], ["h", "partner", "partner_fp", "anchor"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = []
        for own, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            a, b = np.frombuffer(own, "V16").tolist(), np.frombuffer(other, "V16").tolist()
            gone.append(sorted({i + k for i, _, n in patience_blocks(a, b) for k in range(n)}))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))], ["doc_id", "fp", "gone"])


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, cut, kept = [], [], []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            out, n, drop = [], 0, set(gone or ())
            for line in (text or "").encode().split(b"\n"):
                if line.split():
                    if n not in drop:
                        out.append(line)
                    n += 1
                else:
                    out.append(line)
            total.append(n)
            cut.append(len(drop))
            kept.append(text if not drop else b"\n".join(out).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(cut, pa.int64()), pa.array(kept, pa.string()), *batch.columns[3:]],
            ["doc_id", "n_lines", "n_removed", "kept_text", *batch.schema.names[3:]],
        )


def dedupe_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_text) of every row and its ``keep`` columns; lines are the non-blank ones.

    Judged on the input: a line of at least ``min_words`` words goes if the alignment with any earlier
    document matches it, a shorter one if that with a nominated document does.  Two lines are equal if
    128 bits of two hashes of their bytes are.  Blank lines stay and are not counted.  A null text stays
    null with no lines.  A document with a null id stays as it is and counts for no other.  Rows that
    share an id are never aligned with each other, and each keeps or loses its own lines; a document with
    a larger id is aligned with them all.  Ties cannot occur: only a smaller id deletes.  Texts and lists
    of lines of any length are aligned whole.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"cast(`{text_col}` AS string) AS text", *[f"`{c}`" for c in keep])
    rows = rows.withColumn("_fp", F.xxhash64("text"))
    given = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("_fp").alias("fp"), "text")
    shared = scratch.write(
        given.mapInArrow(_holders, "h long, lo long, lo_fp long, hi long, n long, lo_anchor long, n_anchor long").repartition(parts, "h").groupBy("h")
        .agg(F.min(F.struct("lo", "lo_fp")).alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.min("lo_anchor").alias("lo_anchor"), F.sum("n_anchor").alias("n_anchor"))
        .where("lo.lo < hi").selectExpr("h", "lo.lo AS partner", "lo.lo_fp AS partner_fp", "n", "lo_anchor", "n_anchor"), "shared",
    )
    meets = scratch.write(
        given.mapInArrow(_places(min_words), "h long, doc_id long, fp long, line int, anchor boolean").join(shared.hint("merge"), "h")
        .where("partner < doc_id AND (line >= 0 OR lo_anchor < doc_id)"), "meets",
    )
    left, anchors = meets.where("line >= 0"), meets.where("anchor AND lo_anchor < doc_id").select("h", "doc_id", "fp", "n_anchor")
    seqs = scratch.write(given.mapInArrow(_sequences(min_words), "doc_id long, fp long, seq binary, whole binary"), "sequences")
    copies = seqs.where("whole IS NOT NULL").groupBy("whole").agg(F.min(F.struct("doc_id", "fp")).alias("lo"), F.max("doc_id").alias("hi")).where("lo.doc_id < hi")
    copies = copies.selectExpr("whole", "lo.doc_id AS partner", "lo.fp AS partner_fp")
    copied = scratch.write(seqs.select("doc_id", "fp", "whole").join(copies.hint("merge"), "whole").where("partner < doc_id").select(*_PAIR, "whole"), "copied")
    single = seqs.select("doc_id", "fp", "seq")
    if not seqs.groupBy("doc_id", "fp").count().where("count > 1").isEmpty():  # rows of one id and text have one sequence
        single = scratch.write(single.dropDuplicates(["doc_id", "fp"]), "single")

    def aligned(pairs: DataFrame, name: str) -> DataFrame:
        """(doc_id, fp, line) that the alignments of ``pairs`` delete."""
        own = scratch.write(pairs, f"{name}_pairs").join(single.hint("merge"), ["doc_id", "fp"])
        other = single.select(F.col("doc_id").alias("partner"), F.col("fp").alias("partner_fp"), F.col("seq").alias("other"))
        both = own.join(other.hint("merge"), ["partner", "partner_fp"]).select("doc_id", "fp", "seq", "other")
        return scratch.write(both.mapInArrow(_align, "doc_id long, fp long, gone array<int>").select("doc_id", "fp", F.explode("gone").alias("line")).distinct(), name)

    cuts = [aligned(left.select(*_PAIR).union(copied.select(*_PAIR)).distinct(), "cuts")]
    holders, least = None, 0
    for k, most in enumerate(ROUNDS, 1):
        standing = left.select("h", "doc_id", "fp", "line", "n").join(cuts[-1].hint("merge"), ["doc_id", "fp", "line"], "left_anti")
        if k == 1:  # a document without a shared anchor or edge aligns with nobody
            costs = anchors.groupBy("doc_id", "fp").agg(F.sum("n_anchor").alias("cost"))
            standing = standing.select("h", "doc_id", "fp", "line", "n").join(costs.hint("merge"), ["doc_id", "fp"])
        else:
            standing = standing.join(left.select("doc_id", "fp", "cost").distinct().hint("merge"), ["doc_id", "fp"])
        left = scratch.write(standing, f"left{k}")
        if left.isEmpty():
            break
        by_line = left.where("n <= cost").select("h", "doc_id", "fp").distinct().withColumn("anchored", F.lit(False))
        by_anchor = anchors.select("h", "doc_id", "fp").join(left.where("n > cost").select("doc_id", "fp").distinct().hint("merge"), ["doc_id", "fp"], "left_semi")
        open_ = scratch.write(by_line.unionByName(by_anchor.withColumn("anchored", F.lit(True))), f"open{k}")
        if holders is None:
            # a mark's holders in an order of their own, the same in every round; an alignment with a copy
            # deletes what that with the copied earlier document deletes
            first = seqs.join(copied.select("doc_id", "whole").distinct().hint("merge"), ["doc_id", "whole"], "left_anti").select("doc_id", "fp", "seq")
            wanted = open_.select("h").distinct().join(shared.select("h", "n").hint("merge"), "h")
            holders = scratch.write(
                first.mapInArrow(_members, "h long, partner long, partner_fp long, anchor boolean").join(wanted.hint("merge"), "h")
                .selectExpr("h", "partner", "partner_fp", "anchor", "pmod(xxhash64(partner), n) AS place", f"cast(pmod(xxhash64(partner, 1), {SALTS}) AS int) AS salt"), "holders",
            )
        some = holders.where(F.col("place") >= least)
        if most:
            some, least = some.where(F.col("place") < most), most
        dealt = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        pairs = dealt.join(some.hint("merge"), ["h", "salt"]).where("partner < doc_id AND (anchor OR NOT anchored)").select(*_PAIR).distinct()
        cuts.append(aligned(pairs, f"cuts{k}"))
    gone = scratch.write(
        reduce(DataFrame.union, cuts).groupBy("doc_id", F.col("fp").alias("_fp")).agg(F.array_sort(F.collect_set("line")).alias("gone")), "gone",
    )
    scratch.keep("gone")
    schema = StructType().add("doc_id", "long").add("n_lines", "long").add("n_removed", "long").add("kept_text", "string")
    for c in keep:
        schema = schema.add(docs.schema[c])
    return rows.join(gone.hint("merge"), ["doc_id", "_fp"], "left").select("doc_id", "text", "gone", *keep).mapInArrow(_rewrite, schema)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), min_words=1).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
