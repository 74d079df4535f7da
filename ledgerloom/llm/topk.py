"""Exact top-k inner products by MaxScore over shards of vectors.

A dimension is a query term and its column of a shard is its posting list.  Per shard each term has
an upper bound of what it can add.  Terms are ordered by bound; once k scores are known, the terms
whose bounds cannot lift a vector over the k-th score are non-essential: only essential columns are
traversed, and the others are probed in turn for vectors that are still competitive.  Blocks of
queries meet shards by an equi-join on a shard group; the best k of every shard are merged.

Scores are computed in doubles where no sum can pass 2**53, else in Python's integers, which have no
bound.  A score that does not fit 64 bits is kept as its digits, so that it is ranked all the same.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

SHARD_ROWS = 4096
QUERY_ROWS = 512
_STEP = 1024
_PROBE = 8
#: Bits that hold any sum of products of two whole doubles.
_WIDE = 2176


def quantise(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable rows, their lengths, floor(scale * x) of all usable components in order)."""
    column = column.cast(pa.large_list(pa.float64()))
    size = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(size.sum()))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(size)), size)
    bad = np.zeros(len(size), bool)
    bad[row[~np.isfinite(values)]] = True
    if column.null_count:
        bad |= column.is_null().to_numpy(zero_copy_only=False)
    usable = np.flatnonzero(~bad)
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values[~bad[row]])
    return usable, size[usable], np.clip(scaled, -sys.float_info.max, sys.float_info.max)


def _pack(limit: int, scale: float):
    """Blocks of at most ``limit`` vectors; shorter vectors are filled with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            usable, size, values = quantise(batch.column(1), scale)
            start = np.concatenate([[0], np.cumsum(size)])
            for a in range(0, len(usable), limit):
                b = min(a + limit, len(usable))
                dim = int(size[a:b].max())
                dense = np.zeros((b - a, dim))
                dense[np.arange(dim)[None, :] < size[a:b, None]] = values[start[a] : start[b]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([made], pa.int64()), pa.array([ids[usable[a:b]].astype("<i8").tobytes()], pa.binary()),
                    pa.array([dense.astype("<f8").tobytes()], pa.binary()), pa.array([dim], pa.int32()),
                ], ["block", "ids", "matrix", "dim"])
                made += 1

    return run


def max_score(query: np.ndarray, own: int, ids: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray,
              k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of a shard for one query; ``columns`` is terms x vectors."""
    bound = np.maximum(query * low, query * high)
    order = np.argsort(-(bound - np.minimum(query * low, query * high)), kind="stable")
    order = order[query[order] != 0]
    rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0.0]])  # what terms from here on can add
    best_id, best = np.zeros(0, np.int64), np.zeros(0, query.dtype)
    for a in range(0, columns.shape[1], _STEP):
        part = columns[:, a : a + _STEP]
        number = ids[a : a + _STEP]
        alive = np.flatnonzero(number != own)
        bar = best[-1] if len(best) == k else -math.inf
        # essential: as many terms as it takes until the others alone could not reach the bar
        essential = int(np.argmax(rest < bar)) if (rest < bar).any() and bar > 0 else len(order)
        done = max(essential, min(_PROBE, len(order)))
        score = query[order[:done]] @ part[order[:done]] if done else np.zeros(part.shape[1], query.dtype)
        score = score[alive]
        while done < len(order) and len(alive):
            keep = score + rest[done] >= bar
            alive, score = alive[keep], score[keep]
            nxt = order[done : done + _PROBE]
            score = score + query[nxt] @ part[np.ix_(nxt, alive)]
            done += len(nxt)
        keep = score >= bar
        cand_id, cand = np.concatenate([best_id, number[alive[keep]]]), np.concatenate([best, score[keep]])
        top = np.lexsort((cand_id, -cand))[:k] if cand.dtype != object else sorted(range(len(cand)), key=lambda i: (-cand[i], cand_id[i]))[:k]
        best_id, best = cand_id[top], cand[top]
    return best_id, best


def _integers(x: np.ndarray) -> np.ndarray:
    """Whole doubles as Python's integers."""
    return np.array([int(v) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def _ranked(scores: list[int]) -> tuple[list[int], list[bytes | None], list[int | None]]:
    """(tier, digits, score): tier 0 fits 64 bits; tiers 1 and -1 are ordered by sign-adjusted digits of one width."""
    tier = [0 if -(1 << 63) <= v < 1 << 63 else 1 if v > 0 else -1 for v in scores]
    digits = [None if t == 0 else (v + (1 << _WIDE - 1)).to_bytes(_WIDE // 8, "big") for v, t in zip(scores, tier)]
    return tier, digits, [v if t == 0 else None for v, t in zip(scores, tier)]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, ids = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["ids"], "<i8")
                q = np.frombuffer(r["q_matrix"], "<f8").reshape(len(q_ids), r["q_dim"])
                x = np.frombuffer(r["matrix"], "<f8").reshape(len(ids), r["dim"])
                dim = min(r["q_dim"], r["dim"])
                q, columns = q[:, :dim], np.ascontiguousarray(x[:, :dim].T)
                if dim and dim * max(1.0, np.abs(q).max()) * max(1.0, np.abs(columns).max()) >= 2.0**53:
                    q, columns = _integers(q), _integers(columns)
                low, high = (columns.min(axis=1), columns.max(axis=1)) if dim else (columns[:, 0], columns[:, 0])
                out = [max_score(v, own, ids, columns, low, high, k) for own, v in zip(q_ids.tolist(), q)]
                tier, digits, scores = _ranked([int(v) for o in out for v in o[1].tolist()])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q_ids, [len(o[0]) for o in out]), pa.int64()),
                    pa.array(np.concatenate([o[0] for o in out]), pa.int64()),
                    pa.array(tier, pa.int32()), pa.array(digits, pa.binary()), pa.array(scores, pa.int64()),
                ], ["query_id", "vec_id", "tier", "digits", "score"])

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of every query.

    Components are floor(scale * x).  Ties go to the smaller vec_id; a query's own id is no
    candidate.  Vectors that are null, hold a null or non-finite component, or have a null id take
    no part; vectors of unequal length meet on their common components.  With fewer than k
    candidates all are returned; without queries or candidates nothing is.  Rows that share an id
    are separate candidates; queries that share an id have one ranking, the k best over all their
    vectors.  Extra columns are ignored.  Finite components of any size are ranked exactly; a score
    beyond 64 bits is null in the result.  Components beyond the double range after scaling count as its end.
    """
    spark = vectors.sparkSession
    groups = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = "block long, ids binary, matrix binary, dim int"

    def blocks(df: DataFrame, limit: int) -> DataFrame:
        rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"))
        return rows.mapInArrow(_pack(limit, scale), packed)

    shards = blocks(vectors, SHARD_ROWS).withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups)))
    asked = blocks(queries, QUERY_ROWS).select(
        F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.col("dim").alias("q_dim"),
        F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("g"),
    )
    found = shards.join(asked, "g").select("ids", "matrix", "dim", "q_ids", "q_matrix", "q_dim").mapInArrow(
        _search(k), "query_id long, vec_id long, tier int, digits binary, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("tier"), F.desc("digits"), F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM p)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM r WHERE k <= 5
"""
