"""Language identification: nearest of several centroids per language over TF-IDF n-grams.

Vectors are hashed byte 2- and 3-grams of the lower-cased (A-Z) text, weighted by inverse document
frequency over all training documents and scaled to length 1.  Spherical k-means on a bounded sample
gives ``clusters`` centroids per language; a text gets the language of the centroid with the largest
cosine, and is rejected if that cosine is below what the language's own sample reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .samples import remainder

GRAMS = (2, 3)
DIMS = 1 << 12
CLUSTERS = 3
PER_LANGUAGE = 400
#: Languages that a model learns at most: those of the most training rows.
LANGUAGES = 500
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13, *range(33, 65), *range(91, 97), *range(123, 127)]] = 32
_TABLE = W._stream(71, 256)[_FOLD]
_ROWS = 128


def counts(text: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x DIMS counts) for runs of at most 128 rows; whole texts."""
    for first, rows, data, offs in W.byte_slices(text, W.SLICE_BYTES // 2):
        with np.errstate(over="ignore"):
            values = _TABLE[data]
            grams = []
            for n in GRAMS:
                m = max(len(data) - n + 1, 0)
                h = np.zeros(m, np.uint64)
                for j in range(n):
                    h += values[j : j + m] * W.coefficients(0, 64)[j]
                h *= np.uint64(0x9E3779B97F4A7C15)
                grams.append((h >> np.uint64(52)).astype(np.int64))
        for a in range(0, rows, _ROWS):
            b = min(a + _ROWS, rows)
            total = np.zeros((b - a) * DIMS)
            for n, g in zip(GRAMS, grams):
                size = np.maximum(np.diff(offs[a : b + 1]) - n + 1, 0)
                own = np.repeat(np.arange(b - a), size)
                at = np.arange(len(own)) + np.repeat(offs[a:b] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                total += np.bincount(own * DIMS + g[at], minlength=(b - a) * DIMS)
            yield first + a, total.reshape(b - a, DIMS)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(tf).astype(np.float32) * idf.astype(np.float32))


class Model(NamedTuple):
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for _, c in counts(batch.column("text")):
            df += (c > 0).sum(axis=0)
            n += len(c)
    if n:
        at = np.append(np.flatnonzero(df), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(df[df > 0], n))], ["bucket", "docs"])


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [row.astype("<f4").tobytes() for _, c in counts(batch.column("text")) for row in np.log1p(c)]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.binary())], ["lang", "tf"])


def _centroids(idf: np.ndarray, clusters: int):
    """One language's sample to its centroids and its rejection floor."""

    def run(table: pa.Table) -> pa.Table:
        x = np.array([np.frombuffer(tf, "<f4") for tf in sorted(table["tf"].to_pylist())])
        x = unit(x * idf.astype(np.float32))
        c = _cluster(x, clusters).astype("<f4")
        floor = 0.5 * float(np.quantile((x @ c.T).max(axis=1), 0.01))
        return pa.table({"lang": table["lang"][:1], "centroids": pa.array([c.tobytes()], pa.binary()), "floor": pa.array([floor])})

    return run


def _cluster(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; farthest-first start, so the same rows give the same centroids."""
    centers = [unit(x.mean(axis=0, keepdims=True))[0]]
    while len(centers) < min(k, len(x)):
        centers.append(x[np.argmin((x @ np.array(centers).T).max(axis=1))])
    c = np.array(centers)
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = unit(np.array([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))]))
    return c


def train(docs: DataFrame, divisor: int = 4, held_out: int = 2, clusters: int = CLUSTERS,
          per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> Model:
    """Document frequencies come from all training rows, centroids from a bounded sample.

    At most ``languages`` values of ``lang`` are learned, those of the most training rows (of equal ones
    the first by name), so neither the sample nor the model grows with a column that holds noise.
    The sample is at most ``per_language`` rows of each language, chosen by a hash of the id (the bound
    holds for rows where several share an id); only centroids come to the driver.  Rows with a null
    language or text do not count, rows with a null id count for the frequencies alone, repeated rows
    count each.  Without rows the model knows no language.  Extra columns are ignored.
    """
    usable = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), divisor) != held_out)
    )
    df = usable.select("text").mapInArrow(_frequencies, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs")).collect()
    found = {r.bucket: r.docs for r in df}
    n = found.pop(-1, 0)
    idf = np.full(DIMS, np.log(n + 1.0) + 1)
    for bucket, d in found.items():
        idf[bucket] = np.log((n + 1) / (d + 1)) + 1

    def first(rows: DataFrame, *keys: str) -> DataFrame:
        at = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), *rows.columns))
        return rows.withColumn("_k", at).where(F.col("_k") <= per_language).drop("_k")

    # a language is ranked in 8 parts before it is ranked as a whole
    known = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    ids = usable.select("doc_id", "lang").join(F.broadcast(known), "lang").where("doc_id IS NOT NULL").withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(8)))
    chosen = first(first(ids, "lang", "_part").drop("_part"), "lang").select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    mine = (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))
    sample = first(usable.join(F.broadcast(chosen), mine).select("doc_id", "lang", "text"), "lang").select("lang", "text")
    rows = sample.mapInArrow(_sample_rows, "lang string, tf binary").groupBy("lang").applyInArrow(
        _centroids(idf, clusters), "lang string, centroids binary, floor double").orderBy("lang").collect()
    centroids = [np.frombuffer(r.centroids, "<f4").reshape(-1, DIMS) for r in rows]
    owner = [i for i, c in enumerate(centroids) for _ in c]
    empty = np.zeros((0, DIMS), np.float32)
    return Model(idf, [r.lang for r in rows], np.vstack([empty, *centroids]), np.array(owner, np.int64), np.array([r.floor for r in rows]))


def predict(docs: DataFrame, model: Model, reject_as: str | None = "und") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row.

    A null text, a text without a letter, and any text when there was nothing to learn from give
    ``und`` with score 0.  A text whose best cosine is below its language's floor is rejected: its
    prediction is ``reject_as``, or stays the nearest language where that is None.  Texts of any length
    are read whole; equal cosines give the language that sorts first.  A null id stays null, repeated
    rows stay, an empty table gives an empty result, and extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            best, cosine = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for first, c in counts(batch.column("text")):
                if len(m.centroids):
                    sim = vectors(c, m.idf) @ m.centroids.T
                    near = sim.argmax(axis=1)
                    best[first : first + len(c)] = m.owner[near]
                    cosine[first : first + len(c)] = sim[np.arange(len(c)), near]
            names = pa.array([m.languages[i] for i in best] if m.languages else [None] * len(best), pa.string())
            low = cosine < (m.floor[best] if len(m.floor) else 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), names, pa.array(cosine.clip(0, 1)), pa.array(low), batch.column("lettered")],
                ["doc_id", "name", "cosine", "low", "lettered"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    got = rows.mapInArrow(run, "doc_id long, name string, cosine double, low boolean, lettered boolean")
    named: Column = F.col("name") if reject_as is None else F.when(F.col("low"), F.lit(reject_as)).otherwise(F.col("name"))
    known = F.col("lettered") & F.col("name").isNotNull()
    return got.select(
        "doc_id", F.when(known, named).otherwise(F.lit("und")).alias("lang_pred"),
        F.when(known, F.col("cosine")).otherwise(F.lit(0.0)).alias("score"),
        (F.col("low") | ~known).alias("rejected"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, train(docs), reject_as=None).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected",
    )
