"""Toxicity: a linear classifier over hashed character n-grams scaled by naive Bayes ratios.

A feature is the presence of a character n-gram of the lower-cased text (a character is one Unicode
code point); its value is the log ratio of its shares in toxic and clean texts, both shares smoothed
by the same constant, so that an n-gram seen in neither has the value 0.  A logistic regression over
these values is fitted on a bounded sample; its weights and the ratios fold into one table, so that
scoring adds up one number per distinct n-gram.  Scoring is one pass without a shuffle.

A sampled text comes to the driver as its list of buckets or as a bitmap of all buckets, whichever
is smaller: 32 KB a text at most, however long it is.  Fitting unpacks one small batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .quality import sigmoid
from .samples import labelled_sample, remainder

GRAMS = (4, 6)
DIMS = 1 << 18
TOXIC_ROWS, CLEAN_ROWS = 2000, 4000
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_TABLE = W._stream(53, 256)[_FOLD]
_PLACE = W.coefficients(1, 64)[:64].copy()
_PLACE[0] = 1  # characters of one byte keep their value


def characters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value of every code point of UTF-8 bytes, row offsets counted in code points)."""
    values = _TABLE[data]
    lead = (data & 0xC0) != 0x80
    lead[offs[:-1][offs[:-1] < len(data)]] = True
    starts = np.flatnonzero(lead)
    if len(starts) == len(data):
        return values, offs
    with np.errstate(over="ignore"):
        upto = np.concatenate([[0], np.cumsum(lead)])
        place = np.arange(len(data)) - starts[upto[1:] - 1]
        values = np.add.reduceat(values * _PLACE[place % 64], starts)
    return values, upto[offs]


def gram_buckets(values: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram at every character that has n characters from it on."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(m, np.uint64)
        for j in range(n):
            out += values[j : j + m] * W.coefficients(0, 64)[j]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return ((out >> np.uint64(40)) & np.uint64(DIMS // len(GRAMS) - 1)).astype(np.int64)


class Distinct:
    """Distinct bucket numbers without sorting: the last position of each bucket counts."""

    def __init__(self, dims: int):
        self.last = np.zeros(dims, np.int64)

    def __call__(self, index: np.ndarray) -> np.ndarray:
        at = np.arange(len(index))
        self.last[index] = at
        return index[self.last[index] == at]


def presences(text: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct buckets) of every row, over the whole text."""
    distinct = Distinct(DIMS)
    span = DIMS // len(GRAMS)
    for first, rows, data, offs in W.byte_slices(text):
        values, at = characters(data, offs)
        grams = [gram_buckets(values, n) + k * span for k, n in enumerate(GRAMS)]
        for i in range(rows):
            a, b = int(at[i]), int(at[i + 1])
            parts = [g[a : max(a, b - n + 1)] for g, n in zip(grams, GRAMS)]
            yield first + i, distinct(np.concatenate(parts))


def packed(index: np.ndarray) -> tuple[bool, bytes]:
    """(whether it is a bitmap, bytes): bucket numbers in the smaller of two forms."""
    if 4 * len(index) < DIMS // 8:
        return False, np.sort(index).astype("<i4").tobytes()
    bits = np.zeros(DIMS, bool)
    bits[index] = True
    return True, np.packbits(bits).tobytes()


def unpacked(row: tuple[bool, bytes]) -> np.ndarray:
    dense, body = row
    return np.flatnonzero(np.unpackbits(np.frombuffer(body, np.uint8))) if dense else np.frombuffer(body, "<i4").astype(np.int64)


class Model(NamedTuple):
    bias: float
    table: np.ndarray


def ratios(y: np.ndarray, rows: list[tuple[bool, bytes]], alpha: float) -> np.ndarray:
    """log of (share in class 1 + b) / (share in class 0 + b), with b = alpha / texts of the smaller class."""
    count = np.zeros((2, DIMS))
    for label, row in zip(y.astype(int), rows):
        count[label, unpacked(row)] += 1
    size = np.array([len(y) - y.sum(), y.sum()])
    both = np.log(count / size[:, None] + alpha / size.min())
    return both[1] - both[0]


def fit(y: np.ndarray, rows: list[tuple[bool, bytes]], alpha: float = 100.0, epochs: int = 8, rate: float = 0.5,
        penalty: float = 3e-4, seed: int = 5) -> Model:
    """The model of three quarters of the rows, its bias moved to where it errs least on the other quarter.

    Weights move from 0 by Adagrad over small balanced batches.  The large ``alpha`` keeps the values of
    n-grams of few texts small; none is left out.  Without both classes the
    table is zero and the bias says the class (or 0.5); a quarter of one class moves nothing.
    """
    part = np.arange(len(y)) % 4 == 3
    own = np.flatnonzero(~part)
    if len(y) == 0 or y[own].min() == y[own].max():
        return Model(float(8 * y.mean() - 4) if len(y) else 0.0, np.zeros(DIMS))
    ratio = ratios(y[own], [rows[i] for i in own], alpha)
    rng = np.random.default_rng(seed)
    w, bias, gw, gb = np.zeros(DIMS), 0.0, np.full(DIMS, 1e-4), 1e-4
    share = y[own].mean()
    for _ in range(epochs):
        order = rng.permutation(own)
        for a in range(0, len(order), 32):
            pick = order[a : a + 32]
            cols = [unpacked(rows[i]) for i in pick]
            size = np.array([len(c) for c in cols])
            row, col = np.repeat(np.arange(len(pick)), size), np.concatenate(cols)
            x = ratio[col]
            err = sigmoid(np.bincount(row, w[col] * x, minlength=len(pick)) + bias) - y[pick]
            err *= np.where(y[pick] > 0, 0.5 / share, 0.5 / (1 - share)) / len(pick)
            g = np.bincount(col, err[row] * x, minlength=DIMS)
            at = np.flatnonzero(g)
            g = g[at] + penalty * w[at]
            gw[at] += g * g
            w[at] -= rate * g / np.sqrt(gw[at])
            gb += err.sum() ** 2
            bias -= rate * float(err.sum() / np.sqrt(gb))
    table = w * ratio
    return Model(bias - shift(y[part], np.array([bias + table[unpacked(r)].sum() for r, p in zip(rows, part) if p])), table)


def shift(y: np.ndarray, margin: np.ndarray) -> float:
    """The middle of the cuts, between -6 and 6, that make the fewest errors; 0 without both classes."""
    if len(y) == 0 or y.min() == y.max():
        return 0.0
    tries = np.linspace(-6, 6, 97)
    errors = ((margin[None, :] > tries[:, None]) != (y[None, :] > 0)).sum(axis=1)
    return float(np.median(tries[errors == errors.min()]))


def _presence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [packed(index) for _, index in presences(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("y").cast(pa.int32()), pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.binary())], ["y", "dense", "idx"],
        )


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 5,
          toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Fit on at most ``toxic_rows`` and ``clean_rows`` labelled documents with a non-zero remainder.

    Whole texts; null texts count as without n-grams, rows without an id or a label are not taken,
    repeated rows count each.  Empty tables give the model that answers 0.5.  ``docs`` needs doc_id
    and text; extra columns of either table are ignored.
    """
    sample = labelled_sample(docs, labels, label, divisor, toxic_rows, clean_rows)
    sample = sample.select(F.col("_y").alias("y"), F.lower("text").alias("text"))
    got = [(r.y, r.dense, bytes(r.idx)) for r in sample.mapInArrow(_presence_rows, "y int, dense boolean, idx binary").toLocalIterator()]
    got.sort()
    return fit(np.array([g[0] for g in got], np.float64), [g[1:] for g in got])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get the bias's score.

    Texts of any length are scored whole.  A null id stays null and repeated rows stay repeated, each
    with its own text's score; equal texts have equal scores.  Extra columns are ignored, whatever
    their names; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Model(model.bias, model.table.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = np.full(batch.num_rows, m.bias)
            for i, index in presences(batch.column(1)):
                out[i] += m.table[index].sum(dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(out))], ["doc_id", "score"])

    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"lower(cast(`{text_col}` AS string)) AS text")
    return rows.mapInArrow(run, "doc_id long, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
