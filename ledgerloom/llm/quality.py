"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The second sum costs O(features x factors).  Fitting uses a bounded sample (``per_class``); scoring
is one pass over the rows without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .samples import labelled_sample, remainder

WORD_DIMS = 1 << 15
FACTORS = 6
PER_CLASS = 2500
_STATS = 20
DIMS = WORD_DIMS + _STATS

_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n",
                             b"!?", b".,;:", b"|", b"#$%&*+=<>@^_~\\/{}[]", b"\"'()-`"), start=1):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 11
_N_CLASS = 12


class Features(NamedTuple):
    """Sparse rows: ``row`` ascending."""

    first: int
    rows: int
    row: np.ndarray
    index: np.ndarray
    value: np.ndarray


def _distinct_share(s: W.Slice) -> np.ndarray:
    row = s.row_of_word()
    if len(row) == 0:
        return np.ones(s.rows)
    order = np.lexsort((s.hashes, row))
    r, h = row[order], s.hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    total = np.diff(s.bounds)
    return np.where(total > 0, np.bincount(r[new], minlength=s.rows) / np.maximum(total, 1), 1.0)


def features(text: pa.Array, n_chars: np.ndarray) -> Iterator[Features]:
    """Word part: square-root counts of hashed words, length 1.  Then structure and metadata."""
    lines = W.word_slices(text, separators=W.IS_NEWLINE)
    for s, ln in zip(W.word_slices(text, lower=True), lines):
        row = s.row_of_word()
        key = row * WORD_DIMS + (s.hashes & np.uint64(WORD_DIMS - 1)).astype(np.int64)
        key, count = np.unique(key, return_counts=True)
        r, idx = key // WORD_DIMS, key % WORD_DIMS
        val = np.sqrt(count.astype(np.float64))
        norm = np.sqrt(np.bincount(r, val * val, minlength=s.rows))
        val = 3.0 * val / np.maximum(norm[r], 1e-9)
        size = np.diff(s.offsets)
        owner = np.repeat(np.arange(s.rows), size)
        hist = np.bincount(owner * _N_CLASS + _CLASS[s.data], minlength=s.rows * _N_CLASS).reshape(s.rows, _N_CLASS)
        share = hist / np.maximum(size, 1)[:, None]
        n_words, n_lines = np.diff(s.bounds), np.diff(ln.bounds)
        width = np.bincount(row, (s.ends - s.starts), minlength=s.rows) / np.maximum(n_words, 1)
        meta = n_chars[s.first : s.first + s.rows]
        dense = np.column_stack([
            np.sqrt(share[:, 1:]),
            _distinct_share(s), _distinct_share(ln), width / 10, np.log1p(n_words) / 8,
            np.log1p(n_words / np.maximum(n_lines, 1)) / 6, np.log1p(n_lines) / 6,
            np.where(np.isnan(meta), 0, np.log1p(np.maximum(np.nan_to_num(meta), 0))) / 10, np.isnan(meta), size == 0,
        ]).clip(-3, 3)
        k = dense.shape[1]
        rows = np.concatenate([r, np.repeat(np.arange(s.rows), k)])
        cols = np.concatenate([idx, np.tile(WORD_DIMS + np.arange(k), s.rows)])
        vals = np.concatenate([val, dense.ravel()])
        order = np.argsort(rows, kind="stable")
        yield Features(s.first, s.rows, rows[order], cols[order], vals[order])


class Machine(NamedTuple):
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, rows: int, row: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = self.bias + np.bincount(row, self.linear[index] * value, minlength=rows)
        for f in range(self.factors.shape[1]):
            vx = self.factors[index, f] * value
            out += 0.5 * (np.bincount(row, vx, minlength=rows) ** 2 - np.bincount(row, vx * vx, minlength=rows))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(y: np.ndarray, row: np.ndarray, index: np.ndarray, value: np.ndarray, epochs: int = 25,
        rate: float = 0.08, decay: float = 2e-4, seed: int = 5) -> Machine:
    """Adagrad over small batches.  Without rows the machine answers 0.5; one class gives its share."""
    rng = np.random.default_rng(seed)
    linear, factors, bias = np.zeros(DIMS), rng.normal(0, 0.02, (DIMS, FACTORS)), 0.0
    if len(y) == 0:
        return Machine(0.0, linear, np.zeros((DIMS, FACTORS)))
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    bounds = np.searchsorted(row, np.arange(len(y) + 1))
    gl, gf = np.full(DIMS, 1e-2), np.full((DIMS, FACTORS), 1e-2)
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs if 0 < y.mean() < 1 else 0):
        order = rng.permutation(len(y))
        for a in range(0, len(order), 64):
            pick = order[a : a + 64]
            at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in pick])
            r = np.repeat(np.arange(len(pick)), bounds[pick + 1] - bounds[pick])
            i, x = index[at], value[at]
            m = Machine(bias, linear, factors)
            err = (sigmoid(m.margin(len(pick), r, i, x)) - y[pick]) * weight[pick] / len(pick)
            cols, inv = np.unique(i, return_inverse=True)
            g = np.bincount(inv, err[r] * x, minlength=len(cols)) + decay * linear[cols]
            gl[cols] += g * g
            linear[cols] -= rate * g / np.sqrt(gl[cols])
            for f in range(FACTORS):
                v = factors[i, f]
                total = np.bincount(r, v * x, minlength=len(pick))
                g = np.bincount(inv, err[r] * x * (total[r] - v * x), minlength=len(cols)) + decay * factors[cols, f]
                gf[cols, f] += g * g
                factors[cols, f] -= 0.5 * rate * g / np.sqrt(gf[cols, f])
            bias -= rate * float(err.sum())
    return Machine(bias, linear, factors)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chars = batch.column("n_chars").to_numpy(zero_copy_only=False).astype(np.float64)
        y = batch.column("y").to_numpy(zero_copy_only=False)
        for f in features(batch.column("text"), chars):
            cut = np.searchsorted(f.row, np.arange(f.rows + 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(y[f.first : f.first + f.rows], pa.int32()),
                pa.array([f.index[cut[i] : cut[i + 1]].astype("<i4").tobytes() for i in range(f.rows)], pa.binary()),
                pa.array([f.value[cut[i] : cut[i + 1]].astype("<f4").tobytes() for i in range(f.rows)], pa.binary()),
            ], ["y", "idx", "val"])


def _prepared(docs: DataFrame, *more: str) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(*more, F.col("text").cast("string").alias("text"), chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 5,
          per_class: int = PER_CLASS) -> Machine:
    """Fit on at most ``per_class`` labelled documents of each class with a non-zero remainder."""
    sample = _prepared(labelled_sample(docs, labels, label, divisor, per_class, per_class), F.col("_y").alias("y"))
    got = sample.mapInArrow(_feature_rows, "y int, idx binary, val binary").collect()
    got.sort(key=lambda r: (r.y, bytes(r.idx), bytes(r.val)))
    sizes = [len(r.idx) // 4 for r in got]
    return fit(
        np.array([r.y for r in got], np.float64), np.repeat(np.arange(len(got)), sizes),
        np.frombuffer(b"".join(bytes(r.idx) for r in got), "<i4").astype(np.int64),
        np.frombuffer(b"".join(bytes(r.val) for r in got), "<f4").astype(np.float64),
    )


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of ``docs`` and ``score``; null and empty texts are scored by their structure.

    A column that is already called ``score`` is replaced.  Rows stay as they are, repeated ones
    included; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(machine)
    kept = [c for c in docs.columns if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            chars = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.float64)
            out = np.empty(batch.num_rows)
            for f in features(batch.column(batch.num_columns - 2), chars):
                out[f.first : f.first + f.rows] = sigmoid(m.margin(f.rows, f.row, f.index, f.value))
            cols = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out)], [*kept, "score"])

    given = docs.select(*[f"`{c}`" for c in kept])
    chars = F.col("n_chars").cast("double") if "n_chars" in kept else F.lit(None).cast("double")
    given = given.select("*", F.col("text").cast("string").alias("_scored_text"), chars.alias("_scored_chars"))
    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add("score", "double")
    return given.mapInArrow(run, schema)


THRESHOLD = 0.3


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text", "n_chars"), machine).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
