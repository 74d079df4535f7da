"""Corpus pipeline over ``documents``: five stages that each call one of the ten operators.

A stage gets what the stage before it kept and returns the columns of ``documents``; the last one
returns the packed pieces.  ``run`` writes every stage's rows as Parquet in the shared folder and
reads them back, so a stage never recomputes another.  Every stage takes null columns, empty and very
long texts, repeated rows and an empty table (which gives an empty one); columns other than those of
``documents`` are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.decontaminate import find_leaks
from ledgerloom.llm.jaccard import jaccard_groups
from ledgerloom.llm.lines import dedupe_lines
from ledgerloom.llm.packing import pack
from ledgerloom.llm.quality import THRESHOLD, score, train
from ledgerloom.llm.scratch import Scratch, temporary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A null or empty text is scored by its structure, a long one whole, a null n_chars by its absence.
    Repeated rows and rows with a null doc_id are judged each; a score equal to the threshold stays.
    Without labels of both classes the model gives every text the share of the class (0.5 without any).
    """
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select(*COLUMNS), machine).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that align with an earlier document go, and documents that lose all their lines.

    A changed text gets its new number of characters; others keep n_chars as it is.  Null texts, texts
    without a line and documents with a null doc_id stay as they are.  Rows that share a doc_id are
    never aligned with each other, so repeated rows stay, and lose the same lines.
    """
    found = dedupe_lines(docs, min_words=1, keep=("lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    return found.where(~(changed & (F.col("n_removed") == F.col("n_lines")))).select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays.

    All rows with that id stay, repeated ones included.  Null and empty texts link with nothing and
    stay, and so do documents with a null doc_id.
    """
    # small tiles: the workers also hold what the other stages have loaded
    others = jaccard_groups(docs, block_rows=256).where("component_id < doc_id").select("doc_id")
    return docs.join(others.hint("merge"), "doc_id", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    All rows of such a doc_id go.  Null and empty texts hold nothing; documents with a null doc_id stay.
    Long texts are searched whole.  An empty benchmark removes nothing.
    """
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences: every row has its own pieces, a null text the end token."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", jaccard),
    ("decontamination", decontaminate),
    ("best_fit_packing", packing),
]
#: SQL has neither the classifier, the alignment nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; a stage's own tables and its predecessor's rows go once it is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with temporary(spark, name):
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.keep(name)
    return docs
