"""Bounded, repeatable samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(divisor)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, divisor: int, ones: int, zeros: int, seed: int = 7
) -> DataFrame:
    """(doc_id, text, n_chars, _y) of at most ``ones`` and ``zeros`` labelled documents.

    Only rows whose id has a non-zero remainder are taken.  The ids are chosen by a hash, first per
    class by a distributed top-k, so no more than ``ones + zeros`` ids are ever broadcast; where rows
    share an id, the bound holds for the rows.  Null labels, labels other than 0 and 1 and null ids are
    left out; extra columns are ignored; empty tables give an empty sample.
    """
    usable = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).where(
        F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & (remainder(F.col("_id"), divisor) != 0)
    )
    order = [F.xxhash64(F.col("_id"), F.lit(seed)), F.col("_id"), F.col("_y")]
    chosen = usable.where("_y = 1").orderBy(*order).limit(ones).unionByName(
        usable.where("_y = 0").orderBy(*order).limit(zeros)
    )
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"), chars.alias("n_chars"))
    rows = plain.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")
    at = F.row_number().over(Window.partitionBy("_y").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "text", "n_chars"))
    return rows.withColumn("_at", at).where(F.col("_at") <= F.when(F.col("_y") == 1, ones).otherwise(zeros)).drop("_at")
